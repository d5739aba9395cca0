"""Getting archives: which formats to ask for, how to go on with a part, and a cache that is trusted only if it checks out.

Nothing here opens a connection: `fetch` does, and is given by the caller. These are decisions and single files of the
driver; what is in archives is read by archives.zip_members.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import zipfile
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from pathlib import Path

from lexspark.operators.canonical import DOWNLOAD_ORDER
from lexspark.sources.archives import tested_members

CHUNK = 8 << 20
ATTEMPTS = 3
INVENTORY_VERSION = 1


class NotAvailable(RuntimeError):
    """No format of a collection could be got."""


def formats_to_try(preferred: str, available: Iterable[str] = ()) -> list[str]:
    """The preferred format, then the others that are offered, in the order of downloads."""
    offered = set(available)
    return list(dict.fromkeys([preferred, *(f for f in DOWNLOAD_ORDER if f in offered)]))


def file_digest(path: Path) -> str:
    with path.open("rb") as source:
        return hashlib.file_digest(source, "sha256").hexdigest()


@dataclass(frozen=True)
class Entry:
    """What the inventory says of an archive."""

    collection: str
    format: str
    members: int
    sha256: str
    size: int

    @classmethod
    def of(cls, path: Path, collection: str, source_format: str) -> Entry:
        """Reads every file of the archive; ValueError if one is unsafe or damaged, or there is none."""
        try:
            with zipfile.ZipFile(path) as archive:
                members = len(tested_members(archive))
        except zipfile.BadZipFile as error:
            raise ValueError(str(error)) from error
        return cls(collection, source_format, members, file_digest(path), path.stat().st_size)


def replaced(path: Path, text: str) -> None:
    """Writes a file whole or not at all."""
    draft = path.with_name(path.name + ".draft")
    draft.write_text(text, encoding="utf-8")
    os.replace(draft, path)


class Cache:
    """Archives in a folder, each with its line of checksum, and an inventory of all."""

    def __init__(self, folder: Path) -> None:
        self.folder = folder
        folder.mkdir(parents=True, exist_ok=True)

    @property
    def _inventory(self) -> Path:
        return self.folder / "inventory.json"

    def _line(self, name: str) -> Path:
        return self.folder / f"{name}.sha256"

    def entries(self) -> dict[str, dict]:
        """The inventory; empty if it is missing, damaged or of another version."""
        try:
            value = json.loads(self._inventory.read_text(encoding="utf-8"))
            known = value["archives"] if value["schema_version"] == INVENTORY_VERSION else {}
            return known if isinstance(known, dict) else {}
        except (OSError, ValueError, KeyError, TypeError):
            return {}

    def _keep(self, entries: dict[str, dict]) -> None:
        replaced(self._inventory, json.dumps({"schema_version": INVENTORY_VERSION, "archives": entries}, ensure_ascii=False, indent=2, sort_keys=True) + "\n")

    def put(self, name: str, source: Path, entry: Entry) -> None:
        draft = self.folder / f"{name}.draft"
        shutil.copyfile(source, draft)
        os.replace(draft, self.folder / name)
        replaced(self._line(name), f"{entry.sha256}  {name}\n")
        self._keep(self.entries() | {name: asdict(entry)})

    def evict(self, name: str) -> None:
        for path in (self.folder / name, self._line(name)):
            path.unlink(missing_ok=True)
        self._keep({k: v for k, v in self.entries().items() if k != name})

    def get(self, name: str) -> Path | None:
        """The archive, if its files, checksum line and inventory agree; what does not is evicted."""
        path, known = self.folder / name, self.entries().get(name)
        if not path.is_file():
            return None
        try:
            found = Entry.of(path, "", "")
            listed = [known[k] for k in ("members", "sha256", "size")] if known else []
            if listed == [found.members, found.sha256, found.size] and self._line(name).read_text(encoding="ascii").strip() == f"{found.sha256}  {name}":
                return path
        except (OSError, ValueError, KeyError, TypeError):
            pass
        self.evict(name)
        return None


@dataclass(frozen=True)
class Answer:
    """What a server says before it sends bytes. start: the first byte's place, if it goes on with a part; etag may be none."""

    start: int | None
    etag: str | None
    pieces: Iterable[bytes]


#: fetch(collection, format, offset): asks for the archive from a byte on.
Fetch = Callable[[str, str, int], Answer]


def goes_on(answer: Answer, offset: int, edition: str, known: dict) -> bool:
    """Whether the answer goes on with the part that is there; ValueError if it is of another archive or place.

    The part belongs to the same archive if it was begun for the same edition, or if both have the same tag.
    """
    if not offset or answer.start is None:
        return False
    if answer.start != offset:
        raise ValueError("the server goes on at another place")
    if known.get("edition") != edition and not (answer.etag and answer.etag == known.get("etag")):
        raise ValueError("the part belongs to another archive")
    return True


def _received(fetch: Fetch, collection: str, source_format: str, edition: str, part: Path) -> None:
    note = part.with_name(part.name + ".json")
    offset = part.stat().st_size if part.exists() else 0
    answer = fetch(collection, source_format, offset)
    try:
        known = json.loads(note.read_text(encoding="utf-8"))
    except (OSError, ValueError):
        known = {}
    on = goes_on(answer, offset, edition, known)
    replaced(note, json.dumps({"edition": edition, "etag": answer.etag}))
    with part.open("ab" if on else "wb") as out:
        for piece in answer.pieces:
            out.write(piece)


def download(fetch: Fetch, cache: Cache, collection: str, source_format: str, edition: str, attempts: int = ATTEMPTS, wait: Callable[[int], None] = lambda attempt: None) -> tuple[Path, bool]:
    """The archive in the cache, and whether it was there already. NotAvailable after so many attempts.

    A connection that breaks (ConnectionError, TimeoutError) leaves its part for the next attempt; a damaged archive
    or a part of another one is thrown away.
    """
    if found := cache.get(edition):
        return found, True
    part = cache.folder / f"{edition.rpartition('-')[0] or edition}.part"  # editions of one collection share a part
    note, last = part.with_name(part.name + ".json"), None
    for attempt in range(1, attempts + 1):
        try:
            _received(fetch, collection, source_format, edition, part)
            cache.put(edition, part, Entry.of(part, collection, source_format))
            part.unlink()
            note.unlink(missing_ok=True)
            return cache.folder / edition, False
        except (ConnectionError, TimeoutError) as error:
            last = error
        except (OSError, ValueError) as error:
            last = error
            part.unlink(missing_ok=True)
            note.unlink(missing_ok=True)
        if attempt < attempts:
            wait(attempt)
    raise NotAvailable(f"{collection}: no archive after {attempts} attempts: {last}")


def collect(fetch: Fetch, cache: Cache, name: str, edition_name: str, preferred: str, available: Iterable[str] = (), created: str | None = None, smoke: bool = False, **how) -> tuple[Path, str, bool] | None:
    """The archive of a collection in the first format that can be got: path, format, whether it was cached.

    If none can, NotAvailable tells why of each; a smoke test goes on without the collection (null).
    """
    told = []
    for source_format in formats_to_try(preferred, available):
        try:
            path, cached = download(fetch, cache, name, source_format, f"{edition_name}-{source_format}-{created or 'unknown'}.zip", **how)
            return path, source_format, cached
        except NotAvailable as error:
            told.append(str(error))
    if smoke:
        return None
    raise NotAvailable("no format could be got:\n- " + "\n- ".join(told))
