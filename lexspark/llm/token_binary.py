"""Token ids in binary shards: frequency-ranked ids in byte-aligned variable-length coding.

A shard holds documents in ascending doc_id order. Its ids are replaced by their rank by frequency within
the shard (the table of ids by rank is in the shard), so frequent ids take one byte. Control bytes, two bits
for each value's length, lie apart from the data bytes; four values are decoded by a lookup of their control byte.

Layout, little-endian: 8 bytes of magic; 5 uint64 (documents, ids, types, data bytes, ids of the bucket before);
doc_id int64 and null flags uint8 by document; ids of each document uint32; ids by rank uint32; control bytes;
data bytes; crc32 of all before it, uint32.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.bpe import PieceTable, chunk_pieces
from lexspark.llm.common import input_partitions, new_folder, staged, text_chunks

MAGIC = b"FRVB0001"
END_ID = 0

_controls = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
#: By control byte: the lengths of its four values, and where each begins among their data bytes.
LENGTHS = (_controls + 1).astype(np.uint8)
PLACES = np.concatenate([np.zeros((256, 1), np.int64), np.cumsum(LENGTHS, 1, dtype=np.int64)], 1)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of uint32 values; the last control byte is filled up with zeros."""
    n = len(values)
    padded = np.zeros(-(-n // 4) * 4, np.uint32)
    padded[:n] = values
    extra = (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    four = extra.reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8)
    stops = np.cumsum(extra.astype(np.int64) + 1)
    data = np.empty(int(stops[-1]) if n else 0, np.uint8)
    at = stops - extra - 1
    for k in range(4):
        has = slice(None) if k == 0 else np.flatnonzero(extra >= k)
        data[at[has] + k] = padded[has] >> np.uint32(8 * k) & np.uint32(0xFF)
    return control.tobytes(), data.tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The first n values. All four of a control byte come from one row of the tables."""
    if n == 0:
        return np.zeros(0, np.uint32)
    stops = np.cumsum(PLACES[control, 4])
    at = ((stops - PLACES[control, 4])[:, None] + PLACES[control, :4]).reshape(-1)[:n]
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    word = padded[at] | padded[at + 1] << 8 | padded[at + 2] << 16 | padded[at + 3] << 24
    return word & MASKS[LENGTHS[control].reshape(-1)[:n]]


def write_shard(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, before: int) -> bytes:
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    by_rank = np.argsort(-counts, kind="stable")[: int((counts > 0).sum())].astype(np.uint32)
    rank = np.zeros(len(counts), np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    control, data = pack(rank[ids])
    null = np.array([d is None for d in doc_ids], np.uint8)
    body = b"".join(
        [
            MAGIC,
            struct.pack("<5Q", len(doc_ids), len(ids), len(by_rank), len(data), before),
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            null.tobytes(),
            sizes.astype("<u4").tobytes(),
            by_rank.astype("<u4").tobytes(),
            control,
            data,
        ]
    )
    return body + struct.pack("<I", zlib.crc32(body))


def read_shard(body: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """doc_ids, ids of each document, all ids, ids of the bucket before; a damaged shard is an error."""
    if body[:8] != MAGIC or zlib.crc32(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
        raise ValueError("not a whole shard of token ids")
    docs, n, types, size, before = struct.unpack_from("<5Q", body, 8)
    at = 48

    def take(count: int, kind: str) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    doc_ids, null, sizes = take(docs, "<i8"), take(docs, "u1"), take(docs, "<u4")
    by_rank, control, data = take(types, "<u4"), take(-(-n // 4), "u1"), take(size, "u1")
    return [None if z else d for d, z in zip(doc_ids.tolist(), null.tolist())], sizes, by_rank[unpack(control, data, n)], before


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if it shows, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_caches: dict[str, tuple[PieceTable, AddedTokens]] = {}


class AddedTokens:
    """The tokenizer's added tokens, which the library takes out of a text before it looks at anything else.

    They are found leftmost first, the longest of those that begin together. Tokens that take white space beside
    them, stand only as whole words or are sought in normalised text are left to the library: texts that hold one
    go whole to its encode().
    """

    def __init__(self, tokenizer) -> None:
        added = tokenizer.get_added_tokens_decoder().items()
        self.ids = {t.content.encode(): i for i, t in added if t.content}
        self.plain = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for _, t in added)
        self.tokenizer = tokenizer
        self.pattern = re.compile(b"|".join(re.escape(t) for t in sorted(self.ids, key=len, reverse=True)))

    def holders(self, raw: bytes, offs: list[int]) -> list[int]:
        """Which texts of a chunk hold an added token."""
        if not any(t in raw for t in self.ids):
            return []
        return [i for i, (a, b) in enumerate(zip(offs, offs[1:])) if self.pattern.search(raw, a, b)]


def _library(path: str) -> tuple[PieceTable, AddedTokens]:
    if path not in _caches:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenize, letters = tokenizer.model.tokenize, byte_letters()
        table = PieceTable(lambda pieces: [[t.id for t in tokenize(p.decode("latin-1").translate(letters))] for p in pieces], most=1_000_000)
        _caches[path] = (table, AddedTokens(tokenizer))
    return _caches[path]


def library_ids(buf: np.ndarray, offs: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The tokenizers library's ids of a chunk of texts, and the number of ids of each text.

    A byte-level tokenizer takes added tokens out of a text, splits each part between them into pre-tokens and
    encodes each pre-token for itself, so the library's model is given every pre-token that this worker has not
    met before, once.
    """
    table, added = _library(path)
    raw, at = buf.tobytes(), offs.tolist()
    held = added.holders(raw, at)
    if not held:
        return _piece_ids(table, buf, offs)
    if not added.plain:
        ids, sizes = _piece_ids(table, buf, offs)
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for i in held:
            parts[i] = np.array(added.tokenizer.encode(raw[at[i] : at[i + 1]].decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    spans = [(m.start(), m.end(), added.ids[m[0]]) for i in held for m in added.pattern.finditer(raw, at[i], at[i + 1])]
    begin, end, own = (np.array(x, np.int64) for x in zip(*spans))
    # Cuts at texts and at both ends of added tokens; the parts that are added tokens get one id, the others' as they are.
    cuts = np.unique(np.concatenate([offs, begin, end]))
    part = np.searchsorted(cuts, begin)
    ids, sizes = _piece_ids(table, buf, cuts)
    first = np.cumsum(sizes) - sizes
    gone = np.zeros(len(ids) + 1, np.int64)
    np.add.at(gone, first[part], 1)
    np.add.at(gone, first[part] + sizes[part], -1)
    kept = np.cumsum(gone[:-1]) == 0
    sizes[part] = 0
    place = (np.cumsum(sizes) - sizes)[part]
    sizes[part] = 1
    before = np.concatenate([[0], np.cumsum(sizes)])
    return np.insert(ids[kept], place, own.astype(ids.dtype)), np.diff(before[np.searchsorted(cuts, offs)])


def _piece_ids(table: PieceTable, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bounds, before = chunk_pieces(buf, offs)
    ids, n = table.lookup(buf, bounds)
    return ids, np.diff(np.concatenate([[0], np.cumsum(n)])[before])


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str | None = None, shard_ids: int = 1 << 21) -> DataFrame:
    """Encodes docs (doc_id, text), writes shards under folder, and returns their list: bucket, shard, path, n_docs, n_ids.

    Buckets are ranges of doc_id; texts are dealt out to them and encoded there, in order. Shards follow each other by
    bucket and shard number in ascending doc_id order (null ids last; equal ids by a hash of the text, then the text). A null text is empty: its only id is the end id. Repeated rows stay. Files of a task that is run
    again get other names; only those of the list count. The folder may be any URI that Arrow's file systems open.
    """
    folder = folder or new_folder(docs.sparkSession, "token-shards")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        fs, root = pafs.FileSystem.from_uri(folder)
        held: list[tuple[int | None, np.ndarray]] = []
        bucket, shard, before, size = TaskContext.get().partitionId(), 0, 0, 0  # ranges in order

        def flush() -> pa.RecordBatch:
            nonlocal held, size, shard, before
            ids = np.concatenate([x for _, own in held for x in (own, [END_ID])]).astype(np.uint32)
            body = write_shard([d for d, _ in held], np.array([len(own) + 1 for _, own in held]), ids, before)
            name = f"{bucket:08d}-{shard:06d}-{uuid.uuid4().hex}.ids"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(body)
            row = pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "shard": pa.array([shard], pa.int32()), "path": [f"{folder}/{name}"], "n_docs": pa.array([len(held)]), "n_ids": pa.array([len(ids)])})
            before, shard, held, size = before + len(ids), shard + 1, [], 0
            return row

        for rows, buf, offs in text_chunks(batches):
            ids, sizes = library_ids(buf, offs, tokenizer_path)
            cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            for d, a, b in zip(rows.column(0).to_pylist(), cuts, cuts[1:]):
                if size >= shard_ids:
                    yield flush()
                held.append((d, ids[a:b]))
                size += b - a + 1
        if held:
            yield flush()

    # Ties of one doc_id (null among them) are told apart by their texts, so no id fills a range.
    keys = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    dealt = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(input_partitions(docs), *keys)
    listed = dealt.sortWithinPartitions(*keys, "text").mapInArrow(write, "bucket int, shard int, path string, n_docs long, n_ids long")
    return staged(listed, "token-shard-list")


def read_ids(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of all documents in the listed shards, from their files.

    start counts the ids of all documents before: of the buckets before (running sums over one row a bucket, of
    which there are as many as partitions), plus what the shard's head says of its own bucket.
    """
    sums = shards.groupBy("bucket").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base_ids, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, name = pafs.FileSystem.from_uri(path)
                with fs.open_input_stream(name) as source:
                    doc_ids, sizes, ids, before = read_shard(source.read())
                ends = np.cumsum(sizes.astype(np.int64))
                raw, cuts = ids.astype("<u4").tobytes(), np.concatenate([[0], ends * 4]).tolist()
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "start": pa.array(ends - sizes + before + base_ids),
                        "n_tokens": pa.array(sizes.astype(np.int64)),
                        "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                    }
                )

    listed = shards.join(base, "bucket").select("base", "path").repartition(input_partitions(shards), "path")
    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
