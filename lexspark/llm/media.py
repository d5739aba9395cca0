"""Media in binary columns: PNG images, read and written chunk by chunk, and cosine-transform hashes of them.

write_png and read_png handle 8-bit grey images: zlib chunks with checksum tests, and all five scan-line filters.
A filtered sample needs its left, upper and upper left neighbours, so many images are undone at once along their
diagonals: step d takes the sample at d - y of every line y, of all images, whose neighbours earlier steps gave.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the first bytes of every PNG file.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
IDAT_BYTES = 1 << 16


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))


def guesses(left: np.ndarray, up: np.ndarray, corner: np.ndarray) -> Iterator[np.ndarray]:
    """What filters 0 to 4 (None, Sub, Up, Average, Paeth) expect, from neighbours in int16."""
    yield np.zeros_like(left)
    yield left
    yield up
    yield (left + up) >> 1
    # Distances of left + up - corner from each neighbour; ties go to the left one, then to the upper one.
    of_left, of_up = np.abs(up - corner), np.abs(left - corner)
    of_corner = np.abs(left + up - 2 * corner)
    yield np.where((of_left <= of_up) & (of_left <= of_corner), left, np.where(of_up <= of_corner, up, corner))


#: By residual: its distance from 0.
_SIZES = np.abs(np.arange(256, dtype=np.uint8).view(np.int8).astype(np.int16)).astype(np.uint8)


def filtered(samples: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's filter and residuals; of the five filters the one with the smallest residuals is taken.

    samples: lines of images of one width, one image after the other; first: where images begin.
    """
    height, width = samples.shape
    framed = np.zeros((height + 1, width + 1), np.int16)
    framed[1:, 1:] = samples
    above = framed[:-1].copy()
    above[first] = 0
    own = framed[1:, 1:]
    lines, least = np.zeros((height, width + 1), np.uint8), np.full(height, np.iinfo(np.int64).max)
    for kind, guess in enumerate(guesses(framed[1:, :-1], above[:, 1:], above[:, :-1])):
        residuals = (own - guess).astype(np.uint8)
        cost = _SIZES[residuals].sum(1, dtype=np.int64)
        better = cost < least
        lines[better, 0], lines[better, 1:], least[better] = kind, residuals[better], cost[better]
    return lines


def _file(width: int, height: int, packed: bytes) -> bytes:
    data = [_chunk(b"IDAT", packed[i : i + IDAT_BYTES]) for i in range(0, len(packed), IDAT_BYTES)]
    return b"".join([SIGNATURE, _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)), *data, _chunk(b"IEND", b"")])


def _alike(keys: list) -> Iterator[list[int]]:
    """Places of equal keys."""
    places: dict = {}
    for i, key in enumerate(keys):
        places.setdefault(key, []).append(i)
    yield from places.values()


def write_pngs(images: list[np.ndarray], level: int = 6) -> list[bytes]:
    """images: uint8, height x width. An image's lines have filters chosen one by one, or all none (better for text), whatever packs better."""
    out = [b""] * len(images)
    for mine in _alike([x.shape[1] for x in images]):
        heights = np.array([len(images[i]) for i in mine])
        ends = np.cumsum(heights)
        samples = np.concatenate([images[i] for i in mine])
        plain = np.zeros((len(samples), samples.shape[1] + 1), np.uint8)
        plain[:, 1:] = samples
        chosen = filtered(samples, (ends - heights)[heights > 0])
        for i, a, b in zip(mine, (ends - heights).tolist(), ends.tolist()):
            packed = min((zlib.compress(lines[a:b].tobytes(), level) for lines in (plain, chosen)), key=len)
            out[i] = _file(samples.shape[1], b - a, packed)
    return out


def write_png(samples: np.ndarray, level: int = 6) -> bytes:
    return write_pngs([samples], level)[0]


def chunks(png: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Chunks up to IEND; a wrong signature, length or checksum is an error."""
    if png[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at = 8
    while True:
        if at + 12 > len(png):
            raise ValueError("PNG ends early")
        (size,) = struct.unpack_from(">I", png, at)
        kind, body = png[at + 4 : at + 8], png[at + 8 : at + 8 + size]
        check = png[at + 8 + size : at + 12 + size]
        if len(check) != 4 or struct.unpack(">I", check)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"wrong checksum of {kind!r}")
        yield kind, body
        if kind == b"IEND":
            return
        at += 12 + size


def unfilter(images: list[np.ndarray]) -> list[np.ndarray]:
    """Samples of images of one width, from their lines (filter, then one byte a sample)."""
    heights = np.array([len(x) for x in images])
    lines = np.concatenate(images)
    width = lines.shape[1] - 1
    if len(lines) and lines[:, 0].max() > 4:
        raise ValueError("unknown filter")
    # Lines by their number within the image: those at work in a step lie together.
    image = np.repeat(np.arange(len(images)), heights)
    first = np.cumsum(heights) - heights
    number = np.arange(len(lines)) - first[image]
    order = np.argsort(number, kind="stable")
    place = np.empty(len(lines), np.int64)
    place[order] = np.arange(len(lines))
    number, kinds = number[order], lines[order, 0]
    above = np.where(number > 0, place[np.maximum(order - 1, 0)], len(lines))  # the last place stays 0
    source, begin = lines[:, 1:].reshape(-1), order * width - number
    out = np.empty(source.shape, np.uint8)
    now, before = np.zeros(len(lines) + 1, np.int16), np.zeros(len(lines) + 1, np.int16)
    for d in range(int(heights.max(initial=0)) + width - 1 if width else 0):
        lo, hi = np.searchsorted(number, (d - width + 1, d + 1))
        work, at = slice(lo, hi), begin[lo:hi] + d
        left, up, corner = now[work], now[above[work]], before[above[work]]
        sample = (source[at] + np.choose(kinds[work], list(guesses(left, up, corner)))) & 255
        out[at] = sample
        before[work] = left
        now[work] = sample
    samples = out.reshape(len(lines), width)
    return [samples[a : a + n] for a, n in zip(first.tolist(), heights.tolist())]


def filtered_lines(png: bytes) -> np.ndarray:
    """Lines of an 8-bit grey PNG without interlacing as they are stored: a filter and its residuals."""
    head, data = None, []
    for kind, body in chunks(png):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        elif kind[0] & 32 == 0 and kind != b"IEND":
            raise ValueError(f"unknown critical chunk {kind!r}")
    if head is None or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("only 8-bit grey PNG without interlacing")
    width, height = head[:2]
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    if len(lines) != height * (width + 1):
        raise ValueError("PNG has too few or too many samples")
    return lines.reshape(height, width + 1)


def read_pngs(pngs: list[bytes]) -> list[np.ndarray]:
    """Samples of each image, height x width."""
    lines = [filtered_lines(png) for png in pngs]
    out = [x[:, 1:] for x in lines]
    coded = [i for i, x in enumerate(lines) if x[:, 0].any()]
    for alike in _alike([lines[i].shape[1] for i in coded]):
        mine = [coded[k] for k in alike]
        for i, samples in zip(mine, unfilter([lines[i] for i in mine])):
            out[i] = samples
    return out


def read_png(png: bytes) -> np.ndarray:
    return read_pngs([png])[0]


_SIDE, _LOW = 32, 8
_k = np.arange(_LOW)[:, None]
#: The lowest frequencies of a cosine transform (type II) over _SIDE places.
COSINES = np.cos(np.pi * _k * (2 * np.arange(_SIDE)[None, :] + 1) / (2 * _SIDE))


def cosine_hashes(images: list[np.ndarray]) -> list[bytes]:
    """Of each image 8 bytes: for each of the 8 x 8 lowest frequencies, whether it is above their median (without the mean's).

    An image is first averaged down, or repeated up, to 32 x 32. Images of one shape are worked on together.
    """
    out = [b""] * len(images)
    for mine in _alike([x.shape for x in images]):
        height, width = images[mine[0]].shape
        sums = np.zeros((len(mine), height + 1, width + 1), np.int64)
        sums[:, 1:, 1:] = np.stack([images[i] for i in mine]).cumsum(1, dtype=np.int64).cumsum(2)
        ys, xs = np.arange(_SIDE) * height // _SIDE, np.arange(_SIDE) * width // _SIDE
        ye, xe = np.maximum(ys + 1, (np.arange(_SIDE) + 1) * height // _SIDE), np.maximum(xs + 1, (np.arange(_SIDE) + 1) * width // _SIDE)
        rows = sums[:, ye] - sums[:, ys]
        small = (rows[:, :, xe] - rows[:, :, xs]) / ((ye - ys)[:, None] * (xe - xs)[None, :])
        low = np.round(COSINES @ small @ COSINES.T, 6).reshape(len(mine), -1)
        for i, bits in zip(mine, low > np.median(low[:, 1:], axis=1, keepdims=True)):
            out[i] = np.packbits(bits).tobytes()
    return out


def cosine_hash(samples: np.ndarray) -> bytes:
    return cosine_hashes([samples])[0]


def text_payload(raw: bytes) -> bytes:
    """raw with bytes 0 up to a positive multiple of 64."""
    return raw + bytes(-len(raw) % WIDTH if raw else WIDTH)


def _with(df: DataFrame, more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), more])


def encode_media(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without text, with `n_bytes` (long) and `media` (binary): the text's UTF-8 as a PNG 64 samples wide.

    Null text counts as empty, and an empty one is stored as one line of zeros. Columns named n_bytes or media
    are replaced; repeated rows stay. A text is held whole, with some ten times its size while it is packed.
    """
    kept = docs.drop("n_bytes", "media").select(*[c for c in docs.columns if c not in ("n_bytes", "media", text)], F.encode(text, "UTF-8").alias(text))
    schema = _with(kept.drop(text), "n_bytes long, media binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(batch.num_columns - 1)
            for lo, hi in _slices(raw):
                rows = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in raw.slice(lo, hi - lo)]
                media = write_pngs([np.frombuffer(text_payload(x), np.uint8).reshape(-1, WIDTH) for x in rows])
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(list(map(len, rows)), pa.int64()), pa.array(media, pa.binary())], names=[*batch.schema.names[:-1], "n_bytes", "media"])

    return kept.mapInArrow(run, schema)


def _slices(values: pa.Array, most_rows: int = 512, most_bytes: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about most_bytes at most; a longer row is one of its own."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(values), 0)))
    lo = 0
    while lo < len(values):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most_bytes, side="right"))
        hi = min(max(hi, lo + 1), lo + most_rows)
        yield lo, min(hi, len(values))
        lo = min(hi, len(values))


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_features(media: DataFrame, column: str = "media") -> DataFrame:
    """media without its binary column, with what is read back from it: sizes, digests and the hash in hex.

    Null media gives nulls; media that is damaged or no 8-bit grey PNG is an error.
    """
    names = [f.split()[0] for f in FEATURES.split(", ")]
    kept = media.select(*[c for c in media.columns if c not in (*names, column)], column)
    schema = _with(kept.drop(column), FEATURES)
    types = [pa.string() if " string" in f else pa.int64() for f in FEATURES.split(", ")]

    def features(png: bytes | None, samples: np.ndarray | None, mark: bytes | None) -> tuple:
        if png is None:
            return (None,) * len(names)
        payload = samples.tobytes()
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(png), hashlib.sha256(png).hexdigest(), mark.hex()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(lo, hi - lo)
                pngs = part.column(part.num_columns - 1).to_pylist()
                images = read_pngs([x for x in pngs if x is not None])
                more = iter(zip(images, cosine_hashes(images)))
                rows = [features(x, *((None, None) if x is None else next(more))) for x in pngs]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=[*batch.schema.names[:-1], *names])

    return kept.mapInArrow(run, schema)
