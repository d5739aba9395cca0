"""What the operators share: sizes, Arrow text chunks, vectorised words; staging is that of the library."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexspark.staging import new_folder, shared_dir, staged  # noqa: F401

#: Words are runs of code points outside this class; the same class in Java, RE2 and Python.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_RE = rf"[^{SPACE_CLASS}]+"

U64 = np.uint64
_MASK = (1 << 64) - 1


#: Input of one hash partition, at least; a task holds a few times as much.
PARTITION_BYTES = 32 << 20
#: Input behind each block that a unit of documents sends to a hash partition, at least.
BLOCK_BYTES = 4 << 10


def input_partitions(df: DataFrame) -> int:
    """Hash partitions for what is dealt out of df: as many as its files' size asks for, at least the session's number.

    Units of documents send a block to each partition, so units times partitions must grow no faster than the input:
    partitions are of PARTITION_BYTES, and beyond 256 GB of input they grow, as units do, with its square root
    (64 MB at 1 TB, 640 MB at 100 TB). The size is what Spark knows of the tables read, without running anything;
    tables of unknown size count nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(x for x in sizes if x < 1 << 60)
    each = max(PARTITION_BYTES, math.isqrt(known * BLOCK_BYTES))
    return max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known // each))


def unit_bytes(n_parts: int, least: int = 1 << 21) -> int:
    """Text of one unit: enough for BLOCK_BYTES in each of its blocks, so the number of blocks follows the input alone."""
    return max(least, n_parts * BLOCK_BYTES)


def joined(batches: Iterator[pa.RecordBatch], least_bytes: int, most_rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of least_bytes or more (the last: what is left), but not more than most_rows if no input batch has more."""
    held: list[pa.RecordBatch] = []

    def together() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if held and sum(b.num_rows for b in held) + batch.num_rows > most_rows:
            yield together()
            held = []
        if batch.num_rows:
            held.append(batch)
        if sum(b.nbytes for b in held) >= least_bytes:
            yield together()
            held = []
    if held:
        yield together()


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", most_bytes: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Whole rows in slices of about most_bytes of text: (slice, UTF-8 bytes, row offsets). Null text counts as empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
        if len(texts) == 0:
            continue
        bufs = texts.buffers()
        offs = np.frombuffer(bufs[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(texts):
            hi = int(np.searchsorted(offs, offs[lo] + most_bytes, side="right")) - 1
            hi = min(max(hi, lo + 1), len(texts))
            yield batch.slice(lo, hi - lo), data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
            lo = hi


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and how many words lie before each row offset; rows end words."""
    if len(buf) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    space = _SPACES[buf]
    before = np.empty(len(buf), bool)
    before[0] = True
    before[1:] = space[:-1]
    before[offs[:-1][offs[:-1] < len(buf)]] = True
    after = np.empty(len(buf), bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[offs[1:][offs[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BASE = 0x9E3779B97F4A7C15
#: Random codes of bytes; for words those of white space are 0.
ALL_BYTES = mixed(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
WORD_BYTES = np.where(_SPACES, U64(0), ALL_BYTES)
_powers = np.ones(1, U64)


def powers(n: int) -> np.ndarray:
    """The first n powers of an odd base modulo 2**64."""
    global _powers
    while len(_powers) < n:
        step = U64(pow(_BASE, len(_powers), 1 << 64))
        _powers = np.concatenate([_powers, _powers * step])
    return _powers[:n]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = WORD_BYTES) -> np.ndarray:
    """64-bit hashes of spans, from byte codes times powers of a base; bytes between spans must have code 0."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    first = int(starts[0])
    gaps = np.diff(np.append(starts, len(buf)))
    at = np.arange(first, len(buf), dtype=np.int64) - np.repeat(starts, gaps)
    lens = (ends - starts).astype(U64)
    longest = int(lens.max())
    np.minimum(at, longest - 1, out=at)  # only bytes between spans lie further on
    terms = codes.take(buf[first:])
    terms *= powers(longest).take(at)
    return mixed(np.add.reduceat(terms, starts - first) + lens * U64(0xA24BAED4963EE407))
