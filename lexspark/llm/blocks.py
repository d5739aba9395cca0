"""Blocks: packed numpy arrays that units of documents send to hash partitions and get answers for."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

from lexspark.llm.common import U64


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([a.nbytes for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def unpack(raw: bytes, *kinds: str) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 31)
    sizes = np.frombuffer(body, "<i8", len(kinds))
    out, at = [], 8 * len(kinds)
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(body, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def by_partition(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of keys sorted by partition and key; cuts between partitions."""
    part = (keys % U64(n)).astype(np.int64)
    order = np.lexsort((keys, part))
    return order, np.searchsorted(part[order], np.arange(n + 1)), part


def rows_of(schema: list[tuple[str, pa.DataType]], **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in schema], names=[k for k, _ in schema])


def split_bytes(values: np.ndarray) -> np.ndarray:
    """The lowest bytes of all values, then the next, and so on: sorted gaps pack better that way."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).reshape(-1)


def join_bytes(raw: np.ndarray, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)
