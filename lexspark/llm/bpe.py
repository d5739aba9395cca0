"""Byte-level BPE without regular expressions.

Boundaries of pre-tokens come from arrays: each code point gets a class from a table, a symbol that
also holds what stands next to it (the last white space of a run, a contraction ahead), and a small
automaton over these symbols says where a piece begins. Automaton steps are functions on states; their
composition is associative, so all texts of a chunk are run at once: functions are composed within
blocks, then across blocks by doubling, and every block is replayed from its true first state.
The slices feed pair merging by rank, whose results are cached by piece.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import ALL_BYTES, U64, span_hashes, text_chunks

# Classes of code points.
LETTER, NUMBER, OTHER, BLANK, WHITE = range(5)
# Symbols: what the automaton reads.
(S_LETTER, S_NUMBER, S_OTHER, S_QUOTE1, S_QUOTE2, S_BLANK_LAST, S_WHITE_LAST, S_WHITE_IN) = range(8)
N_SYMBOLS = 8
# States: what the piece under way is. CLOSED: the next code point begins a piece.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_WHITE, ONE_MORE, TWO_MORE = range(8)
N_STATES = 8
#: The code points of Unicode's White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins at this code point."""
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return CLOSED, False
    if symbol in (S_QUOTE1, S_QUOTE2) and state not in (IN_OTHERS, AFTER_BLANK):
        return (ONE_MORE if symbol == S_QUOTE1 else TWO_MORE), True
    if symbol == S_WHITE_IN:
        return IN_WHITE, state != IN_WHITE
    if symbol == S_BLANK_LAST:
        return AFTER_BLANK, True
    if symbol == S_WHITE_LAST:
        return CLOSED, True
    to = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS}.get(symbol, IN_OTHERS)
    return to, state not in (to, AFTER_BLANK)


class Automaton:
    """Tables for single steps and for composed steps. Symbols from N_SYMBOLS on begin a text."""

    def __init__(self) -> None:
        pairs = [[step(s, x) for x in range(N_SYMBOLS)] for s in range(N_STATES)]
        fresh = [(pairs[CLOSED][x][0], True) for x in range(N_SYMBOLS)]
        rows = [row + fresh for row in pairs]
        self.to = np.array([[p[0] for p in row] for row in rows], np.uint8)
        self.begins = np.array([[p[1] for p in row] for row in rows], bool)
        functions: dict[tuple[int, ...], int] = {tuple(range(N_STATES)): 0}
        letters = [tuple(int(s) for s in self.to[:, x]) for x in range(2 * N_SYMBOLS)]
        for f in letters:
            functions.setdefault(f, len(functions))
        members, seen = list(functions), 0
        while seen < len(members):  # all functions that words over the symbols can make
            f = members[seen]
            seen += 1
            for g in letters:
                fg = tuple(g[s] for s in f)
                if fg not in functions:
                    functions[fg] = len(functions)
                    members.append(fg)
        table = np.array(members, np.uint8)
        self.of_symbol = np.array([functions[f] for f in letters], np.int32)
        self.first = table[:, CLOSED]
        self.size = len(members)
        # Flat tables, so that a step is one lookup: by function and symbol, by two functions, by state and symbol.
        then = np.array([[functions[tuple(int(s) for s in g[list(f)])] for g in table] for f in members], np.int32)
        self.then = then.reshape(-1)
        self.then_symbol = np.ascontiguousarray(then[:, self.of_symbol]).reshape(-1)
        self.moves = (self.to.astype(np.int32) * 2 * N_SYMBOLS).reshape(-1)
        self.begins = self.begins.reshape(-1)


@lru_cache(1)
def automaton() -> Automaton:
    return Automaton()


@lru_cache(1)
def class_table() -> np.ndarray:
    """Class by code point, from the Unicode categories of Python."""
    major = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((major.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = WHITE
    table[0x20] = BLANK
    return table


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols of code points; first: where texts begin."""
    n = len(points)
    kind = class_table().take(points)
    white = kind >= BLANK
    starts = np.zeros(n + 1, bool)
    starts[first] = True
    starts[n] = True
    last = np.zeros(n, bool)  # white, and something else follows in the same text
    last[:-1] = white[:-1] & ~white[1:] & ~starts[1:-1]
    out = kind.copy()
    out[white] = S_WHITE_IN
    out[last] = np.where(kind[last] == BLANK, S_BLANK_LAST, S_WHITE_LAST)
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        same1 = ~starts[np.minimum(quote + 1, n)]
        same2 = same1 & ~starts[np.minimum(quote + 2, n)]
        single = same1 & np.isin(one, [ord(c) for c in "stmd"])
        double = same2 & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        out[quote[single]] = S_QUOTE1
        out[quote[double]] = S_QUOTE2
    out[first] += N_SYMBOLS
    return out


def piece_starts(points: np.ndarray, first: np.ndarray, block: int = 64) -> np.ndarray:
    """Indexes of the code points that begin pieces. first: distinct indexes where non-empty texts begin."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    auto = automaton()
    sym = symbols(points, first)
    blocks = -(-n // block)
    grid = np.full(blocks * block, S_LETTER, np.int32)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(blocks, block).T)
    composed = auto.of_symbol[grid[0]]
    for j in range(1, block):
        composed = auto.then_symbol.take(composed * (2 * N_SYMBOLS) + grid[j])
    reach = 1
    while reach < blocks:  # prefix composition by doubling
        nearer = composed.copy()
        nearer[reach:] = auto.then.take(composed[:-reach] * auto.size + composed[reach:])
        composed = nearer
        reach *= 2
    state = np.empty(blocks, np.int32)
    state[0] = CLOSED
    state[1:] = auto.first[composed[:-1]]
    state *= 2 * N_SYMBOLS
    begins = np.empty(grid.shape, bool)
    for j in range(block):
        state += grid[j]
        auto.begins.take(state, out=begins[j])
        state = auto.moves.take(state)
    return np.flatnonzero(np.ascontiguousarray(begins.T).reshape(-1)[:n])


def chunk_pieces(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of pieces over a chunk of texts, and the number of pieces before each text."""
    if len(buf) == 0:
        return np.zeros(1, np.int64), np.zeros(len(offs), np.int64)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    points = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    filled = offs[:-1][np.diff(offs) > 0]
    starts = lead[piece_starts(points, np.searchsorted(lead, filled))]
    return np.append(starts, len(buf)), np.searchsorted(starts, offs)


@lru_cache(2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: of all neighbours the pair of lowest rank is joined, leftmost first, until none has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 48:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    get, none = ranks.get, 1 << 60
    scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while scores:
        best = min(scores)
        if best == none:
            break
        i = scores.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del scores[i]
        if i:
            scores[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(scores):
            scores[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n: a heap of pairs over a linked list; stale entries are skipped."""
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that begins here; 0 once it is joined to its left
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(a: int) -> None:
        b = end[a]
        if b < n and (rank := ranks.get(piece[a : end[b]])) is not None:
            heapq.heappush(heap, (rank, a, end[b]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, a, stop = heapq.heappop(heap)
        b = end[a]
        if b == 0 or b >= n or end[b] != stop:
            continue
        end[a], end[b] = stop, 0
        if stop < n:
            before[stop] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    ids, a = [], 0
    while a < n:
        ids.append(ranks[piece[a : end[a]]])
        a = end[a]
    return ids


class PieceTable:
    """Ids by piece, cached in arrays sorted by a hash; `encode` gets the pieces that are new, each once.

    A piece is known by its 64-bit hash, its size and its first 8 bytes; pieces that agree in the hash alone are
    encoded for themselves. The table starts anew when it holds `most` pieces: that bounds memory and changes no result.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], most: int = 500_000) -> None:
        self.encode, self.most = encode, most
        self._restart()

    def _restart(self) -> None:
        self.keys, self.place = np.zeros(0, U64), np.zeros(0, np.int64)
        self.checks, self.sizes, self.starts, self.flat = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.encode(pieces)
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def lookup(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces between bounds, in order, and the number of ids of each piece."""
        n = len(bounds) - 1
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.keys) > self.most:
            self._restart()
        starts, sizes = bounds[:-1], np.diff(bounds)
        hashes = span_hashes(buf, starts, bounds[1:], ALL_BYTES)
        padded = np.concatenate([buf, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(buf), "<u8", padded, strides=(1,))[starts]
        eight &= _HEADS.take(np.minimum(sizes, 8))
        code, keys = pd.factorize(hashes)
        first = np.empty(len(keys), np.int64)
        first[code[::-1]] = np.arange(n - 1, -1, -1)
        checks, key_sizes = eight[first], sizes[first]
        if not ((eight == checks.take(code)) & (sizes == key_sizes.take(code))).all():
            return self._encoded(cut(buf, bounds))
        at = np.searchsorted(self.keys, keys)
        near = np.minimum(at, max(len(self.keys) - 1, 0))
        same = self.keys[near] == keys if len(self.keys) else np.zeros(len(keys), bool)
        place = np.full(len(keys), -1)
        place[same] = self.place[near[same]]
        hit = same.copy()
        hit[same] = (self.checks[place[same]] == checks[same]) & (self.sizes[place[same]] == key_sizes[same])
        new = np.flatnonzero(~hit)
        if len(new):
            raw, begin = buf.tobytes(), starts[first[new]].tolist()
            flat, counts = self._encoded([raw[a : a + k] for a, k in zip(begin, key_sizes[new].tolist())])
            place[new] = len(self.checks) + np.arange(len(new))
            self.checks, self.sizes = np.concatenate([self.checks, checks[new]]), np.concatenate([self.sizes, key_sizes[new]])
            self.starts, self.flat = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)]), np.concatenate([self.flat, flat])
            fresh = new[~same[new]]
            fresh = fresh[np.argsort(keys[fresh])]
            where = np.searchsorted(self.keys, keys[fresh])
            self.keys, self.place = np.insert(self.keys, where, keys[fresh]), np.insert(self.place, where, place[fresh])
        begin = self.starts.take(place)
        counts = self.starts.take(place + 1) - begin
        begin, counts = begin.take(code), counts.take(code)
        ends = np.cumsum(counts)
        return self.flat.take(np.repeat(begin - (ends - counts), counts) + np.arange(int(ends[-1]))), counts


_HEADS = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def cut(buf: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    raw, at = buf.tobytes(), bounds.tolist()
    return [raw[a:b] for a, b in zip(at, at[1:])]


_caches: dict[str, tuple[PieceTable, np.ndarray, np.ndarray]] = {}


def _tools(path: str) -> tuple[PieceTable, np.ndarray, np.ndarray]:
    """Cache of pieces, and all tokens' bytes and decimals by id, once in each worker."""
    if path not in _caches:
        ranks = read_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        _caches[path] = (PieceTable(lambda pieces: [merge_pairs(p, ranks) for p in pieces]), np.array(tokens, object), np.array([b"%d " % i for i in range(len(tokens))], object))
    return _caches[path]


OUT = "ids array<int>, ends array<int>"


def encode(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """docs with `ids` (array of int) and `ends` (array of int: the byte offset in the text after each id).

    A null text counts as empty and gets empty arrays. Columns named ids or ends are replaced.
    Rows keep their other columns, repeated rows stay, and no order is promised.
    """
    kept = docs.drop("ids", "ends")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", " + OUT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, tokens, _ = _tools(ranks_path)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        for rows, buf, offs in text_chunks(batches, text):
            bounds, before = chunk_pieces(buf, offs)
            ids, n = cache.lookup(buf, bounds)
            at = np.concatenate([[0], np.cumsum(n)])[before]
            lists = pa.array(at.astype(np.int32))
            ends = np.cumsum(sizes[ids]) - np.repeat(offs[:-1], np.diff(at))
            columns = [pa.ListArray.from_arrays(lists, pa.array(x.astype(np.int32))) for x in (ids, ends)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=[*rows.schema.names, "ids", "ends"])

    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """encoded with `decoded` (binary): the bytes of the ids. Null ids decode to empty; an unknown id is an error."""
    kept = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tools(ranks_path)[1]
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            decoded = [b"".join(tokens[np.asarray(own.values)].tolist()) if own.is_valid and len(own.values) else b"" for own in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"])

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_pieces: digests of what encode() and decode() give.

    Encoding, decoding and digests run in one pass, as arrays of ids need not leave the worker.
    Null or empty text: 0 tokens and the digests of the empty string. Repeated rows stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, tokens, decimals = _tools(ranks_path)
        sha = hashlib.sha256
        for rows, buf, offs in text_chunks(batches):
            bounds, before = chunk_pieces(buf, offs)
            ids, n = cache.lookup(buf, bounds)
            at = np.concatenate([[0], np.cumsum(n)])[before].tolist()
            words, parts = decimals[ids].tolist(), tokens[ids].tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(np.diff(at)),
                    pa.array([sha(b"".join(words[a:b])[:-1]).hexdigest() for a, b in zip(at, at[1:])], pa.string()),
                    pa.array([sha(b"".join(parts[a:b])).hexdigest() for a, b in zip(at, at[1:])], pa.string()),
                    pa.array(np.diff(before)),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_pieces"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_pieces long")
