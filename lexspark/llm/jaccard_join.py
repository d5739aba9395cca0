"""N-gram Jaccard join by multiple global orders, and the components that its links make.

1. Equal sets of shingles become one node, found by size and a 128-bit digest.
2. A set can only link if most of its shingles occur elsewhere too. Units of documents send their distinct shingles,
   each once, as sorted blocks to hash partitions, which answer how many of each document's shingles others share;
   what several documents of a unit hold is counted there. Sets with too few are done. (Blocks hold 32 bits of a
   hash there; a clash only leaves a set in.)
3. For the rest, frequencies come from a second exchange of blocks, again one entry of a unit for each shingle. There
   are three global orders: by frequency, rare first; and the same after each half of all shingles, halved by hash,
   has gone first. Two sets that link share a shingle within their prefixes under every order. The first order's
   prefixes make buckets; pairs must also share one in the prefixes of the other orders, so in either half, before
   they are verified exactly.
4. Each bucket has a pivot, and its members join the pivot's group. Members are first tried with their pivot. Then
   those in another component than their pivot are tried with all members of the group in other components, so
   every pair that shares a bucket is tried or already connected. A group's tries are dealt out as a grid of bounded
   cells, pairs are never rows, and a large group of copies isn't squared. Joins on hot shingles and hot nodes are
   plain joins, which adaptive execution splits where a key is skewed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.blocks import by_partition, pack, rows_of, unpack
from lexspark.llm.common import LOWER, U64, input_partitions, joined, mixed, span_hashes, staged, text_chunks, unit_bytes, word_spans

WORDS = 4
PERCENT = 85
ORDERS = 3
#: The list of candidate sets is broadcast if it has at most so many bytes as a hash table; a larger one is shuffled.
BROADCAST_BYTES = 64 << 20
#: Of the list: key and value rows of 24 and 16 bytes, their headers, and two slots of 16 bytes in the table.
BROADCAST_ROW_BYTES = 128
_MULTIPLIERS = [U64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def shingles(buf: np.ndarray, offs: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a chunk of texts, sorted within each text, and their offsets by text."""
    buf = LOWER[buf]
    starts, ends, before = word_spans(buf, offs)
    own = span_hashes(buf, starts, ends)
    n_words = np.diff(before)
    count = np.where(n_words >= words, n_words - words + 1, (n_words > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(count)), count)
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + before[:-1][doc]
    width = np.minimum(n_words, words)[doc]
    total = width.astype(U64) * U64(0x8CB92BA72F3D8DD7)
    padded = np.concatenate([own, np.zeros(words, U64)])
    for k in range(words):
        part = (padded[at + k] + U64(k)) * _MULTIPLIERS[k % 4]
        total += np.where(width > k, mixed(part), U64(0))
    total = mixed(total)
    order = np.lexsort((total, doc))
    total, doc = total[order], doc[order]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])
    return total[new], np.searchsorted(doc[new], np.arange(len(count) + 1))


def digests(sets: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set: a sum and an exclusive or of differently mixed members."""
    one, two = np.zeros(len(offs) - 1, U64), np.zeros(len(offs) - 1, U64)
    filled = np.flatnonzero(np.diff(offs))
    if len(filled):
        one[filled] = np.add.reduceat(mixed(sets ^ U64(0x5851F42D4C957F2D)), offs[:-1][filled])
        two[filled] = np.bitwise_xor.reduceat(mixed(sets + U64(0x14057B7EF767814F)), offs[:-1][filled])
    return one.view(np.int64), two.view(np.int64)


_I, _B = pa.int64(), pa.binary()
_SETS = [("kind", pa.int32()), ("part", pa.int32()), ("unit", _I), ("slot", _I), ("doc_id", _I), ("text_hash", _I), ("n", _I), ("k1", _I), ("k2", _I), ("payload", _B)]
_SETS_SQL = "kind int, part int, unit long, slot long, doc_id long, text_hash long, n long, k1 long, k2 long, payload binary"
DOC, BLOCK, COUNTS = 0, 1, 2


def _sets_and_shares(docs: DataFrame, words: int) -> DataFrame:
    """DOC rows: each document's set (unit, slot, n, digests); COUNTS rows: by unit and partition, how many of each document's shingles others share."""
    n_parts = input_partitions(docs)
    size = unit_bytes(n_parts)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = TaskContext.get().partitionId() << 20  # the same when a lost task is run again
        for rows, buf, offs in text_chunks(joined(batches, size), most_bytes=size):
            sets, cuts = shingles(buf, offs, words)
            one, two = digests(sets, cuts)
            m = rows.num_rows
            yield rows_of(_SETS, kind=[DOC] * m, part=np.arange(m) % n_parts, unit=[unit] * m, slot=np.arange(m), doc_id=rows.column(0), text_hash=rows.column(1), n=np.diff(cuts), k1=one, k2=two)
            order, at, _ = by_partition(sets, n_parts)
            key, doc = sets[order], np.repeat(np.arange(m), np.diff(cuts))[order]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            times = np.diff(np.append(starts, len(key)))
            # What several documents of the unit share is known here; others only need to know that it exists.
            here = np.bincount(doc[np.repeat(times > 1, times)], minlength=m)
            yield rows_of(_SETS, kind=[COUNTS], part=[unit % n_parts], unit=[unit], payload=[pack(here.astype("<u4"))])
            short, who = (key[starts] >> U64(32)).astype("<u4"), np.where(times > 1, 0, doc[starts] + 1).astype("<u4" if m >= 0xFFFF else "<u2")
            at = np.searchsorted(starts, at)
            full = np.flatnonzero(np.diff(at)).tolist()
            blocks = [pack(np.diff(short[at[p] : at[p + 1]], prepend=np.uint32(0)), who[at[p] : at[p + 1]]) for p in full]
            yield rows_of(_SETS, kind=[BLOCK] * len(full), part=full, unit=[unit] * len(full), n=[who.itemsize] * len(full), payload=blocks)
            unit += 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, shorts, docs_of = [], [], []
        for batch in batches:
            is_block = np.array(batch.column(0)) == BLOCK
            if not is_block.all():
                yield batch.filter(pa.array(~is_block))
            for unit, width, raw in zip(*(batch.filter(pa.array(is_block)).column(i).to_pylist() for i in (2, 6, 9))):
                gaps, who = unpack(raw, "<u4", f"<u{width}")
                units.append(unit)
                shorts.append(np.cumsum(gaps, dtype=np.uint32))
                docs_of.append(who)
        if not units:
            return
        keys, sizes = np.concatenate(shorts), np.array(list(map(len, shorts)))
        shorts.clear()
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        shared = np.zeros(len(keys), bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        ends = np.cumsum(sizes)
        out = [np.bincount(who[shared[end - size : end] & (who > 0)].astype(np.int64) - 1).astype("<u4") for who, end, size in zip(docs_of, ends.tolist(), sizes.tolist())]
        yield rows_of(_SETS, kind=[COUNTS] * len(units), part=[0] * len(units), unit=units, payload=[pack(c) for c in out])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return staged(rows.mapInArrow(send, _SETS_SQL).repartitionById(n_parts, "part").mapInArrow(count, _SETS_SQL), "jaccard-sets")


def _shared(sets: DataFrame) -> DataFrame:
    """unit, slot, shared: the counts of all partitions added up; documents that share nothing are left out."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            for unit, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (more,) = unpack(raw, "<u4")
                have = kept.get(unit, np.zeros(0, np.int64))
                total = np.zeros(max(len(have), len(more)), np.int64)
                total[: len(have)] = have
                total[: len(more)] += more
                kept[unit] = total
        for unit, total in kept.items():
            slot = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"unit": pa.array([unit] * len(slot), _I), "slot": slot, "shared": total[slot]})

    n = input_partitions(sets)
    return sets.where(f"kind = {COUNTS}").select("unit", "payload").repartition(n, "unit").mapInArrow(add, "unit long, slot long, shared long")


_UNITS = [("kind", pa.int32()), ("part", pa.int32()), ("unit", _I), ("payload", _B)]
_UNITS_SQL = "kind int, part int, unit long, payload binary"
_NODES = [("kind", pa.int32()), ("token", _I), ("node", _I), ("n", _I), ("rare", _I), ("payload", _B)]
_NODES_SQL = "kind int, token long, node long, n long, rare long, payload binary"
NODE, ENTRY = 0, 1


def _candidate_units(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The candidates' sets, some MB of text a row: nodes, offsets and shingles. wanted: node, doc_id, text_hash."""
    few = wanted.count() * BROADCAST_ROW_BYTES <= BROADCAST_BYTES
    size = unit_bytes(input_partitions(docs))
    wanted = wanted.select("node", F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"))
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    key = texts["doc_id"].eqNullSafe(F.col("of_id")) & (texts["text_hash"] == F.col("of_hash"))
    own = texts.join(F.broadcast(wanted) if few else wanted, key).select("node", "text")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = TaskContext.get().partitionId() << 20
        for rows, buf, offs in text_chunks(joined(batches, size), most_bytes=size):
            sets, cuts = shingles(buf, offs, words)
            yield rows_of(_UNITS, kind=[NODE], part=[-1], unit=[unit], payload=[pack(np.asarray(rows.column(0), "<i8"), cuts.astype("<i8"), sets.astype("<u8"))])
            unit += 1

    return staged(own.mapInArrow(gather, _UNITS_SQL), "jaccard-units")


def prefix_length(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """So many of the first members hold a common one, if an overlap of percent of n is needed."""
    return n - (percent * n + 99) // 100 + 1


def ordered(sets: np.ndarray, df: np.ndarray, doc: np.ndarray, order: int) -> np.ndarray:
    """Places of all members by document, and within each by a global order.

    Order 0 takes rare shingles first, order 1 those of one half of all shingles (by hash) before the other's,
    order 2 the other way round, rare ones first in either half. Ties go by an own hash.
    """
    own = mixed(sets ^ U64(0xA0761D6478BD642F * (order + 1) & 0xFFFFFFFFFFFFFFFF))
    half = mixed(sets + U64(0xE7037ED1A0B428DB)) & U64(1)
    return np.lexsort((own, df, doc) if order == 0 else (own, df, half ^ U64(order - 1), doc))


def prefixes(sets: np.ndarray, cuts: np.ndarray, df: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the shared members of all sets' prefixes, and whose they are."""
    n = np.diff(cuts)
    doc = np.repeat(np.arange(len(n)), n)
    length = prefix_length(n, percent)
    for k in range(ORDERS):
        rank = ordered(sets, df, doc, k)
        first = (np.arange(len(rank)) - cuts[:-1][doc] < length[doc]) & (df > 1)[rank]
        yield sets[rank][first], doc[first]


def _prefixes(units: DataFrame, percent: int) -> DataFrame:
    """NODE rows: a node's shared shingles and its prefixes under the later orders; ENTRY rows: prefixes under the first."""
    n_parts = input_partitions(units)

    def dealt(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct shingles by partition, how many sets of the unit have each, cuts, and each member's place among them."""
        keys, inverse, times = np.unique(sets, return_inverse=True, return_counts=True)
        order, at, _ = by_partition(keys, n_parts)
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        return keys[order], times[order], at, place[inverse]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, raw in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                keys, times, at, _ = dealt(unpack(raw, "<i8", "<i8", "<u8")[2])
                full = np.flatnonzero(np.diff(at)).tolist()
                yield rows_of(_UNITS, kind=[ENTRY] * len(full), part=full, unit=[unit] * len(full), payload=[pack(keys[at[p] : at[p + 1]], times[at[p] : at[p + 1]].astype("<u4")) for p in full])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, keys, counts = [], [], []
        for batch in batches:
            for part, unit, raw in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                own, times = unpack(raw, "<u8", "<u4")
                heads.append((part, unit))
                keys.append(own)
                counts.append(times)
        if not heads:
            return
        _, of = np.unique(np.concatenate(keys), return_inverse=True)
        df = np.minimum(np.bincount(of, np.concatenate(counts))[of], 0xFFFFFFFF).astype("<u4")  # frequencies beyond 32 bits tie
        at = np.concatenate([[0], np.cumsum(list(map(len, keys)))]).tolist()
        yield rows_of(_UNITS, kind=[ENTRY] * len(heads), part=[p for p, _ in heads], unit=[u for _, u in heads], payload=[pack(df[a:b]) for a, b in zip(at, at[1:])])

    def order_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list = []

        def done() -> Iterator[pa.RecordBatch]:
            nodes, cuts, sets, df, _, place = own
            df = df[place]
            doc = np.repeat(np.arange(len(nodes)), np.diff(cuts))
            (token, of), *later = prefixes(sets, cuts, df, percent)
            rare = prefix_length(np.diff(cuts), percent) - np.bincount(of, minlength=len(nodes))
            lists = []
            for chosen, whose in later:
                again = np.lexsort((chosen, whose))
                lists.append((chosen[again], np.searchsorted(whose[again], np.arange(len(nodes) + 1))))
            shared = df > 1
            kept, kept_at = sets[shared], np.searchsorted(doc[shared], np.arange(len(nodes) + 1))
            payload = [pack(kept[kept_at[i] : kept_at[i + 1]], *(t[a[i] : a[i + 1]] for t, a in lists)) for i in range(len(nodes))]
            yield rows_of(_NODES, kind=[NODE] * len(nodes), node=nodes, n=np.diff(cuts), payload=payload)
            yield rows_of(_NODES, kind=[ENTRY] * len(token), token=token.view(np.int64), node=nodes[of], rare=rare[of])

        for batch in batches:
            for part, unit, raw in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if part < 0:
                    if own:
                        yield from done()
                    nodes, cuts, sets = unpack(raw, "<i8", "<i8", "<u8")
                    keys, _, at, place = dealt(sets)
                    own = [nodes, cuts, sets, np.ones(len(keys), np.int64), at, place]
                else:
                    own[3][own[4][part] : own[4][part + 1]] = unpack(raw, "<u4")[0]
        if own:
            yield from done()

    answers = units.mapInArrow(send, _UNITS_SQL).repartitionById(n_parts, "part").mapInArrow(answer, _UNITS_SQL)
    together = units.unionByName(answers).repartition(n_parts, "unit").sortWithinPartitions("unit", "part")
    return staged(together.mapInArrow(order_sets, _NODES_SQL), "jaccard-nodes", partition_by="kind")


_MEMBERS = "pivot long, node long, linked boolean"


def _memberships(entries: DataFrame) -> DataFrame:
    """pivot, node: each bucket's pivot, the member with the fewest shingles of its own, with each other member.

    Pivots are found by partial sums, so a bucket of any size is one row of each task there.
    """
    pivots = entries.groupBy("token").agg(F.min(F.struct("rare", "node")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("token", F.col("least.node").alias("pivot"))
    return entries.join(pivots, "token").where("node != pivot").select("pivot", "node").distinct()


def _tried_with_pivots(members: DataFrame, sets: DataFrame, percent: int, share: int = 256) -> DataFrame:
    """members with `linked`. A pivot's set goes to one task for each `share` members, whose sets come after it."""
    counts = members.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("salts"))
    salted = members.join(counts, "pivot").withColumn("salt", F.pmod(F.hash("node"), F.col("salts")))
    own = salted.join(sets, "node").select("pivot", "salt", "node", "n", "payload")
    pivots = counts.join(sets.withColumnRenamed("node", "pivot"), "pivot").select("pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("node"), "n", "payload")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n_first = [], 0
        for batch in batches:
            out: list[tuple[int, int, bool]] = []
            for pivot, node, n, raw in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                arrays = unpack(raw, *["<u8"] * ORDERS)
                if node is None:
                    first, n_first = arrays, n
                    continue
                linked = False
                if all(_common(x, y) for x, y in zip(first[1:], arrays[1:])):  # the other orders' filters
                    both = _common(first[0], arrays[0])
                    linked = 100 * both >= percent * (n + n_first - both)
                out.append((pivot, node, linked))
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], _I), pa.array(columns[1], _I), pa.array(columns[2], pa.bool_())], names=["pivot", "node", "linked"])

    dealt = pivots.unionByName(own).repartition(input_partitions(members), "pivot", "salt")
    return dealt.sortWithinPartitions("pivot", "salt", F.col("node").asc_nulls_first()).mapInArrow(verify, _MEMBERS)


class _Left:
    """The sets of a share of a group, by member: how many members of each that another set has."""

    def __init__(self, rows: list[tuple[int, int, int, list[np.ndarray]]]) -> None:
        self.node, self.n, self.label = (np.array([r[i] for r in rows]) for i in range(3))
        self.tables = [self._table([r[3][k] for r in rows]) for k in range(ORDERS)]

    def _table(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        member = np.concatenate(sets)
        order = np.argsort(member, kind="stable")
        return member[order], np.repeat(np.arange(len(sets)), list(map(len, sets)))[order]

    def common(self, k: int, own: np.ndarray) -> np.ndarray:
        members, of = self.tables[k]
        lo, hi = np.searchsorted(members, own), np.searchsorted(members, own, side="right")
        size = hi - lo
        ends = np.cumsum(size)
        at = np.repeat(lo - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        return np.bincount(of[at], minlength=len(self.node))


def _tried_within_groups(tried: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, side: int = 512) -> DataFrame:
    """a, b: links between components so far, as many in a task as connect what it has seen.

    In each group the members outside their pivot's component (left) are tried with all members in other components
    than theirs (right). Left and right rows are dealt into shares of about `side` rows each, and every left share
    meets every right one in a cell, so no cell is larger whatever the group is.
    """
    label = lambda name: F.coalesce(F.col(name), F.col(name[2:]))
    known = tried.join(labels.select(F.col("node"), F.col("label").alias("l_node")), "node", "left").join(labels.select(F.col("node").alias("pivot"), F.col("label").alias("l_pivot")), "pivot", "left")
    rows = known.select("pivot", "node", label("l_node").alias("label"), (label("l_node") != label("l_pivot")).alias("left"))
    groups = rows.groupBy("pivot").agg(F.count_if("left").alias("n_left"), F.count(F.lit(1)).alias("n_all")).where("n_left > 0 AND n_all > 1")
    shares = groups.select("pivot", *[F.ceil(F.col(n) / side).cast("long").alias(c) for n, c in (("n_left", "n_rows"), ("n_all", "n_columns"))])
    open_ = rows.join(shares, "pivot").join(sets, "node")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    placed = lambda c: F.pmod(F.hash("node"), F.col(c))
    share = (F.col("row") * F.col("n_columns") + F.col("column")).alias("share")
    lefts = open_.where("left").withColumns({"row": placed("n_rows"), "column": every("n_columns")}).select("pivot", share, F.lit(0).alias("side"), "node", "n", "label", "payload")
    rights = open_.withColumns({"row": every("n_rows"), "column": placed("n_columns")}).select("pivot", share, F.lit(1).alias("side"), "node", "n", "label", "payload")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, left = None, [], None
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        for batch in batches:
            out: list[tuple[int, int]] = []
            for pivot, part, side, node, n, own_label, raw in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if (pivot, part) != key:
                    key, held, left, root = (pivot, part), [], None, {}
                arrays = unpack(raw, *["<u8"] * ORDERS)
                if side == 0:
                    held.append((node, n, own_label, arrays))
                    continue
                if not held:
                    continue
                left = left or _Left(held)
                may = (left.label != own_label) & (100 * np.minimum(left.n, n) >= percent * np.maximum(left.n, n))
                for k in range(1, ORDERS):  # the other orders' filters
                    if may.any():
                        may &= left.common(k, arrays[k]) > 0
                if may.any():
                    both = left.common(0, arrays[0])
                    for i in np.flatnonzero(may & (100 * both >= percent * (left.n + n - both))).tolist():
                        x, y = find(int(left.label[i])), find(own_label)
                        if x != y:
                            root[x] = y
                            out.append((int(left.node[i]), node))
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], _I), "b": pa.array([y for _, y in out], _I)})

    dealt = lefts.unionByName(rights).repartition(input_partitions(tried), "pivot", "share")
    return dealt.sortWithinPartitions("pivot", "share", "side").mapInArrow(verify, "a long, b long")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Common members of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    if len(x) == 0:
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest node that links reach, for every node of a link.

    Each round takes the least label of the neighbours and then the label of that label, so paths shorten by
    half; rounds are tables in the shared folder, and only the number of changes comes to the driver.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = staged(links.union(links.select("b", "a")).distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = staged(nearer.join(up, "label", "left").select("node", "old", F.least("label", "up").alias("label")), "labels")
        if jumped.where("old != label").isEmpty():
            return labels
        labels = jumped.select("node", "label")


def join_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, first for every row of docs (doc_id, text).

    component_id: the smallest doc_id that links reach, the row itself included (null if all are null). first:
    whether the row is the one to keep of its component: that with the smallest doc_id, null last. Rows
    without words have no shingles, link with nothing and are each first. Rows that repeat are linked as copies.
    """
    sets = _sets_and_shares(docs, words)
    rows = sets.where(f"kind = {DOC}").select("doc_id", "text_hash", "n", "k1", "k2", "unit", "slot", ((F.col("unit") * (1 << 20)) + F.col("slot")).alias("row"))
    filled = rows.where("n > 0").join(_shared(sets), ["unit", "slot"], "left")
    rep = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "text_hash")
    groups = staged(filled.groupBy("n", "k1", "k2").agg(F.min("row").alias("node"), F.min(rep).alias("rep"), F.max("shared").alias("shared")), "jaccard-groups")
    wanted = groups.where(f"100 * coalesce(shared, 0) >= {percent} * n").select("node", "rep.doc_id", "rep.text_hash")
    nodes = _prefixes(_candidate_units(docs, wanted, words), percent)
    payloads = nodes.where(f"kind = {NODE}").select("node", "n", "payload").dropDuplicates(["node"])
    entries = nodes.where(f"kind = {ENTRY}").select("token", "rare", "node")
    tried = staged(_tried_with_pivots(_memberships(entries), payloads, percent), "jaccard-tried")
    links = tried.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    labels = components(links)
    more = staged(_tried_within_groups(tried, labels, payloads, percent), "jaccard-links")
    if not more.isEmpty():
        labels = components(links.union(more))
    # By set, then by component: what a component keeps is the least representative of its sets.
    by_set = groups.join(labels, "node", "left").select("n", "k1", "k2", "rep", F.coalesce("label", "node").alias("component"))
    best = by_set.groupBy("component").agg(F.min("rep").alias("best"))
    placed = by_set.join(best, "component").select("n", "k1", "k2", "best")
    known = rows.where("n > 0").join(placed, ["n", "k1", "k2"]).select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("best.doc_id").alias("component_id"), (F.col("row") == F.col("best.row")).alias("first"))
    empty = rows.where("n = 0").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return known.unionByName(empty)


def first_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component (join_groups says which), columns as they are.

    Rows are found by doc_id and a hash of the text; rows that repeat in both stay once, also without words. What
    goes, and the few rows that repeat, are looked up; where these lists are small, texts aren't shuffled.
    """
    marks = [F.col("doc_id").cast("string"), F.xxhash64("text")]
    of = lambda df: df.select(F.col("doc_id").cast("string").alias("__id"), F.col("text_hash").alias("__hash"), "first")
    listed = staged(of(join_groups(docs, words, percent)).groupBy("__id", "__hash").agg(F.max("first").alias("first"), F.count(F.lit(1)).alias("n")).where("NOT first OR n > 1"), "jaccard-gone")
    match = lambda kept: marks[0].eqNullSafe(kept["__id"]) & (marks[1] == kept["__hash"])
    repeated = listed.where("first")
    once = docs.join(listed, match(listed), "left_anti")
    again = docs.join(repeated, match(repeated), "left_semi").withColumns({"__id": F.coalesce(marks[0], F.lit("")), "__hash": marks[1]}).dropDuplicates(["__id", "__hash"])
    return once.unionByName(again.select(*docs.columns))
