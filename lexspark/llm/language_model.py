"""Language-model scores by deleted interpolation of word bigrams, unigrams and a uniform floor.

P(w | u) mixes c(u, w) / c(u), c(w) / N and 1 / (V + 1). The weights depend on how often the context u was seen,
by powers of two, and are learned by expectation-maximisation on counts that were held out: a seventh of the
training documents is left out of the counts, and its bigrams are what the weights are fitted to. The final
counts take all training documents. Held-out bigrams of equal counts (of the bigram, its context and its word) are
one row; these rows stay a table, and each step of EM is one sum over it by bucket, which is all that reaches the driver.

All counts are exact and distributed. Units of documents send each hash partition the words, then the bigrams,
that they hold, once, in sorted blocks, and get the corpus counts of these back in the same order; so what travels
is the distinct n-grams of units, and a very common word or pair is one entry of each unit. Units grow with the
number of partitions (common.unit_bytes), so blocks keep their size at any size of input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.blocks import by_partition, join_bytes, pack, rows_of, split_bytes, unpack
from lexspark.llm.common import LOWER, U64, input_partitions, joined, mixed, new_folder, span_hashes, staged, text_chunks, unit_bytes, word_spans

FOLDS = 7
TEST_FOLD = 2
#: The training documents that the weights are fitted to.
WEIGHT_FOLD = 3
UNIT_BYTES = 1 << 22
END = mixed(np.array([0xE7D], U64))[0]
START = mixed(np.array([0x57A27], U64))[0]
#: 0 and one for each power of two of a 64-bit count.
BUCKETS = 64
#: Where EM starts: bigram, word, floor.
START_WEIGHTS = (0.3, 0.6, 0.1)
EM_ROUNDS = 20

_I, _B = pa.int64(), pa.binary()
_ROWS = [("kind", pa.int32()), ("part", pa.int32()), ("unit", _I), ("path", pa.string()), ("total", _I), ("kept", _I), ("types", _I), ("payload", _B)]
_SQL = "kind int, part int, unit long, path string, total long, kept long, types long, payload binary"
HEAD, BLOCK, ANSWER, SUMS = range(4)


def _write(folder: str, name: str, body: bytes) -> str:
    """A file in the shared folder under a new name, so that a task run again harms nothing."""
    import uuid

    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    path = f"{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(f"{root}/{path}") as out:
        out.write(body)
    return f"{folder}/{path}"


def _read(path: str) -> bytes:
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(name) as source:
        return source.read()


def _blocks(keys: np.ndarray, n_parts: int, *columns: np.ndarray, only: tuple[np.ndarray, ...] = ()) -> Iterator[tuple[int, bytes]]:
    """For each partition with keys: sorted keys as gaps, and the columns in the same order.

    only: flags of keys, and columns of corpus counts that are sent for these keys alone.
    """
    order, at, _ = by_partition(keys, n_parts)
    keys, columns, only = keys[order], [c[order] for c in columns], [c[order] for c in only]
    for p in np.flatnonzero(np.diff(at)).tolist():
        own = slice(at[p], at[p + 1])
        gaps = np.diff(keys[own], prepend=U64(0))
        yield p, pack(split_bytes(gaps), *(c[own] for c in columns), *(_wide(c[own][only[0][own]]) for c in only[1:]))


def _unblock(raw: bytes, *kinds: str) -> list[np.ndarray]:
    gaps, *columns = unpack(raw, "u1", *kinds)
    return [np.cumsum(join_bytes(gaps, "<u8"), dtype=U64), *columns]


def _narrow(x: np.ndarray) -> np.ndarray:
    """For counts within a unit."""
    return x.astype("<u4")


def _wide(x: np.ndarray) -> np.ndarray:
    """For corpus counts, which may exceed 32 bits; their upper bytes lie together and pack to almost nothing."""
    return split_bytes(x.astype("<u8"))


def _counts(raw: np.ndarray) -> np.ndarray:
    return join_bytes(raw, "<u8").astype(np.int64)


def _send_words(docs: DataFrame, folder: str, n_parts: int) -> DataFrame:
    """HEAD rows (a unit and the file of its tokens) and BLOCK rows (its words with training counts)."""
    size = unit_bytes(n_parts, UNIT_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = TaskContext.get().partitionId() << 20  # the same when a lost task is run again
        for rows, buf, offs in text_chunks(joined(batches, size), most_bytes=size):
            buf = LOWER[buf]
            starts, ends, before = word_spans(buf, offs)
            m, n_words = rows.num_rows, np.diff(before)
            tokens = np.empty(len(starts) + m, U64)
            stops = before[1:] + np.arange(m)
            is_end = np.zeros(len(tokens), bool)
            is_end[stops] = True
            tokens[~is_end], tokens[is_end] = span_hashes(buf, starts, ends), END
            fold = np.asarray(rows.column(1))
            own_fold = np.repeat(fold, n_words + 1)
            words, local = np.unique(tokens, return_inverse=True)
            train = (own_fold >= 0) & (own_fold != TEST_FOLD)
            total = np.bincount(local, train, len(words))
            kept = np.bincount(local, train & (own_fold != WEIGHT_FOLD), len(words))
            known = rows.column(0).is_valid()
            path = _write(folder, f"unit-{unit}", pack(np.asarray(rows.column(0).fill_null(0), "<i8"), np.asarray(known).astype("u1"), fold.astype("<i4"), _narrow(n_words + 1), _narrow(local), words))
            yield rows_of(_ROWS, kind=[HEAD], part=[unit % n_parts], unit=[unit], path=[path])
            sent = list(_blocks(words, n_parts, _narrow(total), _narrow(kept)))
            yield rows_of(_ROWS, kind=[BLOCK] * len(sent), part=[p for p, _ in sent], unit=[unit] * len(sent), payload=[b for _, b in sent])
            unit += 1

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS, F.lit(-1)).cast("int").alias("fold"), "text")
    return rows.mapInArrow(run, _SQL)


def _sums_of(keys: list[np.ndarray], *columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[int]]:
    """For blocks of one partition: the place of each entry among distinct keys, sums by key, and cuts between blocks."""
    at = np.concatenate([[0], np.cumsum(list(map(len, keys)))]).tolist()
    everything = np.concatenate(keys)
    order = np.argsort(everything, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = everything[order][1:] != everything[order][:-1]
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    n = int(new.sum())
    return place, [np.bincount(place, np.concatenate(c), n).astype(np.int64) for c in columns], at


def _count_words(sent: DataFrame, n_parts: int) -> DataFrame:
    """HEAD rows as they are, ANSWER rows (corpus counts of a unit's words), and SUMS rows (tokens and types of a partition)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, keys, totals, kepts = [], [], [], []
        for batch in batches:
            is_block = np.asarray(batch.column(0)) == BLOCK
            if not is_block.all():
                yield batch.filter(pa.array(~is_block))
            own = batch.filter(pa.array(is_block))
            for part, unit, raw in zip(*(own.column(i).to_pylist() for i in (1, 2, 7))):
                heads.append((part, unit))
                key, total, kept = _unblock(raw, "<u4", "<u4")
                keys.append(key)
                totals.append(total)
                kepts.append(kept)
        if not heads:
            return
        place, (total, kept), at = _sums_of(keys, totals, kepts)
        t, k = total[place], kept[place]
        yield rows_of(_ROWS, kind=[ANSWER] * len(heads), part=[p for p, _ in heads], unit=[u for _, u in heads], payload=[pack(_wide(t[a:b]), _wide(k[a:b])) for a, b in zip(at, at[1:])])
        yield rows_of(_ROWS, kind=[SUMS], part=[heads[0][0]], unit=[-1], total=[int(total.sum())], kept=[int(kept.sum())], types=[int((total > 0).sum())])

    return sent.repartitionById(n_parts, "part").mapInArrow(run, _SQL)


class _Unit:
    """A unit's tokens with the corpus counts of its words, and its bigrams."""

    def __init__(self, raw: bytes, n_parts: int) -> None:
        self.ids, self.known, self.fold, self.n_tokens, self.local, self.words = unpack(raw, "<i8", "u1", "<i4", "<u4", "<u4", "<u8")
        self.total, self.kept = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), np.int64)
        self._order, self._at, _ = by_partition(self.words, n_parts)
        self.n_parts = n_parts

    def answer(self, part: int, raw: bytes) -> None:
        own = self._order[self._at[part] : self._at[part + 1]]
        self.total[own], self.kept[own] = map(_counts, unpack(raw, "u1", "u1"))

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys; by token: the bigram's place and its context's place (the number of words: START); first tokens' flags."""
        first = np.zeros(len(self.local), bool)
        first[np.cumsum(self.n_tokens) - self.n_tokens] = True
        context = np.empty(len(self.local), np.int64)
        context[1:] = self.local[:-1]
        context[first] = len(self.words)
        names = np.append(self.words, START)
        full = mixed(names[context] * U64(0x9E3779B97F4A7C15) + self.words[self.local])
        keys, place = np.unique(full, return_inverse=True)
        return keys, place, context, first


def _by_unit(batches: Iterator[pa.RecordBatch], n_parts: int) -> Iterator[tuple[int, str, _Unit, list[tuple[int, bytes]]]]:
    """Units with their answers, from rows sorted by unit, kind and partition."""
    unit, path, answers = None, None, []
    for batch in batches:
        for kind, part, of, where, raw in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 7))):
            if of != unit:
                if unit is not None:
                    yield unit, path, _Unit(_read(path), n_parts), answers
                unit, path, answers = of, None, []
            if kind == HEAD:
                path = where
            else:
                answers.append((part, raw))
    if unit is not None:
        yield unit, path, _Unit(_read(path), n_parts), answers


def _send_bigrams(answered: DataFrame, folder: str, n_parts: int) -> DataFrame:
    """HEAD rows (now with the file of word counts) and BLOCK rows: bigrams with training counts, and for those of
    the weight fold the kept counts of context and word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, path, unit, answers in _by_unit(batches, n_parts):
            for part, raw in answers:
                unit.answer(part, raw)
            keys, place, context, _ = unit.bigrams()
            fold = np.repeat(unit.fold, unit.n_tokens)
            train = (fold >= 0) & (fold != TEST_FOLD)
            total = np.bincount(place, train, len(keys))
            fitted = np.bincount(place, fold == WEIGHT_FOLD, len(keys))
            one = np.empty(len(keys), np.int64)  # a token of each bigram
            one[place] = np.arange(len(place))
            end = np.searchsorted(unit.words, END)
            of_context = np.append(unit.kept, unit.kept[end])  # texts begin as often as they end
            use = fitted > 0
            c_context, c_word = of_context[context[one]], unit.kept[unit.local[one]]
            counts = _write(folder, f"counts-{number}", pack(_wide(unit.total)))
            yield rows_of(_ROWS, kind=[HEAD], part=[number % n_parts], unit=[number], path=[f"{path}\n{counts}"])
            sent = list(_blocks(keys, n_parts, _narrow(total), _narrow(fitted), only=(use, c_context, c_word)))
            yield rows_of(_ROWS, kind=[BLOCK] * len(sent), part=[p for p, _ in sent], unit=[number] * len(sent), payload=[b for _, b in sent])

    return answered.where(f"kind IN ({HEAD}, {ANSWER})").repartition(n_parts, "unit").sortWithinPartitions("unit", "kind", "part").mapInArrow(run, _SQL)


def _count_bigrams(sent: DataFrame, n_parts: int) -> DataFrame:
    """HEAD rows, ANSWER rows (corpus counts of a unit's bigrams), and SUMS rows: what the weights are fitted to.

    In SUMS rows, part is the bucket of the context's count, unit, total and types are the kept counts of bigram,
    context and word, and kept is how many held-out tokens have these. Where the bigram's is 0, the context's only
    matters by its bucket and is written as 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, blocks = [], []
        for batch in batches:
            is_block = np.asarray(batch.column(0)) == BLOCK
            if not is_block.all():
                yield batch.filter(pa.array(~is_block))
            own = batch.filter(pa.array(is_block))
            for part, unit, raw in zip(*(own.column(i).to_pylist() for i in (1, 2, 7))):
                heads.append((part, unit))
                *columns, context, word = _unblock(raw, "<u4", "<u4", "u1", "u1")
                blocks.append((*columns, _counts(context), _counts(word)))
        if not heads:
            return
        columns = [list(c) for c in zip(*blocks)]
        place, (total, fitted), at = _sums_of(columns[0], columns[1], columns[2])
        t = total[place]
        yield rows_of(_ROWS, kind=[ANSWER] * len(heads), part=[p for p, _ in heads], unit=[u for _, u in heads], payload=[pack(_wide(t[a:b])) for a, b in zip(at, at[1:])])
        weight, context, word = (np.concatenate(c).astype(np.int64) for c in columns[2:])
        use = np.flatnonzero(weight)
        if len(use) == 0:
            return
        weight, kept = weight[use], (total - fitted)[place[use]]  # context and word are of these alone
        cells = np.stack([bucket(context), kept, np.where(kept > 0, context, 0), word])
        order = np.lexsort(cells)
        cells = cells[:, order]
        new = np.append(True, (cells[:, 1:] != cells[:, :-1]).any(0))
        sums = np.add.reduceat(weight[order], np.flatnonzero(new))
        of, bigram, context, word = cells[:, new]
        yield rows_of(_ROWS, kind=[SUMS] * len(of), part=of, unit=bigram, total=context, types=word, kept=sums)

    return sent.repartitionById(n_parts, "part").mapInArrow(run, _SQL)


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the power of two below its count."""
    return np.where(context > 0, np.frexp(np.maximum(context, 1).astype(np.float64))[1], 0).astype(np.int64)


def fit_weights(cells: DataFrame, n_kept: int, n_types: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights (bigram, word, floor) by bucket, from cells (bucket, bigram, context, word, tokens) of held-out tokens.

    Expectation-maximisation until no weight moves by 1e-5, or `rounds` steps; a hundredth of a token for each part
    keeps weights above 0. A bucket without tokens has the weights of the nearest one below that has some, or the
    start's; contexts never seen have no bigram.
    """
    weights = np.tile(np.array(START_WEIGHTS), (BUCKETS, 1))
    seen: set[int] = set()
    for _ in range(rounds):
        of = lambda i: f"array({', '.join(f'{float(w)!r}D' for w in weights[:, i])})[bucket]"
        split = cells.selectExpr("bucket", "tokens", f"{of(0)} * bigram / greatest(context, 1L) AS p0", f"{of(1)} * word / {max(n_kept, 1)} AS p1", f"{of(2)} / {n_types + 1} AS p2")
        sums = split.groupBy("bucket").agg(*[F.expr(f"sum(tokens * p{i} / (p0 + p1 + p2)) AS s{i}") for i in range(3)]).collect()
        new = weights.copy()
        for r in sums:  # a row a bucket
            own = np.array([r[f"s{i}"] for i in range(3)]) + 0.01
            new[r["bucket"]] = own / own.sum()
            seen.add(r["bucket"])
        moved, weights = np.abs(new - weights).max(), new
        if moved < 1e-5:
            break
    last = np.array(START_WEIGHTS)
    for b in range(BUCKETS):
        last = weights[b] if b in seen else last
        weights[b] = last if b else [0.0, *(last[1:] / last[1:].sum())]
    return weights


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, token_score for every row of docs (doc_id, text).

    Scores are log10 probabilities of the whole text with its end; token_score is score by token, for comparing texts of
    different lengths. Null text is empty: its only token is the end.
    Rows with a null doc_id are scored, but not learned from, and not held out. Repeated rows count as often as
    they come. Without training tokens every score is that of the uniform floor. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    n_parts, folder = input_partitions(docs), new_folder(spark, "lm-units")
    words = staged(_count_words(_send_words(docs, folder, n_parts), n_parts), "lm-words")
    sums = words.where(f"kind = {SUMS}").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "kept", "types"))).first()
    n, n_kept, types = sums["total"], sums["kept"], sums["types"]
    counted = staged(_count_bigrams(_send_bigrams(words, folder, n_parts), n_parts), "lm-bigrams", partition_by="kind").select(*dict(_ROWS))
    cells = counted.where(f"kind = {SUMS}").groupBy(F.col("part").alias("bucket"), F.col("unit").alias("bigram"), F.col("total").alias("context"), F.col("types").alias("word"))
    weights = fit_weights(staged(cells.agg(F.sum("kept").alias("tokens")), "lm-cells"), n_kept, types)
    floor = 1 / (types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, paths, answers = None, None, []

        def done() -> pa.RecordBatch:
            tokens, counts = paths.split("\n")
            u = _Unit(_read(tokens), n_parts)
            (total,) = (_counts(x).astype(np.float64) for x in unpack(_read(counts), "u1"))
            keys, place, context, _ = u.bigrams()
            order, at, _ = by_partition(keys, n_parts)
            pair = np.zeros(len(keys))
            for part, raw in answers:
                pair[order[at[part] : at[part + 1]]] = _counts(unpack(raw, "u1")[0])
            c_context = np.append(total, total[np.searchsorted(u.words, END)])[context]
            c_word = total[u.local]
            lam = weights[bucket(c_context)]
            p = lam[:, 0] * pair[place] / np.maximum(c_context, 1) + lam[:, 1] * c_word / max(n, 1) + lam[:, 2] * floor
            doc = np.repeat(np.arange(len(u.ids)), u.n_tokens)
            m = len(u.ids)
            base = np.bincount(doc, np.log10((c_word + 1) / (n + types + 1)), m)
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(u.ids, _I, mask=u.known == 0),
                    "held_out": u.fold == TEST_FOLD,
                    "n_tokens": u.n_tokens.astype(np.int64),
                    "n_known": np.bincount(doc, c_word > 0, m).astype(np.int64),
                    "train_tokens": np.full(m, n, np.int64),
                    "base_score": base,
                    "score": (total_score := np.bincount(doc, np.log10(p), m)),
                    "token_score": total_score / u.n_tokens,
                }
            )

        for batch in batches:
            for kind, part, of, where, raw in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 7))):
                if of != unit:
                    if unit is not None:
                        yield done()
                    unit, paths, answers = of, None, []
                if kind == HEAD:
                    paths = where
                else:
                    answers.append((part, raw))
        if unit is not None:
            yield done()

    dealt = counted.where(f"kind IN ({HEAD}, {ANSWER})").repartition(n_parts, "unit").sortWithinPartitions("unit", "kind", "part")
    return dealt.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, token_score double")
