"""Language identification with word-first backoff.

A text's words are scored by their log frequency in each language; a word that no language has is scored by
its longest known character n-grams instead, from five characters down to one. The model is fitted on about
`sample_rows` labelled texts of each language, taken by hash, so its size is bounded whatever the input is.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import LOWER, U64, mixed, span_hashes, text_chunks, word_spans

SAMPLE_ROWS = 1500
LONGEST = 5
SMOOTHING = 0.5
UNKNOWN = "und"

#: Letters of ASCII in lower case and all bytes of other code points stay; every other byte ends a word.
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_GRAM_STEPS = mixed(np.arange(1, LONGEST + 1, dtype=U64)) | U64(1)


def bucket_of(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(-1)).cast("int")


def words_in(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, word starts and ends, words before each text, and word hashes."""
    folded = _LETTERS[buf]
    starts, ends, before = word_spans(folded, offs)
    return folded, starts, ends, before, span_hashes(folded, starts, ends)


def grams_in(words: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For n from LONGEST down to 1: n, and the word and hash of each character n-gram; words have a blank on each side."""
    points = np.frombuffer((b" " + b" ".join(words) + b" ").decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(U64)
    blank = points == 0x20
    word = np.cumsum(blank) - 1
    codes = mixed(points + U64(0x51ED27))
    for n in range(LONGEST, 0, -1):
        m = len(points) - n + 1
        if m <= 0:
            continue
        value = np.zeros(m, U64)
        inner = np.zeros(m, bool)
        for k in range(n):
            value += codes[k : k + m] * _GRAM_STEPS[k]
            if 0 < k < n - 1:
                inner |= blank[k : k + m]
        ok = ~inner & ~(blank[:m] & blank[n - 1 : n - 1 + m])
        of = word[:m].copy()
        yield n, of[ok], mixed(value[ok] + U64(n))


@dataclass(frozen=True)
class Model:
    """Sorted hashes of words and of n-grams by n, each with log frequencies by language."""

    languages: tuple[str, ...]
    words: tuple[np.ndarray, np.ndarray]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]


def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in the table, and the scores of those."""
    own, scores = table
    if len(own) == 0:
        return np.zeros(len(keys), bool), scores[:0]
    at = np.searchsorted(own, keys)
    at[at == len(own)] = 0
    hit = own[at] == keys
    return hit, scores[at[hit]]


def training_rows(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows to learn from: text and label not null, and an id whose bucket of 4 is neither 2 nor unknown."""
    bucket = bucket_of(F.col("doc_id"), 4)
    return docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (bucket != 2) & (bucket >= 0)).select("doc_id", F.col(lang).alias("lang"), F.col(text).alias("text"))


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Counts words and n-grams of about sample_rows rows of each language (all, if fewer), by hash of doc_id.

    Only counts of the sample come to the driver. Without labelled rows the model has no languages.
    """
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        none = (np.zeros(0, U64), np.zeros((0, 0), np.float32))
        return Model((), none, {})
    draw = F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30))
    limits = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1 << 30, -(-sample_rows * (1 << 30) // n)))])
    sample = labelled.where(draw < limits[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[str, int], dict[int, int]] = {}

        def add(lang: str, n: int, keys: np.ndarray, weights: np.ndarray | None = None) -> None:
            own, inverse = np.unique(keys, return_inverse=True)
            sums = np.bincount(inverse, weights, len(own)).astype(np.int64)
            have = totals.setdefault((lang, n), {})
            for k, v in zip(own.tolist(), sums.tolist()):
                have[k] = have.get(k, 0) + v

        for rows, buf, offs in text_chunks(batches):
            folded, starts, ends, before, hashes = words_in(buf, offs)
            labels = np.array(rows.column(0).to_pylist(), object)
            raw, label_of = folded.tobytes(), np.repeat(labels, np.diff(before))
            for lang in set(labels):
                mine = np.flatnonzero(label_of == lang)
                own, first, times = np.unique(hashes[mine], return_index=True, return_counts=True)
                add(lang, 0, hashes[mine])
                at = mine[first].tolist()
                if at:
                    for n, of, keys in grams_in([raw[starts[i] : ends[i]] for i in at]):
                        add(lang, n, keys, times[of])
        for (lang, n), have in totals.items():
            k = np.fromiter(have, U64, len(have)).view(np.int64)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(k), "n": pa.array([n] * len(k), pa.int32()), "key": k, "times": np.fromiter(have.values(), np.int64, len(k))})

    counted = sample.mapInArrow(count, "lang string, n int, key long, times long").groupBy("lang", "n", "key").agg(F.sum("times").alias("times"))
    table = counted.toArrow()
    lang = np.searchsorted(np.array(languages), np.array(table.column("lang").to_pylist(), dtype=object).astype(str)) if table.num_rows else np.zeros(0, np.int64)
    n, key, times = (np.asarray(table.column(c)) for c in ("n", "key", "times"))

    def scores(of: int) -> tuple[np.ndarray, np.ndarray]:
        mine = np.flatnonzero(n == of)
        own, inverse = np.unique(key[mine].view(U64), return_inverse=True)
        counts = np.full((len(own), len(languages)), SMOOTHING)
        np.add.at(counts, (inverse, lang[mine]), times[mine])
        return own, np.log(counts / counts.sum(0)).astype(np.float32) if len(own) else counts.astype(np.float32)

    return Model(languages, scores(0), {k: scores(k) for k in range(LONGEST, 0, -1)})


def word_scores(model: Model, hashes: np.ndarray, word_at) -> np.ndarray:
    """Scores by language of distinct words; word_at gives the bytes of the words at some places."""
    out = np.zeros((len(hashes), len(model.languages)), np.float64)
    hit, own = _found(model.words, hashes)
    out[hit] = own
    left = np.flatnonzero(~hit)
    if len(left) == 0:
        return out
    open_ = np.ones(len(left), bool)
    for n, of, keys in grams_in(word_at(left)):
        mine = np.flatnonzero(open_[of])
        known, own = _found(model.grams[n], keys[mine])
        of = of[mine][known]
        times = np.bincount(of, minlength=len(left))
        got = np.flatnonzero(times)
        for j in range(len(model.languages)):
            out[left[got], j] = np.bincount(of, own[:, j], len(left))[got] / times[got]
        open_[got] = False
        if not open_.any():
            break
    return out


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_unseen for every row of docs, from the text alone.

    score: the language's posterior probability, all languages being as likely before. A null text, one without
    letters, and any text under a model without languages are `und` with score 0. Of equals the first language
    by name is taken. held_out: bucket 2 of 4 by doc_id (false for a null id). n_unseen: words scored by n-grams.
    """
    languages = np.array([*model.languages, UNKNOWN], object)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample
    und = len(languages) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for rows, buf, offs in text_chunks(batches):
            folded, starts, ends, before, hashes = words_in(buf, offs)
            m, best, share, unseen = rows.num_rows, np.full(rows.num_rows, und), np.zeros(rows.num_rows), np.zeros(rows.num_rows, np.int64)
            if len(hashes) and und:
                words, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
                raw = folded.tobytes()
                scored = word_scores(own, words, lambda at: [raw[a:b] for a, b in zip(starts[first[at]].tolist(), ends[first[at]].tolist())])
                doc = np.repeat(np.arange(m), np.diff(before))
                total = np.stack([np.bincount(doc, scored[inverse, j], m) for j in range(und)], 1)
                unseen = np.bincount(doc, ~_found(own.words, words)[0][inverse], m).astype(np.int64)
                raw_text = buf.tobytes()
                some = np.bincount(np.repeat(np.arange(m), np.diff(offs)), ((folded >= 97) & (folded < 123)), m) > 0
                for i in np.flatnonzero(~some & (np.diff(before) > 0)).tolist():
                    some[i] = any(unicodedata.category(c)[0] == "L" for c in raw_text[offs[i] : offs[i + 1]].decode("utf-8", "replace"))
                odds = np.exp(total - total.max(1, keepdims=True))
                share = np.where(some, odds.max(1) / odds.sum(1), 0.0)
                best = np.where(some, total.argmax(1), und)
            yield pa.RecordBatch.from_pydict({"doc_id": rows.column(0), "held_out": rows.column(1), "lang_pred": pa.array(languages[best], pa.string()), "score": share, "n_unseen": unseen})

    held = (bucket_of(F.col("doc_id"), 4) == 2).alias("held_out")
    return docs.select(F.col("doc_id").cast("long"), held, F.col(text).alias("text")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, n_unseen long")
