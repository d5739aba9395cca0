"""Ranked full-text search: tokens, postings, a MATCH query language and BM25.

Queries: words (all must match), OR, AND, NOT, parentheses, "phrases", prefix*, column:word.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.operators.temporal import in_force
from lexspark.staging import staged

K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
COLUMNS = ("titolo", "text")


def _marked() -> tuple[str, str]:
    """Letters of the first planes that are a plain letter with marks, and these letters; from the character database."""
    found = {}
    for point in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)):
        letter = unicodedata.normalize("NFD", chr(point).lower())
        if len(letter) > 1 and letter[0].isalpha() and all(unicodedata.category(c) == "Mn" for c in letter[1:]):
            found[chr(point).lower()] = unicodedata.normalize("NFKD", letter[0])[0]
    one = {k: v for k, v in found.items() if len(k) == 1}
    return "".join(one), "".join(one.values())


#: Letters with marks and the plain letters that they match.
MARKED, PLAIN = _marked()


class MatchError(ValueError):
    """A query that is no MATCH expression."""


def tokens(text: Column) -> Column:
    """Runs of letters and digits in lower case without marks."""
    folded = F.translate(F.lower(F.coalesce(text, F.lit(""))), MARKED, PLAIN)
    return F.filter(F.split(folded, r"[^\p{L}\p{N}\p{Co}]+"), lambda t: t != "")


def fold(word: str) -> str:
    return word.lower().translate(str.maketrans(MARKED, PLAIN))


@dataclass(frozen=True)
class Phrase:
    words: tuple[str, ...]
    prefix: bool = False
    column: str | None = None


def _wanted(term: Column, phrases: list[Phrase]) -> Column:
    """Whether a term is a word of the phrases, or begins with a prefix of theirs."""
    whole = sorted({w for p in phrases for w in p.words[: len(p.words) - p.prefix]})
    begun = sorted({p.words[-1] for p in phrases if p.prefix})
    return reduce(Column.__or__, [*([term.isin(whole)] if whole else []), *(F.startswith(term, F.lit(w)) for w in begun)])


def postings(documents: DataFrame, key: str = "urn", columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """key, col, term, positions, n_tokens (of all columns together)."""
    sized = documents.select(key, *[tokens(F.col(c)).alias(c) for c in columns]).withColumn("n_tokens", sum((F.size(c) for c in columns), F.lit(0)).cast("int"))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("list")) for c in columns])).alias("e")
    spread = sized.select(key, "n_tokens", each).select(key, "n_tokens", "e.col", F.posexplode("e.list").alias("pos", "term"))
    return spread.groupBy(key, "col", "term").agg(F.array_sort(F.collect_list("pos")).alias("positions"), F.first("n_tokens").alias("n_tokens"))


_LEX = re.compile(r'\s*(?:(?P<open>\()|(?P<close>\))|(?:(?P<col>\w+)\s*:\s*)?(?:"(?P<phrase>(?:[^"]|"")*)"|(?P<word>[\w]+))(?P<star>\s*\*)?)')


def parse_match(query: str) -> tuple:
    """A tree of ('and' | 'or' | 'not', left, right) and Phrase leaves; words side by side are joined by and."""
    items: list = []
    at = 0
    while at < len(query.rstrip()):
        m = _LEX.match(query, at)
        if not m:
            raise MatchError(f"syntax error near {query[at:at + 10]!r}")
        at = m.end()
        if m["open"] or m["close"]:
            items.append(m[0].strip())
        elif m["word"] in ("AND", "OR", "NOT") and not m["col"] and not m["star"]:
            items.append(m["word"])
        else:
            words = tuple(re.findall(r"[^\W_]+", fold((m["phrase"] or "").replace('""', '"') if m["word"] is None else m["word"])))
            if m["col"] and m["col"] not in COLUMNS:
                raise MatchError(f"no such column: {m['col']}")
            items.append(Phrase(words, bool(m["star"]), m["col"]))
    place = 0

    def peek():
        return items[place] if place < len(items) else None

    def leaf():
        nonlocal place
        item = peek()
        place += 1
        if item == "(":
            inner = either()
            if peek() != ")":
                raise MatchError("missing )")
            place += 1
            return inner
        if not isinstance(item, Phrase) or not item.words:
            raise MatchError("syntax error")
        return item

    def chain(below, name, word):
        def level():
            nonlocal place
            left = below()
            while peek() == word or (word == "AND" and (isinstance(peek(), Phrase) or peek() == "(")):
                place += peek() == word
                left = (name, left, below())
            return left

        return level

    either = chain(chain(chain(leaf, "not", "NOT"), "and", "AND"), "or", "OR")
    if not items:
        raise MatchError("empty query")
    tree = either()
    if place < len(items):
        raise MatchError("syntax error")
    return tree


def leaves(tree) -> list[Phrase]:
    return [tree] if isinstance(tree, Phrase) else [*leaves(tree[1]), *leaves(tree[2])]


def _hits(index: DataFrame, phrase: Phrase, key: str) -> DataFrame:
    """key, tf, n_tokens: how often a phrase comes in each document."""
    own = index.where(F.col("col") == phrase.column) if phrase.column else index
    last = len(phrase.words) - 1
    start = None
    for i, word in enumerate(phrase.words):
        term = F.startswith("term", F.lit(word)) if phrase.prefix and i == last else F.col("term") == word
        here = own.where(term).select(key, "col", "n_tokens", F.explode("positions").alias("pos")).select(key, "col", "n_tokens", (F.col("pos") - i).alias("pos"))
        start = here if start is None else start.join(here.select(key, "col", "pos"), [key, "col", "pos"])
    return start.groupBy(key).agg(F.count(F.lit(1)).alias("tf"), F.first("n_tokens").alias("n_tokens"))


def _occurrences(tokens_: Column, phrase: Phrase) -> Column:
    """How often a phrase comes in a list of tokens."""
    last = len(phrase.words) - 1
    fits = lambda token, i: F.startswith(token, F.lit(phrase.words[i])) if phrase.prefix and i == last else token == phrase.words[i]
    return F.size(F.filter(tokens_, lambda t, at: reduce(Column.__and__, (F.coalesce(fits(t if i == 0 else F.get(tokens_, at + i), i), F.lit(False)) for i in range(last + 1)))))


def _scanned(documents: DataFrame, phrases: list[Phrase], key: str) -> DataFrame:
    """key, n_tokens, tfs (of each phrase) of every document: one pass, staged, without postings."""
    lists = documents.select(key, *[tokens(F.col(c)).alias(f"t_{c}") for c in COLUMNS])
    tfs = [sum((_occurrences(F.col(f"t_{c}"), p) for c in ([p.column] if p.column else COLUMNS)), F.lit(0)) for p in phrases]
    return staged(lists.select(key, sum((F.size(f"t_{c}") for c in COLUMNS), F.lit(0)).alias("n_tokens"), F.array(*tfs).alias("tfs")), "search")


def totals(documents: DataFrame) -> DataFrame:
    """One row: n_docs, avg_tokens."""
    return documents.agg(F.count(F.lit(1)).alias("n_docs"), F.avg(sum((F.size(tokens(F.col(c))) for c in COLUMNS), F.lit(0))).alias("avg_tokens"))


def search(documents: DataFrame, query: str, limit: int | None = 20, day: str | None = None, key: str = "urn", index: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """The best documents with score, lower being better, ties by key; limit None: all. day: only those in force then.

    index, counts: stored tables of postings() and totals(); else all documents are read once, for what the query asks.
    """
    tree = parse_match(query)
    phrases = list(dict.fromkeys(leaves(tree)))
    if index is None:
        seen = _scanned(documents, phrases, key)
        counts = seen.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("n_tokens").alias("avg_tokens"))
        hits = seen.select(key, "n_tokens", F.posexplode("tfs").alias("phrase", "tf")).where("tf > 0")
    else:
        counts = totals(documents) if counts is None else counts
        index = index.where(_wanted(F.col("term"), phrases))
        hits = reduce(DataFrame.unionByName, (_hits(index, p, key).withColumn("phrase", F.lit(i)) for i, p in enumerate(phrases)))
    df = hits.groupBy("phrase").agg(F.count(F.lit(1)).alias("df"))
    idf = F.ln((F.col("n_docs") - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    tf = F.col("tf").cast("double")
    norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("n_tokens") / F.col("avg_tokens"))
    part = F.when(idf > 0, idf).otherwise(F.lit(LEAST_IDF)) * tf * F.lit(K1 + 1) / (tf + norm)
    scored = hits.join(F.broadcast(df), "phrase").crossJoin(F.broadcast(counts)).groupBy(key).agg((-F.sum(part)).alias("score"), F.collect_set("phrase").alias("found"))  # a row a phrase, and one row

    def holds(node) -> Column:
        if isinstance(node, Phrase):
            return F.array_contains("found", phrases.index(node))
        left, right = holds(node[1]), holds(node[2])
        return left & right if node[0] == "and" else left | right if node[0] == "or" else left & ~right

    kept = scored.where(holds(tree)).drop("found")
    if day:
        kept = kept.join(documents.where(in_force(day)).select(key), key, "left_semi")
    if limit is None:
        return kept.join(documents, key)
    best = kept.orderBy("score", key).limit(limit)  # before documents are read
    return best.join(documents, key).orderBy("score", key)
