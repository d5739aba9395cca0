"""Quality rules as weak supervision, with DataFrame functions only.

Rules vote good or bad or abstain. Documents are counted by their votes (at most 3 ** rules patterns); from
these counts over all documents, expectation-maximisation estimates how often each rule votes bad on bad and
on good documents and the share of bad ones; each document is then kept by its posterior probability of being
good, so one unsure rule does not reject a document that the others vouch for.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import SPACE_CLASS, WORD_RE, staged

WINDOW = 5

#: Frequent short words of running text in English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to a in is that was for it with as be on by at from this are "
    "de la le les des et un une du en que qui dans pour sur par pas est au il "
    "der die das und ist zu den von mit ein eine auf im nicht als auch es an dem sich "
    "el los las y del por con una su para no se al lo como más o"
).split()


def _repeat_words() -> Column:
    """Words in windows of 5 that come twice or more: runs of equal window hashes, then the union of their places."""
    return F.expr(
        f"""CASE WHEN size(windows) = size(array_distinct(windows)) THEN 0 ELSE
        aggregate(
          transform(array(sort_array(transform(windows, (h, i) -> named_struct('h', h, 'i', i)))), s ->
            sort_array(transform(filter(s, (p, k) -> (k > 0 AND try_element_at(s, k).h = p.h) OR (k + 1 < size(s) AND try_element_at(s, k + 2).h = p.h)), p -> p.i)))[0],
          named_struct('last', -{WINDOW}, 'n', 0),
          (a, p) -> named_struct('last', p, 'n', a.n + least({WINDOW}, p - a.last)),
          a -> a.n) END"""
    ).cast("long")


def features(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts of each whole text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and what rules need.

    A null text has no words and all counts 0, as an empty one. Windows of five words are compared by 64-bit
    hashes. Rows stay one for one; `keep` names the columns to keep.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    one = docs.select(*keep, body.alias("__text"), F.regexp_extract_all(body, F.lit(WORD_RE), F.lit(0)).alias("words"))
    window = ", ".join(f"words[i + {k}]" for k in range(WINDOW))
    two = one.select(
        *keep,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("__text", F.lit(r"[#*$%&|<>]+")).cast("long").alias("n_marks"),
        F.regexp_count("__text", F.lit(r"[A-ZÀ-ÖØ-Þ]")).cast("long").alias("n_upper"),
        F.regexp_count("__text", F.lit(r"!")).cast("long").alias("n_exclaim"),
        F.regexp_count("__text", F.lit(r"[0-9]")).cast("long").alias("n_digits"),
        F.expr(f"filter(split(__text, '\\n'), l -> l rlike '[^{SPACE_CLASS}]')".replace("\\x", "\\\\x")).alias("lines"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size(F.array_intersect("words", F.array(*map(F.lit, FUNCTION_WORDS)))).alias("n_function"),
        F.expr(f"CASE WHEN size(words) < {WINDOW} THEN array() ELSE transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({window})) END").alias("windows"),
    )
    return two.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words().alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        "n_marks",
        "n_upper",
        "n_exclaim",
        "n_digits",
        "n_function",
        "n_distinct",
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Votes bad where `bad` holds, else good where `good` holds; abstains otherwise."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), F.lit(0)).when(F.expr(self.good), F.lit(1)).otherwise(F.lit(2))


#: Each can vote either way on documents that the base leaves; what the base tests alone is no rule.
RULES = (
    Rule("symbols", "n_symbols > 0.15 * n_words", "n_symbols <= 0.05 * n_words"),
    Rule("marks", "n_marks > 0.1 * n_words", "n_marks <= 0.03 * n_words"),
    Rule("lines", "n_dup_lines > 0.3 * n_lines", "n_dup_lines <= 0.1 * n_lines"),
    Rule("repeats", "n_repeat_words > 0.12 * n_words", "n_repeat_words <= 0.03 * n_words"),
    Rule("capitals", "n_upper > 0.4 * word_chars", "n_upper <= 0.2 * word_chars"),
    Rule("shouting", "n_exclaim > 0.2 * n_words", "n_exclaim <= 0.05 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    Rule("variety", "n_distinct <= 0.5 * n_words AND n_words <= 60", "n_distinct > 0.6 * n_words"),
    Rule("digits", "n_digits > 0.3 * word_chars", "n_digits <= 0.1 * word_chars"),
    Rule("function_words", "n_words >= 40 AND n_function = 0", "n_function >= 2"),
)


@dataclass(frozen=True)
class Accuracies:
    """bad_share: of all documents; on_bad, on_good: how often each rule, if it votes, votes bad on either kind."""

    bad_share: float
    on_bad: tuple[float, ...]
    on_good: tuple[float, ...]


#: What EM starts from: the share of bad documents, and how often a rule votes bad on bad and on good ones. Each
#: kind of junk concerns few rules, so even on bad documents most votes are good.
START = Accuracies(0.15, (0.2,) * len(RULES), (0.002,) * len(RULES))
#: The start counts as so many votes for each vote seen (at least two), whatever the size of the input.
START_WEIGHT = 0.05


def estimate(patterns: list[tuple[tuple[int, ...], int]], start: Accuracies = START, rounds: int = 200) -> Accuracies:
    """Expectation-maximisation over counts of vote patterns (0 bad, 1 good, 2 abstains), to a fixed point or `rounds`.

    Good and bad keep their meaning by the start alone, which is also the prior of every estimate: bad documents
    as START has them cast START_WEIGHT times the votes of all documents. No estimate is cut off. Without patterns
    the start is returned.
    """
    rules = len(patterns[0][0]) if patterns else len(start.on_bad)
    now = Accuracies(start.bad_share, start.on_bad[:rules], start.on_good[:rules])
    total = sum(n for _, n in patterns)
    weight = max(2.0, START_WEIGHT * total)
    for _ in range(rounds if patterns else 0):
        bad_n = 0.0
        cast = [[[0.0, 0.0], [0.0, 0.0]] for _ in range(rules)]  # by rule: [all votes, bad votes] of bad and of good documents
        for pattern, n in patterns:
            b, g = now.bad_share, 1 - now.bad_share
            for r, v in enumerate(pattern):
                if v != 2:
                    b *= now.on_bad[r] if v == 0 else 1 - now.on_bad[r]
                    g *= now.on_good[r] if v == 0 else 1 - now.on_good[r]
            p = b / (b + g)
            bad_n += n * p
            for r, v in enumerate(pattern):
                if v != 2:
                    for kind, share in zip(cast[r], (n * p, n * (1 - p))):
                        kind[0] += share
                        kind[1] += share * (v == 0)
        of_bad, of_good = weight * start.bad_share, weight * (1 - start.bad_share)
        new = Accuracies(
            (bad_n + of_bad) / (total + weight),
            tuple((c[0][1] + of_bad * s) / (c[0][0] + of_bad) for c, s in zip(cast, start.on_bad)),
            tuple((c[1][1] + of_good * s) / (c[1][0] + of_good) for c, s in zip(cast, start.on_good)),
        )
        step = max(abs(x - y) for x, y in zip((new.bad_share, *new.on_bad, *new.on_good), (now.bad_share, *now.on_bad, *now.on_good)))
        now = new
        if step < 1e-9:
            break
    return now


def p_good(found: Accuracies) -> Column:
    """Posterior probability of a good document, from the vote columns."""
    odds = F.lit(math.log((1 - found.bad_share) / found.bad_share))
    for r, rule in enumerate(RULES):
        vote = F.col(f"v_{rule.name}")
        bad, good = math.log(found.on_good[r] / found.on_bad[r]), math.log((1 - found.on_good[r]) / (1 - found.on_bad[r]))
        odds = odds + F.when(vote == 0, F.lit(bad)).when(vote == 1, F.lit(good)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least: float = 0.5) -> DataFrame:
    """features() with base_failed, p_good (double) and kept (boolean) for every row.

    kept is false if the base fails, else whether p_good is at least `least`. An empty table gives an empty one;
    repeated rows are judged alike. Counts are staged once in the shared folder, then all documents that
    the base leaves are counted by votes.
    """
    votes = [f"v_{r.name}" for r in RULES]
    rows = staged(features(docs, text, keep), "quality-features").withColumns({v: r.vote() for v, r in zip(votes, RULES)})
    counted = rows.where(~base_failed()).groupBy(*votes).count().collect()  # at most 3 ** len(RULES) rows
    found = estimate([(tuple(r[v] for v in votes), r["count"]) for r in sorted(counted)])
    judged = rows.withColumn("base_failed", base_failed()).withColumn("p_good", p_good(found))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least)).drop(*votes)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with their columns as they are.

    Rows are matched by a hash of doc_id and text, which repeated rows share along with the verdict.
    """
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    verdicts = judge(keyed, keep=("__row",)).where("kept").select("__row").distinct()
    return keyed.join(verdicts, "__row", "left_semi").drop("__row")
