"""Secret scans by a trigram inverted index, with DataFrame functions only.

From each rule's pattern a Boolean query over trigrams is derived (any of several sets that must all be there).
The index holds the postings of the trigrams in queries. It is partitioned by document, as a document's postings are
needed beside its text: they are a column, and the sets of a query are sought in it, so neither texts nor ids are
shuffled, however many candidates there are. Only candidates are tried with the rule's pattern. Rules without
mandatory trigrams scan all texts. postings() and candidates() give the same index as rows, for storing it.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: More alternatives than this make a query worth less than a scan.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """kind; pattern; least_chars of the group that counts (0: the match); base: found by the base rules too.

    scan: an equal but quicker pattern for the same matches that pass, where there is one.
    """

    kind: str
    pattern: str
    least_chars: int = 1
    group: int = 0
    scan: str | None = None


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + "|" + either_case("api") + "_?" + either_case("key")
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run too short stays too short from any later start, so the length may be part of these two patterns.
BASE_RULES = (
    Rule("assign", ASSIGN, 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18, 0, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]+", 16, 0, r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pay", r"sk_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Sets of lower-case trigrams, one of which is whole in every text with a match; None: nothing is mandatory.

    The parsed pattern is walked from left to right with the set of strings that its run of exact parts can
    spell. A part that spells too many ends the run; the best run, with the longest shortest string, is taken.
    """
    runs = [r for r in _runs(sre_parser.parse(pattern)) if r and min(map(len, r)) >= 3]
    if not runs:
        return None
    best = max(runs, key=lambda r: (min(map(len, r)), -len(r)))
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in best}
    return sorted((x for x in sets if not any(y < x for y in sets)), key=sorted)  # a set that holds another asks for more than is needed


def _runs(parsed) -> list[set[str]]:
    runs: list[set[str]] = [{""}]
    for op, value in parsed:
        exact, inner = _strings(op, value)
        if exact is not None and len(both := {a + b for a in runs[-1] for b in exact}) <= MOST_STRINGS:
            runs[-1] = both
        else:
            runs += [*inner, {""}]
    return runs


def _strings(op, value) -> tuple[set[str] | None, list[set[str]]]:
    """The strings that a part can spell, if few; else the runs inside it that are mandatory."""
    if op is sre.LITERAL:
        return {chr(value).lower()}, []
    if op is sre.IN:
        if all(k is sre.LITERAL for k, _ in value):
            return {chr(v).lower() for _, v in value}, []
        return None, []
    if op is sre.SUBPATTERN:
        return _whole(value[3])
    if op is sre.BRANCH:
        options = [_whole(p)[0] for p in value[1]]
        return (None, []) if any(o is None for o in options) else (set().union(*options), [])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, part = value
        exact, inner = _whole(part)
        if exact is not None and most <= 4:
            out: set[str] = set()
            power = {""}
            for k in range(most + 1):
                if k >= least:
                    out |= power
                power = {a + b for a in power for b in exact}
                if len(out) + len(power) > MOST_STRINGS:
                    return None, []
            return out, []
        return None, inner if least else []
    return None, []


def _whole(parsed) -> tuple[set[str] | None, list[set[str]]]:
    runs = _runs(parsed)
    return (runs[0], []) if len(runs) == 1 else (None, runs)


def _array(values) -> str:
    return f"array({', '.join(values)})"


def own_postings(text: str, trigrams: list[str]) -> Column:
    """A document's postings: the numbers of those trigrams that its text (a column) holds in lower case.

    What lambdas use again and again is bound to a variable of an outer one, so it is computed once a row.
    """
    grams = _array("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in trigrams)
    return F.expr(f"transform(array(lower({text})), f -> filter(sequence(0, {len(trigrams) - 1}), i -> contains(f, {grams}[i])))[0]")


def met_rules(postings: str, queries: list[tuple[int, frozenset[str]]], trigrams: list[str]) -> Column:
    """Numbers of the rules that have a set of trigrams whole in a column of postings."""
    of = {t: i for i, t in enumerate(trigrams)}
    sets = _array(f"named_struct('rule', {rule}, 'grams', {_array(str(of[g]) for g in sorted(grams))})" for rule, grams in queries)
    return F.expr(f"transform(array({postings}), own -> array_distinct(transform(filter({sets}, q -> size(array_except(q.grams, own)) = 0), q -> q.rule)))[0]")


def postings(docs: DataFrame, trigrams: list[str], text: str = "text") -> DataFrame:
    """The index as rows: (trigram, doc_id, text_hash), once a document; case is folded, trigrams are numbers of the list."""
    whole = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return whole.select("doc_id", "text_hash", F.explode(own_postings("__text", trigrams)).alias("trigram"))


def candidates(index: DataFrame, queries: list[tuple[int, frozenset[str]]], trigrams: list[str]) -> DataFrame:
    """doc_id, text_hash and `rules`, the numbers of the rules that the postings of the document meet; others are left out."""
    lists = index.groupBy("doc_id", "text_hash").agg(F.collect_set("trigram").alias("__own"))
    return lists.select("doc_id", "text_hash", met_rules("__own", queries, trigrams).alias("rules")).where("size(rules) > 0")


def _spans(rule: Rule, order: int, text: Column) -> Column:
    """Array of (start, end, kind, order) of a rule's matches: lengths of what lies between them and of them, added up."""
    pattern = rule.scan or rule.pattern
    quoted = lambda p: "r'" + p.replace("'", "\\x27") + "'"
    p, group = quoted(pattern), rule.group
    kept = f"length(g[k]) >= {rule.least_chars}" if group else "true"
    groups = f"regexp_extract_all(__text, {p}, {group})" if group else "array('')"
    return F.expr(
        f"""CASE WHEN __text rlike {p} THEN
        transform(array(named_struct('m', regexp_extract_all(__text, {p}, 0), 'b', split(__text, {p}, -1), 'g', {groups})), x ->
          filter(aggregate(sequence(0, size(x.m) - 1),
            named_struct('at', 0, 'out', cast(array() AS array<struct<start:int,`end`:int,ord:int,kind:string>>)),
            (a, k) -> named_struct('at', a.at + length(x.b[k]) + length(x.m[k]), 'out',
              CASE WHEN {kept.replace('g[k]', 'x.g[k]')} THEN concat(a.out, array(named_struct('start', a.at + length(x.b[k]), 'end', a.at + length(x.b[k]) + length(x.m[k]), 'ord', {order}, 'kind', '{rule.kind}'))) ELSE a.out END),
            a -> a.out), s -> s.start IS NOT NULL))[0]
        ELSE cast(array() AS array<struct<start:int,`end`:int,ord:int,kind:string>>) END"""
    )


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", into: str = "found") -> DataFrame:
    """docs with `into`: an array of (start, end, ord, kind) of all rules' matches, by start, then by the rules' order.

    Code points, end exclusive; matches of one rule do not overlap. Null text has none; null and repeated doc_ids are
    allowed, and rows stay as they are, without a shuffle. A column of that name is replaced.
    """
    queries = [(i, q) for i, r in enumerate(rules) for q in trigram_query(r.pattern) or []]
    indexed = {i for i, _ in queries}
    trigrams = sorted({g for _, q in queries for g in q})
    marked = docs.drop(into).withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    if trigrams:
        marked = marked.withColumn("__own", own_postings("__text", trigrams)).withColumn("__rules", met_rules("__own", queries, trigrams))
    none = "cast(array() AS array<struct<start:int,`end`:int,ord:int,kind:string>>)"
    each = []
    for i, rule in enumerate(rules):
        spans = _spans(rule, i, F.col("__text"))
        each.append(F.when(F.array_contains("__rules", i), spans).otherwise(F.expr(none)) if i in indexed else spans)
    return marked.withColumn(into, F.sort_array(F.concat(*each))).drop("__text", "__own", "__rules")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span of scan() replaced by mark (spans that overlap or touch as one), n_chars counted anew."""
    found = scan(docs, into="__found")
    cleaned = F.expr(
        f"""CASE WHEN size(__found) = 0 THEN text ELSE aggregate(__found, named_struct('at', 0, 'out', cast('' AS string)),
        (a, s) -> CASE WHEN s.start <= a.at AND a.at > 0 THEN named_struct('at', greatest(a.at, s.`end`), 'out', a.out)
          ELSE named_struct('at', s.`end`, 'out', concat(a.out, substring(text, a.at + 1, s.start - a.at), '{mark}')) END,
        a -> concat(a.out, substring(text, a.at + 1))) END"""
    )
    out = found.withColumn("text", cleaned).drop("__found")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
