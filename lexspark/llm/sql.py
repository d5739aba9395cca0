"""DuckDB SQL for the rows of those queries that SQL can express."""

from __future__ import annotations

from lexspark.llm.secret_scan import BASE_RULES, RULES, Rule

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _rule(order: int, rule: Rule) -> str:
    """doc_id, ord, kind, s, e of a rule's matches, from what lies between them."""
    pattern, size = _quoted(rule.scan or rule.pattern), "lambda x: length(x)"
    return f"""SELECT doc_id, {order} AS ord, '{rule.kind}' AS kind,
      list_sum(list_transform(b[1:k], {size})) + coalesce(list_sum(list_transform(m[1:k - 1], {size})), 0) AS s, s + length(m[k]) AS e
      FROM (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM (
        SELECT doc_id, regexp_extract_all(text, {pattern}) AS m, regexp_extract_all(text, {pattern}, {rule.group}) AS g, string_split_regex(text, {pattern}) AS b FROM documents))
      WHERE length(g[k]) >= {rule.least_chars if rule.group else 0}"""


_SHOWN = "string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, ord)"
_COUNTS = ", ".join(f"count(*) FILTER (ord = {i}) AS n_{r.kind}" for i, r in enumerate(BASE_RULES))
OP3 = f"""WITH f AS ({' UNION ALL '.join(_rule(i, r) for i, r in enumerate(RULES))}),
    g AS (SELECT doc_id, {_COUNTS}, {_SHOWN} FILTER (ord < {len(BASE_RULES)}) AS base, {_SHOWN} AS spans FROM f GROUP BY 1)
    SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE_RULES)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN g USING (doc_id)"""

OP4 = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS sh FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.other FROM r JOIN l ON l.a = r.doc_id)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY 1"""

OP7 = f"""WITH s AS (SELECT doc_id, source, len({_WORDS}) AS size,
      ('0x' || substr(md5('0|' || coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || coalesce(source, '~') || '|' || coalesce(text, '~')), 1, 15))::BIGINT AS key FROM documents),
    t AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY 1),
    w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, (3 * source_size)::DOUBLE AS most FROM t),
    v AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
    g AS (SELECT source, source_size, least(most, coalesce(max(CASE WHEN level * weight < most THEN level END) OVER () * weight, most)) AS target FROM v),
    b AS (SELECT s.*, source_size, target, round(target)::BIGINT AS budget, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source),
    e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b)
    SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken FROM e"""

_SAID = r"'\### Assistant: </turn> ok'"
_MORE = r"(length(text) - length(replace(text, '\', ''))) + (length(text) - length(replace(text, '###', ''))) // 3 + (length(text) - length(replace(text, '</turn>', ''))) // 7"
OP9 = f"""WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', {_SAID}), (-7, 1, 'assistant', {_SAID})))
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum(length('### ' || role || ': ' || text || '</turn>') + 1 + {_MORE})::BIGINT AS formatted_chars,
      regexp_full_match(string_agg(substr(role, 1, 1), '' ORDER BY turn, role, text), 's?(ua)+') AS order_ok
    FROM t GROUP BY 1"""
