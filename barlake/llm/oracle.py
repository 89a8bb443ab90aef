"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force in tests/llm."""

from __future__ import annotations

from barlake.llm import jaccard_join as j
from barlake.llm import quality_rules as q
from barlake.llm import sharding as s
from barlake.llm import source_audit as a
from barlake.llm import span_dedup as d
from barlake.llm import suffix_dedup as x
from barlake.llm import topk_search as k


def _sharding_sql() -> str:
    n, m = len(s.SHARDS), s.SIZE
    md5 = "('0x' || substr(md5({}), 1, 15))::BIGINT"
    return f"""
WITH RECURSIVE shards AS (
  SELECT i, {md5.format("'offset shard-' || lpad(i::VARCHAR, 3, '0')")} % {m} AS off,
         {md5.format("'skip shard-' || lpad(i::VARCHAR, 3, '0')")} % {m - 1} + 1 AS skip
  FROM range({n}) r(i)),
fill(turn, slot, tbl) AS (
  SELECT -1, -1::BIGINT, [-1 FOR x IN range({m})]
  UNION ALL
  SELECT turn + 1, free, list_transform(tbl, lambda x, k: CASE WHEN k = free + 1 THEN turn + 1 ELSE x END)
  FROM (SELECT turn, tbl, [(off + j * skip) % {m} FOR j IN range({m}) IF tbl[(off + j * skip) % {m} + 1] < 0][1] AS free
        FROM fill JOIN shards ON i = (turn + 1) % {n} WHERE turn < {m - 1})),
placed AS (SELECT slot, turn % {n} AS shard FROM fill WHERE turn >= 0),
docs AS (SELECT doc_id, ({md5.format("coalesce(doc_id::VARCHAR, '')")} % {m})::INTEGER AS slot FROM documents)
SELECT doc_id, docs.slot, shard::INTEGER AS shard FROM docs JOIN placed ON docs.slot = placed.slot"""


def _quality_sql() -> str:
    word = r"[^\x20\x09-\x0D]+"
    kinds = list(q.RATIOS)
    union = " UNION ALL ".join(
        f"SELECT lang, source, '{c}' AS feature, {c} AS v FROM ratios WHERE NOT base_failed" for c in kinds)
    percents = sorted({p for low, high, _ in q.RATIOS.values() for p in (low, high)})
    level = "SELECT {keys} feature, max(docs) AS docs, " + ", ".join(f"min(bucket) FILTER (upto >= (docs * {p} + 99) // 100) AS q{p}" for p in percents) + " FROM (" \
            "SELECT {keys} feature, bucket, sum(count(*)) OVER (PARTITION BY {part} ORDER BY bucket) AS upto, " \
            "sum(count(*)) OVER (PARTITION BY {part}) AS docs FROM buckets GROUP BY {keys} feature, bucket) GROUP BY {keys} feature"
    level = "SELECT *, CASE feature " + " ".join(f"WHEN '{c}' THEN q{high} + (q{high} - q{low}) // 2 + {slack}" for c, (low, high, slack) in q.RATIOS.items()) + " END AS fence FROM (" + level + ")"
    levels = ", ".join(f"l{n} AS (" + level.format(keys=k, part=k + "feature") + ")" for n, k in ((2, "lang, source, "), (1, "lang, "), (0, "")))
    fence = ", ".join(f"max(fence) FILTER (feature = '{c}') AS {c}_fence" for c in kinds)
    inside = " AND ".join(f"coalesce({c} <= {c}_fence, false)" for c in kinds)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
arrays AS (
  SELECT *, regexp_extract_all(t, '{word}') AS w, list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '{word}')) AS ls
  FROM texts),
pos AS (SELECT r, w, unnest(range(1, len(w) - {q.WINDOW} + 2)) AS i FROM arrays),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w[i:i + {q.WINDOW - 1}]) AS c FROM pos) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range({q.WINDOW}) o(k) GROUP BY r),
counts AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(ls) AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM arrays LEFT JOIN covered USING (r)),
ratios AS (
  SELECT *, 10000 * n_symbols // greatest(word_chars, 1) AS symbol_ratio, 10000 * n_dup_lines // greatest(n_lines, 1) AS dup_line_ratio,
         10000 * n_repeat_words // greatest(n_words, 1) AS repeat_ratio,
         n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counts),
buckets AS (
  SELECT lang, source, feature, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket FROM ({union})),
{levels},
best AS (
  SELECT l2.lang, l2.source, feature, coalesce(CASE WHEN l2.docs >= {q.MIN_DOCS} THEN l2.fence END, CASE WHEN l1.docs >= {q.MIN_DOCS} THEN l1.fence END, l0.fence) AS fence
  FROM l2 JOIN l1 USING (feature) JOIN l0 USING (feature) WHERE l2.lang IS NOT DISTINCT FROM l1.lang),
limits AS (SELECT lang, source, {fence} FROM best GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {inside} AS kept,
       {', '.join(f'{c}::BIGINT AS {c}' for c in kinds)}, {', '.join(f'{c}_fence::BIGINT AS {c}_fence' for c in kinds)}
FROM ratios LEFT JOIN limits ON ratios.lang IS NOT DISTINCT FROM limits.lang AND ratios.source IS NOT DISTINCT FROM limits.source"""


def _span_sql() -> str:
    unit = r"[^.!?;:,\n]*[.!?;:,\n]+[ \t\r\n]*|[^.!?;:,\n]+$"
    return f"""
WITH texts AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{unit}') AS us FROM documents),
units AS (SELECT doc_id, i, us[i] AS u, regexp_extract_all(lower(us[i]), '\\S+') AS w FROM texts, unnest(range(1, len(us) + 1)) r(i)),
upto AS (SELECT *, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY i) - len(w) AS before, max(i) OVER (PARTITION BY doc_id) AS n FROM units),
ends AS (  -- the first unit after a span
  SELECT a.doc_id, a.i, greatest(min(b.i) + 1, a.i + {d.UNITS}) AS e, any_value(a.n) AS n
  FROM upto a JOIN upto b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.before + len(b.w) >= a.before + {d.WORDS}
  GROUP BY a.doc_id, a.i),
spans AS (
  SELECT s.doc_id, s.i, s.e, (SELECT string_agg(array_to_string(w, ' '), chr(30) ORDER BY u.i) FROM units u WHERE u.doc_id = s.doc_id AND u.i >= s.i AND u.i < s.e AND len(w) > 0) AS h
  FROM ends s WHERE e <= n + 1),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS rn FROM spans) WHERE rn > 1),
gone AS (SELECT DISTINCT u.doc_id, u.i FROM units u JOIN later l ON u.doc_id = l.doc_id AND u.i >= l.i AND u.i < l.e)
SELECT t.doc_id, CASE WHEN any_value(t.text) IS NOT NULL THEN coalesce(string_agg(u.u, '' ORDER BY u.i) FILTER (g.i IS NULL), '') END AS text,
       count(u.i) AS n_units, count(g.i) AS n_removed
FROM texts t LEFT JOIN units u ON t.doc_id = u.doc_id LEFT JOIN gone g ON u.doc_id = g.doc_id AND u.i = g.i
GROUP BY t.doc_id"""


def _jaccard_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) >= {j.WORDS} THEN list_distinct([array_to_string(w[i:i + {j.WORDS - 1}], ' ') FOR i IN range(1, len(w) - {j.WORDS - 2})])
                         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g
  FROM texts),
items AS (SELECT r, len(g) AS n, unnest(g) AS sh FROM sets),
links AS (
  SELECT a.r AS x, b.r AS y FROM items a JOIN items b ON a.sh = b.sh AND a.r <> b.r
  GROUP BY a.r, b.r HAVING 100 * count(*) >= {j.PERCENT} * (any_value(a.n) + any_value(b.n) - count(*))),
reach(x, y) AS (SELECT r, r FROM sets UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, min(t.doc_id) AS component_id
FROM sets s JOIN reach ON s.r = reach.x JOIN sets t ON t.r = reach.y GROUP BY s.r, s.doc_id, s.g"""


def _topk_sql() -> str:
    return f"""
WITH v AS (
  SELECT vec_id, [floor({k.SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10"""


def _audit_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = "1 + (1000000000::HUGEINT * ({n} + 1)) // ({total} + v)"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
raw AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
terms AS (SELECT r, lang, source, translate(term, '{upper}', '{upper.lower()}') AS term FROM raw),
kept AS (SELECT lang, term, count(*) AS lang_n FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= {a.MIN_DOCS}),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms GROUP BY lang, source, term),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
groups AS (
  SELECT lang, source, coalesce(any_value(total), 0) AS total FROM (SELECT DISTINCT lang, source FROM texts)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts JOIN kept USING (lang, term) GROUP BY lang, source) USING (lang, source)
  GROUP BY lang, source),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {share.format(n="coalesce(n, 0)", total="total")} AS p,
         {share.format(n="lang_n", total="lang_total")} AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source),
found AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN pairs p ON p.lang = x.lang AND p.source = x.source AND p.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= {a.TOP_TERMS}"""


def _suffix_sql() -> str:
    n = x.LENGTH
    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (SELECT r, doc_id, k, substr(h, 4000 * k + 1, {4000 + 2 * n - 2}) AS c FROM texts, unnest(range(0, len(h) // 4000 + 1)) u(k)),
windows AS (
  SELECT r, doc_id, 2000 * k + unnest(range(0, greatest(len(c) // 2 - {n - 1}, 0))) AS i,
         unnest([md5(substr(c, 2 * j + 1, {2 * n})) FOR j IN range(0, greatest(len(c) // 2 - {n - 1}, 0))]) AS w
  FROM chunks),
again AS (SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
runs AS (SELECT r, i, sum(begins) OVER (PARTITION BY r ORDER BY i) AS run
         FROM (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= {n} THEN 0 ELSE 1 END AS begins FROM again)),
spans AS (SELECT r, run, min(i) AS a, max(i) + {n} AS b FROM runs GROUP BY r, run),
gaps AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
cut AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, max(b) AS upto
        FROM gaps JOIN texts USING (r) GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)"""


ORACLE: dict[str, str] = {"op2_shard": _sharding_sql(), "op5_quality": _quality_sql(), "op6_span_dedup": _span_sql(),
                          "op8_jaccard_join": _jaccard_sql(), "op10_topk": _topk_sql(),
                          "op12_source_audit": _audit_sql(), "op13_suffix_dedup": _suffix_sql()}
