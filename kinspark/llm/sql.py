"""DuckDB SQL for the text operators that SQL can express."""

from __future__ import annotations

from kinspark.llm import importance as I
from kinspark.llm import pivot_clusters as P
from kinspark.llm.line_dedup import MIN_CHARS, MIN_DOCS
from kinspark.llm.quality_rules import BASE_FAILED, OTHER_LETTERS, STOP_WORDS, SYMBOLS, compile_rules

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

QUALITY_RULES = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws, string_split(text, chr(10)) AS ls, text FROM d),
l AS (SELECT *, [x FOR x IN ls IF length(trim(x, {_WHITE})) > 0] AS lines FROM w),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) > 2) q),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
          SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g) a WHERE c > 1) b GROUP BY doc_id),
m AS (SELECT l.doc_id,
        CAST(len(ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum([length(x) FOR x IN ws]), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
        len(lines) AS n_lines,
        len([x FOR x IN ws IF lower(x) IN ({_STOP})]) AS n_stop_words,
        length(regexp_replace(text, '[^{OTHER_LETTERS}]+', '', 'g')) AS n_other_letters,
        len([x FOR x IN lines IF ends_with(x, '...') OR ends_with(x, chr(8230))]) AS n_ellipsis_lines,
        len([x FOR x IN lines IF starts_with(x, '- ') OR starts_with(x, '* ') OR starts_with(x, chr(8226) || ' ')])
          AS n_bullet_lines
      FROM l LEFT JOIN r ON r.doc_id = l.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
       (NOT {BASE_FAILED} AND {compile_rules().replace("D * ", " * ")}) AS kept
FROM m"""

LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], {_WHITE}), '{_UPPER}', '{_LOWER}') AS k
      FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM d) q),
f AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= {MIN_CHARS}
      GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
j AS (SELECT l.doc_id, i, line, (f.k IS NOT NULL AND l.doc_id <> f.keeper) AS gone FROM l LEFT JOIN f ON f.k = l.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""


IMPORTANCE = f"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
      FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
      FROM benchmark),
df AS MATERIALIZED (SELECT doc_id, unnest(ws || [ws[i] || ' ' || ws[i + 1] FOR i IN generate_series(1, len(ws) - 1)]) AS f FROM d),
bf AS MATERIALIZED (SELECT unnest(ws || [ws[i] || ' ' || ws[i + 1] FOR i IN generate_series(1, len(ws) - 1)]) AS f FROM b),
steps(i, k, v) AS (SELECT i, 0, i FROM range(256) r(i) UNION ALL
      SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
t AS MATERIALIZED (SELECT list(v ORDER BY i) AS tab FROM steps WHERE k = 8),
names AS (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf) u),
bytes AS (SELECT f, [CAST((instr('0123456789ABCDEF', substr(h, 2 * i - 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, 2 * i, 1)) - 1 AS BIGINT)
                     FOR i IN generate_series(1, length(h) // 2)] AS bs FROM (SELECT f, hex(f) AS h FROM names) x),
hashed AS MATERIALIZED (SELECT f, xor(list_reduce([CAST(4294967295 AS BIGINT)] || bs, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])),
                               4294967295) % {I.BUCKETS} AS k FROM bytes, t),
dk AS MATERIALIZED (SELECT doc_id, k FROM df JOIN hashed USING (f)),
s AS (SELECT k, count(*) AS s FROM dk GROUP BY k),
tt AS (SELECT k, count(*) AS t FROM bf JOIN hashed USING (f) GROUP BY k),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) + {I.SMOOTH} AS a, (SELECT coalesce(sum(t), 0) FROM tt) + {I.SMOOTH} AS b),
g AS (SELECT s.k, CAST(floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(a AS DOUBLE)) / (CAST(s + 1 AS DOUBLE) * CAST(b AS DOUBLE)))) AS BIGINT) AS gain
      FROM s LEFT JOIN tt ON tt.k = s.k, n),
m AS (SELECT doc_id, count(*) AS n, sum(gain) AS total FROM dk JOIN g USING (k) GROUP BY doc_id),
w AS (SELECT d.doc_id, len(ws) AS n_words, CAST(coalesce(m.n, 0) AS BIGINT) AS n_features,
             CAST(coalesce((total - ((total % n + n) % n)) // n, 0) AS BIGINT) AS weight,
             CAST(concat('0x', substr(sha256(concat('{I.SEED}:', d.doc_id)), 1, 8)) AS BIGINT) AS h FROM d LEFT JOIN m ON m.doc_id = d.doc_id),
sc AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score, n_words >= {I.MIN_WORDS} AS ok FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY ok ORDER BY score DESC, doc_id) AS place, sum(CAST(ok AS BIGINT)) OVER () AS total FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN ok AND place <= {I.PERCENT} * total // 100 THEN place END AS rank FROM r"""


def _round(i: int) -> str:
    """Assignment to the centroids c{i} and, from it, c{i + 1}."""
    return f"""
s{i} AS (SELECT r, c, sum((x - y) * (x - y)) AS dist FROM x JOIN c{i} USING (d) GROUP BY r, c),
a{i} AS MATERIALIZED (SELECT r, c, dist FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY dist, c) AS place FROM s{i}) q WHERE place = 1),
m{i} AS (SELECT c, d, sum(x) AS t, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY c, d),
c{i + 1} AS MATERIALIZED (SELECT o.c, o.d, coalesce(CAST((t - ((t % n + n) % n)) // n AS BIGINT), o.y) AS y FROM c{i} o LEFT JOIN m{i} m ON m.c = o.c AND m.d = o.d)"""


PIVOT_CLUSTERS = f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor({P.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
      WHERE len(embedding) = {P.WIDTH} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {P.WIDTH}),
x AS MATERIALIZED (SELECT r, unnest(generate_series(1, {P.WIDTH})) AS d, unnest(v) AS x FROM e),
c0 AS MATERIALIZED (SELECT c, d, x AS y FROM x JOIN (SELECT r, row_number() OVER (ORDER BY sha256(concat('{P.SEED}:', vec_id))) - 1 AS c FROM e) o
      USING (r) WHERE c < {P.CLUSTERS}),{",".join(_round(i) for i in range(P.ROUNDS + 1))},
f AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS digest FROM c{P.ROUNDS} GROUP BY c)
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance, CAST(sum(dist) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(dist) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a{P.ROUNDS} a JOIN e USING (r) JOIN f ON f.c = a.c"""
