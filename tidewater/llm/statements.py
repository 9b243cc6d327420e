"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_COUNTS = rf"""
d AS (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, regexp_extract_all(text, '{_WORD}') AS words FROM d),
p AS (SELECT row, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM w),
x AS (SELECT row, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM p WINDOW o AS (PARTITION BY row ORDER BY i)),
g AS (SELECT row, i, count(*) OVER (PARTITION BY row, a, b, c) AS n FROM x WHERE c IS NOT NULL),
r AS (
  SELECT row, sum(least(3, coalesce(nxt - i, 3))) AS n_repeat_words
  FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS nxt FROM g WHERE n > 1) GROUP BY row),
l AS (SELECT row, line FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}')),
k AS (SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY row),
c AS (
  SELECT d.row, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines
  FROM d JOIN w USING (row) LEFT JOIN r USING (row) LEFT JOIN k USING (row)),
m AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbol,
    CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS line,
    CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeat
  FROM c)"""



def _level(name: str, keys: list[str]) -> str:
    """Values above 0 and the threshold for each group of ``keys`` and each ratio."""
    k = ", ".join([*keys, "ratio"])
    same = " AND ".join(f"t.{x} IS NOT DISTINCT FROM p.{x}" for x in [*keys, "ratio"])
    return f"""{name}v AS (SELECT {k}, value, count(*) AS n, length(bin(value + 1)) AS m FROM v GROUP BY ALL),
{name}t AS (
  SELECT {k}, any_value(filled) AS filled, min(value) FILTER (value > 0 AND 100 * seen >= CASE ratio WHEN 'line' THEN 90 ELSE 95 END * filled) AS tail
  FROM (SELECT *, sum(CASE WHEN value > 0 THEN n ELSE 0 END) OVER (PARTITION BY {k}) AS filled,
          sum(CASE WHEN value > 0 THEN n ELSE 0 END) OVER (PARTITION BY {k} ORDER BY value) AS seen FROM {name}v) GROUP BY {k}),
{name}m AS (SELECT {k}, m, sum(n)::BIGINT AS n, min(value) AS low, max(value) AS high FROM {name}v GROUP BY {k}, m),
{name}w AS (
  SELECT {k}, m, (high + lead(low) OVER w) // 2 AS middle, (sum(n) OVER w)::DOUBLE AS l, (sum(n * m) OVER w)::DOUBLE AS s,
    (sum(n) OVER (PARTITION BY {k}))::DOUBLE AS d, (sum(n * m) OVER (PARTITION BY {k}))::DOUBLE AS z
  FROM {name}m WINDOW w AS (PARTITION BY {k} ORDER BY m)),
{name}p AS (
  SELECT {k}, middle FROM (SELECT *, (d * s - l * z) * (d * s - l * z) / (l * (d - l)) AS apart FROM {name}w WHERE d > l)
  QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY apart DESC, m) = 1),
{name} AS (
  SELECT {", ".join("t." + x for x in [*keys, "ratio"])}, filled, CASE WHEN t.ratio = 'symbol' THEN middle ELSE tail END AS cut
  FROM {name}t t LEFT JOIN {name}p p ON {same})"""


_LIMITS = f"""
v AS (
  SELECT lang, source, ratio, least(value, 4000) AS value
  FROM (SELECT lang, source, unnest(['symbol', 'line', 'repeat']) AS ratio, unnest([symbol, line, repeat]) AS value FROM m WHERE NOT base_failed)),
{_level("own", ["lang", "source"])},
{_level("language", ["lang"])},
{_level("every", [])},
f AS (
  SELECT o.lang, o.source, o.ratio, coalesce(CASE WHEN o.filled >= 20 THEN o.cut WHEN a.filled >= 20 THEN a.cut ELSE e.cut END, 4000) AS cut
  FROM own o JOIN language a ON o.lang IS NOT DISTINCT FROM a.lang AND o.ratio = a.ratio JOIN every e ON o.ratio = e.ratio),
t AS (
  SELECT lang, source, greatest(10, max(cut) FILTER (ratio = 'symbol')) AS max_symbol,
    greatest(30, max(cut) FILTER (ratio = 'line')) AS max_line, greatest(30, max(cut) FILTER (ratio = 'repeat')) AS max_repeat
  FROM f GROUP BY lang, source)"""

QUALITY = f"""
WITH {_COUNTS}, {_LIMITS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(symbol <= max_symbol, true) AND coalesce(line <= max_line, true)
    AND coalesce(repeat <= max_repeat, true) AS kept
FROM m LEFT JOIN t ON m.lang IS NOT DISTINCT FROM t.lang AND m.source IS NOT DISTINCT FROM t.source"""

SEARCH = """
WITH v AS (
  SELECT vec_id, max(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

COLLOCATIONS = rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
s AS (SELECT row, lang, string_split_regex(text, '[.,;:!?\x0A-\x0D]') AS pieces FROM d),
p AS (SELECT row, lang, generate_subscripts(pieces, 1) AS piece, unnest(pieces) AS text FROM s),
e AS (SELECT row, lang, piece, regexp_extract_all(text, '[^\x20\x09]+') AS words FROM p),
w AS (SELECT row, lang, piece, generate_subscripts(words, 1) AS i, unnest(words) AS w1 FROM e),
t AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY row, piece ORDER BY i)),
n AS (SELECT lang, count(*) AS n FROM t GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM t GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM t WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM t WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
x AS (
  SELECT lang, w1, w2, max(f) AS longer
  FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
c AS (
  SELECT lang, f2.w1 || ' ' || f2.w2 AS phrase, 1 AS cut, f2.f AS a, a.f AS l, b.f AS r
  FROM f2 JOIN f1 a USING (lang, w1) JOIN f1 b ON b.lang = f2.lang AND b.w1 = f2.w2 LEFT JOIN x ON x.lang = f2.lang AND x.w1 = f2.w1 AND x.w2 = f2.w2
  WHERE f2.f >= 10 AND (longer IS NULL OR 100 * longer < 50 * f2.f)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 1, f3.f, a.f, b.f
  FROM f3 JOIN f1 a ON a.lang = f3.lang AND a.w1 = f3.w1 JOIN f2 b ON b.lang = f3.lang AND b.w1 = f3.w2 AND b.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 2, f3.f, a.f, b.f
  FROM f3 JOIN f2 a ON a.lang = f3.lang AND a.w1 = f3.w1 AND a.w2 = f3.w2 JOIN f1 b ON b.lang = f3.lang AND b.w1 = f3.w3),
g AS (SELECT *, CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM c),
h AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM h JOIN n USING (lang)) WHERE rank <= 2000"""

SQL = {"op4_topk_search": SEARCH, "op8_quality_rules": QUALITY, "op12_collocations": COLLOCATIONS}
