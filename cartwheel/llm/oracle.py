"""DuckDB SQL of the operators that SQL can express, over the same tables.

Sharding needs CRC-32, the mix a keyed permutation, and the others models, signatures or
tokenizers; those are tested against brute force in Python instead.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
OP5 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
),
windows AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM docs WHERE len(words) >= 8)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, CAST(sum(least(8, coalesce(next - i, 8))) AS BIGINT) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM twice) GROUP BY r
),
lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
),
counts AS (
  SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(l.n, 0) AS n_lines, coalesce(l.dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN covered c USING (r) LEFT JOIN lines l USING (r)
),
judged AS (
  SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeats,
    100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 30 * n_lines AS dup_lines
  FROM counts
),
hosts AS (
  SELECT source AS host, rule, count(*) AS n, sum(CASE WHEN broken THEN 1 ELSE 0 END) AS f FROM (
    UNPIVOT (SELECT source, short, repeats, symbols, dup_lines FROM judged)
    ON short, repeats, symbols, dup_lines INTO NAME rule VALUE broken) GROUP BY ALL
),
totals AS (
  SELECT rule, sum(n) AS n, sum(f) AS f, count(*) AS hosts, sum(CAST(n AS DOUBLE) * n) AS n2, sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS s
  FROM hosts GROUP BY rule
),
spread AS (
  SELECT rule, m, n AS all_n, f AS all_f, m * (1 - m) AS within, CASE WHEN 1 - n2 / (n * n) > 1e-12 THEN
    (greatest(s - m * m, 0) - m * (1 - m) * (hosts - 1) / n) / (1 - n2 / (n * n)) ELSE 0 END AS between_hosts FROM totals
),
priors AS (
  SELECT rule, m, all_n, all_f, least(greatest(CASE WHEN between_hosts > within / 1e6 THEN within / between_hosts - 1 ELSE 1e6 END, 20), 1e6) AS k FROM spread
),
bad AS (
  SELECT DISTINCT host FROM hosts JOIN priors USING (rule)
  WHERE (f + m * k) / (n + k) > 0.6 AND all_n > n AND (f + m * k) / (n + k) * (all_n - n) >= 2 * (all_f - f)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
  NOT (short OR repeats) AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.host IS NOT DISTINCT FROM judged.source) AS kept
FROM judged
"""
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(size: int, percent: int) -> str:
    """Documents, the sizes of their sets of ``size`` words and their components."""
    return rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents
),
shingles AS (
  SELECT DISTINCT r, md5_number(array_to_string(words[i:i + {size - 1}], ' ')) AS s
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - {size - 2}, 2))) AS i FROM docs WHERE len(words) > 0)
),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY ALL
),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * c.n >= {percent} * (x.n + y.n - c.n)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT r AS a, r AS b FROM sizes
  UNION SELECT reached.a, both_ways.b FROM reached JOIN both_ways ON reached.b = both_ways.a
),
groups AS (SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN docs ON docs.r = reached.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM docs LEFT JOIN sizes USING (r) LEFT JOIN groups USING (r)
"""


OP10 = f"SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM ({_components(5, 75)})"
OP11 = _components(4, 85)
OP13 = """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, list(t ORDER BY pos) AS own, CAST((4294967295 - list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, c: list_reduce(list_concat([xor(crc, c)], list_transform(range(8), lambda z: CAST(0 AS BIGINT))),
      lambda x, z: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1))))) % 9 AS BIGINT) AS h
  FROM turns GROUP BY conv_id
),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), coalesce(c.own[c.h + 1:], [])) AS seq
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5
),
prefixes AS (SELECT conv_id, d, len(seq) AS n, seq[1:d] AS p FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, p, min(conv_id) AS id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends
  FROM prefixes GROUP BY d, p
),
linked AS (
  SELECT c.*, q.id AS parent, CASE WHEN c.d > 0 THEN strlen(c.p[-1].text) ELSE 0 END AS bytes
  FROM nodes c LEFT JOIN nodes q ON q.d = c.d - 1 AND q.p = c.p[1:c.d - 1]
),
children AS (SELECT d - 1 AS d, parent AS id, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL),
above AS (SELECT l.*, coalesce(k.n, 0) AS n_children, unnest(range(l.d + 1)) AS up FROM linked l LEFT JOIN children k ON k.d = l.d AND k.id = l.id),
sums AS (
  SELECT up, p[1:up] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved FROM above GROUP BY ALL
)
SELECT l.id AS conv_id, CAST(l.d AS BIGINT) AS depth, l.parent AS parent_conv_id, l.n_convs, coalesce(k.n, 0) AS n_children,
  s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, l.ends AS ends_sha256
FROM linked l JOIN sums s ON s.up = l.d AND s.p = l.p LEFT JOIN children k ON k.d = l.d AND k.id = l.id
"""


def _assigned(k: int) -> str:
    return f"""a{k} AS (
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT r, p, e, list_sum(list_transform(list_zip(t.s, b.s), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts t JOIN b{k} b USING (p)) GROUP BY r, p
)"""


def _replaced(k: int) -> str:
    return f"""m{k} AS (
  SELECT p, e, i, sum(x) AS x, count(*) AS n
  FROM (SELECT p, e, unnest(s) AS x, unnest(range(len(s))) AS i FROM a{k} JOIN parts USING (r, p)) GROUP BY ALL
),
b{k + 1} AS (
  SELECT p, e, coalesce(n.s, b.s) AS s FROM b{k} b LEFT JOIN (
    SELECT p, e, list(CAST((x - ((x % n) + n) % n) // n AS BIGINT) ORDER BY i) AS s FROM m{k} GROUP BY p, e) n USING (p, e)
)"""


OP12 = f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (
  SELECT r, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS s FROM (SELECT *, unnest(range(16)) AS p FROM kept)
),
first AS (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept ORDER BY vec_id, v LIMIT 64),
b0 AS (SELECT p, e, s FROM parts JOIN first USING (r)),
{_assigned(0)},
{_replaced(0)},
{_assigned(1)},
{_replaced(1)},
{_assigned(2)},
coded AS (SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY r),
digest AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS h
  FROM (SELECT p, e, unnest(s) AS x, unnest(range(len(s))) AS i FROM b2)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""
