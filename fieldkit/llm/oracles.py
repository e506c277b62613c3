"""DuckDB SQL for the queries that SQL can express, over the same tables.

Written from the contracts, by plain grouping and all pairs: nothing of the
operators' methods is in it.
"""

from __future__ import annotations

from fieldkit.llm import embed_dedup, line_dedup, quality

WORDS = "regexp_extract_all({}, '[^ \\t-\\r]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"

LINE_DEDUP = f"""
WITH d AS (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, text, ls, i, len({WORDS.format('ls[i]')}) AS w
      FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id, text ORDER BY i) AS upto FROM l),
forth AS (SELECT a.doc_id, a.text, a.ls, a.i AS s, min(b.i) AS e FROM c a JOIN c b
          ON a.doc_id = b.doc_id AND a.text = b.text AND b.i >= a.i AND b.upto - a.upto + a.w >= {line_dedup.MIN_WORDS}
          GROUP BY ALL),
back AS (SELECT b.doc_id, b.text, b.ls, max(a.i) AS s, b.i AS e FROM c a JOIN c b
         ON a.doc_id = b.doc_id AND a.text = b.text AND b.i >= a.i AND b.upto - a.upto + a.w >= {line_dedup.MIN_WORDS}
         GROUP BY b.doc_id, b.text, b.ls, b.i),
runs AS (SELECT *, row_number() OVER (PARTITION BY ls[s:e] ORDER BY doc_id, s) AS nth
         FROM (SELECT * FROM forth UNION SELECT * FROM back)),
gone AS (SELECT DISTINCT doc_id, text, unnest(range(s, e + 1)) AS i FROM runs WHERE nth > 1),
kept AS (SELECT doc_id, text, string_agg(ls[i], chr(10) ORDER BY i) AS rest FROM l ANTI JOIN gone USING (doc_id, text, i)
         GROUP BY doc_id, text),
spans AS (SELECT doc_id, text, string_agg((min_i - 1) || ':' || max_i, ',' ORDER BY min_i) AS removed
          FROM (SELECT doc_id, text, min(i) AS min_i, max(i) AS max_i
                FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, text ORDER BY i) AS island FROM gone)
                GROUP BY doc_id, text, island) GROUP BY doc_id, text)
SELECT d.doc_id, CAST(len(ls) AS INTEGER) AS n_lines, coalesce(removed, '') AS removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(rest, '') END AS text
FROM d LEFT JOIN kept USING (doc_id, text) LEFT JOIN spans USING (doc_id, text)
"""

QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, source, {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, i, ws[i:i + 4] AS five
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, five) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
raw AS (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM raw WHERE len({WORDS.format('line')}) > 0 GROUP BY doc_id),
norm AS (SELECT doc_id, coalesce('=' || source, '-') AS host, t, n_words, line FROM (
           SELECT doc_id, source, t, len({WORDS.format('line')}) AS n_words,
                  array_to_string({WORDS.format(f"translate(line, '{UPPER}', '{LOWER}')")}, ' ') AS line FROM raw)
         WHERE n_words > 0),
own AS (SELECT host, t, line, max(w) AS w, min(doc_id) AS id
        FROM (SELECT host, t, line, doc_id, sum(n_words) AS w FROM norm GROUP BY ALL) GROUP BY host, t, line),
hosts AS (SELECT coalesce('=' || source, '-') AS host, count(DISTINCT t) AS docs FROM d GROUP BY 1),
often AS (SELECT host, line, min(id) AS first_id, count(*) AS n FROM own JOIN hosts USING (host) GROUP BY host, line, docs
          HAVING count(*) > {quality.MIN_LINE_DOCS} AND (count(*) > {quality.MAX_LINE_DOCS} OR count(*) > docs * {quality.MAX_LINE_SHARE})),
gone AS (SELECT host, t, sum(w) AS w FROM own JOIN often USING (host, line) WHERE id <> first_id GROUP BY host, t),
f AS (SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
        CAST(length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(gone.w, 0) AS BIGINT) AS frequent_line_words
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id)
      LEFT JOIN gone ON gone.host = coalesce('=' || d.source, '-') AND gone.t = d.t),
g AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PCT} * n_words AS base_failed,
        n_words - frequent_line_words AS rest FROM f)
SELECT * EXCLUDE (rest), NOT base_failed AND NOT (frequent_line_words > 0
         AND (rest < {quality.MIN_WORDS} OR 100 * rest < {quality.MIN_LEFT_PCT} * n_words)) AS kept FROM g
"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= {embed_dedup.MIN_COSINE}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
part AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM part LEFT JOIN n USING (vec_id)
"""


def _rounds() -> str:
    """Lloyd's rounds: nearest entry of every part, then the entries' new components."""
    out = []
    for r in range(3):
        out.append(f"""near{r} AS (
  SELECT n, p, min(d * 64 + e) % 64 AS e, min(d) AS d
  FROM (SELECT x.n, x.p, c.e, sum((x.x - c.x) * (x.x - c.x)) AS d FROM x JOIN c{r} c ON c.p = x.p AND c.j = x.j GROUP BY ALL)
  GROUP BY n, p)""")
        if r < 2:
            out.append(f"""m{r} AS (
  SELECT a.p, a.e, x.j, sum(x.x)::BIGINT AS s, count(*) AS k FROM near{r} a JOIN x ON x.n = a.n AND x.p = a.p GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, c.j, CASE WHEN k IS NULL THEN c.x ELSE (s - ((s % k) + k) % k) // k END AS x
  FROM c{r} c LEFT JOIN m{r} m ON m.p = c.p AND m.e = c.e AND m.j = c.j)""")
    return ",\n".join(out)


VECTOR_CODES = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (
  SELECT n, (k * 16) // size AS p, k % (size // 16) AS j, floor(256 * value::DOUBLE)::BIGINT AS x
  FROM (SELECT n, len(embedding) AS size, unnest(embedding) AS value, unnest(range(len(embedding))) AS k FROM v)),
c0 AS MATERIALIZED (SELECT p, n AS e, j, x FROM x WHERE n < 64),
{_rounds()},
done AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM near2 JOIN v USING (n) GROUP BY n, vec_id, label),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM done, books
"""

CONVERSATIONS = """
WITH own AS MATERIALIZED (
  SELECT conv_id, list(md5(length(r)::VARCHAR || ':' || r || x) ORDER BY turn NULLS FIRST, r, x) AS s,
    list(len(list_filter(regexp_split_to_array(x, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) ORDER BY turn NULLS FIRST, r, x) AS n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
h AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda u, step: xor(u >> 1, 3988292384 * (u & 1))))) % 4 AS h
  FROM own),
rebuilt AS MATERIALIZED (
  SELECT h.conv_id, list_concat(coalesce(b.s[1:h], []), own.s[h + 1:]) AS s, list_concat(coalesce(b.n[1:h], []), own.n[h + 1:]) AS n
  FROM h JOIN own USING (conv_id) LEFT JOIN own b ON b.conv_id = h.base),
path AS MATERIALIZED (
  SELECT conv_id, d, md5(array_to_string(s[1:d], ',')) AS key, md5(array_to_string(s[1:d - 1], ',')) AS above,
    CASE WHEN d = 0 THEN 0 ELSE n[d] END AS words, len(s) = d AS ended
  FROM (SELECT conv_id, s, n, unnest(range(len(s) + 1)) AS d FROM rebuilt)),
node AS MATERIALIZED (
  SELECT d, key, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM path GROUP BY d, key),
kids AS (SELECT d - 1 AS d, above AS key, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
total AS (
  SELECT a.d, a.key, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum(x.saved)::BIGINT AS saved_tokens
  FROM node x JOIN path a ON a.conv_id = x.conv_id AND a.d <= x.d LEFT JOIN kids k ON k.d = x.d AND k.key = x.key GROUP BY ALL)
SELECT x.conv_id, x.d AS depth, up.conv_id AS parent_conv_id, x.n_convs, coalesce(k.n, 0) AS n_children, n_leaves, saved_tokens, x.ends_sha256
FROM node x JOIN total USING (d, key) LEFT JOIN kids k ON k.d = x.d AND k.key = x.key
LEFT JOIN node up ON up.d = x.d - 1 AND up.key = x.above
"""
