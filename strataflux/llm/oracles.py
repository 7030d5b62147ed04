"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from strataflux.llm.licenses import PHRASES, TEMPLATES

OP10 = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM n
WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""


OP9 = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS shingles
  FROM w),
t AS (SELECT row, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
  SELECT a.row AS x, b.row AS y
  FROM t a JOIN t b ON a.shingle = b.shingle AND a.row < b.row
  GROUP BY a.row, b.row, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT row AS x, row AS y FROM s
  UNION
  SELECT r.x, l.y FROM reach r JOIN both_ways l ON r.y = l.x)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT x, min(o.doc_id) AS component_id FROM reach JOIN s o ON o.row = reach.y GROUP BY x) m ON m.x = s.row
"""


OP5 = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                             lambda x: x <> '') AS w FROM documents),
iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                              lambda x: x <> '') AS w FROM benchmark),
i AS (
  SELECT item_id, len(w) AS n, least(len(w), 5) AS width,
         list_transform(range(0, len(w) - least(len(w), 5) + 1),
                        lambda k: array_to_string(w[k + 1 : k + least(len(w), 5)], ' ')) AS bag
  FROM iw WHERE len(w) > 0),
widths AS (SELECT DISTINCT width FROM i),
d AS (
  SELECT doc_id, width, list_transform(range(0, greatest(0, len(w) - width + 1)),
                        lambda k: array_to_string(w[k + 1 : k + width], ' ')) AS bag
  FROM dw, widths),
ds AS (SELECT doc_id, width, len(bag) AS total, unnest(bag) AS shingle, unnest(range(len(bag))) AS place FROM d),
its AS (SELECT item_id, n, width, unnest(bag) AS shingle, unnest(range(len(bag))) AS place FROM i),
wanted AS (SELECT DISTINCT n, width, shingle FROM its),
places AS (
  SELECT ds.doc_id, a.n, a.width, ds.total, ds.shingle,
         unnest(range(greatest(0, ds.place - (a.n - a.width)),
                      least(ds.place, greatest(0, ds.total - (a.n - a.width + 1))) + 1)) AS start
  FROM ds JOIN wanted a ON ds.shingle = a.shingle AND ds.width = a.width),
bags AS (
  SELECT doc_id, n, start, least(total, n - width + 1) AS size, shingle, count(*) AS c FROM places GROUP BY ALL),
ibags AS (SELECT item_id, n, n - width + 1 AS size, shingle, count(*) AS c FROM its GROUP BY ALL),
shared AS (
  SELECT b.doc_id, ib.item_id, b.start, b.size + ib.size AS sizes, sum(least(b.c, ib.c)) AS both_weights
  FROM bags b JOIN ibags ib ON b.n = ib.n AND b.shingle = ib.shingle
  GROUP BY ALL),
close_enough AS (
  SELECT doc_id, item_id, start, both_weights::DOUBLE / (sizes - both_weights) AS similarity FROM shared
  WHERE both_weights::DOUBLE / (sizes - both_weights) >= 0.8)
SELECT doc_id, item_id, max(similarity) AS similarity,
       CAST(arg_max(start, (similarity, -start)) AS BIGINT) AS first_word
FROM close_enough GROUP BY doc_id, item_id
"""

OP7 = r"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                             lambda x: x <> '') AS words
  FROM lowered),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM d),
phrases(phrase, label) AS (VALUES PHRASES),
p AS (SELECT string_split(phrase, ' ') AS words, label FROM phrases),
base AS (
  SELECT d.doc_id, w.pos, p.label
  FROM p JOIN w ON w.word = p.words[1] JOIN d ON d.doc_id = w.doc_id
  WHERE d.words[w.pos + 1 : w.pos + len(p.words)] = p.words),
templates(template, label) AS (VALUES TEMPLATES),
t AS (SELECT template, label, len(string_split(template, ' ')) AS m,
             list_distinct(string_split(template, ' ')) AS tokens FROM templates),
tt AS (SELECT template, label, m, len(tokens) AS n, unnest(tokens) AS token FROM t),
b AS (
  SELECT w.doc_id, tt.template, tt.label, tt.n, tt.m, w.pos // tt.m - shift.s AS block, tt.token
  FROM tt JOIN w ON w.word = tt.token CROSS JOIN (VALUES (0), (1)) shift(s)
  WHERE w.pos // tt.m - shift.s >= 0),
blocks AS (
  SELECT doc_id, template, label, m, block, count(DISTINCT token) / any_value(n)::DOUBLE AS share,
         count(DISTINCT token) >= ceil(any_value(n) * 4 / 5.0) AS enough
  FROM b GROUP BY doc_id, template, label, m, block),
met AS (SELECT doc_id, label, max(share) AS share FROM blocks WHERE enough GROUP BY ALL),
shown AS (
  SELECT doc_id, string_agg(DISTINCT shown, ',' ORDER BY shown) AS blocks FROM (
    SELECT doc_id, label || ':' || block * m || ':' || least((block + 2) * m, len(words)) AS shown
    FROM blocks JOIN d USING (doc_id) WHERE enough)
  GROUP BY doc_id),
labels AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM (
    SELECT doc_id, label, 1.0::DOUBLE AS share FROM base UNION ALL SELECT doc_id, label, share FROM met)
  GROUP BY doc_id),
bases AS (
  SELECT doc_id, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(bases.n, 0) AS n_base, first_word, last_word,
       coalesce(bases.labels, '') AS base_labels, coalesce(labels.labels, '') AS labels,
       coalesce(labels.score, 0.0)::DOUBLE AS score, coalesce(shown.blocks, '') AS blocks
FROM d LEFT JOIN bases USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN shown USING (doc_id)
"""


# Where sources are sorted by the share of a weight of one that fills them, those up to some place are full.
OP13 = r"""
WITH d AS (
  SELECT doc_id, text, source,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, 3 * source_size AS most,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS place FROM r),
t AS (
  SELECT *, sum(source_size) OVER () - sum(most) OVER (ORDER BY place) + most AS left_over,
         sum(weight) OVER () - sum(weight) OVER (ORDER BY place) + weight AS weights
  FROM o),
f AS (SELECT coalesce(min(place), (SELECT count(*) + 1 FROM t)) AS place FROM t WHERE left_over * weight < most * weights),
targets AS (
  SELECT source, source_size,
         CASE WHEN t.place < f.place THEN most::DOUBLE
              ELSE (SELECT x.left_over::DOUBLE FROM t x WHERE x.place = f.place) * weight::DOUBLE
                   / (SELECT x.weights::DOUBLE FROM t x WHERE x.place = f.place) END AS target
  FROM t, f),
rates AS (
  SELECT d.doc_id, d.size, m.source_size, m.target, coalesce(m.target / nullif(m.source_size, 0), 0.0)::DOUBLE AS rate,
         ('0x' || substr(md5(concat_ws(':', 'mix', coalesce(d.doc_id::VARCHAR, ''), md5(coalesce(d.text, '')))), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0::DOUBLE AS draw
  FROM d JOIN targets m ON d.source IS NOT DISTINCT FROM m.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates
"""


def values(pairs: list[tuple[str, str]]) -> str:
    return ", ".join(f"('{text}', '{label}')" for text, label in pairs)


def sql() -> dict[str, str]:
    op7 = OP7.replace("VALUES PHRASES", f"VALUES {values(PHRASES)}")
    op7 = op7.replace("VALUES TEMPLATES", f"VALUES {values(TEMPLATES)}")
    return {
        "op5_decontamination": OP5,
        "op7_license_scan": op7,
        "op9_jaccard_join": OP9,
        "op10_exact_dedup": OP10,
        "op13_source_mix": OP13,
    }
