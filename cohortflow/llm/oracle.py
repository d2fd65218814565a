"""DuckDB SQL for the corpus queries that SQL can express.

Written from the queries' contracts. Operators that learn a model, tokenize or
hash in their own way (2, 3, 5, 6, 8, 9, 10, 12 and the pipeline) have no SQL; the
tests in tests/llm hold them against plain Python.
"""

from __future__ import annotations

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_OP1 = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_SPACED})) AS size FROM documents
),
sources AS (
  SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source
),
filled AS (
  SELECT *, source_size * 2 / weight AS fill,
         coalesce(sum(source_size) OVER before, 0)::BIGINT AS full_size, coalesce(sum(weight) OVER before, 0)::BIGINT AS full_weight,
         (sum(source_size) OVER ())::BIGINT AS all_size, (sum(weight) OVER ())::BIGINT AS all_weight
  FROM sources
  WINDOW before AS (ORDER BY source_size * 2 / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
leveled AS (
  SELECT *, (all_size * 1.5::DOUBLE - full_size * 2) / (all_weight - full_weight) AS level FROM filled
),
targets AS (
  SELECT source, n, source_size,
         least(source_size * 2, (SELECT arg_min(level, fill) FROM leveled WHERE fill >= level) * weight)::DOUBLE AS target
  FROM leveled
),
units AS (
  SELECT source, doc_id, sum(size)::BIGINT AS words FROM sized GROUP BY source, doc_id
),
valued AS (
  SELECT units.*, source_size, target, floor(target / source_size) AS certain,
         target / source_size - floor(target / source_size) AS rest,
         ('0x' || left(md5(doc_id::VARCHAR || ':mix'), 13))::BIGINT::DOUBLE AS bits,
         sqrt(words * n / source_size) AS longer
  FROM units JOIN targets ON units.source IS NOT DISTINCT FROM targets.source
),
ranked AS (
  SELECT *, CASE WHEN rest > 0 AND words > 0
                 THEN ((bits + 0.5::DOUBLE) / 4503599627370496) / (1 - (bits + 0.5::DOUBLE) / 4503599627370496) / (rest / (1 - rest) * longer)
                 ELSE 'inf'::DOUBLE END AS value
  FROM valued
),
drawn AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY value, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM ranked
)
SELECT s.doc_id, s.size, d.source_size, d.target,
       (CASE WHEN words = 0 THEN 0
             ELSE s.size * (certain + CASE WHEN certain < 2 AND before + words / 2 <= target - certain * source_size THEN 1 ELSE 0 END) END)::BIGINT AS taken
FROM sized s JOIN drawn d ON s.doc_id = d.doc_id AND s.source IS NOT DISTINCT FROM d.source"""

_OP4 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, {_SPACED}) AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2])
                                      WHEN len(w) > 0 THEN [w] ELSE [] END) AS s
  FROM words
),
sizes AS (
  SELECT doc_id, count(s) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, y FROM reached r JOIN links ON x = r.other
)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)"""

_OP7 = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, {_ALNUM}) AS w FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all({_FOLDED}, {_ALNUM}) AS w FROM benchmark WHERE item_id IS NOT NULL
),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i : i + 9])) AS win
  FROM items WHERE len(w) > 0
),
runs AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos, w
  FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
),
found AS (
  SELECT doc_id, pos, r.size, item_id FROM runs r JOIN windows v ON v.size = r.size AND v.win = r.w[pos : pos + r.size - 1]
),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""

_OP11 = rf"""
WITH RECURSIVE crc_table AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) t(i)
),
doc_words AS (
  SELECT rowid AS r, doc_id, regexp_extract_all({_FOLDED}, {_ALNUM}) AS w FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
),
doc_counts AS (
  SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM doc_words) GROUP BY r, word
),
bench_counts AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all({_FOLDED}, {_ALNUM})) AS word FROM benchmark) GROUP BY word
),
vocabulary AS (
  SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM doc_counts UNION SELECT word FROM bench_counts)
),
behind AS (  -- what a byte, or (byte -1) the initial register, comes to when `far` more bytes have followed
  SELECT 0 AS far, i AS byte, v FROM crc_table
  UNION ALL SELECT 0, -1, 4294967295
  UNION ALL
  SELECT far + 1, byte, xor(b.v >> 8, c.v) FROM behind b JOIN crc_table c ON c.i = b.v & 255
  WHERE far < (SELECT max(len(x)) // 2 FROM vocabulary)
),
bytes AS (
  SELECT word, len(x) // 2 - 1 - k AS far, ('0x' || substr(x, 2 * k + 1, 2))::BIGINT AS byte
  FROM (SELECT word, x, unnest(range(len(x) // 2)) AS k FROM vocabulary)
  UNION ALL SELECT word, len(x) // 2, -1 FROM vocabulary
),
buckets AS (
  SELECT word, xor(bit_xor(v), 4294967295) % 10000 AS bucket FROM bytes JOIN behind USING (far, byte) GROUP BY word
),
source_n AS (SELECT bucket, sum(n) AS s FROM doc_counts JOIN buckets USING (word) GROUP BY bucket),
target_n AS (SELECT bucket, sum(n) AS t FROM bench_counts JOIN buckets USING (word) GROUP BY bucket),
gains AS (
  SELECT b.bucket,
         floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (coalesce((SELECT sum(s) FROM source_n), 0) + 10000)::DOUBLE)
                       / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM target_n), 0) + 10000)::DOUBLE))) AS gain
  FROM (SELECT DISTINCT bucket FROM buckets) b LEFT JOIN source_n USING (bucket) LEFT JOIN target_n USING (bucket)
),
weights AS (
  SELECT r, sum(n) AS n, floor(sum(gain * n) / sum(n)::DOUBLE) AS weight
  FROM doc_counts JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r
),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM doc_words LEFT JOIN weights USING (r)
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= (SELECT count(*) FROM scored WHERE n_features >= 20) * 10 // 100 THEN place END AS rank
FROM (SELECT *, row_number() OVER (ORDER BY n_features < 20, score DESC, doc_id NULLS FIRST, n_features, weight) AS place FROM scored)"""

_OP13 = rf"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
),
drawn AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
),
cut AS (
  SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS low, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS high FROM drawn
),
parts AS (
  SELECT doc_id, text, len(u) AS n, form, coalesce(array_to_string(u[:low], ''), '') AS prefix,
         coalesce(array_to_string(u[low + 1 : high], ''), '') AS middle, coalesce(array_to_string(u[high + 1 :], ''), '') AS suffix
  FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""

ORACLE_SQL: dict[str, str] = {
    "op1_pareto_mix": _OP1,
    "op4_minhash_forest": _OP4,
    "op7_decontaminate": _OP7,
    "op11_target_resampling": _OP11,
    "op13_fill_in_middle": _OP13,
}
