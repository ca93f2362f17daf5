"""DuckDB statements for the operators that SQL can express over whole tables.

Written from the contracts, by brute force where that is simpler, not from the
Spark plans.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE["op13_url_filter"] = f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
cut AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parts AS (SELECT page_id, translate(h, '{_UPPER}', '{_LOWER}') AS host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM cut),
rules(rh, rp, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (SELECT p.host, p.path, rh || rp AS rule, verdict,
                row_number() OVER (PARTITION BY p.host, p.path ORDER BY length(rh || rp) DESC) AS n
         FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules ON (p.host = rh OR ends_with(p.host, '.' || rh)) AND starts_with(p.path, rp))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.host = p.host AND f.path = p.path AND f.n = 1"""

ORACLE["op12_source_divergence"] = f"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                        '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
occ AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
here AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM occ o JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM docs),
lv AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
tot AS (SELECT g.lang, g.source, coalesce(sum(h.n), 0) AS total FROM grp g LEFT JOIN here h USING (lang, source) GROUP BY ALL),
p AS (SELECT t.lang, t.source, k.term, coalesce(h.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 1)) // (t.total + lv.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (k.n + 1)) // (lv.total + lv.v)::HUGEINT AS q
      FROM tot t JOIN kept k USING (lang) JOIN lv USING (lang) LEFT JOIN here h ON h.lang = t.lang AND h.source = t.source AND h.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source != b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
found AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
          UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 200"""


_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"

# All windows of 35 words as strings; repeated ones by grouping the strings.
ORACLE["op2_substring_dedup"] = f"""
WITH docs AS (SELECT row_number() OVER () AS d, CAST(doc_id AS BIGINT) AS doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
words AS (SELECT d, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
windows AS (SELECT d, p, word, string_agg(word, ' ') OVER ahead AS s, count(*) OVER ahead AS n FROM words
            WINDOW ahead AS (PARTITION BY d ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
repeated AS (SELECT s FROM windows WHERE n = 35 GROUP BY s HAVING count(*) > 1),
starts AS (SELECT x.d, x.p, x.word, CASE WHEN x.n = 35 AND r.s IS NOT NULL THEN 1 ELSE 0 END AS hit FROM windows x LEFT JOIN repeated r ON x.s = r.s),
marked AS (SELECT d, p, word, max(hit) OVER (PARTITION BY d ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM starts),
texts AS (SELECT d, sum(gone) AS removed, string_agg(word, ' ' ORDER BY p) FILTER (gone = 0) AS kept FROM marked GROUP BY d)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN texts USING (d)"""

# Weighted Jaccard similarity of all texts that share a run, then the closure.
ORACLE["op3_near_duplicates"] = f"""
WITH RECURSIVE docs AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, array_to_string({_WORDS.format("lower(coalesce(text, ''))")}, ' ') AS t FROM documents),
texts AS (SELECT t, min(doc_id) AS id, string_split(t, ' ') AS w FROM docs WHERE t != '' GROUP BY t),
words AS (SELECT id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts),
spans AS (SELECT id, n, p, string_agg(word, ' ') OVER ahead AS run FROM words
          WINDOW ahead AS (PARTITION BY id ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
elements AS (SELECT id, run, row_number() OVER (PARTITION BY id, run ORDER BY p) AS occurrence FROM spans WHERE p <= greatest(n - 4, 1)),
weights AS (SELECT id, count(*) AS weight FROM elements GROUP BY id),
shared AS (SELECT a.id AS a, b.id AS b, count(*) AS n FROM elements a JOIN elements b
           ON a.run = b.run AND a.occurrence = b.occurrence AND a.id < b.id GROUP BY ALL),
links AS (SELECT s.a, s.b FROM shared s JOIN weights x ON x.id = s.a JOIN weights y ON y.id = s.b
          WHERE 5 * s.n >= 4 * (x.weight + y.weight - s.n)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, other) AS (SELECT id, id FROM texts UNION SELECT r.id, e.b FROM reach r JOIN ways e ON e.a = r.other),
classes AS (SELECT id, min(other) AS class_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id
FROM docs d LEFT JOIN texts t ON t.t = d.t LEFT JOIN classes c ON c.id = t.id"""

# Distinct runs of every document against those of every item.
ORACLE["op6_decontamination"] = f"""
WITH docs AS (SELECT row_number() OVER () AS d, CAST(doc_id AS BIGINT) AS doc_id, {_WORDS.format("lower(coalesce(text, ''))")} AS w FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, least(len(w), 5) AS size, w
          FROM (SELECT DISTINCT CAST(item_id AS BIGINT) AS item_id, {_WORDS.format("lower(text)")} AS w FROM benchmark) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM items),
item_words AS (SELECT i, size, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM items),
item_runs AS (SELECT DISTINCT a.i, a.size, string_agg(b.word, ' ' ORDER BY b.p) AS run FROM item_words a
              JOIN item_words b ON a.i = b.i AND b.p BETWEEN a.p AND a.p + a.size - 1 GROUP BY a.i, a.size, a.p HAVING count(*) = a.size),
doc_words AS (SELECT d, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
after AS (SELECT d, p, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] AS next
          FROM doc_words WINDOW o AS (PARTITION BY d ORDER BY p)),
doc_runs AS (SELECT DISTINCT d, size, array_to_string(next[1:size], ' ') AS run FROM after, sizes WHERE next[size] IS NOT NULL),
found AS (SELECT d, i, count(*) AS n FROM doc_runs JOIN item_runs USING (size, run) GROUP BY d, i),
total AS (SELECT i, item_id, count(*) AS n FROM item_runs JOIN items USING (i) GROUP BY i, item_id)
SELECT d.doc_id, t.item_id, CAST(f.n AS DOUBLE) / t.n AS containment
FROM found f JOIN total t USING (i) JOIN docs d USING (d) WHERE 5 * f.n >= 4 * t.n"""
