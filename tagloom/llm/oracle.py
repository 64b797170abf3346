"""DuckDB twins of the corpus queries that SQL can express."""

OP2 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 1 THEN w
    ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s FROM words),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * c >= 80 * (len(p.s) + len(q.s) - c)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, to_id) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, w.b FROM reach r JOIN ways w ON w.a = r.to_id),
part AS (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN part USING (doc_id)
"""

OP9 = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM split),
shared AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM shared)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (k NOT IN (SELECT k FROM shared)), '')) AS kept_sha256
FROM keyed GROUP BY doc_id
"""

# Bisects as the query does: eight rounds, each to a 32nd of the interval.
OP3 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, source, coalesce(source, '') AS name,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS tokens FROM documents),
sums AS (SELECT name, sum(tokens)::BIGINT AS there, count(*) AS docs FROM words GROUP BY 1),
shares AS (SELECT *, there / (sum(there) OVER ())::DOUBLE AS share, count(*) OVER () AS n,
    (sum(there) OVER ())::DOUBLE AS every FROM sums),
unmixed AS (SELECT -sum(share * ln(share)) >= 0.99 * ln(any_value(n)) - 1e-12 AS good FROM shares),
narrowed(round, low, high) AS (
  SELECT 0, 0::DOUBLE, 1::DOUBLE
  UNION ALL
  SELECT round + 1, low + (high - low) * below / 32, low + (high - low) * (below + 1) / 32
  FROM (SELECT round, low, high, (
      SELECT count(*) FILTER (good) FROM (
        SELECT i, -sum(power / z * ln(power / z)) >= 0.99 * ln(any_value(n)) - 1e-12 AS good FROM (
          SELECT i, n, share ** (low + (high - low) * i / 32) AS power,
            sum(share ** (low + (high - low) * i / 32)) OVER (PARTITION BY i) AS z
          FROM shares, range(1, 32) t(i)) GROUP BY i)) AS below
    FROM narrowed WHERE round < 8)),
chosen AS (SELECT CASE WHEN (SELECT good FROM unmixed) THEN 1.0::DOUBLE ELSE (SELECT low FROM narrowed WHERE round = 8) END AS x),
plan AS (
  SELECT name, budget // there AS whole, budget % there AS rest, ceil(sqrt(docs))::BIGINT AS blocks FROM (
    SELECT *, floor(power / sum(power) OVER () * every + 0.5)::BIGINT AS budget FROM (
      SELECT *, share ** (SELECT x FROM chosen) AS power FROM shares))),
dealt AS (
  SELECT doc_id, source, name, tokens, whole, rest, block, p AS pass,
    ('0x' || substr(md5('0|' || p || '|' || doc_id), 1, 15))::BIGINT AS turn
  FROM (SELECT *, ('0x' || substr(md5('0|' || doc_id), 1, 15))::BIGINT % blocks AS block,
      unnest(range(whole + CASE WHEN rest = 0 THEN 0 ELSE 1 END)) AS p
    FROM words JOIN plan USING (name))),
totals AS (SELECT name, pass, block, sum(tokens) AS held FROM dealt GROUP BY ALL),
begins AS (SELECT name, pass, block, coalesce(sum(held) OVER (PARTITION BY name, pass
    ORDER BY ('0x' || substr(md5('0|block|' || name || '|' || pass || '|' || block), 1, 15))::BIGINT, block
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin FROM totals),
placed AS (SELECT *, begin + coalesce(sum(tokens) OVER (PARTITION BY name, pass, block ORDER BY turn, doc_id, tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM dealt JOIN begins USING (name, pass, block))
SELECT doc_id, source, pass::INTEGER AS pass, block::BIGINT AS block, start::BIGINT AS start
FROM placed WHERE pass < whole OR start < rest
"""

OP5 = r"""
WITH calls AS (SELECT conv_id, turn, role, text FROM conversations WHERE role IS DISTINCT FROM 'assistant'),
results AS (SELECT conv_id, turn - 1 AS turn, list(text ORDER BY text) FILTER (text IS NOT NULL) AS contents, true AS there
  FROM conversations WHERE role = 'assistant' GROUP BY 1, 2),
chains AS (SELECT conv_id, turn, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
  FROM (SELECT DISTINCT conv_id, turn FROM calls)),
levels AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS level FROM chains)
SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS call_id, level::BIGINT AS level,
  called IS NOT NULL AND there IS NOT NULL AS linked,
  called IS NOT NULL AND coalesce(role IN ('system', 'user') AND length(text) > 0, false) AS valid,
  '{' || CASE WHEN called THEN '"arguments":{' || coalesce('"text":' || to_json(text), '') || '},' ELSE '' END
    || '"id":"' || conv_id || ':' || turn || '"' || coalesce(',"name":' || to_json(role), '')
    || CASE WHEN len(contents) = 1 THEN ',"result":' || to_json(contents[1]) WHEN len(contents) > 1
      THEN ',"result":' || to_json(contents) ELSE '' END || '}' AS message
FROM (SELECT *, true AS called FROM calls) FULL JOIN results USING (conv_id, turn) LEFT JOIN levels USING (conv_id, turn)
"""

OP8 = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
dl AS (SELECT doc_id, sum(tf) AS dl FROM tf GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM documents)::DOUBLE AS n, (SELECT sum(dl) FROM dl) AS total),
query AS (
  SELECT doc_id AS query_id, term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf
  FROM tf JOIN df USING (term), n WHERE doc_id % 20 = 0 AND df >= 2),
scored AS (
  SELECT query_id, doc_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / (total / n)))), 6) AS score
  FROM query JOIN tf USING (term) JOIN dl USING (doc_id), n WHERE doc_id <> query_id GROUP BY ALL)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored QUALIFY rank <= 10
"""

OP10 = """
WITH score AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS score
  FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM score QUALIFY rank <= 20
"""

OP12 = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS gram
  FROM (SELECT *, least(len(w), 10) AS m FROM item WHERE len(w) > 0)),
places AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i,
    unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS gram
  FROM doc, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m),
hits AS (SELECT doc_id, i, m, item_id FROM places JOIN windows USING (m, gram)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY 1),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY 1),
grams AS (SELECT lang, m, unnest([w[i:i + m - 1] FOR i IN range(1, len(w) - m + 2)]) AS g
  FROM split, range(1, 5) t(m) WHERE len(w) >= m),
counts AS (SELECT lang, m, g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT * FROM counts WHERE m >= 2),
inner_parts AS (SELECT lang, c.a, g[i:i + k - 1] AS g FROM candidates c, range(2, 4) t(k), range(1, 4) u(i)
  WHERE k < m AND i + k - 1 <= m),
longest AS (SELECT lang, g, max(a) AS a FROM inner_parts GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN longest x ON x.lang = c.lang AND x.g = c.g WHERE x.a IS NULL OR 100 * x.a < 80 * c.a),
cuts AS (SELECT c.lang, c.g, c.a, k, l.a AS l, r.a AS r, ((2000000::HUGEINT * c.a) // (l.a + r.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) c
  JOIN counts l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN counts r ON r.lang = c.lang AND r.g = c.g[k + 1:c.m]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
placed AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM best)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM placed JOIN totals USING (lang) QUALIFY rank <= 2000
"""

ORACLE_SQL = {
    "op2_near_dedup": OP2,
    "op3_source_mixing": OP3,
    "op5_tool_calls": OP5,
    "op8_search": OP8,
    "op9_line_dedup": OP9,
    "op10_nearest": OP10,
    "op12_decontamination": OP12,
    "op13_collocations": OP13,
}
