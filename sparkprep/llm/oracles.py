"""SQL that gives the rows of the queries it is registered for, from the input tables alone."""

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

MIX_SOURCES = f"""
WITH d AS (SELECT doc_id, source, {WORDS} AS size FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
                WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 2 * source_size / weight) AS k FROM w),
c AS (SELECT k, SUM(2 * source_size) OVER (ORDER BY k) - 2 * source_size AS caps,
             SUM(weight) OVER () - SUM(weight) OVER (ORDER BY k) + weight AS open,
             SUM(source_size) OVER () AS total, source_size, weight FROM o),
l AS (SELECT CAST(1.5::DOUBLE * CAST(total AS DOUBLE) - CAST(caps AS DOUBLE) AS DOUBLE) / open AS level
      FROM c WHERE 2 * source_size >= weight * ((1.5::DOUBLE * CAST(total AS DOUBLE) - CAST(caps AS DOUBLE)) / open)
      ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), weight * (SELECT level FROM l)) AS target
      FROM w),
r AS (SELECT doc_id, size, source_size, target,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             CAST(('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 13)) AS BIGINT)
               / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r"""

CHAT_FORMAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, 10 + 2 * (length(regexp_replace(role || text, '[^\\<\[\]]', '', 'g')))
                + length(role) + length(text) AS chars FROM t)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

RANKED_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS terms FROM benchmark),
c AS (SELECT COUNT(*) AS n_docs, CAST(SUM(len(terms)) AS HUGEINT) AS n_terms FROM d WHERE len(terms) > 0),
e AS (SELECT r, unnest(terms) AS term FROM d),
t AS (SELECT r, term, COUNT(*) AS tf FROM e GROUP BY r, term),
v AS (SELECT q, term, COUNT(*) AS times FROM (SELECT q, unnest(terms) AS term FROM i) GROUP BY q, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * COUNT(*) + 1)::DOUBLE)) AS BIGINT) AS w
      FROM t, c GROUP BY term, n_docs),
s AS (SELECT q, t.r, SUM(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.terms) * n_docs) // n_terms)))) AS score
      FROM v JOIN t USING (term) JOIN w USING (term) JOIN d ON d.r = t.r CROSS JOIN c GROUP BY q, t.r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT q, r, score, d.doc_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, d.doc_id NULLS LAST) AS rank
      FROM s JOIN d USING (r) WHERE score > 0) JOIN i USING (q)
WHERE rank <= 10"""
