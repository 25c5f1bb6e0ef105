"""SQL twins for DuckDB of the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept,
       text_sha256
FROM hashed
"""

# Budgets in whole-number arithmetic, then the documents of a source in hash order
# up to the place where the running sum comes nearest to what the rate leaves over.
MIXING = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT source, source_size,
         1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight
  FROM sources
), filling AS (
  SELECT *,
         CAST(sum(source_size) OVER () AS BIGINT)
           - 3 * CAST(coalesce(sum(source_size) OVER before, 0) AS BIGINT) AS words_left,
         CAST(sum(weight) OVER () AS BIGINT)
           - CAST(coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weight_left
  FROM weighted
  WINDOW before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_max(words_left, weight_left) AS words_left, max(weight_left) AS weight_left
  FROM filling WHERE 3 * source_size * weight_left > weight * words_left
), targets AS (
  SELECT f.source, f.source_size,
         CASE WHEN l.weight_left IS NULL OR 3 * f.source_size * l.weight_left <= f.weight * l.words_left
              THEN CAST(3 * f.source_size AS DOUBLE)
              ELSE CAST(f.weight * l.words_left AS DOUBLE) / CAST(l.weight_left AS DOUBLE) END AS target
  FROM filling f CROSS JOIN level l
), passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM targets
), places AS (
  SELECT s.source, s.place, CAST(sum(s.size) AS BIGINT) AS words FROM sized s GROUP BY s.source, s.place
), running AS (
  SELECT p.source, p.place, p.words, t.target - t.whole * t.source_size AS budget,
         CAST(coalesce(sum(p.words) OVER (PARTITION BY p.source ORDER BY p.place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS below
  FROM places p JOIN passes t ON p.source IS NOT DISTINCT FROM t.source
), chosen AS (
  SELECT source, place,
         budget > 0 AND (below + words <= budget
           OR (below <= budget AND below + words - budget < budget - below)) AS taken
  FROM running
)
SELECT s.doc_id, s.size, t.source_size, t.target,
       s.size * (t.whole + CAST(c.taken AS BIGINT)) AS taken
FROM sized s
JOIN passes t ON s.source IS NOT DISTINCT FROM t.source
JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source AND s.place = c.place
"""


# Texts are read back as they went in; the formatted length depends on the template alone.
CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), lengths AS (
  SELECT *, length(replace(text, '\', '\\')) + 2 * length(regexp_extract_all(text, '<\||</?s>|\[/?INST\]|<</?SYS>>'))
    + length(role) + 23 AS formatted
  FROM turns
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM lengths GROUP BY conv_id
"""

RANKED_SEARCH = r"""
WITH worded AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), sized AS (
  SELECT place, doc_id, terms, len(terms) AS n FROM worded WHERE len(terms) > 0
), totals AS (
  SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sized
), occurrences AS (
  SELECT place, doc_id, n, term, count(*) AS tf
  FROM (SELECT place, doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * any_value(all_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM occurrences, totals GROUP BY term
), wanted AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), scored AS (
  SELECT item_id, place, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * all_docs) // all_terms)))) AS BIGINT)
           AS score
  FROM wanted JOIN weights USING (term) JOIN occurrences USING (term), totals GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
       doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


def _vector_codes() -> str:
    """Four rounds of assignment to the nearest entry and its floor mean, then a last assignment."""
    steps = [
        r"""numbered AS (
  SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), spread AS MATERIALIZED (
  SELECT place, (i - 1) // 16 AS part, (i - 1) % 16 AS position, CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM numbered, range(1, 65) AS r(i)
), book0 AS (
  SELECT part, place AS entry, position, x FROM spread WHERE place < 256
)"""
    ]
    for i in range(5):
        steps.append(
            f"""far{i} AS (
  SELECT s.place, s.part, b.entry, sum((s.x - b.x) * (s.x - b.x)) AS d
  FROM spread s JOIN book{i} b ON b.part = s.part AND b.position = s.position GROUP BY ALL
), near{i} AS MATERIALIZED (
  SELECT place, part, min({{'d': d, 'entry': entry}}) AS best FROM far{i} GROUP BY ALL
), book{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.position, coalesce(m.x, b.x) AS x
  FROM book{i} b LEFT JOIN (
    SELECT n.part, n.best.entry AS entry, s.position, CAST(floor(CAST(sum(s.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
    FROM near{i} n JOIN spread s ON s.place = n.place AND s.part = n.part GROUP BY ALL) m
  ON m.part = b.part AND m.entry = b.entry AND m.position = b.position
)"""
        )
    return "WITH " + ", ".join(steps) + """, coded AS (
  SELECT place, string_agg(printf('%02x', CAST(best.entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near4 GROUP BY place
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, position)) FROM book4) AS codebooks_sha256
FROM coded JOIN numbered USING (place)
"""


def llm_oracles():
    return {"op4_chat_format": CHAT, "op6_exact_dedup": EXACT_DEDUP, "op8_mixing": MIXING, "op11_ranked_search": RANKED_SEARCH, "op13_vector_codes": _vector_codes()}
