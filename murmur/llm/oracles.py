"""DuckDB SQL that gives the rows of the queries SQL can express."""

QUALITY = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents
), w AS (
  SELECT doc_id, t, r,
         list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), tok AS (
  SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM w
), win AS (
  SELECT r, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] AS five,
         lead(i, 4) OVER o AS last
  FROM tok WINDOW o AS (PARTITION BY r ORDER BY i)
), rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS c FROM win WHERE last IS NOT NULL) WHERE c > 1
), hit AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM rep) GROUP BY r
), s AS (
  SELECT doc_id, t, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words,
         len(regexp_extract_all(t, '!')) AS exclamations,
         len(regexp_extract_all(t, '\p{Lu}{2,}')) AS capitals
  FROM w LEFT JOIN hit USING (r)
), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 35 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 2 * exclamations > n_words OR 2 * capitals > n_words) AS kept
FROM b
"""

DECONTAMINATION = r"""
WITH words AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')
  FROM benchmark
), items AS (
  SELECT id AS item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, greatest(len(w) - 11, 2)),
         lambda i: array_to_string(w[i:i + 12], ' '))) AS win
  FROM words WHERE kind = 'b' AND len(w) > 0
), lens AS (SELECT DISTINCT n FROM items
), dwin AS (
  SELECT r, n, unnest(list_transform(range(1, greatest(len(w) - n + 2, 1)), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win,
         unnest(range(0, greatest(len(w) - n + 1, 0))) AS pos
  FROM words, lens WHERE kind = 'd'
), hit AS (
  SELECT r, dwin.n, pos, item_id FROM dwin JOIN items ON dwin.win = items.win AND dwin.n = items.n
), cov AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + n)) AS p FROM hit) GROUP BY r
), its AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY r
)
SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN cov USING (r) LEFT JOIN its USING (r) WHERE kind = 'd'
"""

WARC = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g
  FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), links AS (
  SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2) p
  JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 85 * (nx.n + ny.n - c)
), r AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT r.doc_id, links.y FROM r JOIN links ON links.x = r.other
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1) m USING (doc_id)
"""

#: All pairs of an anchor and a row; inner products of doubles are exact here, as all are integers below 2**53.
HARD_NEGATIVES = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) for x in embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
           list_dot_product(a.v, r.v)::BIGINT AS score
    FROM rows a JOIN rows r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
