"""DuckDB statements that the pN_ queries must agree with, where SQL can express them."""

_CURRENT = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY updated_at DESC NULLS LAST, line_no DESC NULLS LAST) AS rn FROM manifest_entries WHERE image_id IS NOT NULL) WHERE rn = 1"
_CURRENT_CAPTIONS = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY created_at DESC NULLS LAST, caption_id DESC NULLS LAST) AS rn FROM captions WHERE image_id IS NOT NULL) WHERE rn = 1"
_SCORE = """CASE WHEN qc_metrics.laplacian_variance > 0 AND NOT isnan(qc_metrics.laplacian_variance) THEN
  coalesce(CASE WHEN width > 0 AND height > 0 THEN width::DOUBLE * height::DOUBLE / 1000000 END, CASE WHEN megapixels > 0 AND NOT isnan(megapixels) THEN megapixels END)
  * (qc_metrics.laplacian_variance / 100) END"""

_TERMS = f"""
WITH cur AS ({_CURRENT}), cap AS ({_CURRENT_CAPTIONS}),
el AS (SELECT 'context_tags' AS dimension, image_id, unnest(context_tags) AS e FROM cur
  UNION ALL SELECT 'style', image_id, style FROM cap UNION ALL SELECT 'location', image_id, location FROM cap UNION ALL SELECT 'pose', image_id, pose FROM cap),
parts AS (SELECT dimension, image_id, unnest(regexp_split_to_array(e, '[,;|]')) AS p FROM el WHERE e IS NOT NULL),
blanks AS (SELECT dimension, image_id, trim(regexp_replace(replace(nfc_normalize(lower(nfc_normalize(p))), chr(160), ' '), '[\\s_-]+', ' ', 'g')) AS t FROM parts),
terms AS (SELECT dimension, image_id, trim(regexp_replace(regexp_replace(t, '^[# ]+', ''), '[.,;:!? ]+$', '')) AS term FROM blanks),
ok AS (SELECT * FROM terms WHERE term <> ''),
n AS (SELECT dimension, count(DISTINCT image_id) AS n FROM ok GROUP BY 1),
f AS (SELECT dimension, term, count(*) AS occurrences, count(DISTINCT image_id) AS records FROM ok GROUP BY 1, 2),
m AS (SELECT dimension, term, occurrences, records, CASE WHEN records <= 2 THEN 'rare' WHEN records / n > 0.3 THEN 'common' END AS mark FROM f JOIN n USING (dimension))
"""

_SETS = f"""
WITH cur AS ({_CURRENT}),
t AS (SELECT image_id, {_SCORE} AS score, coalesce(regexp_replace(lower(category), '[\\s_-]+', '', 'g'), '') AS c,
  trim(regexp_replace(nfc_normalize(lower(replace(replace(replace(replace(context_title, '&amp;', '&'), '&#38;', '&'), '&eacute;', 'é'), chr(160), ' '))), '\\s+', ' ', 'g')) AS s FROM cur),
u AS (SELECT *, regexp_replace(s, '[ \\-–|,(\\[]*\\bpage \\d+( ?(of|/) ?\\d+)?[)\\]]?$', '') AS title FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY c, title ORDER BY score DESC NULLS LAST, image_id) AS k,
  title IS NULL OR title IN ('', 'untitled', 'unknown', 'n/a', '-') AS no_set FROM u)
"""

_CLUSTERS = f"""
WITH cur AS ({_CURRENT}), st AS (SELECT lower(trim(source)) AS s, max(trust) AS trust FROM source_trust GROUP BY 1),
x AS (SELECT phash_cluster_id, image_id, updated_at, megapixels, qc_metrics, {_SCORE} AS score, coalesce(trust, -1) AS trust,
  (qc_metrics.laplacian_variance IS NOT NULL AND qc_metrics.laplacian_variance > 0 AND NOT isnan(qc_metrics.laplacian_variance))::INT
  + (qc_metrics.has_watermark IS NOT NULL)::INT + (qc_metrics.watermark_confidence IS NOT NULL)::INT AS complete
  FROM cur LEFT JOIN st ON st.s = lower(trim(source)) WHERE phash_cluster_id IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY phash_cluster_id ORDER BY score DESC NULLS LAST, updated_at DESC NULLS LAST, image_id) AS a,
  row_number() OVER (PARTITION BY phash_cluster_id ORDER BY complete DESC, trust DESC, updated_at DESC NULLS LAST, image_id) AS b,
  count(*) OVER (PARTITION BY phash_cluster_id) AS n FROM x)
"""

ORACLES = {
    "p1_found": _TERMS + "SELECT dimension, term, mark FROM m WHERE mark IS NOT NULL",
    "p1_frequencies": _TERMS + "SELECT dimension, term, occurrences, records, mark FROM m",
    "p2_found": _SETS + "SELECT image_id FROM r WHERE NOT no_set AND k > 20",
    "p2_capped": _SETS + "SELECT image_id FROM r WHERE no_set OR k <= 20",
    "p3_found": f"""
WITH RECURSIVE cur AS ({_CURRENT}), img AS (SELECT lower(trim(image_id)) AS id, ('0x' || phash)::UBIGINT AS h FROM cur),
p AS (SELECT lower(trim(image_id_a, ' ' || chr(9) || chr(10) || chr(13) || chr(160))) AS a, lower(trim(image_id_b, ' ' || chr(9) || chr(10) || chr(13) || chr(160))) AS b, hamming FROM match_pairs),
e AS (SELECT a, b FROM p JOIN img x ON x.id = a JOIN img y ON y.id = b WHERE a <> b AND coalesce(hamming, bit_count(xor(x.h, y.h))) <= 6),
links AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
walk(id, g) AS (SELECT a, a FROM links UNION SELECT links.b, walk.g FROM walk JOIN links ON links.a = walk.id)
SELECT id AS image_id, min(g) AS group_id FROM walk GROUP BY id""",
    "p4_found": _CLUSTERS + "SELECT phash_cluster_id, max(image_id) FILTER (a = 1) AS image_id, max(image_id) FILTER (b = 1) AS qc_image_id FROM r WHERE n >= 2 GROUP BY 1",
    "p4_records": _CLUSTERS
    + """SELECT i.phash_cluster_id, i.image_id, i.megapixels, q.qc_metrics.laplacian_variance AS laplacian_variance, q.qc_metrics.has_watermark AS has_watermark,
  q.qc_metrics.watermark_confidence AS watermark_confidence FROM r i JOIN r q USING (phash_cluster_id) WHERE i.a = 1 AND q.b = 1 AND i.n >= 2""",
}
ORACLES["p3_blocks"] = ORACLES["p3_found"]
