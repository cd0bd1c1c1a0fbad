"""Queries over the driver's tables, one or more per operator, each beside the SQL it must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.functions import compliance, json_repair, scalars
from curatrix.functions import html as pages
from curatrix.operators import balance, components, dedup, fingerprint, gates, select, stages
from curatrix.operators.state import latest_rows
from curatrix.plans import reports
from curatrix.session import checkpoint_dir, cut_lineage
from curatrix.sources import manifest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _items(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Current manifest rows with the columns asked for."""
    return latest_rows(_t(spark, d, "manifest_entries"), "image_id", ["updated_at", "line_no"], {c: c for c in columns})


_CUR = "cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY updated_at DESC NULLS LAST, line_no DESC NULLS LAST) AS rn FROM manifest_entries WHERE image_id IS NOT NULL) WHERE rn = 1)"
_CAP = "cap AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY created_at DESC NULLS LAST, caption_id DESC NULLS LAST) AS rn FROM captions WHERE image_id IS NOT NULL) WHERE rn = 1)"


def _words_sql(c: str) -> str:
    blank = r"[\s\x{00A0}\x{0085}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1680}\v]+"
    return f"coalesce(len(list_filter(regexp_split_to_array({c}, '{blank}'), lambda x: x <> '')), 0)"


def _tokens_sql(c: str) -> str:
    signs = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]"
    return f"coalesce(greatest(floor({_words_sql(c)} * 1.35::DOUBLE)::INT, len(regexp_extract_all({c}, '{signs}'))), 0)"


_HALF_EVEN = "(q + ((2*r > d) OR (2*r = d AND q % 2 = 1))::INT) / 1000.0"


# --- state -------------------------------------------------------------------------------------


@_query("SELECT reason, count(*) AS n FROM (SELECT unnest(rejection_reasons) AS reason FROM manifest_entries) WHERE reason IS NOT NULL GROUP BY 1")
def q_reason_histogram(spark, d):
    return balance.reason_histogram(_t(spark, d, "manifest_entries"))


@_query("SELECT line_no, coalesce(len(rejection_reasons) > 0, false) OR coalesce(stages_status['stage2_qc'] = 'rejected', false) OR coalesce(stages_status['stage4_caption'] = 'rejected_screening', false) AS rejected FROM manifest_entries")
def q_is_rejected(spark, d):
    rules = {"stage2_qc": ("rejected",), "stage4_caption": ("rejected_screening",)}
    return _t(spark, d, "manifest_entries").select("line_no", stages.is_rejected(F.col("stages_status"), F.col("rejection_reasons"), rules).alias("rejected"))


@_query("SELECT e.key AS stage, e.value AS status, count(*) AS n FROM (SELECT unnest(map_entries(stages_status)) AS e FROM manifest_entries) GROUP BY 1, 2")
def q_stage_status_counts(spark, d):
    return balance.stage_status_counts(_t(spark, d, "manifest_entries"))


@_query(
    """SELECT e.key AS stage, count(*) FILTER (e.value = 'pending') AS pending, count(*) FILTER (e.value IN ('passed','downloaded','done','captioned','exported')) AS ok,
    count(*) FILTER (e.value IN ('rejected','rejected_screening','failed')) AS rejected, count(*) FILTER (e.value = 'skipped') AS skipped
    FROM (SELECT unnest(map_entries(stages_status)) AS e FROM manifest_entries) GROUP BY 1"""
)
def q_status_pivot(spark, d):
    s = _t(spark, d, "manifest_entries").select(F.explode("stages_status").alias("stage", "status"))
    n = lambda *v: F.count_if(F.col("status").isin(*v))
    return s.groupBy("stage").agg(
        n("pending").alias("pending"), n("passed", "downloaded", "done", "captioned", "exported").alias("ok"), n("rejected", "rejected_screening", "failed").alias("rejected"), n("skipped").alias("skipped")
    )


@_query(f"WITH {_CUR} SELECT image_id, line_no, source_url, updated_at::TIMESTAMP AS updated_at FROM cur")
def q_latest_state(spark, d):
    return _items(spark, d, "line_no", "source_url", "updated_at")


@_query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def q_latest_event_upsert(spark, d):
    return latest_rows(_t(spark, d, "events"), "user_id", ["ts", "event_id"], {"event_type": "event_type", "value": "value"})


@_query("SELECT source_url, arg_max(image_id, line_no) AS image_id FROM manifest_entries WHERE source_url IS NOT NULL GROUP BY 1")
def q_url_lookup(spark, d):
    return latest_rows(_t(spark, d, "manifest_entries"), "source_url", ["line_no"], {"image_id": "image_id"})


@_query("SELECT image_id, count(*) AS rows FROM captions c WHERE NOT EXISTS (SELECT 1 FROM manifest_entries m WHERE m.image_id = c.image_id) AND image_id IS NOT NULL GROUP BY 1")
def q_unknown_items_anti(spark, d):
    caps = _t(spark, d, "captions").where(F.col("image_id").isNotNull())
    return caps.join(_t(spark, d, "manifest_entries").select("image_id"), "image_id", "left_anti").groupBy("image_id").agg(F.count(F.lit(1)).alias("rows"))


@_query("SELECT line_no, list_filter(rejection_reasons, lambda x: NOT (starts_with(x, 'min_edge_below_') OR starts_with(x, 'duplicate_phash_') OR x = 'blurry_laplacian_low')) AS kept FROM manifest_entries")
def q_reason_clear(spark, d):
    return _t(spark, d, "manifest_entries").select("line_no", gates.clear_reasons(F.col("rejection_reasons"), ["min_edge_below_", "duplicate_phash_"], ["blurry_laplacian_low"]).alias("kept"))


@_query("SELECT regexp_replace(regexp_replace(reason, '^duplicate_phash_.*', 'duplicate_phash'), '_[0-9.]+$', '') AS family, count(*) AS n FROM (SELECT unnest(rejection_reasons) AS reason FROM manifest_entries) WHERE reason IS NOT NULL GROUP BY 1")
def q_reason_families(spark, d):
    r = _t(spark, d, "manifest_entries").select(F.explode("rejection_reasons").alias("reason")).where(F.col("reason").isNotNull())
    family = F.regexp_replace(F.regexp_replace("reason", "^duplicate_phash_.*", "duplicate_phash"), "_[0-9.]+$", "")
    return r.groupBy(family.alias("family")).agg(F.count(F.lit(1)).alias("n"))


# --- gates -------------------------------------------------------------------------------------


@_query(
    """SELECT line_no, coalesce(width > 0 AND height > 0, false) AND coalesce(width::DOUBLE * height / 1e6, 0) >= 0.7 AS accepted,
    CASE WHEN width > 0 AND height > 0 THEN width::DOUBLE * height / 1e6 ELSE 0.0 END AS mp FROM manifest_entries"""
)
def q_megapixel_gate(spark, d):
    ok, mp = gates.resolution_gate(F.col("width"), F.col("height"), 0.7)
    return _t(spark, d, "manifest_entries").select("line_no", ok.alias("accepted"), mp.alias("mp"))


@_query(
    """SELECT line_no, list_filter([CASE WHEN least(width, height) < 1080 AND width IS NOT NULL AND height IS NOT NULL OR coalesce(width, height) < 1080 AND (width IS NULL OR height IS NULL) THEN 'min_edge_below_1080' END,
    CASE WHEN lap < 100 THEN 'blurry_laplacian_low' END, CASE WHEN qc_metrics.has_watermark THEN 'watermark_detected_unspecified' END], lambda x: x IS NOT NULL) AS reasons
    FROM (SELECT *, CASE WHEN NOT isnan(qc_metrics.laplacian_variance) THEN qc_metrics.laplacian_variance END AS lap FROM manifest_entries)"""
)
def q_quality_reasons(spark, d):
    lap = F.when(~F.isnan("qc_metrics.laplacian_variance"), F.col("qc_metrics.laplacian_variance"))
    return _t(spark, d, "manifest_entries").select("line_no", gates.quality_reasons(F.col("width"), F.col("height"), lap, F.col("qc_metrics.has_watermark"), 1080).alias("reasons"))


@_query(
    r"""SELECT caption_id, list_filter([
    CASE WHEN age IS NULL THEN 'screening_invalid_age_value' END, CASE WHEN age < 25 THEN 'screening_age_under_25' END,
    CASE WHEN coalesce(uncertain_age, true) THEN 'screening_uncertain_age' END, CASE WHEN coalesce(has_watermark, true) THEN 'screening_watermark_present' END,
    CASE WHEN coalesce(has_text, true) THEN 'screening_text_present' END, CASE WHEN coalesce(lower(trim(quality)) = 'low', true) THEN 'screening_low_quality' END,
    CASE WHEN NOT coalesce(provenance_verified, false) THEN 'screening_no_provenance' END], lambda x: x IS NOT NULL) AS reasons
    FROM (SELECT *, CASE WHEN regexp_matches(trim(subject_age_estimate), '^\d{1,3}$') THEN trim(subject_age_estimate)::INT END AS age FROM captions)"""
)
def q_screening(spark, d):
    c = [F.col(x) for x in ("subject_age_estimate", "uncertain_age", "has_watermark", "has_text", "quality", "provenance_verified")]
    return _t(spark, d, "captions").select("caption_id", gates.screening_reasons(*c).alias("reasons"))


@_query(
    r"""SELECT caption_id, CASE WHEN style IS NULL OR location IS NULL OR pose IS NULL OR description IS NULL
      THEN 'missing:' || array_to_string(list_filter([CASE WHEN style IS NULL THEN 'style' END, CASE WHEN location IS NULL THEN 'location' END, CASE WHEN pose IS NULL THEN 'pose' END, CASE WHEN description IS NULL THEN 'description' END], lambda x: x IS NOT NULL), ',')
      WHEN length(trim(description)) < 25 THEN 'short:' || length(trim(description))
      WHEN regexp_matches(trim(description), '(?i)\bi (cannot|can''t|am unable to|won''t)\b') OR regexp_matches(trim(description), '(?i)\bas an ai\b') OR regexp_matches(trim(description), '(?i)^i''?m sorry\b') THEN 'refusal' END AS reason FROM captions"""
)
def q_caption_validity(spark, d):
    need = {c: F.col(c) for c in ("style", "location", "pose", "description")}
    return _t(spark, d, "captions").select("caption_id", gates.invalid_reason(F.col("description"), need).alias("reason"))


@_query("SELECT count(*) AS n, count(*) FILTER (stages_status['stage2_qc'] = 'passed') AS qc_passed, count(*) FILTER (stages_status['stage4_caption'] = 'captioned') AS captioned, count(*) FILTER (len(rejection_reasons) > 0) AS with_reasons FROM manifest_entries")
def q_diagnostics(spark, d):
    s = F.col("stages_status")
    return _t(spark, d, "manifest_entries").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(s["stage2_qc"] == "passed").alias("qc_passed"), F.count_if(s["stage4_caption"] == "captioned").alias("captioned"), F.count_if(F.size("rejection_reasons") > 0).alias("with_reasons")
    )


# --- scalars -----------------------------------------------------------------------------------

_SIZE = "greatest(16, (round_even({0} * least(1.0::DOUBLE, 2048.0::DOUBLE / greatest(width, height)) / 16, 0) * 16)::INT)"


@_query(f"SELECT line_no, CASE WHEN width > 0 AND height > 0 THEN {_SIZE.format('width')} END AS w, CASE WHEN width > 0 AND height > 0 THEN {_SIZE.format('height')} END AS h FROM manifest_entries")
def q_downscale_dims(spark, d):
    w, h = scalars.downscaled(F.col("width"), F.col("height"))
    return _t(spark, d, "manifest_entries").select("line_no", w.alias("w"), h.alias("h"))


@_query(
    f"""WITH g AS (SELECT line_no, CASE WHEN width > 0 AND height > 0 THEN width::BIGINT END AS w, CASE WHEN width > 0 AND height > 0 THEN height::BIGINT END AS h FROM manifest_entries)
    SELECT a.line_no, a.ar, m.mp FROM
    (SELECT line_no, {_HALF_EVEN} AS ar FROM (SELECT line_no, h AS d, (w * 1000) // h AS q, (w * 1000) % h AS r FROM g)) a
    JOIN (SELECT line_no, {_HALF_EVEN} AS mp FROM (SELECT line_no, 1000000 AS d, (w * h * 1000) // 1000000 AS q, (w * h * 1000) % 1000000 AS r FROM g)) m USING (line_no)"""
)
def q_geometry(spark, d):
    w, h = F.col("width"), F.col("height")
    return _t(spark, d, "manifest_entries").select("line_no", scalars.aspect_ratio(w, h).alias("ar"), scalars.megapixels(w, h).alias("mp"))


@_query(f"SELECT doc_id, {_words_sql('text')} AS words FROM documents")
def q_word_count(spark, d):
    return _t(spark, d, "documents").select("doc_id", scalars.word_count(F.col("text")).alias("words"))


@_query(f"SELECT caption_id, {_tokens_sql('caption_dense')} AS tokens, coalesce(trim(caption_dense) <> '' AND ({_tokens_sql('caption_dense')} > 150 OR {_words_sql('caption_dense')} >= 280), false) AS updated FROM captions")
def q_token_estimate(spark, d):
    """Tokens of every caption; the threshold is 150 instead of 400, as no caption of these tables is longer."""
    c, words, signs = F.col("caption_dense"), F.col("words"), F.col("signs")
    counted = _t(spark, d, "captions").select("caption_id", "caption_dense", scalars.word_count(c).alias("words"), scalars.sign_count(c).alias("signs"))
    return counted.select("caption_id", scalars.estimate_tokens(c, words, signs).alias("tokens"), scalars.already_updated(c, F.lit(False), 150, 280, words, signs).alias("updated"))


@_query("SELECT caption_id, CASE WHEN style IS NULL OR lower(style) = 'other' THEN '' ELSE trim(replace(style, '_', ' ')) END AS style_words FROM captions")
def q_humanize(spark, d):
    return _t(spark, d, "captions").select("caption_id", scalars.humanize_tag(F.col("style")).alias("style_words"))


@_query(
    r"""SELECT line_no, trim(regexp_replace(CASE WHEN b = '' THEN t WHEN t = '' OR starts_with(lower(b), lower(regexp_replace(t, '[, ]+$', ''))) THEN b
      ELSE t || CASE WHEN contains(b, ',') AND NOT starts_with(b, 'Photograph') THEN ', ' ELSE ' ' END || b END, '[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+', ' ', 'g')) AS caption
    FROM (SELECT line_no, coalesce(trim(trigger_word), '') AS t, coalesce(trim(caption_text), '') AS b FROM manifest_entries)"""
)
def q_assemble_dense(spark, d):
    none = F.lit(None).cast("string")
    return _t(spark, d, "manifest_entries").select("line_no", scalars.assemble_caption(F.col("trigger_word"), F.col("caption_text"), none, none, none, none).alias("caption"))


@_query(
    r"""SELECT caption_id, trim(regexp_replace(concat_ws(' ', 'look', CASE WHEN p <> '' THEN 'Set in a ' || p || '.' END,
      CASE WHEN coalesce(trim(description), '') <> '' THEN regexp_replace(trim(description), '[. ]+$', '') || '.' END,
      CASE WHEN coalesce(trim(lighting_camera), '') <> '' THEN regexp_replace(trim(lighting_camera), '[. ]+$', '') || '.' END), '[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+', ' ', 'g')) AS caption
    FROM (SELECT *, CASE WHEN location IS NULL OR lower(location) = 'other' THEN '' ELSE trim(replace(location, '_', ' ')) END AS p FROM captions)"""
)
def q_assemble_parts(spark, d):
    c = {x: F.col(x) for x in ("style", "location", "description", "lighting_camera")}
    text = scalars.assemble_caption(F.lit("look"), F.lit(None).cast("string"), c["style"], c["location"], c["description"], c["lighting_camera"])
    return _t(spark, d, "captions").select("caption_id", text.alias("caption"))


@_query("SELECT line_no, coalesce(nullif(trigger_word, ''), CASE WHEN category <> '' THEN replace('{category} look', '{category}', category) ELSE '{category} look' END) AS trigger FROM manifest_entries")
def q_resolve_trigger(spark, d):
    return _t(spark, d, "manifest_entries").select("line_no", scalars.resolve_trigger(F.col("trigger_word"), F.lit("{category} look"), F.col("category"), "set", "plain").alias("trigger"))


@_query(r"SELECT line_no, nullif(regexp_extract(caption_text, '^([a-z0-9]+_[a-z0-9_]+)\s*,', 1), '') AS trigger FROM manifest_entries")
def q_leading_trigger(spark, d):
    return _t(spark, d, "manifest_entries").select("line_no", scalars.leading_trigger(F.col("caption_text")).alias("trigger"))


_KEY = r"""lower(coalesce(nullif(regexp_extract({0}, '^([0-9a-fA-F]{{8,64}})', 1), ''), nullif(trim(string_split_regex({0}, '(?i)\.(?:jpe?g|png|webp|bmp)')[1]), ''), regexp_replace({0}, '(.)\.[^.]*$', '\1')))"""


@_query(f"SELECT line_no, {_KEY.format('a')} AS key, {_KEY.format('b')} AS title_key FROM (SELECT line_no, string_split(raw_path, '/')[-1] AS a, string_split('sets/' || context_title || '.JPG', '/')[-1] AS b FROM manifest_entries)")
def q_hash_key(spark, d):
    """Keys of the paths, which lead with hex digits, and of paths made of the titles, which don't."""
    titled = F.concat(F.lit("sets/"), F.col("context_title"), F.lit(".JPG"))
    return _t(spark, d, "manifest_entries").select("line_no", scalars.hash_key(F.col("raw_path")).alias("key"), scalars.hash_key(titled).alias("title_key"))


@_query(
    r"""SELECT line_no, nullif(lower(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)), '') AS host,
    lower(regexp_extract(regexp_replace(regexp_replace(source_url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '[^/](\.[A-Za-z0-9]+)$', 1)) AS suffix,
    nullif(lower(regexp_extract(page_url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)), '') AS page_host FROM manifest_entries"""
)
def q_url_parts(spark, d):
    u = F.col("source_url")
    return _t(spark, d, "manifest_entries").select("line_no", scalars.url_host(u).alias("host"), scalars.url_suffix(u).alias("suffix"), scalars.url_host(F.col("page_url")).alias("page_host"))


_NAME = r"""coalesce(nullif(left(regexp_replace(regexp_replace(regexp_replace(url_decode({0}), '[\\/*?:"<>|]', '_', 'g'), '[\s\x{{00A0}}]+', ' ', 'g'), '^[. ]+|[. ]+$', '', 'g'), 40), ''), 'item')"""


@_query(f"SELECT line_no, {_NAME.format('context_title')} AS name, {_NAME.format('joined')} AS joined_name FROM (SELECT *, context_title || '%2F' || category || '%20set' AS joined FROM manifest_entries)")
def q_sanitize_name(spark, d):
    """Names of all titles, and of titles with percent escapes put in, among them an escaped path separator."""
    t = F.col("context_title")
    joined = F.concat(t, F.lit("%2F"), F.col("category"), F.lit("%20set"))
    return _t(spark, d, "manifest_entries").select("line_no", scalars.sanitize_name(t, 40).alias("name"), scalars.sanitize_name(joined, 40).alias("joined_name"))


@_query(
    """SELECT line_no, concat(a, '-', b, ', ', c) AS spec, list_sort(list_distinct(list_concat(range(least(a, b), greatest(a, b) + 1), [c])))::INT[] AS pages
    FROM (SELECT line_no, line_no % 9 + 1 AS a, line_no % 4 + 1 AS b, line_no % 13 + 1 AS c FROM manifest_entries)"""
)
def q_page_range(spark, d):
    n = F.col("line_no")
    spec = F.concat(n % 9 + 1, F.lit("-"), n % 4 + 1, F.lit(", "), n % 13 + 1)
    return _t(spark, d, "manifest_entries").select("line_no", spec.alias("spec")).select("line_no", "spec", scalars.page_numbers(F.col("spec"), F.lit(4)).alias("pages"))


@_query("SELECT line_no, CASE WHEN line_no % 3 = 0 THEN page_url || '?page=' || (line_no % 5 + 2) WHEN line_no % 5 = 0 THEN page_url ELSE page_url || '?page=' || (line_no % 5 + 1) END AS url FROM manifest_entries")
def q_page_url(spark, d):
    """Addresses of numbered pages: the number replaced where the base has one, else appended; page 1 is the base."""
    n, u = F.col("line_no"), F.col("page_url")
    base, page = F.when(n % 3 == 0, F.concat(u, F.lit("?page=99"))).otherwise(u), n % 5 + F.when(n % 3 == 0, 2).otherwise(1)
    return _t(spark, d, "manifest_entries").select("line_no", scalars.page_url(base, page).alias("url"))


@_query("SELECT line_no, sha256(caption_text) AS full_id, left(sha256(caption_text), 16) AS short_id FROM manifest_entries")
def q_content_id(spark, d):
    c = F.col("caption_text").cast("binary")
    return _t(spark, d, "manifest_entries").select("line_no", scalars.content_id(c).alias("full_id"), scalars.content_id(c, 16).alias("short_id"))


@_query(
    """WITH x AS (SELECT line_no, caption_data AS t, nullif(regexp_extract(caption_data, '(?s)```(?:json)?\\s*(\\{.*?\\})\\s*```', 1), '') AS f, nullif(regexp_extract(caption_data, '(?s)(\\{.*\\})', 1), '') AS b FROM manifest_entries),
    j AS (SELECT line_no, CASE WHEN f IS NOT NULL AND json_valid(f) THEN f WHEN json_valid(t) THEN t WHEN b IS NOT NULL AND json_valid(b) THEN b END AS j FROM x)
    SELECT line_no, j IS NOT NULL AS parsed, nullif(trim(j->>'style'), '') AS style, nullif(trim(j->>'pose'), '') AS pose FROM j"""
)
def q_json_extract(spark, d):
    j = json_repair.extract_object(F.col("caption_data"))
    rows = _t(spark, d, "manifest_entries").select("line_no", j.alias("j"))
    return rows.select("line_no", F.col("j").isNotNull().alias("parsed"), json_repair.field(F.col("j"), "style").alias("style"), json_repair.field(F.col("j"), "pose").alias("pose"))


@_query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def q_json_prefilled(spark, d):
    cut = F.substring(F.col("props"), F.lit(2), F.length("props"))
    return _t(spark, d, "events").select("event_id", json_repair.field(json_repair.repair_prefilled(cut), "k").try_cast("int").alias("k"))


@_query(
    """WITH v AS (SELECT dimension, term FROM vocabulary), c AS (SELECT caption_id, lower(regexp_replace(trim(style), '[ _-]+', '_', 'g')) AS s FROM captions)
    SELECT caption_id, CASE WHEN s IN (SELECT term FROM v WHERE dimension = 'style') THEN s ELSE 'other' END AS style FROM c"""
)
def q_vocabulary_validation(spark, d):
    # The vocabulary is configuration of fixed size.
    return gates.within_vocabulary(_t(spark, d, "captions"), _t(spark, d, "vocabulary"), {"style": "other"}).select("caption_id", "style")


def _term_sql(column: str, default: str) -> str:
    folded = f"lower(regexp_replace(trim({column}), '[ _-]+', '_', 'g'))"
    return f"CASE WHEN {folded} IN (SELECT term FROM vocabulary WHERE dimension = '{column}') THEN {folded} ELSE {default} END AS {column}"


@_query(f"""SELECT caption_id, {_term_sql("style", "'other'")}, {_term_sql("location", "'other'")}, {_term_sql("pose", "'other'")}, {_term_sql("quality", "NULL")} FROM captions""")
def q_vocabulary_dimensions(spark, d):
    # Quality has no 'other': a grade outside the vocabulary is unknown.
    defaults = {"style": "other", "location": "other", "pose": "other", "quality": None}
    return gates.within_vocabulary(_t(spark, d, "captions"), _t(spark, d, "vocabulary"), defaults).select("caption_id", *defaults)


@_query(
    r"""SELECT line_no, trim(regexp_replace(regexp_replace(regexp_replace(context_title, '[\s\x{00A0}]+\|[^|]*$', ''), '(?i)[\s\x{00A0}]*[-–|,]?[\s\x{00A0}]*[\(\[]?\bpage[\s\x{00A0}]+\d+.*$', ''), '[\s\x{00A0}]+', ' ', 'g')) AS title
    FROM manifest_entries"""
)
def q_clean_title(spark, d):
    return _t(spark, d, "manifest_entries").select("line_no", scalars.clean_title(F.col("context_title")).alias("title"))


@_query(
    """SELECT line_no, list_filter(c, lambda x, i: list_position(list_transform(c, lambda y: lower(y)), lower(x)) = i) AS tags
    FROM (SELECT line_no, list_filter(list_transform(context_tags, lambda x: trim(x)), lambda x: x IS NOT NULL AND x <> '') AS c FROM manifest_entries)"""
)
def q_distinct_tags(spark, d):
    """The tags of every row; null elements are no tags, a null list stays null."""
    return _t(spark, d, "manifest_entries").select("line_no", scalars.distinct_ignoring_case(F.col("context_tags")).alias("tags"))


# --- duplicates --------------------------------------------------------------------------------


@_query(f"SELECT {_KEY.format('a')} AS key, count(*) AS members, min(line_no) AS line_no FROM (SELECT line_no, string_split(raw_path, '/')[-1] AS a FROM manifest_entries WHERE raw_path IS NOT NULL) GROUP BY 1")
def q_exact_groups(spark, d):
    """Groups of rows whose file names hold the same identity, each with its first row; a row without a path has none."""
    rows = _t(spark, d, "manifest_entries").where("raw_path is not null").select("line_no", scalars.hash_key(F.col("raw_path")).alias("key"))
    return dedup.best_of(rows, ["key"], [F.col("line_no")], ["line_no"])


_RANK = rf"(raw_path LIKE '.%/%' OR raw_path LIKE '%/.%/%')::INT, regexp_matches(raw_path, '(?i)\.(jpe?g|png|webp|bmp)\.(jpe?g|png|webp|bmp)$')::INT, -{_words_sql('caption_text')}, length(string_split(raw_path, '/')[-1]), length(raw_path), raw_path, line_no"


@_query(f"SELECT image_id, raw_path, line_no, members FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY {_RANK}) AS rn, count(*) OVER (PARTITION BY image_id) AS members FROM manifest_entries WHERE raw_path IS NOT NULL) WHERE rn = 1")
def q_primary_ranking(spark, d):
    rows = _t(spark, d, "manifest_entries").where("raw_path is not null").select("image_id", "raw_path", "line_no", "caption_text")
    rank = [*dedup.primary_rank(F.col("raw_path"), F.col("caption_text")), F.col("line_no")]
    return dedup.best_of(rows, ["image_id"], rank, ["raw_path", "line_no"])


@_query(f"SELECT image_id, arg_max(caption_dense, ({_words_sql('caption_dense')}, -caption_id)) AS best_caption FROM captions WHERE trim(caption_dense) <> '' AND ({_tokens_sql('caption_dense')} > 150 OR {_words_sql('caption_dense')} >= 280) AND image_id IS NOT NULL GROUP BY 1")
def q_best_caption_in_group(spark, d):
    c = _t(spark, d, "captions").where("image_id is not null")
    return dedup.best_updated_caption(c, "image_id", "caption_dense", F.lit(False), "caption_id", 150)


@_query(
    """SELECT m.doc_id, p.doc_id AS primary_id FROM documents m JOIN (SELECT text, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY 1) p USING (text)"""
)
def q_dedup_fanout(spark, d):
    rows = _t(spark, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("key"))
    primaries = dedup.best_of(rows, ["key"], [F.col("doc_id")], ["doc_id"]).select("key", F.col("doc_id").alias("primary_id"))
    return dedup.fan_out(rows, primaries, "key").select("doc_id", "primary_id")


_BITS = """b AS (SELECT vec_id, embedding AS e, list_sort(embedding) AS s FROM embeddings), m AS (SELECT vec_id, e, (s[32]::DOUBLE + s[33]::DOUBLE) / 2 AS md FROM b),
f AS (SELECT vec_id, list_aggregate(list_transform(e[1:32], lambda x, i: CASE WHEN x::DOUBLE > md THEN 1::BIGINT << (32 - i)::INT ELSE 0 END), 'sum')::BIGINT AS hi,
  list_aggregate(list_transform(e[33:64], lambda x, i: CASE WHEN x::DOUBLE > md THEN 1::BIGINT << (32 - i)::INT ELSE 0 END), 'sum')::BIGINT AS lo FROM m)"""


def _prints(spark, d):
    hi, lo = fingerprint.median_bits(F.col("embedding"))
    return _t(spark, d, "embeddings").select("vec_id", hi.alias("hi"), lo.alias("lo"))


@_query(f"WITH {_BITS} SELECT vec_id, hi, lo FROM f")
def q_fingerprint(spark, d):
    return _prints(spark, d)


_NEAR = f"WITH {_BITS} SELECT a.vec_id AS a, b.vec_id AS b, (bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)))::INT AS distance FROM f a JOIN f b ON a.vec_id < b.vec_id WHERE bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= "


@_query(_NEAR + "18")
def q_hamming_pairs_t18(spark, d):
    return fingerprint.hamming_pairs(_prints(spark, d), "vec_id", "hi", "lo", 18)


def _phashes(spark, d):
    rows = _items(spark, d, "phash")
    hi, lo = scalars.hash_halves(F.col("phash"))
    return rows.select("image_id", hi.alias("hi"), lo.alias("lo")).where(F.col("hi").isNotNull())


_PH = f"WITH {_CUR}, f AS (SELECT min(image_id) AS id, h FROM (SELECT image_id, ('0x' || phash)::UBIGINT AS h FROM cur WHERE phash IS NOT NULL) GROUP BY h)"


@_query(f"{_PH} SELECT a.id AS a, b.id AS b, bit_count(xor(a.h, b.h))::INT AS distance FROM f a JOIN f b ON a.id < b.id WHERE bit_count(xor(a.h, b.h)) <= 6")
def q_hamming_pairs_t6(spark, d):
    return fingerprint.hamming_pairs(_phashes(spark, d), "image_id", "hi", "lo", 6)


@_query(
    f"""WITH RECURSIVE {_CUR}, h AS (SELECT image_id AS id, ('0x' || phash)::UBIGINT AS h FROM cur WHERE phash IS NOT NULL), r AS (SELECT min(id) AS id, h FROM h GROUP BY h),
    e AS (SELECT a.id AS a, b.id AS b FROM r a JOIN r b ON a.id <> b.id WHERE bit_count(xor(a.h, b.h)) <= 6 UNION SELECT h.id, r.id FROM h JOIN r USING (h) WHERE h.id <> r.id UNION SELECT r.id, h.id FROM h JOIN r USING (h) WHERE h.id <> r.id),
    w(id, c) AS (SELECT a, a FROM e UNION SELECT e.b, w.c FROM w JOIN e ON e.a = w.id) SELECT id, min(c) AS component FROM w GROUP BY id"""
)
def q_near_duplicate_components(spark, d):
    prints = cut_lineage(_phashes(spark, d))
    pairs = fingerprint.hamming_pairs(prints, "image_id", "hi", "lo", 6).select("a", "b").union(fingerprint.class_links(prints, "image_id", "hi", "lo"))
    return components.connected_components(pairs)


@_query(
    """SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[64], b.embedding::DOUBLE[64]), 6) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
    WHERE list_cosine_similarity(a.embedding::DOUBLE[64], b.embedding::DOUBLE[64]) >= 0.4"""
)
def q_cosine_pairs(spark, d):
    return fingerprint.cosine_pairs(_t(spark, d, "embeddings"), "vec_id", "embedding", 0.4, 64).select("a", "b", F.round("cosine", 6).alias("cosine"))


_SCORE_SQL = "CASE WHEN isnan(qc_metrics.laplacian_variance) THEN NULL ELSE coalesce(nullif(megapixels, 0), 1.0) * (coalesce(qc_metrics.laplacian_variance, 100.0) / 100) END"


def _score():
    lap = F.col("qc_metrics.laplacian_variance")
    return F.when(~F.coalesce(F.isnan(lap), F.lit(False)), scalars.quality_score(F.col("megapixels"), lap))


@_query(f"WITH {_CUR} SELECT phash_cluster_id, image_id, members FROM (SELECT *, row_number() OVER (PARTITION BY phash_cluster_id ORDER BY coalesce({_SCORE_SQL}, -1e300) DESC, image_id) AS k, count(*) OVER (PARTITION BY phash_cluster_id) AS members FROM cur WHERE phash_cluster_id IS NOT NULL) WHERE k = 1")
def q_keep_best(spark, d):
    rows = _items(spark, d, "phash_cluster_id", "megapixels", "qc_metrics").where("phash_cluster_id is not null").withColumn("score", _score())
    return dedup.best_of(rows, ["phash_cluster_id"], [-F.coalesce("score", F.lit(-1e300)), F.col("image_id")], ["image_id"])


# --- balance -----------------------------------------------------------------------------------


@_query(
    f"WITH {_CAP} "
    + " UNION ALL ".join(f"SELECT '{c}' AS dimension, coalesce({c}, 'other') AS value, count(*) AS n FROM cap GROUP BY 2" for c in ("style", "location", "pose"))
)
def q_distributions(spark, d):
    dims = ("style", "location", "pose")
    return balance.distributions(latest_rows(_t(spark, d, "captions"), "image_id", ["created_at", "caption_id"], {c: c for c in dims}), dims)


@_query("SELECT quality, engine, count(*) AS n FROM (SELECT coalesce(quality, 'other') AS quality, coalesce(engine, 'other') AS engine FROM captions) GROUP BY CUBE (quality, engine)")
def q_cross_tab(spark, d):
    return balance.cross_tab(_t(spark, d, "captions"), ["quality", "engine"])


@_query(
    """SELECT b.bucket, count(x.line_no) AS n FROM (VALUES ('1:1'), ('4:3'), ('16:9'), ('other')) b(bucket) LEFT JOIN
    (SELECT line_no, CASE WHEN r BETWEEN .95 AND 1.05 THEN '1:1' WHEN r BETWEEN .7 AND .8 OR r BETWEEN 1.25 AND 1.4 THEN '4:3' WHEN r BETWEEN .5 AND .65 OR r BETWEEN 1.7 AND 1.85 THEN '16:9' ELSE 'other' END AS bucket
     FROM (SELECT line_no, coalesce(nullif(aspect_ratio, 0), 1.0) AS r FROM manifest_entries)) x ON x.bucket = b.bucket GROUP BY 1"""
)
def q_aspect_buckets(spark, d):
    return balance.aspect_histogram(_t(spark, d, "manifest_entries"))


@_query("SELECT value, n, round_even(n / t, 3) AS ratio FROM (SELECT coalesce(lang, 'unknown') AS value, count(*) AS n, sum(count(*)) OVER () AS t FROM documents GROUP BY 1) WHERE n / t > 0.1")
def q_dominance(spark, d):
    return balance.dominance(_t(spark, d, "documents"), "lang", 0.1)


@_query("SELECT lang, n, greatest(1, least(4, round_even(max(n) OVER () / n, 0)::INT)) AS repeats, n * greatest(1, least(4, round_even(max(n) OVER () / n, 0)::INT)) AS effective FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1)")
def q_balance_repeats(spark, d):
    return balance.repeats(_t(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")))


@_query(
    f"""SELECT engine, n, round_even(100.0::DOUBLE * n / sum(n) OVER (), 1) AS pct, w / n AS avg_words, floor(w / n * 1.35::DOUBLE)::BIGINT AS avg_tokens
    FROM (SELECT engine, count(*) AS n, sum({_words_sql('caption_dense')})::DOUBLE AS w FROM captions GROUP BY 1)"""
)
def q_tier_stats(spark, d):
    return balance.tier_stats(_t(spark, d, "captions"), "engine", scalars.word_count(F.col("caption_dense")))


# --- selection ---------------------------------------------------------------------------------


@_query(f"WITH {_CUR} SELECT image_id, {_SCORE_SQL} AS score FROM cur ORDER BY coalesce({_SCORE_SQL}, -1e300) DESC, image_id LIMIT 500")
def q_curated_top_n(spark, d):
    rows = _items(spark, d, "megapixels", "qc_metrics").select("image_id", _score().alias("score"))
    return select.top_n(rows, F.col("score"), 500, ["image_id"])


@_query(f"WITH {_CUR} SELECT category, image_id FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY created_at NULLS FIRST, image_id) AS k FROM cur) WHERE k <= 25")
def q_quota(spark, d):
    return select.quota(_items(spark, d, "category", "created_at"), "category", [F.col("created_at"), F.col("image_id")], 25).select("category", "image_id")


@_query(
    f"""WITH {_CUR}, r AS (SELECT context_title AS t, image_id, row_number() OVER (PARTITION BY context_title ORDER BY image_id) AS i, count(*) OVER (PARTITION BY context_title) AS n FROM cur)
    SELECT t AS context_title, image_id FROM r WHERE n > 2 AND CASE WHEN n - 2 <= 7 THEN i > 1 AND i < n ELSE list_contains(list_transform(range(7), lambda k: round_even(k * (n - 3)::DOUBLE / 6, 0)::BIGINT + 2), i) END"""
)
def q_even_sample(spark, d):
    return select.even_sample(_items(spark, d, "context_title"), "context_title", [F.col("image_id")]).select("context_title", "image_id")


@_query("SELECT doc_id, lang FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 200")
def q_hashed_sample(spark, d):
    return select.hashed_sample(_t(spark, d, "documents").select("doc_id", "lang"), "doc_id", 200, 7)


@_query("SELECT doc_id, i AS position, CASE WHEN (i * 7) % 100 < 30 THEN 'tags' WHEN (i * 7) % 100 < 70 THEN 'short' ELSE 'dense' END AS tier, i // 64 AS batch FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)")
def q_caption_tier(spark, d):
    rows = select.dense_positions(_t(spark, d, "documents").select("doc_id"), "doc_id")
    return rows.select("doc_id", "position", select.tier(F.col("position")).alias("tier"), select.batches(F.col("position"), 64).alias("batch"))


@_query(
    r"""WITH x AS (SELECT line_no, coalesce(source, '') AS f, coalesce(string_split(raw_path, '/')[-1], '') AS name FROM manifest_entries),
    e AS (SELECT *, lower(name) AS b, regexp_extract(name, '[^.](\.[^.]*)$', 1) AS ext, row_number() OVER (PARTITION BY f, lower(name) ORDER BY line_no) - 1 AS k FROM x),
    own AS (SELECT f, b, count(*) AS n FROM e GROUP BY 1, 2),
    p AS (SELECT f, b, regexp_extract(b, '[^.](\.[^.]*)$', 1) AS ext FROM own), q AS (SELECT f, b, ext, left(b, length(b) - length(ext)) AS stem FROM p),
    t AS (SELECT f, regexp_replace(stem, '_[1-9]\d{0,17}$', '') || ext AS b, regexp_extract(stem, '_([1-9]\d{0,17})$', 1)::BIGINT AS t FROM q WHERE regexp_matches(stem, '_[1-9]\d{0,17}$') AND NOT (regexp_matches(stem, '^_[1-9]\d{0,17}$') AND ext <> '')),
    s AS (SELECT f, b, list(t - i + 1) AS passed FROM (SELECT *, row_number() OVER (PARTITION BY f, b ORDER BY t) AS i FROM t) GROUP BY 1, 2)
    SELECT line_no, CASE WHEN k = 0 THEN name ELSE left(name, length(name) - length(ext)) || '_' || (k + coalesce(len(list_filter(passed, lambda z: z <= k)), 0)) || ext END AS unique_name
    FROM e LEFT JOIN s USING (f, b)"""
)
def q_unique_names(spark, d):
    rows = _t(spark, d, "manifest_entries").select("line_no", "source", F.element_at(F.split("raw_path", "/"), -1).alias("name"))
    return select.unique_names(rows, "source", "name", "line_no").select("line_no", "unique_name")


@_query(f"WITH {_CUR}, g AS (SELECT phash_cluster_id AS g, min(image_id) AS root FROM cur WHERE phash_cluster_id IS NOT NULL GROUP BY 1) SELECT g AS grp, printf('cluster_%04d', row_number() OVER (ORDER BY root)) AS label FROM g")
def q_cluster_labels(spark, d):
    roots = _items(spark, d, "phash_cluster_id").where("phash_cluster_id is not null").groupBy(F.col("phash_cluster_id").alias("grp")).agg(F.min("image_id").alias("root"))
    return select.dense_positions(roots, "root").select("grp", components.display_label(F.col("position") + 1).alias("label"))


@_query("SELECT a.w AS a_weight, b.w AS b_weight, printf('w%d_%d', (a.w * 100)::INT, (b.w * 100)::INT) AS cell FROM (VALUES (0.4::DOUBLE), (0.7), (1.0)) a(w), (VALUES (0.5::DOUBLE), (0.8)) b(w)")
def q_weight_matrix(spark, d):
    cells = select.grid({"a_weight": [0.4, 0.7, 1.0], "b_weight": [0.5, 0.8]}, spark)
    return cells.withColumn("cell", F.format_string("w%d_%d", F.round(F.col("a_weight") * 100).cast("int"), F.round(F.col("b_weight") * 100).cast("int")))


_TOP = "(SELECT term FROM vocabulary WHERE dimension = '{0}' AND term <> 'other' ORDER BY term LIMIT {1})"


@_query(
    f"""SELECT s.term AS style, l.term AS location, p.term AS pose, concat_ws(', ', 'look', replace(s.term, '_', ' '), replace(l.term, '_', ' '), replace(p.term, '_', ' ')) AS prompt
    FROM {_TOP.format('style', 4)} s, {_TOP.format('location', 3)} l, {_TOP.format('pose', 3)} p UNION ALL SELECT NULL, NULL, NULL, 'look'"""
)
def q_prompt_grid(spark, d):
    return select.prompt_grid(_t(spark, d, "vocabulary"), {"style": 4, "location": 3, "pose": 3}, "look")


@_query("SELECT line_no, CASE WHEN coalesce(width, 0)::BIGINT * coalesce(height, 0) + 1 >= 1000000 THEN source_url ELSE source_url || '?w=1000' END AS url FROM manifest_entries")
def q_best_variant(spark, d):
    """Of a row's original, a scaled copy and a clip: the static one with most pixels, the original on a tie."""
    u = F.col("source_url")
    variant = lambda url, kind, w, h, optimized: F.struct(url.alias("url"), F.lit(kind).alias("type"), w.alias("width"), h.alias("height"), F.lit(optimized).alias("isOptimized"))
    side = F.lit(1000)
    listed = F.array(variant(F.concat(u, F.lit(".mp4")), "MP4", F.lit(9999), F.lit(9999), False), variant(F.concat(u, F.lit("?w=1000")), "JPEG", side, side, True), variant(u, "JPEG", F.col("width"), F.col("height"), False))
    return _t(spark, d, "manifest_entries").select("line_no", scalars.best_variant(listed)["url"].alias("url"))


# --- pages -------------------------------------------------------------------------------------


@_query(
    """SELECT line_no, 0 AS position, 'a' AS kind, page_url AS address FROM manifest_entries WHERE page_url IS NOT NULL
    UNION ALL SELECT line_no, 1, 'img', source_url FROM manifest_entries WHERE page_url IS NOT NULL"""
)
def q_page_links(spark, d):
    """Links and pictures of a page made of each row's addresses, one of them relative and escaped."""
    path = F.regexp_replace("page_url", r"^[a-z]+://[^/]+", "")
    html = F.concat(F.lit("<div><A class=x HREF='"), F.replace(path, F.lit("/"), F.lit("&#47;")), F.lit("'>set<img alt=\"a > b\" src='thumb.gif' data-src=\""), F.col("source_url"), F.lit("\"></a><a name=top>"))
    rows = _t(spark, d, "manifest_entries").select("line_no", "page_url", html.alias("html"))
    return pages.extract_links(rows, "line_no", "html", "page_url")


@_query("SELECT DISTINCT page_url AS page, source_url AS address FROM manifest_entries WHERE page_url IS NOT NULL AND source_url IS NOT NULL")
def q_union_of_links(spark, d):
    """Every address found on a page once, however many of the page's copies hold it."""
    rows = _t(spark, d, "manifest_entries").select("page_url", F.concat(F.lit("<img src=\""), F.col("source_url"), F.lit("\">")).alias("html"))
    return pages.union_of_links(pages.extract_links(rows, "page_url", "html"), "page_url").select(F.col("page_url").alias("page"), "address")


@_query(
    """SELECT doc_id, CASE WHEN source LIKE 'b%' THEN 'header:tdm-reservation' WHEN doc_type = 'gallery_page' THEN 'header:x-robots-tag' WHEN lang = 'fr' THEN 'meta:tdm-reservation'
    WHEN lang = 'de' THEN 'meta:robots' END AS reason FROM documents"""
)
def q_reservation(spark, d):
    """Reservations in headers and metadata made of each document's columns; its whole text is the page's body."""
    has = lambda c, then, other: F.when(F.coalesce(c, F.lit(False)), then).otherwise(other)
    lang, text = F.col("lang"), F.coalesce("text", F.lit(""))
    headers = F.create_map(
        F.lit("Content-Type"), F.lit("text/html"), F.lit("TDM-Reservation"), has(F.col("source").like("b%"), "1", "0"), F.lit("X-Robots-Tag"), has(F.col("doc_type") == "gallery_page", "noai, noimageai", "all")
    )
    meta = F.concat(F.lit("<META NAME='robots' CONTENT='"), has(lang == "de", "index, NoAI", "index"), F.lit("'><meta content=\""), has(lang == "fr", "1", "0"), F.lit("\" name=\"tdm-reservation\">"), F.replace(text, F.lit("<"), F.lit("&lt;")))
    return _t(spark, d, "documents").select("doc_id", compliance.reservation(headers, meta).alias("reason"))


@_query(
    r"""SELECT line_no, CASE WHEN caption_text IS NULL THEN NULL ELSE trim(regexp_replace(caption_text, '"', '', 'g')) END AS bare FROM manifest_entries"""
)
def q_strip_fences(spark, d):
    """Captions wrapped in a code fence and quotes come out as they were."""
    plain = F.replace("caption_text", F.lit('"'), F.lit(""))
    return _t(spark, d, "manifest_entries").select("line_no", scalars.strip_fences(F.concat(F.lit('```json\n"'), F.trim(plain), F.lit('"\n```'))).alias("bare"))


@_query("SELECT line_no, coalesce(length(caption_text) >= 200, false) AS large, coalesce(source_url LIKE '%.jpg' AND NOT regexp_matches(source_url, '(?i)avatar|banner|smil(ey|ies)|logo'), false) AS picture FROM manifest_entries")
def q_payload_filters(spark, d):
    c = F.col("caption_text")
    return _t(spark, d, "manifest_entries").select("line_no", gates.least_bytes(c, 200).alias("large"), gates.is_picture_url(F.col("source_url")).alias("picture"))


@_query("SELECT line_no, list_sort(list_distinct(list_concat(coalesce(rejection_reasons, []), ['manual_review']))) AS reasons FROM manifest_entries")
def q_reason_append(spark, d):
    """One more reason on every row, never twice; the list as a sorted set."""
    return _t(spark, d, "manifest_entries").select("line_no", F.array_sort(F.array_distinct(gates.add_reasons(F.col("rejection_reasons"), F.array(F.lit("manual_review"))))).alias("reasons"))


@_query(
    f"""WITH {_CUR} SELECT coalesce(category, 'unknown') AS category, count(*) AS present, greatest(0, 100 - count(*)) AS missing FROM cur GROUP BY 1"""
)
def q_remaining_quota(spark, d):
    return balance.remaining_quota(_items(spark, d, "category"), "category", 100)


@_query(
    f"""SELECT count(*) AS found, count(*) FILTER (caption_dense IS NULL OR trim(caption_dense) = '') AS without_text, count(*) FILTER ({_words_sql('caption_dense')} >= 120) AS long_enough,
    count(*) FILTER (engine IS NULL) AS without_engine, count(DISTINCT image_id) AS images, count(*) FILTER (provenance_verified) AS verified FROM captions"""
)
def q_discovery_counters(spark, d):
    """Six counters over all annotations in one aggregation."""
    c = F.col("caption_dense")
    blank = F.coalesce(F.trim(c), F.lit("")) == ""
    return _t(spark, d, "captions").agg(
        F.count(F.lit(1)).alias("found"), F.count_if(blank).alias("without_text"), F.count_if(scalars.word_count(c) >= 120).alias("long_enough"), F.count_if(F.col("engine").isNull()).alias("without_engine"),
        F.count_distinct("image_id").alias("images"), F.count_if("provenance_verified").alias("verified"),
    )


@_query(
    """SELECT c.caption_id FROM captions c WHERE c.image_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM manifest_entries m WHERE m.image_id = c.image_id AND m.stages_status['stage1_crawl'] = 'downloaded')"""
)
def q_known_and_downloaded(spark, d):
    """Annotations whose image is not both known and downloaded."""
    done = _t(spark, d, "manifest_entries").where(stages.has_status(F.col("stages_status"), "stage1_crawl", "downloaded")).select("image_id")
    return _t(spark, d, "captions").where(F.col("image_id").isNotNull()).join(done, "image_id", "left_anti").select("caption_id")


@_query(
    r"""SELECT doc_id, page_url IS NOT NULL AND h IS NOT NULL AND NOT starts_with(h, 'b') AND NOT (starts_with(h, 'c') AND regexp_matches(page_url, '^[a-z]+://[^/]+/(caption/|post/1)')) AS allowed
    FROM (SELECT doc_id, page_url, nullif(lower(regexp_extract(page_url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)), '') AS h FROM documents)"""
)
def q_robots_allowed(spark, d):
    """Pages under rules made for their hosts: those of 'b' close everything, those of 'c' some paths, a page without a host has none."""
    docs = _t(spark, d, "documents").select("doc_id", "page_url", scalars.url_host(F.col("page_url")).alias("host"))
    closed = "Disallow: /caption/\nDisallow: /post/1"
    rules = F.when(F.startswith("host", F.lit("b")), "Disallow: /").when(F.startswith("host", F.lit("c")), closed).otherwise("Disallow:")
    robots = docs.where("host is not null").select("host", F.concat(F.lit("User-agent: *\n"), rules).alias("robots_txt")).distinct()
    return compliance.robots_allowed(docs, robots, "page_url", "host").select("doc_id", F.col("robots_allowed").alias("allowed"))


@_query(
    """SELECT line_no, 'Set ' || line_no AS title, ['g' || (line_no % 7), 'h' || (line_no % 3)] AS genres, coalesce(source_url, '') AS format, (line_no % 40)::VARCHAR AS photos FROM manifest_entries"""
)
def q_post_metadata(spark, d):
    """Lines of a post made of each row's columns, read back as title, genres and labelled values."""
    n = F.col("line_no")
    text = F.concat(
        F.lit("Genre: old,\r\n\r\n  Set "), n, F.lit("\nGenres: g"), n % 7, F.lit(" , h"), n % 3, F.lit(",\nformat : "), F.coalesce("source_url", F.lit("")), F.lit("\nNumber of photos: "), n % 40, F.lit("\n[img]x[/img]"),
    )
    post = scalars.post_metadata(text)
    return _t(spark, d, "manifest_entries").select("line_no", post.alias("p")).select("line_no", "p.title", "p.genres", F.coalesce(F.col("p.metadata")["format"], F.lit("")).alias("format"), F.col("p.metadata")["photos_count"].alias("photos"))


@_query("SELECT line_no, greatest(line_no % 5 + 1, line_no % 9 + 1)::INT AS pages FROM manifest_entries")
def q_page_count(spark, d):
    n = F.col("line_no")
    html = F.concat(F.lit("<a href='/set?page="), n % 5 + 1, F.lit("'>x</a> <a href=\"/set/page-"), n % 9 + 1, F.lit("\">y</a> 999"))
    return _t(spark, d, "manifest_entries").select("line_no", scalars.page_count(html).alias("pages"))


@_query(
    """SELECT caption_id, coalesce(nullif(trim(caption_dense), ''), nullif(trim(description), ''), 'none') AS caption FROM captions"""
)
def q_caption_fallback(spark, d):
    """The caption of a tier that model output lacks: the dense one, else the description, else the raw text."""
    raw = F.to_json(F.struct("caption_dense", "description"))
    blank = (F.coalesce(F.trim("caption_dense"), F.lit("")) == "") & (F.coalesce(F.trim("description"), F.lit("")) == "")
    rows = _t(spark, d, "captions").select("caption_id", F.when(blank, "none").otherwise(F.concat(F.lit("```json\n"), raw, F.lit("\n```"))).alias("raw"))
    rows = rows.withColumn("j", json_repair.extract_object(F.col("raw")))
    return rows.select("caption_id", json_repair.caption_of_tier(F.col("raw"), "mid", F.col("j")).alias("caption"))


# --- files, written from the tables and read back -------------------------------------------------


def _folder(spark) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/written/{uuid.uuid4().hex}"


@_query("SELECT image_id, arg_max(line_no, line_no)::VARCHAR AS line, arg_max(struct_pack(t := context_title), line_no).t AS context_title FROM manifest_entries WHERE image_id IS NOT NULL GROUP BY 1")
def q_jsonl_last_wins(spark, d):
    """The manifest as a JSON-lines log in order of arrival, read back: of every id the line that stands last."""
    at = _folder(spark)
    entries = _t(spark, d, "manifest_entries").select("line_no", "image_id", "context_title", F.col("line_no").cast("string").alias("trigger_word"))
    entries.repartitionByRange("line_no").sortWithinPartitions("line_no").select(F.to_json(F.struct("image_id", "context_title", "trigger_word"))).write.text(at)
    rows, _ = manifest.read_jsonl(spark, at, last_wins=True)
    return rows.select("image_id", F.col("trigger_word").alias("line"), "context_title")


@_query("SELECT image_id, arg_max(category, (updated_at, line_no)) AS category FROM manifest_entries WHERE image_id IS NOT NULL GROUP BY 1")
def q_bucketed_state(spark, d):
    """Two merges of the manifest's halves into a bucketed state, read back."""
    at = _folder(spark)
    every = _t(spark, d, "manifest_entries").where(F.col("image_id").isNotNull()).select("image_id", "category", F.struct("updated_at", "line_no").alias("at"), (F.col("line_no") % 2).alias("half"))
    for half in (1, 0):
        manifest.merge_buckets(latest_rows(every.where(F.col("half") == half), "image_id", ["at"], {"category": "category", "at": "at"}), at, order="at", buckets=16)
    return manifest.read_snapshot(spark, at).select("image_id", "category")


@_query("SELECT image_id, max(caption_dense) AS caption FROM captions WHERE image_id IS NOT NULL AND caption_dense IS NOT NULL GROUP BY 1")
def q_caption_versions(spark, d):
    """Captions kept as versions: a changed text becomes the next version, and the newest is the greatest here."""
    texts = _t(spark, d, "captions").where(F.col("image_id").isNotNull() & F.col("caption_dense").isNotNull())
    ends = texts.groupBy("image_id").agg(F.min("caption_dense").alias("first"), F.max("caption_dense").alias("last"))
    history = ends.select(F.col("image_id").alias("item_id"), F.lit(1).alias("version"), F.col("first").alias("text"))
    after = reports.caption_versions(history, ends.select(F.col("image_id").alias("item_id"), F.col("last").alias("text")))
    newest = latest_rows(after, "item_id", ["version"], {"text": "text"})
    return newest.select(F.col("item_id").alias("image_id"), F.col("text").alias("caption"))


# --- relational warm-ups on the star schema ------------------------------------------------------


@_query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY 1, 2")
def q_pricing_summary(spark, d):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return _t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(price), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


@_query("SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def q_orders_by_nation(spark, d):
    o, c, n = (_t(spark, d, x) for x in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
