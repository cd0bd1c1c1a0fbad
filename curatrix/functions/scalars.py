"""Scalar functions as Column expressions; every one stays inside code generation unless it says otherwise.

Nulls: a null input gives null unless the docstring names a default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: characters that file systems reject.
_UNSAFE = r'[\\/*?:"<>|]'
_IMAGE_EXTENSION = r"(?i)\.(?:jpe?g|png|webp|bmp)"


def words(text: Column) -> Column:
    """The white-space separated words of a text, none empty."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def collapse(text: Column) -> Column:
    """White space of any kind as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def null_if_blank(text: Column) -> Column:
    """The trimmed text, null where nothing is left."""
    t = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.when(t != "", t)


def decode_percent(text: Column) -> Column:
    """Percent escapes resolved, '+' kept, the input where an escape is invalid."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def _strip_dots(text: Column) -> Column:
    return F.regexp_replace(text, r"^[. ]+|[. ]+$", "")


def sanitize_name(name: Column, max_length: int = 80, default: str = "item") -> Column:
    """A name safe for folders: escapes resolved, unsafe characters as '_', blanks collapsed, cut to length."""
    s = _strip_dots(F.regexp_replace(F.regexp_replace(decode_percent(name), _UNSAFE, "_"), r"(?U)\s+", " "))
    return F.coalesce(F.nullif(F.substring(s, 1, max_length), F.lit("")), F.lit(default))


def sanitize_filename(name: Column, max_length: int = 150, default: str = "image") -> Column:
    """sanitize_name that keeps the extension when it shortens."""
    s = F.coalesce(F.nullif(_strip_dots(F.regexp_replace(F.regexp_replace(decode_percent(name), _UNSAFE, "_"), r"(?U)\s+", " ")), F.lit("")), F.lit(default))
    ext = F.regexp_extract(s, r"[^.](\.[^.]*)$", 1)
    stem = F.substring(s, F.lit(1), F.length(s) - F.length(ext))
    return F.when(F.length(s) > max_length, F.concat(F.trim(F.substring(stem, F.lit(1), F.greatest(F.lit(max_length - 5) - F.length(ext), F.lit(0)))), ext)).otherwise(s)


def page_numbers(spec: Column, available: Column | None = None) -> Column:
    """Sorted distinct pages of '3', '1-4', '9-7,2' or 'all' (1 to ``available``); null if a part is no number."""
    s = F.lower(F.trim(spec))
    parts = F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x)), lambda p: p != "")
    bounds = F.transform(parts, lambda p: F.transform(F.split(p, "-", 2), lambda x: F.trim(x).try_cast("int")))
    invalid = F.exists(bounds, lambda b: F.exists(b, lambda x: x.isNull()))
    safe = F.when(~invalid, bounds)
    ranges = F.transform(safe, lambda b: F.sequence(F.least(F.element_at(b, 1), F.element_at(b, -1)), F.greatest(F.element_at(b, 1), F.element_at(b, -1))))
    listed = F.filter(F.array_sort(F.array_distinct(F.flatten(ranges))), lambda p: p >= 1)
    if available is None:
        return listed
    return F.when(s == "all", F.when(available >= 1, F.sequence(F.lit(1), available.cast("int")))).otherwise(listed)


def page_url(base: Column, page: Column) -> Column:
    """The address of a numbered page: page=n replaced in the query, else appended; page 1 is the base itself."""
    n = page.cast("string")
    replaced = F.regexp_replace(base, F.lit(r"([?&])page=\d+"), F.concat(F.lit("$1page="), n))
    joined = F.concat(base, F.when(F.contains(base, F.lit("?")), "&page=").otherwise("?page="), n)
    return F.when(F.regexp_like(base, F.lit(r"[?&]page=\d+")), replaced).when(page <= 1, base).otherwise(joined)


def url_host(url: Column) -> Column:
    """Lower-case host without port and user, by pattern, so that a malformed address is null, not an error."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def url_suffix(url: Column) -> Column:
    """Lower-case extension of the path with its dot, '' without one."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.lower(F.regexp_extract(path, r"[^/](\.[A-Za-z0-9]+)$", 1))


def humanize_tag(tag: Column) -> Column:
    """snake_case as words; null and 'other' are ''."""
    return F.when(tag.isNull() | (F.lower(tag) == "other"), "").otherwise(F.trim(F.replace(tag, F.lit("_"), F.lit(" "))))


def assemble_caption(
    trigger: Column, dense: Column, style: Column, location: Column, description: Column, lighting: Column, with_style: bool = False
) -> Column:
    """A training caption: the dense text with the trigger in front unless it already starts so, else composed parts.

    The trigger is joined by ', ' if the dense text has a comma and doesn't start with 'Photograph', else
    by a blank. Composed: trigger, style (``with_style``), location, description and lighting, blanks
    collapsed. Null parts are left out; the result is never null.
    """
    trig, body = F.coalesce(F.trim(trigger), F.lit("")), F.coalesce(F.trim(dense), F.lit(""))
    bare = F.lower(F.regexp_replace(trig, "[, ]+$", ""))
    mark = F.when(F.contains(body, F.lit(",")) & ~F.startswith(body, F.lit("Photograph")), ", ").otherwise(" ")
    led = F.when((trig == "") | F.startswith(F.lower(body), bare), body).otherwise(F.concat(trig, mark, body))
    sentence = lambda c: F.concat(F.regexp_replace(F.trim(c), "[. ]+$", ""), F.lit("."))
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    style_words, place = humanize_tag(style), humanize_tag(location)
    parts = F.concat_ws(
        " ",
        F.when(trig != "", trig),
        F.when(F.lit(with_style) & (style_words != ""), F.concat(style_words, F.lit(" aesthetic."))),
        F.when(place != "", F.concat(F.lit("Set in a "), place, F.lit("."))),
        F.when(filled(description), sentence(description)),
        F.when(filled(lighting), sentence(lighting)),
    )
    return collapse(F.when(body != "", led).otherwise(parts))


def resolve_trigger(own: Column, template: Column, category: Column, prefix: str, default: str) -> Column:
    """The item's own trigger, else the template ({category} filled in), else prefix and category, else default."""
    given = F.nullif(template, F.lit(""))
    filled = F.when(F.contains(given, F.lit("{category}")) & (category != ""), F.replace(given, F.lit("{category}"), category)).otherwise(given)
    return F.coalesce(F.nullif(own, F.lit("")), filled, F.when(category != "", F.concat(F.lit(prefix + ", "), category)), F.lit(default))


def leading_trigger(caption: Column, pattern: str = r"^([a-z0-9]+_[a-z0-9_]+)\s*,") -> Column:
    """The trigger that a caption starts with, by ``pattern``'s first group; null without one."""
    return F.nullif(F.regexp_extract(caption, pattern, 1), F.lit(""))


def word_count(text: Column) -> Column:
    """White-space separated words; a null text has none.

    Each word with the blanks around it becomes one character, and those are counted; no array is built.
    """
    marks = F.regexp_replace(text, r"(?U)(?:^\s++)?\S++\s*+", "x")
    return F.coalesce(F.length(F.regexp_replace(marks, r"(?U)\s++", "")), F.lit(0))


def sign_count(text: Column) -> Column:
    """Runs of word characters plus other signs that are no ASCII blank; a null text has none.

    Each run becomes one character, blanks none; what is left is counted, no array is built.
    """
    runs = F.regexp_replace(text, r"[\w\p{L}\p{M}\p{N}]++", "x")
    return F.coalesce(F.length(F.regexp_replace(runs, r"\s++", "")), F.lit(0))


def estimate_tokens(text: Column, words: Column | None = None, signs: Column | None = None) -> Column:
    """The greater of 1.35 times the words, rounded down, and the runs of word characters plus other signs; null is 0.

    Counts already at hand may be given as ``words`` and ``signs``.
    """
    words = word_count(text) if words is None else words
    return F.greatest(F.floor(words * F.lit(1.35)).cast("int"), sign_count(text) if signs is None else signs)


def already_updated(
    caption: Column, has_backup: Column, token_threshold: int = 400, word_threshold: int = 280, words: Column | None = None, signs: Column | None = None
) -> Column:
    """Whether a non-blank caption has a backup or is as long as an updated one."""
    words = word_count(caption) if words is None else words
    long_enough = (estimate_tokens(caption, words, signs) > token_threshold) | (words >= word_threshold)
    return F.coalesce((words > 0) & (F.coalesce(has_backup, F.lit(False)) | long_enough), F.lit(False))


def hash_key(path: Column) -> Column:
    """The identity in a file name: 8 to 64 leading hex digits, else what stands before an image extension, else the stem."""
    name = F.element_at(F.split(path, "/"), -1)
    hexed = F.nullif(F.regexp_extract(name, r"^([0-9a-fA-F]{8,64})", 1), F.lit(""))
    before = F.nullif(F.trim(F.element_at(F.split(name, _IMAGE_EXTENSION), 1)), F.lit(""))
    return F.lower(F.coalesce(hexed, before, F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")))


def strip_fences(text: Column) -> Column:
    """Model output without a surrounding code fence and surrounding quotes."""
    unfenced = F.regexp_replace(F.trim(text), r"(?s)^```[A-Za-z]*\s*|\s*```$", "")
    return F.trim(F.regexp_replace(unfenced, r"(?s)^\"(.*)\"$", "$1"))


def downscaled(width: Column, height: Column, longest: int = 2048, multiple: int = 16) -> tuple[Column, Column]:
    """Width and height scaled to ``longest`` if above it, each rounded half-even to ``multiple`` and at least one.

    Both are null unless both edges are above 0.
    """
    valid = (width > 0) & (height > 0)
    scale = F.least(F.lit(1.0), F.lit(float(longest)) / F.when(valid, F.greatest(width, height)))
    side = lambda x: F.when(valid, F.greatest(F.lit(multiple), (F.bround(x * scale / multiple, 0) * multiple).cast("int")))
    return side(width), side(height)


def thousandths(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half-even to 3 decimals on integers; null for a zero denominator.

    Whole-number arithmetic, because rounding the double differs between engines at ties.
    """
    n, d = numerator.cast("long") * 1000, F.nullif(denominator.cast("long"), F.lit(0).cast("long"))
    q, r = F.floor(n / d).cast("long"), F.pmod(n, d)
    up = (2 * r > d) | ((2 * r == d) & (F.pmod(q, F.lit(2)) == 1))
    return (q + up.cast("long")) / F.lit(1000.0)


def aspect_ratio(width: Column, height: Column) -> Column:
    """Width by height to 3 decimals; null unless both edges are above 0."""
    return F.when((width > 0) & (height > 0), thousandths(width, height))


def megapixels(width: Column, height: Column) -> Column:
    """Millions of pixels to 3 decimals; null unless both edges are above 0."""
    return F.when((width > 0) & (height > 0), thousandths(width.cast("long") * height.cast("long"), F.lit(1_000_000)))


def quality_score(mp: Column, laplacian: Column) -> Column:
    """mp * (laplacian / 100); missing or zero mp counts as 1, missing laplacian as 100."""
    return F.coalesce(F.nullif(mp, F.lit(0.0)), F.lit(1.0)) * (F.coalesce(laplacian, F.lit(100.0)) / 100)


def hash_halves(hex16: Column) -> tuple[Column, Column]:
    """A 64-bit hash in hex as two 32-bit halves in longs; null if it isn't 16 hex digits."""
    ok = F.regexp_like(hex16, F.lit("^[0-9a-fA-F]{16}$"))
    half = lambda at: F.when(ok, F.conv(F.substring(hex16, at, 8), 16, 10).cast("long"))
    return half(1), half(9)


def hamming(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Bits in which two hashes, given as halves, differ."""
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def content_id(content: Column, digits: int | None = None) -> Column:
    """SHA-256 of the bytes in hex, or its first ``digits``."""
    h = F.sha2(content, 256)
    return h if digits is None else F.substring(h, 1, digits)


#: The labels that a post's metadata lines start with, by key.
POST_LABELS = {"format": "Format", "photos_count": "Number of photos|Photos", "resolution": "Resolution", "filesize": "Filesize"}


def post_metadata(text: Column) -> Column:
    """struct(title, genres, metadata) of a post's lines: 'Label: value' pairs, the last genre line, the first free line."""
    lines = F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    last = lambda label: F.element_at(
        F.filter(F.transform(lines, lambda x: F.trim(F.regexp_extract(x, rf"(?i)^(?:{label})\s*:\s*(.+)$", 1))), lambda v: v != ""), -1
    )
    has = lambda label: F.exists(lines, lambda x: F.regexp_like(x, F.lit(rf"(?i)^(?:{label})\s*:\s*.+$")))
    raw = F.when(has("Genres?|Tags?"), F.regexp_replace(last("Genres?|Tags?"), ",+$", ""))
    genres = F.coalesce(F.filter(F.transform(F.split(raw, ","), lambda x: F.trim(x)), lambda g: g != ""), F.array().cast("array<string>"))
    free = F.filter(
        lines,
        lambda x: ~F.regexp_like(x, F.lit(r"(?i)^(?:(?:genres?|tags?)\s*:\s*.|http|\[|download|format|resolution|genre|filesize|number|photos\s*:\s*.)")) & (F.length(x) < 120),
    )
    pairs = [F.struct(F.lit(k).alias("key"), F.when(has(v), last(v)).alias("value")) for k, v in POST_LABELS.items()]
    pairs.append(F.struct(F.lit("genres_raw").alias("key"), raw.alias("value")))
    return F.struct(
        F.get(free, 0).alias("title"), genres.alias("genres"), F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())).alias("metadata")
    )


def page_count(html: Column, pattern: str = r"[?&/]page[=-](\d+)") -> Column:
    """The greatest page number among a page's pagination links, 1 without any."""
    found = F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), lambda x: x.try_cast("int"))
    return F.when(html.isNotNull(), F.coalesce(F.array_max(found), F.lit(1)))


def clean_title(title: Column) -> Column:
    """A page title without a ' | site' suffix and a 'page n' tail."""
    return collapse(F.regexp_replace(F.regexp_replace(title, r"(?U)\s+\|[^|]*$", ""), r"(?iU)\s*[-–|,]?\s*[\(\[]?\bpage\s+\d+.*$", ""))


def distinct_ignoring_case(items: Column) -> Column:
    """The trimmed non-empty items in order, the first of each spelling that differs only in case."""
    clean = F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")
    lower = F.transform(clean, F.lower)
    return F.filter(clean, lambda x, i: F.array_position(lower, F.lower(x)) == i + 1)


def best_variant(sources: Column) -> Column:
    """The static variant of array<struct<url,type,width,height,isOptimized>> with most pixels, the original on a tie."""
    static = F.filter(sources, lambda s: ~F.coalesce(F.endswith(s["url"], F.lit(".mp4")), F.lit(False)) & ~F.coalesce(F.upper(s["type"]) == "MP4", F.lit(False)))
    score = lambda s: F.coalesce(s["width"], F.lit(0)).cast("long") * F.coalesce(s["height"], F.lit(0)) + F.when(F.coalesce(s["isOptimized"], F.lit(False)), 0).otherwise(1)
    top = F.array_max(F.transform(static, score))
    return F.get(F.filter(static, lambda s: score(s) == top), 0)
