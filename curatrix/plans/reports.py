"""Reports and configuration files from small aggregates."""

from __future__ import annotations

import html
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Most rows a report takes to the driver; a table with more is an error, never cut short.
MOST_ROWS = 10_000
#: The trainer's width and height buckets, resolutions and caption settings.
BUCKETS = ((1024, 1024), (1536, 1024), (1024, 1536), (1280, 832), (832, 1280), (2048, 1024), (1024, 2048))
RESOLUTIONS = (1024, 1536, 2048)
CAPTION_EXTENSION = "txt"


def _few(df: DataFrame, most: int) -> list:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows for a report")
    return rows


def distribution_markdown(distribution: DataFrame, total: int, title: str = "Distribution", most_rows: int = MOST_ROWS) -> str:
    """(dimension, value, n) as Markdown tables, shares to one decimal, 0 without rows."""
    out = [f"# {title}", "", f"Total: {total}"]
    current = None
    for d, v, n in _few(distribution.orderBy("dimension", F.col("n").desc(), "value").select("dimension", "value", "n"), most_rows):
        if d != current:
            out += ["", f"## {d}", "", "| value | n | share |", "|---|---|---|"]
            current = d
        out.append(f"| {v} | {n} | {(100 * n / total if total else 0):.1f} % |")
    return "\n".join(out) + "\n"


def sample_html(rows: DataFrame, columns: Sequence[str], title: str = "Samples", most: int = 200) -> str:
    """A sample of rows as escaped cards."""
    cards = []
    for r in rows.select(*columns).limit(most).collect():
        cards.append("<article>" + "".join(f"<p><b>{html.escape(c)}</b> {html.escape('' if r[c] is None else str(r[c]))}</p>" for c in columns) + "</article>")
    return f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>{''.join(cards)}\n"


def contact_sheet_html(prompts: DataFrame, weights: Sequence[float], most: int = 20) -> str:
    """The first prompts against every weight, one cell each."""
    head = "".join(f"<th>{w:g}</th>" for w in weights)
    body = "".join(
        f"<tr><td>{html.escape(r[0])}</td>" + "".join(f"<td>{i:02d}_{int(round(w * 100))}</td>" for w in weights) + "</tr>"
        for i, r in enumerate(prompts.select("prompt").orderBy("prompt").limit(most).collect())
    )
    return f"<!doctype html><meta charset='utf-8'><table><tr><th>prompt</th>{head}</tr>{body}</table>\n"


def dataset_config(repeats: DataFrame, category: str, root: str, default_caption: str = "", resolutions: Sequence[int] = RESOLUTIONS, buckets: Sequence = BUCKETS) -> dict:
    """A trainer's dataset mapping: folder, caption and cache settings, resolutions, aspect buckets, and a subset per category with its repeats."""
    rows = _few(repeats.select(category, "repeats").orderBy(category), MOST_ROWS)
    config = {"folder_path": root, "caption_ext": CAPTION_EXTENSION, "default_caption": default_caption, "cache_latents_to_disk": True, "cache_text_encoder_to_disk": True}
    config |= {"resolutions": list(resolutions), "buckets": [list(b) for b in buckets]}
    return config | {"subsets": [{"path": f"{root}/{r[0]}", "repeats": int(r[1]), "caption_ext": CAPTION_EXTENSION} for r in rows]}


def write_missing(selected: DataFrame, path: str, key: str) -> None:
    """Appends the selected rows whose key the table at ``path`` lacks; what is there already stays as it is."""
    from curatrix.sources.manifest import exists

    fresh = selected.where(F.col(key).isNotNull()).dropDuplicates([key])
    if exists(selected.sparkSession, path):
        fresh = fresh.join(selected.sparkSession.read.parquet(path).select(key), key, "left_anti").select(*selected.columns)
    fresh.write.mode("append").parquet(path)


def as_yaml(config: dict) -> str:
    import yaml

    return yaml.safe_dump(config, sort_keys=False, allow_unicode=True)


def as_toml(config: dict) -> str:
    """The same mapping as TOML: general keys, then one [[subset]] per entry."""
    quote = lambda s: '"' + str(s).replace("\\", "\\\\").replace('"', '\\"') + '"'
    lines = ["[general]", f"resolutions = {config['resolutions']}"]
    for s in config["subsets"]:
        lines += ["", "[[subset]]", f"path = {quote(s['path'])}", f"repeats = {s['repeats']}"]
    return "\n".join(lines) + "\n"


def caption_versions(history: DataFrame, captions: DataFrame) -> DataFrame:
    """(item_id, version, text): a changed caption becomes the item's next version, the former ones stay."""
    last = history.groupBy("item_id").agg(F.max_by("text", "version").alias("old"), F.max("version").alias("v"))
    changed = captions.where(F.col("text").isNotNull()).join(last, "item_id", "left").where(~F.col("text").eqNullSafe(F.col("old")))
    return history.unionByName(changed.select("item_id", (F.coalesce("v", F.lit(0)) + 1).cast("int").alias("version"), "text"))


def genre_lines(sets: DataFrame) -> DataFrame:
    """One text value per set: 'Key: value' lines of title, genres and metadata, for a text sink."""
    meta = F.array_join(F.transform(F.map_entries("metadata"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return sets.select(F.concat_ws("\n", F.concat(F.lit("Title: "), "title"), F.concat(F.lit("Genres: "), F.array_join("genres", ", ")), F.nullif(meta, F.lit(""))).alias("value"))
