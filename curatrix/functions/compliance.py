"""Opt-out and crawl permissions: header and meta reservations, robots rules."""

from __future__ import annotations

from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

_YES = ("1", "true", "yes")


def _metas(html: Column, names: str) -> Column:
    """Lower-case contents of the meta tags named ``names``, whichever attribute comes first."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0))
    named = F.filter(tags, lambda t: F.regexp_like(t, F.lit(rf"(?is)\bname\s*=\s*[\"']?\s*(?:{names})\s*[\"'\s/>]")))
    return F.transform(named, lambda t: F.lower(F.trim(F.regexp_extract(t, r"(?is)\bcontent\s*=\s*[\"']([^\"']*)[\"']", 1))))


def reservation(headers: Column, html: Column) -> Column:
    """Why a page reserves its text and data mining rights, null if it doesn't; headers before metas."""
    entries = F.map_entries(headers)
    tdm = F.exists(entries, lambda e: (F.lower(e["key"]) == "tdm-reservation") & F.lower(e["value"]).isin(*_YES))
    tag = F.exists(entries, lambda e: (F.lower(e["key"]) == "x-robots-tag") & F.regexp_like(F.lower(e["value"]), F.lit("noai|noimageai")))
    meta = F.exists(_metas(html, "tdm-reservation"), lambda v: v.isin(*_YES))
    robots = F.exists(_metas(html, "robots|googlebot"), lambda v: F.regexp_like(v, F.lit("noai|noimageai")))
    return F.when(tdm, "header:tdm-reservation").when(tag, "header:x-robots-tag").when(meta, "meta:tdm-reservation").when(robots, "meta:robots")


def robots_allowed(pages: DataFrame, robots: DataFrame, url: str, host: str, agent: str = "*") -> DataFrame:
    """``pages`` with robots_allowed by each host's robots.txt (host, robots_txt); a missing file denies.

    An equi-join on the host; each batch parses a host's rules once.
    """

    def judge(urls: pd.Series, texts: pd.Series) -> pd.Series:
        parsed: dict[str, RobotFileParser] = {}
        out = []
        for u, t in zip(urls, texts):
            if t is None or u is None:
                out.append(False)
                continue
            if t not in parsed:
                parsed[t] = RobotFileParser()
                parsed[t].parse(t.splitlines())
            out.append(parsed[t].can_fetch(agent, u))
        return pd.Series(out)

    rules = robots.groupBy(F.col("host").alias("__robots_host")).agg(F.max("robots_txt").alias("__robots_txt"))
    joined = pages.join(rules, F.col(host) == F.col("__robots_host"), "left")
    return joined.withColumn("robots_allowed", pandas_udf(judge, "boolean")(F.col(url), F.col("__robots_txt"))).drop("__robots_host", "__robots_txt")
