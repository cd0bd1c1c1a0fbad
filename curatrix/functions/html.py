"""Links and pictures in HTML by the standard parser, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Collector(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = dict(attrs)
        if tag == "a" and given.get("href"):
            self.found.append(("a", given["href"]))
        elif tag == "img":
            address = given.get("data-src") or given.get("src")
            if address:
                self.found.append(("img", address))


def collect(html: str) -> list[tuple[str, str]]:
    """(kind, address) of every link and picture, in order; what can't be parsed ends the list."""
    c = _Collector()
    try:
        c.feed(html)
        c.close()
    except (ValueError, AssertionError):
        pass
    return c.found


def _resolve(base: str | None, address: str) -> str:
    try:
        return urljoin(base, address) if base else address
    except ValueError:
        return address


def extract_links(df: DataFrame, ident: str, html: str, base: str | None = None) -> DataFrame:
    """(ident, position, kind, address) of the links (a) and pictures (img), relative ones resolved against ``base``.

    Narrow, no shuffle; a null page has none.
    """
    kind = df.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            bases = batch.column(2).to_pylist()
            for i, page in enumerate(batch.column(1).to_pylist()):
                rows += [(i, p, k, _resolve(bases[i], a)) for p, (k, a) in enumerate(collect(page))] if page else []
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())],
                names=["i", "position", "kind", "address"],
            )

    source = df.select(F.col(ident).alias("i"), F.col(html).alias("h"), (F.col(base) if base else F.lit(None).cast("string")).alias("b"))
    return source.mapInArrow(run, f"i {kind}, position int, kind string, address string").withColumnRenamed("i", ident)


def union_of_links(links: DataFrame, page: str) -> DataFrame:
    """(page, address) once each over all copies of a page and all kinds of links; a null page is none."""
    return links.select(page, "address").where(F.col(page).isNotNull() & F.col("address").isNotNull()).distinct()
