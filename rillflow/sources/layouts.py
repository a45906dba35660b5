"""Tables out of documents: cell grids, placed characters, headed lines, HTML."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from rillflow.operators import intervals
from rillflow.session import ship_package


def by_width(grids: DataFrame, cells: str, layouts: dict[int, Sequence[str]]) -> tuple[DataFrame, DataFrame]:
    """Rows of cells (array<string>) of a known width as named columns, missing ones null, with source_layout; the rest
    come back as the second frame, counted and not dropped."""
    names = max(layouts.values(), key=len)
    width = F.size(cells)
    columns = []
    for name in names:
        value = F.lit(None).cast("string")
        out = F.when(F.lit(False), value)
        for n, layout in layouts.items():
            if name in layout:
                out = out.when(width == n, F.get(cells, F.lit(list(layout).index(name))))
        columns.append(out.otherwise(value).alias(name))
    known = width.isin(*layouts)
    rest = [c for c in grids.columns if c != cells]
    return grids.where(known).select(*rest, *columns, width.alias("source_layout")), grids.where(~F.coalesce(known, F.lit(False)))


def valid_rows(rows: DataFrame, first: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose first cell is a number, and the others with a reason."""
    ok = F.coalesce(F.col(first).rlike(r"^\s*\d+\s*$"), F.lit(False))
    reason = F.when(F.col(first).isNull(), "no first cell").when(F.lower(first).rlike("[a-z]"), "header").otherwise("not a number")
    return rows.where(ok), rows.where(~ok).withColumn("reason", reason)


def with_fallback(ruled: DataFrame, aligned: DataFrame, page: str) -> DataFrame:
    """Rows of the first extraction, and of the second for those pages alone where the first found none; `method` tells which."""
    rest = aligned.join(ruled.select(page).distinct(), page, "left_anti")
    return ruled.withColumn("method", F.lit("ruled")).unionByName(rest.withColumn("method", F.lit("aligned")), allowMissingColumns=True)


def bucket_of(value: Column, edges: Sequence[float]) -> Column:
    """Index of the half-open interval [edge, next) that holds the value; null outside."""
    out = F.when(F.lit(False), F.lit(None).cast("int"))
    for k in range(len(edges) - 1):
        out = out.when((value >= edges[k]) & (value < edges[k + 1]), k)
    return out


def reassemble(characters: DataFrame, page: str, x_edges: Sequence[float], y_edges: Sequence[float]) -> DataFrame:
    """Cells of a ruled grid from placed characters (x0, x1, top, bottom, char): a character belongs where its centre lies;
    within a cell characters read by line (top / 1.5, rounded), then left to right."""
    col = bucket_of((F.col("x0") + F.col("x1")) / 2, x_edges)
    row = bucket_of((F.col("top") + F.col("bottom")) / 2, y_edges)
    placed = characters.select(page, row.alias("row"), col.alias("col"), F.struct(F.round(F.col("top") / 1.5).alias("line"), "x0", F.col("char").alias("c")).alias("at")).where("row is not null and col is not null")
    return placed.groupBy(page, "row", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list("at")), lambda a: a["c"]), "").alias("cell"))


def ruled_edges(rects: DataFrame, page: str, low: str, high: str, thin: float = 2.0, least: int = 2) -> DataFrame:
    """(page, edge): places of the rules of each page, thin rectangles whose sides are `low` and `high`, to a tenth; pages with
    fewer than `least` are left out."""
    edges = rects.where(F.col(high) - F.col(low) < thin).select(page, F.round(low, 1).alias("edge")).distinct()
    return edges.withColumn("__n", F.count(F.lit(1)).over(W.partitionBy(page))).where(F.col("__n") >= least).drop("__n")


def reassemble_pages(characters: DataFrame, rects: DataFrame, page: str, least_x: int = 2, least_y: int = 2) -> DataFrame:
    """reassemble() with each page's own grid, measured off its rules (x0, x1, top, bottom): (page, row, col, cell).

    Characters outside the grid, and pages with too few rules, have no cells.
    """
    columns = intervals.between_edges(ruled_edges(rects, page, "x0", "x1", least=least_x), [page], "edge")
    rows = intervals.between_edges(ruled_edges(rects, page, "top", "bottom", least=least_y), [page], "edge")
    placed = intervals.interval_join(characters.select(page, "x0", "x1", "top", "bottom", "char"), (F.col("x0") + F.col("x1")) / 2, columns, [page], "col")
    placed = intervals.interval_join(placed, (F.col("top") + F.col("bottom")) / 2, rows, [page], "row")
    at = F.struct(F.round(F.col("top") / 1.5).alias("line"), "x0", F.col("char").alias("c"))
    return placed.groupBy(page, "row", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(at)), lambda a: a["c"]), "").alias("cell"))


def headed_lines(texts: DataFrame, key: str, text: str, header: str, numbered: str) -> DataFrame:
    """Numbered lines with the last header line before them: key, line_no, owner, number, rest.

    header and numbered are patterns with one and two groups. Lines before any header have no owner.
    """
    lines = texts.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    head = F.nullif(F.regexp_extract("line", header, 1), F.lit(""))
    owner = F.last(head, ignorenulls=True).over(W.partitionBy(key).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0))
    return lines.withColumn("owner", owner).where(F.col("line").rlike(numbered)).select(key, "line_no", "owner", F.regexp_extract("line", numbered, 1).alias("number"), F.regexp_extract("line", numbered, 2).alias("rest"))


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, href, label of every link, white space collapsed, one row per distinct href of a page (the first)."""
    pattern = r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("label"))
    found = pages.select(key, F.posexplode(pairs).alias("at", "a")).select(key, "at", F.col("a.href").alias("href"), F.trim(F.regexp_replace(F.regexp_replace("a.label", "<[^>]*>", " "), r"\s+", " ")).alias("label"))
    return found.groupBy(key, "href").agg(F.min_by("label", "at").alias("label"))


class _Leaves(HTMLParser):
    """Rows of the innermost tables."""

    def __init__(self) -> None:
        super().__init__()
        self.stack: list[dict] = []
        self.tables: list[list[list[str]]] = []

    def handle_starttag(self, tag, attrs):  # noqa: ANN001
        if tag == "table":
            for t in self.stack:
                t["leaf"] = False
            self.stack.append({"leaf": True, "rows": [], "cell": None})
        elif self.stack and tag == "tr":
            self._close()
            self.stack[-1]["rows"].append([])
        elif self.stack and tag in ("td", "th"):
            self._close()
            self.stack[-1]["cell"] = []

    def _close(self) -> None:
        top = self.stack[-1]
        if top["cell"] is not None:
            if not top["rows"]:
                top["rows"].append([])
            top["rows"][-1].append(" ".join("".join(top["cell"]).split()))
            top["cell"] = None

    def handle_endtag(self, tag):  # noqa: ANN001
        if self.stack and tag in ("td", "th", "tr"):
            self._close()
        elif self.stack and tag == "table":
            self._close()
            top = self.stack.pop()
            if top["leaf"]:
                self.tables.append([r for r in top["rows"] if r])

    def handle_data(self, data):  # noqa: ANN001
        if self.stack and self.stack[-1]["cell"] is not None:
            self.stack[-1]["cell"].append(data)


def leaf_tables(html: str | None) -> list[list[list[str]]]:
    """Rows of cells of each innermost table, in order."""
    parser = _Leaves()
    parser.feed(html or "")
    parser.close()
    return parser.tables


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, table_no, row_no, cells of every innermost table. HTML needs a parser, so this is a pandas pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, t, r, cells) for k, page in zip(batch.iloc[:, 0], batch.iloc[:, 1], strict=True) for t, table in enumerate(leaf_tables(page)) for r, cells in enumerate(table)]
            yield pd.DataFrame(rows, columns=["key", "table_no", "row_no", "cells"])

    ship_package(pages.sparkSession)
    kind = dict(pages.dtypes)[key]
    return pages.select(key, html).mapInPandas(run, f"key {kind}, table_no int, row_no int, cells array<string>").withColumnRenamed("key", key)


def geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """Properties and geometry of each feature of a collection."""
    return spark.read.option("multiLine", True).json(path).select(F.explode("features").alias("f")).select("f.*")


def json_rows(spark: SparkSession, path: str, field: str) -> DataFrame:
    """The structs of one array field of a JSON document, as rows: reads a serving document back as a table."""
    return spark.read.option("multiLine", True).json(path).select(F.explode(field).alias("r")).select("r.*")
