"""Rows of HTML tables of a page table."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Table rows that are put out at once.
ROWS = 1000


class _Tables(HTMLParser):
    """Collects the cells of each table, header cells apart."""

    def __init__(self) -> None:
        super().__init__()
        self.tables: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def close_cell(self) -> None:
        if self.cell is not None:
            self.tables[-1][-1][-1] = " ".join("".join(self.cell).split())
            self.cell = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("table", "tr", "td", "th"):
            self.close_cell()
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.cell = []
            self.tables[-1][-1].append("")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self.close_cell()

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)


def table_rows(html: str | None) -> list[dict]:
    """``(table_no, row_no, cells)`` of every table row."""
    parser = _Tables()
    parser.feed(html or "")
    return [{"table_no": t, "row_no": r, "cells": cells} for t, rows in enumerate(parser.tables) for r, cells in enumerate(rows) if cells]


def html_tables(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """One row per table row of each page; few pages at a time are Python objects, whatever an Arrow batch holds."""
    n = len(keep)
    found = pa.struct([("table_no", pa.int32()), ("row_no", pa.int32()), ("cells", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, rows = [], []

            def out() -> Iterator[pa.RecordBatch]:
                for at in range(0, len(rows), ROWS):
                    own = [batch.column(c).take(pa.array(of[at : at + ROWS])) for c in range(n)]  # noqa: B023
                    yield pa.RecordBatch.from_arrays([*own, *pa.array(rows[at : at + ROWS], found).flatten()], names=[*keep, *found.names])  # noqa: B023

            for i in range(batch.num_rows):
                more = table_rows(batch.column(n)[i].as_py())
                of, rows = of + [i] * len(more), rows + more
                if len(rows) >= ROWS:
                    yield from out()
                    of, rows = [], []
            yield from out()

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields]
    return pages.select(*keep, F.col(html).alias("_html")).mapInArrow(run, ", ".join([*kinds, "table_no int", "row_no int", "cells array<string>"]))


def name_tables(rows: DataFrame, keys: list[str], header: str) -> DataFrame:
    """Data rows of tables whose first row matches ``header``: name, colour, list of regions."""
    head = rows.where("row_no = 0").where(F.exists("cells", lambda c: F.rlike(F.lower(c), F.lit(header)))).select(*keys, "table_no")
    data = rows.where("row_no > 0 AND size(cells) > 0").join(head, [*keys, "table_no"])
    return data.select(*keys, F.get("cells", F.lit(0)).alias("name"), F.get("cells", F.lit(1)).alias("colour"), split_list(F.get("cells", F.lit(2))).alias("regions"))


def split_list(text: Column) -> Column:
    """Parts of a list written with commas, semicolons or ``and``."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"\s*[,;]\s*|\s+and\s+"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")
