"""HTML tables to rows. Markup is no regular language, so this is an Arrow function."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

TABLES = "array<struct<headers:array<string>,rows:array<array<string>>>>"


class _Reader(HTMLParser):
    """Collects tables; rows and cells that are never closed end where the next one starts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[dict] = []
        self.row: list[str] | None = None
        self.cell: list[str] | None = None
        self.span, self.is_header, self.muted, self.depth = 1, False, 0, 0

    def _end_cell(self) -> None:
        if self.cell is not None:
            self.row.append(" ".join("".join(self.cell).split()))
            self.row.extend([""] * (self.span - 1))
            self.cell = None

    def _end_row(self) -> None:
        self._end_cell()
        if self.row is not None and any(self.row):
            table = self.tables[-1]
            if self.is_header and not table["headers"] and not table["rows"]:
                table["headers"] = self.row
            else:
                table["rows"].append(self.row)
        self.row, self.is_header = None, False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.muted += 1
        elif tag == "table":
            if self.depth == 0:
                self.tables.append({"headers": [], "rows": []})
            self.depth += 1
        elif self.depth and tag == "tr":
            self._end_row()
            self.row = []
        elif self.depth and tag in ("td", "th"):
            self._end_cell()
            self.row = [] if self.row is None else self.row
            self.cell, span = [], dict(attrs).get("colspan") or "1"
            self.span = max(1, int(span)) if span.isdigit() else 1
            self.is_header |= tag == "th"
        elif self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.muted = max(0, self.muted - 1)
        elif tag == "table" and self.depth:
            self.depth -= 1
            if not self.depth:
                self._end_row()
        elif tag == "tr":
            self._end_row()
        elif tag in ("td", "th"):
            self._end_cell()
        elif self.cell is not None:
            self.cell.append(" ")

    def handle_data(self, data: str) -> None:
        if self.cell is not None and not self.muted:
            self.cell.append(data)


def read_tables(markup: str | None) -> list[dict]:
    """headers and rows of each table; null and blank markup has none, empty rows are left out."""
    reader = _Reader()
    reader.feed(markup or "")
    reader.close()
    if reader.tables:
        reader._end_row()
    return [t for t in reader.tables if t["headers"] or t["rows"]]


_TEXTS = ArrayType(StringType())


@F.pandas_udf(ArrayType(StructType([StructField("headers", _TEXTS), StructField("rows", ArrayType(_TEXTS))])))
def parse_tables(markup: pd.Series) -> pd.Series:
    return markup.map(read_tables)


def first_table(tables: Column, *required: str) -> Column:
    """The first table that has a header containing each of the words, in any case."""
    wanted = [w.strip().lower() for w in required if w.strip()]
    if not wanted:
        return F.lit(None).cast(TABLES[6:-1])
    return F.get(F.filter(tables, lambda t: _all(_has_header(t, w) for w in wanted)), F.lit(0))


def _has_header(table: Column, word: str) -> Column:
    return F.exists(table["headers"], lambda h: F.contains(F.lower(h), F.lit(word)))


def _all(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out


def records(table: Column) -> Column:
    """Rows as maps by header; cells beyond the headers are joined under ``_extra``."""
    n = F.size(table["headers"])

    def one(row: Column) -> Column:
        named = F.map_from_arrays(table["headers"], F.transform(table["headers"], lambda _, i: F.coalesce(F.get(row, i), F.lit(""))))
        extra = F.map_from_arrays(F.array(F.lit("_extra")), F.array(F.array_join(F.slice(row, n + 1, F.greatest(F.size(row) - n, F.lit(0))), " ")))
        return F.when(F.size(row) > n, F.map_concat(named, extra)).otherwise(named)

    return F.transform(table["rows"], one)
