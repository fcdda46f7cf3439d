"""CSV scans that follow a data-frame library's reading rules.

Cells are read as text by column name, missing-value tokens become null, and types
are cast afterwards: type inference costs a pass and knows a single null token.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, IntegralType, StringType, StructField, StructType

from catalog_star.operators.keys import number_rows
from catalog_star.operators.quality import Audit, QualityError
from catalog_star.schemas import NA_TOKENS

UTF8 = "UTF-8"
LATIN1 = "ISO-8859-1"
_EXTRA = "_extra"


@dataclass(frozen=True)
class CsvLayout:
    """How a file must be read; files of one layout are read together."""

    encoding: str
    multiline: bool
    header: str | None = None


def probe_csv(spark: SparkSession, path: str) -> dict[CsvLayout, list[str]]:
    """The files below a path by layout, found out in one splittable pass.

    Bytes that are not UTF-8 call for Latin-1. Records span lines only if some line
    holds an odd number of quotes; files without one can be read in splits. Header lines are told apart, as
    columns may come in another order. A row per file reaches the driver.
    """
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    first = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    found = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("file"), first.alias("place"), line, quotes.alias("quotes"))
        .groupBy("file")
        .agg(
            F.count_if(~F.is_valid_utf8(line)).alias("invalid"),
            F.count_if(F.col("quotes") % 2 == 1).alias("open_quotes"),
            F.min_by(F.hex(line.cast("binary")), "place").alias("header"),
        )
        .collect()
    )
    layouts: dict[CsvLayout, list[str]] = {}
    for row in sorted(found, key=lambda r: r["file"]):
        layout = CsvLayout(LATIN1 if row["invalid"] else UTF8, bool(row["open_quotes"]), row["header"])
        layouts.setdefault(layout, []).append(row["file"])
    return layouts


def _reader(spark: SparkSession, layout: CsvLayout):
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("encoding", layout.encoding)
        .option("multiLine", layout.multiline)
    )


def null_tokens(c: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """Missing-value tokens become null; the comparison is exact."""
    return F.when(~c.isin(*tokens), c)


def typed(c: Column, field: StructField) -> Column:
    """Cast a text cell; whole numbers may be written as ``4.0``. What does not fit the type becomes null, never a part of itself."""
    if isinstance(field.dataType, StringType):
        return c
    if isinstance(field.dataType, IntegralType):
        kind, number = field.dataType, c.try_cast("double")
        return F.when(c.contains("."), F.when(number == F.floor(number), number.try_cast(kind))).otherwise(
            F.coalesce(c.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))
        )
    if isinstance(field.dataType, BooleanType):
        return F.lower(c).try_cast("boolean")
    return c.try_cast(field.dataType)


_PLACE = ["_file", "_block", "_row"]


def _cells(
    spark: SparkSession, path: str, encoding: str | None, multiline: bool | None, bad_lines: str, tokens: Sequence[str]
) -> tuple[DataFrame, int]:
    """All columns as text with each row's place (file, block, row in it), and the number of files."""
    if bad_lines not in ("error", "skip"):
        raise ValueError("bad_lines must be 'error' or 'skip'")
    rows, files = None, 0
    for found, names_of_files in probe_csv(spark, path).items():
        files += len(names_of_files)
        layout = CsvLayout(encoding or found.encoding, found.multiline if multiline is None else multiline)
        names = _reader(spark, layout).csv(names_of_files[0]).columns
        wide = StructType([StructField(c, StringType()) for c in [*names, _EXTRA]])
        own = _reader(spark, layout).schema(wide).csv(names_of_files)
        surplus = F.col(_EXTRA)
        if bad_lines == "skip":
            own = own.where(surplus.isNull())
        else:
            message = F.lit(f"line with more than {len(names)} fields in {path}")
            own = own.where(F.when(surplus.isNull(), True).otherwise(F.raise_error(message).cast("boolean")))
        own = own.select(
            *[null_tokens(F.col(f"`{c}`"), tokens).alias(c) for c in names],
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    if rows is None:
        raise QualityError(f"{path} holds no line")
    return rows, files


def read_csv_text(
    spark: SparkSession,
    path: str,
    encoding: str | None = None,
    multiline: bool | None = None,
    bad_lines: str = "error",
    tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """All columns of the CSV files with header below a path, as text.

    Encoding, line breaks within records and the order of columns are found out per file; columns that only some
    files have are null elsewhere. ``bad_lines`` is what happens to a line with more fields than its header:
    ``error`` fails the job, ``skip`` leaves it out. Short lines are filled with nulls.
    """
    return _cells(spark, path, encoding, multiline, bad_lines, tokens)[0].drop(*_PLACE)


def cast_losses(cells: DataFrame, schema: StructType) -> DataFrame:
    """One row: per column, how many cells had text that its type cannot hold."""
    lost = [
        F.count_if(F.col(f"`{f.name}`").isNotNull() & typed(F.col(f"`{f.name}`"), f).isNull()).alias(f.name)
        for f in schema.fields
        if f.name in cells.columns
    ]
    return cells.agg(*lost)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    order: str | None = None,
    index: str = "_c0",
    audit: Audit | None = None,
    encoding: str | None = None,
    multiline: bool | None = None,
    bad_lines: str = "error",
    tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """CSV files with the columns and types of ``schema``, found by name.

    ``order`` receives a file's own index column (an unnamed first column is called ``_c0``). Where there is none, or
    several files each have their own, rows are numbered from 0 by file, block and row, however Spark packs
    files into tasks. ``audit`` receives the number of cells per column that were lost to a cast; that costs a pass.
    """
    cells, files = _cells(spark, path, encoding, multiline, bad_lines, tokens)
    absent = [f.name for f in schema.fields if f.name not in cells.columns and f.name != order]
    if absent:
        raise QualityError(f"{path} lacks {', '.join(absent)}")
    if audit:
        audit.add_row("csv: cells lost to casts", cast_losses(cells, schema))
    columns = {f.name: typed(F.col(f"`{f.name}`"), f).alias(f.name) for f in schema.fields if f.name != order}
    if not order or order not in schema.names:
        return cells.select(*columns.values())
    if index in cells.columns and files == 1:
        columns[order] = F.col(index).try_cast("long").alias(order)
        return cells.select(*[columns[name] for name in schema.names])
    numbered = number_rows(cells.select(*_PLACE, *columns.values()), _PLACE, order, start=0, label="csv")
    return numbered.select(*schema.names)
