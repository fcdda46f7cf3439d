"""Data-quality checks and the audit of row counts per step."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_star.functions import values

log = logging.getLogger(__name__)


class QualityError(ValueError):
    """An input breaks its contract."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail on an empty input; reads at most one row."""
    if df.isEmpty():
        raise QualityError(f"{what} is empty")
    return df


def require_columns(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    """Fail on missing columns; looks at the schema only."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"{what} lacks {', '.join(missing)}")
    return df


def require_unique(df: DataFrame, column: str) -> None:
    """Fail if a column that is to order rows has repeated or missing values."""
    rows = df.count()
    values_found = df.select(column).where(F.col(column).isNotNull()).distinct().count()
    if rows != values_found:
        raise QualityError(f"{column} does not order rows: {values_found} values in {rows} rows")


class Audit:
    """Named figures of a run: rows per step, removals, load counts.

    Figures are read from staged or written tables. Metrics gathered inside a running
    job would count rows twice whenever a lost executor makes a stage run again.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._rows: list[tuple[str, str, int]] = []

    def add(self, step: str, **figures: int) -> None:
        for figure, value in figures.items():
            log.info("%s: %s = %s", step, figure, value)
            self._rows.append((step, figure, None if value is None else int(value)))

    def add_row(self, step: str, report: DataFrame) -> None:
        """Add the whole-number figures of a one-row report."""
        found = report.first().asDict()
        self.add(step, **{k: v for k, v in found.items() if v is None or isinstance(v, int)})

    def figures(self) -> dict[str, dict[str, int]]:
        table: dict[str, dict[str, int]] = {}
        for step, figure, value in self._rows:
            table.setdefault(step, {})[figure] = value
        return table

    def frame(self) -> DataFrame:
        """One row per step and figure."""
        rows = [(n, *row) for n, row in enumerate(self._rows, 1)]
        return self._spark.createDataFrame(rows, "position int, step string, figure string, value long")


def range_check(df: DataFrame, column: str, low, high) -> DataFrame:
    """One row: violations of the range and the range that was found."""
    c = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(values.outside(c, low, high)).alias("violations"),
        F.min(c).alias("lowest"),
        F.max(c).alias("highest"),
    )


def match_rate(df: DataFrame, flag: str, join_key: str) -> DataFrame:
    """One row: matched rows, their share in percent, and matches on an empty join key."""
    hit = F.col(flag)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(hit).alias("matched"),
        F.count_if(~hit).alias("unmatched"),
        values.round_half_even(F.avg(hit.cast("int")) * 100, 1).alias("matched_pct"),
        F.count_if(hit & (F.col(join_key) == "")).alias("matched_on_empty"),
    )


def repeated_ids(df: DataFrame, column: str) -> DataFrame:
    """One row: rows whose id an earlier row has too, as they are kept on purpose."""
    return df.agg((F.count(column) - F.count_distinct(column)).alias("repeated_ids_kept"))


def removal_counts(
    distinct: DataFrame, copies: str, identity: list[str], column: str, value
) -> DataFrame:
    """One row: how many rows each cleaning step removes.

    ``distinct`` holds one row per distinct input row and how many copies it had. Copies
    agree on every filter, so one pass over a few columns gives all the counts.
    """
    missing = F.lit(False)
    for c in identity:
        missing = missing | F.col(c).isNull()
    invalid = F.col(column).eqNullSafe(F.lit(value))
    n = F.col(copies)
    return distinct.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(missing).alias("missing_removed"),
        F.count_if(~missing & invalid).alias("invalid_removed"),
        F.count_if(~missing & ~invalid).alias("rows_out"),
    )


def orphans(facts: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Foreign keys without a dimension row, as (reference, key).

    ``dimensions`` maps a key column to its dimension. Keys are made distinct before
    they are compared, so a hot key travels once per partition.
    """
    found = None
    for key, dimension in dimensions.items():
        used = facts.select(F.col(key).alias("key")).distinct()
        known = dimension.select(F.col(key).alias("key"))
        lost = used.join(known, "key", "left_anti").select(F.lit(key).alias("reference"), "key")
        found = lost if found is None else found.unionByName(lost)
    return found
