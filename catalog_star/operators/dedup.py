"""Order-aware deduplication.

Row order is an explicit column: a DataFrame has no order of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from catalog_star.staging import stage


def distinct_rows(df: DataFrame, order: str, copies: str | None = None) -> DataFrame:
    """Drop full-row duplicates, ignoring ``order``; the earliest copy stays.

    A hash aggregate with a map-side half: copies of one row that sit in the
    same partition are merged before the shuffle. ``copies`` names a column for the
    number of rows each survivor stands for.
    """
    data = [c for c in df.columns if c != order]
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    return (
        df.groupBy(*data)
        .agg(F.min(order).alias(order), *counted)
        .select(*df.columns, *([copies] if copies else []))
    )


def first_seen(df: DataFrame, columns: str | Sequence[str], order: str) -> DataFrame:
    """Distinct values of ``columns`` with the position each first appeared at."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    return df.groupBy(*columns).agg(F.min(order).alias(order))


def keep_first(
    df: DataFrame, keys: Sequence[str], order: str, collapse: bool = False
) -> DataFrame:
    """Earliest row per key.

    The rank filter reaches the map side of the shuffle, so a partition sends at
    most one row per key however many it holds. ``collapse`` first merges equal
    rows in a hash aggregate; use it when rows repeat often (few distinct rows per
    key), because it spares the map side from sorting all of them.
    """
    columns = df.columns
    if collapse:
        df = first_seen(df, [c for c in columns if c != order], order)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rank", rank).where("_rank = 1").select(*columns)


def key_digest(columns: Sequence[str]) -> Column:
    """256 bits that stand for the values of some columns; nulls are equal to each other and to nothing else.

    Values are marked and prefixed by their length, so no two lists of values read alike.
    """
    parts = []
    for c in columns:
        value = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``repeats`` after the first copy, and ``members`` of all repeated groups.

    Groups are counted by digest, so long values stay where they are. Nulls compare equal.
    """
    return (
        df.groupBy(key_digest(keys).alias("_digest"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeats"),
            F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("members"),
        )
    )


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once.

    A window count would pull each whole group into one task. Counting is a two-sided aggregate of digests
    instead, and the repeated ones come back through a semi join: they are staged, so a small
    set is broadcast by its true size and a large one is a plain shuffle join whose hot keys adaptive
    execution splits.
    """
    digest = key_digest(keys)
    repeated = stage(
        df.groupBy(digest.alias("_repeated")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "repeated_keys"
    )
    return df.join(repeated, digest == F.col("_repeated"), "left_semi")
