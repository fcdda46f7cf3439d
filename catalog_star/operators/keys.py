"""Dense surrogate keys 1..n in a given order, without a single-partition window.

Rows are sorted within ordered partitions, and the number of rows in the partitions before is added.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from catalog_star.staging import stage


@dataclass(frozen=True)
class KnownKeys:
    """A key map that is read in part: its highest key, and how to get the rows that may hold natural keys of some others."""

    highest: int
    near: Callable[[DataFrame, Sequence[str]], DataFrame]


_SLOT_BITS = 33  # monotonically_increasing_id: partition above, row below


def number_rows(
    df: DataFrame, order: str | Sequence[str], key: str, start: int = 1, label: str = "numbered"
) -> DataFrame:
    """Add ``key`` = start, start+1, … following ``order``; the result is staged.

    Rows are range-partitioned and sorted, their place within the partition is
    recorded and the table is written once. A partition's first key is then the
    number of rows in the partitions before it: one small count per partition is all
    that reaches the driver. ``order`` must be unique, or tied rows are numbered in
    any order; a unique order also means that no value can overfill a partition.
    """
    order = [order] if isinstance(order, str) else list(order)
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        label,
    )
    partition = F.shiftright("_place", _SLOT_BITS).cast("int")
    sizes = {
        row["p"]: row["n"]
        for row in placed.groupBy(partition.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    counts = [sizes.get(p, 0) for p in range(max(sizes, default=-1) + 1)]
    number = _looked_up(accumulate(counts, initial=start), partition) + _slot(F.col("_place"))
    return placed.select(number.alias(key), *df.columns)


def number_within(df: DataFrame, groups: str | Sequence[str], order: str | Sequence[str], key: str, label: str = "numbered_within") -> DataFrame:
    """Add ``key`` = 1, 2, … following ``order`` within each group; the rows are staged in that order on the way.

    A segmented scan: rows are range-partitioned by group and order, so a group of any size is cut by its order, which must be unique
    within it. Rows are ranked within (partition, group), which no group can make larger than a partition. Only the groups at the
    edges of partitions span several; their counts in the partitions before, at most two for every partition, are added.
    """
    groups = [groups] if isinstance(groups, str) else list(groups)
    order = [order] if isinstance(order, str) else list(order)
    placed = stage(df.repartitionByRange(*groups, *order).withColumn("_part", F.spark_partition_id()), label)
    group = F.struct(*groups)
    edges = placed.groupBy("_part").agg(F.array(F.min(group), F.max(group)).alias("_edges"))
    spanning = edges.select("_part", F.explode(F.array_distinct("_edges")).alias("_group")).groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    counts = placed.select("_part", group.alias("_group")).join(F.broadcast(spanning.select("_group")), "_group", "left_semi")
    counts = counts.groupBy("_part", "_group").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_part").alias("_at"), F.col("_group").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part", *groups).orderBy(*order))
    ranked = placed.withColumn("_rank", inside)
    ranked = ranked.join(F.broadcast(offsets), (F.col("_part") == F.col("_at")) & group.eqNullSafe(F.col("_of")), "left")
    return ranked.select(*df.columns, (F.col("_rank") + F.coalesce("_before", F.lit(0))).cast("long").alias(key))


def _looked_up(table: Iterable[int], position: Column) -> Column:
    """Element of a constant array. A join would inflate the size estimate of the rows."""
    text = F.lit(",".join(map(str, table)))
    return F.get(F.split(text, ",").cast("array<bigint>"), position)


def _slot(place: Column) -> Column:
    return place.bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))


def matches(columns: Sequence[str], prefix: str = "_") -> Column:
    """Null-safe equality of columns with their namesakes under a prefix."""
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return same


def number_unseen(
    rows: DataFrame, known: DataFrame | KnownKeys | None, natural: Sequence[str], order: str, key: str, label: str
) -> DataFrame:
    """``rows`` with their keys: known natural keys keep theirs, others continue after the highest in ``order``.

    Natural keys are unique in ``rows`` and in ``known`` (key, natural columns). The result is staged.
    """
    if known is None:
        return number_rows(rows, order, key, label=label)
    if isinstance(known, KnownKeys):
        rows = stage(rows, f"{label}_batch")
        highest, known = known.highest, known.near(rows, natural)
    else:
        highest = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).first()["m"]
    right = known.select(key, *[F.col(c).alias(f"_{c}") for c in natural])
    found = rows.join(right, matches(natural), "left").select(key, *rows.columns)
    fresh = number_rows(found.where(F.col(key).isNull()).drop(key), order, key, start=highest + 1, label=f"{label}_new")
    return stage(found.where(F.col(key).isNotNull()).unionByName(fresh), label)


def extend_keys(
    values: DataFrame, known: DataFrame, natural: Sequence[str], order: str, key: str
) -> DataFrame:
    """Key map for ``values``: known ones keep their key, new ones continue after the highest.

    ``values`` holds one row per natural key with the position it was first seen at.
    """
    columns = list(natural)
    right = known.select(*[F.col(c).alias(f"_{c}") for c in columns])
    fresh = values.select(order, *columns).join(right, matches(columns), "left_anti")
    highest = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).first()["m"]
    added = number_rows(fresh, order, key, start=highest + 1, label=f"new_{key}")
    return known.select(key, *columns).unionByName(added.select(key, *columns))
