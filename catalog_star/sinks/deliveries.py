"""Duplicates across deliveries: what came before is known by digests, so a delivery is compared with all earlier ones without reading their rows.

A delivered table is three tables of a versioned warehouse: its distinct rows, the digests of their keys with how often each came, and a row of
figures for every delivery. All three change in one version, so a delivery that breaks off counts for nothing and one that is repeated counts once.
Digests lie in buckets with bitmaps: a delivery reads only buckets that may hold one of its own. Segments of digests of like size are merged, their
counts added up.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from catalog_star.operators.dedup import key_digest
from catalog_star.sinks.versions import Snapshot, VersionedWarehouse
from catalog_star.staging import stage

#: What a delivery adds to the totals over all deliveries.
FIGURES = ("rows", "distinct_rows", "repeats", "members")


@dataclass(frozen=True)
class DeliveredTable:
    """A table that grows by deliveries. ``keys`` say when rows are the same (all columns but ``order``, if not given); of the same
    rows the one of the earliest delivery stays, within it the one of least ``order``."""

    house: VersionedWarehouse
    name: str
    order: str
    keys: Sequence[str] | None = None

    @property
    def _digests(self) -> str:
        return f"{self.name}_digests"

    @property
    def _figures(self) -> str:
        return f"{self.name}_deliveries"

    def deliver(self, rows: DataFrame, label: str) -> bool:
        """Take a delivery; false if one of this label was taken before, which changes nothing.

        Nulls in keys are equal to each other. An empty delivery is noted. The rows are read once; rows with equal keys are merged before
        the shuffle, and the join with earlier digests has one row a digest on both sides, so a key that repeats often weighs no more than another.
        """
        with self.house.load() as load:
            base = load.base
            taken = base.read(self._figures)
            if taken is not None and not taken.where(F.col("delivery") == label).isEmpty():
                return False
            keys = list(self.keys) if self.keys is not None else [c for c in rows.columns if c != self.order]
            first = F.struct(F.col(self.order), key_digest(rows.columns))
            own = rows.groupBy(key_digest(keys).alias("digest")).agg(
                F.count(F.lit(1)).alias("copies"), F.min_by(F.struct(*rows.columns), first).alias("_row")
            )
            own = stage(own, "delivered")
            before = base.near(self._digests, own, ["digest"])
            if before is None:
                met = own.withColumn("_before", F.lit(0).cast("long"))
            else:
                counted = stage(before.groupBy("digest").agg(F.sum("copies").alias("_before")), "delivered_before")
                met = stage(own.join(counted, "digest", "left").withColumn("_before", F.coalesce("_before", F.lit(0))), "delivered_met")
            new, after = F.col("_before") == 0, F.col("_before") + F.col("copies")
            figures = {
                "rows": F.sum("copies"),
                "distinct_rows": F.count_if(new),
                "repeats": F.sum(F.col("copies") - new.cast("long")),
                "members": F.sum(F.when(after > 1, after).otherwise(0) - F.when(F.col("_before") > 1, F.col("_before")).otherwise(0)),
            }
            load.append(met.where(new).select("_row.*"), self.name)
            load.append(met.select("digest", "copies"), self._digests, natural=["digest"])
            noted = met.agg(*[F.coalesce(figures[f], F.lit(0)).cast("long").alias(f) for f in FIGURES])
            load.append(noted.select(F.lit(label).alias("delivery"), *FIGURES), self._figures)
            load.compact(self.name)
            load.compact(self._figures)
            load.compact(self._digests, combine=_added_up)
        return True

    def distinct_rows(self, snapshot: Snapshot | None = None) -> DataFrame | None:
        """The first row of every key over all deliveries; nothing before the first delivery."""
        return (snapshot or self.house.snapshot()).read(self.name)

    def deliveries(self, snapshot: Snapshot | None = None) -> DataFrame | None:
        """One row per delivery: its rows, the distinct ones it brought, and what it added to repeats and members of repeated groups."""
        return (snapshot or self.house.snapshot()).read(self._figures)

    def duplicate_counts(self, snapshot: Snapshot | None = None) -> DataFrame | None:
        """One row as ``dedup.duplicate_counts`` gives over the union of all deliveries, from one row per delivery."""
        noted = self.deliveries(snapshot)
        return None if noted is None else noted.agg(F.sum("repeats").alias("repeats"), F.sum("members").alias("members"))

    def copies_of(self, rows: DataFrame, keys: Sequence[str], snapshot: Snapshot | None = None) -> DataFrame:
        """``rows`` with ``_copies``, how often their key came over all deliveries: 0 if never, above 1 if it repeats.

        Digests of the rows are made distinct before they meet the delivered ones; the rows take the counts back in a join of staged tables.
        """
        asked = stage(rows.withColumn("_asked", key_digest(keys)), "asked")
        own = stage(asked.select(F.col("_asked").alias("digest")).distinct(), "asked_digests")
        before = (snapshot or self.house.snapshot()).near(self._digests, own, ["digest"])
        if before is None:
            return asked.drop("_asked").withColumn("_copies", F.lit(0).cast("long"))
        known = stage(before.join(own, "digest", "left_semi").groupBy("digest").agg(F.sum("copies").alias("_copies")), "asked_known")
        return asked.join(known, asked["_asked"] == known["digest"], "left").select(
            *[asked[c] for c in rows.columns], F.coalesce("_copies", F.lit(0)).alias("_copies")
        )


def _added_up(segments: DataFrame) -> DataFrame:
    return segments.groupBy("digest").agg(F.sum("copies").alias("copies"))
