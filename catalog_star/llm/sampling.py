"""Bounded draws that are a function of the rows alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_below(hashed: Column, share: Column | float) -> Column:
    """Whether a 64-bit hash lies in the lowest ``share`` of its range."""
    share = F.lit(float(share)) if isinstance(share, (int, float)) else share
    return hashed.cast("double") <= share * 2.0**64 - 2.0**63


def smallest_hashes(rows: DataFrame, columns: list[str], limit: int, slack: float = 4.0) -> DataFrame:
    """At most ``limit`` rows, those of smallest hash of ``columns``, ties by the columns themselves.

    Rows far above the likely threshold are left out first, so what is ranked does not grow with the number of partitions.
    """
    count = rows.count()
    hashed = F.xxhash64(*columns)
    return rows.where(hash_below(hashed, slack * limit / max(1, count))).orderBy(hashed, *columns).limit(limit)
