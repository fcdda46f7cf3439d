"""Column profiles: missing values, frequencies, statistics, histograms, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from catalog_star.functions import values
from catalog_star.operators.quantiles import exact_quantiles
from catalog_star.staging import stage

QUARTILES = (0.25, 0.5, 0.75)


def _rows(named: dict[str, Sequence[Column]], fields: Sequence[str]) -> Column:
    """Turn one wide row into a row per column name."""
    structs = [
        F.struct(F.lit(name).alias("column"), *[v.alias(f) for v, f in zip(parts, fields)])
        for name, parts in named.items()
    ]
    return F.inline(F.array(*structs))


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that the table has."""
    return [c for c in columns if c in df.columns]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, in number and percent, from one aggregate."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    share = {
        c: [F.col(f"_{i}"), values.round_half_even(F.try_divide(F.col(f"_{i}"), F.col("_all")) * 100, 2)]
        for i, c in enumerate(columns)
    }
    return counted.select(_rows(share, ["nulls", "null_pct"]))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Number of distinct values per column, nulls left out.

    The exact form reduces each partition to distinct (column, value) pairs first.
    """
    columns = list(columns)
    if approximate:
        counted = df.agg(*[F.approx_count_distinct(c).alias(f"_{i}") for i, c in enumerate(columns)])
    else:
        counted = df.agg(*[F.count_distinct(c).alias(f"_{i}") for i, c in enumerate(columns)])
    return counted.select(_rows({c: [F.col(f"_{i}")] for i, c in enumerate(columns)}, ["distinct_values"]))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value; nulls are left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; ties go to the smaller value."""
    return value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(k)


def frequent_values(df: DataFrame, column: str, k: int, slots: int = 65_536) -> DataFrame:
    """``top_values`` without a shuffle of all distinct values where some values stand out.

    Values are hashed to ``slots``, and the rows of a slot bound the count of any value in it. The values of the fullest slots are counted
    exactly; the ``k``-th count among them bounds the result from below, so no value of a slot with fewer rows belongs to it. Any other
    slot with as many rows is counted too, which makes the result exact whatever the data. On a flat column that is every slot,
    and the cost is that of ``top_values`` and two scans more. At most ``slots`` numbers are ever held or broadcast.
    """
    values_ = df.select(column).where(F.col(column).isNotNull())
    slotted = values_.withColumn("_slot", F.pmod(F.xxhash64(column), F.lit(slots)).cast("int"))
    sizes = stage(slotted.groupBy("_slot").agg(F.count(F.lit(1)).alias("_rows")), "slot_sizes")

    def counted(chosen: DataFrame) -> DataFrame:
        # At most ``slots`` rows, so they may be broadcast.
        kept = slotted.join(F.broadcast(chosen.select("_slot")), "_slot", "left_semi")
        return kept.groupBy(column).agg(F.count(F.lit(1)).alias("n"))

    fullest = sizes.orderBy(F.desc("_rows"), "_slot").limit(2 * k)
    first = stage(counted(fullest).orderBy(F.desc("n"), F.asc(column)).limit(k), "slot_candidates")
    found, least = first.agg(F.count(F.lit(1)), F.min("n")).first()
    chosen = sizes.where(F.col("_rows") >= (least if found == k else 0))
    if chosen.join(fullest, "_slot", "left_anti").isEmpty():
        return first.orderBy(F.desc("n"), F.asc(column))
    return counted(chosen).orderBy(F.desc("n"), F.asc(column)).limit(k)


def counts_by_value(df: DataFrame, column: str) -> DataFrame:
    """Frequencies ordered by value."""
    return value_counts(df, column).orderBy(column)


def value_shares(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Share of each value in percent of all values.

    The total comes from a scalar subquery: a window over all values would put
    them into one task.
    """
    total = df.agg(F.count(column)).scalar()
    share = values.round_half_even(F.col("n") / total * 100, digits)
    return value_counts(df, column).withColumn("share_pct", share)


def share_where(df: DataFrame, condition: Column, digits: int = 1) -> DataFrame:
    """One row: number and percentage of rows that meet ``condition``."""
    met = F.coalesce(condition, F.lit(False))
    return df.agg(
        F.count_if(met).alias("n"),
        values.round_half_even(F.avg(met.cast("int")) * 100, digits).alias("share_pct"),
    )


def extent(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("lowest"), F.max(column).alias("highest"))


def head(df: DataFrame, order: str | Sequence[str], n: int) -> DataFrame:
    """First rows in order: a top-n per partition, then of those."""
    order = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*order).limit(n)


def missing_rows(df: DataFrame, column: str, show: Sequence[str]) -> DataFrame:
    """Rows that lack ``column``, reduced to the columns to show."""
    return df.where(F.col(column).isNull()).select(*show)


def describe(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    columns = list(columns)
    pruned = df.select(*columns)
    clean = {c: values.ignore_nan(F.col(c).cast("double")) for c in columns}
    names = ["count", "mean", "std", "min", "max"]
    functions = [F.count, F.avg, F.stddev_samp, F.min, F.max]
    row = pruned.agg(
        *[f(clean[c]).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in zip(names, functions)]
    ).first()
    stats = {c: {n: row[f"{n}_{i}"] for n in names} for i, c in enumerate(columns)}
    quartiles = exact_quantiles(pruned, {c: stats[c]["count"] for c in columns}, QUARTILES)
    table = [
        (c, stats[c]["count"], stats[c]["mean"], stats[c]["std"], stats[c]["min"], *quartiles[c], stats[c]["max"])
        for c in columns
    ]
    result = df.sparkSession.createDataFrame(
        table,
        "column string, count long, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double",
    )
    if digits is None:
        return result
    figures = [c for c in result.columns if c not in ("column", "count")]
    return result.withColumns({c: values.round_half_even(F.col(c), digits) for c in figures})


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form; a pair uses the rows in which both have a value."""
    columns = list(columns)
    clean = {c: values.ignore_nan(F.col(c).cast("double")) for c in columns}
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    counted = df.agg(*[F.corr(clean[columns[i]], clean[columns[j]]).alias(f"_{i}_{j}") for i, j in pairs])
    cells = [
        F.struct(
            F.lit(columns[i]).alias("column"),
            F.lit(columns[j]).alias("other"),
            F.col(f"_{min(i, j)}_{max(i, j)}").alias("correlation"),
        )
        for i in range(len(columns))
        for j in range(len(columns))
    ]
    return counted.select(F.inline(F.array(*cells)))


#: Fields of the co-moments of a pair: rows in which both have a value, their means, sums of squared deviations and of products.
MOMENTS = ("n", "mean_x", "mean_y", "sxx", "syy", "sxy")


def comoments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What correlations of a part of a table add up from: a row per pair of columns, whatever the rows. One scan; no values give n = 0."""
    columns = list(columns)
    clean = {c: values.ignore_nan(F.col(c).cast("double")) for c in columns}
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    functions = (F.regr_count, F.regr_avgx, F.regr_avgy, F.regr_sxx, F.regr_syy, F.regr_sxy)
    row = df.agg(*[f(clean[b], clean[a]).alias(f"_{i}_{m}") for i, (a, b) in enumerate(pairs) for m, f in zip(MOMENTS, functions)])
    cells = [
        F.struct(F.lit(a).alias("column"), F.lit(b).alias("other"), *[F.col(f"_{i}_{m}").alias(m) for m in MOMENTS]) for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*cells)))


def merged_comoments(parts: DataFrame) -> DataFrame:
    """Co-moments of the union of parts: within parts, and of the parts' means around the common ones.

    Deviations are taken from means, never from zero, so large values with little spread lose nothing. Parts may come
    in any number and order, and be merged before.
    """
    held = parts.where("n > 0")
    common = held.groupBy("column", "other").agg(
        F.sum("n").alias("_n"),
        F.min("mean_x").alias("_x"),
        F.min("mean_y").alias("_y"),
    )
    # Means around one of the parts' means: their sum has no large terms that cancel.
    away = held.join(common, ["column", "other"]).withColumns({"_dx": F.col("mean_x") - F.col("_x"), "_dy": F.col("mean_y") - F.col("_y")})
    mean = {d: F.sum(F.col("n") * F.col(d)) / F.sum("n") for d in ("_dx", "_dy")}

    def spread(inside: str, a: str, b: str) -> Column:
        return F.sum(inside) + F.sum(F.col("n") * F.col(a) * F.col(b)) - F.sum("n") * mean[a] * mean[b]

    return away.groupBy("column", "other").agg(
        F.sum("n").alias("n"),
        (F.first("_x") + mean["_dx"]).alias("mean_x"),
        (F.first("_y") + mean["_dy"]).alias("mean_y"),
        spread("sxx", "_dx", "_dx").alias("sxx"),
        spread("syy", "_dy", "_dy").alias("syy"),
        spread("sxy", "_dx", "_dy").alias("sxy"),
    )


def correlations_of(moments: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The matrix that ``correlations`` gives, from co-moments kept of all parts of a table. A constant column correlates with nothing: null."""
    one = merged_comoments(moments).withColumn("_r", F.try_divide(F.col("sxy"), F.sqrt("sxx") * F.sqrt("syy")))
    both = one.select("column", "other", "_r").unionByName(
        one.where("column != other").select(F.col("other").alias("column"), F.col("column").alias("other"), "_r")
    )
    frame = moments.sparkSession.createDataFrame([(a, b) for a in columns for b in columns], "column string, other string")
    return frame.join(both, ["column", "other"], "left").withColumnRenamed("_r", "correlation")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins per column, the last one closed, empty ones included.

    Two aggregates over the pruned columns: the extents, then counts per bin. A
    value belongs to the bin whose computed edges enclose it, whatever the rounding of
    its quotient. A column with one value gets a range of width one around it.
    """
    columns = list(columns)
    pruned = df.select(*columns)
    clean = {c: values.ignore_nan(F.col(c).cast("double")) for c in columns}
    row = pruned.agg(
        *[f(clean[c]).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    limits = []
    for i, c in enumerate(columns):
        low, high = row[f"lo_{i}"], row[f"hi_{i}"]
        if low is None:
            continue
        limits.append((c, low, high) if low < high else (c, low - 0.5, high + 0.5))

    def bin_of(c: str, low: float, high: float) -> Column:
        width = (high - low) / bins
        guess = F.least(F.floor((clean[c] - F.lit(low)) * F.lit(bins / (high - low))), F.lit(bins - 1))
        too_high = clean[c] < guess * F.lit(width) + F.lit(low)
        too_low = (clean[c] >= (guess + 1) * F.lit(width) + F.lit(low)) & (guess < bins - 1)
        return guess - too_high.cast("int") + too_low.cast("int") + 1

    if not limits:
        return df.sparkSession.createDataFrame(
            [], "column string, bin int, lower double, upper double, n long"
        )
    placed = pruned.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("_c"), bin_of(c, lo, hi).cast("int").alias("_b")) for c, lo, hi in limits])
        )
    )
    filled = placed.where(F.col("_b").isNotNull()).groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_n"))
    frame = df.sparkSession.createDataFrame(limits, "column string, low double, high double")
    frame = frame.select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("high") - F.col("low")) / F.lit(bins)
    # At most ``bins`` counts per column exist, so they may be broadcast.
    return frame.join(
        F.broadcast(filled), (F.col("column") == F.col("_c")) & (F.col("bin") == F.col("_b")), "left"
    ).select(
        "column",
        "bin",
        (width * (F.col("bin") - 1) + F.col("low")).alias("lower"),
        F.when(F.col("bin") == bins, F.col("high")).otherwise(width * F.col("bin") + F.col("low")).alias("upper"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )
