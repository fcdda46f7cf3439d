import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalog_star.operators import profile, quality, quantiles


@pytest.fixture(scope="module")
def frame():
    rng = random.Random(2)
    n = 3000
    return pd.DataFrame(
        {
            "id": range(n),
            "even": [rng.uniform(-5, 5) for _ in range(n)],
            "steps": [float(rng.choice([0.1, 0.2, 0.3, 0.3, 0.3])) for _ in range(n)],
            "skewed": [rng.expovariate(0.001) ** 3 for _ in range(n)],
            "holes": [None if i % 5 == 0 else float(i % 7) for i in range(n)],
            "flat": [4.0] * n,
            "kind": ["hot" if i % 3 == 0 else f"k{i % 17}" if i % 11 else None for i in range(n)],
        }
    )


@pytest.fixture(scope="module")
def df(spark, frame):
    rows = [tuple(None if pd.isna(x) else x for x in r) for r in frame.itertuples(index=False)]
    schema = "id long, even double, steps double, skewed double, holes double, flat double, kind string"
    return spark.createDataFrame(rows, schema).repartition(6)


NUMBERS = ["even", "steps", "skewed", "holes", "flat"]


@pytest.mark.parametrize("small", [100_000, 300, 5])
def test_describe_is_exact_for_any_size(df, frame, monkeypatch, small):
    monkeypatch.setattr(quantiles, "SMALL_RANGE", small)
    monkeypatch.setattr(quantiles, "GRID", 11)
    monkeypatch.setattr(quantiles, "ACCURACY", 55)
    found = {r["column"]: r for r in profile.describe(df, NUMBERS).collect()}
    wanted = frame[NUMBERS].describe()
    for c in NUMBERS:
        got = [found[c][k] for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
        assert got == pytest.approx(wanted[c].tolist(), rel=1e-12, abs=1e-9), c


def test_quantiles_are_the_same_bits_whatever_the_bounds(df, monkeypatch):
    counts = {c: df.where(f"{c} is not null and not isnan({c})").count() for c in NUMBERS}
    found = []
    for small, grid in ((100_000, 501), (300, 11), (5, 7)):
        monkeypatch.setattr(quantiles, "SMALL_RANGE", small)
        monkeypatch.setattr(quantiles, "GRID", grid)
        monkeypatch.setattr(quantiles, "ACCURACY", 5 * grid)
        found.append(quantiles.exact_quantiles(df, counts, [0.01, 0.1, 1 / 3, 0.5, 0.77, 0.99]))
    assert found[0] == found[1] == found[2]


def test_quantiles_survive_a_bad_estimate(df, frame, monkeypatch):
    monkeypatch.setattr(quantiles, "SMALL_RANGE", 50)
    monkeypatch.setattr(quantiles, "GRID", 11)
    monkeypatch.setattr(quantiles, "ACCURACY", 6)
    found = quantiles.exact_quantiles(df, {"even": 3000, "skewed": 3000}, [0.1, 0.9])
    for c in ("even", "skewed"):
        assert found[c] == pytest.approx(np.quantile(frame[c], [0.1, 0.9]).tolist())


def test_quantiles_of_nothing(df):
    empty = df.where("false")
    row = profile.describe(empty, ["even"]).first()
    assert row["count"] == 0 and row["q50"] is None and row["min"] is None


def test_correlations(df, frame):
    columns = ["even", "steps", "skewed", "holes"]
    found = {(r["column"], r["other"]): r["correlation"] for r in profile.correlations(df, columns).collect()}
    wanted = frame[columns].astype(float).corr()
    assert len(found) == 16
    for a in columns:
        for b in columns:
            assert found[a, b] == pytest.approx(wanted.loc[a, b], abs=1e-9)


def test_histogram_equals_numpy(df, frame):
    found = profile.histogram(df, ["even", "steps", "holes", "flat"], 50).orderBy("bin").collect()
    for c in ("even", "steps", "holes", "flat"):
        counts, edges = np.histogram(frame[c].dropna().astype(float), bins=50)
        mine = [r for r in found if r["column"] == c]
        assert [r["n"] for r in mine] == counts.tolist()
        assert [r["lower"] for r in mine] == pytest.approx(edges[:-1].tolist())
        assert mine[-1]["upper"] == edges[-1]
    assert profile.histogram(df.where("false"), ["even"]).count() == 0


def test_missing_and_distinct(df, frame):
    nulls = {r["column"]: (r["nulls"], r["null_pct"]) for r in profile.null_profile(df).collect()}
    assert nulls == {c: (frame[c].isna().sum(), round(frame[c].isna().mean() * 100, 2)) for c in frame.columns}
    assert profile.null_profile(df.where("false"), ["kind"]).first()["null_pct"] is None
    distinct = {r["column"]: r["distinct_values"] for r in profile.distinct_counts(df, ["kind", "holes"]).collect()}
    assert distinct == {"kind": frame["kind"].nunique(), "holes": frame["holes"].nunique()}
    about = {r["column"]: r["distinct_values"] for r in profile.distinct_counts(df, ["id"], approximate=True).collect()}
    assert about["id"] == pytest.approx(3000, rel=0.1)
    assert profile.missing_rows(df, "kind", ["id"]).count() == frame["kind"].isna().sum()


def test_frequencies(df, frame):
    counts = frame["kind"].value_counts()
    assert {r["kind"]: r["n"] for r in profile.value_counts(df, "kind").collect()} == counts.to_dict()
    ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert [tuple(r) for r in profile.top_values(df, "kind", 5).collect()] == ranked
    shares = {r["kind"]: r["share_pct"] for r in profile.value_shares(df, "kind").collect()}
    assert shares == (frame["kind"].value_counts(normalize=True) * 100).round(2).to_dict()
    assert [r["holes"] for r in profile.counts_by_value(df, "holes").collect()] == sorted(frame["holes"].dropna().unique())
    zero = profile.share_where(df, F.col("holes") == 0).first()
    assert zero["n"] == (frame["holes"] == 0).sum() and zero["share_pct"] == round((frame["holes"] == 0).mean() * 100, 1)
    assert tuple(profile.extent(df, "id").first()) == (0, 2999)
    assert profile.row_count(df).first()["rows"] == 3000
    assert [r["id"] for r in profile.head(df, "id", 4).collect()] == [0, 1, 2, 3]


def test_quality_reports(spark):
    years = spark.createDataFrame([(1957,), (1958,), (None,), (2031,)], "year int")
    assert tuple(quality.range_check(years, "year", 1958, 2030).first()) == (4, 2, 1957, 2031)
    hits = spark.createDataFrame([(True, ""), (True, "a"), (False, "b")], "hit boolean, k string")
    assert tuple(quality.match_rate(hits, "hit", "k").first()) == (3, 2, 1, 66.7, 1)
    facts = spark.createDataFrame([(1, 7), (1, 8), (2, 7), (3, None)], "a long, b long")
    known = {"a": spark.createDataFrame([(1,), (2,)], "a long"), "b": spark.createDataFrame([(8,)], "b long")}
    found = sorted(map(tuple, quality.orphans(facts, known).collect()), key=str)
    assert found == [("a", 3), ("b", 7), ("b", None)]
    with pytest.raises(quality.QualityError):
        quality.require_columns(facts, ["a", "z"], "facts")


@pytest.mark.parametrize("slots", [1, 7, 4096])
def test_frequent_values_are_exact(spark, slots):
    flat = [str(i) for i in range(300)]
    skewed = ["hot"] * 200 + ["warm"] * 50 + [v for v in flat for _ in range(1 + int(v) % 3)] + [None] * 400
    for found in (flat, skewed, ["one"] * 9, [], [None]):
        df = spark.createDataFrame([(v,) for v in found], "v string")
        for k in (1, 5, 20):
            assert profile.frequent_values(df, "v", k, slots).collect() == profile.top_values(df, "v", k).collect()


def test_frequent_values_of_a_skewed_column_shuffle_few(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 6).otherwise(F.col("id")).alias("v"))
    found = profile.frequent_values(df, "v", 2, slots=4096)
    assert [tuple(r) for r in found.collect()] == [(0, 33334), (3, 33334 - 1)]
    assert "Exchange hashpartitioning(v" not in found._jdf.queryExecution().executedPlan().toString()  # proven by the candidates


def test_comoments_of_parts_equal_the_whole(spark):
    rng = np.random.default_rng(4)
    x = 1e9 + rng.normal(size=600)
    y = 0.3 * (x - 1e9) + rng.normal(size=600)
    rows = [(i, float(a), None if i % 7 == 0 else float(b), 5.0, float("nan") if i % 11 == 0 else float(a - b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "i long, x double, y double, flat double, z double")
    columns = ["x", "y", "flat", "z"]
    parts = profile.comoments(df.where("i < 10"), columns)
    for share in ("i between 10 and 10", "i between 11 and 400", "i > 400", "i < 0"):
        parts = parts.unionByName(profile.comoments(df.where(share), columns))
    as_dict = lambda m: {(r["column"], r["other"]): r["correlation"] for r in m.collect()}
    got, merged_twice = as_dict(profile.correlations_of(parts, columns)), as_dict(profile.correlations_of(profile.merged_comoments(parts), columns))
    frame = pd.DataFrame([r[1:] for r in rows], columns=columns).astype(float)
    frame[["x", "z"]] -= [1e9, 1e9]  # the comparison itself must not lose digits
    want = frame.corr()
    assert len(got) == 16
    for (a, b), r in got.items():
        if "flat" in (a, b):
            assert r is None and merged_twice[a, b] is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-6) and merged_twice[a, b] == pytest.approx(r, abs=1e-9)


def test_comoments_of_nothing(spark):
    nothing = spark.createDataFrame([], "x double, y double")
    found = profile.correlations_of(profile.comoments(nothing, ["x", "y"]), ["x", "y"])
    assert [r["correlation"] for r in found.collect()] == [None] * 4
