import random

import pytest

from catalog_star.operators import dedup, keys


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_distinct_rows_keeps_earliest_and_counts(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "a", "x"), (5, None, None), (4, None, None)], "o long, a string, b string")
    assert rows(dedup.distinct_rows(df, "o")) == rows(spark.createDataFrame([(1, "a", None), (2, "a", "x"), (4, None, None)], df.schema))
    assert {r["o"]: r["n"] for r in dedup.distinct_rows(df, "o", copies="n").collect()} == {1: 2, 2: 1, 4: 2}


@pytest.mark.parametrize("collapse", [False, True])
def test_keep_first_with_a_hot_key(spark, collapse):
    rng = random.Random(1)
    data = [(i, "hot" if i % 3 == 0 else f"k{rng.randint(0, 50)}", rng.choice("xyz")) for i in range(2000)] + [(2000, None, "n"), (2001, None, "m")]
    df = spark.createDataFrame(data, "o long, k string, v string").repartition(8)
    wanted = {}
    for o, k, v in data:
        wanted.setdefault(k, (o, k, v))
    assert rows(dedup.keep_first(df, ["k"], "o", collapse)) == sorted(wanted.values(), key=str)


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(x,) for x in ["a", "a", "b", None, None, "c"]], "k string")
    assert tuple(dedup.duplicate_counts(df, ["k"]).first()) == (2, 4)
    assert rows(dedup.duplicated_rows(df, ["k"])) == [("a",), ("a",), (None,), (None,)]
    assert tuple(dedup.duplicate_counts(df.where("false"), ["k"]).first()) == (0, 0)
    two = spark.createDataFrame([(1, None), (1, None), (1, 2), (2, None)], "a int, b int")
    assert rows(dedup.duplicated_rows(two, ["a", "b"])) == [(1, None), (1, None)]


@pytest.mark.parametrize("partitions", [1, 9])
def test_number_rows_by_several_columns(spark, partitions):
    data = [(i % 7, chr(97 + i % 11), i) for i in range(500)]
    df = spark.createDataFrame(data, "a int, b string, c int").repartition(partitions)
    found = [tuple(r) for r in keys.number_rows(df, ["a", "b", "c"], "key", start=10).orderBy("key").collect()]
    assert found == [(n, *row) for n, row in enumerate(sorted(data), 10)]


def test_number_rows_of_nothing(spark):
    df = spark.createDataFrame([], "a int")
    assert keys.number_rows(df, "a", "key").count() == 0


def test_uneven_orders_are_numbered_alike(spark):
    for orders in ([*range(1000), 10**12], [-(2**62), 0, 2**62], [x * 3 - 100 for x in range(1000) if x % 10 != 4]):
        df = spark.createDataFrame([(o,) for o in orders], "o long").repartition(5)
        found = [tuple(r) for r in keys.number_rows(df, "o", "key").orderBy("o").collect()]
        assert found == [(n, o) for n, o in enumerate(orders, 1)]


def test_unseen_keys_continue_and_known_ones_stay(spark):
    known = spark.createDataFrame([(1, "b"), (7, None)], "key long, v string")
    seen = spark.createDataFrame([("b", 5, "x"), (None, 3, "y"), ("z", 9, "x"), ("a", 1, "x")], "v string, o long, w string")
    found = keys.number_unseen(seen, known, ["v"], "o", "key", "unseen")
    assert sorted(map(tuple, found.collect())) == [(1, "b", 5, "x"), (7, None, 3, "y"), (8, "a", 1, "x"), (9, "z", 9, "x")]


def test_digests_tell_values_apart(spark):
    values = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), (None, None), ("-", None), ("1:a", "b")]
    df = spark.createDataFrame(values * 2, "a string, b string")
    assert df.select(dedup.key_digest(["a", "b"])).distinct().count() == len(values)
    assert tuple(dedup.duplicate_counts(df, ["a", "b"]).first()) == (len(values), 2 * len(values))


def test_extended_keys_continue(spark):
    known = spark.createDataFrame([(1, "b"), (2, None)], "key long, v string")
    seen = spark.createDataFrame([("b", 5), (None, 3), ("z", 9), ("a", 11)], "v string, o long")
    found = keys.extend_keys(seen, known, ["v"], "o", "key")
    assert rows(found) == rows(spark.createDataFrame([(1, "b"), (2, None), (3, "z"), (4, "a")], "key long, v string"))
    again = keys.extend_keys(seen, found, ["v"], "o", "key")
    assert again.count() == 4


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_within_groups(spark, partitions):
    data = [(None if i % 3 == 0 else i % 50, chr(97 + i % 4), i * 7 % 3001) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, h string, o int").repartition(partitions)
    found = sorted(map(tuple, keys.number_within(df, ["g", "h"], "o", "n").collect()), key=str)
    seen, expected = {}, []
    for g, h, o in sorted(data, key=lambda r: r[2]):
        seen[g, h] = seen.get((g, h), 0) + 1
        expected.append((g, h, o, seen[g, h]))
    assert found == sorted(expected, key=str)
    assert keys.number_within(df.where("false"), "g", "o", "n").collect() == []
