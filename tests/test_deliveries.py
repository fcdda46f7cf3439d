"""Duplicates across deliveries: rows, figures and counts equal those of the union, and little is read and written for a small delivery."""

import pytest
from pyspark.sql import functions as F

from catalog_star.operators import dedup
from catalog_star.sinks import deliveries
from catalog_star.sinks.deliveries import DeliveredTable
from catalog_star.sinks.versions import VersionedWarehouse

SCHEMA = "ord long, name string, n long"


@pytest.fixture
def house(spark, tmp_path):
    return VersionedWarehouse(spark, str(tmp_path / "house"), buckets=16)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_deliveries_equal_their_union(spark, house):
    table = DeliveredTable(house, "names", "ord")
    parts = [
        batch(spark, [(3, "a", 1), (2, "a", 1), (1, None, None), (4, "b", 2)]),
        batch(spark, [(5, "a", 1), (6, None, None), (7, "c", 3), (8, "", None)]),
        batch(spark, []),
        batch(spark, [(9, "b", 2), (10, "b", None), (11, "c", 3)]),
    ]
    for i, part in enumerate(parts):
        assert table.deliver(part, f"d{i}")
        union = parts[0]
        for other in parts[1 : i + 1]:
            union = union.unionByName(other)
        assert rows_of(table.distinct_rows()) == rows_of(dedup.distinct_rows(union, "ord"))
        assert rows_of(table.duplicate_counts()) == rows_of(dedup.duplicate_counts(union, ["name", "n"]))
    asked = batch(spark, [(0, "a", 1), (0, "a", 1), (0, None, None), (0, "z", 9), (0, "", None)])
    assert rows_of(table.copies_of(asked, ["name", "n"]).select("name", "n", "_copies")) == sorted(
        [("a", 1, 3), ("a", 1, 3), (None, None, 2), ("z", 9, 0), ("", None, 1)], key=str
    )
    assert [r["rows"] for r in table.deliveries().orderBy("delivery").collect()] == [4, 4, 0, 3]


def test_the_first_row_of_a_key_stays(spark, house):
    table = DeliveredTable(house, "names", "ord", keys=["name"])
    table.deliver(batch(spark, [(2, "a", 20), (1, "a", 10)]), "late")
    table.deliver(batch(spark, [(0, "a", 0), (5, "b", 5)]), "early")  # a lower place in a later delivery does not replace
    assert rows_of(table.distinct_rows()) == [(1, "a", 10), (5, "b", 5)]


def test_nothing_before_the_first_delivery(spark, house):
    table = DeliveredTable(house, "names", "ord")
    assert table.distinct_rows() is None and table.duplicate_counts() is None
    assert rows_of(table.copies_of(batch(spark, [(1, "a", 1)]), ["name"])) == [(1, "a", 1, 0)]


def test_a_delivery_counts_once(spark, house):
    table = DeliveredTable(house, "names", "ord")
    part = batch(spark, [(1, "a", 1), (2, "a", 1)])
    assert table.deliver(part, "monday") and not table.deliver(part, "monday")
    assert rows_of(table.duplicate_counts()) == [(1, 2)]


def test_a_delivery_that_breaks_off_leaves_nothing(spark, house, monkeypatch):
    table = DeliveredTable(house, "names", "ord")
    table.deliver(batch(spark, [(1, "a", 1)]), "one")
    version = house.snapshot().version

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(deliveries.F, "count_if", fail)
    with pytest.raises(RuntimeError):
        table.deliver(batch(spark, [(2, "a", 1), (3, "b", 1)]), "two")
    monkeypatch.undo()
    assert house.snapshot().version == version
    assert table.deliver(batch(spark, [(2, "a", 1), (3, "b", 1)]), "two")
    assert rows_of(table.duplicate_counts()) == [(1, 2)]


def test_a_small_delivery_reads_few_buckets_and_rewrites_no_large_segment(spark, house):
    table = DeliveredTable(house, "numbers", "ord")
    big = spark.range(20_000).select(F.col("id").alias("ord"), F.concat(F.lit("n"), "id").alias("name"), F.col("id").alias("n"))
    table.deliver(big, "big")
    large = house.snapshot().tables["numbers_digests"].segments[0]
    small = batch(spark, [(1, "n7", 7)])
    digest = small.select(dedup.key_digest(["name", "n"]).alias("digest"))
    snapshot = house.snapshot()
    ((_, touched),) = snapshot.touched(snapshot.tables["numbers_digests"], digest, ["digest"])
    assert len(touched) == 1
    for i in range(9):
        table.deliver(batch(spark, [(1, "n7", 7), (2, f"new{i}", i)]), f"small{i}")
    segments = house.snapshot().tables["numbers_digests"].segments
    assert large in segments and len(segments) < 9  # the small ones were merged, the large one stays
    assert rows_of(table.duplicate_counts()) == [(9, 10)]
    assert table.distinct_rows().count() == 20_009
