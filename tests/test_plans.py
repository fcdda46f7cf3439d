"""Plans: no Python workers, no single-partition windows, hot keys split, scans pruned."""

import re
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog_star import staging
from catalog_star.operators import dedup, enrich
from catalog_star.operators.keys import number_within
from catalog_star.operators.star import look_up_keys, with_row_identity
from catalog_star.registry.roles import Catalogue, catalogue, table
from catalog_star.staging import stage, stage_root
from catalog_star.sinks.warehouse import CatalogWarehouse, FolderWarehouse, unseen_rows

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


@pytest.fixture
def settings(spark):
    before = {}

    def use(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield use
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def splitting(settings):
    """Thresholds small enough for test data to count as skewed and as too large to broadcast."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4096",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8192",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )


def test_star_plans_have_no_python_and_no_single_partition(spark):
    star = catalogue(spark, "/root/testdata/sf0.01").star()
    for df in (star.fact, *star.dimensions.values()):
        text = plan(df)
        assert "Python" not in text and "Window" not in text and "SinglePartition" not in text
    assert "Exchange" not in plan(star.fact) and "Join" not in plan(star.fact)


def test_scans_read_only_needed_columns(spark):
    top = dedup.first_seen(table(spark, DATA, "orders"), "o_orderpriority", "o_orderkey")
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan(top)) == ["o_orderkey:bigint,o_orderpriority:string"]
    late = table(spark, DATA, "lineitem").where("l_quantity > 49").select("l_orderkey")
    assert "GreaterThan(l_quantity,49.0)" in plan(late)


def test_keep_first_ranks_before_the_shuffle(spark):
    text = plan(dedup.keep_first(table(spark, DATA, "documents"), ["text"], "doc_id"))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_small_staged_summary_is_broadcast_by_size(spark):
    tracks = table(spark, DATA, "customer").select(F.col("c_name").alias("primary_artist_normalized"))
    summary = stage(
        spark.createDataFrame([("x", 1, 1, 1, "c")], "artist_normalized string, grammy_wins long, grammy_first_year int, grammy_last_year int, grammy_categories string"),
        "summary",
    )
    assert "BroadcastHashJoin" in plan(enrich.enrich_tracks(tracks, summary))


def hot_rows(spark, name):
    """A third of all rows share one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    return spark.range(0, 60_000, 1, 6).select(key.alias(name), F.xxhash64("id").alias("load"))


def test_hot_artist_is_split_in_enrichment(spark, splitting):
    tracks = hot_rows(spark, "primary_artist_normalized")
    awards = hot_rows(spark, "artist").select("artist", F.lit(True).alias("winner"), F.lit(2000).alias("year"), F.lit("c").alias("category"))
    summary = stage(enrich.summarize_awards(awards), "summary")
    merged = enrich.enrich_tracks(tracks, summary)
    assert "skew=true" in final_plan(merged)
    assert merged.count() == 60_000 and merged.where("grammy_winner").count() == 60_000


def test_hot_key_is_split_in_lookup_and_repeat_search(spark, splitting):
    facts = stage(hot_rows(spark, "natural"), "facts")
    keyed = stage(facts.select(F.col("natural").alias("_natural")).distinct().withColumn("key", F.xxhash64("_natural")), "keyed")
    assert "skew=true" in final_plan(look_up_keys(facts, keyed, "key", "natural"))
    repeated = dedup.duplicated_rows(facts, ["natural"])
    assert "skew=true" in final_plan(repeated) and repeated.count() == 20_000


def test_hot_key_is_split_in_incremental_load(spark, splitting):
    facts = stage(hot_rows(spark, "natural"), "facts")
    existing = stage(facts.select("natural").where("natural != 'hot'").distinct(), "existing")
    new = unseen_rows(facts, existing, "natural")
    assert "skew=true" in final_plan(new) and new.count() == 20_000


def test_bucketed_table_is_compared_without_a_shuffle(spark, settings, tmp_path):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.sql(f"create database plans location '{tmp_path}/plans'")
    try:
        house = CatalogWarehouse(spark, "plans", buckets=4)
        rows = spark.range(0, 1000, 1, 6).withColumnRenamed("id", "k")
        house.append(rows, "t", "k")
        assert len(list((tmp_path / "plans" / "t").glob("*.parquet"))) == 4
        new = unseen_rows(spark.range(500, 1500, 1, 6).withColumnRenamed("id", "k"), house.read("t"), "k")
        assert final_plan(new).split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
        assert new.count() == 500
    finally:
        spark.sql("drop database plans cascade")


def test_dropped_stages_are_gone_and_others_stay(spark):
    with staging.stage_scope(spark) as outer:
        other = stage(spark.range(4), "other")
        with staging.stage_scope(spark) as inner:
            kept = stage(spark.range(3), "gone")
        assert kept.count() == 3 and len(inner.paths) == len(outer.paths) == 1
        path = inner.paths[0]
        assert inner.drop() == 1 and inner.drop() == 0
    assert FolderWarehouse(spark, path.rpartition("/")[0]).read(path.rpartition("/")[2]) is None
    assert other.count() == 4


def test_stage_folder_is_the_checkpoint_folder(spark):
    assert stage_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_key_figures_scan_the_stored_fact(spark, tmp_path):
    from catalog_star.operators.clean import clean_awards, clean_tracks
    from catalog_star.plans import etl, kpis
    from catalog_star.sinks.warehouse import load_star, stored_star
    from tests import fixture_data as fx

    house = FolderWarehouse(spark, str(tmp_path))
    load_star(etl.transform(clean_tracks(fx.tracks(spark)), clean_awards(fx.awards(spark))).star, house)
    star = stored_star(house)
    for figure, joins in ((kpis.popularity_and_danceability, 1), (kpis.genres_by_winning_artists, 2)):
        plan = final_plan(figure(star)).split("Initial Plan")[0]
        assert "row_ord" not in plan and "tempo" not in plan and plan.count("Join") <= joins


def test_numbers_within_a_hot_group_are_spread(spark, settings):
    """A third of the rows are equal: no task ranks more than three times the median."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="24")
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("g"), (F.col("id") * 7919 % 30_011).alias("o"))
    found = number_within(rows, "g", "o", "n")
    assert found.where("g = -1").agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 10_000, 10_000)
    # the window ranks by partition and group, so its tasks hold what these pieces hold
    placed = spark.read.parquet(found.inputFiles()[0].rsplit("/", 1)[0])
    pieces = sorted(r["count"] for r in placed.groupBy("_part").count().collect())
    assert len(pieces) > 12 and pieces[-1] <= 3 * pieces[len(pieces) // 2]
    assert placed.where("g = -1").select("_part").distinct().count() > 4
    assert "SinglePartition" not in plan(found)


def test_equal_fact_rows_are_told_apart(spark):
    rows = spark.range(9000).select("id", F.sha2(F.when(F.col("id") % 3 == 0, "x").otherwise((F.col("id") % 3000).cast("string")), 256).alias("_digest"))
    found = with_row_identity(rows, "id")
    assert found.count() == 9000 == found.select("_digest", "_copy").distinct().count()
    expected = rows.withColumn("_copy", F.row_number().over(Window.partitionBy("_digest").orderBy("id")).cast("long"))
    assert found.exceptAll(expected).count() == 0
    alone = with_row_identity(rows.where("id % 3 = 1 and id < 3000"), "id")
    assert [r[0] for r in alone.select("_copy").distinct().collect()] == [1]


def test_tracks_are_grouped_where_they_met_their_parts(spark, settings):
    """Distinct rows need no shuffle of their own: rows lie by track id since the last join."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    assert plan(Catalogue(spark, DATA).tracks_clean()).count("Exchange hashpartitioning") == 6


def test_shuffles_behind_a_stage_are_deleted_after_a_large_one(spark, monkeypatch):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before = shuffles()
    stage(spark.range(1000).repartition(4, "id"), "shuffled")
    made = shuffles() - before
    time.sleep(2)  # for listeners of the query that ended
    monkeypatch.setattr(staging, "LARGE", 1)
    stage(spark.range(3), "next")
    until = time.time() + 20
    while shuffles() & made and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() & made


def test_wide_fact_rows_are_staged_once(spark, monkeypatch):
    """Digests and numbers are told on narrow rows, for a first load and for one that looks up the keys of another."""
    from catalog_star.operators import keys, star
    from catalog_star.operators.clean import clean_awards, clean_tracks
    from catalog_star.plans import etl
    from tests import fixture_data as fx

    staged = {}

    def noted(df, label, *rest):
        staged[label] = set(df.columns)
        return stage(df, label, *rest)

    monkeypatch.setattr(keys, "stage", noted)
    monkeypatch.setattr(star, "stage", noted)
    known = None
    for _ in range(2):
        staged.clear()
        made = etl.transform(clean_tracks(fx.tracks(spark)), clean_awards(fx.awards(spark)), known=known).star
        known = made.key_maps
        assert [label for label, columns in staged.items() if "tempo" in columns] == ["fact_streams", "fact_streams_keyed"]
        assert not any({"_digest", "popularity"} <= columns for columns in staged.values())
        assert fx.rows(made.fact, "stream_key", "track_key", "artist_key", "genre_key", "popularity") and made.fact.count() == known["fact_streams"].count() == 5
