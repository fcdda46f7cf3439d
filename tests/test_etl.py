import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalog_star import schemas as s
from catalog_star.operators.clean import clean_awards, clean_tracks
from catalog_star.operators.enrich import add_track_keys, enrich_tracks, summarize_awards
from catalog_star.operators.quality import QualityError
from catalog_star.plans import etl, kpis
from catalog_star.sinks.warehouse import CatalogWarehouse, FolderWarehouse, load_star
from catalog_star.sources.csv import read_csv
from tests import fixture_data as fx


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    house = FolderWarehouse(spark, str(tmp_path_factory.mktemp("house")))
    export = str(tmp_path_factory.mktemp("export"))
    return etl.run(fx.tracks(spark), fx.awards(spark), house, export_folder=export), house, export


def by_key(df):
    return [tuple(r) for r in df.orderBy(df.columns[0]).collect()]


def test_award_summary(done):
    assert by_key(done[0].transformed.summary) == fx.SUMMARY


def test_star(done):
    star = done[0].transformed.star
    assert by_key(star.dimensions["dim_artist"]) == fx.DIM_ARTIST
    assert by_key(star.dimensions["dim_genre"]) == fx.DIM_GENRE
    assert by_key(star.dimensions["dim_track"]) == fx.DIM_TRACK
    keys = star.fact.select("stream_key", "track_key", "artist_key", "genre_key", "popularity")
    assert by_key(keys) == fx.FACT
    assert star.fact.columns == ["stream_key", "track_key", "artist_key", "genre_key", "popularity", *s.AUDIO_FEATURES]


def test_star_does_not_depend_on_partitioning(spark):
    for n in (1, 7):
        star = etl.transform(clean_tracks(fx.tracks(spark, n)), clean_awards(fx.awards(spark))).star
        assert by_key(star.dimensions["dim_track"]) == fx.DIM_TRACK
        assert [r[:4] for r in by_key(star.fact)] == [r[:4] for r in fx.FACT]


def test_enrichment_keeps_row_count(spark):
    tracks = add_track_keys(clean_tracks(fx.tracks(spark)))
    merged = enrich_tracks(tracks, summarize_awards(clean_awards(fx.awards(spark))))
    assert merged.count() == tracks.count() == 5
    assert "artist_normalized" not in merged.columns


def test_warehouse_and_second_load(done):
    run, house, _ = done
    assert [(c.table, c.new, c.omitted) for c in run.loads] == [
        ("dim_artist", 3, 0), ("dim_genre", 4, 0), ("dim_track", 3, 0), ("fact_streams", 5, 0),
    ]
    again = load_star(run.transformed.star, house)
    assert [(c.new, c.omitted) for c in again] == [(0, 3), (0, 4), (0, 3), (0, 5)]
    assert house.read("fact_streams").count() == 5


def test_audit(done):
    found = done[0].audit.figures()
    assert found["tracks: cleaning"] == {
        "rows_in": 8, "duplicates_removed": 1, "missing_removed": 1, "invalid_removed": 1, "rows_out": 5,
    }
    assert found["awards: missing filled"] == {"nominee": 1, "artist": 1, "workers": 4}
    assert found["awards: years"]["violations"] == 0
    assert found["merge: matches"]["matched"] == 4
    assert found["load: fact_streams"] == {"total": 5, "new": 5, "omitted": 0}
    assert done[0].audit.frame().where("step = 'merge: matches'").count() == 4


def test_export(spark, done):
    back = spark.read.option("header", True).csv(f"{done[2]}/star/dim_artist")
    assert back.where("artist_key = 3").first().asDict() == {
        "artist_key": "3", "primary_artist": "Little Feat", "grammy_winner": "False", "grammy_wins": "0",
        "grammy_first_year": None, "grammy_last_year": None, "grammy_categories": "N/A",
    }


def test_key_figures(done):
    star = done[0].transformed.star
    assert kpis.total_tracks(star).first()["tracks"] == 3
    assert kpis.award_winning_artists(star).first()["winning_artists"] == 2
    assert [tuple(r) for r in kpis.genres_by_winning_artists(star, 2).collect()] == [("Hip Hop", 2), ("Indie Pop", 1)]
    found = {r["grammy_winner"]: r for r in kpis.popularity_and_danceability(star).collect()}
    assert found[True]["avg_popularity"] == 60.25 and found[False]["avg_popularity"] == 10.0
    assert {r["avg_energy"] for r in kpis.audio_profile(star).collect()} == {0.5}


def test_catalog_warehouse_with_buckets(spark, done, tmp_path):
    spark.sql(f"create database house location '{tmp_path}/house'")
    try:
        house = CatalogWarehouse(spark, "house", buckets=4)
        assert house.read("dim_artist") is None
        star = done[0].transformed.star
        assert [c.new for c in load_star(star, house)] == [3, 4, 3, 5]
        assert [c.new for c in load_star(star, house)] == [0, 0, 0, 0]
        assert sorted(map(tuple, spark.table("house.dim_artist").collect())) == fx.DIM_ARTIST
    finally:
        spark.sql("drop database house cascade")


def test_replaced_tables_can_be_appended_to(spark, tmp_path):
    spark.sql(f"create database swap location '{tmp_path}/swap'")
    try:
        house = CatalogWarehouse(spark, "swap", buckets=4, bucketed=("t",))
        rows = spark.range(10).withColumnRenamed("id", "k")
        for name in ("t", "small"):
            house.replace(rows, name, "k")
            house.append(rows.selectExpr("k + 100 as k"), name, "k")
            assert house.read(name).count() == 20
    finally:
        spark.sql("drop database swap cascade")


def test_grown_catalogue_keeps_its_keys(spark, tmp_path):
    """One artist and track in front, as a list that is sorted anew would have them."""
    house = FolderWarehouse(spark, str(tmp_path))
    etl.run(fx.tracks(spark), fx.awards(spark), house)
    new = spark.createDataFrame([(-1, "t0", *fx.TRACKS[0][2:])], s.TRACKS_RAW).withColumn("artists", F.lit("Newcomer"))
    grown = fx.tracks(spark).unionByName(new)
    run = etl.run(grown, fx.awards(spark), house)
    assert [(c.table, c.new) for c in run.loads] == [("dim_artist", 1), ("dim_genre", 0), ("dim_track", 1), ("fact_streams", 1)]
    assert by_key(house.read("dim_artist"))[:3] == fx.DIM_ARTIST
    assert [r[:2] for r in by_key(house.read("dim_artist"))][3:] == [(4, "Newcomer")]
    fact = by_key(house.read("fact_streams").select("stream_key", "track_key", "artist_key", "genre_key", "popularity"))
    assert fact[:5] == fx.FACT and fact[5][:4] == (6, 4, 4, 1)
    again = etl.run(grown, fx.awards(spark), house)
    assert [c.new for c in again.loads] == [0, 0, 0, 0]
    assert again.drop_stages() > 5 and house.read("fact_streams").count() == 6


def test_order_must_be_unique(spark, tmp_path):
    with pytest.raises(QualityError, match="does not order rows"):
        etl.run(fx.tracks(spark).withColumn("row_ord", F.lit(1).cast("long")), fx.awards(spark), FolderWarehouse(spark, str(tmp_path)))


def test_orphan_stops_the_fact_load(spark, done, tmp_path):
    from dataclasses import replace

    star = done[0].transformed.star
    broken = replace(star, fact=star.fact.withColumn("genre_key", F.nullif("genre_key", F.lit(4).cast("long"))))
    house = FolderWarehouse(spark, str(tmp_path))
    with pytest.raises(PySparkException, match="fact_streams row without genre_key"):
        load_star(broken, house)
    assert house.read("dim_genre").count() == 4


def test_contract_checks(spark, tmp_path):
    house = FolderWarehouse(spark, str(tmp_path))
    with pytest.raises(QualityError, match="empty"):
        etl.run(fx.tracks(spark).where("false"), fx.awards(spark), house)
    with pytest.raises(QualityError, match="awards table is empty"):
        etl.run(fx.tracks(spark), fx.awards(spark).where("false"), house)
    with pytest.raises(QualityError, match="track_id"):
        etl.run(fx.tracks(spark).drop("track_id"), fx.awards(spark), house)
    with pytest.raises(QualityError, match="lacks updated_at"):
        etl.run(fx.tracks(spark), fx.awards(spark).drop("updated_at"), house)


def test_from_csv_file(spark, tmp_path):
    header = [c for c in s.TRACKS_RAW.fieldNames() if c != s.ROW_ORDER]
    lines = ["," + ",".join(header)]
    for row in fx.TRACKS:
        cells = ["None" if r is None and c == "track_name" else "" if r is None else f"{r}" for c, r in zip(s.TRACKS_RAW.fieldNames(), row)]
        lines.append(",".join(cells))
    path = tmp_path / "tracks.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    back = read_csv(spark, str(path), s.TRACKS_RAW, order=s.ROW_ORDER)
    assert back.schema == s.TRACKS_RAW
    assert fx.rows(back) == fx.rows(fx.tracks(spark))


def test_seed_repairs_and_replaces(spark, tmp_path):
    path = tmp_path / "awards.csv"
    header = ",".join(s.AWARDS_RAW.fieldNames())
    good = "2000,t,p,u,best song,n,José,w,i,True"
    long_line = "2001,t,p,u,best song,n,Zoë,w,i,True,extra"
    short_line = "2002,t,p,u,best song"
    path.write_text("\n".join([header, good, long_line, short_line, ""]), encoding="utf-8")
    house = FolderWarehouse(spark, str(tmp_path / "house"))
    for _ in range(2):
        assert etl.seed_awards(spark, str(path), house) == 2
    assert [r["artist"] for r in house.read("awards").orderBy("year").collect()] == ["José", None]
