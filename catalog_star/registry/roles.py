"""The driver's tables in the roles of a track catalogue and an awards table.

A track is an order line with its order, part and customer; an award is an event of
a customer. Codes, blanks, mixed case, collaboration markers and missing values are
derived from the rows, so that every cleaning rule has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_star import schemas as s
from catalog_star.operators.clean import clean_awards, clean_tracks
from catalog_star.operators.enrich import add_track_keys, enrich_tracks, summarize_awards
from catalog_star.operators.keys import number_rows
from catalog_star.operators.star import Star, build_star
from catalog_star.staging import stage

# All columns, so that only equal lines tie, and these may change places.
LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate",
]

TRACK_COLUMNS = {
    "track_id": "'P' || cast(l_partkey as string)",
    "artists": """case c_mktsegment when 'HOUSEHOLD' then c_name || ' Feat. Guest'
            when 'MACHINERY' then '  ' || c_name || ' '
            when 'BUILDING' then upper(c_name) || ' & Friends'
            else c_name end || ';Nation ' || cast(c_nationkey as string)""",
    "album_name": "p_brand",
    "track_name": "nullif(p_name, 'hot rod')",
    "popularity": "cast(l_quantity as int)",
    "duration_ms": "cast(floor(l_extendedprice * 10) as bigint)",
    "explicit": "case l_returnflag when 'R' then true when 'A' then false end",
    "danceability": "abs(l_discount)",
    "energy": "abs(l_tax)",
    "key": "cast(l_suppkey % 13 as int)",
    "loudness": "0 - l_quantity",
    "mode": "case l_linestatus when 'O' then 1 else 0 end",
    "speechiness": "abs(l_discount) * l_quantity",
    "acousticness": "p_retailprice",
    "instrumentalness": "c_acctbal",
    "liveness": "o_totalprice",
    "valence": "p_size / 50",
    "tempo": "l_extendedprice",
    "time_signature": "case when l_linenumber < 7 then l_linenumber - 1 end",
    "track_genre": "lower(nullif(p_type, 'PROMO')) || '-' || lower(o_orderpriority)",
}

_AWARDED = "'Customer#' || lpad(cast(user_id as string), 9, '0')"
AWARD_COLUMNS = {
    "year": "cast(1950 + day(ts) as int)",
    "title": "'ceremony'",
    "published_at": "event_type",
    "updated_at": "event_type",
    "category": "' best  ' || event_type || ' of r&b'",
    "nominee": "replace(nullif(event_type, 'signup'), 'i', 'ï')",
    "artist": f"""case event_type when 'view' then upper({_AWARDED})
        when 'click' then {_AWARDED} || ' feat. Guest'
        when 'signup' then ' ' || {_AWARDED} || ' '
        when 'purchase' then {_AWARDED} end""",
    "workers": "case when value < 10 then props end",
    "img": "props",
    "winner": "case when value > 100 then true when value > 5 then false end",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _project(df: DataFrame, columns: dict[str, str], *keep: str) -> DataFrame:
    return df.selectExpr(*keep, *[f"{sql} as {name}" for name, sql in columns.items()])


def awards_raw(spark: SparkSession, folder: str) -> DataFrame:
    return _project(table(spark, folder, "events"), AWARD_COLUMNS)


class Catalogue:
    """The stages of one data folder; each is computed when first asked for, then kept.

    A warehouse is built once and asked many times: stages are Parquet tables in the
    session's checkpoint folder.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder
        self._kept: dict[str, object] = {}

    def _once(self, name: str, make):
        if name not in self._kept:
            self._kept[name] = make()
        return self._kept[name]

    def tracks_raw(self) -> DataFrame:
        """The lines, numbered, with their orders, customers and parts.

        Customers meet the orders, of which there are fewer than lines. Parts come last and by track id: shuffled rows then lie
        by a column of the result, and who groups them by all its columns need not shuffle them again.
        """

        def make():
            lines = number_rows(
                table(self._spark, self._folder, "lineitem"), LINE_ORDER, s.ROW_ORDER, label="lines"
            )
            orders = table(self._spark, self._folder, "orders")
            parts = table(self._spark, self._folder, "part")
            customers = table(self._spark, self._folder, "customer")
            track_id = TRACK_COLUMNS["track_id"]
            bought = orders.join(customers, orders.o_custkey == customers.c_custkey)
            placed = lines.join(bought, lines.l_orderkey == bought.o_orderkey).withColumn("track_id", F.expr(track_id))
            named = parts.withColumn("_track_id", F.expr(track_id.replace("l_partkey", "p_partkey")))
            flat = placed.join(named, F.col("track_id") == F.col("_track_id"))
            return _project(flat, {**TRACK_COLUMNS, "track_id": "track_id"}, s.ROW_ORDER)

        return self._once("tracks_raw", make)

    def tracks_clean(self) -> DataFrame:
        return clean_tracks(self.tracks_raw())

    def award_summary(self) -> DataFrame:
        raw = awards_raw(self._spark, self._folder)
        return self._once("award_summary", lambda: stage(summarize_awards(clean_awards(raw)), "award_summary"))

    def merged(self) -> DataFrame:
        return enrich_tracks(add_track_keys(self.tracks_clean()), self.award_summary())

    def star(self) -> Star:
        return self._once("star", lambda: build_star(self.merged()))


_TABLES = ("lineitem", "orders", "part", "customer", "events")
_catalogues: dict[tuple, Catalogue] = {}


def _versions(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of every file the catalogue is made from."""
    files = None
    for name in _TABLES:
        own = table(spark, folder, name).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        files = own if files is None else files.unionByName(own)
    return tuple(sorted(map(tuple, files.collect())))


def catalogue(spark: SparkSession, folder: str) -> Catalogue:
    """The catalogue of a data folder within this Spark application; made anew if a file has changed."""
    key = (spark.conf.get("spark.app.id"), folder.rstrip("/"), _versions(spark, folder))
    if key not in _catalogues:
        _catalogues[key] = Catalogue(spark, folder)
    return _catalogues[key]


def forget_catalogues() -> None:
    """Let the next query compute its stages anew."""
    _catalogues.clear()
