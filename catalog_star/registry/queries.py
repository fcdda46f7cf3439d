"""Every operator as a query over the driver's tables, with SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from catalog_star import schemas as s
from catalog_star.functions import text, values
from catalog_star.operators import clean, dedup, enrich, profile, quality
from catalog_star.operators.keys import extend_keys, number_rows
from catalog_star.plans import etl, kpis
from catalog_star.registry import comparison as c
from catalog_star.registry.roles import awards_raw, catalogue, table
from catalog_star.sinks.deliveries import DeliveredTable
from catalog_star.sinks.files import export_tables, write_csv
from catalog_star.sinks.versions import VersionedWarehouse
from catalog_star.sinks.warehouse import FolderWarehouse, counts_frame, insert_ignore, load_star, stored_star, unseen_rows
from catalog_star.sources.csv import null_tokens, read_csv, read_csv_text
from catalog_star.staging import current_scope, stage_path


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(sql: str | None):
    """Register a function under its own name, with the SQL it must agree with."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


# --- scalar rules ---------------------------------------------------------------

@query(f"select doc_id, {c.strip('text')} as stripped from documents")
def strip_text(spark, folder):
    padded = F.concat(F.lit("\t "), F.col("text"), F.lit(" \n"))
    return table(spark, folder, "documents").select("doc_id", text.strip(padded).alias("stripped"))


@query(f"select doc_id, {c.title('text')} as titled from documents")
def title_case(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.title_case(F.col("text")).alias("titled"))


@query(f"""select o_orderkey, {c.title("replace(o_orderpriority, '-', ' ')")} as label from orders""")
def genre_label(spark, folder):
    spaced = text.replace_literal(F.col("o_orderpriority"), "-", " ")
    return table(spark, folder, "orders").select("o_orderkey", text.title_case(spaced).alias("label"))


@query(f"select conv_id, turn, {c.normalized('text')} as name from conversations")
def normalize_name(spark, folder):
    turns = table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", text.normalize_name(F.col("text")).alias("name"))


@query(r"select doc_id, regexp_replace(text, '\s+', ' ', 'g') as flat from documents")
def collapse_whitespace(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.collapse_whitespace(F.col("text")).alias("flat"))


@query(f"select doc_id, {c.strip('''split_part(text, ',', 1)''')} as first_part from documents")
def first_of(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.first_of(F.col("text")).alias("first_part"))


@query(
    f"""select p_partkey, {c.coded('p_size', s.PITCH_NAMES)} as pitch,
        {c.coded('p_size % 3', s.MODE_NAMES)} as scale from part"""
)
def code_map(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        values.map_codes(F.col("p_size"), s.PITCH_NAMES).alias("pitch"),
        values.map_codes(F.col("p_size") % 3, s.MODE_NAMES).alias("scale"),
    )


@query(
    f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
        {c.rounded('floor(l_extendedprice * 10) / 1000::double', 2)} as seconds,
        {c.rounded('l_extendedprice * (1 - l_discount)', 3)} as price from lineitem"""
)
def scale_round(spark, folder):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        values.milliseconds_to_seconds(F.floor(F.col("l_extendedprice") * 10)).alias("seconds"),
        values.round_half_even(price, 3).alias("price"),
    )


@query(
    """select p_partkey, coalesce(nullif(p_type, 'PROMO'), 'N/A') as kind,
        nullif(cast(p_size as bigint), 7) as size, p_type is distinct from 'SMALL' as not_small,
        coalesce(cast(nullif(p_type, 'LARGE') = 'SMALL' as boolean), true) as small_or_unknown from part"""
)
def null_rules(spark, folder):
    kind = values.null_if(F.col("p_type"), "PROMO")
    return table(spark, folder, "part").select(
        "p_partkey",
        values.default(kind, text.MISSING_NAME).alias("kind"),
        values.null_if(F.col("p_size").cast("long"), 7).alias("size"),
        values.not_value(F.col("p_type"), "SMALL").alias("not_small"),
        values.truthy(values.null_if(F.col("p_type"), "LARGE") == "SMALL").alias("small_or_unknown"),
    )


@query("select doc_id, text, lang, source, n_chars from documents")
def mojibake_fix(spark, folder):
    """UTF-8 text misread as Latin-1 comes back whole from the repair."""
    misread = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return text.repair_text_columns(table(spark, folder, "documents").withColumn("text", misread))


# --- cleaning, filters, deduplication --------------------------------------------


@query(
    """select min(doc_id) as doc_id, text, lang from documents
       where nullif(source, 'src3') is not null group by text, lang, source
       having lang is distinct from 'de'"""
)
def clean_rows(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", "lang", values.null_if(F.col("source"), "src3").alias("source")
    )
    kept = clean.drop_missing(dedup.distinct_rows(docs, "doc_id"), ["text", "source"])
    return clean.drop_value(kept, "lang", "de").select("doc_id", "text", "lang")


@query("select doc_id, text, lang, source, n_chars from documents qualify row_number() over (partition by text order by doc_id) = 1")
def keep_first(spark, folder):
    return dedup.keep_first(table(spark, folder, "documents"), ["text"], "doc_id")


@query("select o_orderpriority, min(o_orderkey) as o_orderkey from orders group by o_orderpriority")
def first_seen(spark, folder):
    return dedup.first_seen(table(spark, folder, "orders"), "o_orderpriority", "o_orderkey")


@query("select doc_id, text, lang, source, n_chars from documents qualify count(*) over (partition by text) > 1")
def duplicated_rows(spark, folder):
    return dedup.duplicated_rows(table(spark, folder, "documents"), ["text"])


@query(
    """with n as (select count(*) as n from documents group by text)
       select cast(sum(n - 1) as bigint) as repeats, cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as members from n"""
)
def duplicate_report(spark, folder):
    return dedup.duplicate_counts(table(spark, folder, "documents"), ["text"])


def _delivered(spark, folder) -> DeliveredTable:
    """All line items by three deliveries of unlike size, reduced to columns whose rows repeat within and across deliveries."""
    lines = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("place"), "l_suppkey", "l_quantity", "l_returnflag",
        values.null_if(F.col("l_linestatus"), "F").alias("l_linestatus"),
    )
    delivered = DeliveredTable(VersionedWarehouse(spark, stage_path(spark, "delivered"), buckets=64), "lines", "place")
    for label, share in (("first", "place % 10 > 2"), ("second", "place % 10 = 2"), ("third", "place % 10 < 2")):
        delivered.deliver(lines.where(share), label)
    return delivered


_LINES = """select l_suppkey, l_quantity, l_returnflag, case when l_linestatus <> 'F' then l_linestatus end as l_linestatus, count(*) as n
    from lineitem group by all"""


@query(f"select l_suppkey, l_quantity, l_returnflag, l_linestatus from ({_LINES})")
def distinct_deliveries(spark, folder):
    """Distinct rows over three deliveries, each compared with the digests of those before."""
    return _delivered(spark, folder).distinct_rows().drop("place")


@query(
    f"""select cast(sum(n - 1) as bigint) as repeats, cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as members from ({_LINES})"""
)
def delivery_report(spark, folder):
    """Repeats over three deliveries, added up from one row of figures each."""
    return _delivered(spark, folder).duplicate_counts()


@query(
    """select text, doc_id, lang from documents qualify count(*) over (partition by text) > 1
       order by text, doc_id limit 15"""
)
def duplicated_head(spark, folder):
    repeated = dedup.duplicated_rows(table(spark, folder, "documents"), ["text"])
    return profile.head(repeated.select("text", "doc_id", "lang"), ["text", "doc_id"], 15)


@query("select event_id, user_id from events where value > 100 and event_type is not null and event_type <> 'error'")
def filter_rows(spark, folder):
    events = table(spark, folder, "events")
    named = F.col("event_type").isNotNull() & (F.col("event_type") != "error")
    return events.where((F.col("value") > 100) & named).select("event_id", "user_id")


@query("select p_partkey, p_name from part where nullif(p_type, 'PROMO') is null")
def missing_rows(spark, folder):
    parts = table(spark, folder, "part").withColumn("p_type", values.null_if(F.col("p_type"), "PROMO"))
    return profile.missing_rows(parts, "p_type", ["p_partkey", "p_name"])


@query(c.over("tracks_clean", "select * from tracks_clean"))
def clean_tracks(spark, folder):
    return catalogue(spark, folder).tracks_clean()


@query(c.over("awards_clean", "select * from awards_clean"))
def clean_awards(spark, folder):
    return clean.clean_awards(awards_raw(spark, folder))


# --- enrichment and star ---------------------------------------------------------


@query(
    c.over("tracks_keyed", "select row_ord, track_genre, is_explicit, primary_artist, primary_artist_normalized from tracks_keyed")
)
def track_keys(spark, folder):
    return enrich.add_track_keys(catalogue(spark, folder).tracks_clean()).select(
        "row_ord", "track_genre", "is_explicit", "primary_artist", "primary_artist_normalized"
    )


@query(c.over("award_summary", "select * from award_summary"))
def award_summary(spark, folder):
    return enrich.summarize_awards(clean.clean_awards(awards_raw(spark, folder)))


@query(
    """with a as (select user_id, count(value) as wins, min(cast(day(ts) as int)) as first_day,
            max(cast(day(ts) as int)) as last_day, string_agg(distinct event_type, ' | ' order by event_type) as kinds
            from events group by user_id)
       select c_custkey, c_name, a.wins is not null as has_winner, coalesce(wins, 0) as has_wins,
            coalesce(first_day, 0) as has_first_year, coalesce(last_day, 0) as has_last_year,
            coalesce(kinds, 'N/A') as has_categories
       from customer left join a on cast(c_custkey as varchar) = cast(a.user_id as varchar)"""
)
def enrich_left(spark, folder):
    events = table(spark, folder, "events").select(
        F.col("user_id").cast("string"), "value", F.dayofmonth("ts").alias("day"), "event_type"
    )
    summary = enrich.summarize_awards(
        events, artist="user_id", winner="value", year="day", category="event_type", key="who", prefix="has"
    )
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.col("c_custkey").cast("string").alias("name")
    )
    return enrich.enrich_tracks(customers, summary, "name", "who", prefix="has").drop("name")


@query(
    c.over(
        "merged",
        """select row_ord, track_id, primary_artist, grammy_winner, grammy_wins, grammy_first_year,
           grammy_last_year, grammy_categories from merged""",
    )
)
def merged_tracks(spark, folder):
    return catalogue(spark, folder).merged().select(
        "row_ord", "track_id", "primary_artist", "grammy_winner", "grammy_wins", "grammy_first_year",
        "grammy_last_year", "grammy_categories",
    )


@query(c.over("dim_artist", "select * from dim_artist"))
def dim_artist(spark, folder):
    return catalogue(spark, folder).star().dimensions["dim_artist"]


@query(c.over("dim_genre", "select * from dim_genre"))
def dim_genre(spark, folder):
    return catalogue(spark, folder).star().dimensions["dim_genre"]


@query(c.over("dim_track", "select * from dim_track"))
def dim_track(spark, folder):
    return catalogue(spark, folder).star().dimensions["dim_track"]


@query(c.over("fact_streams", "select * from fact_streams"))
def fact_streams(spark, folder):
    return catalogue(spark, folder).star().fact


@query(
    """select row_number() over (order by first_key) as priority_key, o_orderpriority
       from (select o_orderpriority, min(o_orderkey) as first_key from orders group by o_orderpriority)"""
)
def dense_key_dim(spark, folder):
    seen = dedup.first_seen(table(spark, folder, "orders"), "o_orderpriority", "o_orderkey")
    return number_rows(seen, "o_orderkey", "priority_key").drop("o_orderkey")


@query("select row_number() over (order by o_orderkey) as order_key, o_orderkey, o_totalprice from orders")
def dense_key_fact(spark, folder):
    return number_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", "order_key")


@query(
    """with known as (select c_mktsegment, c_nationkey, row_number() over (order by min(c_custkey)) as place_key
            from customer where c_acctbal < 0 group by c_mktsegment, c_nationkey),
        fresh as (select c_mktsegment, c_nationkey, min(c_custkey) as first_seen from customer c
            where not exists (select 1 from known k where k.c_mktsegment = c.c_mktsegment and k.c_nationkey = c.c_nationkey)
            group by c_mktsegment, c_nationkey)
       select place_key, c_mktsegment, c_nationkey from known
       union all select (select coalesce(max(place_key), 0) from known) + row_number() over (order by first_seen),
            c_mktsegment, c_nationkey from fresh"""
)
def extended_keys(spark, folder):
    """Keys of a first load stay; values seen later continue after the highest."""
    places = ["c_mktsegment", "c_nationkey"]
    customers = table(spark, folder, "customer")
    early = dedup.first_seen(customers.where("c_acctbal < 0"), places, "c_custkey")
    known = number_rows(early, "c_custkey", "place_key").drop("c_custkey")
    return extend_keys(dedup.first_seen(customers, places, "c_custkey"), known, places, "c_custkey", "place_key")


# --- loads -------------------------------------------------------------------------


@query("select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F')")
def anti_load(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    loaded = table(spark, folder, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return unseen_rows(lines, loaded, "l_orderkey")


@query(
    """with batch as (select l_orderkey, l_extendedprice from lineitem qualify row_number() over
            (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1)
       select o_orderkey as l_orderkey, o_totalprice as l_extendedprice from orders where o_orderstatus = 'F'
       union all select l_orderkey, l_extendedprice from batch
            where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')"""
)
def insert_ignored(spark, folder):
    """A table that holds the finished orders, after order lines were offered to it."""
    house = FolderWarehouse(spark, stage_path(spark, "insert_ignore"))
    done = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    house.replace(done.selectExpr("o_orderkey as l_orderkey", "o_totalprice as l_extendedprice"), "orders_seen")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    offered = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice", order.alias("_order"))
    insert_ignore(offered, house, "orders_seen", "l_orderkey", order="_order")
    return house.read("orders_seen")


_LOADS = c.over(
    "fact_streams",
    """, sizes as (select 'dim_artist' as t, count(*) as n from dim_artist
            union all select 'dim_genre', count(*) from dim_genre
            union all select 'dim_track', count(*) from dim_track
            union all select 'fact_streams', count(*) from fact_streams)
       select 1 as load, t as "table", n as total, n as new, cast(0 as bigint) as omitted from sizes
       union all select 2, t, n, 0, n from sizes""",
)


@query(_LOADS)
def star_load_counts(spark, folder):
    """A first load stores every row of the star, a second one none."""
    star = catalogue(spark, folder).star()
    house = FolderWarehouse(spark, stage_path(spark, "warehouse"))
    first, second = (counts_frame(spark, load_star(star, house)) for _ in range(2))
    return first.select(F.lit(1).alias("load"), "*").unionByName(second.select(F.lit(2).alias("load"), "*"))


def _grown(first: str) -> str:
    """The star after a load of the rows that meet ``first``, then of all."""
    return f""", artists as (select primary_artist, row_number() over (order by min(row_ord) filter ({first}) is null,
            coalesce(min(row_ord) filter ({first}), min(row_ord))) as artist_key from merged group by primary_artist),
        genres as (select track_genre, row_number() over (order by min(row_ord) filter ({first}) is null,
            coalesce(min(row_ord) filter ({first}), min(row_ord))) as genre_key from merged group by track_genre),
        tracks as (select track_id, row_number() over (order by min(row_ord) filter ({first}) is null,
            coalesce(min(row_ord) filter ({first}), min(row_ord))) as track_key from merged group by track_id),
        seen as (select * from merged qualify row_number() over (partition by track_id order by not ({first}), row_ord) = 1)
       select row_number() over (order by not (m.{first}), m.row_ord) as stream_key, t.track_key, a.artist_key, g.genre_key,
            m.popularity, a.primary_artist, g.track_genre, seen.album_name
       from merged m join artists a using (primary_artist) join genres g on m.track_genre is not distinct from g.track_genre
            join tracks t on m.track_id = t.track_id join seen on m.track_id = seen.track_id"""


@query(c.over("merged", _grown("popularity > 20")))
def grown_load(spark, folder):
    """The stored star after two loads: part of the catalogue, then all of it, whose new rows come before and between the old."""
    house = FolderWarehouse(spark, stage_path(spark, "grown"))
    tracks, awards = catalogue(spark, folder).tracks_raw(), awards_raw(spark, folder)
    for rows in (tracks.where("popularity > 20"), tracks):
        etl.run(rows, awards, house).drop_stages()
    return _named_facts(stored_star(house))


def _named_facts(star):
    fact = star.fact.select("stream_key", "track_key", "artist_key", "genre_key", "popularity")
    for name, attribute in (("dim_artist", "primary_artist"), ("dim_genre", "track_genre"), ("dim_track", "album_name")):
        dimension = star.dimensions[name]
        fact = fact.join(dimension.select(dimension.columns[0], attribute), dimension.columns[0])
    return fact


@query(
    c.over(
        "merged",
        _grown("popularity > 20").replace("select row_number() over (order by not (m.", ", grown as (select row_number() over (order by not (m.", 1)
        + ") select 2 as version, * from grown union all select 1, * from grown where popularity > 20",
    )
)
def load_versions(spark, folder):
    """The star as the first of two loads left it, read after the second, and as the second did."""
    house = VersionedWarehouse(spark, stage_path(spark, "versions"))
    tracks, awards = catalogue(spark, folder).tracks_raw(), awards_raw(spark, folder)
    for rows in (tracks.where("popularity > 20"), tracks):
        etl.run(rows, awards, house).drop_stages()
    found = [_named_facts(house.snapshot(v).star()).select(F.lit(v).alias("version"), "*") for v in house.versions()]
    return found[0].unionByName(found[1])


@query(c.over("fact_streams", "select 'loaded' as figure, count(*) as n from fact_streams union all select 'artists', count(*) from dim_artist union all select 'broken', 1 union all select 'scanned again', 0"))
def resumed_run(spark, folder):
    """A run that breaks off while it loads, and the next one: its rows, and how many finished stages had to be made again."""
    house = VersionedWarehouse(spark, stage_path(spark, "resumed"))
    tracks, awards = catalogue(spark, folder).tracks_raw(), awards_raw(spark, folder)
    job = (tracks, awards, BreakingWarehouse(spark, house.folder))
    made = broken = 0
    try:
        etl.run(*job, resume=True)
    except ConnectionError as error:
        broken, made = 1, error.args[0]
    run = etl.run(tracks, awards, house, resume=True)
    star = house.snapshot().star()
    figures = {"loaded": star.fact, "artists": star.dimensions["dim_artist"]}
    counted = [df.agg(F.lit(name).alias("figure"), F.count(F.lit(1)).alias("n")) for name, df in figures.items()]
    rest = spark.createDataFrame([("broken", broken), ("scanned again", made - len(run.stages.taken_up))], "figure string, n long")
    return counted[0].unionByName(counted[1]).unionByName(rest)


class BreakingWarehouse(VersionedWarehouse):
    """A warehouse whose connection is lost when the fact is to be written; the error tells how many stages there were."""

    @contextmanager
    def load(self):
        with super().load() as load:
            store = load.insert_new

            def insert_new(rows, table, *rest):
                if table == "fact_streams":
                    raise ConnectionError(current_scope().count)
                return store(rows, table, *rest)

            load.insert_new = insert_new
            yield load


@query(c.over("merged", _grown("row_ord % 50 > 0")))
def pruned_load(spark, folder):
    """The star after a large load and a small one, whose natural keys are looked up in few buckets of the key maps."""
    house = VersionedWarehouse(spark, stage_path(spark, "pruned"), buckets=256)
    tracks, awards = catalogue(spark, folder).tracks_raw(), awards_raw(spark, folder)
    for rows in (tracks.where("row_ord % 50 > 0"), tracks.where("row_ord % 50 = 0")):
        etl.run(rows, awards, house).drop_stages()
    return _named_facts(house.snapshot().star())


@query(
    c.over(
        "fact_streams",
        """select stream_key, artist_key, primary_artist, grammy_wins, genre_key, track_genre, track_name, popularity, tempo
           from fact_streams join dim_artist using (artist_key) join dim_genre using (genre_key) join dim_track using (track_key)""",
    )
)
def star_export(spark, folder):
    """Every star table written as CSV, read back by its types and joined again."""
    star, path = catalogue(spark, folder).star(), stage_path(spark, "export")
    export_tables(star.tables(), path)
    back = {name: read_csv(spark, f"{path}/{name}", df.schema) for name, df in star.tables().items()}
    fact = back["fact_streams"].select("stream_key", "artist_key", "genre_key", "track_key", "popularity", "tempo")
    joined = fact.join(back["dim_artist"], "artist_key").join(back["dim_genre"], "genre_key").join(back["dim_track"], "track_key")
    return joined.select("stream_key", "artist_key", "primary_artist", "grammy_wins", "genre_key", "track_genre", "track_name", "popularity", "tempo")


@query(
    """select 'supplier' as reference, l_suppkey as key from lineitem
            where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0) group by l_suppkey
       union all select 'part', l_partkey from lineitem
            where l_partkey not in (select p_partkey from part where p_type <> 'PROMO') group by l_partkey"""
)
def orphan_keys(spark, folder):
    lines = table(spark, folder, "lineitem").selectExpr("l_suppkey as supplier", "l_partkey as part")
    known = {
        "supplier": table(spark, folder, "supplier").where("s_acctbal > 0").selectExpr("s_suppkey as supplier"),
        "part": table(spark, folder, "part").where("p_type <> 'PROMO'").selectExpr("p_partkey as part"),
    }
    return quality.orphans(lines, known)


# --- key figures ---------------------------------------------------------------------


@query(c.over("dim_track", "select count(*) as tracks from dim_track"))
def kpi_total_tracks(spark, folder):
    return kpis.total_tracks(catalogue(spark, folder).star())


@query(c.over("dim_artist", "select count(*) as winning_artists from dim_artist where grammy_winner"))
def kpi_winners(spark, folder):
    return kpis.award_winning_artists(catalogue(spark, folder).star())


@query(
    c.over(
        "fact_streams",
        """select track_genre, count(distinct artist_key) as winning_artists from fact_streams
           join dim_artist using (artist_key) join dim_genre using (genre_key)
           where grammy_winner group by track_genre""",
    )
)
def kpi_genre_winners(spark, folder):
    return kpis.genres_by_winning_artists(catalogue(spark, folder).star())


def _averages(measures: list[str]) -> str:
    means = ", ".join(f"{c.rounded(f'avg({m})', 6)} as avg_{m}" for m in measures)
    return c.over(
        "fact_streams",
        f"select grammy_winner, count(*) as streams, {means} from fact_streams join dim_artist using (artist_key) group by grammy_winner",
    )


@query(_averages(["popularity", "danceability"]))
def kpi_pop_dance(spark, folder):
    return kpis.popularity_and_danceability(catalogue(spark, folder).star())


@query(_averages(["energy", "valence", "acousticness"]))
def kpi_features(spark, folder):
    return kpis.audio_profile(catalogue(spark, folder).star())


_KEPT_MEANS = ["popularity", "danceability", "energy", "valence", "acousticness"]


@query(
    c.over(
        "fact_streams",
        "select 'winners' as figure, track_genre as of, count(distinct artist_key)::double as value from fact_streams join dim_artist using (artist_key)"
        " join dim_genre using (genre_key) where grammy_winner group by track_genre union all "
        + " union all ".join(
            f"select '{m}', grammy_winner::varchar, {c.rounded(f'avg({m})', 6)} from fact_streams join dim_artist using (artist_key) group by grammy_winner" for m in _KEPT_MEANS
        ),
    )
)
def kept_key_figures(spark, folder):
    """Key figures after three loads, from counts and sums that each load has added for its own rows."""
    house = VersionedWarehouse(spark, stage_path(spark, "kept"))
    tracks, awards = catalogue(spark, folder).tracks_raw(), awards_raw(spark, folder)
    for rows in (tracks.where("popularity > 40"), tracks.where("popularity > 20"), tracks):
        etl.run(rows, awards, house).drop_stages()
    star = house.snapshot().star()
    winners = kpis.genres_by_winning_artists(star).select(F.lit("winners").alias("figure"), F.col("track_genre").alias("of"), F.col("winning_artists").cast("double").alias("value"))
    means = kpis.averages_by_award(star, _KEPT_MEANS)
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("figure"), F.col(f"avg_{m}").alias("value")) for m in _KEPT_MEANS]))
    means = means.select(F.col("grammy_winner").cast("string").alias("of"), each.alias("x")).select("x.figure", "of", "x.value")
    return winners.unionByName(means)


# --- profiles ----------------------------------------------------------------------------

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("select count(*) as rows from lineitem")
def row_count(spark, folder):
    return profile.row_count(table(spark, folder, "lineitem"))


_AWARD_FIELDS = ["year", "category", "nominee", "artist", "workers", "winner"]


@query(
    c.over(
        "awards_raw",
        " union all ".join(
            f"""select '{f}' as "column", count(*) - count({f}) as nulls,
                {c.rounded(f'(count(*) - count({f}))::double / count(*)::double * 100', 2)} as null_pct from awards_raw"""
            for f in _AWARD_FIELDS
        ),
    )
)
def null_profile(spark, folder):
    return profile.null_profile(awards_raw(spark, folder), _AWARD_FIELDS)


@query(
    """select 'user_id' as "column", count(distinct user_id) as distinct_values from events
       union all select 'event_type', count(distinct event_type) from events
       union all select 'props', count(distinct props) from events"""
)
def distinct_counts(spark, folder):
    events = table(spark, folder, "events")
    return profile.distinct_counts(events, profile.present(events, ["user_id", "event_type", "genre", "props"]))


@query("select event_type, count(*) as n from events where event_type is not null group by event_type")
def value_counts(spark, folder):
    return profile.value_counts(table(spark, folder, "events"), "event_type")


@query("select o_custkey, count(*) as n from orders group by o_custkey order by n desc, o_custkey limit 20")
def value_counts_top(spark, folder):
    return profile.top_values(table(spark, folder, "orders"), "o_custkey", 20)


@query("select l_partkey, count(*) as n from lineitem group by l_partkey order by n desc, l_partkey limit 20")
def frequent_values(spark, folder):
    """The most frequent values by bounds of hash slots and an exact count of what may reach the top."""
    return profile.frequent_values(table(spark, folder, "lineitem"), "l_partkey", 20)


@query(
    """select event_type || ' ' || coalesce(user_id % 97, -1) as label, count(*) as n from events where event_type is not null
       group by label order by n desc, label limit 5"""
)
def frequent_labels(spark, folder):
    """The same on texts."""
    user = F.coalesce(F.col("user_id") % 97, F.lit(-1))
    events = table(spark, folder, "events").select(F.concat("event_type", F.lit(" "), user).alias("label"))
    return profile.frequent_values(events, "label", 5, slots=4096)


@query(
    f"""select l_returnflag, count(*) as n,
        {c.rounded('count(*)::double / (select count(l_returnflag) from lineitem)::double * 100', 2)} as share_pct
        from lineitem group by l_returnflag"""
)
def value_share(spark, folder):
    return profile.value_shares(table(spark, folder, "lineitem"), "l_returnflag")


@query(f"select count(*) filter (l_discount = 0) as n, {c.rounded('avg((l_discount = 0)::int) * 100', 1)} as share_pct from lineitem")
def share_where(spark, folder):
    return profile.share_where(table(spark, folder, "lineitem"), F.col("l_discount") == 0)


@query("select cast(year(o_orderdate) as int) as year, count(*) as n from orders group by 1")
def by_year(spark, folder):
    return profile.counts_by_value(table(spark, folder, "orders").select(F.year("o_orderdate").alias("year")), "year")


@query("select min(o_totalprice) as lowest, max(o_totalprice) as highest from orders")
def extent(spark, folder):
    return profile.extent(table(spark, folder, "orders"), "o_totalprice")


@query("select o_orderkey, o_totalprice, o_orderpriority from orders order by o_totalprice, o_orderkey limit 15")
def sort_head(spark, folder):
    return profile.head(
        table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"),
        ["o_totalprice", "o_orderkey"],
        15,
    )


@query(
    " union all ".join(
        f"""select '{m}' as "column", count({m}) as count, {c.rounded(f'avg({m})', 3)} as mean,
            {c.rounded(f'stddev_samp({m})', 3)} as std, {c.rounded(f'min({m})', 3)} as min,
            {c.rounded(f'quantile_cont({m}, 0.25)', 3)} as q25, {c.rounded(f'quantile_cont({m}, 0.5)', 3)} as q50,
            {c.rounded(f'quantile_cont({m}, 0.75)', 3)} as q75, {c.rounded(f'max({m})', 3)} as max from lineitem"""
        for m in MEASURES
    )
)
def describe(spark, folder):
    return profile.describe(table(spark, folder, "lineitem"), MEASURES, digits=3)


@query(
    " union all ".join(
        f"""select '{a}' as "column", '{b}' as other, {c.rounded(f'corr({a}, {b})', 9)} as correlation from lineitem"""
        for a in MEASURES
        for b in MEASURES
    )
)
def corr_matrix(spark, folder):
    found = profile.correlations(table(spark, folder, "lineitem"), MEASURES)
    return found.withColumn("correlation", values.round_half_even(F.col("correlation"), 9))


@query(
    " union all ".join(
        f"""select '{a}' as "column", '{b}' as other, {c.rounded(f'corr({a}, {b})', 9)} as correlation from lineitem"""
        for a in MEASURES
        for b in MEASURES
    )
)
def kept_correlations(spark, folder):
    """The same from co-moments that deliveries of unlike size left behind."""
    lines, path = table(spark, folder, "lineitem"), stage_path(spark, "moments")
    for share in ("l_linenumber > 2", "l_linenumber = 2", "l_linenumber < 2", "l_linenumber is null"):
        profile.comoments(lines.where(share), MEASURES).write.mode("append").parquet(path)
    found = profile.correlations_of(spark.read.parquet(path), MEASURES)
    return found.withColumn("correlation", values.round_half_even(F.col("correlation"), 9))


def _histogram_sql(column: str, source: str) -> str:
    width = "((hi - lo) / 50::double)"
    return f"""
        select "column", bin, lower, upper, n from (
            with limits as (select min({column}) as lo, max({column}) as hi from {source}),
            guessed as (select {column} as v, lo, hi,
                least(floor(({column} - lo) * (50::double / (hi - lo))), 49) as g from {source}, limits
                where {column} is not null),
            placed as (select g - (v < g * {width} + lo)::int
                + (v >= (g + 1) * {width} + lo and g < 49)::int + 1 as b from guessed)
            select '{column}' as "column", cast(i as int) as bin, {width} * (i - 1) + lo as lower,
                case when i = 50 then hi else {width} * i + lo end as upper,
                (select count(*) from placed where b = i) as n
            from range(1, 51) r(i), limits)"""


@query(" union all ".join(_histogram_sql(m, "lineitem") for m in ["l_quantity", "l_extendedprice"]))
def histogram_50(spark, folder):
    return profile.histogram(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"])


# --- quality -----------------------------------------------------------------------------


@query(
    c.over(
        "tracks_distinct",
        """select cast(sum(copies) as bigint) as rows_in, cast(sum(copies - 1) as bigint) as duplicates_removed,
            count(*) filter (track_name is null) as missing_removed,
            count(*) filter (track_name is not null and time_signature = 0) as invalid_removed,
            count(*) filter (track_name is not null and time_signature is distinct from 0) as rows_out
           from tracks_distinct""",
    )
)
def quality_audit(spark, folder):
    raw = catalogue(spark, folder).tracks_raw()
    distinct = dedup.distinct_rows(raw, s.ROW_ORDER, copies="_copies")
    return quality.removal_counts(distinct, "_copies", s.IDENTITY_COLUMNS, "time_signature", 0)


@query(
    c.over(
        "awards_raw",
        """select count(*) as total, count(*) filter (year < 1958 or year > 2030) as violations,
           min(year) as lowest, max(year) as highest from awards_raw""",
    )
)
def range_check(spark, folder):
    return quality.range_check(awards_raw(spark, folder), "year", s.FIRST_AWARD_YEAR, s.LAST_AWARD_YEAR)


@query(
    c.over(
        "merged",
        f"""select count(*) as total, count(*) filter (grammy_winner) as matched,
            count(*) filter (not grammy_winner) as unmatched,
            {c.rounded('avg(grammy_winner::int) * 100', 1)} as matched_pct,
            count(*) filter (grammy_winner and primary_artist_normalized = '') as matched_on_empty from merged""",
    )
)
def match_rate(spark, folder):
    return quality.match_rate(catalogue(spark, folder).merged(), "grammy_winner", "primary_artist_normalized")


# --- files ----------------------------------------------------------------------------------

_DOCUMENT = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


@query("select doc_id, text, nullif(lang, 'de') as lang, source, n_chars from documents")
def csv_roundtrip(spark, folder):
    """Texts with quotes and line breaks, and nulls, written as CSV and read back."""
    path = stage_path(spark, "csv")
    docs = table(spark, folder, "documents").withColumn("lang", values.null_if(F.col("lang"), "de"))
    write_csv(docs, path)
    return read_csv(spark, path, _DOCUMENT)


@query("select doc_id, text, lang, source, n_chars from documents")
def encoding_fallback(spark, folder):
    """Files that are not UTF-8 are found out and read as Latin-1."""
    path = stage_path(spark, "latin")
    write_csv(table(spark, folder, "documents"), path, encoding="ISO-8859-1")
    return read_csv(spark, path, _DOCUMENT)


def _mixed_files(spark, folder) -> str:
    """Documents over many files: some in Latin-1, some with line breaks in their texts, some with another order of columns."""
    path, docs = stage_path(spark, "mixed"), table(spark, folder, "documents")
    flat = docs.withColumn("text", F.replace("text", F.lit("\n"), F.lit(" ")))
    for name, rows, encoding in (
        ("a", flat.where("lang = 'fr'").repartition(3, "doc_id"), "ISO-8859-1"),
        ("b", docs.where("lang = 'de'").repartition(2, "doc_id"), "UTF-8"),
        ("c", flat.where("coalesce(lang, '') not in ('fr', 'de')").select("source", "n_chars", "lang", "text", "doc_id").repartition(4, "doc_id"), "UTF-8"),
    ):
        write_csv(rows, f"{path}/{name}", encoding=encoding)
    return f"{path}/*"


@query(
    """select doc_id, case when lang = 'de' then text else replace(text, chr(10), ' ') end as text, lang, source, n_chars
       from documents"""
)
def mixed_encodings(spark, folder):
    """Encoding, line breaks and columns are found out file by file."""
    return read_csv(spark, _mixed_files(spark, folder), _DOCUMENT)


@query(
    """select count(*) as rows, count(*) as places, cast(0 as bigint) as first_place, count(*) - 1 as last_place,
        cast(0 as bigint) as out_of_order from documents"""
)
def many_files(spark, folder):
    """Rows of many files have places that are unique, dense, and rise within each file as its rows do."""
    path = stage_path(spark, "many")
    docs = table(spark, folder, "documents").select("doc_id", "lang", F.crc32("text").alias("n_chars"))
    write_csv(docs.repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id"), path)
    schema = StructType([StructField("place", LongType()), StructField("doc_id", LongType()), StructField("lang", StringType())])
    rows = read_csv(spark, path, schema, order="place")
    after = rows.select((F.col("place") - 1).alias("place"), F.col("doc_id").alias("next_id"))
    falls = rows.join(after, "place").agg(F.count_if(F.col("next_id") < F.col("doc_id")).alias("out_of_order"))
    totals = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("place").alias("places"), F.min("place").alias("first_place"), F.max("place").alias("last_place")
    )
    return totals.join(falls, F.lit(True))


@query(
    """select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus,
        case when o_orderstatus <> 'F' then o_orderpriority end as o_orderpriority
       from orders where o_orderstatus <> 'P'"""
)
def bad_lines(spark, folder):
    """Lines with a field too many are skipped, lines with one too few are filled."""
    path = stage_path(spark, "lines")
    fields = F.when(F.col("o_orderstatus") == "F", F.lit(None)).otherwise(F.col("o_orderpriority"))
    extra = F.when(F.col("o_orderstatus") == "P", F.lit("surplus"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", fields, extra)
    lines = table(spark, folder, "orders").select(line.alias("o_orderkey,o_orderstatus,o_orderpriority"))
    # A single unquoted column whose name is the header line.
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
    return read_csv_text(spark, path, bad_lines="skip")


@query("select n_nationkey, case when n_name not in ('NATION_1', 'NATION_2') then n_name end as n_name from nation")
def na_tokens(spark, folder):
    return table(spark, folder, "nation").select(
        "n_nationkey", null_tokens(F.col("n_name"), ["NATION_1", "NATION_2"]).alias("n_name")
    )


# --- whole jobs ---------------------------------------------------------------------------------


@query(c.over("awards_raw", "select * from awards_raw"))
def seeded_awards(spark, folder):
    """The awards table after its seed from a CSV file."""
    path = stage_path(spark, "seed")
    write_csv(awards_raw(spark, folder), path)
    house = FolderWarehouse(spark, stage_path(spark, "seed_house"))
    etl.seed_awards(spark, path, house)
    return house.read("awards")


def _figures(step: str, source: str, **figures: str) -> str:
    return " union all ".join(
        f"select '{step}' as step, '{name}' as figure, cast({sql} as bigint) as value from {source}"
        for name, sql in figures.items()
    )


_TABLES = ["dim_artist", "dim_genre", "dim_track", "fact_streams"]


@query(
    c.over(
        "fact_streams",
        " union all ".join(
            [
                _figures(
                    "awards: missing filled",
                    "awards_raw",
                    **{f: f"count(*) - count({f})" for f in ("nominee", "artist", "workers")},
                ),
                _figures(
                    "awards: years",
                    "awards_raw",
                    total="count(*)",
                    violations="count(*) filter (year < 1958 or year > 2030)",
                    lowest="min(year)",
                    highest="max(year)",
                ),
                _figures(
                    "tracks: cleaning",
                    "tracks_distinct",
                    rows_in="sum(copies)",
                    duplicates_removed="sum(copies - 1)",
                    missing_removed="count(*) filter (track_name is null)",
                    invalid_removed="count(*) filter (track_name is not null and time_signature = 0)",
                    rows_out="count(*) filter (track_name is not null and time_signature is distinct from 0)",
                ),
                _figures("tracks: repeats", "tracks_clean", repeated_ids_kept="count(track_id) - count(distinct track_id)"),
                _figures("awards: summary", "award_summary", artists="count(*)"),
                _figures(
                    "merge: matches",
                    "merged",
                    total="count(*)",
                    matched="count(*) filter (grammy_winner)",
                    unmatched="count(*) filter (not grammy_winner)",
                    matched_on_empty="count(*) filter (grammy_winner and primary_artist_normalized = '')",
                ),
                *[_figures(f"load: {t}", t, total="count(*)", new="count(*)", omitted="0 * count(*)") for t in _TABLES],
            ]
        ),
    )
)
def run_audit(spark, folder):
    """Every figure of a whole run: clean, enrich, derive the star and load it."""
    house = FolderWarehouse(spark, stage_path(spark, "run_house"))
    done = etl.run(catalogue(spark, folder).tracks_raw(), awards_raw(spark, folder), house)
    return done.audit.frame().drop("position")
