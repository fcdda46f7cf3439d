"""Dimensions and fact with dense surrogate keys, derived from one flat table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from catalog_star import schemas as s
from catalog_star.functions import values
from catalog_star.operators.dedup import keep_first, key_digest
from catalog_star.operators.keys import KnownKeys, number_rows, number_unseen, number_within
from catalog_star.operators.quality import require_unique
from catalog_star.staging import stage


@dataclass(frozen=True)
class Dimension:
    """How one dimension is cut from the flat table.

    ``attributes`` maps output columns to columns of the flat table; those in
    ``zero_is_null`` turn a filled-in zero back into null. ``repeats`` tells that the
    attributes hardly vary within a key.
    """

    name: str
    key: str
    natural: str
    attributes: dict[str, str] = field(default_factory=dict)
    zero_is_null: tuple[str, ...] = ()
    repeats: bool = True


@dataclass(frozen=True)
class StarLayout:
    dimensions: tuple[Dimension, ...]
    fact: str
    fact_key: str
    references: tuple[str, ...]
    measures: tuple[str, ...]

    def sources(self) -> set[str]:
        """Columns of the flat table that any of the tables needs."""
        wanted = set(self.measures)
        for d in self.dimensions:
            wanted |= {d.natural, *d.attributes.values()}
        return wanted


@dataclass(frozen=True)
class Star:
    """The dimension and fact tables (staged), and the natural keys behind the surrogate ones.

    ``key_maps`` has a table per dimension and one for the fact; stored next to the tables, they
    let a later load give every row it has seen the key it had. ``summary`` stands for the fact where only counts and sums by
    artist and genre are asked for; several rows may tell of one pair.
    """

    dimensions: dict[str, DataFrame]
    fact_name: str
    fact: DataFrame
    key_maps: dict[str, DataFrame] = field(default_factory=dict)
    fact_key: str = ""
    references: tuple[str, ...] = ()
    flat: DataFrame | None = None
    summary: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        """Dimensions first, so that a load in this order never breaks a reference."""
        return {**self.dimensions, self.fact_name: self.fact}


TRACK_STAR = StarLayout(
    dimensions=(
        Dimension(
            "dim_artist", "artist_key", "primary_artist",
            {
                "primary_artist": "primary_artist",
                "grammy_winner": "grammy_winner",
                "grammy_wins": "grammy_wins",
                "grammy_first_year": "grammy_first_year",
                "grammy_last_year": "grammy_last_year",
                "grammy_categories": "grammy_categories",
            },
            zero_is_null=("grammy_first_year", "grammy_last_year"),
        ),
        Dimension("dim_genre", "genre_key", "track_genre", {"track_genre": "track_genre"}),
        Dimension(
            "dim_track", "track_key", "track_id",
            {
                "track_name": "track_name",
                "album_name": "album_name",
                "is_explicit": "is_explicit",
                "duration_s": "duration_s",
                "key_note": "key",
                "mode": "mode",
                "time_signature": "time_signature",
            },
            repeats=False,
        ),
    ),
    fact="fact_streams",
    fact_key="stream_key",
    references=("track_key", "artist_key", "genre_key"),
    measures=("popularity", *s.AUDIO_FEATURES),
)


def build_dimension(rows: DataFrame, dimension: Dimension, order: str, known: DataFrame | KnownKeys | None = None) -> DataFrame:
    """Attributes of each natural key's first row, keyed by first appearance (staged).

    Natural keys in ``known`` keep their key. The natural key is kept as ``_natural`` for the fact to look keys up by.
    """
    attributes = [
        (values.null_if(F.col(source), 0) if name in dimension.zero_is_null else F.col(source)).alias(name)
        for name, source in dimension.attributes.items()
    ]
    cut = rows.select(order, F.col(dimension.natural).alias("_natural"), *attributes)
    first = keep_first(cut, ["_natural"], order, collapse=dimension.repeats)
    if isinstance(known, DataFrame):
        known = known.withColumnRenamed(dimension.natural, "_natural")
    if isinstance(known, KnownKeys):  # its buckets go by the stored name and type of the natural key
        stored = known
        near = lambda batch, _: stored.near(batch.select(F.col("_natural").alias(dimension.natural)), [dimension.natural]).withColumnRenamed(dimension.natural, "_natural")
        known = KnownKeys(stored.highest, near)
    return number_unseen(first, known, ["_natural"], order, dimension.key, dimension.name).drop(order)


def look_up_keys(facts: DataFrame, keyed: DataFrame, key: str, natural: str) -> DataFrame:
    """Left join of a dimension's key; a null natural key finds the null member.

    Both sides are stage tables or shuffles of them: small dimensions are broadcast by
    their file size, large ones shuffle-joined with adaptive splitting of hot keys.
    """
    lookup = keyed.select(key, F.col("_natural").alias(f"_{key}"))
    return facts.join(lookup, F.col(natural).eqNullSafe(F.col(f"_{key}")), "left").drop(f"_{key}")


def with_row_identity(digested: DataFrame, order: str, label: str = "copies") -> DataFrame:
    """Add what tells a fact row from equal ones whenever it is loaded: beside ``_digest``, its number among rows of the same digest.

    Equal rows are interchangeable, so they are told apart by count. Digests are counted by a short hash first, then those that share one by themselves; only rows of
    digests that repeat are numbered, by a scan that cuts even one group of equal rows into partitions, and come back by their order, which is unique.
    """
    once = digested.withColumn("_copy", F.lit(1).cast("long"))
    slot = F.xxhash64("_digest")
    shared = stage(digested.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), f"{label}_shared")
    if shared.isEmpty():
        return once
    candidates = digested.join(shared, slot == F.col("_slot"), "left_semi")
    repeated = stage(candidates.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), f"{label}_repeated")
    if repeated.isEmpty():
        return once
    again = digested.select(order, "_digest").join(repeated, "_digest", "left_semi")
    copies = number_within(again, "_digest", order, "_copy", f"{label}_numbered").where("_copy > 1")
    copies = stage(copies.select(F.col(order).alias("_order"), "_copy"), label)
    found = digested.join(copies, F.col(order) == F.col("_order"), "left").drop("_order")
    return found.withColumn("_copy", F.coalesce("_copy", F.lit(1).cast("long")))


def build_star(
    merged: DataFrame, order: str = s.ROW_ORDER, layout: StarLayout = TRACK_STAR, known: dict[str, DataFrame] | dict[str, KnownKeys] | None = None
) -> Star:
    """Derive all tables from ``merged``; ``order`` must be unique, which is checked.

    ``known`` holds the key maps of earlier loads: rows they name keep their keys. The flat table is staged once. Every
    dimension reads its few columns from that stage and is staged itself, as output and as the lookup for the
    fact. Keys are looked up, and the fact is numbered, on rows of its order and one natural key or digest; measures are shuffled
    once, to meet the keys. The fact is staged: whoever reads it afterwards scans a table.
    """
    known = known or {}
    sources = layout.sources()
    naturals = list(dict.fromkeys(d.natural for d in layout.dimensions))
    flat = merged.select(order, *[c for c in merged.columns if c in sources and c != order])
    flat = stage(flat, layout.fact)
    require_unique(flat, order)
    keyed = {d.name: build_dimension(flat, d, order, known.get(d.name)) for d in layout.dimensions}
    identity = with_row_identity(flat.select(order, key_digest([*naturals, *layout.measures]).alias("_digest")), order, f"{layout.fact}_copies")
    if layout.fact in known:
        numbered = number_unseen(identity, known[layout.fact], ["_digest", "_copy"], order, layout.fact_key, f"{layout.fact}_numbered")
    else:
        numbered = number_rows(flat.select(order), order, layout.fact_key, label=f"{layout.fact}_numbered")
    by_order = [numbered.select(order, layout.fact_key)]
    by_order += [look_up_keys(flat.select(order, d.natural), keyed[d.name], d.key, d.natural).select(order, d.key) for d in layout.dimensions]
    facts = flat.select(order, *layout.measures)
    for keys in by_order:
        facts = facts.join(keys, order)
    facts = stage(facts, f"{layout.fact}_keyed")
    stored = numbered if layout.fact in known else identity.join(facts.select(order, layout.fact_key), order)
    maps = {d.name: keyed[d.name].select(d.key, F.col("_natural").alias(d.natural)) for d in layout.dimensions}
    return Star(
        dimensions={d.name: keyed[d.name].select(d.key, *d.attributes) for d in layout.dimensions},
        fact_name=layout.fact,
        fact=facts.select(layout.fact_key, *layout.references, *layout.measures),
        key_maps={**maps, layout.fact: stored.select(layout.fact_key, "_digest", "_copy")},
        fact_key=layout.fact_key,
        references=layout.references,
        flat=flat,
    )
