"""Key figures over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog_star import schemas as s
from catalog_star.functions import values
from catalog_star.operators.star import Star


SUMMED = ("popularity", *s.AUDIO_FEATURES)


def summarize_streams(fact: DataFrame) -> DataFrame:
    """Streams by genre and artist: their number, and sum and number of every measure. Rows of several loads add up."""
    sums = [F.sum(F.col(m).cast("double")).alias(f"s_{m}") for m in SUMMED] + [F.count(m).alias(f"n_{m}") for m in SUMMED]
    return fact.groupBy("genre_key", "artist_key").agg(F.count(F.lit(1)).alias("streams"), *sums)


def total_tracks(star: Star) -> DataFrame:
    return star.dimensions["dim_track"].agg(F.count(F.lit(1)).alias("tracks"))


def award_winning_artists(star: Star) -> DataFrame:
    winners = star.dimensions["dim_artist"].where("grammy_winner")
    return winners.agg(F.count(F.lit(1)).alias("winning_artists"))


def genres_by_winning_artists(star: Star, k: int | None = None) -> DataFrame:
    """Distinct award-winning artists per genre, most first.

    Facts are reduced to distinct (genre, artist) keys before any name is joined, so
    the joins see a small table and a dominant genre is spread over its artists. A summary of the facts spares reading them.
    """
    winners = star.dimensions["dim_artist"].where("grammy_winner").select("artist_key")
    facts = star.fact if star.summary is None else star.summary
    pairs = facts.select("genre_key", "artist_key").distinct()
    counted = (
        pairs.join(winners, "artist_key", "left_semi")
        .groupBy("genre_key")
        .agg(F.count(F.lit(1)).alias("winning_artists"))
    )
    named = counted.join(star.dimensions["dim_genre"], "genre_key").select("track_genre", "winning_artists")
    if k is None:
        return named
    return named.orderBy(F.desc("winning_artists"), F.asc("track_genre")).limit(k)


def averages_by_award(star: Star, measures: list[str], digits: int = 6) -> DataFrame:
    """Mean of each measure for award-winning artists' tracks and for the rest.

    Facts are first summed per artist, which needs one shuffle of partial sums and
    leaves one row per artist to join with the artist dimension. A summary of the facts spares reading them.
    """
    if star.summary is None:
        sums = [F.sum(m).alias(f"_s_{m}") for m in measures] + [F.count(m).alias(f"_n_{m}") for m in measures]
        per_artist = star.fact.groupBy("artist_key").agg(F.count(F.lit(1)).alias("_rows"), *sums)
    else:
        sums = [F.sum(f"{x}_{m}").alias(f"_{x}_{m}") for x in "sn" for m in measures]
        per_artist = star.summary.groupBy("artist_key").agg(F.sum("streams").alias("_rows"), *sums)
    flags = star.dimensions["dim_artist"].select("artist_key", "grammy_winner")
    means = [
        values.round_half_even(F.sum(f"_s_{m}") / F.sum(f"_n_{m}"), digits).alias(f"avg_{m}") for m in measures
    ]
    return (
        per_artist.join(flags, "artist_key")
        .groupBy("grammy_winner")
        .agg(F.sum("_rows").alias("streams"), *means)
    )


def popularity_and_danceability(star: Star) -> DataFrame:
    return averages_by_award(star, ["popularity", "danceability"])


def audio_profile(star: Star) -> DataFrame:
    return averages_by_award(star, ["energy", "valence", "acousticness"])
