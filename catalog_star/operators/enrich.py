"""Join keys, the award summary per artist and its left join onto the tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog_star.functions import text, values


def add_track_keys(
    tracks: DataFrame, artists: str = "artists", genre: str = "track_genre", explicit: str = "explicit"
) -> DataFrame:
    """Lead artist, its join key and the display form of the genre."""
    lead = text.first_of(F.col(artists))
    spaced = text.replace_literal(F.col(genre), "-", " ")
    return tracks.withColumns(
        {
            "primary_artist": lead,
            "primary_artist_normalized": text.normalize_name(lead),
            genre: text.title_case(spaced),
        }
    ).withColumnRenamed(explicit, "is_explicit")


def summarize_awards(
    awards: DataFrame,
    artist: str = "artist",
    winner: str = "winner",
    year: str = "year",
    category: str = "category",
    key: str = "artist_normalized",
    prefix: str = "grammy",
) -> DataFrame:
    """One row per artist: wins, first and last year, sorted distinct categories.

    A win is any row whose winner flag has a value. Awards are first reduced to one
    row per artist and category, so a much-awarded artist is spread over its
    categories and only distinct ones are ever collected.
    """
    per_category = (
        awards.select(
            text.normalize_name(F.col(artist)).alias(key),
            F.col(category).alias("_category"),
            F.col(winner).alias("_winner"),
            F.col(year).alias("_year"),
        )
        .where(F.col(key) != text.UNMATCHABLE)
        .groupBy(key, "_category")
        .agg(
            F.count("_winner").alias("_wins"),
            F.min("_year").alias("_first"),
            F.max("_year").alias("_last"),
        )
    )
    return per_category.groupBy(key).agg(
        F.sum("_wins").alias(f"{prefix}_wins"),
        F.min("_first").alias(f"{prefix}_first_year"),
        F.max("_last").alias(f"{prefix}_last_year"),
        F.array_join(F.array_sort(F.collect_list("_category")), " | ").alias(f"{prefix}_categories"),
    )


def enrich_tracks(
    tracks: DataFrame,
    summary: DataFrame,
    track_key: str = "primary_artist_normalized",
    summary_key: str = "artist_normalized",
    prefix: str = "grammy",
) -> DataFrame:
    """Left join of the summary, with a match flag and defaults for the unmatched.

    No broadcast is forced. A staged summary is broadcast if its files are below the
    session's threshold; otherwise this is a shuffle join, and adaptive execution
    splits an artist that holds a large part of the tracks.
    """
    wins, first, last, categories = (
        f"{prefix}_{part}" for part in ("wins", "first_year", "last_year", "categories")
    )
    joined = tracks.join(summary, tracks[track_key] == summary[summary_key], "left")
    return joined.drop(summary_key).withColumns(
        {
            f"{prefix}_winner": F.col(wins).isNotNull(),
            wins: values.default(F.col(wins), 0),
            first: values.default(F.col(first), 0),
            last: values.default(F.col(last), 0),
            categories: values.default(F.col(categories), text.MISSING_NAME),
        }
    )
