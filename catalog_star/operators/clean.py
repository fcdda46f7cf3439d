"""Cleaning of the two raw inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalog_star import schemas as s
from catalog_star.functions import text, values
from catalog_star.operators.dedup import distinct_rows


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which every one of ``columns`` has a value."""
    return df.dropna(how="any", subset=columns)


def drop_value(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` is not ``value``; nulls stay."""
    return df.where(values.not_value(F.col(column), value))


def strip_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: text.strip(F.col(c)) for c in columns})


def fill_missing(df: DataFrame, columns: list[str], value) -> DataFrame:
    return df.withColumns({c: values.default(F.col(c), value) for c in columns})


def title_and_collapse(c: Column) -> Column:
    return text.collapse_whitespace(text.title_case(c))


def tidy_tracks(tracks: DataFrame, identity: list[str] = s.IDENTITY_COLUMNS) -> DataFrame:
    """Drop unusable rows of a deduplicated catalogue, tidy text and decode codes."""
    rows = drop_value(drop_missing(tracks, identity), "time_signature", 0)
    rows = strip_columns(rows, [*identity, "track_genre"])
    return rows.withColumns(
        {
            "artists": text.replace_literal(F.col("artists"), ";", ", "),
            "explicit": values.truthy(F.col("explicit")),
            "key": values.map_codes(F.col("key"), s.PITCH_NAMES),
            "mode": values.map_codes(F.col("mode"), s.MODE_NAMES),
            "duration_s": values.milliseconds_to_seconds(F.col("duration_ms")),
        }
    ).drop("duration_ms")


def clean_tracks(
    tracks: DataFrame, order: str = s.ROW_ORDER, identity: list[str] = s.IDENTITY_COLUMNS
) -> DataFrame:
    """Deduplicate, then tidy.

    Text is stripped after deduplication, so rows that differ only in outer
    whitespace all survive.
    """
    return tidy_tracks(distinct_rows(tracks, order), identity)


def clean_awards(
    awards: DataFrame,
    unused: list[str] = s.AWARD_UNUSED_COLUMNS,
    text_columns: list[str] = s.AWARD_TEXT_COLUMNS,
) -> DataFrame:
    """Drop web metadata, tidy text and fill missing credits."""
    rows = strip_columns(awards.drop(*unused), text_columns)
    rows = rows.withColumn("category", title_and_collapse(F.col("category")))
    return fill_missing(rows, ["nominee", "artist", "workers"], text.MISSING_NAME)
