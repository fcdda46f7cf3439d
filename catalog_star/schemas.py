"""Table layouts and the constants the catalogue and awards data are read with."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Cell texts that mean "missing" in a CSV file.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Pitch classes and modes.
PITCH_NAMES = {
    0: "C", 1: "C#", 2: "D", 3: "D#", 4: "E", 5: "F",
    6: "F#", 7: "G", 8: "G#", 9: "A", 10: "A#", 11: "B",
}
MODE_NAMES = {0: "Minor", 1: "Major"}

# Years in which an award can have been given.
FIRST_AWARD_YEAR = 1958
LAST_AWARD_YEAR = 2030

ROW_ORDER = "row_ord"

AUDIO_FEATURES = [
    "danceability", "energy", "loudness", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo",
]
IDENTITY_COLUMNS = ["track_id", "track_name", "artists", "album_name"]
AWARD_TEXT_COLUMNS = ["category", "nominee", "artist", "workers"]
AWARD_UNUSED_COLUMNS = ["img", "title", "published_at", "updated_at"]


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


TRACKS_RAW = _struct(
    row_ord=LongType(), track_id=StringType(), artists=StringType(),
    album_name=StringType(), track_name=StringType(), popularity=IntegerType(),
    duration_ms=LongType(), explicit=BooleanType(), danceability=DoubleType(),
    energy=DoubleType(), key=IntegerType(), loudness=DoubleType(), mode=IntegerType(),
    speechiness=DoubleType(), acousticness=DoubleType(), instrumentalness=DoubleType(),
    liveness=DoubleType(), valence=DoubleType(), tempo=DoubleType(),
    time_signature=IntegerType(), track_genre=StringType(),
)

AWARDS_RAW = _struct(
    year=IntegerType(), title=StringType(), published_at=StringType(),
    updated_at=StringType(), category=StringType(), nominee=StringType(),
    artist=StringType(), workers=StringType(), img=StringType(), winner=BooleanType(),
)
