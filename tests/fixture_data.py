"""A tiny catalogue and awards table, and the star worked out from them by hand."""

from catalog_star import schemas as s

AUDIO = (0.5, 0.5, -5.0, 0.5, 0.5, 0.5, 0.5, 0.5, 120.0)


def track(ord_, id_, name, artists, album, pop, ms, explicit, key, mode, sig, genre):
    d, e, loud, sp, ac, ins, li, va, tempo = AUDIO
    return (ord_, id_, artists, album, name, pop, ms, explicit, d, e, key, loud, mode, sp, ac, ins, li, va, tempo, sig, genre)


TRACKS = [
    track(0, "t1", "Song A", "Ann Lee;Bob", "Alb 1", 50, 230665, False, 0, 1, 4, "hip-hop"),
    track(1, "t1", "Song A", "Ann Lee;Bob", "Alb 1", 50, 230665, False, 0, 1, 4, "r-n-b"),
    track(2, "t1", "Song A", "Ann Lee;Bob", "Alb 1", 50, 230665, False, 0, 1, 4, "hip-hop"),
    track(3, "t2", None, "X", "Alb 2", 5, 1000, False, 1, 0, 4, "pop"),
    track(4, "t3", "Song C", "(Hed) P.E.", "Alb 3", 0, 180005, True, 11, 0, 0, "metal"),
    track(5, "t4", "\tSong D ", "Simon & Friends", "Alb 4", 70, 200015, True, -1, 0, None, "indie-pop"),
    track(6, "t5", "Song E", "Little Feat", "Alb 5", 10, 1005, False, 6, 1, 3, None),
    track(7, "t4", "Song D alt", "Simon & Friends", "Alb 4b", 71, 200015, True, 2, 1, 4, "hip-hop"),
]


def award(year, category, nominee, artist, workers, winner):
    return (year, "ceremony", "p", "u", category, nominee, artist, workers, "img", winner)


AWARDS = [
    award(1999, "best r&b  song", "N1", "Ann Lee feat. Zed", None, True),
    award(2003, "album of the year", "N2", "ANN LEE", "W", True),
    award(2001, "Best R&B  Song", "N3", " Ann Lee ", None, None),
    award(1980, "record of the year", None, None, "W2", True),
    award(1975, "Best Duo", "N5", "Simon & Garfunkel", None, True),
    award(2010, "x", "N6", "Nobody", None, True),
]

SUMMARY = [
    ("ann lee", 2, 1999, 2003, "Album Of The Year | Best R&B Song"),
    ("nobody", 1, 2010, 2010, "X"),
    ("simon", 1, 1975, 1975, "Best Duo"),
]
DIM_ARTIST = [
    (1, "Ann Lee", True, 2, 1999, 2003, "Album Of The Year | Best R&B Song"),
    (2, "Simon & Friends", True, 1, 1975, 1975, "Best Duo"),
    (3, "Little Feat", False, 0, None, None, "N/A"),
]
DIM_GENRE = [(1, "Hip Hop"), (2, "R N B"), (3, "Indie Pop"), (4, None)]
DIM_TRACK = [
    (1, "Song A", "Alb 1", False, 230.66, "C", "Major", 4),
    (2, "Song D", "Alb 4", True, 200.02, None, "Minor", None),
    (3, "Song E", "Alb 5", False, 1.0, "F#", "Major", 3),
]
FACT = [(1, 1, 1, 1, 50), (2, 1, 1, 2, 50), (3, 2, 2, 3, 70), (4, 3, 3, 4, 10), (5, 2, 2, 1, 71)]


def tracks(spark, partitions=3):
    return spark.createDataFrame(TRACKS, s.TRACKS_RAW).repartition(partitions)


def awards(spark):
    return spark.createDataFrame(AWARDS, s.AWARDS_RAW)


def rows(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
