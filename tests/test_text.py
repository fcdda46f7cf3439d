import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from catalog_star.functions import text, values

NORMALIZED = [
    (None, "n/a"), ("N/A", "n/a"), ("n/a", "n/a"), ("Jay-Z Featuring X", "jay-z"), ("Little Feat", "little"),
    ("(Hed) P.E.", ""), ("Earth, Wind & Fire", "earth, wind"), ("With You", "with you"),
    ("Dance With Me", "dance"), ("A&B", "a&b"), ("A (B) & C", "a"), ("X\x1cfeat Y", "x"), ("Q & Z", "q"),
]
TITLED = [
    ("best r&b performance", "Best R&B Performance"), ("best children's album", "Best Children'S Album"),
    ("2nd best o'neal", "2Nd Best O'Neal"), ("x_y", "X_Y"), ("ABC dEF", "Abc Def"), ("ßtraße", "Sstraße"),
    ("İstanbul", "İstanbul"), ("日本abc", "日本Abc"), ("", ""), (None, None),
]
GENRES = [("drum-and-bass", "Drum And Bass"), ("r-n-b", "R N B"), ("idm", "Idm"), ("hip-hop", "Hip Hop")]
SECONDS = [(230665, 230.66), (200015, 200.02), (1005, 1.0), (1015, 1.01), (230675, 230.68)]


def applied(spark, inputs, kind, rule):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", rule(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "rule, table, kind",
    [
        (text.normalize_name, NORMALIZED, "string"),
        (text.title_case, TITLED, "string"),
        (lambda c: text.title_case(text.replace_literal(c, "-", " ")), GENRES, "string"),
        (values.milliseconds_to_seconds, SECONDS, "long"),
        (text.first_of, [("Tyler, The Creator", "Tyler"), (" A ;B", "A ;B"), (",x", ""), (None, None)], "string"),
        (text.collapse_whitespace, [("a \t\n b c", "a b c"), ("\x1c\x1dx", " x")], "string"),
    ],
)
def test_fixed_tables(spark, rule, table, kind):
    assert applied(spark, [i for i, _ in table], kind, rule) == [o for _, o in table]


def test_strip_matches_python_on_every_blank(spark):
    blanks = [chr(i) for i in range(0x110000) if chr(i).isspace()]
    inputs = [b + "a" + b + "b" + b for b in blanks] + ["​x​", "", " \t\n"]
    assert applied(spark, inputs, "string", text.strip) == [x.strip() for x in inputs]


def test_title_and_lower_match_python_on_random_text(spark):
    rng = random.Random(7)
    pool = [chr(i) for i in range(0x20, 0x250) if unicodedata.category(chr(i)) != "Cc"] + list("ΑΒςωЖж '-&.(")
    pool = [c for c in pool if c not in "ƛ"]  # newer Unicode gave it an upper case
    inputs = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    assert applied(spark, inputs, "string", text.title_case) == [x.title() for x in inputs]


def test_mojibake(spark):
    inputs = ["JosÃ©", "Beyoncé", "plain", "日本", None, "â\x82¬ and Ã", "José".encode().decode("latin-1") * 3]
    wanted = ["José", "Beyonc�", "plain", "日本", None, "€ and �", "José" * 3]
    assert applied(spark, inputs, "string", text.repair_mojibake) == wanted


def test_mojibake_matches_python_on_random_bytes(spark):
    rng = random.Random(3)
    inputs = [bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0xFF, 0xED, 0xA0]) for _ in range(8)).decode("latin-1") for _ in range(500)]
    wanted = [x.encode("latin-1").decode("utf-8", errors="replace") for x in inputs]
    assert applied(spark, inputs, "string", text.repair_mojibake) == wanted


def test_rounding_matches_numpy(spark):
    import numpy as np

    rng = random.Random(5)
    inputs = [rng.uniform(-1e4, 1e4) for _ in range(2000)] + [i / 1000 for i in range(0, 4000, 5)]
    found = applied(spark, inputs, "double", lambda c: values.round_half_even(c, 2))
    assert found == [float(x) for x in np.round(np.array(inputs), 2)]


def test_null_rules(spark):
    assert applied(spark, [0, 3, None], "int", lambda c: values.not_value(c, 0)) == [False, True, True]
    assert applied(spark, [True, False, None], "boolean", values.truthy) == [True, False, True]
    assert applied(spark, [0, 3, None], "int", lambda c: values.null_if(c, 0)) == [None, 3, None]
    assert applied(spark, [1957, 1958, 2030, 2031, None], "int", lambda c: values.outside(c, 1958, 2030)) == [True, False, False, True, False]
    assert applied(spark, [0, 11, 12, -1, None], "int", lambda c: values.map_codes(c, {0: "C", 11: "B"})) == ["C", "B", None, None, None]


def test_string_columns(spark):
    assert text.string_columns(spark.createDataFrame([], "a int, b string, c double, d string")) == ["b", "d"]
