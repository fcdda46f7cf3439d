import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, ratio string, kept string, score string, value string, label string, `key` string, pass string, block string, start string, `order` string, bucket string, digest string, hash string"


def words(seed: int, n: int, size: int = 5000) -> list[str]:
    rng = np.random.Generator(np.random.PCG64(seed))
    return [f"w{x}" for x in rng.integers(0, size, n)]


def prose(seed: int, n: int, size: int = 5000) -> str:
    return " ".join(words(seed, n, size))


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Nulls in every column, empty and blank and very long texts, repeated rows and ids, and columns that clash with results."""
    long = prose(1, 30_000)
    rows = [
        (1, "", "en", "a", 0), (2, None, None, None, None), (3, " \t\n\r\f\v ", "en", "a", 3), (4, long, "en", None, 9), (4, long, "en", None, 9),
        (4, prose(2, 40), "de", "b", 1), (None, prose(3, 70), None, "b", 1), (None, None, None, None, None), (5, "word", "en", "c", 4), (6, "two words", "fr", "c", 4),
        (7, "a b c " * 400, "en", "a", 4), (8, "naïve – ÉTÉ 你好 🙂 x y", "fr", "", 4), (9, "<|endoftext|> 1 2 3 don't \x1f ́x", "de", "b", 4),
    ]
    return spark.createDataFrame([(*r, 7, *["x"] * 13) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_rows(odd_rows):
    return odd_rows.where("false")
