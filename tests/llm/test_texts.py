"""Counts per text against brute force in plain Python."""

import re
import string
from collections import Counter

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from catalog_star.llm.quality import Bands, compression_verdict, quality_rules, word_statistics
from catalog_star.llm.texts import Texts, windows
from catalog_star.llm.wordcache import WordCache, number_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SOME_TEXT = st.text(st.sampled_from("ab é你\n\t\r\x0b\x0c #|🙂 "), max_size=60)


def brute_statistics(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), SOME_TEXT), max_size=6))
def test_statistics_equal_brute_force(texts):
    if not texts:
        return
    made = word_statistics(Texts.of(texts))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(int(made[n][i]) for n in names) for i in range(len(texts))] == [brute_statistics(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(SOME_TEXT, min_size=1, max_size=5))
def test_equal_words_have_equal_hashes_in_any_batch(texts):
    together = Texts.of(texts)
    _, _, first = together.words()
    for i, text in enumerate(texts):
        assert (Texts.of([text]).word_hashes() == together.word_hashes()[first[i] : first[i + 1]]).all()
    found = dict(zip(together.word_hashes().tolist(), (w for t in texts for w in WORD.findall(t))))
    assert len(found) == len({w for t in texts for w in WORD.findall(t)})


def test_windows_stay_within_a_text():
    texts = Texts.of(["a b c", "d e", "", "a b c d"])
    _, _, first = texts.words()
    hashes, place = windows(texts.word_hashes(), first, 3)
    assert place.tolist() == [0, 5, 6] and hashes[0] == hashes[1] != hashes[2]


def test_word_cache_asks_for_each_word_once():
    cache, asked = WordCache(100), []

    def make(words):
        asked.extend(words)
        return np.array([len(w) for w in words])

    assert number_words(Texts.of(["aa b aa", "ccc b"]), cache, make).tolist() == [2, 1, 2, 3, 1]
    assert number_words(Texts.of(["ccc dddd"]), cache, make).tolist() == [3, 4]
    assert sorted(asked) == [b"aa", b"b", b"ccc", b"dddd"]


def test_quality_of_odd_rows(spark, odd_rows, no_rows):
    found = quality_rules(odd_rows).collect()
    assert len(found) == odd_rows.count()
    brute = Counter((r["doc_id"], *brute_statistics(r["text"])) for r in odd_rows.collect())
    assert brute == Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in found)
    assert all(r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) for r in found)
    assert not any(r["kept"] for r in found if r["base_failed"])
    assert quality_rules(no_rows).collect() == []


def test_bands_refuse_repetition_and_noise(spark):
    rng = np.random.Generator(np.random.PCG64(5))
    noise = " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"), 12)) for _ in range(800))
    pattern = "".join(f"item {i} has the same long description as every other item of the list, " for i in range(400))
    prose = " ".join(rng.choice(["the", "of", "and", "house", "river", "walked", "slowly", "green", "under", "morning", "letters", "against"] + [f"{a}{b}ing" for a in "bcdfgl" for b in "aeiou"], 800))
    docs = spark.createDataFrame([(1, noise), (2, pattern), (3, prose), (4, prose + " " + noise)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert not found[1]["base_failed"] and not found[1]["kept"] and found[1]["ratio"] > 0.7
    assert not found[2]["kept"] and found[2]["ratio"] < 0.13
    assert found[3]["kept"] and not found[4]["kept"] and found[4]["bad_share"] > 0.34
    loose = Bands(bands=((0, 0.0, 9.0),))
    assert all(r["kept"] or r["base_failed"] for r in quality_rules(docs, bands=loose).collect())


@pytest.mark.parametrize("size", [200, 400, 800, 1500, 3000, 8000, 60_000])
def test_bands_of_every_length_part_text_from_repetition_and_noise(size):
    """Patterns that five-word windows miss, and encoded noise; from 256 bytes on for noise, as shorter text packs no better."""
    packer = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
    bands, refused = Bands(), 0
    for seed in range(20):
        rng = np.random.Generator(np.random.PCG64([seed, size]))
        stems = ["".join(rng.choice(list("etaoinshrdlu"), int(n))) for n in rng.integers(2, 9, 400)]
        weight = 1 / np.arange(1, 401)
        running = " ".join(rng.choice(stems, size, p=weight / weight.sum()))[:size].encode()
        pattern = " ".join(f"{stems[i % 7]} {i} " + " ".join(stems[7:10]) for i in range(size))[:size].encode()
        noise = "".join(rng.choice(list(string.ascii_letters + string.digits + "+/"), size)).encode()
        assert compression_verdict(running, bands, packer)[2], compression_verdict(running, bands, packer)
        refused += not compression_verdict(pattern, bands, packer)[2]
        assert size < 512 or not compression_verdict(noise, bands, packer)[2]
    assert size < 400 or refused == 20
