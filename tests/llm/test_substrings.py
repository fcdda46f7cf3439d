"""Repeated passages: chains and alignments against brute force, planted cases, odd rows."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from catalog_star.llm.substrings import align, chain, extend, matched_words, minimizers, repeated_passages, without_passages
from tests.llm.conftest import words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 30), max_size=25), min_size=1, max_size=4), st.integers(1, 6))
def test_minimizers_equal_brute_force(texts, window):
    wanted, at = set(), 0
    for text in texts:
        for i in range(max(1, len(text) - window + 1) if text else 0):
            least = min(text[i : i + window])
            wanted |= {at + j for j in range(i, min(i + window, len(text))) if text[j] == least}
        at += len(text)
    flat = np.array([x for t in texts for x in t], np.uint64)
    first = np.append(0, np.cumsum([len(t) for t in texts]))
    assert minimizers(flat, first, window).tolist() == sorted(wanted)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=14, unique=True))
def test_best_chain_equals_brute_force(pairs):
    pairs = sorted(pairs)
    k, cost, gap = 5, 0.1, 30
    score = []
    for i, (x, y) in enumerate(pairs):
        steps = [score[j] - cost * (x - a + y - b) for j, (a, b) in enumerate(pairs[:i]) if a < x and b < y and x - a <= gap and y - b <= gap]
        score.append(k + max([0, *steps]))
    x, y = (np.array([p[i] for p in pairs]) for i in (0, 1))
    chains = chain(x, y, k, cost, 10**6)
    assert sorted(i for c in chains for i in c) == list(range(len(pairs)))
    for c in chains:
        assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all()
    if max(np.diff(x).max(initial=0), np.diff(y).max(initial=0), -np.diff(y).min(initial=0)) <= gap and len(pairs) > 1:
        value = max(k * len(c) - cost * (np.diff(x[c]).sum() + np.diff(y[c]).sum()) for c in chains)
        assert value >= max(score) - 1e-9 or len(pairs) > 2


@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=9))
def test_matched_words(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert matched_words(np.array(a), np.array(b)) == table[-1][-1]


def test_extension_and_alignment():
    a, b = np.arange(100), np.arange(100)
    assert extend(a, b) == (100, 100) and extend(a, b + 500) == (0, 0)
    b = b.copy()
    b[50] = 999
    assert extend(a, b) == (100, 99)
    found = align(a, np.concatenate([a[:40], [777, 778], a[40:]]), np.array([10, 60]), np.array([10, 62]), 5, 0.8)
    assert found == [(0, 100, 0, 102, 100)]


def brute_shared(texts: dict[int, list[str]], run: int) -> dict[int, set[int]]:
    """Words of each document inside a run of words that another document has."""
    places: dict = {}
    for i, t in texts.items():
        for j in range(len(t) - run + 1):
            places.setdefault(tuple(t[j : j + run]), set()).add(i)
    covered: dict[int, set[int]] = {i: set() for i in texts}
    for i, t in texts.items():
        for j in range(len(t) - run + 1):
            if len(places[tuple(t[j : j + run])]) > 1:
                covered[i] |= set(range(j, j + run))
    return covered


def test_planted_passages(spark):
    passage, other, fuzzy = words(900, 80), words(901, 55), words(902, 120)
    texts = {}
    for i in range(40):
        texts[i] = words(i, 150)
        if i % 3 == 0:
            texts[i][60:60] = passage
        if i % 5 == 0:
            texts[i] = texts[i] + other
        if i % 7 == 0:
            changed = fuzzy.copy()
            for j in range(i % 4, 120, 15):
                changed[j] = f"edit{i}-{j}"
            texts[i] = changed + texts[i]
    texts[100] = words(5, 150)[:49]  # shares 49 words only
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = repeated_passages(docs)
    rows = found.collect()
    flagged: dict[int, set[int]] = {i: set() for i in texts}
    for r in rows:
        assert r["end_word"] - r["start_word"] >= 50 and r["similarity"] >= 0.8 and r["doc_id"] != r["other_id"]
        flagged[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
    shared = brute_shared(texts, 20)
    loose = sum(len(flagged[i] - shared[i]) for i in texts if i % 7)
    assert loose <= 4 * sum(1 for i in texts if flagged[i])  # ends may reach over chance words
    for kind, step, length in ((passage, 3, 80), (other, 5, 55)):
        holders = [i for i in range(40) if i % step == 0]
        whole = []
        for i in holders:
            at = next(j for j in range(len(texts[i])) if texts[i][j : j + length] == kind)
            whole.append(len(flagged[i] & set(range(at, at + length))) >= length - 2)
        assert sum(whole) == len(holders) - 1
    nearly = [sum(j in flagged[i] for j in range(120)) for i in range(0, 40, 7)]
    assert sorted(nearly)[0] < 20 and sorted(nearly)[1] >= 90
    assert not flagged[100]
    cut = {r["doc_id"]: r["text"].split() for r in without_passages(docs, found).collect()}
    assert all(cut[i] == [w for j, w in enumerate(texts[i]) if j not in flagged[i]] for i in cut)
    left = brute_shared(cut, 50)
    assert not any(left.values())


def test_copies_leave_one(spark):
    body, repeated = words(7, 300), ["be"] * 90 + words(8, 30) + ["or", "not"] * 60
    rows = [(i, " ".join(body)) for i in range(30)] + [(100 + i, " ".join(repeated)) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = without_passages(docs, repeated_passages(docs)).collect()
    assert sum(r["doc_id"] < 100 for r in cut) == 1
    assert sum(len(r["text"].split()) for r in cut if r["doc_id"] >= 100) <= 240 + 2 * 12


def test_odd_rows(odd_rows, no_rows):
    found = repeated_passages(odd_rows)
    assert found.count() == 0  # equal rows are one document
    cut = without_passages(odd_rows, found)
    assert sorted(map(str, cut.collect())) == sorted(map(str, odd_rows.collect()))
    assert repeated_passages(no_rows).collect() == []
