"""Passages whose seeds have strangers of smaller key as holders, against brute force."""

import numpy as np
from pyspark.sql import functions as F

from catalog_star.llm.substrings import repeated_passages, without_passages
from tests.llm.conftest import words
from tests.llm.test_substrings import brute_shared


def test_passages_whose_phrases_are_held_by_others(spark):
    rng = np.random.Generator(np.random.PCG64(6))
    texts, pairs, passages = {}, [], [words(500 + p, 50 + 2 * p) for p in range(6)]
    for p, passage in enumerate(passages):
        own = [words(600 + 2 * p + side, int(rng.integers(0, 90))) + passage + words(700 + 2 * p + side, int(rng.integers(0, 90))) for side in range(2)]
        tried = spark.createDataFrame([(1_000_000 + 1000 * p + 300 * side + i, " ".join(t)) for side, t in enumerate(own) for i in range(300)], "doc_id long, text string")
        tried = sorted(((r[1], r[0]) for r in tried.select("doc_id", F.xxhash64("doc_id", "text")).collect()), reverse=True)
        pairs.append([next(i for _, i in tried if (i - 1_000_000) % 1000 // 300 == side) for side in range(2)])  # of large key
        texts |= dict(zip(pairs[-1], own))
        for i in range(len(passage) - 4):  # every phrase of five words in a document of its own
            texts[10_000 + 100 * p + i] = words(50_000 + 100 * p + i, 30) + passage[i : i + 5] + words(60_000 + 100 * p + i, 30)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    keys = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64("doc_id", "text")).collect()}
    found = repeated_passages(docs)
    flagged = {i: set() for i in texts}
    for r in found.collect():
        flagged[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
    shared = brute_shared(texts, 50)
    for pair in pairs:
        a, b = sorted(pair, key=keys.get)
        assert shared[a] and shared[b] <= flagged[b]
    cut = {r["doc_id"]: r["text"].split() for r in without_passages(docs, found).collect()}
    assert not any(brute_shared(cut, 50).values())
