"""Token counts and packing against brute force."""

import math
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from catalog_star.llm import packing
from catalog_star.llm.packing import best_fit, crossover, evolve, genetic_packing, mutate, pack_documents
from catalog_star.llm.tokencounts import WORD_BEGIN, Pieces, PretokenTrie, token_counts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = {"a": -1.0, "b": -2.0, "ab": -2.5, "abc": -2.6, "c": -1.5, "bc": -2.2, WORD_BEGIN: -0.5, WORD_BEGIN + "a": -1.2}


def brute_count(word: str, scores: dict[str, float], byte: float) -> int:
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
    known = {p for p in scores if len(p) == 1}
    for end in range(1, len(word) + 1):
        options = [(best[i][0] + scores[word[i:end]], -best[i][1] - 1) for i in range(end) if word[i:end] in scores]
        if word[end - 1] not in known:
            n = len(word[end - 1].encode())
            options.append((best[end - 1][0] + n * byte, -best[end - 1][1] - n))
        top = max(options)
        best[end] = top[0], -top[1]
    return best[-1][1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcé"), max_size=9), max_size=20), st.integers(1, 30), st.integers(1, 12))
def test_trie_counts_equal_forward_scores(words, most_nodes, most_depth):
    trie = PretokenTrie(Pieces(PIECES, -7.0), most_nodes, most_depth)
    for word in words:
        assert trie.insert(WORD_BEGIN + word) == brute_count(WORD_BEGIN + word, PIECES, -7.0)


def test_shared_prefixes_are_scored_once():
    trie = PretokenTrie(Pieces(PIECES, -7.0), 1000)
    for word in ("abcab", "abcac", "abc"):
        trie.insert(word)
    assert trie.size == 6
    assert trie.root.child["a"].child["b"].child["c"].terminal == 1


def test_a_very_long_word_takes_bounded_memory():
    import tracemalloc

    trie, word = PretokenTrie(Pieces(PIECES, -7.0), 1000), WORD_BEGIN + "abcé" * 50_000
    tracemalloc.start()
    n = trie.insert(word)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert n == 1 + 150_000 and trie.size == 64  # of each four characters one piece and two bytes
    assert peak < 200_000


def test_token_counts_of_odd_rows(spark, odd_rows, no_rows):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    found = token_counts(odd_rows, path).collect()
    assert len(found) == odd_rows.count()
    assert [r["n_tokens"] for r in found if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert {r["doc_id"]: r["n_pretokens"] for r in found}[6] == 2 and model.get_piece_size() == 32000
    a, b = (sorted(map(tuple, token_counts(odd_rows, path, most_nodes=n, most_words=m).collect()), key=str) for n, m in ((5, 3), (10**6, 10**6)))
    assert a == b
    assert token_counts(no_rows, path).collect() == []


def test_pieces_hold_the_tokens_of_whole_texts(spark, odd_rows, no_rows):
    found = [r.asDict() for r in pack_documents(odd_rows, TOKENIZER, capacity=512, with_ids=True).collect()]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    wanted = []
    for r in odd_rows.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for piece in range(-(-len(ids) // 512)):
            part = ids[512 * piece : 512 * piece + 512]
            wanted.append((r["doc_id"], piece, 512 * piece, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda t: (str(t[0]), *t[1:])
    assert sorted(wanted, key=key) == sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found), key=key)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in found)
    check_sequences(found, 512)
    assert pack_documents(no_rows, TOKENIZER).collect() == []


def check_sequences(rows: list[dict], capacity: int) -> int:
    sequences: dict = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        end = sequences.get(r["sequence_id"], 0)
        assert r["offset"] == end and end + r["length"] <= capacity
        sequences[r["sequence_id"]] = end + r["length"]
    return len(sequences)


def test_genetic_packing_reaches_the_least_number_of_sequences(spark):
    rng = np.random.Generator(np.random.PCG64(8))
    length = rng.integers(1, 300, 3000).tolist()
    items = spark.createDataFrame(list(enumerate(length)), "uid long, length long")
    placed = {r["uid"]: r.asDict() for r in genetic_packing(items, 512, problem_size=500).collect()}
    assert len(placed) == 3000
    used = check_sequences([{**placed[i], "length": n} for i, n in enumerate(length)], 512)
    assert used <= -(-sum(length) // 512) + 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=2, max_size=40), st.integers(0, 1000))
def test_operators_keep_every_piece_once(length, seed):
    rng = np.random.Generator(np.random.PCG64(seed))
    a = best_fit(list(range(len(length))), length, 50)
    b = best_fit(rng.permutation(len(length)).tolist(), length, 50)
    for bins in (a, b, crossover(a, b, length, 50, rng), mutate(a, length, 50, rng), evolve(length, 50, [a, b], seed, 4, 3)):
        assert sorted(i for x in bins for i in x) == list(range(len(length)))
        assert all(sum(length[i] for i in x) <= 50 for x in bins)
    assert len(evolve(length, 50, [a], seed, 4, 3)) <= len(a)


def test_islands_improve_on_best_fit_decreasing(spark):
    rng = np.random.Generator(np.random.PCG64(5))
    capacity, problems = 60, []
    for _ in range(40):  # bins that three pieces fill
        cuts = [np.sort(rng.choice(np.arange(1, capacity), 2, replace=False)) for _ in range(12)]
        problems.append([int(x) for a, b in cuts for x in (a, b - a, capacity - b)])
    first = [len(best_fit(sorted(range(36), key=lambda i: (-p[i], i)), p, capacity)) for p in problems]
    hard = [p for p, n in zip(problems, first) if n > 12]
    assert len(hard) > 5
    better = 0
    for p in hard:
        items = [(i, n) for i, n in enumerate(p)]
        state = spark.createDataFrame([(0, k, [(n, i) for i, n in items], None, None) for k in range(3)], "problem long, island int, items array<struct<length: bigint, uid: bigint>>, elite array<int>, guest array<int>")
        found = packing._evolved(state, capacity, 8, 30, 0).agg({"bins": "min"}).first()[0]
        assert found <= 13
        better += found < len(best_fit(sorted(range(36), key=lambda i: (-p[i], i)), p, capacity))
        if better:
            break
    assert better


def test_only_open_problems_are_evolved(spark, monkeypatch):
    seen = []
    whole = packing._evolved
    monkeypatch.setattr(packing, "_evolved", lambda islands, *rest: (seen.append(islands.select("problem").distinct().count()), whole(islands, *rest))[1])
    easy = spark.range(4000).select(F.col("id").alias("uid"), F.lit(64).cast("long").alias("length"))
    assert genetic_packing(easy, 512, problem_size=500).count() == 4000 and seen == []
