"""Language and toxicity: held-out accuracy, determinism, odd rows."""

import zlib

import numpy as np
import pytest

from catalog_star.llm import language, toxicity
from catalog_star.llm.queries import QUERIES
from catalog_star.llm.texts import Texts

DATA = "/root/testdata/sf0.01"


def test_language_of_held_out_texts(spark):
    found = {r["doc_id"]: r for r in QUERIES["op4_byte_cnn"](spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(found) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    held = [d for d in docs if found[d["doc_id"]]["held_out"] and d["n_chars"] > 60]
    assert np.mean([found[d["doc_id"]]["lang_pred"] == d["lang"] for d in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_windows_cover_every_byte():
    texts = Texts.of(["", "abc", "x" * 128, "y" * 300, "é" * 65])
    windows, held, first = language.cut_windows(texts, 128)
    assert held.tolist() == [3, 128, 128, 128, 44, 128, 2] and first.tolist() == [0, 0, 1, 2, 5, 7]
    assert b"".join(w[:n].tobytes() for w, n in zip(windows[2:5], held[2:5])) == b"y" * 300


def test_gradients_are_right():
    network = language.ByteNetwork.start(["a", "b", "c"], 12, 3, 4, (2, 3), 1)
    for p in network.parameters():
        p += 0.05
    network.vectors[0] = 0
    network.vectors, network.filters, network.biases = network.vectors.astype(float), [f.astype(float) for f in network.filters], [b.astype(float) for b in network.biases]
    network.out, network.out_bias = network.out.astype(float), network.out_bias.astype(float)
    rng = np.random.Generator(np.random.PCG64(2))
    windows, target = rng.integers(1, 9, (5, 12)), rng.integers(0, 3, 5)
    loss = lambda: -network.forward(windows)[0][np.arange(5), target].mean()
    for p, g in zip(network.parameters(), network.gradients(windows, target)):
        for at in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(8)]:
            if p is network.vectors and at[0] == 0:
                continue
            kept, step = p[at], 1e-6
            p[at] = kept + step
            high = loss()
            p[at] = kept - step
            low = loss()
            p[at] = kept
            assert g[at] == pytest.approx((high - low) / (2 * step), abs=1e-4)


def test_training_is_repeatable_and_batches_do_not_matter():
    texts = [(f"the house and the river {i}", "en") for i in range(20)] + [(f"das haus und der fluss {i}", "de") for i in range(20)]
    a, b = (language.fit(texts, epochs=3) for _ in range(2))
    assert all((p == q).all() for p, q in zip(a.parameters(), b.parameters()))
    windows, _, _ = language.cut_windows(Texts.of([t for t, _ in texts]), a.window)
    assert np.allclose(a.log_probabilities(windows, 3), a.log_probabilities(windows, 40), atol=1e-5)
    assert np.allclose(a.log_probabilities(windows), a.forward(windows)[0], atol=1e-5)


def test_language_of_odd_rows(spark, odd_rows, no_rows):
    drawn = language.draw_labelled(odd_rows, "doc_id", "text", "lang", 3)
    assert {x for _, x in drawn} == {"en", "de", "fr"} and max(len(t) for t, _ in drawn) <= 2048
    network = language.fit(drawn, epochs=2)
    found = language.identify(odd_rows, network, {"doc_id": "doc_id"}).collect()
    assert len(found) == odd_rows.count()
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in found if r["doc_id"] in (1, 2, 3))
    assert all(r["lang_pred"] in ("en", "de", "fr") and r["score"] > 0 for r in found if r["doc_id"] in (4, 5, 6, 7, 8, 9))
    assert language.draw_labelled(no_rows, "doc_id", "text", "lang", 3) == [] and language.fit([]) is None
    assert {r["lang_pred"] for r in language.identify(odd_rows, None, {"doc_id": "doc_id"}).collect()} == {"und"}
    assert language.identify(no_rows, network, {"doc_id": "doc_id"}).collect() == []


def held_out(spark, folder):
    """Of labelled rows whose labels were not learnt: (language, label, predicted)."""
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    known = docs.join(labels, "doc_id").where("text is not null and toxic is not null").select("doc_id", "lang", "toxic")
    found = QUERIES["op10_toxicity"](spark, folder)
    rows = found.where("held_out").join(known, "doc_id").select("lang", "toxic", "predicted").collect()
    assert found.count() == docs.count()
    return rows


def test_toxicity_of_held_out_texts(spark):
    rows = held_out(spark, "/root/testdata/check_s")
    for lang in ("en", "de", "fr", "es"):
        own = [r for r in rows if r["lang"] == lang]
        assert np.mean([r["predicted"] for r in own if r["toxic"]]) > 0.8
        assert np.mean([r["predicted"] for r in own if not r["toxic"]]) < 0.05
    assert np.mean([r["predicted"] for r in rows if r["toxic"]]) > 0.9


def test_folds_of_toxicity(spark):
    found = QUERIES["op10_toxicity"](spark, DATA).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)


def test_word_windows_cover_the_text():
    text = "one two  three\nfour " * 50 + "x" * 700
    windows = toxicity.word_windows(text, 64)
    assert all(len(w) <= 64 for w in windows)
    joined = windows[0] + b"".join(w[1:] if w[:1] == b" " else w for w in windows[1:])
    assert b"".join(joined.split()) == "".join(text.split()).encode()
    assert toxicity.word_windows("", 64) == [] or toxicity.word_windows("", 64) == [b"  "]


def test_toxicity_of_odd_rows(spark, odd_rows, no_rows):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (7, 0, 0), (9, None, 0), (None, 1, 0), (6, 0, 0)], "doc_id long, toxic int, text int")
    drawn = toxicity.draw_labelled(odd_rows, labels, "doc_id", "text", "toxic", 10, 10)
    assert sorted(k for _, k in drawn) == [0, 0, 1] and max(len(t) for t, _ in drawn) <= 16_384 + 32
    model = toxicity.fit([("you idiot and moron go away now", 1), ("the river flows past green fields", 0)] * 12)
    found = toxicity.score_texts(odd_rows, model, {"doc_id": "doc_id"}).collect()
    assert len(found) == odd_rows.count() and all(0 <= r["score"] <= 1 for r in found)
    untrained = toxicity.fit([("a", 0)])
    assert {r["score"] for r in toxicity.score_texts(odd_rows, untrained, {"doc_id": "doc_id"}).collect()} == {0.0}
    assert toxicity.score_texts(no_rows, model, {"doc_id": "doc_id"}).collect() == []


def test_copies_do_not_mark_runs():
    toxic = ["the moron said nothing useful today at all"] * 30 + [f"{a * 3} moron {b * 3} went" for a in "abcdefgh" for b in "ijklm"]
    ordinary = [f"{a * 3} quiet {b * 3} went" for a in "abcdefgh" for b in "ijklm"]
    marks = toxicity.marking_runs(toxic, ordinary, 10.0, 8)
    assert {b" moro", b"moron", b"oron "} <= {int(x).to_bytes(5, "big") for x in marks}
    assert all({*b"oron"} & {*int(x).to_bytes(5, "big")} for x in marks)
    dictionary = toxicity.toxic_dictionary(toxic, ordinary, 1024, 10.0, 8)
    assert b" moron " in dictionary and b"useful" not in dictionary and b"went" not in dictionary


def test_dictionaries_come_from_the_trainer(monkeypatch):
    made = []
    whole = toxicity.zstandard.train_dictionary
    monkeypatch.setattr(toxicity.zstandard, "train_dictionary", lambda *a, **k: (made.append(len(a[1])), whole(*a, **k))[1])
    rng = np.random.Generator(np.random.PCG64(1))
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    text = lambda extra: " ".join(rng.permutation([*rng.choice(words, 60), *extra]))
    texts = [(text(["vermin"] * 2), 1) for _ in range(60)] + [(text([]), 0) for _ in range(60)]
    model = toxicity.fit(texts)
    assert len(made) == 2 and b"vermin" in model.toxic and b"vermin" not in model.ordinary
    packers = model.packers()
    score = model.score(np.array([model.features(t, packers) for t in (text(["vermin"] * 3), text([]))]))
    assert score[0] > 0.5 > score[1]
