"""Mixing: exact targets, caps, permutations, shards; against the SQL form and by hand."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from catalog_star.llm import mixing
from tests.llm.conftest import prose


def brute_targets(sizes: dict, weights=(5, 2, 1), share=1.5) -> dict:
    """Sources in order, null last; what exceeds twice a source is shared anew until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = [s for s in names if s not in capped]
        target = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: 2.0 * sizes[s] for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return {**capped, **target}
        capped |= over


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, prose(i, (i * 37) % 300 if i % 9 else 2000), f"s{i % 4}" if i % 7 else None) for i in range(120)]
    rows += [(1000 + i, prose(i, 3), "tiny") for i in range(4)] + [(2000, "", "hollow"), (2001, None, "hollow")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_and_limits(docs):
    rows = mixing.taken_words(mixing.mix_sources(docs, block=16, shard_slots=32)).collect()
    assert len(rows) == docs.count()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] >= r["size"]
    wanted = brute_targets(sizes)
    assert target == pytest.approx(wanted)
    assert all(abs(taken[s] - wanted[s]) <= 0.5 for s in sizes)


def test_reruns_agree_whatever_the_partitioning(docs):
    one, other = (sorted(map(tuple, mixing.taken_words(mixing.mix_sources(docs.repartition(n), block=16)).select("id", "taken").collect())) for n in (1, 9))
    assert one == other
    changed = sorted(map(tuple, mixing.taken_words(mixing.mix_sources(docs, block=16, seed="other")).select("id", "taken").collect()))
    assert changed != one and sum(t for _, t in changed) == sum(t for _, t in one)


def test_sql_form_agrees(docs):
    found = mixing.taken_words(mixing.mix_sources(docs, block=16, shard_slots=8)).select("id", "size", "source_size", "target", "taken")
    db = duckdb.connect()
    frame = docs.toPandas()  # noqa: F841
    db.execute("create table d as select * from frame")
    wanted = db.execute(mixing.comparison_sql("d", block=16)).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_permutations_are_permutations(spark):
    for n in (1, 2, 3, 17, 1000):
        index = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("k"), F.lit("1")).alias("x"))
        got = [r["x"] for r in index.collect()]
        assert sorted(got) == list(range(n))
    assert got != list(range(1000))


def test_shards_are_multinomial_and_slots_are_used_once(docs):
    spans = mixing.mix_sources(docs, block=16, shard_slots=32).spans.cache()
    slots = spans.groupBy("source_rank", "slot").agg(F.count_distinct("shard").alias("n"), F.sum("words").alias("w"), F.count_distinct("pass").alias("p"))
    assert slots.agg(F.max("n"), F.max("p"), F.max("w")).first()[:3] == (1, 1, 16)
    sizes = [r["count"] for r in spans.select("shard", "source_rank", "slot").distinct().groupBy("shard").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 4 * sum(sizes) / len(sizes)
    places = spans.groupBy("source_rank", "start", "pass", "from_word").count()
    assert places.agg(F.max("count")).first()[0] == 1


def test_texts_of_the_mixture(docs):
    mixture = mixing.mix_sources(docs, block=16)
    taken = {r["id"]: r["taken"] for r in mixing.taken_words(mixture).collect()}
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {}
    for r in mixing.mixed_texts(docs, mixture).collect():
        words = r["text"].split()
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(words)
        rest = iter(whole[r["doc_id"]].split())
        assert all(w in rest for w in words)
    assert got == {i: n for i, n in taken.items() if n}


def test_odd_rows(odd_rows, no_rows):
    mixture = mixing.mix_sources(odd_rows)
    rows = mixing.taken_words(mixture).collect()
    assert len(rows) == odd_rows.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mixed_texts(odd_rows, mixture).count() > 0
    empty = mixing.mix_sources(no_rows)
    assert mixing.taken_words(empty).collect() == [] and mixing.mixed_texts(no_rows, empty).collect() == []
    assert {r["taken"] for r in mixing.taken_words(mixing.mix_sources(odd_rows.where("doc_id < 4"))).collect()} == {0}


def test_slots_meet_documents_by_a_shuffle(docs):
    """Plans of slots look small, as their sources are few: they must not be broadcast for it."""
    joins = re.findall(r"(\w+Join) \[source_rank#\d+, block#\d+L?\]", mixing.mix_sources(docs).spans._jdf.queryExecution().executedPlan().toString())
    assert joins == ["SortMergeJoin"]
