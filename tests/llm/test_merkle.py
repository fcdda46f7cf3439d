"""Merkle trees and proofs against a plain recursion."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from catalog_star.llm import merkle
from catalog_star.llm.queries import SQL, op11_merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(row):
    """The root of a row of digests and, for each, its (left, right) siblings by level."""
    ways = [[] for _ in row]
    spans = [[i] for i in range(len(row))]
    while len(row) > 1:
        for i in range(len(row)):
            first = i // 3 * 3
            for leaf in spans[i]:
                ways[leaf].append(("".join(row[first:i]), "".join(row[i + 1 : first + 3])))
        spans = [[x for s in spans[i : i + 3] for x in s] for i in range(0, len(row), 3)]
        row = [sha("".join(row[i : i + 3])) for i in range(0, len(row), 3)]
    return row[0], ways


def plain(rows):
    """(doc_id, leaf, subroot, root, siblings) of each (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0], sha("".join(encoded(r[k]) for k in (0, 3, 2, 4, 1)))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for g in order}
    climbed = {g: climb([d for _, d in trees[g]]) for g in order}
    root, above = climb([climbed[g][0] for g in order])
    return [(i, d, climbed[g][0], root, climbed[g][1][k] + above[n]) for n, g in enumerate(order) for k, (i, d) in enumerate(trees[g])]


def proofs(spark, rows):
    found = merkle.prove(spark.createDataFrame(rows, SCHEMA).repartition(5))
    hexed = [merkle.written(F.col(c)) for c in ("leaf", "subroot", "root")]
    sides = F.transform("siblings", lambda s: F.struct(merkle.written(s["left"]), merkle.written(s["right"])))
    rows = found.select("doc_id", *hexed, sides, merkle.written(merkle.folded(F.col("claimed"), F.col("siblings")))).collect()
    assert all(r[5] == r[3] for r in rows)
    return sorted(((r[0], r[1], r[2], r[3], [tuple(s) for s in r[4]]) for r in rows), key=str)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2}, {"a": 1, "b": 1, None: 3}, {None: 4, "a": 28, "é": 9, "z": 10, "b": 730, "": 1}, {f"s{i}": i % 4 + 1 for i in range(30)}])
def test_proofs_equal_a_plain_recursion(spark, sizes):
    rng = random.Random(1)
    ids = rng.sample(range(-5, 5000), sum(sizes.values()))
    rows = [(ids.pop(), f"text {rng.random()}\nmore 🙂", rng.choice(["en", None]), g, rng.choice([1, None])) for g, n in sizes.items() for _ in range(n)]
    assert proofs(spark, rows) == sorted(plain(rows), key=str)


def test_repeated_rows_and_nulls(spark):
    rows = [(None, None, None, None, None)] * 4 + [(1, "a", "en", "s", 1)] * 30 + [(1, "b", "en", "s", 1), (2, "", None, "", 0)]
    assert proofs(spark, rows) == sorted(plain(rows), key=str)


def test_odd_rows_and_no_rows(odd_rows, no_rows):
    assert merkle.prove(odd_rows).count() == odd_rows.count()
    assert merkle.prove(no_rows).collect() == []


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("merkle")
    rows = [(i, ["one\ntwo", "one two", None, "\n"][i % 4], "en", ["a", "b", None][i % 3 % 2], i) for i in range(90)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_tampered_texts_fail_and_sql_agrees(spark, folder):
    found = op11_merkle(spark, folder).toPandas().sort_values("doc_id", ignore_index=True)
    theirs = duckdb.connect().sql(SQL["op11_merkle"].replace("FROM documents", f"FROM '{folder}/documents.parquet/*.parquet'")).df()
    theirs = theirs.sort_values("doc_id", ignore_index=True)[list(found.columns)]
    assert (found == theirs).all().all()
    import zlib

    expected = [zlib.crc32(str(i).encode()) % 2 == 1 or i % 4 in (1, 2) for i in range(90)]
    assert found["verified"].tolist() == expected and not all(expected)


def test_few_pointed_nodes_or_many(spark, monkeypatch):
    rows = [(i, f"t{i}", "en", f"s{i % 5}", i) for i in range(400)]
    expected = sorted(plain(rows), key=str)
    monkeypatch.setattr(merkle, "MOST_BROADCAST", 0)
    assert proofs(spark, rows) == expected
