"""Components, SimHash and vectors against brute force."""

import re
from itertools import combinations

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from catalog_star.llm import embeddings, simhash
from catalog_star.llm.components import components, roots
from tests.llm.conftest import prose


def brute_roots(n: int, pairs: list[tuple[int, int]]) -> list[int]:
    label = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=20))
def test_roots(pairs):
    a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    assert roots(13, a, b).tolist() == brute_roots(13, pairs)


def test_components_of_long_paths_stars_and_loops(spark):
    path = [(i * 37 % 200, (i + 1) * 37 % 200) for i in range(150)]
    star = [(500, 600 + i) for i in range(50)]
    edges = path + star + [(900, 900)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    label = brute_roots(1000, edges)
    assert found == {n: label[n] for e in path + star for n in e}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def brute_fingerprint(text: str | None) -> int:
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_of_odd_rows(spark, odd_rows, no_rows):
    base = prose(3, 400).split()
    near = [(100 + i, " ".join(base[:i] + ["other"] + base[i + 1 :])) for i in range(0, 40, 4)]
    docs = odd_rows.unionByName(spark.createDataFrame(near, "doc_id long, text string"), allowMissingColumns=True)
    rows = docs.collect()
    found = simhash.simhash_groups(docs).collect()
    prints = [brute_fingerprint(r["text"]) for r in rows]
    assert sorted((str(r["doc_id"]), f"{p:016x}") for r, p in zip(rows, prints)) == sorted((str(r["doc_id"]), r["fingerprint"]) for r in found)
    label = brute_roots(len(rows), [(i, j) for i, j in combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 3])
    least = {}
    for r, k in zip(rows, label):
        if r["doc_id"] is not None:
            least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    wanted = sorted((str(r["doc_id"]), f"{p:016x}", str(least.get(k))) for r, p, k in zip(rows, prints, label))
    assert wanted == sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in found)
    assert simhash.simhash_groups(no_rows).collect() == []


def test_links_are_exact_whatever_the_leaves(spark):
    rng = np.random.Generator(np.random.PCG64(9))
    centres = rng.integers(0, 2**63, 60, dtype=np.uint64)
    values = np.unique(np.concatenate([centres, *[centres ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for _ in range(12)]]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64).tolist()], "value long")
    close = np.bitwise_count(values[:, None] ^ values[None]) <= 3
    a, b = np.nonzero(close)
    wanted = {int(values.view(np.int64)[i]): k for i, k in enumerate(roots(len(values), a, b))}
    for scale, sample in ((1, 50), (1, 4000), (64, 4000)):
        found = simhash.near_links(frame, "value", leaf_scale=scale, sample_size=sample).collect()
        index = {int(v): i for i, v in enumerate(values.view(np.int64).tolist())}
        label = roots(len(values), np.array([index[r["a"]] for r in found]), np.array([index[r["b"]] for r in found]))
        assert {int(values.view(np.int64)[i]): k for i, k in enumerate(label)} == wanted


def test_tree_routes_every_neighbour_to_its_home():
    rng = np.random.Generator(np.random.PCG64(4))
    values = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    tree = simhash.Tree.build(values, 100, 3)
    at, home = tree.route(values, 0)
    assert sorted(at.tolist()) == list(range(3000)) and tree.leaves > 10
    flipped = values ^ np.uint64(0b1011)
    where, leaf = tree.route(flipped, 3)
    assert set(zip(at.tolist(), home.tolist())) <= set(zip(where.tolist(), leaf.tolist()))


def brute_vectors(rows, threshold=0.98):
    n = len(rows)
    sound, unit = [], []
    for _, v, label in rows:
        x = np.array([np.nan if c is None else c for c in v], float) if v else np.zeros(0)
        ok = label is not None and len(x) > 0 and np.isfinite(x).all() and (x != 0).any()
        sound.append(ok)
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    pairs = [(i, j) for i, j in combinations(range(n), 2) if sound[i] and sound[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
    links = np.bincount([k for p in pairs for k in p], minlength=n)
    return links.tolist(), brute_roots(n, pairs)


def test_vectors_against_brute_force(spark):
    rng = np.random.Generator(np.random.PCG64(7))
    rows = []
    for _ in range(25):
        centre = rng.standard_normal(24)
        label = int(rng.integers(0, 3))
        rows += [(centre + rng.standard_normal(24) * rng.uniform(0.02, 0.12), label) for _ in range(rng.integers(1, 12))]
    hot = rng.standard_normal(24)
    rows += [(hot + rng.standard_normal(24) * 0.02, 1) for _ in range(120)] + [(hot, 1)] * 30
    rows = [(i, [float(np.float32(c)) for c in v], label) for i, (v, label) in enumerate(rows)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 24, 1), (n + 3, [1.0, None] + [0.5] * 22, 1), (n + 4, [float("nan")] * 24, 1), (n + 5, [float("inf")] * 24, 1), (n + 6, rows[0][1], None), (n + 7, [1e30] * 24, 2), (n + 8, [1e-30] * 24, 2), (n + 9, [1.0] * 5, 2)]
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, label int, n_links int, node int, copies string")
    links, label = brute_vectors(rows)
    for index in ({}, {"block": 16}):
        found = {r["vec_id"]: r for r in embeddings.near_vectors(frame, **index).collect()}
        assert len(found) == len(rows)
        got = sum(found[i]["n_links"] for i in range(len(rows)))
        assert got >= 0.98 * sum(links) and all(found[i]["n_links"] <= links[i] for i in range(len(rows)))
        assert np.mean([found[i]["component_id"] == label[i] for i in range(len(rows))]) > 0.98
        assert all(found[i]["kept"] == (found[i]["component_id"] == i) for i in range(len(rows)))
        assert all((found[i]["n_links"], found[i]["component_id"]) == (0, i) for i in range(n, n + 7))
        assert found[n + 7]["n_links"] == 1 and found[n + 8]["component_id"] == n + 7


def test_repeated_and_nameless_vectors(spark):
    rows = [(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (None, [2.0, -1.0], 1), (5, [1.0, 2.0], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in embeddings.near_vectors(frame).collect())
    assert found == [("1", 2, "1", True), ("1", 2, "1", True), ("5", 0, "5", True), ("None", 0, "None", True), ("None", 2, "1", False)]
    assert embeddings.near_vectors(frame.where("false")).collect() == []


def test_one_row_of_each_group_stays(odd_rows, no_rows):
    base = prose(3, 400).split()
    near = odd_rows.sparkSession.createDataFrame([(100 + i, " ".join(base) + " " * i, "z") for i in range(4)], "doc_id long, text string, score string")
    docs = odd_rows.unionByName(near, allowMissingColumns=True)
    kept = simhash.first_of_groups(docs)
    assert kept.columns == docs.columns
    rows = docs.collect()
    prints = [brute_fingerprint(r["text"]) for r in rows]
    label = brute_roots(len(rows), [(i, j) for i, j in combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 3])
    groups = {}
    for r, k in zip(rows, label):
        groups.setdefault(k, []).append(r)
    wanted = sorted(min((r["doc_id"] is None, r["doc_id"] or 0) for r in own) for own in groups.values())
    found = kept.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found) == wanted
    assert all(r in rows for r in found) and simhash.first_of_groups(no_rows).collect() == []
