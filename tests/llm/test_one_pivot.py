"""Vectors of one cone, which leave a single pivot, against brute force."""

import numpy as np

from catalog_star.llm.embeddings import near_vectors, spread, units


def test_single_cone_and_lone_pairs_equal_brute_force(spark):
    rng = np.random.Generator(np.random.PCG64(4))
    axis = rng.normal(size=16)
    cone = axis / np.linalg.norm(axis) + rng.normal(size=(300, 16)) * rng.choice([0.01, 0.045], size=(300, 1))
    assert len(spread(units(cone), 0.98)) == 1
    lone = np.array([[1.0, 0.0, 0.0], [0.99, np.sqrt(1 - 0.99**2), 0.0]])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(cone)] + [(1000 + i, v.tolist(), 1) for i, v in enumerate(lone)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r for r in near_vectors(frame).collect()}
    near = units(cone) @ units(cone).T >= 0.98
    assert 300 < near.sum() < 300 * 300
    assert [found[i]["n_links"] for i in range(300)] == (near.sum(1) - 1).tolist()
    label = np.arange(300)
    for _ in range(300):
        label = np.array([label[row].min() for row in near])
    assert [found[i]["component_id"] for i in range(300)] == label.tolist()
    assert [(found[i]["n_links"], found[i]["component_id"]) for i in (1000, 1001)] == [(1, 1000), (1, 1000)]
