"""Chains with a greatest gap in force, against brute force."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from catalog_star.llm.substrings import chain


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 90), st.integers(0, 90)), min_size=2, max_size=24, unique=True))
def test_best_chain_within_reach_equals_brute_force(pairs):
    pairs = sorted(pairs)
    k, cost, gap = 5, 0.1, 12
    score = []
    for i, (x, y) in enumerate(pairs):
        steps = [score[j] - cost * (x - a + y - b) for j, (a, b) in enumerate(pairs[:i]) if a < x and b < y and x - a <= gap and y - b <= gap]
        score.append(k + max([0, *steps]))
    x, y = (np.array([p[i] for p in pairs]) for i in (0, 1))
    chains = chain(x, y, k, cost, gap)
    assert sorted(i for c in chains for i in c) == list(range(len(pairs)))
    for c in chains:
        assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all()
        assert max(np.diff(x[c]).max(initial=0), np.diff(y[c]).max(initial=0)) <= gap
    value = max(k * len(c) - cost * (np.diff(x[c]).sum() + np.diff(y[c]).sum()) for c in chains)
    assert value >= max(score) - 1e-9


def test_a_long_run_does_not_hide_near_matches():
    run, after = np.arange(0, 480, 8), np.array([600, 608, 616, 640])
    x, y = np.concatenate([run, [540], after]), np.concatenate([run, [5], after])  # one match out of order
    found = [x[c].tolist() for c in chain(x, y, 5, 0.1, 48)]
    assert after.tolist() in found and run.tolist() in found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 60)), min_size=1, max_size=12), st.integers(0, 1))
def test_an_unrelated_match_changes_no_chain(steps, side):
    """Rising matches with and without one far away, which makes the tree do the work."""
    x, y = (np.cumsum([s[i] for s in steps]) for i in (0, 1))
    alone = {tuple(x[c].tolist()) for c in chain(x, y, 5, 0.1, 48)}
    far = (10_000, 0) if side else (10_000, 20_000)
    if side:
        y = y + 5000
    more = {tuple(np.append(x, far[0])[c].tolist()) for c in chain(np.append(x, far[0]), np.append(y, far[1]), 5, 0.1, 48)}
    assert more == alone | {(10_000,)}
