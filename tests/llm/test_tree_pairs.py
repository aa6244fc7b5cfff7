"""op5, F1: all points of a cell go down the tree together."""

import numpy as np
import pytest

from ordwave.llm import jaccard


@pytest.mark.parametrize("at_a_time", [1, 1 << 20])
@pytest.mark.parametrize("m", [1, 2, 16, 17, 45, 300])
def test_pairs_are_those_of_all_bounds(monkeypatch, m, at_a_time):
    monkeypatch.setattr(jaccard, "BOUNDS", at_a_time)
    r = np.random.default_rng(m)
    base = r.integers(0, 4, (1 + m // 5, 32))
    points = np.clip(base[r.integers(0, len(base), m)] + (r.random((m, 32)) < 0.1), 0, 15).astype(np.int32)
    points = points[np.argsort(points.sum(1), kind="stable")]
    n, comp = points.sum(1).astype(np.int64), r.integers(-3, 1 + m // 4, m).astype(np.int64)
    t = jaccard.Threshold(75)
    want = [(i, j) for i in range(m) for j in range(i + 1, m)
            if comp[i] != comp[j] and t.links(int(np.minimum(points[i], points[j]).sum()), n[i], n[j])]
    assert list(map(tuple, jaccard.tree_pairs(points, n, comp, t).T.tolist())) == want and (m < 16 or want)


def test_nodes_of_one_component_are_not_bounded(monkeypatch):
    """A cell of 1,024 members of one component and two others compares these two only."""
    compared = []
    monkeypatch.setattr(jaccard, "BOUNDS", 8)
    links = jaccard.Threshold.links
    monkeypatch.setattr(jaccard.Threshold, "links", lambda self, o, a, b: compared.append(np.size(o)) or links(self, o, a, b))
    points = np.full((1026, 8), 5, np.int32)
    comp = np.zeros(1026, np.int64)
    comp[[100, 900]] = 1, 2
    got = jaccard.tree_pairs(points, points.sum(1).astype(np.int64), comp, jaccard.Threshold(75))
    assert got.shape[1] == 2 * 1024 + 1 and sum(compared) < 60_000          # of 525,825 pairs
