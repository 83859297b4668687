"""Counts of covering circles without their pairs."""

import numpy as np
import pytest

from aidmatch.operators import coverage, proximity
from tests.rows import frame
from tests.test_proximity import by_hand, crowd


def spots(rng, n, grid=None):
    lat, lon = 39.25 + rng.random(n) * 0.2, -0.55 + rng.random(n) * 0.2
    if grid:
        lat, lon = np.round(lat * grid) / grid, np.round(lon * grid) / grid
    return np.stack([np.radians(lat), np.radians(lon), np.cos(np.radians(lat))])


@pytest.mark.parametrize("grid", [None, 100, 1])
def test_counts_equal_all_pairs(grid, monkeypatch):
    monkeypatch.setattr(coverage, "LEAF_POINTS", 4)
    monkeypatch.setattr(coverage, "LEAF_PAIRS", 8)
    rng = np.random.default_rng(5)
    points, centres = spots(rng, 400, grid), spots(rng, 300, grid)
    circles = np.vstack([centres, rng.choice([0.0, 1.0, 5.0, 12.0, 25000.0], 300, p=[0.2, 0.3, 0.3, 0.15, 0.05])])
    far = coverage._distances(*(x[:, None] for x in points), *circles[:3])
    fit = far <= circles[3]
    total, nearest, farthest, *_ = coverage.count_cover(points, circles)
    assert (total == fit.sum(axis=1)).all()
    assert np.allclose(nearest, np.where(fit, far, np.inf).min(axis=1), rtol=0, atol=1e-8)
    assert np.allclose(farthest, np.where(fit, far, -np.inf).max(axis=1), rtol=0, atol=1e-8)


def test_whole_neighbourhoods_are_counted_once(monkeypatch):
    """A hundred million pairs take a few comparisons; a join of all pairs would make each of them."""
    seen, whole = [], coverage._distances
    monkeypatch.setattr(coverage, "_distances", lambda *a: seen.append(np.size(a[0])) or whole(*a))
    rng = np.random.default_rng(6)
    points, centres = spots(rng, 10_000), spots(rng, 10_000)
    total, *_ = coverage.count_cover(points, np.vstack([centres, np.full(10_000, 40.0)]))
    assert (total == 10_000).all() and sum(seen) < 1_000_000


def test_crowded_cubes_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(coverage, "BLOCK_POINTS", 7)
    monkeypatch.setattr(coverage, "BLOCK_CIRCLES", 9)
    rows = crowd(1, 60, 80, 2000)
    got = {
        r.help_id: (r.eligible, round(r.nearest, 6), round(r.farthest, 6))
        for r in proximity.reachable(frame(spark, rows), max_rows=0).collect()
    }
    assert got == by_hand(rows)[1]
