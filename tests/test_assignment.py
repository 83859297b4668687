import random
from datetime import timedelta

import pytest

from aidmatch.operators.assignment import assign
from aidmatch.operators.parts import connected_parts
from tests.rows import collected, frame, greedy, need, offer

# Every group is called large: its parts are settled in one step, or, where they may hold
# next to nothing, in many short rounds.
PARTS = {"max_rows": 0}
ROUNDS = {"max_rows": 0, "max_part": 20, "block_requests": 3}


def solve(spark, rows, **bounds):
    return collected(assign(frame(spark, rows), **bounds))


def apart(cases):
    """Each case in windows of its own, to solve them in one go."""
    rows = []
    for k, case in enumerate(cases):
        shift = timedelta(minutes=10 * k)
        rows += [r | {"w": r["w"] + shift, "ts": r["ts"] + shift} for r in case]
    return rows


CASES = {
    "urgency first": [need("a", urgency=1), need("b", urgency=5, at=1), offer("v")],
    "radius is inclusive": [need("a"), offer("v", radius=0)],
    "the volunteer's radius counts": [need("a"), offer("v", lat=39.49, radius=5)],
    "next takes what is left": [
        need("a", urgency=5), need("b", urgency=4), offer("v", lat=39.41), offer("u", lat=39.42),
    ],
    "exact repeat": [need("a"), need("a"), offer("v"), offer("v")],
    "two payloads of one id match twice": [
        need("a", attempts=1), need("a", attempts=2, at=1), offer("v"), offer("u"),
    ],
    "copy after the match vanishes": [need("a", urgency=5), need("a", urgency=2, attempts=1), offer("v")],
    "copy before the match stays": [
        need("a", lat=41.0, urgency=5), need("a", urgency=2, attempts=1), offer("v", radius=1),
    ],
    "volunteer copy of a match vanishes": [need("a"), offer("v"), offer("v", lat=41.0, attempts=1)],
    "only requests": [need("a"), need("b")],
    "only offers": [offer("v"), offer("u")],
    "no radius": [need("a"), offer("v", radius=None)],
    "no urgency goes last": [need("a", urgency=None), need("b", urgency=1, at=5), offer("v")],
    "groups do not mix": [
        need("a"), offer("v", cat="Transporte"), need("b", w=1), offer("u", w=2), need("c", w=2),
    ],
    "across the 180th meridian": [need("a", lat=-17.0, lon=179.99), offer("v", lat=-17.0, lon=-179.99, radius=5)],
    "over the pole": [need("a", lat=89.99, lon=0.0), offer("v", lat=89.99, lon=180.0, radius=5)],
    "whole Earth": [need("a", lat=40.0, lon=0.0), offer("v", lat=-40.0, lon=180.0, radius=20100)],
}


@pytest.mark.parametrize("rows", CASES.values(), ids=CASES.keys())
def test_case(spark, rows):
    assert solve(spark, rows) == greedy(rows)


@pytest.mark.parametrize("bounds", [PARTS, {"max_rows": 0, "max_part": 1}], ids=["parts", "rounds"])
def test_cases_as_large_groups(spark, bounds):
    rows = apart(CASES.values())
    assert solve(spark, rows, **bounds) == greedy(rows)


def crowd(rng, helps, offers, span, groups=2):
    def spot():
        return dict(lat=39.3 + rng.randrange(span) / 1e4, lon=-0.5 + rng.randrange(span) / 1e4)

    cats = ["Limpieza", "Transporte"][:groups]
    rows = [need(f"h{i}", urgency=rng.randint(1, 5), at=i % 50, cat=rng.choice(cats), **spot()) for i in range(helps)]
    rows += [offer(f"v{i}", radius=rng.choice([1, 5, 20]), at=i % 50, cat=rng.choice(cats), **spot()) for i in range(offers)]
    return rows


def crowds():
    sizes = [(1, 60, 60, 2000), (2, 90, 30, 500), (3, 30, 90, 3000), (4, 50, 50, 1)]
    return apart(crowd(random.Random(seed), helps, offers, span) for seed, helps, offers, span in sizes)


def test_random_groups(spark):
    rows = crowds()
    assert solve(spark, rows) == greedy(rows)


@pytest.mark.parametrize("bounds", [PARTS, ROUNDS], ids=["parts", "rounds"])
def test_random_groups_as_large_groups(spark, bounds):
    rows = crowds()
    assert solve(spark, rows, **bounds) == greedy(rows)


def test_parts_do_not_interact(spark):
    """Two towns far apart and one between them whose volunteers reach both."""
    rng = random.Random(9)
    rows = crowd(rng, 40, 40, 800, groups=1)
    far = [r | {"lat": r["lat"] + 3.0, "id": "f" + r["id"]} for r in crowd(rng, 40, 40, 800, groups=1)]
    assert solve(spark, rows + far, **PARTS) == greedy(rows + far)
    between = [offer(f"m{i}", lat=40.8, lon=-0.5, radius=250, at=i, cat="Limpieza") for i in range(10)]
    assert solve(spark, rows + far + between, **ROUNDS) == greedy(rows + far + between)


def test_connected_parts(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(30)] + [(900, 900)]
    first = {x: x for link in links for x in link}
    for _ in first:
        for a, b in links:
            first[a] = first[b] = min(first[a], first[b])
    found = connected_parts(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r.node: r.part for r in found.collect()} == first


def test_large_and_bounded_groups_together(spark):
    rng = random.Random(7)
    rows = crowd(rng, 80, 80, 1500, groups=1) + [need("x", cat="Transporte"), offer("y", cat="Transporte")]
    assert solve(spark, rows, max_pairs=100) == greedy(rows)
