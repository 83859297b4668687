"""The windows of a category solved one after the other."""

import random

from pyspark.sql import functions as F

from aidmatch.plans import replay as plan
from tests.rows import frame, need, offer
from tests.test_operators import test_replay_equals_going_window_by_window as window_by_window


def _rows():
    """Copies of an id, exact repeats, records with both fields, first attempts that are not the first, a window without any."""
    rng = random.Random(8)
    spot = lambda: {"lat": 39.3 + rng.random() / 4, "cat": rng.choice(["Limpieza", "Transporte"])}
    windows = [0, 1, 3]
    rows = [need(f"h{rng.randrange(40)}", urgency=rng.choice([0, 2, 5, None]), at=i, w=rng.choice(windows), attempts=rng.choice([None, None, 3]), **spot()) for i in range(60)]
    rows += [offer(f"v{rng.randrange(40)}", radius=rng.choice([0, 2, 6]), at=i, w=rng.choice(windows), attempts=rng.choice([None, 1, 2]), **spot()) for i in range(50)]
    both = [need(f"b{i}", urgency=3, w=i % 3, **spot()) | {"radio_disponible_km": 4} for i in range(8)]
    return rows + rows[:15] + both + [r | {"is_help": False} for r in both]


def _found(done):
    out = done.outcomes.select("w", "help", "volunteer", F.round("distance", 6))
    dead = [df.drop("insertion_stamp") for df in (done.requests, done.volunteers)]
    return [sorted(map(str, df.collect())) for df in (out, done.retries, *dead)]


def test_chains_equal_windows_solved_side_by_side(spark):
    rows = frame(spark, _rows())
    last = rows.agg(F.max(plan.micros("w"))).first()[0]
    chained, side_by_side = (_found(plan.replay(rows, "1 minute", 4, until=last, **bounds).saved()) for bounds in ({}, {"max_rows": 8192}))
    assert chained == side_by_side and all(chained)


def test_every_window_is_solved_once(spark, monkeypatch):
    """No turn solves windows again, however far a change runs."""

    def never(*_, **__):
        raise AssertionError("windows are solved under a guess")

    monkeypatch.setattr(plan, "attempt", never)
    window_by_window(spark)
    done = plan.replay(frame(spark, _rows()), "1 minute")
    assert done.outcomes._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_records_without_a_category_are_tried_as_often_as_others(spark):
    rows = [need("a", cat=None), offer("v", cat=None, w=1), need("b")]
    done = plan.replay(frame(spark, rows), "1 minute")
    assert sorted((r["id"], r["attempts"]) for r in [*done.requests.collect(), *done.volunteers.collect()]) == [("a", 5), ("b", 5), ("v", 5)]
