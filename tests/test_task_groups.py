"""Groups too large for one row that one task solves."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from aidmatch.operators import crowds
from aidmatch.operators.assignment import assign
from tests.rows import collected, frame, greedy, need, offer
from tests.test_assignment import CASES, apart, crowds as random_crowds

#: Every group is solved in a task of its own.
TASKS = {"max_rows": 0, "max_task_rows": 1 << 17}


@pytest.mark.parametrize("rows", [apart(CASES.values()), random_crowds()], ids=["cases", "random"])
def test_task_groups_equal_greedy(spark, rows):
    assert collected(assign(frame(spark, rows), **TASKS)) == greedy(rows)


def test_groups_beyond_a_task(spark):
    rows = random_crowds()
    assert collected(assign(frame(spark, rows), max_rows=0, max_task_rows=100, max_part=20, block_requests=3)) == greedy(rows)


def test_small_cells(spark, monkeypatch):
    """Searches over many cells, some of them empty after a while."""
    rows = random_crowds()
    import pandas as pd
    import numpy as np

    rng = np.random.default_rng(3)
    spots = lambda n: pd.DataFrame({"rlat": np.radians(39 + rng.integers(0, 40, n) / 100), "rlon": np.radians(rng.integers(0, 40, n) / 100)})
    asked, seats = spots(300).assign(sure=np.inf), spots(200).assign(radius=rng.choice([0.0, 5.0, 20.0], 200))
    for side in (asked, seats):
        side["clat"] = np.cos(side["rlat"])
    whole = crowds.choose(asked, seats)
    monkeypatch.setattr(crowds, "CELL_SEATS", 1)
    assert (crowds.choose(asked, seats) == whole).all()


def test_a_crowded_group_shuffles_whole_records_once(spark):
    """By default such a group leaves one exchange of records in the plan."""
    rows = [need(f"h{i}", at=i % 60) for i in range(1100)] + [offer(f"v{i}", radius=5, at=i % 60) for i in range(1000)]
    outcomes = assign(frame(spark, rows))
    plan = outcomes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    kinds = outcomes.groupBy(F.col("distance").isNotNull().alias("matched")).count().collect()
    assert {r.matched: r["count"] for r in kinds} == {True: 1000, False: 100}


def test_records_without_place_or_group_stay(spark):
    nowhere = {"lat": None, "lon": None}
    rows = [need("a") | nowhere, need("b", cat=None), offer("v"), offer("u", cat=None), offer("t") | nowhere, offer("s", radius=None)]
    got = assign(frame(spark, rows), **TASKS).collect()
    assert sorted((r.help or r.volunteer).id for r in got) == ["a", "b", "s", "t", "u", "v"]
    assert all(r.distance is None for r in got)


def test_groups_with_many_pairs_a_record_keep_no_lists_of_pairs(spark):
    """What a task sorts is its records, once; lists of pairs and tables of whole records would grow faster or spill."""
    rows = [need(f"h{i}", at=i % 60) for i in range(200)] + [offer(f"v{i}", radius=5, at=i % 60) for i in range(190)]
    plan = assign(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort ") == 1
    assert not any(step in plan for step in ("Aggregate", "Window", "Join"))


def test_repeats_in_a_task(spark):
    """The earliest arrival of a record stays, one without a time only where there is no other."""
    later = timedelta(seconds=30)
    rows = [need("a", at=40), need("a", at=10), need("b", at=20), offer("v", at=5), offer("v", at=1), offer("u", at=3, lat=0.0)]
    rows += [rows[-1] | {"lat": -0.0}, need("c") | {"ts": None}, need("c", at=50), rows[0] | {"is_help": False, "radio_disponible_km": None}]
    rows += [need("d", at=2, w=10), need("d", at=1, w=10) | {"ts": None}, offer("x", at=9, w=10), offer("x", at=8, w=10)]
    rows += [r | {"ts": r["ts"] + later} for r in rows if r["ts"]]

    def found(**bounds):
        out = assign(frame(spark, rows), **bounds).select(
            "w", "help.id", "help.ts", "help.lat", "volunteer.id", "volunteer.ts", "volunteer.lat", F.round("distance", 6)
        )
        return sorted(out.collect(), key=str)

    assert found(**TASKS) == found() and str(found(**TASKS)).count("id='") == 8
