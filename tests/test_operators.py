"""Hand-made rows for parsing, validation, routing, places and the retry loop."""

import random

import pytest
from pyspark.sql import functions as F

from aidmatch.functions.geo import parse_coordinates
from aidmatch.operators import leftovers as L
from aidmatch.operators import validation as V
from aidmatch.operators import places as places_module
from aidmatch.operators.places import GENERATOR_DEFAULT, GENERATOR_PRECEDENCE, with_place_name
from aidmatch.operators.proximity import nearest_volunteer, reachable
from aidmatch.plans.replay import replay
from aidmatch.sources.messages import encode, parse, quarantine, sound
from tests.rows import frame, greedy, km, need, offer


def test_coordinates(spark):
    texts = ["39.4", "39.4,-0.4,5", "a,b", "1d,2", "nan,1", "39.4,", " 39.4 , -0.4 ", "39,-.5", "1e1,2\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_coordinates(F.col("t")).alias("at"))
    got = [tuple(r["at"]) if r["at"] else None for r in df.collect()]
    assert got == [None] * 6 + [(39.4, -0.4), (39.0, -0.5), (10.0, 2.0)]


def test_messages(spark):
    good = '{\n  "id": "a",\n  "nombre": "Íñigo",\n  "categoria": "Limpieza",\n  "ubicacion": "39.4,-0.4",\n  "nivel_urgencia": 3\n}'
    rows = [
        good,
        '{"id": "b", "ubicacion": "39.4,-0.4", "nivel_urgencia": 3}',
        '{"id": "c", "categoria": "Limpieza", "ubicacion": "39.4,-0.4", "nivel_urgencia": "5"}',
        '{"id": "d", "categoria": "Limpieza", "ubicacion": "39.4", "nivel_urgencia": 5}',
        '{"id": "e", "categoria": "Limpieza", "ubicacion": "1,1", "nivel_urgencia": 5, "radio_disponible_km": 5}',
        '{"id": "f", "categoria": "Limpieza", "ubicacion": "1,1", "urgencia": 4}',
        "not json",
    ]
    raw = spark.createDataFrame([(bytearray(t.encode()),) for t in rows], "value binary").withColumn("ts", F.current_timestamp())
    parsed = parse(raw)
    assert sorted((r["id"], r["nombre"], r["is_help"]) for r in sound(parsed).collect()) == [
        ("a", "Íñigo", True), ("e", None, False), ("e", None, True),
    ]
    assert sorted(r["fault"] for r in quarantine(parsed).collect()) == sorted(
        ["no categoria", "neither request nor offer", "bad ubicacion", "neither request nor offer", "no id"]
    )
    assert sound(parse(raw, urgencia_alias=True)).filter("id = 'f'").first()["nivel_urgencia"] == 4


def test_encode_keeps_nulls_and_letters(spark):
    df = spark.createDataFrame([("Núñez", None)], "a string, b string")
    assert encode(df).first()["value"] == '{"a":"Núñez","b":null}'


@pytest.mark.parametrize("phone,fine", [("123456789", True), ("12345678", False), ("123456789\n", False)])
def test_phone(spark, phone, fine):
    row = need("a") | {"telefono": phone}
    assert V.accepted(frame(spark, [row]), V.request_rules()).count() == fine


def test_rejects_name_their_rules(spark):
    rows = [
        need("a", lat=0.0), need("b", urgency=6) | {"nombre": " "}, need("c", cat="Otra"), need("d") | {"descripcion": None},
    ]
    got = {r["id"]: r["errors"] for r in V.rejected(frame(spark, rows), V.request_rules()).collect()}
    assert got == {"a": ["ubicacion"], "b": ["nombre", "nivel_urgencia"], "c": ["categoria"], "d": ["descripcion"]}
    assert V.rejected(frame(spark, [offer("v", radius=101)]), V.volunteer_rules()).count() == 1


def test_routing_and_attempts(spark):
    rows = [
        need("zero", urgency=0), offer("none", radius=0), need("both", urgency=2) | {"radio_disponible_km": 5},
        need("neither", urgency=None), need("four", attempts=4), need("five", attempts=5),
    ]
    left = L.add_attempt(frame(spark, rows))
    live = sorted((r["id"], r["is_help"], r["attempts"]) for r in L.retries(left).collect())
    assert live == [("both", False, 1), ("both", True, 1)]
    dead = {r["id"]: r["attempts"] for r in L.unmatched_requests(left).collect()}
    assert dead == {"four": 5, "five": 6}
    zero = frame(spark, [need("zero", urgency=0, attempts=4), offer("none", radius=0, attempts=4)])
    zero = L.add_attempt(zero)
    assert L.unmatched_requests(zero).count() == 1
    assert L.unmatched_volunteers(zero).count() == 1


@pytest.mark.parametrize("most", [200_000, -1], ids=["broadcast", "shuffled"])
def test_places(spark, monkeypatch, most):
    monkeypatch.setattr(places_module, "BROADCAST_PLACES", most)
    rng = random.Random(1)
    places = [(i, rng.uniform(38, 41), rng.uniform(-2, 1)) for i in range(60)] + [(60, -17.0, 179.9), (61, 89.9, 10.0)]
    points = [(f"p{i}", rng.uniform(37, 42), rng.uniform(-3, 2)) for i in range(60)] + [("q", -17.0, -179.9), ("r", 89.0, -170.0)]
    gaz = spark.createDataFrame(
        [(i, a, o, f"v{i}", "", None) for i, a, o in places], "place_id long, lat double, lon double, village string, town string, city string"
    )
    df = spark.createDataFrame(points, "id string, lat double, lon double")
    got = {r["id"]: (r["place_id"], r["place_name"]) for r in with_place_name(df, gaz).collect()}
    for key, a, o in points:
        best = min(places, key=lambda p: km({"lat": p[1], "lon": p[2]}, {"lat": a, "lon": o}))[0]
        assert got[key] == (best, f"v{best}")
    # rows of one id have places of their own, rows without a position have none
    twice = spark.createDataFrame([("x", 39.0, 0.0), ("x", 41.0, 0.0), ("x", 39.0, 0.0), ("y", None, None)], "id string, lat double, lon double")
    near = [min(places, key=lambda p: km({"lat": p[1], "lon": p[2]}, {"lat": a, "lon": 0.0}))[0] for a in (39.0, 39.0, 41.0)]
    rows = with_place_name(twice, gaz).orderBy("lat").collect()
    assert [r["place_id"] for r in rows] == [None, *near] and rows[0]["place_name"] == "Desconocido"
    none = with_place_name(df, gaz.limit(0), GENERATOR_PRECEDENCE, GENERATOR_DEFAULT)
    assert {r["place_name"] for r in none.collect()} == {""}


def test_distance_join_on_the_grid_equals_the_group_join(spark):
    rng = random.Random(2)
    rows = [need(f"h{i}", lat=39 + rng.random(), lon=rng.random()) for i in range(40)]
    rows += [offer(f"v{i}", lat=39 + rng.random(), lon=rng.random(), radius=rng.choice([0, 1, 7, 30, 90])) for i in range(40)]
    df = frame(spark, rows)
    for run in (nearest_volunteer, reachable):
        small = sorted(tuple(r) for r in run(df).collect())
        assert small and small == sorted(tuple(r) for r in run(df, max_rows=0).collect())


def test_replay_equals_going_window_by_window(spark):
    from datetime import timedelta

    rng = random.Random(5)
    rows = [need(f"h{w}{i}", lat=39.3 + rng.random() / 4, urgency=rng.randint(1, 5), at=i, w=w) for w in range(2) for i in range(5)]
    rows += [offer(f"v{w}{i}", lat=39.3 + rng.random() / 4, radius=rng.choice([2, 6]), at=i, w=w) for w in range(3) for i in range(4)]
    matches, dead, carry = set(), [], []
    for w in sorted({r["w"] + timedelta(minutes=k) for r in rows for k in range(6)}):
        mine = [r for r in rows if r["w"] == w] + carry
        found, helps, volunteers = greedy(mine)
        matches |= {(k[2], v[0]) for k, v in found.items()}
        lost = {k[2] for k in helps + volunteers}
        carry = []
        for r in mine:
            if r["id"] in lost:
                again = r | {"attempts": (r["attempts"] or 0) + 1, "w": w + timedelta(minutes=1), "ts": w + timedelta(minutes=1)}
                (dead if again["attempts"] >= 5 else carry).append(again)
    done = replay(frame(spark, rows), "1 minute")
    got = {(r["help"]["id"], r["volunteer"]["id"]) for r in L.matches(done.outcomes).collect()}
    assert got == matches
    ids = sorted(r["id"] for r in done.requests.collect()) + sorted(r["id"] for r in done.volunteers.collect())
    assert sorted(ids) == sorted(r["id"] for r in dead)
