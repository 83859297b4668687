"""The streaming job against the batch replay of the same records."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from aidmatch.plans.replay import replay
from aidmatch.sources.messages import read_messages
from aidmatch.streaming.job import StreamConfig, late_records, result_table, run_arrivals, run_notifications, run_quarantine, run_stream
from tests.rows import START, frame, need, offer

HELP = ["id", "nombre", "ubicacion", "poblacion", "categoria", "descripcion", "nivel_urgencia", "telefono", "attempts"]
OFFER = ["id", "nombre", "ubicacion", "poblacion", "categoria", "radio_disponible_km", "attempts"]


def send(spark, folder, name, rows, extra=()):
    """One file of messages."""
    values = []
    for r in rows:
        m = {c: r[c] for c in (HELP if r["is_help"] else OFFER) if r[c] is not None}
        m["created_at"] = r["created_at"].isoformat()
        values.append((json.dumps(m, ensure_ascii=False), r["ts"].replace(tzinfo=timezone.utc)))
    values += extra
    spark.createDataFrame(values, "value string, ts timestamp").coalesce(1).write.parquet(f"{folder}/{name}")


def config(tmp_path, **more):
    source = {f"{k}_source": {"path": f"{tmp_path}/{k}", "recursiveFileLookup": "true"} for k in ("help", "volunteer")}
    retry = {f"{k}_retry": {"path": f"{tmp_path}/{k}"} for k in ("help", "volunteer")}
    return StreamConfig(
        tables=f"{tmp_path}/tables", checkpoint=f"{tmp_path}/checkpoint",
        events_sink={"path": f"{tmp_path}/events"}, retry_clock="window", **source, **retry, **more,
    )


def test_stream_equals_batch_replay(spark, tmp_path):
    rng = random.Random(3)
    windows = 3
    rows = []
    for w in range(windows):
        rows += [need(f"h{w}{i}", lat=39.3 + rng.random() / 5, urgency=rng.randint(1, 5), at=i, w=w) for i in range(8)]
        rows += [offer(f"v{w}{i}", lat=39.3 + rng.random() / 5, radius=rng.choice([2, 5]), at=i, w=w) for i in range(8)]
    rows[0]["nombre"] = "Begoña Núñez"
    # only the volunteers send the records that close windows, so both streams share a clock
    cfg = config(tmp_path, watermark_scope="union", delay="0 seconds")
    for r in rows:
        assert r["ts"].tzinfo is None
    send(spark, f"{tmp_path}/help", "w0", [r for r in rows[:16] if r["is_help"]] + rows[:1], extra=[("{broken", START.replace(tzinfo=timezone.utc))])
    send(spark, f"{tmp_path}/volunteer", "w0", [r for r in rows[:16] if not r["is_help"]])
    query = run_stream(spark, cfg)
    # A record far outside every radius and category closes each window in turn.
    for w in range(1, windows + 6):
        mine = rows[16 * w : 16 * (w + 1)]
        send(spark, f"{tmp_path}/volunteer", f"w{w}", [r for r in mine if not r["is_help"]] + [offer(f"tick{w}", cat="Maquinaria", w=w, radius=0)])
        if mine:
            send(spark, f"{tmp_path}/help", f"w{w}", [r for r in mine if r["is_help"]])
        query.processAllAvailable()
        query.processAllAvailable()
    query.stop()
    done = replay(frame(spark, rows), "60 seconds").saved()

    def read(name):
        return result_table(spark, cfg, name).filter("categoria <> 'Maquinaria'")

    def rows_of(df, *columns):
        return sorted(tuple(r) for r in df.select(*columns).collect())

    pair = ("help_nombre", "help_ubicacion", "volunteer_ubicacion", "urgencia")
    km = F.round("distance", 6).alias("km")
    assert rows_of(read("matched_pairs"), *pair, km) == rows_of(done.matched, *pair, km)
    dead = ("id", "attempts")
    assert rows_of(read("unmatched_requests"), *dead) == rows_of(done.requests, *dead)
    assert rows_of(read("unmatched_volunteers"), *dead) == rows_of(done.volunteers, *dead)
    assert {r["attempts"] for r in read("unmatched_requests").collect()} <= {5}
    matched = done.matched.count()
    assert 2 * matched + done.requests.count() + done.volunteers.count() == len(rows)

    # Every match is an event, and every event becomes a notification.
    assert read_messages(spark, "parquet", path=f"{tmp_path}/events", recursiveFileLookup="true").count() == matched
    source = {"path": f"{tmp_path}/events", "recursiveFileLookup": "true"}
    run_notifications(spark, cfg, source, availableNow=True).awaitTermination()
    notes = [json.loads(r["value"]) for r in spark.read.parquet(f"{tmp_path}/tables/notifications").collect()]
    assert len(notes) == matched
    assert any("Begoña Núñez" in n["embeds"][0]["fields"][3]["value"] for n in notes)

    run_quarantine(spark, cfg, availableNow=True).awaitTermination()
    bad = spark.read.parquet(f"{tmp_path}/tables/quarantine").collect()
    assert [(r["value"], r["fault"]) for r in bad if r["value"] == "{broken"] == [("{broken", "no id")]


@pytest.mark.parametrize("lagging", [False, True])
def test_backlog_or_lagging_stream_loses_nothing(spark, tmp_path, lagging):
    """Several windows read at once, or volunteers a batch behind the requests, under the default clock."""
    rng = random.Random(8)
    rows = []
    for w in range(3):
        rows += [need(f"h{w}{i}", lat=39.3 + rng.random() / 3, urgency=rng.randint(1, 5), at=i, w=w) for i in range(6)]
        rows += [offer(f"v{w}{i}", lat=39.3 + rng.random() / 3, radius=rng.choice([2, 6]), at=i, w=w) for i in range(6)]
    sides = {"help": [r for r in rows if r["is_help"]], "volunteer": [r for r in rows if not r["is_help"]]}
    cfg = config(tmp_path, max_attempts=3)
    send(spark, f"{tmp_path}/help", "a", sides["help"])
    send(spark, f"{tmp_path}/volunteer", "a", [offer("first", cat="Maquinaria", radius=0)] if lagging else sides["volunteer"])
    query = run_stream(spark, cfg)
    query.processAllAvailable()
    if lagging:
        send(spark, f"{tmp_path}/volunteer", "b", sides["volunteer"])
        query.processAllAvailable()
    # far outside every radius and category; the clock jumps over several windows
    for w in (8, 16):
        send(spark, f"{tmp_path}/help", f"w{w}", [need(f"tick{w}", cat="Maquinaria", lat=43.0, w=w)])
        send(spark, f"{tmp_path}/volunteer", f"w{w}", [offer(f"tock{w}", cat="Maquinaria", w=w, radius=0)])
        query.processAllAvailable()
    dropped = sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)
    query.stop()
    done = replay(frame(spark, rows), "60 seconds", max_attempts=3).saved()

    def ids(df):
        return sorted(r["id"] for r in df.filter("categoria <> 'Maquinaria'").select("id").collect())

    def pairs(df):
        columns = ("help_ubicacion", "volunteer_ubicacion", F.round("distance", 6))
        return sorted(tuple(r) for r in df.filter("categoria <> 'Maquinaria'").select(*columns).collect())

    read = lambda name: result_table(spark, cfg, name)
    assert dropped == 0
    assert pairs(read("matched_pairs")) == pairs(done.matched)
    assert ids(read("unmatched_requests")) == ids(done.requests)
    assert ids(read("unmatched_volunteers")) == ids(done.volunteers)
    assert 2 * len(pairs(done.matched)) + len(ids(done.requests)) + len(ids(done.volunteers)) == len(rows)


@pytest.mark.parametrize("scope", ["union", "source"])
def test_late_record_is_dropped_and_window_fires_once(spark, tmp_path, scope):
    counted = []
    cfg = config(tmp_path, watermark_scope=scope, on_batch=lambda batch_id, counts: counted.append(counts))
    send(spark, f"{tmp_path}/help", "a", [need("h")])
    send(spark, f"{tmp_path}/volunteer", "a", [offer("v")])
    query = run_stream(spark, cfg)
    query.processAllAvailable()
    for k in ("help", "volunteer"):
        make = need if k == "help" else offer
        send(spark, f"{tmp_path}/{k}", "b", [make("later" + k, cat="Maquinaria", lat=41.0 + (k == "help"), w=5)])
    query.processAllAvailable()
    # The first window is closed: this copy is late and must not match again.
    send(spark, f"{tmp_path}/help", "c", [need("late")])
    query.processAllAvailable()
    dropped = sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)
    query.stop()
    matched = result_table(spark, cfg, "matched_pairs").collect()
    assert [r["help_created_at"] for r in matched] == [START]
    assert dropped == 1
    lost = result_table(spark, cfg, "outcome_counts").groupBy("outcome").agg(F.sum("total").alias("n"))
    assert {r["outcome"]: r["n"] for r in lost.collect()} == {"matched": 1}
    assert counted == [{"matched": 1, "requests_left": 0, "volunteers_left": 0, "dead_requests": 0, "dead_volunteers": 0}]
    # what the job lost from sight is listed, and nothing else
    run_arrivals(spark, cfg, availableNow=True).awaitTermination()
    assert [(r["id"], r["w"]) for r in late_records(spark, cfg).collect()] == [("late", START)]
    assert spark.read.parquet(f"{tmp_path}/tables/arrivals").count() == 5
