
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aidmatch.functions.geo import format_coordinates, haversine_km, parse_coordinates  # noqa: E402
from aidmatch.operators import leftovers as L  # noqa: E402
from aidmatch.operators import validation as V  # noqa: E402
from aidmatch.operators.assignment import assign, urgency_order  # noqa: E402
from aidmatch.operators.places import with_place_name  # noqa: E402
from aidmatch.operators.proximity import nearest_volunteer, reachable  # noqa: E402
from aidmatch.operators.windows import dedupe, group_sizes, tumbling, window_counts  # noqa: E402
from aidmatch.plans import dashboard  # noqa: E402
from aidmatch.plans.attempt import attempt  # noqa: E402
from aidmatch.plans.replay import replay  # noqa: E402
from aidmatch.schemas import MATCH_EVENT, MESSAGE, RESULT_TABLES  # noqa: E402
from aidmatch.sources import messages as M  # noqa: E402
from aidmatch.sources import tables as T  # noqa: E402
from aidmatch.sources.results import ResultTables  # noqa: E402
from aidmatch.streaming.notifications import field_values, payloads  # noqa: E402
from aidmatch.workspace import scratch_path  # noqa: E402

WINDOW = "6 hours"

HELP_COLUMNS = [
    "id", "nombre", "ubicacion", "poblacion", "categoria", "descripcion", "created_at", "nivel_urgencia", "telefono",
]
VOLUNTEER_COLUMNS = ["id", "nombre", "ubicacion", "poblacion", "categoria", "radio_disponible_km", "created_at"]


def entry(spark: SparkSession) -> DataFrame:
    """Matches per category on the smallest tables."""
    return dashboard.matches_by_category(_attempt(spark, "/root/testdata/sf0.001").matched)


def _km():
    return F.round("distance", 6).alias("distance")


# --- inputs ---------------------------------------------------------------------------


def _windowed(spark, sf, length=WINDOW):
    return tumbling(T.records(spark, sf), length)


def _attempt(spark, sf):
    """One attempt over records that are part-way through their retries."""
    return attempt(tumbling(T.with_attempts(T.records(spark, sf)), WINDOW))


def _tables(spark, sf):
    """The three result tables of one attempt that is run once."""
    done = _attempt(spark, sf).saved()
    return done.matched, done.requests, done.volunteers


def _routed(spark, sf):
    """Leftovers with both fields, neither, and zeros among them."""
    return T.records(spark, sf).withColumns({
        "nivel_urgencia": F.expr(
            "CASE WHEN arrival % 13 = 0 THEN NULL WHEN arrival % 11 = 0 AND is_help THEN 0 ELSE nivel_urgencia END"
        ),
        "radio_disponible_km": F.expr(
            "CASE WHEN arrival % 13 = 0 THEN NULL WHEN arrival % 11 = 0 AND NOT is_help THEN 0 "
            "WHEN arrival % 7 = 0 THEN 5 ELSE radio_disponible_km END"
        ),
    })


def _messages(spark, sf):
    """Records, some broken, as JSON messages."""
    return M.encode_record(T.with_faults(T.records(spark, sf)), "ts")


# --- queries --------------------------------------------------------------------------


def scan_help(spark, sf):
    return T.records(spark, sf).filter("is_help").select(*HELP_COLUMNS, "ts")


def scan_volunteers(spark, sf):
    return T.records(spark, sf).filter("NOT is_help").select(*VOLUNTEER_COLUMNS, "ts")


def parse_messages(spark, sf):
    return M.parse(_messages(spark, sf)).select(
        "id", "categoria", "nombre", "nivel_urgencia", "radio_disponible_km", "telefono", "is_help",
        "lat", "lon", "fault", "ts",
    )


def encode_submissions(spark, sf):
    value = M.encode_record(T.records(spark, sf))
    return value.select(F.from_json("value", MESSAGE).alias("m")).select(
        *[F.col(f"m.{c}") for c in ("id", "nombre", "ubicacion", "poblacion", "categoria", "descripcion",
                                    "nivel_urgencia", "telefono", "radio_disponible_km")]
    )


def parse_coordinates_query(spark, sf):
    df = T.with_faults(T.records(spark, sf)).withColumn("at", parse_coordinates(F.col("ubicacion")))
    return df.select("id", "at.lat", "at.lon")


def format_coordinates_query(spark, sf):
    df = T.records(spark, sf).withColumn("at", parse_coordinates(format_coordinates(F.col("lat"), F.col("lon"))))
    return df.select("id", "at.lat", "at.lon")


def _faulty(spark, sf, is_help):
    return T.with_faults(T.records(spark, sf)).filter("is_help" if is_help else "NOT is_help")


def validate_requests(spark, sf):
    return V.accepted(_faulty(spark, sf, True), V.request_rules()).select(*HELP_COLUMNS)


def rejected_requests(spark, sf):
    bad = V.rejected(_faulty(spark, sf, True), V.request_rules())
    return bad.select("id", F.array_join("errors", ",").alias("errors"))


def validate_volunteers(spark, sf):
    return V.accepted(_faulty(spark, sf, False), V.volunteer_rules()).select(*VOLUNTEER_COLUMNS)


def build_requests(spark, sf):
    return V.build_requests(V.accepted(_faulty(spark, sf, True), V.request_rules()))


def build_volunteers(spark, sf):
    return V.build_volunteers(V.accepted(_faulty(spark, sf, False), V.volunteer_rules()))


def _new(df):
    """Whether the parts that are made up are there and tell records apart."""
    return df.withColumns({
        "new_id": F.length("id") == 36, "stamped": F.col("created_at").isNotNull(), "at": parse_coordinates(F.col("ubicacion")),
    })


def built_requests(spark, sf):
    return _new(build_requests(spark, sf)).select(
        "nombre", "poblacion", "categoria", "descripcion", "nivel_urgencia", "telefono", "at.lat", "at.lon", "new_id", "stamped"
    )


def built_volunteers(spark, sf):
    return _new(build_volunteers(spark, sf)).select(
        "nombre", "poblacion", "categoria", "radio_disponible_km", "at.lat", "at.lon", "new_id", "stamped"
    )


def route_retry(spark, sf):
    return _routed(spark, sf).select("id", L.live_help().alias("to_help"), L.live_volunteer().alias("to_volunteers"))


def route_terminal(spark, sf):
    return _routed(spark, sf).select(
        "id", L.terminal_help().alias("to_requests"), L.terminal_volunteer().alias("to_volunteers")
    )


def add_attempts(spark, sf):
    return L.add_attempt(T.with_attempts(T.records(spark, sf))).select("id", "attempts")


def partition_attempts(spark, sf):
    df = L.add_attempt(T.with_attempts(T.records(spark, sf)))
    return df.groupBy(L.is_terminal().alias("terminal"), "is_help").agg(F.count("*").alias("total"))


def tumbling_counts(spark, sf):
    return window_counts(tumbling(T.records(spark, sf)))


def dedupe_help(spark, sf):
    df = tumbling(T.with_repeats(T.with_attempts(T.records(spark, sf))).filter("is_help"))
    return dedupe(df).select("w", "categoria", "id", "nivel_urgencia", "attempts", "ts")


def dedupe_volunteers(spark, sf):
    df = tumbling(T.with_repeats(T.with_attempts(T.records(spark, sf))).filter("NOT is_help"))
    return dedupe(df).select("w", "categoria", "id", "radio_disponible_km", "attempts", "ts")


def cogroup_sizes(spark, sf):
    return group_sizes(dedupe(tumbling(T.with_repeats(T.records(spark, sf)))))


def urgency_order_query(spark, sf):
    return urgency_order(_windowed(spark, sf)).select("w", "categoria", "id", "turn")


def haversine_pairs(spark, sf):
    nations = T.table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("place_id"), F.col("n_name").alias("poblacion"))
    places = T.gazetteer(spark, sf).join(nations, "place_id").select(
        "poblacion", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon")
    )
    df = T.records(spark, sf).join(places, "poblacion")
    km = haversine_km(F.col("p_lat"), F.col("p_lon"), F.col("lat"), F.col("lon"))
    return df.select("id", "poblacion", F.round(km, 6).alias("distance"))


def pairs_within_radius(spark, sf):
    return reachable(_windowed(spark, sf)).select(
        "w", "categoria", "help_id", "eligible",
        F.round("nearest", 6).alias("nearest"), F.round("farthest", 6).alias("farthest"),
    )


def nearest_volunteer_query(spark, sf):
    return nearest_volunteer(_windowed(spark, sf)).select("w", "categoria", "help_id", "volunteer_id", _km())


def greedy_match(spark, sf):
    return L.matches(assign(_windowed(spark, sf))).select(
        "w", "categoria", F.col("help.id").alias("help_id"), F.col("volunteer.id").alias("volunteer_id"), _km()
    )


def _one_window(spark, sf):
    """All records at once: groups as large as the tables."""
    return T.records(spark, sf).withColumn("w", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"))


def _matched_ids(outcomes):
    return L.matches(outcomes).select(
        "categoria", F.col("help.id").alias("help_id"), F.col("volunteer.id").alias("volunteer_id"), _km()
    )


def greedy_match_one_window(spark, sf):
    return _matched_ids(assign(_one_window(spark, sf)))


def nearest_volunteer_one_window(spark, sf):
    return nearest_volunteer(_one_window(spark, sf)).select("categoria", "help_id", "volunteer_id", _km())


def pairs_within_radius_one_window(spark, sf):
    """The pairs of groups as large as the tables, by cubes, the crowded ones in blocks."""
    return reachable(_one_window(spark, sf), max_rows=0).select(
        "categoria", "help_id", "eligible", F.round("nearest", 6).alias("nearest"), F.round("farthest", 6).alias("farthest"),
    )


def window_unmatched_help(spark, sf):
    left = L.leftovers(assign(_windowed(spark, sf)))
    return left.filter("is_help").select("w", "categoria", "id")


def window_unmatched_volunteers(spark, sf):
    left = L.leftovers(assign(_windowed(spark, sf)))
    return left.filter("NOT is_help").select("w", "categoria", "id")


def unmatched_mixed(spark, sf):
    return L.leftovers(assign(_windowed(spark, sf))).select(
        "w", "categoria", "id", "is_help", "nivel_urgencia", "radio_disponible_km"
    )


def matched_pairs(spark, sf):
    return _attempt(spark, sf).matched.drop("match_id").withColumn("distance", _km())


def match_events(spark, sf):
    value = M.encode(_attempt(spark, sf).matched)
    return value.select(F.from_json("value", MATCH_EVENT).alias("m")).select("m.*").select(
        "categoria", _km(), "urgencia", "help_nombre", "help_ubicacion", "help_telefono", "help_created_at",
        "volunteer_nombre", "volunteer_ubicacion", "volunteer_radio_disponible_km", "volunteer_created_at",
    )


def decode_envelope(spark, sf):
    events = M.envelope(M.encode(_attempt(spark, sf).matched))
    return M.decode_envelope(events).select("categoria", _km(), "urgencia", "help_telefono", "volunteer_nombre")


def match_notifications(spark, sf):
    return field_values(_attempt(spark, sf).matched).drop("match_id", "footer_text")


def match_ids(spark, sf):
    """Ids of matches tell them apart and are the same when a batch runs again."""
    first, again = (_attempt(spark, sf).matched.groupBy("match_id").agg(F.count("*").alias(n)) for n in ("first", "again"))
    both = first.join(again, "match_id", "full")
    return both.agg(
        F.sum("first").alias("matches"), F.count("first").alias("ids"),
        F.count_if(F.col("first") == F.col("again")).alias("same_again"),
    )


_PAYLOAD = """embeds array<struct<title:string,color:int,fields:array<struct<name:string,value:string,inline:boolean>>,
  timestamp:string,footer:struct<text:string>>>"""


def notification_payloads(spark, sf):
    """Whole payloads, read back from their JSON; ids and times only by their form."""
    embed = payloads(_attempt(spark, sf).matched).select(F.from_json("value", _PAYLOAD)["embeds"].alias("embeds")).select(
        F.size("embeds").alias("embeds"), F.col("embeds")[0].alias("e")
    )
    return embed.select(
        "embeds", "e.title", "e.color",
        F.array_join("e.fields.name", "|").alias("names"), F.array_join("e.fields.value", "|").alias("texts"),
        F.array_join(F.transform("e.fields.inline", lambda x: x.cast("string")), "|").alias("inline"),
        F.col("e.footer.text").rlike("^Match ID: [0-9a-f]{64}$").alias("with_id"), F.col("e.timestamp").isNotNull().alias("stamped"),
    )


def dated_matches_by_category(spark, sf):
    """A summary of some days of the committed tables, which three batches have written and a compaction has joined."""
    done, results = _attempt(spark, sf).saved(), ResultTables(spark, scratch_path(spark))
    for batch in range(3):
        results.write(batch, **{
            name: df.filter(F.pmod(F.datediff("day", F.lit("2024-01-01")), F.lit(3)) == batch).withColumns(
                {f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
            ) for name, df in done.tables().items()
        })
    results.compact({name: RESULT_TABLES[name] for name in done.tables()}, upto=1)
    matched = results.read("matched_pairs", RESULT_TABLES["matched_pairs"]).filter("day BETWEEN '2024-01-05' AND '2024-01-12'")
    return dashboard.matches_by_category(matched)


def unmatched_requests(spark, sf):
    return _attempt(spark, sf).requests.drop("insertion_stamp")


def unmatched_volunteers(spark, sf):
    return _attempt(spark, sf).volunteers.drop("insertion_stamp")


def dead_letter(spark, sf):
    done = _attempt(spark, sf).saved()
    parts = [df.select("categoria", F.lit(kind).alias("kind"), "attempts")
             for df, kind in ((done.requests, "request"), (done.volunteers, "volunteer"))]
    return parts[0].unionByName(parts[1]).groupBy("categoria", "kind", "attempts").agg(F.count("*").alias("total"))


def _requeued(spark, sf, is_help):
    again = _attempt(spark, sf).retries.filter(F.col("is_help") == is_help)
    parsed = M.parse(M.encode_record(again, "ts"))
    return parsed.select("id", "categoria", "ubicacion", "nivel_urgencia", "radio_disponible_km", "attempts")


def requeue_help(spark, sf):
    return _requeued(spark, sf, True)


def requeue_volunteers(spark, sf):
    return _requeued(spark, sf, False)


def outcome_counts(spark, sf):
    df = tumbling(T.with_attempts(T.records(spark, sf)), WINDOW)
    return L.outcome_counts(df, assign(df))


def total_messages(spark, sf):
    return dashboard.total_messages(*_tables(spark, sf))


def match_totals(spark, sf):
    return dashboard.match_totals(*_tables(spark, sf))


def matches_by_location(spark, sf):
    return dashboard.matches_by_location(_attempt(spark, sf).matched)


def matches_by_category(spark, sf):
    return dashboard.matches_by_category(_attempt(spark, sf).matched)


def avg_urgency_by_category(spark, sf):
    matched, requests, _ = _tables(spark, sf)
    return dashboard.avg_urgency_by_category(matched, requests).withColumn(
        "urgencia_promedio", F.round("urgencia_promedio", 6)
    )


def unmatched_by_location(spark, sf):
    return dashboard.unmatched_by_location(_attempt(spark, sf).requests)


def unmatched_by_category(spark, sf):
    return dashboard.unmatched_by_category(_attempt(spark, sf).requests)


def category_demand(spark, sf):
    return dashboard.category_demand(*_tables(spark, sf))


def place_enrichment(spark, sf):
    df = with_place_name(T.records(spark, sf), T.gazetteer(spark, sf))
    return df.select("id", "place_id", "place_name", F.round("place_km", 6).alias("place_km"))


def retry_replay(spark, sf):
    """How many records end in each way when every leftover is tried in up to five windows."""
    done = replay(_windowed(spark, sf, "1 day"), "1 day").saved()
    matched = L.matches(done.outcomes).select(
        "categoria", F.lit("matched").alias("outcome"), F.coalesce("help.attempts", F.lit(0)).cast("long").alias("attempts")
    )
    dead = [df.select("categoria", F.lit(name).alias("outcome"), "attempts")
            for df, name in ((done.requests, "dead_request"), (done.volunteers, "dead_volunteer"))]
    return (
        matched.unionByName(dead[0]).unionByName(dead[1])
        .groupBy("categoria", "outcome", "attempts").agg(F.count("*").alias("total"))
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | _added()[0]


def oracle_sql() -> dict[str, str]:
    return _own_sql() | _added()[1]


def _added() -> tuple[dict, dict]:
    """Queries and SQL of the parts that may be absent: the subpackage for training data and the pipeline."""
    try:
        import corpus_pipeline
        from aidmatch.llm import queries as added
    except ModuleNotFoundError as e:
        if e.name not in ("aidmatch.llm", "aidmatch.llm.queries", "corpus_pipeline"):
            raise
        return {}, {}
    sql = added.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return added.QUERIES | {"pipeline": corpus_pipeline.run}, sql


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_help": scan_help,
        "scan_volunteers": scan_volunteers,
        "parse_messages": parse_messages,
        "encode_submissions": encode_submissions,
        "parse_coordinates": parse_coordinates_query,
        "format_coordinates": format_coordinates_query,
        "validate_requests": validate_requests,
        "rejected_requests": rejected_requests,
        "validate_volunteers": validate_volunteers,
        "build_requests": build_requests,
        "build_volunteers": build_volunteers,
        "built_requests": built_requests,
        "built_volunteers": built_volunteers,
        "route_retry": route_retry,
        "route_terminal": route_terminal,
        "add_attempts": add_attempts,
        "partition_attempts": partition_attempts,
        "tumbling_counts": tumbling_counts,
        "dedupe_help": dedupe_help,
        "dedupe_volunteers": dedupe_volunteers,
        "cogroup_sizes": cogroup_sizes,
        "urgency_order": urgency_order_query,
        "haversine_pairs": haversine_pairs,
        "pairs_within_radius": pairs_within_radius,
        "nearest_volunteer": nearest_volunteer_query,
        "greedy_match": greedy_match,
        "greedy_match_one_window": greedy_match_one_window,
        "nearest_volunteer_one_window": nearest_volunteer_one_window,
        "pairs_within_radius_one_window": pairs_within_radius_one_window,
        "window_unmatched_help": window_unmatched_help,
        "window_unmatched_volunteers": window_unmatched_volunteers,
        "unmatched_mixed": unmatched_mixed,
        "matched_pairs": matched_pairs,
        "match_events": match_events,
        "decode_envelope": decode_envelope,
        "match_notifications": match_notifications,
        "match_ids": match_ids,
        "notification_payloads": notification_payloads,
        "dated_matches_by_category": dated_matches_by_category,
        "unmatched_requests": unmatched_requests,
        "unmatched_volunteers": unmatched_volunteers,
        "dead_letter": dead_letter,
        "requeue_help": requeue_help,
        "requeue_volunteers": requeue_volunteers,
        "outcome_counts": outcome_counts,
        "total_messages": total_messages,
        "match_totals": match_totals,
        "matches_by_location": matches_by_location,
        "matches_by_category": matches_by_category,
        "avg_urgency_by_category": avg_urgency_by_category,
        "unmatched_by_location": unmatched_by_location,
        "unmatched_by_category": unmatched_by_category,
        "category_demand": category_demand,
        "place_enrichment": place_enrichment,
        "retry_replay": retry_replay,
    }


# --- SQL counterparts -----------------------------------------------------------------

_RECORDS = """records AS (
  SELECT CAST(event_id AS VARCHAR) AS id, event_id AS arrival, ts, event_id % 2 = 0 AS is_help,
         'Persona ' || user_id AS nombre, n_name AS poblacion,
         CASE user_id % 6 WHEN 0 THEN 'Alimentos' WHEN 1 THEN 'Medicamentos' WHEN 2 THEN 'Limpieza'
                          WHEN 3 THEN 'Maquinaria' WHEN 4 THEN 'Transporte' ELSE 'Asistencia Social' END AS categoria,
         CASE WHEN event_id % 2 = 0 THEN (39250000 + event_id * 7919 % 200000) / 1e6
              ELSE (39000000 + event_id * 7919 % 800000) / 1e6 END AS lat,
         CASE WHEN event_id % 2 = 0 THEN (event_id * 104729 % 200000 - 550000) / 1e6
              ELSE (event_id * 104729 % 600000 - 800000) / 1e6 END AS lon,
         printf('%.6f,%.6f', lat, lon) AS ubicacion,
         CASE WHEN event_id % 2 = 0 THEN 'Necesito ' || event_type END AS descripcion,
         ts AS created_at,
         CASE WHEN event_id % 2 = 0 THEN CAST(1 + event_id * 31 % 5 AS INTEGER) END AS nivel_urgencia,
         CASE WHEN event_id % 2 = 0 THEN '6' || lpad(CAST(event_id AS VARCHAR), 8, '0') END AS telefono,
         CASE WHEN event_id % 2 = 1 THEN CAST(5 * (1 + (event_id // 2) % 10) AS INTEGER) END AS radio_disponible_km
  FROM events JOIN nation ON n_nationkey = user_id % 25)"""

_FAULTS = _RECORDS + """,
faulty AS (
  SELECT * REPLACE (
    CASE WHEN arrival % 17 = 0 THEN '39.4' ELSE ubicacion END AS ubicacion,
    CASE WHEN arrival % 19 = 0 THEN '123' ELSE telefono END AS telefono,
    CASE WHEN arrival % 23 = 0 AND is_help THEN 9 ELSE nivel_urgencia END AS nivel_urgencia,
    CASE WHEN arrival % 29 = 0 AND NOT is_help THEN 0 ELSE radio_disponible_km END AS radio_disponible_km,
    CASE WHEN arrival % 31 = 0 THEN '  ' ELSE nombre END AS nombre,
    CASE WHEN arrival % 37 = 0 THEN 'Otra' ELSE categoria END AS categoria)
  FROM records),
located AS (
  SELECT *, string_split(ubicacion, ',') AS parts,
         CASE WHEN len(parts) = 2 THEN TRY_CAST(trim(parts[1]) AS DOUBLE) END AS t_lat,
         CASE WHEN len(parts) = 2 THEN TRY_CAST(trim(parts[2]) AS DOUBLE) END AS t_lon
  FROM faulty)"""

_ATTEMPTS = """r AS (SELECT *, CAST(nullif(arrival % 6, 0) AS INTEGER) AS attempts,
                    time_bucket(INTERVAL '6 hours', ts) AS w FROM records)"""

# Everybody in reach, then one request after the other, in turn, per group.
_GREEDY = "WITH RECURSIVE " + _RECORDS + ",\n" + _ATTEMPTS + """,
pairs AS (
  SELECT *, 6371e0 * 2 * atan2(sqrt(a), sqrt(greatest(0e0, 1 - a))) AS d
  FROM (SELECT h.w, h.categoria, h.id AS help_id, v.id AS volunteer_id, h.nivel_urgencia AS urg,
               h.ts AS h_ts, v.ts AS v_ts, v.radio_disponible_km AS radius,
               pow(sin((radians(h.lat) - radians(v.lat)) / 2), 2)
               + cos(radians(v.lat)) * cos(radians(h.lat)) * pow(sin((radians(h.lon) - radians(v.lon)) / 2), 2) AS a
        FROM r h JOIN r v ON h.w = v.w AND h.categoria = v.categoria
        WHERE h.is_help AND NOT v.is_help)),
reach AS (SELECT * FROM pairs WHERE d <= radius),
queue AS (SELECT *, row_number() OVER (PARTITION BY w, categoria ORDER BY urg DESC, h_ts, help_id) AS turn
          FROM (SELECT DISTINCT w, categoria, help_id, urg, h_ts FROM reach)),
step(w, categoria, turn, used, help_id, volunteer_id, d) AS (
  SELECT DISTINCT w, categoria, 0::BIGINT, []::VARCHAR[], NULL::VARCHAR, NULL::VARCHAR, NULL::DOUBLE FROM queue
  UNION ALL
  SELECT s.w, s.categoria, q.turn,
         CASE WHEN b.volunteer_id IS NULL THEN s.used ELSE list_append(s.used, b.volunteer_id) END,
         q.help_id, b.volunteer_id, b.d
  FROM step s JOIN queue q ON q.w = s.w AND q.categoria = s.categoria AND q.turn = s.turn + 1
  LEFT JOIN LATERAL (SELECT c.volunteer_id, c.d FROM reach c
                     WHERE c.w = q.w AND c.categoria = q.categoria AND c.help_id = q.help_id
                       AND NOT list_contains(s.used, c.volunteer_id)
                     ORDER BY c.d, c.v_ts, c.volunteer_id LIMIT 1) b ON true),
greedy AS (SELECT w, categoria, help_id, volunteer_id, round(d, 6) AS distance FROM step WHERE volunteer_id IS NOT NULL),
lost AS (SELECT * FROM r WHERE id NOT IN (SELECT help_id FROM greedy) AND id NOT IN (SELECT volunteer_id FROM greedy)),
tried AS (SELECT * REPLACE (coalesce(attempts, 0) + 1 AS attempts) FROM lost),
matched AS (
  SELECT g.categoria, g.distance, CAST(h.nivel_urgencia AS BIGINT) AS urgencia, h.nombre AS help_nombre,
         h.ubicacion AS help_ubicacion, h.poblacion AS help_poblacion, h.descripcion AS help_descripcion,
         h.telefono AS help_telefono, h.created_at AS help_created_at, v.nombre AS volunteer_nombre,
         v.ubicacion AS volunteer_ubicacion, v.poblacion AS volunteer_poblacion,
         CAST(v.radio_disponible_km AS BIGINT) AS volunteer_radio_disponible_km, v.created_at AS volunteer_created_at
  FROM greedy g JOIN r h ON h.id = g.help_id JOIN r v ON v.id = g.volunteer_id),
requests AS (
  SELECT id, nombre, ubicacion, poblacion, categoria, descripcion, created_at,
         CAST(nivel_urgencia AS BIGINT) AS nivel_urgencia, telefono, CAST(attempts AS BIGINT) AS attempts
  FROM tried WHERE attempts >= 5 AND nivel_urgencia IS NOT NULL),
offers AS (
  SELECT id, nombre, ubicacion, poblacion, categoria, CAST(radio_disponible_km AS BIGINT) AS radio_disponible_km,
         created_at, CAST(attempts AS BIGINT) AS attempts
  FROM tried WHERE attempts >= 5 AND radio_disponible_km IS NOT NULL)
"""

_GREEDY_ONE = _GREEDY.replace("time_bucket(INTERVAL '6 hours', ts) AS w", "TIMESTAMP '2024-01-01' AS w")

_ROUTED = "WITH " + _RECORDS + """,
routed AS (SELECT id,
  CASE WHEN arrival % 13 = 0 THEN NULL WHEN arrival % 11 = 0 AND is_help THEN 0 ELSE nivel_urgencia END AS u,
  CASE WHEN arrival % 13 = 0 THEN NULL WHEN arrival % 11 = 0 AND NOT is_help THEN 0
       WHEN arrival % 7 = 0 THEN 5 ELSE radio_disponible_km END AS k FROM records)
"""

_CATEGORIES = "('Alimentos', 'Medicamentos', 'Limpieza', 'Maquinaria', 'Transporte', 'Asistencia Social')"
_GOOD_COMMON = f"""trim(nombre) <> '' AND coalesce(t_lat <> 0 AND t_lon <> 0, false) AND trim(poblacion) <> ''
  AND categoria IN {_CATEGORIES}"""
_GOOD_REQUEST = _GOOD_COMMON + """ AND trim(descripcion) <> '' AND nivel_urgencia BETWEEN 1 AND 5
  AND regexp_full_match(telefono, '[0-9]{9}')"""


def _columns(names):
    return ", ".join(names)


def _dedupe_sql(side, field):
    return f"""WITH {_RECORDS},
twice AS (SELECT * FROM records UNION ALL SELECT * FROM records WHERE arrival % 10 = 0)
SELECT DISTINCT time_bucket(INTERVAL '60 seconds', ts) AS w, categoria, id, {field},
       CAST(nullif(arrival % 6, 0) AS INTEGER) AS attempts, ts
FROM twice WHERE {side}"""


def _requeue_sql(field):
    return _GREEDY + f"""SELECT id, categoria, ubicacion, nivel_urgencia, radio_disponible_km,
       CAST(attempts AS INTEGER) AS attempts
FROM tried WHERE attempts < 5 AND coalesce({field}, 0) <> 0"""


def _by_sql(table, column):
    return _GREEDY + f"SELECT {column}, count(*) AS total FROM {table} GROUP BY {column} ORDER BY total DESC"


def _own_sql() -> dict[str, str]:
    return {
        "scan_help": f"WITH {_RECORDS} SELECT {_columns(HELP_COLUMNS)}, ts FROM records WHERE is_help",
        "scan_volunteers": f"WITH {_RECORDS} SELECT {_columns(VOLUNTEER_COLUMNS)}, ts FROM records WHERE NOT is_help",
        "parse_messages": f"""WITH {_FAULTS},
messages AS (
  SELECT t_lat, t_lon, ts, json_object('id', id, 'categoria', categoria, 'nombre', nombre, 'telefono', telefono,
         'nivel_urgencia', nivel_urgencia, 'radio_disponible_km', radio_disponible_km) AS m FROM located)
SELECT m->>'id' AS id, m->>'categoria' AS categoria, m->>'nombre' AS nombre,
       CAST(m->>'nivel_urgencia' AS INTEGER) AS nivel_urgencia,
       CAST(m->>'radio_disponible_km' AS INTEGER) AS radio_disponible_km, m->>'telefono' AS telefono,
       m->>'nivel_urgencia' IS NOT NULL AS is_help, t_lat AS lat, t_lon AS lon,
       CASE WHEN t_lat IS NULL OR t_lon IS NULL THEN 'bad ubicacion' END AS fault, ts
FROM messages""",
        "encode_submissions": f"""WITH {_RECORDS} SELECT id, nombre, ubicacion, poblacion, categoria, descripcion,
       nivel_urgencia, telefono, radio_disponible_km FROM records""",
        "parse_coordinates": f"WITH {_FAULTS} SELECT id, t_lat AS lat, t_lon AS lon FROM located",
        "format_coordinates": f"WITH {_RECORDS} SELECT id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM records",
        "validate_requests": f"WITH {_FAULTS} SELECT {_columns(HELP_COLUMNS)} FROM located WHERE is_help AND {_GOOD_REQUEST}",
        "rejected_requests": f"""WITH {_FAULTS},
broken AS (SELECT id, concat_ws(',',
    CASE WHEN trim(nombre) = '' THEN 'nombre' END,
    CASE WHEN NOT coalesce(t_lat <> 0 AND t_lon <> 0, false) THEN 'ubicacion' END,
    CASE WHEN trim(poblacion) = '' THEN 'poblacion' END,
    CASE WHEN categoria NOT IN {_CATEGORIES} THEN 'categoria' END,
    CASE WHEN trim(descripcion) = '' THEN 'descripcion' END,
    CASE WHEN nivel_urgencia NOT BETWEEN 1 AND 5 THEN 'nivel_urgencia' END,
    CASE WHEN NOT regexp_full_match(telefono, '[0-9]{{9}}') THEN 'telefono' END) AS errors
  FROM located WHERE is_help)
SELECT id, errors FROM broken WHERE errors <> ''""",
        "validate_volunteers": f"""WITH {_FAULTS} SELECT {_columns(VOLUNTEER_COLUMNS)} FROM located
WHERE NOT is_help AND {_GOOD_COMMON} AND radio_disponible_km BETWEEN 1 AND 100""",
        "built_requests": f"""WITH {_FAULTS} SELECT nombre, poblacion, categoria, descripcion, nivel_urgencia, telefono,
       round(lat, 6) AS lat, round(lon, 6) AS lon, true AS new_id, true AS stamped FROM located WHERE is_help AND {_GOOD_REQUEST}""",
        "built_volunteers": f"""WITH {_FAULTS} SELECT nombre, poblacion, categoria, radio_disponible_km,
       round(lat, 6) AS lat, round(lon, 6) AS lon, true AS new_id, true AS stamped FROM located
WHERE NOT is_help AND {_GOOD_COMMON} AND radio_disponible_km BETWEEN 1 AND 100""",
        "match_ids": _GREEDY + "SELECT count(*) AS matches, count(*) AS ids, count(*) AS same_again FROM greedy",
        "notification_payloads": _GREEDY + """SELECT 1 AS embeds, '¡Nuevo Match Realizado! 🤝' AS title, 3066993 AS color,
       'Categoría|Distancia|Nivel de Urgencia|Persona que necesita ayuda|Voluntario' AS names,
       concat_ws('|', categoria, printf('%.2f km', distance), '⚠️ ' || urgencia,
                 '**Nombre:** ' || help_nombre || chr(10) || '**Población:** ' || help_poblacion,
                 '**Nombre:** ' || volunteer_nombre || chr(10) || '**Población:** ' || volunteer_poblacion) AS texts,
       'true|true|true|false|false' AS inline, true AS with_id, true AS stamped
FROM matched""",
        "dated_matches_by_category": _GREEDY + """SELECT categoria, count(*) AS total FROM greedy
WHERE CAST(w AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY categoria ORDER BY total DESC""",
        "route_retry": _ROUTED + "SELECT id, coalesce(u, 0) <> 0 AS to_help, coalesce(k, 0) <> 0 AS to_volunteers FROM routed",
        "route_terminal": _ROUTED + "SELECT id, u IS NOT NULL AS to_requests, k IS NOT NULL AS to_volunteers FROM routed",
        "add_attempts": f"WITH {_RECORDS} SELECT id, CAST(arrival % 6 + 1 AS INTEGER) AS attempts FROM records",
        "partition_attempts": f"""WITH {_RECORDS} SELECT arrival % 6 + 1 >= 5 AS terminal, is_help, count(*) AS total
FROM records GROUP BY ALL""",
        "tumbling_counts": f"""WITH {_RECORDS}
SELECT time_bucket(INTERVAL '60 seconds', ts) AS w, count(*) FILTER (is_help) AS helps,
       count(*) FILTER (NOT is_help) AS volunteers FROM records GROUP BY 1""",
        "dedupe_help": _dedupe_sql("is_help", "nivel_urgencia"),
        "dedupe_volunteers": _dedupe_sql("NOT is_help", "radio_disponible_km"),
        "cogroup_sizes": f"""WITH {_RECORDS},
twice AS (SELECT * FROM records UNION ALL SELECT * FROM records WHERE arrival % 10 = 0),
once AS (SELECT DISTINCT time_bucket(INTERVAL '60 seconds', ts) AS w, categoria, is_help, id FROM twice)
SELECT w, categoria, count(*) FILTER (is_help) AS helps, count(*) FILTER (NOT is_help) AS volunteers
FROM once GROUP BY ALL""",
        "urgency_order": f"""WITH {_RECORDS}, {_ATTEMPTS}
SELECT w, categoria, id, CAST(row_number() OVER (PARTITION BY w, categoria
       ORDER BY coalesce(nivel_urgencia, 0) DESC, ts, id) AS INTEGER) AS turn FROM r WHERE is_help""",
        "haversine_pairs": f"""WITH {_RECORDS},
places AS (SELECT n_name, (39000000 + n_nationkey * 31000) / 1e6 AS p_lat, (n_nationkey * 24000 - 800000) / 1e6 AS p_lon
           FROM nation),
halves AS (SELECT id, poblacion, pow(sin(radians(lat - p_lat) / 2), 2)
             + cos(radians(p_lat)) * cos(radians(lat)) * pow(sin(radians(lon - p_lon) / 2), 2) AS a
           FROM records JOIN places ON n_name = poblacion)
SELECT id, poblacion, round(6371e0 * 2 * atan2(sqrt(a), sqrt(1 - a)), 6) AS distance FROM halves""",
        "pairs_within_radius": _GREEDY + """SELECT w, categoria, help_id, count(*) AS eligible,
       round(min(d), 6) AS nearest, round(max(d), 6) AS farthest FROM reach GROUP BY w, categoria, help_id""",
        "nearest_volunteer": _GREEDY + """SELECT w, categoria, help_id, volunteer_id, round(d, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY w, categoria, help_id ORDER BY d, v_ts, volunteer_id) AS n FROM reach)
WHERE n = 1""",
        "greedy_match": _GREEDY + "SELECT * FROM greedy",
        "greedy_match_one_window": _GREEDY_ONE + "SELECT categoria, help_id, volunteer_id, distance FROM greedy",
        "nearest_volunteer_one_window": _GREEDY_ONE + """SELECT categoria, help_id, volunteer_id, round(d, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY categoria, help_id ORDER BY d, v_ts, volunteer_id) AS n FROM reach)
WHERE n = 1""",
        "pairs_within_radius_one_window": _GREEDY_ONE + """SELECT categoria, help_id, count(*) AS eligible,
       round(min(d), 6) AS nearest, round(max(d), 6) AS farthest FROM reach GROUP BY categoria, help_id""",
        "window_unmatched_help": _GREEDY + "SELECT w, categoria, id FROM lost WHERE is_help",
        "window_unmatched_volunteers": _GREEDY + "SELECT w, categoria, id FROM lost WHERE NOT is_help",
        "unmatched_mixed": _GREEDY + "SELECT w, categoria, id, is_help, nivel_urgencia, radio_disponible_km FROM lost",
        "matched_pairs": _GREEDY + "SELECT * FROM matched",
        "match_events": _GREEDY + """SELECT categoria, distance, urgencia, help_nombre, help_ubicacion, help_telefono,
       strftime(help_created_at, '%Y-%m-%dT%H:%M:%S.%f') AS help_created_at, volunteer_nombre, volunteer_ubicacion,
       volunteer_radio_disponible_km, strftime(volunteer_created_at, '%Y-%m-%dT%H:%M:%S.%f') AS volunteer_created_at
FROM matched""",
        "decode_envelope": _GREEDY + "SELECT categoria, distance, urgencia, help_telefono, volunteer_nombre FROM matched",
        "match_notifications": _GREEDY + """SELECT categoria AS category_text, printf('%.2f km', distance) AS distance_text,
       '⚠️ ' || urgencia AS urgency_text,
       '**Nombre:** ' || help_nombre || chr(10) || '**Población:** ' || help_poblacion AS help_text,
       '**Nombre:** ' || volunteer_nombre || chr(10) || '**Población:** ' || volunteer_poblacion AS volunteer_text
FROM matched""",
        "unmatched_requests": _GREEDY + "SELECT * FROM requests",
        "unmatched_volunteers": _GREEDY + "SELECT * FROM offers",
        "dead_letter": _GREEDY + """SELECT categoria, kind, attempts, count(*) AS total FROM (
  SELECT categoria, 'request' AS kind, attempts FROM requests UNION ALL
  SELECT categoria, 'volunteer' AS kind, attempts FROM offers) GROUP BY ALL""",
        "requeue_help": _requeue_sql("nivel_urgencia"),
        "requeue_volunteers": _requeue_sql("radio_disponible_km"),
        "outcome_counts": _GREEDY + """, sizes AS (
  SELECT w, categoria, count(*) FILTER (is_help) AS helps, count(*) FILTER (NOT is_help) AS volunteers FROM r GROUP BY ALL),
taken AS (SELECT w, categoria, count(*) AS n FROM greedy GROUP BY ALL),
turns AS (SELECT *, row_number() OVER (PARTITION BY w, categoria ORDER BY nivel_urgencia DESC, ts, id) AS place
          FROM r WHERE is_help),
last AS (SELECT t.w, t.categoria, max(place) AS place FROM turns t JOIN greedy g ON g.help_id = t.id GROUP BY ALL),
reasons AS (
  SELECT 'matched' AS outcome FROM greedy
  UNION ALL
  SELECT CASE WHEN s.volunteers = 0 THEN 'help_no_volunteers'
              WHEN coalesce(k.n, 0) = s.volunteers AND t.place > last.place THEN 'help_pool_empty'
              ELSE 'help_no_match' END
  FROM turns t JOIN sizes s USING (w, categoria) LEFT JOIN taken k USING (w, categoria) LEFT JOIN last USING (w, categoria)
  WHERE t.id IN (SELECT id FROM lost)
  UNION ALL
  SELECT CASE WHEN s.helps = 0 THEN 'volunteer_no_requests' ELSE 'volunteer_no_match' END
  FROM lost JOIN sizes s USING (w, categoria) WHERE NOT is_help
  UNION ALL SELECT 'dead_letter_help' FROM requests
  UNION ALL SELECT 'dead_letter_volunteer' FROM offers)
SELECT outcome, count(*) AS total FROM reasons GROUP BY outcome""",
        "total_messages": _GREEDY + """SELECT (SELECT count(*) FROM requests) + (SELECT count(*) FROM offers)
       + 2 * (SELECT count(*) FROM matched) AS total_messages""",
        "match_totals": _GREEDY + """SELECT (SELECT count(*) FROM matched) AS total_matches,
       (SELECT count(*) FROM requests) + (SELECT count(*) FROM offers) AS total_not_matched""",
        "matches_by_location": _by_sql("matched", "help_poblacion"),
        "matches_by_category": _by_sql("matched", "categoria"),
        "avg_urgency_by_category": _GREEDY + """SELECT categoria, round(avg(urgencia), 6) AS urgencia_promedio FROM (
  SELECT DISTINCT categoria, nivel_urgencia AS urgencia, 1 AS side FROM requests UNION ALL
  SELECT DISTINCT categoria, urgencia, 2 FROM matched) GROUP BY categoria""",
        "unmatched_by_location": _by_sql("requests", "poblacion"),
        "unmatched_by_category": _by_sql("requests", "categoria"),
        "category_demand": _GREEDY + """SELECT categoria, CAST(sum(asked) AS BIGINT) AS requested, CAST(sum(gave) AS BIGINT) AS offered FROM (
  SELECT categoria, 1 AS asked, 1 AS gave FROM matched UNION ALL SELECT categoria, 1, 0 FROM requests
  UNION ALL SELECT categoria, 0, 1 FROM offers) GROUP BY categoria""",
        "place_enrichment": f"""WITH {_RECORDS},
places AS (SELECT n_nationkey AS place_id, (39000000 + n_nationkey * 31000) / 1e6 AS p_lat,
                  (n_nationkey * 24000 - 800000) / 1e6 AS p_lon,
                  CASE WHEN n_nationkey = 5 THEN 'Desconocido' ELSE n_name END AS place_name FROM nation),
halves AS (SELECT id, place_id, place_name, pow(sin((radians(p_lat) - radians(lat)) / 2), 2)
             + cos(radians(lat)) * cos(radians(p_lat)) * pow(sin((radians(p_lon) - radians(lon)) / 2), 2) AS a
           FROM records CROSS JOIN places),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY a, place_id) AS n FROM halves)
SELECT id, CAST(place_id AS BIGINT) AS place_id, place_name,
       round(6371e0 * 2 * atan2(sqrt(a), sqrt(1 - a)), 6) AS place_km FROM ranked WHERE n = 1""",
    }
