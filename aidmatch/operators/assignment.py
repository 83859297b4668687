"""Exclusive assignment: each request, most urgent first, takes the nearest free volunteer.

Order among requests: urgency down, arrival, id, record key. Order among
volunteers of one request: distance, arrival, id, record key. Both are total,
so the result does not depend on how Spark lays out the rows.

Groups up to a checked size are solved inside one row by a fold, those up to a
second one by one task each, which shuffles a record once. Larger groups are
never gathered: they fall into parts, and large parts are solved by rounds of
proposals over the whole cluster. All give the same answer.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aidmatch.functions.geo import haversine, may_reach, position
from aidmatch.operators.crowds import BLOCK_REQUESTS, MAX_PART, choose, match_crowds
from aidmatch.operators.windows import GROUP, dedupe, group_sizes
from aidmatch.schemas import PAYLOAD
from aidmatch.workspace import checkpointed, checkpointed_in_order

# A group is solved in one row when it has at most this many records and pairs.
MAX_GROUP_ROWS = 8192
MAX_GROUP_PAIRS = 1 << 20
# The lists of pairs of such groups stay this many times their records, all in all, so that they grow as the input.
MAX_PAIRS_A_RECORD = 64
# A larger group is solved in one task when it has at most this many records (about 300 bytes each).
MAX_TASK_ROWS = 1 << 17
# Records that a task gets, as long as a group does not have more; what it sorts stays in memory.
TASK_ROWS = 1 << 16
# Hot-group keys up to this count are broadcast (about 100 bytes each).
BROADCAST_GROUPS = 50_000

RECORD = [*PAYLOAD, "ts", "lat", "lon", "rec_key"]
OUTCOME = [*GROUP, "help", "volunteer", "distance"]


def urgency(nivel: Column) -> Column:
    return F.coalesce(nivel, F.lit(0))


#: Times to the microsecond; by default JSON keeps milliseconds.
WHOLE_TIMES = {f"{kind}Format": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for kind in ("timestamp", "timestampNTZ")}


def record_key(of: str = "") -> Column:
    """A key of the whole record, or of that in a struct; copies of one id that differ get different keys."""
    payload = F.struct(*(F.col(f"{of}.{c}" if of else c).alias(c) for c in PAYLOAD))
    return F.sha2(F.to_json(payload, WHOLE_TIMES), 256)


def with_record_key(df: DataFrame) -> DataFrame:
    return df.withColumn("rec_key", record_key())


def urgency_order(df: DataFrame) -> DataFrame:
    """The place of each request in the order its group chooses in, as a column ``turn``.

    A sort by range cuts large groups over many tasks; numbers within a task
    start where those of the tasks before it end.
    """
    # the record key tells copies of one id apart, as in the choosing itself
    order = [*GROUP, F.desc(urgency(F.col("nivel_urgencia"))), F.col("ts"), F.col("id"), F.col("rec_key")]
    # The task numbers must not change between the count and the numbering.
    sorted_helps = checkpointed(
        with_record_key(df.filter("is_help")).repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    )
    before = Window.partitionBy(*GROUP).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sorted_helps.groupBy(*GROUP, "part").agg(F.count("*").alias("rows"))
        .withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .drop("rows")
    )
    within = Window.partitionBy(*GROUP, "part").orderBy(*order[2:])
    return (
        sorted_helps.withColumn("turn", F.row_number().over(within))
        .join(starts, [*GROUP, "part"])
        .withColumn("turn", (F.col("turn") + F.col("start")).cast("int"))
        .drop("part", "start", "rec_key")
    )


def split_by_size(df: DataFrame, max_rows: int = MAX_GROUP_ROWS, max_pairs: int = MAX_GROUP_PAIRS):
    """Split windowed records into bounded groups and the (usually absent) larger ones.

    Reads only the group columns to count. Returns ``(bounded, large)``, where
    ``large`` is None if every group is within the bounds.
    """
    too_big = (F.col("helps") + F.col("volunteers") > max_rows) | (
        F.col("helps") * F.col("volunteers") > max_pairs
    )
    hot = group_sizes(df).filter(too_big).select(*GROUP)
    count = hot.count()
    if count == 0:
        return df, None
    hot = checkpointed(hot)
    keys = F.broadcast(hot) if count <= BROADCAST_GROUPS else hot
    # a null category is a group like any other
    keys = keys.select(*(F.col(c).alias(f"hot_{c}") for c in GROUP))
    same = [F.col(c).eqNullSafe(F.col(f"hot_{c}")) for c in GROUP]
    return df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi")


def assign(
    df: DataFrame,
    max_rows: int = MAX_GROUP_ROWS,
    max_pairs: int = MAX_GROUP_PAIRS,
    max_part: int = MAX_PART,
    block_requests: int = BLOCK_REQUESTS,
    most_rows: int | None = None,
    max_task_rows: int | None = None,
) -> DataFrame:
    """Outcomes of one attempt for windowed records.

    One row per match (``help``, ``volunteer``, ``distance``) and per leftover
    (one side only, no distance). A leftover request is left out when a copy
    with its id matched earlier in the order, a leftover volunteer when a copy
    with its id matched at all. ``most_rows`` is a number of rows that the caller
    knows no group to exceed; where that alone keeps groups within the bounds,
    they are not counted. ``max_task_rows`` bounds the groups that one task solves;
    by default there are such groups only if ``max_rows`` and ``max_pairs`` are the
    default ones. They also take over where the bounded groups have many pairs a record.
    """
    if max_task_rows is None:
        max_task_rows = MAX_TASK_ROWS if (max_rows, max_pairs) == (MAX_GROUP_ROWS, MAX_GROUP_PAIRS) else 0
    if most_rows is not None and most_rows <= max_rows and most_rows**2 <= 4 * max_pairs:
        return _assign_bounded(df)
    if most_rows is not None and most_rows <= max_task_rows:
        return _assign_in_tasks(df)
    if max_task_rows:
        rows, pairs = F.col("helps") + F.col("volunteers"), F.col("helps") * F.col("volunteers")
        sizes = group_sizes(df).agg(
            F.count_if((rows > max_rows) | (pairs > max_pairs)).alias("over"), F.max(rows).alias("rows"),
            F.sum(rows).alias("all"), F.sum(pairs.cast("double")).alias("pairs"),
        ).first()
        if not sizes["over"] and (sizes["pairs"] or 0) <= MAX_PAIRS_A_RECORD * (sizes["all"] or 0):
            return _assign_bounded(df)
        if sizes["rows"] <= max_task_rows:
            return _assign_in_tasks(df, sizes["all"])
        bounded, large = split_by_size(df, max_task_rows, max_task_rows**2)
        out = _assign_in_tasks(bounded, sizes["all"])
    else:
        bounded, large = split_by_size(df, max_rows, max_pairs)
        out = _assign_bounded(bounded)
    if large is None:
        return out
    return out.unionByName(_assign_large(large, max_part, block_requests))


# --- bounded groups: one row per group ------------------------------------------------


def _side(is_help: bool) -> Column:
    """One side of a group as an array in choosing or arrival order."""
    keep = F.col("is_help") if is_help else ~F.col("is_help")
    first = -urgency(F.col("nivel_urgencia")) if is_help else F.lit(0)
    row = F.struct(
        first.alias("first"),
        F.col("ts").alias("at"),
        F.col("id").alias("who"),
        F.col("rec_key").alias("key"),
        position(F.col("lat"), F.col("lon")).alias("pos"),
        F.col("radio_disponible_km").alias("radius"),
        F.struct(*RECORD).alias("rec"),
    )
    return F.sort_array(F.collect_list(F.when(keep, row)))


def _wishes(groups: DataFrame) -> DataFrame:
    """Per group the lists of volunteer positions its requests can have, nearest first.

    The pairs live in compiled code between two explodes of one row and its own
    aggregate; only those within the radius are kept, as positions.
    """
    pairs = (
        groups.select(*GROUP, F.posexplode("helps.pos").alias("h", "h_pos"), F.col("volunteers.pos").alias("all"), "volunteers.radius")
        .select(*GROUP, "h", "h_pos", "radius", F.posexplode("all").alias("v", "v_pos"))
        .withColumn("radius", F.get("radius", F.col("v")))
        .filter(may_reach(F.col("h_pos"), F.col("v_pos"), F.col("radius")))
        .withColumn("d", haversine(F.col("v_pos"), F.col("h_pos")))
        .filter(F.col("d") <= F.col("radius"))
    )
    return (
        pairs.groupBy(*GROUP, "h")
        .agg(F.sort_array(F.collect_list(F.struct("d", "v")))["v"].alias("wish"))
        .groupBy(*GROUP)
        .agg(F.sort_array(F.collect_list(F.struct("h", "wish"))).alias("wishes"))
    )


def pick_in_turn(preferences: Column, none: Column, finish=None) -> Column:
    """Each list in turn takes its first element that no list before it took.

    ``preferences`` is an array of arrays; the result has one element per list,
    ``none`` where nothing was left.
    """
    return F.aggregate(
        preferences,
        F.slice(F.array(none), 1, 0),
        lambda taken, wish: F.concat(taken, F.array(F.coalesce(F.get(F.array_except(wish, taken), F.lit(0)), none))),
        finish,
    )


def _picked(picks: Column) -> Column:
    """Outcomes of a group: matches and left requests in turn, then left volunteers."""

    def who(side, i):
        return F.get(F.col(side), i)["who"]

    def repeated(side):
        return F.size(F.array_distinct(F.col(side)["who"])) < F.size(side)

    # Only where an id repeats can a copy vanish.
    matched = F.transform(picks, lambda p, i: F.when(p >= 0, who("helps", i)).otherwise(F.lit("")))
    turns = F.transform(picks, lambda p, i: F.struct(i.alias("h"), F.when(p >= 0, p).alias("v")))
    turns = F.when(
        repeated("helps"),
        F.filter(
            turns,
            lambda o: o["v"].isNotNull()
            | ~F.array_position(matched, who("helps", o["h"])).between(F.lit(1), o["h"]),
        ),
    ).otherwise(turns)
    free = F.array_except(F.transform("volunteers", lambda v, i: i), picks)
    served = F.transform(F.filter(picks, lambda p: p >= 0), lambda p: who("volunteers", p))
    free = F.when(
        repeated("volunteers"), F.filter(free, lambda i: ~F.array_contains(served, who("volunteers", i)))
    ).otherwise(free)
    rest = F.transform(free, lambda i: F.struct(F.lit(None).cast("int").alias("h"), i.alias("v")))

    def looked_up(o):
        h, v = F.get(F.col("helps"), o["h"]), F.get(F.col("volunteers"), o["v"])
        return F.struct(
            h["rec"].alias("help"), v["rec"].alias("volunteer"), haversine(v["pos"], h["pos"]).alias("distance")
        )

    return F.transform(F.concat(turns, rest), looked_up)


def _assign_bounded(df: DataFrame) -> DataFrame:
    # One shuffle by group serves the repeats and the grouping. The explicit
    # count keeps adaptive execution from merging tasks that are small in bytes
    # but heavy in work.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = with_record_key(dedupe(df.repartition(parts, *GROUP)))
    groups = placed.groupBy(*GROUP).agg(_side(True).alias("helps"), _side(False).alias("volunteers"))
    # Requests nobody can reach have no list; a group without pairs has no lists at all.
    def wish(h, i):
        place = F.array_position(F.col("wishes")["h"], i).cast("int")
        return F.coalesce(
            F.when(place > 0, F.get(F.col("wishes"), place - 1)["wish"]), F.slice(F.array(F.lit(0)), 1, 0)
        )

    picked = pick_in_turn(F.transform("helps", wish), F.lit(-1), _picked)
    # The outer form keeps the optimizer from adding a filter that repeats the fold.
    return (
        groups.join(_wishes(groups), GROUP, "left")
        .select(*GROUP, F.inline_outer(picked))
        .filter("help IS NOT NULL OR volunteer IS NOT NULL")
    )


# --- groups of one task ---------------------------------------------------------------


def _distinct(rows: pa.Table) -> pa.Table:
    """One row per distinct record, as :func:`dedupe` leaves them; the earliest arrival stays."""
    if pc.count_distinct(rows["rec_key"], mode="all").as_py() == len(rows):
        return rows
    key = ["is_help", *PAYLOAD, "lat", "lon"]
    numbered = rows.append_column("nth", pa.array(np.arange(len(rows))))
    first = numbered.group_by(key, use_threads=False).aggregate([("nth", "min"), ("ts", "min")])
    kept = rows.take(first["nth_min"])
    return kept.set_column(kept.schema.get_field_index("ts"), kept.schema.field("ts"), first["ts_min"])


#: Requests first, in the order in which they choose, then volunteers in that of their arrival.
_TURNS = [("is_help", "descending"), *((c, "ascending") for c in ("first", "ts", "id", "rec_key"))]


def settle_group(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The outcomes of a whole group, whatever the order of its records and however often they come.

    Its distinct records in order, and for each outcome the places of the request and of the
    volunteer among them, -1 for nobody.
    """
    rows = _distinct(rows)
    rows = rows.take(pc.sort_indices(rows, sort_keys=_TURNS, null_placement="at_start"))
    asking = rows["is_help"].to_numpy(zero_copy_only=False)
    helps, others = np.flatnonzero(asking), np.flatnonzero(~asking)
    # a record without a place or radius, or of a group without a name, meets nobody
    place = rows.select(["rlat", "rlon", "clat", "radio_disponible_km"]).to_pandas().astype(float)
    place.columns = ["rlat", "rlon", "clat", "radius"]
    sound = place[["rlat", "rlon", "clat"]].notna().all(axis=1).to_numpy()
    named = not any(rows[c][0].as_py() is None for c in GROUP)
    may_ask = helps[sound[helps] & named]
    may_sit = others[sound[others] & (place["radius"].to_numpy()[others] >= 0) & named]
    picks = choose(place.iloc[may_ask].assign(sure=np.inf), place.iloc[may_sit])
    got = picks >= 0
    matched_helps, matched_seats = may_ask[got], may_sit[picks[got]]
    ids = pd.Series(rows["id"].to_pandas().to_numpy())
    # a leftover vanishes when a copy of its id matched: a request's earlier in the order, a volunteer's at all
    first_won = pd.Series(matched_helps, index=ids[matched_helps]).groupby(level=0).min()
    left_helps = np.setdiff1d(helps, matched_helps, assume_unique=True)
    won = ids[left_helps].map(first_won).to_numpy(dtype=float, na_value=np.inf)
    left_helps = left_helps[~(won < left_helps)]
    left_seats = np.setdiff1d(others, matched_seats, assume_unique=True)
    left_seats = left_seats[~ids[left_seats].isin(ids[matched_seats].dropna()).to_numpy()]
    nobody = [np.full(len(side), -1) for side in (left_seats, left_helps)]
    return rows, np.concatenate([matched_helps, left_helps, nobody[0]]), np.concatenate([matched_seats, nobody[1], left_seats])


def outcome_table(rows: pa.Table, *chosen: np.ndarray) -> pa.Table:
    """What :func:`settle_group` found as rows with both records."""
    types = {c: rows.schema.field(c).type for c in RECORD}
    group = rows.select(GROUP).take(np.maximum(*chosen))
    sides = []
    for at in chosen:
        taken = rows.select(RECORD).take(pa.array(np.maximum(at, 0)))
        columns = [taken[c].combine_chunks() for c in RECORD]
        sides.append(pa.StructArray.from_arrays(columns, fields=[pa.field(c, types[c]) for c in RECORD], mask=pa.array(at < 0)))
    return pa.Table.from_arrays([*(group[c] for c in GROUP), *sides], names=[*GROUP, "help", "volunteer"])


def _assign_in_tasks(df: DataFrame, many: int = 0) -> DataFrame:
    """The same for groups that a task holds: whole records are shuffled once, by group, and leave it as outcomes.

    Tasks sort records by group only, once, and there are as many of them as keep that in memory for
    ``many`` records; repeats, the order of choosing and the choosing are the group's own work.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-many // TASK_ROWS))
    rows = for_tasks(df.repartition(parts, *GROUP)).select("w", "is_help", *RECORD, *PLACE, "first")

    def settle(group: pa.Table) -> pa.Table:
        return outcome_table(*settle_group(group))

    return with_distance(rows.groupBy(*GROUP).applyInArrow(settle, outcome_shape(rows)))


#: Where a record is, as :func:`position` has it.
PLACE = ["rlat", "rlon", "clat"]


def for_tasks(df: DataFrame) -> DataFrame:
    """Records with their keys, their places and the first part of their turns (``first``)."""
    # a zero has no sign and there is one NaN, as in a grouping
    sound = {c: F.when(F.isnan(c), F.lit(float("nan"))).otherwise(F.col(c) + F.lit(0.0)) for c in ("lat", "lon")}
    placed = with_record_key(df.filter("is_help IS NOT NULL").withColumns(sound))
    first = F.when(F.col("is_help"), -urgency(F.col("nivel_urgencia"))).otherwise(F.lit(0))
    return placed.select("*", position(F.col("lat"), F.col("lon")).alias("pos"), first.alias("first")).select("*", "pos.*").drop("pos")


def outcome_shape(rows: DataFrame) -> T.StructType:
    record = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in RECORD])
    group = [T.StructField(c, rows.schema[c].dataType) for c in GROUP]
    return T.StructType([*group, T.StructField("help", record), T.StructField("volunteer", record)])


def with_distance(outcomes: DataFrame) -> DataFrame:
    at = {side: position(F.col(f"{side}.lat"), F.col(f"{side}.lon")) for side in ("help", "volunteer")}
    both = F.col("help").isNotNull() & F.col("volunteer").isNotNull()
    return outcomes.withColumn("distance", F.when(both, haversine(at["volunteer"], at["help"])))


# --- large groups ---------------------------------------------------------------------


def _assign_large(df: DataFrame, max_part: int, block_requests: int) -> DataFrame:
    """The same for groups that no task may hold, see :mod:`aidmatch.operators.crowds`."""
    recs = checkpointed(with_record_key(dedupe(df)))
    pos = position(F.col("lat"), F.col("lon"))
    prio = F.struct((-urgency(F.col("nivel_urgencia"))).alias("first"), "ts", "id", "rec_key")
    # numbers that rise in the order of choosing and of arrival
    asking = checkpointed_in_order(
        recs.filter("is_help").select(*GROUP, prio.alias("prio"), pos.alias("pos"), "rec_key").sort(*GROUP, "prio"), "req"
    )
    seats = checkpointed_in_order(
        recs.filter("NOT is_help AND radio_disponible_km >= 0").select(
            *GROUP, pos.alias("pos"), F.col("radio_disponible_km").cast("double").alias("radius"), "rec_key", "ts", "id",
        ).sort(*GROUP, "ts", "id", "rec_key"),
        "seat",
    )
    pairs = match_crowds(asking.select(*GROUP, "req", "pos"), seats.select(*GROUP, "seat", "pos", "radius"), GROUP, max_part, block_requests)
    matched = checkpointed(
        pairs.join(asking.select(*GROUP, "req", "prio", "pos", F.col("rec_key").alias("help_key")), "req")
        .join(seats.select("seat", F.col("pos").alias("v_pos"), F.col("rec_key").alias("volunteer_key")), "seat")
        .select(*GROUP, "prio", "help_key", "volunteer_key", haversine(F.col("v_pos"), F.col("pos")).alias("distance"))
    )
    return _outcomes(recs, matched)


def _outcomes(recs: DataFrame, matched: DataFrame) -> DataFrame:
    rec = F.struct(*RECORD)
    helps = recs.filter("is_help").select(
        *GROUP, F.col("rec_key").alias("help_key"), rec.alias("help"),
        F.struct((-urgency(F.col("nivel_urgencia"))).alias("first"), "ts", "id", "rec_key").alias("prio"),
    )
    volunteers = recs.filter("NOT is_help").select(*GROUP, F.col("rec_key").alias("volunteer_key"), rec.alias("volunteer"))
    pairs = (
        matched.drop("prio")
        .join(helps.drop("prio"), [*GROUP, "help_key"])
        .join(volunteers, [*GROUP, "volunteer_key"])
        .select(*OUTCOME)
    )
    by_help = pairs.groupBy(*GROUP, F.col("help.id").alias("id")).agg(
        F.min(F.struct((-urgency(F.col("help.nivel_urgencia"))).alias("first"), "help.ts", "help.id", "help.rec_key")).alias("won")
    )
    left_helps = (
        helps.join(matched.select(*GROUP, "help_key"), [*GROUP, "help_key"], "left_anti")
        .withColumn("id", F.col("help.id"))
        .join(by_help, [*GROUP, "id"], "left")
        .filter(F.col("won").isNull() | (F.col("won") > F.col("prio")))
    )
    left_volunteers = (
        volunteers.join(matched.select(*GROUP, "volunteer_key"), [*GROUP, "volunteer_key"], "left_anti")
        .withColumn("id", F.col("volunteer.id"))
        .join(pairs.select(*GROUP, F.col("volunteer.id").alias("id")).distinct(), [*GROUP, "id"], "left_anti")
    )
    return (
        pairs.unionByName(left_helps.select(*GROUP, "help"), allowMissingColumns=True)
        .unionByName(left_volunteers.select(*GROUP, "volunteer"), allowMissingColumns=True)
    )
