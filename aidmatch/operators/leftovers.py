"""What happens to matches and to records left over: attempts, routing, table rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aidmatch.operators.assignment import RECORD
from aidmatch.operators.windows import GROUP
from aidmatch.schemas import (
    HELP_FIELDS,
    MATCHED_PAIRS,
    MAX_ATTEMPTS,
    UNMATCHED_REQUESTS,
    UNMATCHED_VOLUNTEERS,
    VOLUNTEER_FIELDS,
)
from aidmatch.workspace import checkpointed


def matches(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter("distance IS NOT NULL")


def leftovers(outcomes: DataFrame) -> DataFrame:
    """Both kinds of leftover records as one collection, with ``is_help`` for the side they were on."""
    record = F.coalesce("help", "volunteer")
    return outcomes.filter("distance IS NULL").select(
        "w",
        F.col("help").isNotNull().alias("is_help"),
        *[record[c].alias(c) for c in RECORD],
    )


def add_attempt(df: DataFrame) -> DataFrame:
    return df.withColumn("attempts", F.coalesce("attempts", F.lit(0)) + 1)


def is_terminal(max_attempts: int = MAX_ATTEMPTS):
    return F.col("attempts") >= max_attempts


def live_help():
    """On a retry a zero counts as missing; a record with both fields goes both ways."""
    return F.coalesce("nivel_urgencia", F.lit(0)) != 0


def live_volunteer():
    return F.coalesce("radio_disponible_km", F.lit(0)) != 0


def terminal_help():
    """In the dead-letter tables presence counts, so zero stays."""
    return F.col("nivel_urgencia").isNotNull()


def terminal_volunteer():
    return F.col("radio_disponible_km").isNotNull()


def retries(left: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Live leftovers by the stream they return to (``is_help``); ``left`` has its attempt added."""
    kinds = F.array_compact(
        F.array(F.when(live_help(), F.lit(True)), F.when(live_volunteer(), F.lit(False)))
    )
    return left.filter(~is_terminal(max_attempts)).withColumn("is_help", F.explode(kinds))


def _timestamp(df: DataFrame, name: str):
    """Message times are text; table times are timestamps already."""
    as_text = isinstance(df.schema[name].dataType, type(MATCHED_PAIRS["match_id"].dataType))
    return F.try_to_timestamp(F.col(name)) if as_text else F.col(name)


def day() -> Column:
    """The date of the window, by which result tables are laid out."""
    return F.to_date("w").alias("day")


def matched_pairs(outcomes: DataFrame, random_ids: bool = False, with_day: bool = False) -> DataFrame:
    """Rows of the ``matched_pairs`` table, on demand with the ``day`` of their window.

    The id is a digest of window and both records, so that writing a batch
    again gives the same ids; ``random_ids`` asks for fresh ones.
    """
    flat = matches(outcomes).select(
        "w", "distance", "help.*", *[F.col(f"volunteer.{c}").alias(f"v_{c}") for c in RECORD]
    )
    key = F.sha2(F.concat_ws("|", F.col("w").cast("string"), "rec_key", "v_rec_key"), 256)
    return flat_match(flat, F.expr("uuid()") if random_ids else key, [day()] if with_day else [])


def flat_match(flat: DataFrame, match_id, more: list = ()) -> DataFrame:
    return flat.select(
        match_id.alias("match_id"),
        "categoria",
        "distance",
        F.col("nivel_urgencia").cast("long").alias("urgencia"),
        F.col("nombre").alias("help_nombre"),
        F.col("ubicacion").alias("help_ubicacion"),
        F.col("poblacion").alias("help_poblacion"),
        F.col("descripcion").alias("help_descripcion"),
        F.col("telefono").alias("help_telefono"),
        _timestamp(flat, "created_at").alias("help_created_at"),
        F.col("v_nombre").alias("volunteer_nombre"),
        F.col("v_ubicacion").alias("volunteer_ubicacion"),
        F.col("v_poblacion").alias("volunteer_poblacion"),
        F.col("v_radio_disponible_km").cast("long").alias("volunteer_radio_disponible_km"),
        _timestamp(flat, "v_created_at").alias("volunteer_created_at"),
        *more,
    )


def _dead(left: DataFrame, keep, fields, columns, more: list) -> DataFrame:
    row = {c: F.col(c) for c in fields} | {
        "created_at": _timestamp(left, "created_at"),
        "attempts": F.col("attempts").cast("long"),
        "insertion_stamp": F.current_timestamp(),
    }
    for c in ("nivel_urgencia", "radio_disponible_km"):
        if c in fields:
            row[c] = F.col(c).cast("long")
    return left.filter(keep).select(*[row[c].alias(c) for c in columns], *more)


def unmatched_requests(left: DataFrame, max_attempts: int = MAX_ATTEMPTS, with_day: bool = False) -> DataFrame:
    """Dead-letter rows of requests; ``left`` has its attempt added."""
    keep = is_terminal(max_attempts) & terminal_help()
    return _dead(left, keep, HELP_FIELDS, UNMATCHED_REQUESTS.fieldNames(), [day()] if with_day else [])


def unmatched_volunteers(left: DataFrame, max_attempts: int = MAX_ATTEMPTS, with_day: bool = False) -> DataFrame:
    keep = is_terminal(max_attempts) & terminal_volunteer()
    return _dead(left, keep, VOLUNTEER_FIELDS, UNMATCHED_VOLUNTEERS.fieldNames(), [day()] if with_day else [])


def outcome_counts(df: DataFrame, outcomes: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Counts of every kind of outcome, with the reason of each miss.

    ``df`` holds the windowed records that ``outcomes`` came from.
    """
    from aidmatch.operators.windows import dedupe, group_sizes

    sizes = group_sizes(dedupe(df))
    urgency = F.coalesce(F.col("help.nivel_urgencia"), F.lit(0))
    order = F.struct((-urgency).alias("first"), F.col("help.ts").alias("ts"), F.col("help.id").alias("id"), F.col("help.rec_key").alias("rec_key"))
    # what tells the kind of an outcome, written once for the groups and the rows
    kinds = checkpointed(outcomes.select(
        *GROUP,
        F.col("help").isNotNull().alias("asked"),
        F.col("distance").isNull().alias("left"),
        F.when(F.col("help").isNotNull(), order).alias("order"),
        (F.coalesce("help.attempts", "volunteer.attempts", F.lit(0)) + 1 >= max_attempts).alias("terminal"),
        F.coalesce("help.nivel_urgencia", "volunteer.nivel_urgencia").alias("nivel_urgencia"),
        F.coalesce("help.radio_disponible_km", "volunteer.radio_disponible_km").alias("radio_disponible_km"),
    ))
    # A request that comes after the match of the group's last volunteer found the pool empty.
    groups = kinds.groupBy(*GROUP).agg(
        F.count_if(~F.col("left")).alias("taken"), F.max(F.when(~F.col("left"), F.col("order"))).alias("last")
    )
    reasons = kinds.join(groups.join(sizes, GROUP), GROUP).select(
        F.when(~F.col("left"), "matched")
        .when(F.col("asked") & (F.col("volunteers") == 0), "help_no_volunteers")
        .when(F.col("asked") & (F.col("taken") == F.col("volunteers")) & (F.col("order") > F.col("last")), "help_pool_empty")
        .when(F.col("asked"), "help_no_match")
        .when(F.col("helps") == 0, "volunteer_no_requests")
        .otherwise("volunteer_no_match")
        .alias("outcome"),
        "left", "terminal", "nivel_urgencia", "radio_disponible_km",
    )
    dead = F.col("left") & F.col("terminal")
    outcome = F.array_compact(
        F.array(
            F.col("outcome"),
            F.when(dead & terminal_help(), "dead_letter_help"),
            F.when(dead & terminal_volunteer(), "dead_letter_volunteer"),
        )
    )
    return reasons.select(F.explode(outcome).alias("outcome")).groupBy("outcome").agg(F.count("*").alias("total"))
