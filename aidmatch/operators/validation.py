"""Checks of submissions, and the records built from those that pass."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.functions.geo import format_coordinates, parse_coordinates
from aidmatch.schemas import CATEGORIES, HELP_FIELDS, PHONE_PATTERN, RADIUS_RANGE, URGENCY_RANGE, VOLUNTEER_FIELDS


def _filled(name):
    return F.trim(F.col(name)) != ""


def _whole(name, bounds):
    return F.col(name).try_cast("int").between(*bounds)


def _located():
    """A coordinate of zero counts as missing."""
    at = parse_coordinates(F.col("ubicacion"))
    return (at["lat"] != 0) & (at["lon"] != 0)


def _common():
    return {
        "nombre": _filled("nombre"),
        "ubicacion": _located(),
        "poblacion": _filled("poblacion"),
        "categoria": F.col("categoria").isin(CATEGORIES),
    }


def request_rules():
    return _common() | {
        "descripcion": _filled("descripcion"),
        "nivel_urgencia": _whole("nivel_urgencia", URGENCY_RANGE),
        "telefono": F.col("telefono").rlike(PHONE_PATTERN),
    }


def volunteer_rules():
    return _common() | {"radio_disponible_km": _whole("radio_disponible_km", RADIUS_RANGE)}


def checked(df: DataFrame, rules: dict) -> DataFrame:
    """Add ``errors``, the names of the rules a row breaks; a missing value breaks its rule."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("errors", F.array_compact(F.array(*broken)))


def accepted(df: DataFrame, rules: dict) -> DataFrame:
    return checked(df, rules).filter(F.size("errors") == 0).drop("errors")


def rejected(df: DataFrame, rules: dict) -> DataFrame:
    return checked(df, rules).filter(F.size("errors") > 0)


def _built(df: DataFrame, fields: list) -> DataFrame:
    made = {
        "id": F.expr("uuid()"),
        "created_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "ubicacion": format_coordinates(F.col("lat"), F.col("lon")),
    }
    return df.select(*[made.get(c, F.col(c)).alias(c) for c in fields])


def build_requests(df: DataFrame) -> DataFrame:
    """Help-request messages from accepted form rows (with ``lat`` and ``lon``): new id, time now."""
    return _built(df, HELP_FIELDS)


def build_volunteers(df: DataFrame) -> DataFrame:
    return _built(df, VOLUNTEER_FIELDS)
