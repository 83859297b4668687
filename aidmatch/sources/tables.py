"""Requests and offers derived from the ``events`` and ``nation`` tables.

Even event ids are requests, odd ones offers; coordinates are whole
micro-degrees, so that every engine sees the same doubles.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aidmatch.schemas import CATEGORIES

_LAT = """CASE WHEN is_help THEN (39250000 + event_id * 7919 % 200000) / 1e6
               ELSE (39000000 + event_id * 7919 % 800000) / 1e6 END"""
_LON = """CASE WHEN is_help THEN (event_id * 104729 % 200000 - 550000) / 1e6
               ELSE (event_id * 104729 % 600000 - 800000) / 1e6 END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds as one DataFrame, with ``is_help`` and the arrival time ``ts``."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("poblacion"))
    category = F.element_at(
        F.array(*[F.lit(c) for c in CATEGORIES]), (F.col("user_id") % len(CATEGORIES) + 1).cast("int")
    )
    return (
        table(spark, sf_dir, "events")
        .join(nation, F.expr("user_id % 25 = n_nationkey"))
        .withColumn("is_help", F.col("event_id") % 2 == 0)
        .withColumn("lat", F.expr(_LAT))
        .withColumn("lon", F.expr(_LON))
        .select(
            F.col("event_id").cast("string").alias("id"),
            F.col("event_id").alias("arrival"),
            "ts",
            "is_help",
            F.concat(F.lit("Persona "), F.col("user_id").cast("string")).alias("nombre"),
            F.format_string("%.6f,%.6f", "lat", "lon").alias("ubicacion"),
            "poblacion",
            category.alias("categoria"),
            F.expr("CASE WHEN is_help THEN 'Necesito ' || event_type END").alias("descripcion"),
            F.col("ts").alias("created_at"),
            F.expr("CASE WHEN is_help THEN CAST(1 + event_id * 31 % 5 AS int) END").alias("nivel_urgencia"),
            F.expr("CASE WHEN is_help THEN '6' || lpad(CAST(event_id AS string), 8, '0') END").alias("telefono"),
            F.expr(
                "CASE WHEN NOT is_help THEN CAST(5 * (1 + CAST(floor(event_id / 2) AS bigint) % 10) AS int) END"
            ).alias("radio_disponible_km"),
            F.lit(None).cast("int").alias("attempts"),
            "lat",
            "lon",
        )
    )


def with_attempts(df: DataFrame) -> DataFrame:
    """Records part-way through their retries: 0 (absent) to 5 attempts."""
    return df.withColumn("attempts", F.expr("CAST(nullif(arrival % 6, 0) AS int)"))


def with_repeats(df: DataFrame) -> DataFrame:
    """Every tenth record arrives twice."""
    return df.unionByName(df.filter("arrival % 10 = 0"))


def with_faults(df: DataFrame) -> DataFrame:
    """Some records broken, for validation and quarantine."""
    broken = {
        "ubicacion": "CASE WHEN arrival % 17 = 0 THEN '39.4' ELSE ubicacion END",
        "telefono": "CASE WHEN arrival % 19 = 0 THEN '123' ELSE telefono END",
        "nivel_urgencia": "CASE WHEN arrival % 23 = 0 AND is_help THEN 9 ELSE nivel_urgencia END",
        "radio_disponible_km": "CASE WHEN arrival % 29 = 0 AND NOT is_help THEN 0 ELSE radio_disponible_km END",
        "nombre": "CASE WHEN arrival % 31 = 0 THEN '  ' ELSE nombre END",
        "categoria": "CASE WHEN arrival % 37 = 0 THEN 'Otra' ELSE categoria END",
    }
    return df.withColumns({name: F.expr(text) for name, text in broken.items()})


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One place per nation, its name under ``village``, ``town`` or ``city``."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("place_id"),
        F.expr("(39000000 + n_nationkey * 31000) / 1e6").alias("lat"),
        F.expr("(n_nationkey * 24000 - 800000) / 1e6").alias("lon"),
        F.expr("CASE WHEN n_nationkey % 3 = 0 THEN n_name END").alias("village"),
        F.expr("CASE n_nationkey % 3 WHEN 1 THEN n_name WHEN 2 THEN '' END").alias("town"),
        F.expr("CASE WHEN n_nationkey % 3 = 2 AND n_nationkey <> 5 THEN n_name END").alias("city"),
    )
