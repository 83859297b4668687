"""JSON messages in and out, in batch and as streams."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aidmatch.functions.geo import parse_coordinates
from aidmatch.schemas import MATCH_EVENT, MESSAGE, PAYLOAD


def read_messages(spark: SparkSession, fmt: str = "text", streaming: bool = False, **options) -> DataFrame:
    """Raw messages as ``value`` (text or bytes) with their arrival time ``ts``.

    ``text`` takes one file per message, so that a message may span lines; its
    time is the file's. ``kafka`` carries its own time. Other formats (such as
    ``parquet``) must hold ``value`` and ``ts``.
    """
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    if fmt == "text":
        df = reader.option("wholetext", "true").options(**options).load()
        return df.select("value", F.col("_metadata.file_modification_time").alias("ts"))
    if fmt == "kafka":
        return reader.options(**options).load().select("value", F.col("timestamp").alias("ts"))
    if streaming:
        reader = reader.schema("value string, ts timestamp")
    return reader.options(**options).load().select("value", "ts")


def parse(raw: DataFrame, urgencia_alias: bool = False) -> DataFrame:
    """Decode and parse; adds ``is_help``, coordinates and ``fault`` (null where the record is sound).

    The side of a record follows from its fields, not from the stream it came
    on; one with both fields goes to both sides. A manually entered request
    names its urgency ``urgencia``; ``urgencia_alias`` accepts that.
    """
    text = F.decode("value", "UTF-8") if dict(raw.dtypes)["value"] == "binary" else F.col("value")
    m = raw.select(
        *[c for c in raw.columns if c != "value"],
        text.alias("value"),
        F.from_json(text, MESSAGE, {"mode": "PERMISSIVE"}).alias("m"),
    ).select("*", "m.*").drop("m")
    if urgencia_alias:
        m = m.withColumn("nivel_urgencia", F.coalesce("nivel_urgencia", "urgencia"))
    at = parse_coordinates(F.col("ubicacion"))
    sides = F.array_compact(
        F.array(
            F.when(F.col("nivel_urgencia").isNotNull(), F.lit(True)),
            F.when(F.col("radio_disponible_km").isNotNull(), F.lit(False)),
        )
    )
    fault = (
        F.when(F.col("id").isNull(), "no id")
        .when(F.col("categoria").isNull(), "no categoria")
        .when(at.isNull(), "bad ubicacion")
        .when(F.size(sides) == 0, "neither request nor offer")
    )
    return (
        m.withColumns({"lat": at["lat"], "lon": at["lon"], "fault": fault})
        .withColumn("is_help", F.explode_outer(sides))
        .drop("urgencia")
    )


def sound(parsed: DataFrame) -> DataFrame:
    return parsed.filter("fault IS NULL").select(*PAYLOAD, "ts", "lat", "lon", "is_help")


def quarantine(parsed: DataFrame) -> DataFrame:
    """The raw text of what cannot be used, with the reason; a two-sided record has two rows."""
    return parsed.filter("fault IS NOT NULL").select("value", "ts", "fault")


_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def encode(df: DataFrame, columns=None, keep_nulls: bool = True, beside=()) -> DataFrame:
    """One JSON text ``value`` per row, next to the ``beside`` columns; letters stay as they are."""
    options = {"ignoreNullFields": str(not keep_nulls).lower(), "timestampNTZFormat": _ISO, "timestampFormat": _ISO}
    return df.select(F.to_json(F.struct(*(columns or df.columns)), options).alias("value"), *beside)


def encode_record(df: DataFrame, *beside: str) -> DataFrame:
    """A request or offer as a message: only the fields of its kind that are there."""
    return encode(df, PAYLOAD, keep_nulls=False, beside=beside)


def envelope(events: DataFrame) -> DataFrame:
    """Match events as a push service delivers them."""
    return events.select(F.base64(F.encode("value", "UTF-8")).alias("data"))


def decode_envelope(df: DataFrame) -> DataFrame:
    text = F.decode(F.unbase64("data"), "UTF-8")
    return df.select(F.from_json(text, MATCH_EVENT).alias("m")).select("m.*")
