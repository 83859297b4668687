"""Notification payloads for match rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts and colour of a notification.
TITLE = "¡Nuevo Match Realizado! 🤝"
COLOR = 3066993
CATEGORY = "Categoría"
DISTANCE = "Distancia"
URGENCY = "Nivel de Urgencia"
IN_NEED = "Persona que necesita ayuda"
VOLUNTEER = "Voluntario"
PERSON = "**Nombre:** %s\n**Población:** %s"
URGENCY_TEXT = "⚠️ %s"
DISTANCE_TEXT = "%.2f km"
FOOTER = "Match ID: %s"


def field_values(matched: DataFrame) -> DataFrame:
    """The texts that differ between notifications."""

    def person(side):
        return F.format_string(PERSON, F.col(f"{side}_nombre"), F.col(f"{side}_poblacion"))

    return matched.select(
        "match_id",
        F.col("categoria").alias("category_text"),
        F.format_string(DISTANCE_TEXT, F.col("distance")).alias("distance_text"),
        F.format_string(URGENCY_TEXT, F.col("urgencia").cast("string")).alias("urgency_text"),
        person("help").alias("help_text"),
        person("volunteer").alias("volunteer_text"),
        F.format_string(FOOTER, F.col("match_id")).alias("footer_text"),
    )


def payloads(matched: DataFrame) -> DataFrame:
    """One JSON message per match, ready to post."""

    def field(name, value, inline):
        return F.struct(F.lit(name).alias("name"), F.col(value).alias("value"), F.lit(inline).alias("inline"))

    embed = F.struct(
        F.lit(TITLE).alias("title"),
        F.lit(COLOR).alias("color"),
        F.array(
            field(CATEGORY, "category_text", True),
            field(DISTANCE, "distance_text", True),
            field(URGENCY, "urgency_text", True),
            field(IN_NEED, "help_text", False),
            field(VOLUNTEER, "volunteer_text", False),
        ).alias("fields"),
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(F.col("footer_text").alias("text")).alias("footer"),
    )
    return field_values(matched).select("match_id", F.to_json(F.struct(F.array(embed).alias("embeds"))).alias("value"))
