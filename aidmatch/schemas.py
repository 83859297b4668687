"""Record schemas, table columns and fixed value domains."""

from pyspark.sql import types as T

# The category domain.
CATEGORIES = [
    "Alimentos",
    "Medicamentos",
    "Limpieza",
    "Maquinaria",
    "Transporte",
    "Asistencia Social",
]

# Record limits and job constants.
URGENCY_RANGE = (1, 5)
RADIUS_RANGE = (1, 100)
PHONE_PATTERN = r"^[0-9]{9}\z"
MAX_ATTEMPTS = 5
WINDOW_LENGTH = "60 seconds"

HELP_FIELDS = [
    "id", "nombre", "ubicacion", "poblacion", "categoria",
    "descripcion", "created_at", "nivel_urgencia", "telefono",
]
VOLUNTEER_FIELDS = [
    "id", "nombre", "ubicacion", "poblacion", "categoria",
    "radio_disponible_km", "created_at",
]

# One record of either kind as it travels through the job.
PAYLOAD = [
    "id", "nombre", "ubicacion", "poblacion", "categoria", "descripcion",
    "created_at", "nivel_urgencia", "telefono", "radio_disponible_km", "attempts",
]

_TEXT = ["id", "nombre", "ubicacion", "poblacion", "categoria"]


def _struct(**fields):
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Incoming JSON message, either kind; ``attempts`` is absent on first arrival.
MESSAGE = _struct(
    **{n: T.StringType() for n in _TEXT},
    descripcion=T.StringType(),
    created_at=T.StringType(),
    nivel_urgencia=T.IntegerType(),
    telefono=T.StringType(),
    radio_disponible_km=T.IntegerType(),
    attempts=T.IntegerType(),
    urgencia=T.IntegerType(),
)

MATCHED_PAIRS = _struct(
    match_id=T.StringType(),
    categoria=T.StringType(),
    distance=T.DoubleType(),
    urgencia=T.LongType(),
    help_nombre=T.StringType(),
    help_ubicacion=T.StringType(),
    help_poblacion=T.StringType(),
    help_descripcion=T.StringType(),
    help_telefono=T.StringType(),
    help_created_at=T.TimestampType(),
    volunteer_nombre=T.StringType(),
    volunteer_ubicacion=T.StringType(),
    volunteer_poblacion=T.StringType(),
    volunteer_radio_disponible_km=T.LongType(),
    volunteer_created_at=T.TimestampType(),
)

UNMATCHED_REQUESTS = _struct(
    **{n: T.StringType() for n in _TEXT},
    descripcion=T.StringType(),
    created_at=T.TimestampType(),
    nivel_urgencia=T.LongType(),
    telefono=T.StringType(),
    insertion_stamp=T.TimestampType(),
    attempts=T.LongType(),
)

UNMATCHED_VOLUNTEERS = _struct(
    **{n: T.StringType() for n in _TEXT},
    radio_disponible_km=T.LongType(),
    created_at=T.TimestampType(),
    attempts=T.LongType(),
    insertion_stamp=T.TimestampType(),
)

# Match event as published: timestamps travel as text.
MATCH_EVENT = T.StructType([
    T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
    for f in MATCHED_PAIRS.fields
])

# The result tables by name, as schemas in text.
RESULT_TABLES = {
    name: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    for name, fields in (
        ("matched_pairs", MATCHED_PAIRS), ("unmatched_requests", UNMATCHED_REQUESTS), ("unmatched_volunteers", UNMATCHED_VOLUNTEERS),
    )
} | {"outcome_counts": "outcome string, total bigint"}
