"""Names of places for coordinates, from a gazetteer table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.functions.geo import haversine, position
from aidmatch.functions.grid import CELL, LEVELS, diagonal_km, point_cells, within_circles
from aidmatch.workspace import checkpointed

# Order in which a place's names are tried, and the name without any.
FORM_PRECEDENCE = ["village", "town", "city"]
FORM_DEFAULT = "Desconocido"
GENERATOR_PRECEDENCE = ["city", "town", "village"]
GENERATOR_DEFAULT = ""

_TILE_LEVEL = 13  # cubes of 2 km
_TILE = ["tx", "ty", "tz"]


def place_name(precedence: list, default: str):
    """First non-empty name of a place."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in precedence], F.lit(default))


# Places in all lists of the tile index up to which it is broadcast, about 200 bytes each.
BROADCAST_PLACES = 200_000


def tile_index(tiles: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """For every tile (tx, ty, tz, c_pos) the places that can be nearest to a point of it, as ``places``.

    On every level of the grid one place stands for its cube; the nearest
    stand-in around a tile bounds how far the nearest place of any of its points
    can be, and only places within that bound are listed.
    """
    places = gazetteer.select(F.struct(*gazetteer.columns).alias("place"), position(F.col("lat"), F.col("lon")).alias("p_pos"))
    stand_ins = point_cells(places, "p_pos").groupBy(*CELL).agg(F.min("p_pos").alias("near"))
    bounds = (
        point_cells(tiles, "c_pos", LEVELS)
        .join(stand_ins, CELL)
        .groupBy(*_TILE)
        .agg(F.min("c_pos").alias("c_pos"), F.min(haversine(F.col("near"), F.col("c_pos"))).alias("bound"))
        .withColumn("reach", F.col("bound") + 2 * diagonal_km(_TILE_LEVEL))
    )
    return within_circles(places, bounds, []).groupBy(*_TILE).agg(F.collect_list(F.struct("p_pos", "place")).alias("places"))


def nearest_place(df: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Add the nearest place (all gazetteer columns as ``place``) and ``place_km`` to points with lat, lon.

    Rows are looked up one by one in an index from 2 km tiles to the places that
    can be nearest, so they are not shuffled as long as the index is small, and
    however many of them share a position. Rows without a position have no place.
    """
    at = position(F.col("lat"), F.col("lon"))
    placed = point_cells(df.withColumn("place_pos", at), "place_pos", [_TILE_LEVEL]).withColumnsRenamed(dict(zip(CELL[1:], _TILE))).drop("level")
    # Any of its points can speak for a tile: the others are at most a diagonal away.
    tiles = placed.filter("tx IS NOT NULL").groupBy(*_TILE).agg(F.min("place_pos").alias("c_pos"))
    index = checkpointed(tile_index(checkpointed(tiles), gazetteer))
    listed = index.agg(F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0]
    found = placed.join(F.broadcast(index) if listed <= BROADCAST_PLACES else index, _TILE, "left")
    near = F.array_min(F.transform("places", lambda p: F.struct(
        haversine(F.col("place_pos"), p["p_pos"]).alias("place_km"), p["place"]["place_id"].alias("id"), p["place"].alias("place"),
    )))
    return found.withColumn("near", near).select(*df.columns, "near.place_km", "near.place")


def with_place_name(df: DataFrame, gazetteer: DataFrame, precedence=FORM_PRECEDENCE, default=FORM_DEFAULT):
    """Add ``place_id``, ``place_km`` and ``place_name``; the default name where there is no place."""
    found = nearest_place(df, gazetteer)
    names = place_name([f"place.{c}" for c in precedence], default)
    return found.withColumns({"place_id": F.col("place.place_id"), "place_name": names}).drop("place")
