"""Hand-made records and an independent greedy in plain Python."""

import math
from datetime import datetime, timedelta

from pyspark.sql import types as T

START = datetime(2024, 1, 1)

SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("ubicacion", T.StringType()),
    T.StructField("poblacion", T.StringType()),
    T.StructField("categoria", T.StringType()),
    T.StructField("descripcion", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("nivel_urgencia", T.IntegerType()),
    T.StructField("telefono", T.StringType()),
    T.StructField("radio_disponible_km", T.IntegerType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("is_help", T.BooleanType()),
    T.StructField("w", T.TimestampNTZType()),
])


def _row(id, lat, lon, at, cat, w, is_help, urgency=None, radius=None, attempts=None, nombre="Ana"):
    w = START + timedelta(minutes=w)
    lat, lon = round(lat, 6), round(lon, 6)
    return dict(
        id=id, nombre=nombre, ubicacion=f"{lat:.6f},{lon:.6f}", poblacion="Paiporta", categoria=cat,
        descripcion="agua" if is_help else None, created_at=START, nivel_urgencia=urgency,
        telefono="612345678" if is_help else None, radio_disponible_km=radius, attempts=attempts,
        ts=w + timedelta(seconds=at), lat=lat, lon=lon, is_help=is_help, w=w,
    )


def need(id, lat=39.4, lon=-0.4, urgency=3, at=0, cat="Limpieza", w=0, **more):
    return _row(id, lat, lon, at, cat, w, True, urgency=urgency, **more)


def offer(id, lat=39.4, lon=-0.4, radius=10, at=0, cat="Limpieza", w=0, **more):
    return _row(id, lat, lon, at, cat, w, False, radius=radius, **more)


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in SCHEMA) for r in rows], SCHEMA)


def km(a, b):
    p, q = map(math.radians, (a["lat"], b["lat"]))
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(
        math.radians(b["lon"] - a["lon"]) / 2
    ) ** 2
    return 6371 * 2 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))


def greedy(rows):
    """``{(w, cat, help, attempts): (volunteer, attempts, km)}``, leftover keys by side."""
    rows = [dict(t) for t in {tuple(r.items()) for r in rows}]
    matches, lost_helps, lost_volunteers = {}, [], []
    key = lambda r: (r["w"], r["categoria"], r["id"], r["attempts"])
    for group in {(r["w"], r["categoria"]) for r in rows}:
        mine = [r for r in rows if (r["w"], r["categoria"]) == group]
        queue = sorted((r for r in mine if r["is_help"]), key=lambda r: (-(r["nivel_urgencia"] or 0), r["ts"], r["id"]))
        pool = [r for r in mine if not r["is_help"]]
        served, used = set(), set()
        for h in queue:
            fits = [
                (km(v, h), v["ts"], v["id"], i) for i, v in enumerate(pool)
                if v["radio_disponible_km"] is not None and km(v, h) <= v["radio_disponible_km"]
            ]
            if fits:
                v = pool.pop(min(fits)[-1])
                matches[key(h)] = (v["id"], v["attempts"], round(km(v, h), 6))
                served.add(h["id"])
                used.add(v["id"])
            elif h["id"] not in served:
                lost_helps.append(key(h))
        lost_volunteers += [key(v) for v in pool if v["id"] not in used]
    return matches, sorted(lost_helps, key=str), sorted(lost_volunteers, key=str)


def collected(outcomes):
    """The same shape from the outcomes of the library."""
    matches, lost_helps, lost_volunteers = {}, [], []
    for r in outcomes.collect():
        h, v = r["help"], r["volunteer"]
        if h and v:
            at = (r["w"], r["categoria"], h["id"], h["attempts"])
            assert at not in matches
            matches[at] = (v["id"], v["attempts"], round(r["distance"], 6))
        elif h:
            lost_helps.append((r["w"], r["categoria"], h["id"], h["attempts"]))
        else:
            lost_volunteers.append((r["w"], r["categoria"], v["id"], v["attempts"]))
    return matches, sorted(lost_helps, key=str), sorted(lost_volunteers, key=str)
