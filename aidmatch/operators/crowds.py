"""Exclusive assignment of groups that are too large for one row.

A group falls into parts that cannot interact: cubes as wide as the widest circle,
linked where a volunteer's circle touches several of them. Parts of bounded size
are settled in one step each.

Larger parts are settled in rounds, all of them side by side. In a round the first
open requests of a part choose in turn, in one task, among the free volunteers
near them; since they are the first, what they get is final. Who is near is told by
counts: a cube with twice as many free volunteers whose circles span it as
requests that choose in it. A request that finds them all taken ends the round for
those behind it. A round settles up to ``BLOCK_REQUESTS`` requests of a part, so the number
of rounds grows with the crowd of the largest part only. (Blocks that propose side by side
and give way to each other were tried in simulations: where demand exceeds supply,
even two of them took 290 rounds for 8,300 requests.)
"""

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aidmatch.functions.geo import EARTH_RADIUS_KM
from aidmatch.functions.grid import CELL, LEVELS, circle_cells, diagonal_km, level_for, level_of, point_cells
from aidmatch.operators.parts import connected_parts
from aidmatch.workspace import checkpointed, scratch

# Requests and volunteers of a part that is settled in one step.
MAX_PART = 16_384
# Requests of a larger part that choose in one round.
BLOCK_REQUESTS = 1 << 19
# Seats of a cell of the search at most, and the levels of halves between two levels of boxes.
CELL_SEATS, FAN = 16, 4
# A search looks at so many boxes a level first, and this many times more while it finds too few, for a list of at most and at least so many seats.
BEAM, MORE, LIST, FEW = 4, 8, 32, 4
# Requests that are searched for at once; of those that ran out of their lists, the ones so near to their turn.
BLOCK, NEAR = 256, 64
# Seats that are compared at once.
MOST_LOOKS = 1 << 18
_SLACK_KM, _TIE_KM = 1e-5, 1e-7


class _Seats:
    """Free seats in a tree of boxes by place, so that a search reads the boxes near it only.

    A straight line through the Earth is cheap and rises with the distance; the distance itself
    is computed for seats that get onto a list.
    """

    def __init__(self, seats: list[np.ndarray], nth: np.ndarray):
        lat, lon = seats[0][nth], seats[1][nth]
        depth = max(0, int(np.ceil(np.log2(len(nth) / CELL_SEATS))))
        self.width = -(-len(nth) // (1 << depth))
        # halves of halves, by latitude and longitude in turn; the last seat fills up what is missing, as one that is taken
        order = np.minimum(np.arange(self.width << depth), len(nth) - 1)
        for level in range(depth):
            order = order.reshape(1 << level, -1)
            order = np.take_along_axis(order, np.argpartition((lat, lon)[level % 2][order], order.shape[1] // 2, axis=1), axis=1)
        order = order.ravel()
        real = np.zeros(len(order), dtype=bool)
        real[np.unique(order, return_index=True)[1]] = True
        #: Places in ``seats``, and where a place is here.
        self.nth = nth[order]
        self.at = np.zeros(len(seats[0]), dtype=np.int64)
        self.at[self.nth[real]] = np.flatnonzero(real)
        self.lat, self.lon, self.clat, self.radius = (c[self.nth] for c in seats)
        self.chord = np.where(real, _chord(self.radius), -1.0)
        self.xyz = np.stack(_place(self.lat, self.lon, self.clat))
        self.free = len(nth)
        sizes = [(1 << depth) >> (FAN * level) for level in range(depth // FAN + 1)]
        self.low, self.high = ([np.empty((3, n)) for n in sizes] for _ in range(2))
        self.middle, self.half = ([np.empty((3, n)) for n in sizes] for _ in range(2))
        self.most = [np.empty(n) for n in sizes]
        for level, n in enumerate(sizes):
            self._box(level, np.arange(n))

    def _box(self, level: int, node: np.ndarray):
        """Fit boxes to what is still free in them."""
        if level:
            inner = _children(node)
            low, high, most = self.low[level - 1][:, inner], self.high[level - 1][:, inner], self.most[level - 1][inner].max(axis=1)
        else:
            seat = node[:, None] * self.width + np.arange(self.width)
            chord = self.chord[seat]
            low, high = (np.where(chord >= 0, self.xyz[:, seat], empty) for empty in (np.inf, -np.inf))
            # the square of the line beyond which no circle reaches; a box without free seats reaches nothing
            most = chord.max(axis=1)
            most = np.where(most >= 0, (most + _SLACK_KM) ** 2, -1.0)
        low, high = low.min(axis=2), high.max(axis=2)
        self.low[level][:, node], self.high[level][:, node], self.most[level][node] = low, high, most
        low, high = (np.where(most >= 0, side, 0.0) for side in (low, high))
        self.middle[level][:, node], self.half[level][:, node] = (low + high) / 2, (high - low) / 2 + _TIE_KM

    def take(self, places: list[int]):
        seat = self.at[places]
        self.chord[seat] = -1.0
        self.free -= len(seat)
        node = np.unique(seat // self.width)
        for level in range(len(self.most)):
            self._box(level, node)
            node = np.unique(node >> FAN)

    def lists(self, lat: np.ndarray, lon: np.ndarray, clat: np.ndarray, sure: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each point the free seats that cover it, nearest first and the earlier of equally near ones.

        Where the lists start, their seats, and whether a list has all seats within ``sure`` km; else it
        has one at least, and any other is farther than those on it.
        """
        at, chord = _place(lat, lon, clat), _chord(sure)
        most, inner = (chord + _SLACK_KM) ** 2, np.maximum(chord - _SLACK_KM, 0.0) ** 2
        bound, open_, beam = np.full(len(lat), np.inf), np.arange(len(lat)), BEAM
        while len(open_):
            step, cut = max(1, MOST_LOOKS // (beam * max(self.width, 1 << FAN))), []
            for low in range(0, len(open_), step):
                some = open_[low:low + step]
                far, many, more = self._bounds([x[some, None] for x in at], most[some, None], inner[some, None], beam)
                enough = many >= (min(FEW, LIST) if beam == BEAM else 1)
                bound[some[enough]] = far[enough]
                cut.append(some[more & ~enough])
            open_, beam = np.concatenate(cut), beam * MORE
        whole = bound == np.inf
        ends = np.where(whole, most, (np.sqrt(bound) + 2 * _TIE_KM) ** 2)
        top = self.most[-1].shape[0]
        row, node = np.divmod(np.arange(len(lat) * top), top)
        for level in range(len(self.most) - 1, -1, -1):
            near = self._gaps(level, node, [x[row] for x in at]) <= ends[row]
            row, node = row[near], node[near]
            if level:
                row, node = np.repeat(row, 1 << FAN), _children(node).ravel()
        rows, seats, step = [row[:0]], [node[:0]], max(1, MOST_LOOKS // self.width)
        for low in range(0, len(row), step):
            own = row[low:low + step, None]
            seat = node[low:low + step, None] * self.width + np.arange(self.width)
            line, chord = self._lines(seat, [x[own] for x in at]), self.chord[seat]
            there = (chord >= 0) & (line <= (chord + _SLACK_KM) ** 2) & (line <= ends[own])
            rows.append(np.broadcast_to(own, there.shape)[there])
            seats.append(seat[there])
        row, seat = np.concatenate(rows), np.concatenate(seats)
        half = np.sin((lat[row] - self.lat[seat]) / 2) ** 2 + self.clat[seat] * clat[row] * np.sin((lon[row] - self.lon[seat]) / 2) ** 2
        far = EARTH_RADIUS_KM * 2 * np.arctan2(np.sqrt(half), np.sqrt(np.maximum(0.0, 1 - half)))
        # one as far as the bound may be one of several that are not all here
        fit = (far <= np.minimum(self.radius[seat], sure[row])) & (_chord(far) <= np.sqrt(bound[row]) + _TIE_KM)
        row, seat, far = row[fit], seat[fit], far[fit]
        order = np.argsort(far, kind="stable")
        order = order[np.argsort(row[order].astype(np.uint16), kind="stable")]
        if ((far[order[1:]] == far[order[:-1]]) & (row[order[1:]] == row[order[:-1]])).any():
            order = np.lexsort((self.nth[seat], far, row))
        return np.searchsorted(row[order], np.arange(len(lat) + 1)), self.nth[seat[order]], whole

    def _bounds(self, at: list[np.ndarray], most: np.ndarray, inner: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The square of a line for each point, within which seats surely cover it, their number, up to that of a list, and whether any box was left out."""
        cut = np.zeros(len(most), dtype=bool)
        node = np.broadcast_to(np.arange(len(self.most[-1])), (len(most), len(self.most[-1])))
        for level in range(len(self.most) - 1, -1, -1):
            if node.shape[1] > beam:
                gap = self._gaps(level, node, at)
                gap[gap > most] = np.inf
                near = np.argpartition(gap, beam, axis=1)
                cut |= np.take_along_axis(gap, near[:, beam:], axis=1).min(axis=1) < np.inf
                node = np.take_along_axis(node, near[:, :beam], axis=1)
            if level:
                node = _children(node).reshape(len(most), -1)
        seat = (node[:, :, None] * self.width + np.arange(self.width)).reshape(len(most), -1)
        line, chord = self._lines(seat, at), self.chord[seat] - _SLACK_KM
        line[(chord < 0) | (line > chord * chord) | (line > inner)] = np.inf
        if line.shape[1] > LIST:
            line = np.partition(line, LIST - 1, axis=1)[:, :LIST]
        found = line < np.inf
        return np.where(found, line, -1.0).max(axis=1), found.sum(axis=1), cut

    def _gaps(self, level: int, node: np.ndarray, at: list[np.ndarray]) -> np.ndarray:
        """Squares of the lines from points to boxes, infinite where no circle of a box can reach."""
        total = None
        for middle, half, x in zip(self.middle[level], self.half[level], at):
            gap = middle[node]
            gap -= x
            np.abs(gap, out=gap)
            gap -= half[node]
            np.maximum(gap, 0.0, out=gap)
            gap *= gap
            total = gap if total is None else np.add(total, gap, out=total)
        total[total > self.most[level][node]] = np.inf
        return total

    def _lines(self, seat: np.ndarray, at: list[np.ndarray]) -> np.ndarray:
        return sum((c[seat] - x) ** 2 for c, x in zip(self.xyz, at))


def _children(node: np.ndarray) -> np.ndarray:
    return (node << FAN)[..., None] + np.arange(1 << FAN)


def _chord(km):
    """The straight line under a distance, which is no longer than the Earth is wide."""
    return 2 * EARTH_RADIUS_KM * np.sin(np.minimum(km / (2 * EARTH_RADIUS_KM), np.pi / 2))


def _place(lat, lon, clat):
    return EARTH_RADIUS_KM * clat * np.cos(lon), EARTH_RADIUS_KM * clat * np.sin(lon), EARTH_RADIUS_KM * np.sin(lat)


def choose(requests: pd.DataFrame, seats: pd.DataFrame) -> np.ndarray:
    """Requests in turn take the nearest seat that covers them and is not taken.

    ``requests`` (req, rlat, rlon, clat, sure) come by req, ``seats`` (seat, rlat, rlon, clat,
    radius) by seat, so the earlier of two equally near ones wins. Seats within ``sure`` km of a
    request are all there. Returns positions in ``seats``, -1 for nobody; it ends before the
    first request that cannot be certain.
    """
    picks = np.full(len(requests), -1)
    asked = np.stack([requests[c].to_numpy(dtype=float) for c in ("rlat", "rlon", "clat", "sure")])
    columns = [seats[c].to_numpy(dtype=float) for c in ("rlat", "rlon", "clat", "radius")]
    unsure = (asked[3] < np.inf).tolist()
    free, taken, new = _Seats(columns, np.arange(len(seats))) if len(seats) else None, bytearray(len(seats)), []
    # lists of the next requests, which stay in order however many of their seats are taken
    lists, whole, ahead = {}, {}, 0
    for turn in range(len(requests)):
        while True:
            seat = next((s for s in lists.get(turn, ()) if not taken[s]), -1)
            if seat >= 0 or free is None or whole.get(turn):
                break
            # one search for those of the next requests that have no list or ran out of it
            if new:
                free.take(new)
                new = []
                if free.free < len(free.nth) // 2:
                    left = np.sort(free.nth[free.chord >= 0])
                    free = _Seats(columns, left) if len(left) else None
                    continue
            out = [k for k in range(turn, min(ahead, turn + NEAR)) if not whole[k] and all(taken[s] for s in lists[k])]
            more = max(ahead, min(len(requests), turn + BLOCK))
            out += range(ahead, more)
            ahead = more
            starts, found, all_ = free.lists(*asked[:, out])
            starts, found = starts.tolist(), found.tolist()
            for k, low, high, every in zip(out, starts, starts[1:], all_.tolist()):
                lists[k], whole[k] = found[low:high], every
        lists.pop(turn, None), whole.pop(turn, None)
        if seat >= 0:
            picks[turn] = seat
            taken[seat] = 1
            new.append(seat)
        elif unsure[turn]:
            return picks[:turn]
    return picks


def _settled(requests: pd.DataFrame, seats: pd.DataFrame) -> pd.DataFrame:
    """(req, seat) of what is settled; seat is null where nobody is left."""
    requests, seats = requests.sort_values("req"), seats.sort_values("seat")
    picks = choose(requests, seats)
    seat = pd.array(np.where(picks >= 0, seats["seat"].to_numpy()[picks] if len(seats) else 0, 0), dtype="Int64")
    seat[picks < 0] = pd.NA
    return pd.DataFrame({"req": requests["req"].to_numpy()[:len(picks)], "seat": seat})


def _flat(pos: str = "pos"):
    return [F.col(f"{pos}.{c}").alias(c) for c in ("rlat", "rlon", "clat")]


def _choices(asked: DataFrame, seats: DataFrame) -> DataFrame:
    """(req, seat) from requests (part, req, pos, sure) and the free seats (part, seat, pos, radius) near them."""
    requests = asked.select("part", "req", *_flat(), "sure").groupBy("part")
    others = seats.select("part", "seat", *_flat(), "radius").groupBy("part")
    return requests.cogroup(others).applyInPandas(_settled, "req bigint, seat bigint")


def parts_of(asking: DataFrame, seats: DataFrame, on: list[str], widest: float) -> tuple[DataFrame, DataFrame]:
    """``asking`` and ``seats`` with a ``part``; records of different parts cannot match, those that nobody can match are left out."""
    level = level_of(widest)
    cell = [*on, *CELL]
    placed = checkpointed(point_cells(asking, "pos", [level]))
    nodes = checkpointed(placed.groupBy(*cell).agg(F.min("req").alias("node")))
    touched = checkpointed(circle_cells(seats.select(*on, "seat", "pos", "radius"), "pos", "radius", level).join(nodes, cell).select("seat", "node"))
    own = checkpointed(touched.groupBy("seat").agg(F.min("node").alias("own")))
    links = touched.join(own, "seat").select(F.col("own").alias("a"), F.col("node").alias("b")).distinct()
    parts = connected_parts(links)  # a node touched by one seat is linked with itself at least
    named = checkpointed(nodes.join(parts, "node"))
    return (
        checkpointed(placed.join(named.drop("node"), cell).select("part", "req", "pos")),
        checkpointed(seats.join(own, "seat").join(parts, F.col("own") == F.col("node")).select("part", "seat", "pos", "radius")),
    )


def match_crowds(asking: DataFrame, seats: DataFrame, on: list[str], max_part: int = MAX_PART, block_requests: int = BLOCK_REQUESTS) -> DataFrame:
    """(req, seat) of every match.

    ``asking`` (on, req, pos) and ``seats`` (on, seat, pos, radius) are written
    tables; ``req`` rises in the order of choosing, ``seat`` in the order that
    decides between equally near ones.
    """
    widest = seats.agg(F.max("radius")).first()[0]
    nothing = seats.limit(0).select(F.col("seat").alias("req"), "seat")
    if widest is None:
        return nothing
    with scratch(asking.sparkSession) as keep:
        asking, seats = parts_of(asking, seats, on, widest)
        sizes = asking.select("part").unionAll(seats.select("part")).groupBy("part").agg(F.count("*").alias("records"))
        large = checkpointed(sizes.filter(F.col("records") > max_part).select("part"))
        # all of a bounded part meets at once
        final = _choices(
            asking.withColumn("sure", F.lit(float("inf"))).join(large, "part", "left_anti"), seats.join(large, "part", "left_anti")
        )
        settled = [checkpointed(final.filter("seat IS NOT NULL"))]
        if not large.isEmpty():
            settled += _rounds(asking.join(large, "part", "left_semi"), seats.join(large, "part", "left_semi"), widest, block_requests)
        return keep(reduce(DataFrame.unionByName, settled))


def with_reach(asked: DataFrame, free: DataFrame, widest: float) -> DataFrame:
    """Add ``sure`` to ``asked``, the distance within which a request looks: infinite if it has to look everywhere."""
    levels = [k for k in LEVELS if 2 * diagonal_km(k) < widest]
    if not levels:
        return asked.withColumn("sure", F.lit(float("inf")))
    diagonal = F.element_at(F.array(*[F.lit(diagonal_km(k)) for k in LEVELS]), F.col("level") + 1)
    cell = ["part", *CELL]
    near = point_cells(asked.select("part", "req", "pos"), "pos", levels)
    supply = point_cells(free, "pos", levels).filter(F.col("radius") >= diagonal).groupBy(*cell).agg(F.count("*").alias("free"))
    full = near.groupBy(*cell).agg(F.count("*").alias("asked")).join(supply, cell).filter("free >= 2 * asked + 8").select(*cell)
    # neighbours take from a cube as well, so look twice as far
    spans = near.join(full, cell).groupBy("req").agg(F.min(2 * diagonal).alias("span"))
    return asked.join(spans, "req", "left").withColumn("sure", F.coalesce("span", F.lit(float("inf")))).drop("span")


def _around(asked: DataFrame, free: DataFrame, widest: float) -> DataFrame:
    """The free seats in the cubes that the requests' searches touch; one row for a seat."""
    circles = asked.select("part", "pos", F.least("sure", F.lit(widest)).alias("reach"))
    levels = [row[0] for row in circles.select(level_for(F.col("reach"))).distinct().collect()]  # no more than the grid has
    cell = ["part", *CELL]
    cubes = circle_cells(circles, "pos", "reach").select(*cell).distinct()
    return point_cells(free, "pos", levels or LEVELS[:1]).join(cubes, cell, "left_semi").select(*free.columns).dropDuplicates(["seat"])


def _rounds(asking: DataFrame, seats: DataFrame, widest: float, block_requests: int) -> list[DataFrame]:
    """Tables (req, seat), one of each round."""
    first = Window.partitionBy("part").orderBy("req")
    still, free, settled = checkpointed(asking), checkpointed(seats), []
    while not still.isEmpty():
        # cut off before the shuffle as well
        asked = still.withColumn("turn", F.row_number().over(first)).filter(F.col("turn") <= block_requests).drop("turn")
        asked = checkpointed(with_reach(checkpointed(asked), free, widest))
        found = checkpointed(_choices(asked, _around(asked, free, widest)))
        settled.append(found.filter("seat IS NOT NULL"))
        with_seat = found.filter("seat IS NOT NULL").select("seat")
        still, free = checkpointed(still.join(found, "req", "left_anti")), checkpointed(free.join(with_seat, "seat", "left_anti"))
    return settled
