"""Geometry as a plain struct column, with predicates written as column expressions.

``struct<gtype string, srid int, parts array<array<array<struct<x double, y double>>>>>``

The nesting is part -> ring -> point: a point is one part with one ring of one
point, a line is one part with one ring, a polygon is one part with a shell and
its holes. The struct is written to Parquet, compared and grouped like any
other column. Only ring validity, ring repair and the WKB codec use an Arrow
UDF; they receive flat arrays of doubles.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS_TYPE = T.ArrayType(T.ArrayType(T.ArrayType(_POINT_TYPE)))
DEFAULT_SRID = 4326

# Geometry type names in order of their WKB code.
TYPE_NAMES = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def make_point(x: Column | str, y: Column | str, srid: int = DEFAULT_SRID) -> Column:
    """NULL when a coordinate is NULL."""
    px, py = _col(x).cast("double"), _col(y).cast("double")
    point = F.array(F.array(F.array(F.struct(px.alias("x"), py.alias("y")))))
    built = F.struct(F.lit("Point").alias("gtype"), F.lit(srid).alias("srid"), point.alias("parts"))
    return F.when(px.isNotNull() & py.isNotNull(), built)


def make_polygon(points: Column | str, srid: int = DEFAULT_SRID) -> Column:
    """A polygon with one shell from an array of ``struct<x, y>`` points."""
    shell = F.array(F.array(_col(points)))
    return F.struct(F.lit("Polygon").alias("gtype"), F.lit(srid).alias("srid"), shell.alias("parts"))


def from_geojson(c: Column | str, srid: int = DEFAULT_SRID) -> Column:
    """GeoJSON geometry text to the struct; unknown or unreadable types have no parts."""
    doc = F.from_json(_col(c), "type string, coordinates string")
    gtype, coords = doc["type"], doc["coordinates"]
    # Every type is brought to the nesting of a multi-polygon before one parse.
    wrapped = (
        F.when(gtype == "Point", F.concat(F.lit("[[["), coords, F.lit("]]]")))
        .when(gtype.isin("LineString", "MultiPoint"), F.concat(F.lit("[["), coords, F.lit("]]")))
        .when(gtype.isin("Polygon", "MultiLineString"), F.concat(F.lit("["), coords, F.lit("]")))
        .when(gtype == "MultiPolygon", coords)
    )
    nested = F.from_json(wrapped, "array<array<array<array<double>>>>")
    parts = F.transform(
        nested,
        lambda part: F.transform(
            part,
            lambda ring: F.transform(
                F.filter(ring, lambda p: F.size(p) >= 2),
                lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")),
            ),
        ),
    )
    points_apart = F.transform(F.flatten(F.flatten(parts)), lambda p: F.array(F.array(p)))
    rings_apart = F.transform(F.flatten(parts), lambda r: F.array(r))
    parts = (
        F.when(gtype == "MultiPoint", points_apart).when(gtype == "MultiLineString", rings_apart).otherwise(parts)
    )
    parts = F.filter(parts, lambda part: F.size(F.flatten(part)) > 0)
    built = F.struct(gtype.alias("gtype"), F.lit(srid).alias("srid"), parts.alias("parts"))
    return F.when(gtype.isNotNull(), built)


def points_of(g: Column | str) -> Column:
    return F.flatten(F.flatten(_col(g)["parts"]))


def is_unusable(g: Column | str) -> Column:
    """NULL or empty."""
    return _col(g).isNull() | (F.coalesce(F.size(points_of(g)), F.lit(0)) <= 0)


def srid_of(g: Column | str) -> Column:
    return _col(g)["srid"]


def type_name(g: Column | str) -> Column:
    """G1: type name with the ``ST_`` prefix."""
    return F.concat(F.lit("ST_"), _col(g)["gtype"])


def bare_type_name(g: Column | str) -> Column:
    """G1: upper-case bare type name."""
    return F.upper(_col(g)["gtype"])


def point_x(g: Column | str) -> Column:
    """G7."""
    return F.when(_col(g)["gtype"] == "Point", F.get(points_of(g), F.lit(0))["x"])


def point_y(g: Column | str) -> Column:
    """G7."""
    return F.when(_col(g)["gtype"] == "Point", F.get(points_of(g), F.lit(0))["y"])


def bounds(g: Column | str) -> Column:
    """Struct minx, miny, maxx, maxy."""
    pts = points_of(g)
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("minx"),
        F.array_min(ys).alias("miny"),
        F.array_max(xs).alias("maxx"),
        F.array_max(ys).alias("maxy"),
    )


def outside_world(g: Column | str) -> Column:
    """Some coordinate lies beyond lon +-180 or lat +-90."""
    b = bounds(g)
    return (b["minx"] < -180) | (b["maxx"] > 180) | (b["miny"] < -90) | (b["maxy"] > 90)


def geometry_key(g: Column | str) -> Column:
    """Equal exactly for geometries with equal type and coordinates."""
    return F.when(~is_unusable(g), F.md5(F.to_json(F.struct(_col(g)["gtype"], _col(g)["parts"]))))


def contains(g: Column | str, x: Column | str, y: Column | str) -> Column:
    """The point lies inside a polygon, its boundary excluded."""
    px, py = _col(x).cast("double"), _col(y).cast("double")
    parts = _col(g)["parts"]

    def segments(ring: Column) -> Column:
        n = F.size(ring)
        return F.arrays_zip(
            F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0))).alias("a"),
            F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(0))).alias("b"),
        )

    def crosses(s: Column) -> Column:
        a, b = s["a"], s["b"]
        straddles = (a["y"] > py) != (b["y"] > py)
        at_x = (b["x"] - a["x"]) * (py - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return straddles & F.coalesce(px < at_x, F.lit(False))

    def touches(s: Column) -> Column:
        a, b = s["a"], s["b"]
        cross = (b["x"] - a["x"]) * (py - a["y"]) - (b["y"] - a["y"]) * (px - a["x"])
        within = px.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & py.between(
            F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"])
        )
        return (cross == 0) & within

    in_part = lambda part: (F.size(F.filter(F.flatten(F.transform(part, segments)), crosses)) % 2) == 1
    inside = F.exists(parts, in_part)
    on_edge = F.exists(parts, lambda part: F.exists(F.flatten(F.transform(part, segments)), touches))
    # Cheap box test first: most candidates fail it without walking the rings.
    b = bounds(g)
    in_box = px.between(b["minx"], b["maxx"]) & py.between(b["miny"], b["maxy"])
    return F.when(px.isNotNull() & py.isNotNull() & _col(g).isNotNull(), in_box & inside & ~on_edge)


def _finite(g: Column | str) -> Column:
    limit = 1.7976931348623157e308
    return ~F.exists(
        points_of(g),
        lambda p: p["x"].isNull()
        | p["y"].isNull()
        | F.isnan(p["x"])
        | F.isnan(p["y"])
        | (F.abs(p["x"]) > limit)
        | (F.abs(p["y"]) > limit),
    )


def _polygonal(g: Column | str) -> Column:
    return _col(g)["gtype"].isin("Polygon", "MultiPolygon")


def _flat(g: Column | str, condition: Column) -> tuple[Column, Column, Column]:
    """Coordinates and ring sizes as flat arrays for an Arrow UDF, NULL where the condition fails."""
    pts = points_of(g)
    return (
        F.when(condition, F.transform(pts, lambda p: p["x"])),
        F.when(condition, F.transform(pts, lambda p: p["y"])),
        F.when(condition, F.transform(_col(g)["parts"], lambda part: F.transform(part, lambda r: F.size(r)))),
    )


def is_valid(g: Column | str) -> Column:
    """Finite coordinates, proper lines, closed rings that do not cross or collapse.

    Points and lines are tested by column expressions; polygons go to an Arrow
    UDF that works on whole batches, other rows pass it NULL.
    """
    geom = _col(g)
    linear = geom["gtype"].isin("LineString", "MultiLineString")
    lines_ok = F.forall(F.flatten(geom["parts"]), lambda r: F.size(F.array_distinct(r)) >= 2)
    plain = F.when(linear, _finite(g) & lines_ok).otherwise(_finite(g))
    return F.when(~is_unusable(g), F.coalesce(polygons_are_valid(*_flat(g, _polygonal(g))), plain))


# --- numpy helpers used inside Arrow batches --------------------------------


def _proper_crossings(
    x: np.ndarray, y: np.ndarray, owner: np.ndarray, first_only: bool = True, interiors_only: bool = False
):
    """Pairs of segments that meet anywhere but at a shared end point of neighbours.

    ``x, y`` hold segment ends as (n, 2); ``owner`` is the ring of a segment.
    Segments are swept in x order, so only pairs whose x ranges overlap are
    compared.
    """
    lo, hi = x.min(axis=1), x.max(axis=1)
    order = np.argsort(lo, kind="stable")
    lo_sorted = lo[order]
    found = []
    for k in range(len(order)):
        i = order[k]
        stop = np.searchsorted(lo_sorted, hi[i], side="right")
        js = order[k + 1 : stop]
        if not len(js):
            continue
        d1 = _turn(x[i, 0], y[i, 0], x[i, 1], y[i, 1], x[js, 0], y[js, 0])
        d2 = _turn(x[i, 0], y[i, 0], x[i, 1], y[i, 1], x[js, 1], y[js, 1])
        d3 = _turn(x[js, 0], y[js, 0], x[js, 1], y[js, 1], x[i, 0], y[i, 0])
        d4 = _turn(x[js, 0], y[js, 0], x[js, 1], y[js, 1], x[i, 1], y[i, 1])
        cross = (d1 * d2 < 0) & (d3 * d4 < 0)
        overlap = (d1 == 0) & (d2 == 0) & _collinear_overlap(x, y, i, js)
        touch = ~cross & ~overlap & ((d1 * d2 == 0) | (d3 * d4 == 0)) & _touch_inside(x, y, i, js, d1, d2, d3, d4)
        same = owner[js] == owner[i]
        bad = cross if interiors_only else cross | overlap | (touch & same)
        for j in js[bad]:
            found.append((int(min(i, j)), int(max(i, j))))
            if first_only:
                return found
    return found


def _turn(ax, ay, bx, by, px, py):
    return np.sign((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def _collinear_overlap(x, y, i, js):
    """Collinear segments sharing more than one point."""
    use_x = abs(x[i, 1] - x[i, 0]) >= abs(y[i, 1] - y[i, 0])
    v = x if use_x else y
    a0, a1 = min(v[i]), max(v[i])
    b0, b1 = v[js].min(axis=1), v[js].max(axis=1)
    return np.minimum(a1, b1) > np.maximum(a0, b0)


def _touch_inside(x, y, i, js, d1, d2, d3, d4):
    """An end of one segment lies strictly inside the other, or two non-neighbours meet."""

    def on(px, py, sx, sy):
        return (
            (px >= sx.min(axis=-1)) & (px <= sx.max(axis=-1)) & (py >= sy.min(axis=-1)) & (py <= sy.max(axis=-1))
        )

    xi, yi = x[i][None, :], y[i][None, :]
    hit = np.zeros(len(js), dtype=bool)
    hit |= (d1 == 0) & on(x[js, 0], y[js, 0], xi, yi)
    hit |= (d2 == 0) & on(x[js, 1], y[js, 1], xi, yi)
    hit |= (d3 == 0) & on(x[i, 0], y[i, 0], x[js], y[js])
    hit |= (d4 == 0) & on(x[i, 1], y[i, 1], x[js], y[js])
    chained = ((x[js, 0] == x[i, 1]) & (y[js, 0] == y[i, 1])) | ((x[js, 1] == x[i, 0]) & (y[js, 1] == y[i, 0]))
    return hit & ~chained


def _segments(x: np.ndarray, y: np.ndarray, sizes):
    """Segments of consecutive rings, zero-length ones left out."""
    sx, sy, owner, start = [], [], [], 0
    for r, n in enumerate(sizes):
        rx, ry = x[start : start + n], y[start : start + n]
        start += n
        keep = (rx[1:] != rx[:-1]) | (ry[1:] != ry[:-1])
        sx.append(np.stack([rx[:-1], rx[1:]], axis=1)[keep])
        sy.append(np.stack([ry[:-1], ry[1:]], axis=1)[keep])
        owner.append(np.full(int(keep.sum()), r))
    return np.concatenate(sx), np.concatenate(sy), np.concatenate(owner)


def _area(x: np.ndarray, y: np.ndarray) -> float:
    x0, y0 = x - x[0], y - y[0]
    return float(np.sum(x0[:-1] * y0[1:] - x0[1:] * y0[:-1]) / 2.0)


def _simple(x: np.ndarray, y: np.ndarray, part_sizes) -> bool:
    flat = [int(n) for part in part_sizes for n in part]
    start = 0
    for n in flat:
        if _area(x[start : start + n], y[start : start + n]) == 0.0:
            return False
        start += n
    if len(x) <= _SMALL_RING:
        if _short_rings_meet(x.tolist(), y.tolist(), flat):
            return False
    elif _proper_crossings(*_segments(x, y, flat)):
        return False
    return _holes_inside(x, y, part_sizes)


def _short_rings_meet(x: list[float], y: list[float], sizes: list[int]) -> bool:
    """The test of ``_proper_crossings`` for few segments, where plain floats beat small arrays."""
    segments, start = [], 0
    for ring, n in enumerate(sizes):
        for k in range(start, start + n - 1):
            if x[k] != x[k + 1] or y[k] != y[k + 1]:
                segments.append((ring, x[k], y[k], x[k + 1], y[k + 1]))
        start += n
    for i, (ri, ax, ay, bx, by) in enumerate(segments):
        for rj, cx, cy, ex, ey in segments[i + 1 :]:
            d1 = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
            d2 = (bx - ax) * (ey - ay) - (by - ay) * (ex - ax)
            d3 = (ex - cx) * (ay - cy) - (ey - cy) * (ax - cx)
            d4 = (ex - cx) * (by - cy) - (ey - cy) * (bx - cx)
            if d1 * d2 < 0 and d3 * d4 < 0:
                return True
            if d1 == 0 and d2 == 0:
                p, q, r, s = (ax, bx, cx, ex) if abs(bx - ax) >= abs(by - ay) else (ay, by, cy, ey)
                if min(max(p, q), max(r, s)) > max(min(p, q), min(r, s)):
                    return True
            if ri != rj or (cx == bx and cy == by) or (ex == ax and ey == ay):
                continue
            for d, px, py, (ux, uy, vx, vy) in (
                (d1, cx, cy, (ax, ay, bx, by)),
                (d2, ex, ey, (ax, ay, bx, by)),
                (d3, ax, ay, (cx, cy, ex, ey)),
                (d4, bx, by, (cx, cy, ex, ey)),
            ):
                if d == 0 and min(ux, vx) <= px <= max(ux, vx) and min(uy, vy) <= py <= max(uy, vy):
                    return True
    return False


def _holes_inside(x: np.ndarray, y: np.ndarray, part_sizes) -> bool:
    """Some vertex of every hole lies within its shell, no shell sits inside another part's shell."""
    if len(part_sizes) == 1 and len(part_sizes[0]) == 1:
        return True
    start, shells = 0, []
    for part in part_sizes:
        rings = []
        for n in part:
            rings.append((x[start : start + n], y[start : start + n]))
            start += n
        shells.append(rings)
    for rings in shells:
        sx, sy = rings[0]
        for hx, hy in rings[1:]:
            if not any(_within(sx, sy, px, py) for px, py in zip(hx, hy)):
                return False
    for i, a in enumerate(shells):
        for j, b in enumerate(shells):
            if i != j and all(_within(*b[0], px, py) for px, py in zip(*a[0])):
                in_hole = any(all(_within(hx, hy, px, py) for px, py in zip(*a[0])) for hx, hy in b[1:])
                if not in_hole:
                    return False
    return True


def _within(rx: np.ndarray, ry: np.ndarray, px: float, py: float) -> bool:
    ax, ay, bx, by = rx[:-1], ry[:-1], rx[1:], ry[1:]
    straddle = (ay > py) != (by > py)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (bx - ax) * (py - ay) / (by - ay) + ax
    return bool(np.sum(straddle & (px < at)) % 2)


def _valid_polygon(x: np.ndarray, y: np.ndarray, part_sizes) -> bool:
    if not (np.isfinite(x).all() and np.isfinite(y).all()):
        return False
    start = 0
    for part in part_sizes:
        for n in part:
            if n < 4 or x[start] != x[start + n - 1] or y[start] != y[start + n - 1]:
                return False
            start += n
    return _simple(x, y, part_sizes)


# Rings up to this many points are tested together, one array operation per batch.
_SMALL_RING = 40
_BLOCK_CELLS = 2_000_000


def _small_rings_valid(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Validity of many single rings of equal length, given as (rings, points)."""
    ok = np.isfinite(x).all(axis=1) & np.isfinite(y).all(axis=1) & (x[:, 0] == x[:, -1]) & (y[:, 0] == y[:, -1])
    n = x.shape[1] - 1
    if n < 3:
        return np.zeros(len(x), dtype=bool)
    x, y = np.where(ok[:, None], x, 0.0), np.where(ok[:, None], y, 0.0)
    dx, dy = x - x[:, :1], y - y[:, :1]
    ok &= np.sum(dx[:, :-1] * dy[:, 1:] - dx[:, 1:] * dy[:, :-1], axis=1) != 0
    # A repeated point makes an empty segment; such rings take the general path.
    i, j = np.triu_indices(n, k=1)
    ax, ay, bx, by = x[:, i], y[:, i], x[:, i + 1], y[:, i + 1]
    cx, cy, ex, ey = x[:, j], y[:, j], x[:, j + 1], y[:, j + 1]
    d1, d2 = _turn(ax, ay, bx, by, cx, cy), _turn(ax, ay, bx, by, ex, ey)
    d3, d4 = _turn(cx, cy, ex, ey, ax, ay), _turn(cx, cy, ex, ey, bx, by)

    def on(px, py, sx, sy, tx, ty):
        return (
            (px >= np.minimum(sx, tx)) & (px <= np.maximum(sx, tx)) & (py >= np.minimum(sy, ty)) & (py <= np.maximum(sy, ty))
        )

    cross = (d1 * d2 < 0) & (d3 * d4 < 0)
    touch = (
        ((d1 == 0) & on(cx, cy, ax, ay, bx, by))
        | ((d2 == 0) & on(ex, ey, ax, ay, bx, by))
        | ((d3 == 0) & on(ax, ay, cx, cy, ex, ey))
        | ((d4 == 0) & on(bx, by, cx, cy, ex, ey))
    )
    next_to = (j == i + 1) | ((i == 0) & (j == n - 1))
    # Neighbours share one end and may only fold back when they run along one line.
    line = (d1 == 0) & (d2 == 0)
    wide = np.abs(bx - ax) >= np.abs(by - ay)
    lo = np.maximum(np.where(wide, np.minimum(ax, bx), np.minimum(ay, by)), np.where(wide, np.minimum(cx, ex), np.minimum(cy, ey)))
    hi = np.minimum(np.where(wide, np.maximum(ax, bx), np.maximum(ay, by)), np.where(wide, np.maximum(cx, ex), np.maximum(cy, ey)))
    bad = np.where(next_to, line & (hi > lo), cross | touch)
    return ok & ~bad.any(axis=1)


@F.pandas_udf(T.BooleanType())
def polygons_are_valid(xs: pd.Series, ys: pd.Series, sizes: pd.Series) -> pd.Series:
    out = np.full(len(xs), None, dtype=object)
    by_length: dict[int, list[int]] = {}
    for k, (x, s) in enumerate(zip(xs, sizes)):
        if x is None:
            continue
        if len(s) == 1 and len(s[0]) == 1 and len(x) <= _SMALL_RING:
            by_length.setdefault(len(x), []).append(k)
        else:
            out[k] = _valid_polygon(np.asarray(x, float), np.asarray(ys[k], float), s)
    for n, rows in by_length.items():
        step = max(1, _BLOCK_CELLS // max(1, n * n))
        for start in range(0, len(rows), step):
            block = rows[start : start + step]
            x = np.stack([np.asarray(xs[k], float) for k in block])
            y = np.stack([np.asarray(ys[k], float) for k in block])
            repeated = ((x[:, 1:] == x[:, :-1]) & (y[:, 1:] == y[:, :-1])).any(axis=1)
            good = _small_rings_valid(x, y)
            for r, k in enumerate(block):
                out[k] = bool(_valid_polygon(x[r], y[r], sizes[k])) if repeated[r] else bool(good[r])
    return pd.Series(out, dtype=object)


def _clean_ring(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    ring = [p for k, p in enumerate(points) if k == 0 or p != points[k - 1]]
    if ring and ring[0] != ring[-1]:
        ring.append(ring[0])
    return ring


def _crossings(ring: list[tuple[float, float]]) -> list[tuple[int, int]]:
    """Pairs of segments that cross in their interiors; plain floats are quickest on short rings."""
    n = len(ring) - 1
    if n > _SMALL_RING:
        arr = np.asarray(ring, float)
        x = np.stack([arr[:-1, 0], arr[1:, 0]], axis=1)
        y = np.stack([arr[:-1, 1], arr[1:, 1]], axis=1)
        return _proper_crossings(x, y, np.zeros(len(x)), first_only=False, interiors_only=True)

    def turn(a, b, p) -> float:
        return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])

    found = []
    for i in range(n - 2):
        a, b = ring[i], ring[i + 1]
        for j in range(i + 2, n):
            p, q = ring[j], ring[j + 1]
            if turn(a, b, p) * turn(a, b, q) < 0 and turn(p, q, a) * turn(p, q, b) < 0:
                found.append((i, j))
    return found


def _split_at_crossing(ring: list[tuple[float, float]]) -> list[list[tuple[float, float]]]:
    """Two rings when exactly one pair of segments crosses, else the ring itself."""
    pairs = _crossings(ring)
    if len(pairs) != 1:
        return [ring]
    i, j = pairs[0]
    (ax, ay), (bx, by) = ring[i], ring[i + 1]
    (cx, cy), (dx, dy) = ring[j], ring[j + 1]
    den = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
    if den == 0:
        return [ring]
    t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / den
    at = (ax + t * (bx - ax), ay + t * (by - ay))
    inner = [at, *ring[i + 1 : j + 1], at]
    outer = [*ring[: i + 1], at, *ring[j + 1 :]]
    return [_clean_ring(outer), _clean_ring(inner)]


def _repair(x, y, part_sizes) -> list | None:
    """The repaired parts, None when nothing usable came out."""
    if not (np.isfinite(x).all() and np.isfinite(y).all()):
        return None
    start, parts = 0, []
    for part in part_sizes:
        rings = []
        for n in part:
            ring = _clean_ring(list(zip(map(float, x[start : start + n]), map(float, y[start : start + n]))))
            start += n
            if len(ring) >= 4 and len(set(ring)) >= 3:
                pieces = _split_at_crossing(ring)
                if len(pieces) > 1 or _area(*np.asarray(ring, float).T) != 0.0:
                    rings.append(pieces)
        if not rings:
            continue
        shell, holes = rings[0], [p[0] for p in rings[1:]]
        if len(shell) == 1:
            parts.append([shell[0], *holes])
        else:
            parts.extend([[piece] for piece in shell])
    if not parts:
        return None
    return [[[{"x": px, "y": py} for px, py in ring] for ring in part] for part in parts]


@F.pandas_udf(PARTS_TYPE)
def _repaired_parts(xs: pd.Series, ys: pd.Series, sizes: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else _repair(x, y, s) for x, y, s in zip(xs, ys, sizes)], dtype=object)


def make_valid(g: Column | str, valid: Column | None = None) -> Column:
    """Bounded repair of polygons; anything it cannot mend is returned unchanged.

    Closes rings, drops repeated points and collapsed rings, and splits a ring
    that crosses itself once into two parts. ``valid`` is the known outcome of
    ``is_valid`` for the row, if there is one.
    """
    geom = _col(g)
    ok = is_valid(g) if valid is None else valid
    parts = _repaired_parts(*_flat(g, ~ok & _polygonal(g)))
    gtype = F.when(F.size(parts) > 1, F.lit("MultiPolygon")).otherwise(F.lit("Polygon"))
    mended = F.struct(gtype.alias("gtype"), geom["srid"].alias("srid"), parts.alias("parts"))
    return F.when(parts.isNotNull(), mended).otherwise(geom)


# --- WKB codec (G8) ----------------------------------------------------------


def _wkb_encode(gtype: str, xs, ys, sizes) -> bytes | None:
    if gtype not in TYPE_NAMES:
        return None
    code = TYPE_NAMES.index(gtype) + 1
    out, pos = [], 0

    def coords(n: int) -> bytes:
        nonlocal pos
        flat = np.empty(2 * n)
        flat[0::2], flat[1::2] = xs[pos : pos + n], ys[pos : pos + n]
        pos += n
        return flat.astype("<f8").tobytes()

    for part in sizes:
        body = [struct.pack("<BI", 1, (code - 1) % 3 + 1)]
        if code in (1, 4):
            body.append(coords(1))
        elif code in (2, 5):
            body += [struct.pack("<I", part[0]), coords(part[0])]
        else:
            body.append(struct.pack("<I", len(part)))
            for n in part:
                body += [struct.pack("<I", n), coords(n)]
        out.append(b"".join(body))
    if code > 3:
        return struct.pack("<BII", 1, code, len(out)) + b"".join(out)
    return out[0] if out else None


def wkb_to_geojson(blob: bytes | None) -> str | None:
    """Two-dimensional geometry text of a WKB value; extra dimensions are dropped."""
    if not blob:
        return None
    pos = 0

    def header():
        nonlocal pos
        order = "<" if blob[pos] == 1 else ">"
        (raw,) = struct.unpack_from(order + "I", blob, pos + 1)
        pos += 5
        if raw & 0x20000000:  # an embedded SRID
            pos += 4
        dims = 2 + bool(raw & 0x80000000) + bool(raw & 0x40000000)
        kind = raw & 0x0FFFFFFF
        dims += {0: 0, 1: 1, 2: 1, 3: 2}[kind // 1000]
        return order, kind % 1000, dims

    def count(order):
        nonlocal pos
        (n,) = struct.unpack_from(order + "I", blob, pos)
        pos += 4
        return n

    def points(order, dims, n):
        nonlocal pos
        arr = np.frombuffer(blob, dtype=order + "f8", count=n * dims, offset=pos).reshape(n, dims)[:, :2]
        pos += 8 * n * dims
        return arr.tolist()

    def body(order, kind, dims):
        if kind == 1:
            p = points(order, dims, 1)[0]
            return [] if p[0] != p[0] else p
        if kind == 2:
            return points(order, dims, count(order))
        if kind == 3:
            return [points(order, dims, count(order)) for _ in range(count(order))]
        return [body(*header()) for _ in range(count(order))]

    order, kind, dims = header()
    if not 1 <= kind <= 6:
        return json.dumps({"type": "GeometryCollection", "coordinates": []})
    return json.dumps({"type": TYPE_NAMES[kind - 1], "coordinates": body(order, kind, dims)})


@F.pandas_udf(T.StringType())
def _wkb_text(blobs: pd.Series) -> pd.Series:
    return pd.Series([wkb_to_geojson(b) for b in blobs], dtype=object)


@F.pandas_udf(T.BinaryType())
def _wkb_bytes(gtype: pd.Series, xs: pd.Series, ys: pd.Series, sizes: pd.Series) -> pd.Series:
    return pd.Series(
        [None if x is None else _wkb_encode(g, x, y, s) for g, x, y, s in zip(gtype, xs, ys, sizes)], dtype=object
    )


def from_wkb(c: Column | str, srid: int = DEFAULT_SRID) -> Column:
    """WKB bytes to the struct."""
    return from_geojson(_wkb_text(_col(c)), srid)


def from_hex_wkb(c: Column | str, srid: int = DEFAULT_SRID) -> Column:
    """Hexadecimal WKB text to the struct."""
    return from_wkb(F.unhex(_col(c)), srid)


def to_wkb(g: Column | str) -> Column:
    """Little-endian WKB bytes."""
    return _wkb_bytes(_col(g)["gtype"], *_flat(g, ~is_unusable(g)))
