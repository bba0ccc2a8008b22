"""Spatial joins without an index.

Polygons are cut into grid cells once (``split_by_cell``): each (polygon, cell)
row holds only the polygon clipped to that cell, so a continent-sized water
polygon turns into many small rows instead of one hot row that every point
would have to be tested against.  Points carry one cell key.  The join is then
an equi join on the cell key plus a native point-in-polygon expression, which
Spark plans as a hash join (broadcast when the measured cell table is small,
shuffled with AQE skew splitting otherwise) -- never a nested-loop join.

For the semi join the cells are a hierarchical cover (``cover``): cells that no
edge reaches are merged into larger ones, and points in them skip the ring test.

Cutting is done per polygon in a ``mapInPandas`` task with numpy (recursive
halving of the cell range, Sutherland-Hodgman clipping), so the cost is
O(vertices x log(cells)) per polygon.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import crossings_sql, mercator_x, mercator_y, rings_from_mercator
from ..session import stash


# ---------------------------------------------------------------- numpy geometry helpers
def clip_ring(xs: np.ndarray, ys: np.ndarray, box: tuple[float, float, float, float]):
    """Sutherland-Hodgman clip of an open ring (no repeated last vertex) to a
    closed box.  Boundary points are kept (inclusive)."""
    xmin, ymin, xmax, ymax = box
    for axis, bound, ge in ((0, xmin, True), (0, xmax, False), (1, ymin, True), (1, ymax, False)):
        n = len(xs)
        if n == 0:
            break
        qx, qy = np.roll(xs, -1), np.roll(ys, -1)
        v, w = (xs, qx) if axis == 0 else (ys, qy)
        pin = v >= bound if ge else v <= bound
        qin = w >= bound if ge else w <= bound
        cross = pin != qin
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(cross, (bound - v) / np.where(cross, w - v, 1.0), 0.0)
        ix = xs + t * (qx - xs)
        iy = ys + t * (qy - ys)
        if axis == 0:
            ix = np.where(cross, bound, ix)
        else:
            iy = np.where(cross, bound, iy)
        ox = np.empty(2 * n)
        oy = np.empty(2 * n)
        keep = np.empty(2 * n, dtype=bool)
        ox[0::2], oy[0::2], keep[0::2] = xs, ys, pin
        ox[1::2], oy[1::2], keep[1::2] = ix, iy, cross
        xs, ys = ox[keep], oy[keep]
    return xs, ys


def ring_area(xs: np.ndarray, ys: np.ndarray) -> float:
    """Signed shoelace area of an open ring, taken around its first vertex for precision."""
    if len(xs) < 3:
        return 0.0
    x = xs - xs[0]
    y = ys - ys[0]
    return 0.5 * float(np.dot(x, np.roll(y, -1)) - np.dot(np.roll(x, -1), y))


def _open(rx, ry):
    rx = np.asarray(rx, dtype=float)
    ry = np.asarray(ry, dtype=float)
    if len(rx) > 1 and rx[0] == rx[-1] and ry[0] == ry[-1]:
        rx, ry = rx[:-1], ry[:-1]
    return rx, ry


def polygon_box_area(rings_x, rings_y, box) -> tuple[float, bool]:
    """Planar area of (polygon ∩ box), holes subtracted, and whether
    they intersect at all (boundary touch counts)."""
    total = 0.0
    hit = False
    for i, (rx, ry) in enumerate(zip(rings_x, rings_y)):
        ox, oy = _open(rx, ry)
        cx, cy = clip_ring(ox, oy, box)
        if len(cx) == 0:
            continue
        a = abs(ring_area(cx, cy))
        if i == 0:
            hit = True
            total += a
        else:
            total -= a
    return max(total, 0.0), hit


def split_polygon(rings_x, rings_y, cell: float, margin: float):
    """Cut one polygon into grid cells: yields (cx, cy, rings_x, rings_y, edges)
    where rings are the polygon clipped to the cell box grown by ``margin`` and
    edges are the original polygon edges that reach that box (for exact
    boundary tests)."""
    rings = [_open(rx, ry) for rx, ry in zip(rings_x, rings_y)]
    rings = [(x, y) for x, y in rings if len(x) >= 3]
    if not rings:
        return
    ex = []
    for x, y in rings:
        ex.append(np.stack([x, y, np.roll(x, -1), np.roll(y, -1)], axis=1))
    edges = np.concatenate(ex)
    allx = np.concatenate([x for x, _ in rings])
    ally = np.concatenate([y for _, y in rings])
    cx0, cx1 = math.floor(allx.min() / cell), math.floor(allx.max() / cell)
    cy0, cy1 = math.floor(ally.min() / cell), math.floor(ally.max() / cell)
    stack = [(cx0, cx1, cy0, cy1, rings, edges)]
    while stack:
        a0, a1, b0, b1, rs, es = stack.pop()
        if a0 == a1 and b0 == b1:
            yield a0, b0, rs, es
            continue
        if a1 - a0 >= b1 - b0:
            mid = (a0 + a1) // 2
            parts = [(a0, mid, b0, b1), (mid + 1, a1, b0, b1)]
        else:
            mid = (b0 + b1) // 2
            parts = [(a0, a1, b0, mid), (a0, a1, mid + 1, b1)]
        for p0, p1, q0, q1 in parts:
            box = (p0 * cell - margin, q0 * cell - margin, (p1 + 1) * cell + margin, (q1 + 1) * cell + margin)
            sub = []
            for x, y in rs:
                cx, cy = clip_ring(x, y, box)
                if len(cx) >= 3:
                    sub.append((cx, cy))
            if not sub:
                continue
            emask = ((np.maximum(es[:, 0], es[:, 2]) >= box[0]) & (np.minimum(es[:, 0], es[:, 2]) <= box[2])
                     & (np.maximum(es[:, 1], es[:, 3]) >= box[1]) & (np.minimum(es[:, 1], es[:, 3]) <= box[3]))
            stack.append((p0, p1, q0, q1, sub, es[emask]))


#: Cells of a side merged into one of the next level of a cover, and levels above the finest.
COVER_FACTOR, COVER_LEVELS = 4, 2


def cover_polygon(rings_x, rings_y, cell: float, margin: float):
    """A hierarchical cover of one polygon: yields (level, cx, cy, rings, edges).

    Cells of level k measure ``cell * COVER_FACTOR**k``.  A cell that no edge
    reaches lies wholly inside (rings and edges None) or outside (left out), so
    the inside of a large polygon is few large cells; only cells of level 0 meet
    its edges, with rings clipped to the cell grown by ``margin`` and the
    original edges near it.
    """
    rings = [_open(rx, ry) for rx, ry in zip(rings_x, rings_y)]
    rings = [(x, y) for x, y in rings if len(x) >= 3]
    if not rings:
        return
    edges = np.concatenate([np.stack([x, y, np.roll(x, -1), np.roll(y, -1)], axis=1) for x, y in rings])
    top = cell * COVER_FACTOR ** COVER_LEVELS
    span = [range(math.floor((edges[:, i].min() - margin) / top), math.floor((edges[:, i].max() + margin) / top) + 1) for i in (0, 1)]
    stack = [(COVER_LEVELS, cx, cy, rings, edges) for cx in span[0] for cy in span[1]]
    while stack:
        level, cx, cy, rs, es = stack.pop()
        side = cell * COVER_FACTOR ** level
        box = (cx * side - margin, cy * side - margin, (cx + 1) * side + margin, (cy + 1) * side + margin)
        near = es[(np.maximum(es[:, 0], es[:, 2]) >= box[0]) & (np.minimum(es[:, 0], es[:, 2]) <= box[2])
                  & (np.maximum(es[:, 1], es[:, 3]) >= box[1]) & (np.minimum(es[:, 1], es[:, 3]) <= box[3])]
        cut = [c for c in (clip_ring(x, y, box) for x, y in rs) if len(c[0]) >= 3]
        if not len(near):  # no edge here: each ring holds all of the cell or nothing of it
            if len(cut) % 2:
                yield level, cx, cy, None, None
        elif not level:
            yield 0, cx, cy, cut, near
        elif cut:
            stack += [(level - 1, cx * COVER_FACTOR + i, cy * COVER_FACTOR + j, cut, near) for i in range(COVER_FACTOR) for j in range(COVER_FACTOR)]


# ---------------------------------------------------------------- Spark operators
#: Pieces of polygons handed from Python to Spark at a time.
PIECES = 256

_PIECE_FIELDS = [
    T.StructField("_cx", T.LongType()), T.StructField("_cy", T.LongType()),
    T.StructField("_rx", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("_ry", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("_edges", T.ArrayType(T.ArrayType(T.DoubleType()))),
]


def _rings_xy(polygons: DataFrame, rings: str) -> DataFrame:
    return (polygons
            .withColumn("_rx", F.transform(F.col(rings), lambda r: F.transform(r, lambda p: p["x"])))
            .withColumn("_ry", F.transform(F.col(rings), lambda r: F.transform(r, lambda p: p["y"])))
            .drop(rings))


def _with_bounds(polygons: DataFrame, rings: str) -> DataFrame:
    """Polygons with ``_px0``.. ``_py1``, their bounds, and ``_rect``: whether they are one ring that is just these bounds."""
    def shape(polygon):
        points = F.flatten(polygon)
        xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
        ring = F.get(polygon, F.lit(0))
        at = lambda i, c: F.get(ring, F.lit(i))[c]
        turns = lambda a, b: (at(0, a) == at(1, a)) & (at(1, b) == at(2, b)) & (at(2, a) == at(3, a)) & (at(3, b) == at(0, b))
        closed = (F.size(ring) == 5) & (at(0, "x") == at(4, "x")) & (at(0, "y") == at(4, "y"))
        rect = (F.size(polygon) == 1) & closed & (turns("x", "y") | turns("y", "x"))
        return F.struct(F.array_min(xs).alias("_px0"), F.array_min(ys).alias("_py0"), F.array_max(xs).alias("_px1"),
                        F.array_max(ys).alias("_py1"), F.coalesce(rect, F.lit(False)).alias("_rect"))

    # the lambda names the polygon once: a filter on plain columns would make its rings anew for every corner it reads
    shaped = polygons.select("*", F.get(F.transform(F.array(F.col(rings)), shape), F.lit(0)).alias("_shape"))
    return shaped.select("*", "_shape.*").drop("_shape")


def _spread(polygons: DataFrame) -> DataFrame:
    """Polygons dealt to all cores: few of them fill one small file, yet cutting them is most of the work."""
    return polygons.repartition(4 * polygons.sparkSession.sparkContext.defaultParallelism)


def _cells(lo: str, hi: str, side: float):
    return F.explode(F.sequence(F.floor(F.col(lo) / F.lit(side)), F.floor(F.col(hi) / F.lit(side))))


def split_by_cell(polygons: DataFrame, cell_size: float, *, rings: str = "rings",
                  margin: float | None = None) -> DataFrame:
    """One row per (polygon, grid cell) it reaches: other columns of the polygon,
    ``_cx``/``_cy`` cell key, ``_rings`` clipped to the (grown) cell and
    ``_edges`` (original edges near the cell, ``struct(ax, ay, bx, by)``)."""
    if margin is None:
        margin = cell_size * 1e-3
    base = _rings_xy(polygons, rings)
    keep = [f for f in base.schema.fields if f.name not in ("_rx", "_ry")]
    schema = T.StructType(keep + _PIECE_FIELDS)
    names = [f.name for f in keep]

    def cut(batches):
        columns = names + ["_cx", "_cy", "_rx", "_ry", "_edges"]
        out = []
        for pdf in batches:
            for rec in pdf.to_dict("records"):
                for cx, cy, rs, es in split_polygon(rec["_rx"], rec["_ry"], cell_size, margin):
                    out.append((*[rec[n] for n in names], cx, cy, [np.append(x, x[0]) for x, _ in rs], [np.append(y, y[0]) for _, y in rs], list(es)))
                    if len(out) == PIECES:  # a polygon of many cells is handed on in parts
                        yield pd.DataFrame(out, columns=columns)
                        out = []
        if out:
            yield pd.DataFrame(out, columns=columns)

    pieces = base.mapInPandas(cut, schema)
    ring_structs = F.expr("transform(_rx, (rx, i) -> zip_with(rx, _ry[i], (a, b) -> named_struct('x', a, 'y', b)))")
    edge_structs = F.expr("transform(_edges, e -> named_struct('ax', e[0], 'ay', e[1], 'bx', e[2], 'by', e[3]))")
    return (pieces.withColumn("_rings", ring_structs).withColumn("_edge_list", edge_structs)
            .drop("_rx", "_ry", "_edges").withColumnRenamed("_edge_list", "_edges"))


def cover(polygons: DataFrame, cell_size: float, *, rings: str = "rings", margin: float | None = None) -> DataFrame:
    """(_level, _cx, _cy, _rings, _edges): the hierarchical cover of all polygons; null rings are cells wholly inside."""
    margin = cell_size * 1e-3 if margin is None else margin
    schema = T.StructType([T.StructField("_level", T.IntegerType()), *_PIECE_FIELDS])

    def cut(batches):
        out = []
        for pdf in batches:
            for rx, ry in zip(pdf["_rx"], pdf["_ry"]):
                for level, cx, cy, rs, es in cover_polygon(rx, ry, cell_size, margin):
                    out.append((level, cx, cy, None, None, None) if rs is None else
                               (level, cx, cy, [np.append(x, x[0]) for x, _ in rs], [np.append(y, y[0]) for _, y in rs], list(es)))
                    if len(out) == PIECES:
                        yield pd.DataFrame(out, columns=schema.names)
                        out = []
        if out:
            yield pd.DataFrame(out, columns=schema.names)

    pieces = _rings_xy(polygons.select(rings), rings).mapInPandas(cut, schema)
    return pieces.select("_level", "_cx", "_cy", F.expr("transform(_rx, (rx, i) -> zip_with(rx, _ry[i], (a, b) -> named_struct('x', a, 'y', b)))").alias("_rings"),
                         F.expr("transform(_edges, e -> named_struct('ax', e[0], 'ay', e[1], 'bx', e[2], 'by', e[3]))").alias("_edges"))


def _on_edges_sql(px: str, py: str, edges: str) -> str:
    return (f"exists({edges}, e -> (e.bx - e.ax) * ({py} - e.ay) = (e.by - e.ay) * ({px} - e.ax) "
            f"AND {px} BETWEEN least(e.ax, e.bx) AND greatest(e.ax, e.bx) "
            f"AND {py} BETWEEN least(e.ay, e.by) AND greatest(e.ay, e.by))")


_BOUNDS = ["_px0", "_py0", "_px1", "_py1"]

#: Boxes of at most so many cells a side are covered by Spark, with cells one level finer than those of other polygons.
BOX_CELLS, BOX_LEVEL = 4, -1


def _semi_pieces(polygons: DataFrame, cell_size: float, rings: str) -> DataFrame:
    """(_level, _cx, _cy, bounds, _rings, _edges): what a point may lie in, by cell.  Null bounds are cells wholly inside
    some polygon, null edges polygons that are just their bounds; rows that lie only in whole cells are left out."""
    margin, fine = cell_size * 1e-3, cell_size * float(COVER_FACTOR) ** BOX_LEVEL
    cells = lambda lo, hi: F.floor(F.col(hi) / F.lit(cell_size)) - F.floor(F.col(lo) / F.lit(cell_size))
    polys = _with_bounds(polygons.select(rings), rings)
    polys = polys.withColumn("_rect", F.coalesce(F.col("_rect") & (cells("_px0", "_px1") < BOX_CELLS) & (cells("_py0", "_py1") < BOX_CELLS), F.lit(False)))
    reach = (polys.where("_rect").select(*_BOUNDS).distinct()
             .withColumn("_cx", _cells("_px0", "_px1", fine)).withColumn("_cy", _cells("_py0", "_py1", fine)))
    spans = lambda c, lo, hi: (F.col(lo) <= F.col(c) * F.lit(fine) - F.lit(margin)) & (F.col(hi) >= (F.col(c) + 1) * F.lit(fine) + F.lit(margin))
    whole = spans("_cx", "_px0", "_px1") & spans("_cy", "_py0", "_py1")
    full = reach.where(whole).select("_cx", "_cy").distinct()
    edge = reach.where(~whole).join(full, ["_cx", "_cy"], "left_anti")
    up = lambda c: F.floor(F.col(c) / F.lit(COVER_FACTOR)).alias(c)
    other = cover(_spread(polys.where("NOT _rect")), cell_size, rings=rings, margin=margin)
    ends = [F.expr(f"concat(transform(flatten(_rings), p -> p.{c}), transform(_edges, e -> e.a{c}), transform(_edges, e -> e.b{c}))") for c in "xy"]
    other = other.select("*", *[m(e).alias(b) for b, m, e in zip(_BOUNDS, (F.array_min, F.array_min, F.array_max, F.array_max), ends * 2)])
    return (edge.select(up("_cx"), up("_cy"), *_BOUNDS).distinct().withColumn("_level", F.lit(0))
            .unionByName(full.withColumn("_level", F.lit(BOX_LEVEL)), allowMissingColumns=True)
            .unionByName(other, allowMissingColumns=True))


def points_in_polygons(points: DataFrame, polygons: DataFrame, *, lon: str = "lon", lat: str = "lat",
                       rings: str = "rings", polygon_crs: int = 4326, cell_size: float = 1.0,
                       how: str = "left_semi", salt: int = 1, id_col: str | None = None) -> DataFrame:
    """E8 (D4, D9): points inside or on the boundary of any polygon.

    ``how='left_semi'`` is the reference's ``EXISTS`` (each point at most once);
    ``how='inner'`` returns (point, polygon) pairs.  Polygons given in EPSG:3857
    are brought to 4326 vertex by vertex first (edges are straight in degrees).
    """
    polys = polygons
    if polygon_crs == 3857:
        polys = polys.withColumn(rings, rings_from_mercator(rings))
    elif polygon_crs != 4326:
        raise ValueError("polygon_crs must be 4326 or 3857")
    # the original edges settle the boundary, the clipped rings the inside: each is tested once
    inside = F.expr(f"({_on_edges_sql(lon, lat, '_edges')}) OR ({crossings_sql(lon, lat, '_rings')}) % 2 = 1")
    at = lambda c, side: F.floor(F.nanvl(F.col(c), F.lit(None).cast("double")) / F.lit(side))
    key = F.xxhash64(F.col(id_col)) if id_col else F.xxhash64(F.col(lon), F.col(lat))
    if how == "left_semi":
        # a point in a whole inside cell is keyed by that cell, any other by its finest cell: one key a point
        pieces = stash(_semi_pieces(polys, cell_size, rings))
        pts = points.withColumn("_plevel", F.lit(0)).withColumn("_pcx", at(lon, cell_size)).withColumn("_pcy", at(lat, cell_size))
        for level in (BOX_LEVEL, *range(1, COVER_LEVELS + 1)):
            side = cell_size * float(COVER_FACTOR) ** level
            full = pieces.where(F.col("_level") == level).select(F.col("_cx").alias("_fx"), F.col("_cy").alias("_fy")).distinct().withColumn("_full", F.lit(True))
            pts = pts.join(full, (at(lon, side) == F.col("_fx")) & (at(lat, side) == F.col("_fy")), "left")
            pts = (pts.withColumn("_plevel", F.when(F.col("_full"), level).otherwise(F.col("_plevel")))
                   .withColumn("_pcx", F.when(F.col("_full"), F.col("_fx")).otherwise(F.col("_pcx")))
                   .withColumn("_pcy", F.when(F.col("_full"), F.col("_fy")).otherwise(F.col("_pcy"))).drop("_fx", "_fy", "_full"))
        in_box = F.col(lon).between(F.col("_px0"), F.col("_px1")) & F.col(lat).between(F.col("_py0"), F.col("_py1"))
        cond = ((pts["_plevel"] == pieces["_level"]) & (pts["_pcx"] == pieces["_cx"]) & (pts["_pcy"] == pieces["_cy"])
                & F.when(F.col("_px0").isNotNull(), in_box & (F.col("_edges").isNull() | inside)).otherwise(F.lit(True)))
    else:
        pieces = split_by_cell(_spread(polys), cell_size, rings=rings)
        pts = points.withColumn("_pcx", at(lon, cell_size)).withColumn("_pcy", at(lat, cell_size))
        cond = (pts["_pcx"] == pieces["_cx"]) & (pts["_pcy"] == pieces["_cy"]) & inside
    if salt > 1:
        pts = pts.withColumn("_psalt", F.pmod(key, F.lit(salt)).cast("int"))
        pieces = pieces.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        cond = cond & (F.col("_psalt") == F.col("_salt"))
    return pts.join(pieces, cond, how).drop("_plevel", "_pcx", "_pcy", "_psalt", "_salt", "_level", "_cx", "_cy", "_rings", "_edges", *_BOUNDS)


_AREA_SCHEMA = T.StructType([T.StructField("area", T.DoubleType()), T.StructField("hit", T.BooleanType())])


@F.pandas_udf(_AREA_SCHEMA)
def _piece_box_area(rx: pd.Series, ry: pd.Series, x0: pd.Series, y0: pd.Series,
                    x1: pd.Series, y1: pd.Series) -> pd.DataFrame:
    areas, hits = [], []
    for a, b, p, q, r, s in zip(rx, ry, x0, y0, x1, y1):
        area, hit = (0.0, False) if a is None else polygon_box_area(a, b, (p, q, r, s))
        areas.append(area)
        hits.append(hit)
    return pd.DataFrame({"area": areas, "hit": hits})


def _scene_cells(scenes: DataFrame, key: str, box, cell_size_m: float) -> DataFrame:
    """(_k, _mx0.. _my1, _once, _sx, _sy, _cx, _cy): every scene's box in EPSG:3857 in each cell it reaches, with the box's
    first cell and whether its key comes once."""
    xmin, ymin, xmax, ymax = box
    sc = scenes.select(F.col(key).alias("_k"),
                       mercator_x(xmin).alias("_mx0"), mercator_y(ymin).alias("_my0"),
                       mercator_x(xmax).alias("_mx1"), mercator_y(ymax).alias("_my1"))
    sc = sc.where((F.col("_mx0") <= F.col("_mx1")) & (F.col("_my0") <= F.col("_my1")))
    return (sc.withColumn("_once", F.count(F.lit(1)).over(Window.partitionBy("_k")) == 1)
            .withColumn("_sx", F.floor(F.col("_mx0") / cell_size_m)).withColumn("_sy", F.floor(F.col("_my0") / cell_size_m))
            .withColumn("_cx", _cells("_mx0", "_mx1", cell_size_m)).withColumn("_cy", _cells("_my0", "_my1", cell_size_m)))


def _meet(sc: DataFrame, water: DataFrame):
    """Scene boxes and water rows of one cell whose bounds meet (merge join: cells hold many rows on both sides)."""
    cond = ((sc["_cx"] == water["_cx"]) & (sc["_cy"] == water["_cy"])
            & (water["_px0"] <= sc["_mx1"]) & (water["_px1"] >= sc["_mx0"])
            & (water["_py0"] <= sc["_my1"]) & (water["_py1"] >= sc["_my0"]))
    return sc.hint("merge"), water, cond


def _shared_bounds():
    """Area that a scene's box and the bounds of a water row share."""
    return ((F.least("_mx1", "_px1") - F.greatest("_mx0", "_px0")) * (F.least("_my1", "_py1") - F.greatest("_my0", "_py0")))


def _box_water(water: DataFrame, carry: list[str], cell_size_m: float) -> DataFrame:
    """Water polygons that are boxes, whole, in each cell they reach, with their first cell."""
    return (water.where("_rect").select(*carry, *_BOUNDS, *[c for c in water.columns if c == "_wonce"])
            .withColumn("_wx", F.floor(F.col("_px0") / cell_size_m)).withColumn("_wy", F.floor(F.col("_py0") / cell_size_m))
            .withColumn("_cx", _cells("_px0", "_px1", cell_size_m)).withColumn("_cy", _cells("_py0", "_py1", cell_size_m)))


def _areas_on_boxes(sc: DataFrame, boxes: DataFrame, carry: list[str]) -> DataFrame:
    """(_k, carried columns, area) once per scene and box of water that meet: in the cell of the corner where both begin."""
    sc, boxes, cond = _meet(sc, boxes)
    first = (sc["_cx"] == F.greatest("_sx", "_wx")) & (sc["_cy"] == F.greatest("_sy", "_wy"))
    return sc.join(boxes, cond & first).select("_k", *carry, _shared_bounds().alias("area"))


def _areas_on_pieces(sc: DataFrame, water: DataFrame, carry: list[str], rings: str, cell_size_m: float) -> DataFrame:
    """(_k, carried columns, area) for every scene and piece of other water that meet.  Only pieces that the edge of a
    scene's box cuts are clipped: one inside it has its own area, and one that fills its bounds (a cell of open water)
    the shared bounds."""
    pieces = split_by_cell(_spread(water.where(~F.col("_rect")).select(*carry, rings)), cell_size_m, rings=rings, margin=0.0)
    pieces = _with_bounds(pieces.select(*carry, "_cx", "_cy", "_rings"), "_rings")
    pieces = (_rings_xy(pieces, "_rings")
              .withColumn("_own", _piece_box_area("_rx", "_ry", *[F.lit(float(v)) for v in ("-inf", "-inf", "inf", "inf")])["area"]))
    sc, pieces, cond = _meet(sc, pieces)
    pairs = sc.join(pieces, cond)
    inside = ((F.col("_px0") >= F.col("_mx0")) & (F.col("_px1") <= F.col("_mx1"))
              & (F.col("_py0") >= F.col("_my0")) & (F.col("_py1") <= F.col("_my1")))
    plain = F.when(F.col("_rect"), _shared_bounds()).when(inside, F.col("_own"))
    pairs = pairs.select("_k", *carry, "_mx0", "_my0", "_mx1", "_my1", plain.alias("_plain"),
                         *[F.when(plain.isNull(), F.col(c)).alias(c) for c in ("_rx", "_ry")])
    return (pairs.withColumn("_a", _piece_box_area("_rx", "_ry", "_mx0", "_my0", "_mx1", "_my1"))
            .where(F.col("_plain").isNotNull() | F.col("_a.hit"))
            .select("_k", *carry, F.coalesce("_plain", "_a.area").alias("area")))


def water_area(scenes: DataFrame, water: DataFrame, *, key: str = "api_id",
               box=("xmin", "ymin", "xmax", "ymax"), rings: str = "rings",
               cell_size_m: float = 100_000.0) -> DataFrame:
    """E7 (D3, D6, D7, F2): per scene, the summed planar EPSG:3857 area of
    (scene box ∩ water polygon) over all water polygons touching the box
    (overlaps count twice, as in the reference); NULL when none touches.

    ``scenes``: key + lon/lat box; ``water``: polygons in EPSG:3857.  Water that
    is no box is cut into cells exactly (no margin) so per-cell areas simply add up.
    """
    sc, water = _scene_cells(scenes, key, box, cell_size_m), _with_bounds(water.select(rings), rings)
    areas = (_areas_on_boxes(sc, _box_water(water, [], cell_size_m), [])
             .unionByName(_areas_on_pieces(sc, water, [], rings, cell_size_m)))
    per_scene = areas.groupBy("_k").agg(F.sum("area").alias("water_area"))
    return scenes.join(per_scene, scenes[key] == per_scene["_k"], "left").drop("_k")


def scenes_on_water(scenes: DataFrame, water: DataFrame, *, key: str = "api_id", water_key: str = "id",
                    box=("xmin", "ymin", "xmax", "ymax"), rings: str = "rings", cell_size_m: float = 100_000.0) -> DataFrame:
    """(scene key, water key, area) of every scene box and water polygon that intersect, touching edges and corners
    included (area 0).  Arguments as in ``water_area``."""
    sc = _scene_cells(scenes, key, box, cell_size_m)
    water = (_with_bounds(water.select(water_key, rings), rings)
             .withColumn("_wonce", F.count(F.lit(1)).over(Window.partitionBy(water_key)) == 1))
    boxes, carry = _box_water(water, [water_key], cell_size_m), [water_key]
    # keys that come once meet once: their pairs are ready; pieces and repeated keys are summed
    ready = _areas_on_boxes(sc.where("_once"), boxes.where("_wonce"), carry)
    parts = (_areas_on_boxes(sc.where("NOT _once"), boxes, carry)
             .unionByName(_areas_on_boxes(sc.where("_once"), boxes.where("NOT _wonce"), carry))
             .unionByName(_areas_on_pieces(sc, water, carry, rings, cell_size_m)))
    return (ready.unionByName(parts.groupBy("_k", water_key).agg(F.sum("area").alias("area")))
            .select(F.col("_k").alias(key), water_key, "area"))
