"""Nearest-centroid assignment (theta join, argmin of planar distance).

Each point gets the zone of its nearest centroid; distance is planar
Euclidean in the coordinates' own units (degrees for lat/lon).  Ties go to
the centroid with the smallest ``order`` (first in file order); a point
with a NULL coordinate gets ``missing_zone``; a centroid at distance
``max_distance`` or more is never assigned (NULL zone).

Two exact plans:

* **packed** (centroid table proven small): the centroids are packed into
  one array by a scalar subquery and every point takes ``array_min`` of
  (squared distance, order, zone) structs -- a narrow map over the points,
  no shuffle of the point side and no cross join.
* **tiles** (any size): the centroids are cut into tiles of equal count, by
  rank along x and, in each slice, by rank along y, so cells follow the data:
  no tile holds more than ``TILE`` centroids, however far away an outlier lies.
  Tiles are grouped the same way, level by level, up to one array of at
  most ``TOP`` boxes.  A point descends this tree: of the boxes it meets it
  keeps those that are not farther than the nearest far corner of any, which is
  exact, since the box with that corner holds a centroid at most that far.
  The point side is shuffled once per level below the top, as (point, box)
  rows, and once for the smallest distance.

A point far from all centroids meets few tiles, too: those whose near corner is
closer than the best far corner.  Only centroids that lie equally far from a
point (on a circle around it) cannot be told apart by boxes.

Both plans treat coordinates alike: NULL, NaN and infinite ones are missing
(for a centroid: it takes no part), and of centroids at one place only the
first in order is kept.  Points carry an id of our own, so their columns may
hold anything, repeated or NULL keys included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrolstat.operators.ranking import ranked
from patrolstat.session import written

# Centroids we accept to pack into one array shipped with every task; the
# packed plan costs one distance per (point, centroid), so it is kept for
# city-sized centroid tables and the tile plan takes over beyond.
DEFAULT_PACKED_CENTROIDS = 1024
# Centroids in a tile, boxes in a group, boxes in the array every point starts from.
TILE, GROUP_SIDE, TOP = 32, 8, 256


def _dist2(px: Column, py: Column, cx: Column, cy: Column) -> Column:
    dx, dy = cx - px, cy - py
    return dx * dx + dy * dy


def _finite(v: Column) -> Column:
    """``v`` as a double, NULL where it is NaN or infinite."""
    d = v.cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def _prepared(centroids: DataFrame, cx: str, cy: str, zone: str, order: str) -> DataFrame:
    c = centroids.select(_finite(F.col(cx)).alias("_cx"), _finite(F.col(cy)).alias("_cy"),
                         F.struct(F.col(order).alias("o"), F.col(zone).alias("z")).alias("_oz"))
    first = c.filter(F.col("_cx").isNotNull() & F.col("_cy").isNotNull()).groupBy("_cx", "_cy").agg(F.min("_oz").alias("_oz"))
    return first.select("_cx", "_cy", F.col("_oz.o").alias("_ord"), F.col("_oz.z").alias("_zone"))


def _finish(df: DataFrame, best: Column, px: Column, py: Column, out: str, distance_col: str | None,
            missing_zone, max_distance: float | None, keep: list[str]) -> DataFrame:
    ok = best.isNotNull()
    if max_distance is not None:
        ok = ok & (best.getField("d2") < F.lit(float(max_distance)) ** 2)
    missing = px.isNull() | py.isNull()
    zone = F.when(missing, F.lit(missing_zone)).when(ok, best.getField("zone"))
    cols = [*keep, zone.alias(out)]
    if distance_col:
        cols.append(F.when(~missing & ok, F.sqrt(best.getField("d2"))).alias(distance_col))
    return df.select(*cols)


def nearest_centroid(points: DataFrame, centroids: DataFrame, x: str, y: str,
                     cx: str, cy: str, zone: str, order: str, out: str = "zone",
                     distance_col: str | None = "distance", missing_zone=None,
                     max_distance: float | None = None, point_id: str | None = None,
                     max_packed: int = DEFAULT_PACKED_CENTROIDS,
                     tile: int = TILE, top: int = TOP) -> DataFrame:
    """Assign every point the zone of its nearest centroid (see module doc).

    ``point_id`` is accepted for callers that name a key; no plan relies on it.  ``tile`` and ``top``
    bound a tile's centroids and the boxes of the first array; they change no row.
    """
    cents = written(_prepared(centroids, cx, cy, zone, order))
    pts = points.withColumn("_px", _finite(F.col(x))).withColumn("_py", _finite(F.col(y)))
    n = cents.count()
    if n <= max_packed or n == 0:
        return _nearest_packed(pts, cents, out, distance_col, missing_zone, max_distance, list(points.columns))
    return _nearest_tiles(pts, cents, n, out, distance_col, missing_zone, max_distance, list(points.columns), tile, top)


def _pack(cents: DataFrame) -> DataFrame:
    return cents.agg(F.collect_list(F.struct("_cx", "_cy", "_ord", "_zone")).alias("c"))


def _best_of(cents: Column) -> Column:
    px, py = F.col("_px"), F.col("_py")
    return F.array_min(F.transform(cents, lambda c: F.struct(
        _dist2(px, py, c.getField("_cx"), c.getField("_cy")).alias("d2"),
        c.getField("_ord").alias("ord"), c.getField("_zone").alias("zone"))))


def _nearest_packed(pts, cents, out, distance_col, missing_zone, max_distance, keep):
    px, py = F.col("_px"), F.col("_py")
    # The subquery result is projected once as a column; the lambda reads that column.
    with_best = pts.withColumn("_cents", _pack(cents).scalar()) \
        .withColumn("_best", F.when(px.isNotNull() & py.isNotNull(), _best_of(F.col("_cents"))))
    return _finish(with_best, F.col("_best"), px, py, out, distance_col, missing_zone, max_distance, keep)


_BOX = ("x0", "x1", "y0", "y1")


def tiles(cents: DataFrame, n: int, tile: int = TILE) -> DataFrame:
    """The centroids in tiles of at most ``tile``: ``gx, gy`` (slice and place in it), box, ``members``.

    ``n`` is their number.  Slices have equal counts (to one), tiles are cut off each slice's order.
    """
    slices = max(1, round((n / tile) ** 0.5))
    by_x = ranked(cents, [F.col("_cx"), F.col("_cy")], rank="_place")
    # a string key: the ranking's groups are texts
    sliced = by_x.withColumn("_slice", F.expr(f"string(_place * {slices} div {n})"))
    by_y = ranked(sliced, [F.col("_cy"), F.col("_cx")], group="_slice", rank="_place_y")
    return (by_y.groupBy(F.col("_slice").cast("long").alias("gx"), F.expr(f"_place_y div {tile}").alias("gy"))
            .agg(F.min("_cx").alias("x0"), F.max("_cx").alias("x1"), F.min("_cy").alias("y0"), F.max("_cy").alias("y1"),
                 F.collect_list(F.struct("_cx", "_cy", "_ord", "_zone")).alias("members")))


def _grouped(level: DataFrame) -> DataFrame:
    """The next level up: groups of ``GROUP_SIDE`` x ``GROUP_SIDE`` boxes as ``boxes``, with the box around them."""
    return (level.groupBy(F.expr(f"gx div {GROUP_SIDE}").alias("ux"), F.expr(f"gy div {GROUP_SIDE}").alias("uy"))
            .agg(*[(F.min if c.endswith("0") else F.max)(c).alias(c) for c in _BOX],
                 F.collect_list(F.struct("gx", "gy", *_BOX)).alias("boxes"))
            .withColumnsRenamed({"ux": "gx", "uy": "gy"}))


def _kept(boxes: Column, limit: float | None) -> Column:
    """Of ``boxes`` those that may hold the nearest centroid of ``_px, _py``: ``(near, far, gx, gy)``."""
    px, py = F.col("_px"), F.col("_py")

    def measured(b: Column) -> Column:
        nx = F.greatest(b["x0"] - px, px - b["x1"], F.lit(0.0))
        ny = F.greatest(b["y0"] - py, py - b["y1"], F.lit(0.0))
        fx = F.greatest(F.abs(b["x0"] - px), F.abs(b["x1"] - px))
        fy = F.greatest(F.abs(b["y0"] - py), F.abs(b["y1"] - py))
        return F.struct((nx * nx + ny * ny).alias("near"), (fx * fx + fy * fy).alias("far"), b["gx"].alias("gx"), b["gy"].alias("gy"))

    found = F.transform(boxes, measured)
    return found if limit is None else F.filter(found, lambda m: m["near"] < F.lit(limit) ** 2)


def _nearest_tiles(pts, cents, n, out, distance_col, missing_zone, max_distance, keep, tile, top):
    """Exact search down the tree of boxes (equi joins on the boxes' places)."""
    limit = None if max_distance is None else float(max_distance)
    pts = written(pts.withColumn("_k", F.monotonically_increasing_id()))
    level = written(tiles(cents, n, tile))
    levels, boxes = [level], level.count()
    while boxes > top:
        levels.append(written(_grouped(levels[-1])))
        boxes = levels[-1].count()
    first = levels[-1].agg(F.collect_list(F.struct("gx", "gy", *_BOX)).alias("b"))
    open_ = pts.filter(F.col("_px").isNotNull() & F.col("_py").isNotNull()).select("_k", "_px", "_py") \
        .withColumn("_boxes", first.scalar()).withColumn("_kept", _kept(F.col("_boxes"), limit)).drop("_boxes")
    for lower in range(len(levels) - 1, -1, -1):
        # boxes nearer than the nearest far corner, one row each
        bound = F.array_min(F.transform("_kept", lambda m: m["far"]))
        rows = open_.withColumn("_far", bound).select("_k", "_px", "_py", F.explode(
            F.filter("_kept", lambda m: m["near"] <= F.col("_far"))).alias("_m"))
        rows = rows.select("_k", "_px", "_py", F.col("_m.gx").alias("gx"), F.col("_m.gy").alias("gy"))
        if lower == 0:
            break
        met = rows.join(levels[lower].select("gx", "gy", "boxes"), ["gx", "gy"]).withColumn("_kept", _kept(F.col("boxes"), limit))
        # the bound holds over all groups of a point
        open_ = met.groupBy("_k", "_px", "_py").agg(F.flatten(F.collect_list("_kept")).alias("_kept"))
    found = rows.join(levels[0].select("gx", "gy", "members"), ["gx", "gy"]).select("_k", _best_of(F.col("members")).alias("_c")) \
        .groupBy("_k").agg(F.min("_c").alias("_best"))
    joined = pts.join(found, on="_k", how="left")
    return _finish(joined, F.col("_best"), F.col("_px"), F.col("_py"), out, distance_col, missing_zone, max_distance, keep)
