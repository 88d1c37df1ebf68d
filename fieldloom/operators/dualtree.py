"""Distance join of two point sets by a dual-tree descent (problem 1).

Both sides are put into the same quadtree over latitude and longitude. A node is a cell with the tight
bounding box of its points. Pairs of nodes are tested level by level, as distributed joins of the pairs with
the children of either side: a pair whose boxes are farther apart than the radius is discarded, one whose boxes
lie wholly within it is accepted with all below it, and the rest is refined. Only the points of uncertain
leaf pairs are measured one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from fieldloom.durable import durable
from fieldloom.functions.geo import EARTH_RADIUS_KM, canonical_lon, haversine_km, is_location
from fieldloom.skew import hot_keys

#: Relative slack of the box bounds, far above rounding and far below any real distance; it only moves pairs to the exact test.
SLACK = 1e-9


def leaf_level(radius_km: float) -> int:
    """Deepest level, at which cells are about as high as the radius (at least 1, at most 24)."""
    half_turn = math.pi * EARTH_RADIUS_KM
    return max(1, min(24, int(math.log2(half_turn / max(radius_km, 1e-6)))))


def _points(df: DataFrame, key: str, lat: str, lon: str, level: int, side: str) -> DataFrame:
    n = 1 << level
    la, lo = F.col(lat).cast("double"), canonical_lon(F.col(lon).cast("double"))
    at = df.filter(F.col(key).isNotNull() & is_location(F.col(lat), F.col(lon))).select(F.col(key).alias(f"{side}_key"), la.alias(f"{side}_lat"), lo.alias(f"{side}_lon"))
    ix = F.least(F.floor((F.col(f"{side}_lon") + 180.0) / 360.0 * n), F.lit(n - 1)).cast("long")
    iy = F.least(F.floor((F.col(f"{side}_lat") + 90.0) / 180.0 * n), F.lit(n - 1)).cast("long")
    return at.withColumn(f"{side}_leaf", F.shiftleft(iy, 32).bitwiseOR(ix))


def _up(code: Column, by: int) -> Column:
    """Ancestor ``by`` levels above a cell code (row in the upper, column in the lower 32 bits)."""
    row, col = F.shiftright(code, 32), code.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(F.shiftright(row, by), 32).bitwiseOR(F.shiftright(col, by))


def _leaves(points: DataFrame, side: str) -> DataFrame:
    return points.groupBy(f"{side}_leaf").agg(F.min(f"{side}_lat").alias(f"{side}_s"), F.max(f"{side}_lat").alias(f"{side}_n"), F.min(f"{side}_lon").alias(f"{side}_w"), F.max(f"{side}_lon").alias(f"{side}_e"), F.count(F.lit(1)).alias(f"{side}_count"))


def _nodes(leaves: DataFrame, side: str, up: int, up_parent: int) -> DataFrame:
    """Nodes ``up`` levels above the leaves, each with the code of its ancestor ``up_parent`` levels above the leaves."""
    if up:
        leaves = leaves.groupBy(_up(F.col(f"{side}_leaf"), up).alias(f"{side}_leaf")).agg(*[f(f"{side}_{c}").alias(f"{side}_{c}") for f, c in ((F.min, "s"), (F.max, "n"), (F.min, "w"), (F.max, "e"), (F.sum, "count"))])
    return leaves.select(F.col(f"{side}_leaf").alias(f"{side}_node"), _up(F.col(f"{side}_leaf"), up_parent - up).alias(f"{side}_parent"), *[f"{side}_{c}" for c in "snwe"])


def _hav(deg: Column) -> Column:
    return F.pow(F.sin(F.radians(deg) / 2), 2)


def _bounds() -> tuple[Column, Column]:
    """Lower and upper bound of the haversine (sin² of half the angle) between two boxes."""
    c = {f"{s}{k}": F.col(f"{s}_{k}") for s in "ab" for k in "snwe"}
    lat_gap = F.greatest(F.lit(0.0), c["bs"] - c["an"], c["as"] - c["bn"])
    lat_far = F.greatest(F.abs(c["bn"] - c["as"]), F.abs(c["an"] - c["bs"]))
    gaps = [F.greatest(F.lit(0.0), c["bw"] + k - c["ae"], c["aw"] - c["be"] - k) for k in (-360.0, 0.0, 360.0)]
    lon_gap = F.least(*gaps, F.lit(180.0))
    lon_far = F.least(*[F.greatest(F.abs(c["be"] + k - c["aw"]), F.abs(c["ae"] - c["bw"] - k)) for k in (-360.0, 0.0, 360.0)], F.lit(180.0))
    low = {s: F.least(F.cos(F.radians(c[f"{s}s"])), F.cos(F.radians(c[f"{s}n"]))) for s in "ab"}
    high = {s: F.when(c[f"{s}s"] * c[f"{s}n"] <= 0, F.lit(1.0)).otherwise(F.greatest(F.cos(F.radians(c[f"{s}s"])), F.cos(F.radians(c[f"{s}n"])))) for s in "ab"}
    near = _hav(lat_gap) + F.greatest(F.lit(0.0), low["a"]) * F.greatest(F.lit(0.0), low["b"]) * _hav(lon_gap)
    far = _hav(lat_far) + high["a"] * high["b"] * _hav(lon_far)
    return near, far


def dual_tree_pairs(left: DataFrame, right: DataFrame, radius_km: float, left_key: str, right_key: str, left_at: tuple[str, str] = ("latitude", "longitude"), right_at: tuple[str, str] = ("latitude", "longitude"), step: int = 2, with_distance: bool = False) -> DataFrame:
    """Pairs (left_key, right_key) at most ``radius_km`` apart on the sphere, each pair once.

    ``left`` should be the smaller side. Points that are no location (null, NaN, out of range, exactly (0, 0))
    and null keys take no part. Both longitude conventions count, and distances go across the date line and the
    poles. Repeated rows give one pair. Empty tables give an empty result. ``with_distance`` adds ``distance_km``.
    Other columns of the inputs play no role, whatever their names. A cell that holds a large share of either
    side is split into chunks, so that no task gets all of it.
    """
    level = leaf_level(radius_km)
    limit = math.sin(min(radius_km / EARTH_RADIUS_KM, math.pi) / 2) ** 2
    a, b = _points(left, left_key, *left_at, level, "a"), _points(right, right_key, *right_at, level, "b")
    la, lb = durable(_leaves(a, "a")), durable(_leaves(b, "b"))
    ups = [*range(level - (level % step or step), 0, -step), 0]
    spark = left.sparkSession
    pairs = spark.range(1).select(F.col("id").alias("a_pair"), F.col("id").alias("b_pair"), F.lit(False).alias("sure"), F.lit(level).alias("up"))  # the two roots
    above = level
    near, far = _bounds()
    for up in ups:
        na, nb = _nodes(la, "a", up, above), _nodes(lb, "b", up, above)
        # A pair that is sure stays as it is, at its level; the others go on to their children.
        pairs = (
            pairs.join(na, (F.col("a_pair") == F.col("a_parent")) & ~F.col("sure"), "left").join(nb, (F.col("b_pair") == F.col("b_parent")) & ~F.col("sure"), "left")
            .filter(F.col("sure") | (near <= limit * (1 + SLACK) + 1e-18))
            .select(F.coalesce("a_node", "a_pair").alias("a_pair"), F.coalesce("b_node", "b_pair").alias("b_pair"), (F.col("sure") | (far <= limit * (1 - SLACK))).alias("sure"), F.when(F.col("sure"), F.col("up")).otherwise(F.lit(up)).alias("up"))
        )
        above = up
    pairs = durable(pairs)
    leaf_pairs = pairs.filter("up = 0").drop("up")
    for up in sorted(r["up"] for r in pairs.filter("up > 0").select("up").distinct().collect()):  # at most a row a level
        below = lambda t, s: t.select(F.col(f"{s}_leaf"), _up(F.col(f"{s}_leaf"), up).alias(f"{s}_above"))  # noqa: E731, B023
        whole = pairs.filter(F.col("up") == up).join(below(la, "a"), F.col("a_pair") == F.col("a_above")).join(below(lb, "b"), F.col("b_pair") == F.col("b_above"))
        leaf_pairs = leaf_pairs.unionByName(whole.select(F.col("a_leaf").alias("a_pair"), F.col("b_leaf").alias("b_pair"), "sure"))
    pairs = leaf_pairs
    hot = hot_keys(lb.withColumnRenamed("b_leaf", "b_pair"), ["b_pair"], "b_count", least=20_000)
    hot_a = hot_keys(la.withColumnRenamed("a_leaf", "a_pair"), ["a_pair"], "a_count", least=20_000).withColumnRenamed("__nsalt", "__asalt")
    of = lambda c: F.coalesce(F.col(c), F.lit(1))
    pairs = pairs.join(F.broadcast(hot), "b_pair", "left").join(F.broadcast(hot_a), "a_pair", "left").withColumn("chunk", F.explode(F.sequence(F.lit(0), of("__nsalt") - 1))).withColumn("a_chunk_", F.explode(F.sequence(F.lit(0), of("__asalt") - 1))).drop("__nsalt", "__asalt")
    left_points = a.select("a_key", "a_lat", "a_lon", "a_leaf").distinct().join(F.broadcast(hot_a.withColumnRenamed("a_pair", "a_leaf")), "a_leaf", "left").withColumn("a_chunk", F.pmod(F.xxhash64("a_key"), of("__asalt")).cast("int")).drop("__asalt")
    of_left = pairs.join(left_points, (F.col("a_pair") == F.col("a_leaf")) & (F.col("a_chunk_") == F.col("a_chunk"))).select("b_pair", "chunk", "sure", "a_key", "a_lat", "a_lon")
    split = b.join(F.broadcast(hot.withColumnRenamed("b_pair", "b_leaf")), "b_leaf", "left").withColumn("b_chunk", F.when(F.col("__nsalt").isNull(), 0).otherwise(F.pmod(F.xxhash64("b_key"), F.col("__nsalt").cast("long")).cast("int")))
    both = of_left.join(split, (F.col("b_pair") == F.col("b_leaf")) & (F.col("chunk") == F.col("b_chunk")))
    distance = haversine_km(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    both = both.filter(F.col("sure") | (distance <= radius_km))
    keys = [F.col("a_key").alias(left_key if left_key != right_key else f"left_{left_key}"), F.col("b_key").alias(right_key if left_key != right_key else f"right_{right_key}")]
    if with_distance:
        return both.groupBy(*keys).agg(F.min(distance).alias("distance_km"))
    return both.select(*keys).distinct()
