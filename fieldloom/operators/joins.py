"""Joins and alignments that are more than an equi-join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from fieldloom.durable import durable
from fieldloom.functions.geo import wrap_lon
from fieldloom.operators.aggregates import with_next


def nearest_slot(df: DataFrame, time: str, slots: DataFrame, slot: str, out: str = "slot", bucket_seconds: int = 86_400) -> DataFrame:
    """``df`` with ``out``: the slot nearest in time, of two equally near the earlier; null times and an empty slot table give null.

    Between two slots the choice is known, so each interval of neighbouring slots is spread over the time buckets it
    touches and joined by bucket: an equi-join, whatever the sizes. Neighbouring slots come from range partitions.
    """
    s = with_next(slots.select(F.col(slot).cast("timestamp").alias("__a")), "__a", "__b")
    ends = {"__first": s.agg(F.unix_micros(F.min("__a"))).scalar(), "__last": s.agg(F.unix_micros(F.max("__a"))).scalar()}
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    bucket = lambda c: F.floor(micros(c) / (bucket_seconds * 1_000_000))
    s = s.filter("__b IS NOT NULL").select(micros("__a").alias("__a"), micros("__b").alias("__b"), F.explode(F.sequence(bucket("__a"), bucket("__b"))).alias("__k"))
    x = df.withColumns({"__t": micros(time), "__k2": bucket(time)})
    x = x.join(s, (F.col("__k2") == F.col("__k")) & (F.col("__t") >= F.col("__a")) & (F.col("__t") < F.col("__b")), "left").withColumns(ends)
    near = F.when(F.col("__t") - F.col("__a") <= F.col("__b") - F.col("__t"), F.col("__a")).otherwise(F.col("__b"))
    beyond = F.when(F.col("__t") < F.col("__first"), F.col("__first")).when(F.col("__t") >= F.col("__last"), F.col("__last"))
    chosen = F.timestamp_micros(F.coalesce(beyond, F.when(F.col("__a").isNotNull(), near)))
    return x.withColumn(out, chosen.cast("timestamp_ntz")).drop("__t", "__k", "__k2", "__a", "__b", "__first", "__last")


def _ancestor(code: Column, by: int) -> Column:
    """The cell ``by`` levels above a cell code (row in the upper, column in the lower 32 bits)."""
    return F.shiftleft(F.shiftright(F.shiftright(code, 32), by), 32).bitwiseOR(F.shiftright(code.bitwiseAND(F.lit(0xFFFFFFFF)), by))


def nearest_point(points: DataFrame, lat: str, lon: str, places: DataFrame, place_lat: str, place_lon: str, place_key: str, step: int = 3) -> DataFrame:
    """Distinct locations of ``points`` with the place nearest in plane degrees: lat, lon, place_key, distance.

    Of equally near places the smallest key wins. Both sides are put into one quadtree over the space they span, deep
    enough that its cells hold few places. The descent goes level by level over pairs of cells with their tight boxes: a
    cell of locations keeps those cells of places that may be as near as the best bound of any. Only the locations and
    places of the pairs left at the leaves are measured, so no task meets all places. Null and NaN coordinates take no part;
    without places the result is empty.
    """
    ok = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull() & ~F.isnan(F.col(a).cast("double")) & ~F.isnan(F.col(b).cast("double"))
    p = places.filter(ok(place_lat, place_lon)).groupBy(F.col(place_lat).cast("double").alias("py"), F.col(place_lon).cast("double").alias("px")).agg(F.min(place_key).alias("pk"))
    x = points.filter(ok(lat, lon)).select(F.col(lat).cast("double").alias("xy"), F.col(lon).cast("double").alias("xx")).distinct()
    p, x = durable(p), durable(x)
    ends = [t.agg(*[g(f"{s}{c}").alias(f"{n}{c}") for n, g in (("lo", F.min), ("hi", F.max)) for c in "yx"], F.count(F.lit(1)).alias("n")).first() for t, s in ((p, "p"), (x, "x"))]
    some = [e for e in ends if e["n"]] or [{"loy": 0.0, "lox": 0.0, "hiy": 0.0, "hix": 0.0}]
    low = {c: min(e[f"lo{c}"] for e in some) for c in "yx"}
    span = max(max(e[f"hi{c}"] for e in some) - low[c] for c in "yx") * (1 + 1e-9) or 1.0
    depth = min(24, 4 + int(math.log2(max(1, ends[0]["n"])) / 2))
    n = 1 << depth

    def leaves(t: DataFrame, s: str) -> DataFrame:
        cell = lambda c: F.least(F.floor((F.col(f"{s}{c}") - low[c]) / span * n), F.lit(n - 1)).cast("long")
        return t.withColumn(f"{s}c", F.shiftleft(cell("y"), 32).bitwiseOR(cell("x")))

    p, x = leaves(p, "p"), leaves(x, "x")
    box = lambda s: [f(f"{s}{c}").alias(f"{s}{k}{c}") for k, f in (("l", F.min), ("h", F.max)) for c in "yx"]
    tops = {s: durable(t.groupBy(f"{s}c").agg(*box(s))) for s, t in (("p", p), ("x", x))}

    def nodes(s: str, up: int, above: int) -> DataFrame:
        t = tops[s]
        if up:
            t = t.groupBy(_ancestor(F.col(f"{s}c"), up).alias(f"{s}c")).agg(*[f(f"{s}{k}{c}").alias(f"{s}{k}{c}") for k, f in (("l", F.min), ("h", F.max)) for c in "yx"])
        return t.withColumn(f"{s}u", _ancestor(F.col(f"{s}c"), above - up))

    gap = lambda c: F.greatest(F.lit(0.0), F.col(f"pl{c}") - F.col(f"xh{c}"), F.col(f"xl{c}") - F.col(f"ph{c}"))
    far = lambda c: F.greatest(F.abs(F.col(f"ph{c}") - F.col(f"xl{c}")), F.abs(F.col(f"xh{c}") - F.col(f"pl{c}")))
    pairs, above = points.sparkSession.range(1).select(F.col("id").alias("a"), F.col("id").alias("b")), depth
    for up in [*range(depth - (depth % step or step), 0, -step), 0]:
        met = pairs.join(nodes("x", up, above), F.col("a") == F.col("xu")).join(nodes("p", up, above), F.col("b") == F.col("pu"))
        met = met.select(F.col("xc").alias("a"), F.col("pc").alias("b"), (F.pow(gap("y"), 2) + F.pow(gap("x"), 2)).alias("near"), (F.pow(far("y"), 2) + F.pow(far("x"), 2)).alias("far"))
        best = F.min("far").over(W.partitionBy("a"))  # a cell's pairs are the few that its parent kept, times 4^step
        pairs, above = met.withColumn("bound", best).filter(F.col("near") <= F.col("bound") * (1 + 1e-12)).select("a", "b"), up
    pairs = durable(pairs)
    d = F.sqrt(F.pow(F.col("xy") - F.col("py"), 2) + F.pow(F.col("xx") - F.col("px"), 2))
    met = x.join(pairs, F.col("xc") == F.col("a")).join(p, F.col("b") == F.col("pc"))
    best = met.groupBy("xy", "xx").agg(F.min(F.struct(d.alias("d"), F.col("pk").alias("k"))).alias("m"))
    return best.select(F.col("xy").alias(lat), F.col("xx").alias(lon), F.col("m.k").alias(place_key), F.col("m.d").alias("distance"))


def cells_in_boxes(boxes: DataFrame, keys: list[str], lat0: str, lat1: str, lon0: str, lon1: str, step: float = 0.25) -> DataFrame:
    """Grid points within each box, edges included: keys, lat_idx, lon_idx (multiples of ``step``).

    A box whose west edge is east of its east edge goes across the date line. A box that holds no grid point gives the
    one nearest its centre. The cells are whole-number ranges, so that what follows is an equi-join on the cell.
    """
    c, n = F.col, 1 / step
    i0, i1 = F.ceil(c(lat0) * n).cast("int"), F.floor(c(lat1) * n).cast("int")
    east = F.when(c(lon1) < c(lon0), c(lon1) + 360.0).otherwise(c(lon1))
    j0, j1 = F.ceil(c(lon0) * n).cast("int"), F.floor(east * n).cast("int")
    mid_i, mid_j = F.rint((c(lat0) + c(lat1)) / 2 * n).cast("int"), F.rint((c(lon0) + east) / 2 * n).cast("int")
    some = (i1 >= i0) & (j1 >= j0)
    x = boxes.select(*keys, F.when(some, F.sequence(i0, i1)).otherwise(F.array(mid_i)).alias("__i"), F.when(some, F.sequence(j0, j1)).otherwise(F.array(mid_j)).alias("__j"))
    x = x.withColumn("lat_idx", F.explode("__i")).withColumn("lon_idx", F.explode("__j"))
    half = int(180 / step)
    return x.select(*keys, "lat_idx", F.when(c("lon_idx") >= half, c("lon_idx") - 2 * half).otherwise(c("lon_idx")).alias("lon_idx"))


def polygon_cells(polygons: DataFrame, keys: list[str], ring: str, step: float = 0.25) -> DataFrame:
    """Grid points inside each polygon: keys, lat_idx, lon_idx. ``ring``: array<struct<x double, y double>>, closed or not.

    The bounding box gives the candidate cells; each is tested by ray casting, as one expression over the ring. Points on a
    western or southern edge count as inside. Empty rings and null polygons have no cells.
    """
    c = F.col
    x = polygons.filter(F.size(ring) >= 3).withColumns({"__x0": F.array_min(F.transform(ring, lambda p: p["x"])), "__x1": F.array_max(F.transform(ring, lambda p: p["x"])), "__y0": F.array_min(F.transform(ring, lambda p: p["y"])), "__y1": F.array_max(F.transform(ring, lambda p: p["y"]))})
    n = 1 / step
    x = x.withColumns({"__a0": F.ceil(c("__y0") * n).cast("int"), "__a1": F.floor(c("__y1") * n).cast("int"), "__b0": F.ceil(c("__x0") * n).cast("int"), "__b1": F.floor(c("__x1") * n).cast("int")}).filter("__a1 >= __a0 AND __b1 >= __b0")
    x = x.withColumn("lat_idx", F.explode(F.sequence("__a0", "__a1"))).withColumn("lon_idx", F.explode(F.sequence("__b0", "__b1")))
    px, py = c("lon_idx") * step, c("lat_idx") * step
    edges = F.transform(ring, lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), F.element_at(ring, F.when(i + 1 < F.size(ring), i + 2).otherwise(F.lit(1)))["x"].alias("x2"), F.element_at(ring, F.when(i + 1 < F.size(ring), i + 2).otherwise(F.lit(1)))["y"].alias("y2")))
    crossings = F.aggregate(edges, F.lit(0), lambda a, e: a + F.when((e["y1"] > py) != (e["y2"] > py), F.when(px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"], 1).otherwise(0)).otherwise(0))
    return x.filter(crossings % 2 == 1).select(*keys, "lat_idx", "lon_idx")


def _crossings(edges: Column, px: Column, py: Column) -> Column:
    """How many edges (x1, y1, x2, y2) a ray to the east of the point crosses."""
    crossed = lambda e: ((e["y1"] > py) != (e["y2"] > py)) & (px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
    return F.aggregate(edges, F.lit(0), lambda a, e: a + F.when(crossed(e), 1).otherwise(0))


def points_in_regions(points: DataFrame, lat: str, lon: str, regions: DataFrame, key: str, rings: str, cell: float = 1.0) -> DataFrame:
    """``points`` joined to every region that contains them: their columns and ``key``.

    ``rings``: array<array<struct<x double, y double>>> of outer rings and holes, closed or not; by the even-odd rule a point
    in a hole is outside, and islands within holes are inside. Points on a western or southern edge are inside. A region is
    cut into cells of ``cell`` degrees once: a cell that no edge touches lies inside or outside as a whole, and the points of
    the inner ones are accepted untested; only in cells with edges is the point tested, against those edges that cross the
    cell's band of latitude. The join is an equi-join on the cell. Null and NaN coordinates and empty rings match nothing.
    """
    f = lambda c: F.floor(c / cell).cast("int")
    ring_edges = lambda r: F.transform(r, lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), F.element_at(r, F.when(i + 1 < F.size(r), i + 2).otherwise(F.lit(1)))["x"].alias("x2"), F.element_at(r, F.when(i + 1 < F.size(r), i + 2).otherwise(F.lit(1)))["y"].alias("y2")))
    edges = F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) >= 3), ring_edges))
    r = regions.select(F.col(key).alias("__key"), edges.alias("__e")).filter(F.size("__e") > 0)
    bound = lambda g, c: g(F.transform("__e", lambda e: e[c]))
    r = r.withColumn("__i", F.explode(F.sequence(f(bound(F.array_min, "y1")), f(bound(F.array_max, "y1")))))
    # The edges that cross the band of the row; only those can be crossed by a ray within it.
    south, north = F.col("__i") * cell, (F.col("__i") + 1) * cell
    r = r.withColumn("__e", F.filter("__e", lambda e: (F.greatest(e["y1"], e["y2"]) >= south) & (F.least(e["y1"], e["y2"]) <= north))).filter(F.size("__e") > 0)
    r = r.withColumn("__j", F.explode(F.sequence(f(F.array_min(F.transform("__e", lambda e: F.least(e["x1"], e["x2"])))), f(F.array_max(F.transform("__e", lambda e: F.greatest(e["x1"], e["x2"])))))))
    west, east = F.col("__j") * cell, (F.col("__j") + 1) * cell
    touched = F.exists("__e", lambda e: (F.greatest(e["x1"], e["x2"]) >= west) & (F.least(e["x1"], e["x2"]) <= east))
    whole = F.when(~touched, _crossings(F.col("__e"), (west + east) / 2, (south + north) / 2) % 2 == 1)
    r = r.withColumn("__in", whole).filter(F.col("__in").isNull() | F.col("__in"))
    r = r.select("__key", "__i", "__j", F.when(F.col("__in").isNull(), F.col("__e")).alias("__e"))
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    at = points.filter(y.isNotNull() & x.isNotNull() & ~F.isnan(y) & ~F.isnan(x)).withColumns({"__i": f(y), "__j": f(x)})
    met = at.join(r, ["__i", "__j"]).filter(F.col("__e").isNull() | (_crossings(F.col("__e"), x, y) % 2 == 1))
    return met.withColumn(key, F.col("__key")).drop("__i", "__j", "__e", "__key")


def points_in_boxes(points: DataFrame, lat: str, lon: str, boxes: DataFrame, key: str, lat0: str, lat1: str, lon0: str, lon1: str, cell: float = 1.0) -> DataFrame:
    """``points`` joined to every box that holds them, edges included; an equi-join on coarse cells and an exact test after it."""
    f = lambda c: F.floor(F.col(c) / cell)
    b = boxes.select(key, lat0, lat1, lon0, lon1).withColumn("__i", F.explode(F.sequence(f(lat0), f(lat1)))).withColumn("__j", F.explode(F.sequence(f(lon0), f(lon1))))
    x = points.withColumns({"__i": f(lat), "__j": f(lon)}).join(b, ["__i", "__j"])
    return x.filter(F.col(lat).between(F.col(lat0), F.col(lat1)) & F.col(lon).between(F.col(lon0), F.col(lon1))).drop("__i", "__j", lat0, lat1, lon0, lon1)


def normal_name(c: Column) -> Column:
    """Name for matching: outer blanks and letter case aside."""
    return F.lower(F.trim(c))


def semi_by_name(left: DataFrame, right: DataFrame, name: str, right_name: str) -> DataFrame:
    """Rows of ``left`` whose name is among those of ``right``; null names match nothing."""
    return left.withColumn("__n", normal_name(F.col(name))).join(right.select(normal_name(F.col(right_name)).alias("__n")), "__n", "left_semi").drop("__n")


def outer_merge(a: DataFrame, b: DataFrame, keys: list[str], digits: int = 4, suffix: str = "_b") -> DataFrame:
    """Full outer join on keys, numbers among them rounded first; clashing other columns of ``b`` get ``suffix``."""
    kinds = dict(a.dtypes)
    tidy = lambda d: d.withColumns({k: F.round(k, digits) for k in keys if kinds[k] in ("double", "float")})
    clash = [c for c in b.columns if c in a.columns and c not in keys]
    return tidy(a).join(tidy(b).withColumnsRenamed({c: c + suffix for c in clash}), keys, "full")


def star_defaults(fact: DataFrame, joins: list[tuple[DataFrame, str, str]], defaults: dict[str, object]) -> DataFrame:
    """``fact`` left-joined to each (dimension, fact key, dimension key), with defaults for what is absent."""
    for dim, k, dk in joins:
        fact = fact.join(dim.withColumnRenamed(dk, "__k"), F.col(k) == F.col("__k"), "left").drop("__k")
    return fact.fillna(defaults)


def keyed_update(target: DataFrame, changes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``target`` with ``value`` replaced where ``changes`` has one for the keys; of several the largest. Null keys match nothing."""
    new = changes.groupBy(*keys).agg(F.max(value).alias("__new"))
    return target.join(new, keys, "left").withColumn(value, F.coalesce("__new", value)).drop("__new")


def fingerprint(columns: list[str]) -> Column:
    """MD5 of the non-null values joined by an underscore."""
    return F.md5(F.concat_ws("_", *[F.col(c).cast("string") for c in columns]))


def new_rows(batch: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key isn't there yet; rows with a null key are new."""
    return batch.join(existing.select(key), key, "left_anti")


def upsert_distinct(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Both, without rows equal in all columns as trimmed text (null equals null); one of equal rows stays."""
    both = existing.unionByName(batch, allowMissingColumns=True)
    return both.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in both.columns]).distinct()


def media_pairs(images: DataFrame, sounds: DataFrame, key: str, image_order: str, sound_order: str, most: int = 3) -> DataFrame:
    """The first ``most`` pairs a key of image and sound, by image and then sound order: key, image_order, sound_order.

    The first pairs lie within the first ``most`` images and sounds of a key, so both sides are cut to these before the
    join and no key emits all pairs. ``most`` is the feature (a top-k), not a bound on the work.
    """
    cut = lambda d, o: d.filter(F.col(o).isNotNull()).withColumn("__r", F.row_number().over(W.partitionBy(key).orderBy(o))).filter(F.col("__r") <= most).drop("__r")
    w = W.partitionBy(key).orderBy(image_order, sound_order)
    return cut(images, image_order).join(cut(sounds, sound_order), key).withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= most).drop("__r")


def consecutive_pairs(times: DataFrame, time: str) -> DataFrame:
    """(t0, t1) of neighbouring distinct times; the last time has no pair, nulls don't count."""
    return with_next(times.select(F.col(time).alias("t0")), "t0", "t1").filter("t1 IS NOT NULL")


def wrapped(df: DataFrame, lon: str) -> DataFrame:
    """``df`` with longitudes in -180 <= x < 180."""
    return df.withColumn(lon, wrap_lon(F.col(lon)))


RANKS = ["phylum", "class", "order", "family", "genus"]


def taxonomy(records: DataFrame, sources: list[DataFrame], key: str, ranks: list[str] | None = None) -> DataFrame:
    """``records`` with every rank: from the first of ``sources`` (one table after the other, say eDNA before metadata) that has it
    for the key, else the record's own, else Unknown. Of several rows a key the least value of each rank counts."""
    ranks = ranks or RANKS
    own = [c for c in ranks if c in records.columns]
    x = records.withColumnsRenamed({c: f"__own_{c}" for c in own})
    for i, s in enumerate(sources):
        have = [c for c in ranks if c in s.columns]
        x = x.join(s.groupBy(key).agg(*[F.min(F.nullif(F.col(c).cast("string"), F.lit("Unknown"))).alias(f"__{i}_{c}") for c in have]), key, "left")
    pick = lambda c: F.coalesce(*[F.col(f"__{i}_{c}") for i, s in enumerate(sources) if c in s.columns], *([F.col(f"__own_{c}").cast("string")] if c in own else []), F.lit("Unknown"))
    return x.select(*[c for c in records.columns if c not in ranks], *[pick(c).alias(c) for c in ranks])


def country_lookup(df: DataFrame, code: str, countries: DataFrame) -> DataFrame:
    """``df`` with ``country``, ``continent`` and the country's box from a table (iso, country, continent, lat_lo, lat_hi, lon_lo, lon_hi), by code
    or by name, letter case and outer blanks aside; Unknown and null where there is none."""
    name = normal_name(F.col(code))
    c = countries.select(F.explode(F.array(normal_name(F.col("iso")), normal_name(F.col("country")))).alias("__k"), "iso", "country", "continent", "lat_lo", "lat_hi", "lon_lo", "lon_hi").filter("__k IS NOT NULL")
    c = c.groupBy("__k").agg(F.min(F.struct("iso", "country", "continent", "lat_lo", "lat_hi", "lon_lo", "lon_hi")).alias("__c"))
    x = df.withColumn("__k", name).join(c, "__k", "left").drop("__k")
    return x.select(*df.columns, "__c.iso", F.coalesce("__c.country", F.lit("Unknown")).alias("country"), F.coalesce("__c.continent", F.lit("Unknown")).alias("continent"), "__c.lat_lo", "__c.lat_hi", "__c.lon_lo", "__c.lon_hi")


def on_axis(df: DataFrame, column: str, axis: DataFrame, value: str, out: str = "idx") -> DataFrame:
    """``df`` with the place of ``column`` on an axis (rows of ``value`` and ``idx``), -1 where the axis doesn't have it."""
    a = axis.select(F.col(value).alias("__a"), F.col("idx").alias("__i"))
    return df.join(a, F.col(column) == F.col("__a"), "left").withColumn(out, F.coalesce("__i", F.lit(-1))).drop("__a", "__i")
