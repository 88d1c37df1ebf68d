"""Queries of grids, joins, aggregates, reshaping and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldloom.functions import geo
from fieldloom.functions import time as tm
from fieldloom.operators import aggregates as ag
from fieldloom.operators import grid as gr
from fieldloom.operators import joins as jn
from fieldloom.operators import reshape as rs
from fieldloom.plans.views import BOXES, CUBE, OBS, WIDE, YEARS, Register, boxes, cube, indicator_wide, obs
from fieldloom.sources.tables import table

query = Register()
r6 = lambda c: F.round(c, 6)
SLOT = "date_trunc('day', ts) + to_hours(least(18, ceil((hour(ts) * 60 + minute(ts) - 180) / 360.0)::INT * 6))"


@query(f"""WITH {OBS}, s AS (SELECT species, round_even(lat / 0.25, 0)::INT AS la, round_even(lon / 0.25, 0)::INT AS lo, {SLOT} AS slot, sum(dist) AS v FROM obs GROUP BY ALL)
SELECT species, count(*) AS cells, round(sum(v), 6) AS total, round(avg(v), 9) AS mean, round(stddev_pop(v), 9) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max FROM s GROUP BY species""")
def observation_cube_stats(spark: SparkSession, d: str) -> DataFrame:
    x = obs(spark, d).select("species", F.rint(F.col("lat") / 0.25).cast("int").alias("la"), F.rint(F.col("lon") / 0.25).cast("int").alias("lo"), tm.six_hour_slot(F.col("ts")).alias("slot"), "dist")
    v = x.groupBy("species", "la", "lo", "slot").agg(F.sum("dist").alias("v"))
    return v.groupBy("species").agg(F.count(F.lit(1)).alias("cells"), r6(F.sum("v")).alias("total"), F.round(F.avg("v"), 9).alias("mean"), F.round(F.stddev_pop("v"), 9).alias("std"), r6(F.min("v")).alias("min"), r6(F.max("v")).alias("max"))


@query(f"WITH {OBS} SELECT species, round_even(lat / 0.25, 0) * 0.25::DOUBLE AS lat, round_even(lon / 0.25, 0) * 0.25::DOUBLE AS lon, round(sum(dist), 6) AS total FROM obs GROUP BY ALL")
def grid_snap_sum(spark: SparkSession, d: str) -> DataFrame:
    return obs(spark, d).groupBy("species", geo.snap(F.col("lat")).alias("lat"), geo.snap(F.col("lon")).alias("lon")).agg(r6(F.sum("dist")).alias("total"))


@query(f"WITH {OBS} SELECT floor(lat / 0.25) * 0.25::DOUBLE + 0.125 AS lat_bin, count(*) AS n, round(avg(dist), 6) AS mean FROM obs GROUP BY ALL")
def grid_floor_bin_count(spark: SparkSession, d: str) -> DataFrame:
    return obs(spark, d).groupBy(geo.cell_centre(F.col("lat")).alias("lat_bin")).agg(F.count(F.lit(1)).alias("n"), r6(F.avg("dist")).alias("mean"))


@query(f"WITH {OBS} SELECT event_id, {SLOT} AS slot FROM obs")
def slot_6h(spark: SparkSession, d: str) -> DataFrame:
    return obs(spark, d).select("event_id", tm.six_hour_slot(F.col("ts")).cast("timestamp_ntz").alias("slot"))


@query(f"WITH {OBS}, x AS (SELECT event_id, lon * 7 AS l FROM obs) SELECT event_id, round(l - 360 * floor((l + 180) / 360), 6) AS wrapped, round(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END, 6) AS shifted FROM x JOIN obs USING (event_id)")
def wrap_longitude(spark: SparkSession, d: str) -> DataFrame:
    x = obs(spark, d)
    return x.select("event_id", r6(geo.wrap_lon(F.col("lon") * 7)).alias("wrapped"), r6(F.when(F.col("lon") < 0, F.col("lon") + 360).otherwise(F.col("lon"))).alias("shifted"))


@query(f"WITH {OBS} SELECT event_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM obs WHERE lat BETWEEN 40 AND 50.5 AND lon BETWEEN -10 AND 12.25 AND dist IS NOT NULL AND cls IN ('view', 'click')")
def bbox_filter(spark: SparkSession, d: str) -> DataFrame:
    x = gr.in_box(obs(spark, d), "lat", "lon", 40.0, 50.5, -10.0, 12.25).dropna(subset=["dist"]).filter(F.col("cls").isin("view", "click"))
    return x.select("event_id", r6("lat").alias("lat"), r6("lon").alias("lon"))


@query(f"WITH {OBS}, x AS (SELECT *, round_even((lat - 32) / 0.25, 0)::INT AS lat_idx, round_even((lon + 25) / 0.25, 0)::INT AS lon_idx FROM obs) SELECT lat_idx, lon_idx, arg_max(dist, (ts, event_id)) AS dist FROM x WHERE lat_idx BETWEEN 0 AND 160 AND lon_idx BETWEEN 0 AND 280 GROUP BY ALL")
def cell_index_scatter_last(spark: SparkSession, d: str) -> DataFrame:
    return gr.scatter(obs(spark, d), gr.MONTHLY, "lat", "lon", "dist", ["ts", "event_id"], "last")


@query(f"WITH {OBS}, x AS (SELECT *, 152 - round_even((lat - 34) / 0.25, 0)::INT AS lat_idx, round_even((lon + 30) / 0.25, 0)::INT AS lon_idx FROM obs) SELECT cls, lat_idx, lon_idx, arg_min(dist, (ts, event_id)) AS dist FROM x WHERE lat_idx BETWEEN 0 AND 152 AND lon_idx BETWEEN 0 AND 320 GROUP BY ALL")
def cell_first(spark: SparkSession, d: str) -> DataFrame:
    return gr.scatter(obs(spark, d), gr.DAILY, "lat", "lon", "dist", ["ts", "event_id"], "first", by=("cls",))


@query(f"WITH {OBS}, x AS (SELECT round_even((lat - 34) / 2, 0)::INT AS i, cls, sum(dist) AS v FROM obs GROUP BY ALL) SELECT a.i::INT AS lat_idx, c.cls, round(coalesce(v, 0), 6) AS total FROM range(25) a(i) CROSS JOIN (SELECT DISTINCT cls FROM obs) c LEFT JOIN x ON x.i = a.i AND x.cls = c.cls")
def grid_completion(spark: SparkSession, d: str) -> DataFrame:
    x = obs(spark, d).groupBy(geo.axis_index(F.col("lat"), 34.0, 2.0).alias("lat_idx"), "cls").agg(F.sum("dist").alias("total"))
    spine = obs(spark, d).select("cls").distinct().withColumn("lat_idx", F.explode(F.sequence(F.lit(0), F.lit(24))))
    return gr.complete(x, spine, ["lat_idx", "cls"], {"total": 0.0}).withColumn("total", r6("total"))


@query("SELECT (i // 321)::INT AS lat_idx, (i % 321)::INT AS lon_idx, 72 - (i // 321) * 0.25::DOUBLE AS latitude, -30 + (i % 321) * 0.25::DOUBLE AS longitude FROM range(153 * 321) t(i)")
def grid_axis_daily(spark: SparkSession, d: str) -> DataFrame:
    return gr.DAILY.spine(spark)


@query(f"WITH {OBS}, {CUBE}, s AS (SELECT DISTINCT time FROM cube), x AS (SELECT event_id, time, abs(epoch_us(ts) - epoch_us(time)) AS g FROM obs, s) SELECT event_id, arg_min(time, (g, time)) AS slot FROM x GROUP BY event_id")
def asof_nearest_slot(spark: SparkSession, d: str) -> DataFrame:
    return jn.nearest_slot(obs(spark, d), "ts", cube(spark).select("time"), "time").select("event_id", "slot")


@query(f"WITH {OBS}, {BOXES}, c AS (SELECT k, (lat_lo + lat_hi) / 2 AS la, (lon_lo + lon_hi) / 2 AS lo FROM boxes), x AS (SELECT event_id, k, sqrt(pow(lat - la, 2) + pow(lon - lo, 2)) AS g FROM obs, c) SELECT event_id, arg_min(k, (g, k)) AS k, round(min(g), 6) AS distance FROM x GROUP BY event_id")
def nearest_point(spark: SparkSession, d: str) -> DataFrame:
    places = boxes(spark, d).select("k", ((F.col("lat_lo") + F.col("lat_hi")) / 2).alias("la"), ((F.col("lon_lo") + F.col("lon_hi")) / 2).alias("lo"))
    o = obs(spark, d)
    near = jn.nearest_point(o, "lat", "lon", places, "la", "lo", "k")
    return o.join(near, ["lat", "lon"]).select("event_id", "k", r6("distance").alias("distance"))


@query(f"WITH {BOXES}, i AS (SELECT country, k, unnest(range(ceil(lat_lo * 4)::INT, floor(lat_hi * 4)::INT + 1)) AS lat_idx, lon_lo, lon_hi FROM boxes) SELECT country, lat_idx::INT AS lat_idx, unnest(range(ceil(lon_lo * 4)::INT, floor(lon_hi * 4)::INT + 1))::INT AS lon_idx FROM i")
def bbox_cells(spark: SparkSession, d: str) -> DataFrame:
    return jn.cells_in_boxes(boxes(spark, d), ["country"], "lat_lo", "lat_hi", "lon_lo", "lon_hi")


@query(f"WITH {BOXES}, {WIDE}, i AS (SELECT country, unnest(range(ceil(lat_lo)::INT, floor(lat_hi)::INT + 1)) AS lat_idx, lon_lo, lon_hi FROM boxes), c AS (SELECT country, lat_idx::INT AS lat_idx, unnest(range(ceil(lon_lo)::INT, floor(lon_hi)::INT + 1))::INT AS lon_idx FROM i) SELECT c.*, round(agri_1997, 2) AS agri_1997 FROM c JOIN indicator_wide USING (country)")
def bbox_broadcast_indicator(spark: SparkSession, d: str) -> DataFrame:
    cells = jn.cells_in_boxes(boxes(spark, d), ["country"], "lat_lo", "lat_hi", "lon_lo", "lon_hi", 1.0)
    return cells.join(indicator_wide(spark, d).select("country", "agri_1997"), "country")


@query(f"WITH {OBS}, {BOXES} SELECT event_id, country FROM obs JOIN boxes ON lat BETWEEN lat_lo AND lat_hi AND lon BETWEEN lon_lo AND lon_hi")
def points_in_country_boxes(spark: SparkSession, d: str) -> DataFrame:
    return jn.points_in_boxes(obs(spark, d), "lat", "lon", boxes(spark, d), "country", "lat_lo", "lat_hi", "lon_lo", "lon_hi", 5.0).select("event_id", "country")


@query(f"""WITH {BOXES}, g AS (SELECT country, a.i AS lat_idx, b.j AS lon_idx, lat_lo, lat_hi, lon_lo, lon_hi FROM boxes, range(30, 90) a(i), range(-30, 50) b(j)),
t AS (SELECT *, (lon_lo + lon_hi) / 2 AS mx FROM g WHERE lat_idx BETWEEN lat_lo AND lat_hi AND lon_idx BETWEEN lon_lo AND lon_hi)
SELECT country, lat_idx::INT AS lat_idx, lon_idx::INT AS lon_idx FROM t WHERE lat_idx >= lat_lo AND lat_idx < lat_hi
AND lon_idx >= lon_lo + (mx - lon_lo) * (lat_idx - lat_lo) / (lat_hi - lat_lo) AND lon_idx < lon_hi + (mx - lon_hi) * (lat_idx - lat_lo) / (lat_hi - lat_lo)""")
def polygon_cells(spark: SparkSession, d: str) -> DataFrame:
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    c = F.col
    tri = boxes(spark, d).withColumn("ring", F.array(p(c("lon_lo"), c("lat_lo")), p(c("lon_hi"), c("lat_lo")), p((c("lon_lo") + c("lon_hi")) / 2, c("lat_hi"))))
    return jn.polygon_cells(tri, ["country"], "ring", 1.0)


@query(f"WITH {WIDE} SELECT country, agri_1995 FROM indicator_wide WHERE lower(trim(country)) IN (SELECT lower(trim(n_name)) FROM nation WHERE n_regionkey IN (1, 3))")
def country_name_semi(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").filter(F.col("n_regionkey").isin(1, 3)).select(F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")).alias("name"))
    return jn.semi_by_name(indicator_wide(spark, d), n, "country", "name").select("country", "agri_1995")


@query(f"WITH {WIDE}, a AS (SELECT country, agri_1995 AS v FROM indicator_wide WHERE agri_1995 > 0), b AS (SELECT n_name AS country, n_regionkey::DOUBLE AS v FROM nation WHERE n_nationkey % 2 = 0) SELECT country, a.v, b.v AS v_ndvi FROM a FULL JOIN b USING (country)")
def outer_merge(spark: SparkSession, d: str) -> DataFrame:
    a = indicator_wide(spark, d).select("country", F.col("agri_1995").alias("v")).filter("v > 0")
    b = table(spark, d, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_name").alias("country"), F.col("n_regionkey").cast("double").alias("v"))
    return jn.outer_merge(a, b, ["country"], suffix="_ndvi")


@query("SELECT o_orderkey, coalesce(c_name, 'Unknown') AS c_name, coalesce(n_name, 'Unknown') AS n_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) c ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def star_default_join(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").filter("c_custkey % 3 <> 0").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return jn.star_defaults(table(spark, d, "orders").select("o_orderkey", "o_custkey"), [(c, "o_custkey", "c_custkey"), (n, "c_nationkey", "n_nationkey")], {"c_name": "Unknown", "n_name": "Unknown"}).select("o_orderkey", "c_name", "n_name")


@query(f"WITH {OBS}, u AS (SELECT species, round(lat, 0) AS la, max(dist) * 10 AS v FROM obs WHERE event_id % 5 = 0 GROUP BY ALL) SELECT event_id, round(coalesce(u.v, dist), 6) AS dist FROM obs LEFT JOIN u ON obs.species = u.species AND round(obs.lat, 0) = u.la")
def keyed_update(spark: SparkSession, d: str) -> DataFrame:
    o = obs(spark, d).withColumn("la", F.round("lat", 0))
    changes = o.filter("event_id % 5 = 0").select("species", "la", (F.col("dist") * 10).alias("dist"))
    return jn.keyed_update(o.select("event_id", "species", "la", "dist"), changes, ["species", "la"], "dist").select("event_id", r6("dist").alias("dist"))


@query("SELECT event_id, md5(concat_ws('_', user_id::VARCHAR, event_type, event_id::VARCHAR)) AS unique_id FROM events WHERE event_id % 4 <> 0")
def anti_join_append(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", jn.fingerprint(["user_id", "event_type", "event_id"]).alias("unique_id"))
    return jn.new_rows(e, e.filter("event_id % 4 = 0"), "unique_id")


@query("SELECT DISTINCT event_type, (user_id % 10)::VARCHAR AS u FROM events")
def upsert_distinct(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_type", (F.col("user_id") % 10).alias("u"))
    return jn.upsert_distinct(e.filter("u < 7"), e.filter("u > 3").withColumn("event_type", F.concat("event_type", F.lit(" "))))


@query(f"""WITH {OBS}, a AS (SELECT * FROM obs WHERE cls = 'view'), b AS (SELECT * FROM obs WHERE cls = 'click'),
x AS (SELECT a.species, a.event_id AS image, b.event_id AS sound, (a.lat + b.lat) / 2 AS lat, (a.lon + b.lon) / 2 AS lon, make_timestamp((epoch_us(a.ts) + epoch_us(b.ts)) // 2) AS ts, row_number() OVER (PARTITION BY a.species ORDER BY a.event_id, b.event_id) AS r FROM a JOIN b USING (species))
SELECT species, image, sound, round(lat, 6) AS lat, round(lon, 6) AS lon, ts FROM x WHERE r <= 3""")
def media_cross_top3(spark: SparkSession, d: str) -> DataFrame:
    o = obs(spark, d)
    one = lambda cls, k: o.filter(F.col("cls") == cls).select("species", F.col("event_id").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("lat", "lon", "ts")])
    x = jn.media_pairs(one("view", "image"), one("click", "sound"), "species", "image", "sound")
    mid = lambda c: r6((F.col(f"{c}_image") + F.col(f"{c}_sound")) / 2).alias(c)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return x.select("species", "image", "sound", mid("lat"), mid("lon"), F.timestamp_micros(F.floor((micros("ts_image") + micros("ts_sound")) / 2)).cast("timestamp_ntz").alias("ts"))


@query(f"WITH {CUBE} SELECT time AS t0, lead(time) OVER (ORDER BY time) AS t1 FROM (SELECT DISTINCT time FROM cube) QUALIFY t1 IS NOT NULL")
def consecutive_pairs(spark: SparkSession, d: str) -> DataFrame:
    return jn.consecutive_pairs(cube(spark), "time")


@query(f"WITH {WIDE} SELECT country, split_part(k, '_', 1) AS variable, right(k, 4)::INT AS year, NULL::INT AS month, v AS value FROM (UNPIVOT indicator_wide ON COLUMNS(* EXCLUDE country) INTO NAME k VALUE v)")
def unpivot_years(spark: SparkSession, d: str) -> DataFrame:
    return rs.unpivot_periods(indicator_wide(spark, d), ["country"])


@query(f"WITH {OBS} SELECT species, " + ", ".join(f"arg_min(dist, (ts, event_id)) FILTER (cls = '{c}') AS first_{c}" for c in ("view", "click", "error")) + " FROM obs GROUP BY species")
def pivot_years(spark: SparkSession, d: str) -> DataFrame:
    return rs.pivot_first(obs(spark, d), ["species"], "cls", ["view", "click", "error"], "dist", ["ts", "event_id"], "first_")


@query(f"WITH {OBS} SELECT species, " + ", ".join(f"count(*) FILTER (cls = '{c}') AS {c}" for c in ("view", "click", "error")) + " FROM obs GROUP BY species")
def pivot_counts(spark: SparkSession, d: str) -> DataFrame:
    return rs.pivot_counts(obs(spark, d), "species", "cls", ["view", "click", "error"])


@query(f"WITH {WIDE} SELECT country, agri_1995, NULL::DOUBLE AS agri_1996, 'Arable' AS variable_name FROM indicator_wide UNION ALL SELECT country, NULL, agri_1996, 'Cropland' FROM indicator_wide")
def union_with_variable(spark: SparkSession, d: str) -> DataFrame:
    w = indicator_wide(spark, d)
    return rs.union_tagged({"Arable": w.select("country", "agri_1995"), "Cropland": w.select("country", "agri_1996")})


@query(f"WITH {OBS}, {CUBE} SELECT DISTINCT t FROM (SELECT date_trunc('hour', ts) AS t FROM obs UNION ALL SELECT time FROM cube)")
def set_union_timestamps(spark: SparkSession, d: str) -> DataFrame:
    return obs(spark, d).select(F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("t")).union(cube(spark).select("time")).distinct()


@query("SELECT n_name FROM nation WHERE n_regionkey < 3 INTERSECT SELECT n_name FROM nation WHERE n_nationkey % 2 = 1")
def set_intersect_names(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return n.filter("n_regionkey < 3").select("n_name").intersect(n.filter("n_nationkey % 2 = 1").select("n_name"))


@query("SELECT n_name FROM nation WHERE n_regionkey < 3 EXCEPT SELECT n_name FROM nation WHERE n_nationkey % 2 = 1")
def set_difference_names(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return n.filter("n_regionkey < 3").select("n_name").exceptAll(n.filter("n_nationkey % 2 = 1").select("n_name"))


@query(f"WITH {OBS}, x AS (SELECT cls, species, count(*) AS n FROM obs GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY cls) AS p FROM x) SELECT cls, count(*) AS richness, round(-sum(p * ln(p)), 6) AS shannon, round(1 - sum(p * p), 6) AS simpson FROM p GROUP BY cls")
def shannon_simpson(spark: SparkSession, d: str) -> DataFrame:
    return ag.diversity(obs(spark, d), "species", ["cls"]).select("cls", "richness", r6("shannon").alias("shannon"), r6("simpson").alias("simpson"))


@query(f"WITH {OBS} SELECT cls, count(DISTINCT species) AS richness FROM obs GROUP BY cls")
def richness(spark: SparkSession, d: str) -> DataFrame:
    return ag.diversity(obs(spark, d), "species", ["cls"]).select("cls", "richness")


@query(f"WITH {OBS}, x AS (SELECT round(lat / 10, 0) AS region, species * 1000 + round(lon, 0)::INT AS s FROM obs), o AS (SELECT s, min(region) AS region FROM x GROUP BY s HAVING count(DISTINCT region) = 1) SELECT region, count(*) AS endemic FROM o GROUP BY region")
def endemism(spark: SparkSession, d: str) -> DataFrame:
    x = obs(spark, d).select(F.round(F.col("lat") / 10, 0).alias("region"), (F.col("species") * 1000 + F.round("lon", 0).cast("int")).alias("s"))
    return ag.endemism(x, "s", "region")


@query(f"WITH {OBS}, x AS (SELECT DISTINCT round(lat, 0)::INT AS r, species AS s FROM obs), n AS (SELECT r, count(*) AS n FROM x GROUP BY r), i AS (SELECT p.r AS a, q.r AS b, count(*) AS k FROM x p JOIN x q USING (s) GROUP BY ALL) SELECT a, b, round(1 - k::DOUBLE / (m.n + o.n - k), 6) AS jaccard FROM i JOIN n m ON m.r = a JOIN n o ON o.r = b")
def beta_jaccard(spark: SparkSession, d: str) -> DataFrame:
    x = obs(spark, d).select(F.round("lat", 0).cast("int").alias("region"), "species")
    return ag.beta_jaccard(x, "species", "region").withColumn("jaccard", r6("jaccard"))


@query(f"WITH {OBS} SELECT species, count(*) AS n FROM obs WHERE lat BETWEEN 34 AND 72 GROUP BY species ORDER BY n DESC, species LIMIT 100")
def top_species(spark: SparkSession, d: str) -> DataFrame:
    return ag.top_species(gr.in_box(obs(spark, d), "lat", "lon", 34.0, 72.0, -180.0, 180.0), "species", 100)


@query(f"WITH {OBS}, s AS (SELECT species, string_agg(DISTINCT cls, '+' ORDER BY cls) AS modalities FROM obs GROUP BY species) SELECT modalities, count(*) AS items FROM s GROUP BY ALL")
def modality_counts(spark: SparkSession, d: str) -> DataFrame:
    return ag.modality_combinations(obs(spark, d), "species", "cls")


_MOM = "count(value) AS count_valid, count(*) - count(value) AS count_nan, round((count(*) - count(value)) / count(*), 6) AS nan_pct, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max"


@query(f"WITH {CUBE} SELECT 'cube' AS variable, {_MOM} FROM cube GROUP BY ALL")
def moments_by_var(spark: SparkSession, d: str) -> DataFrame:
    x = ag.moments(cube(spark).withColumn("variable", F.lit("cube")), "value", ["variable"], skip_infinite=True)
    return x.withColumns({c: r6(c) for c in ("nan_pct", "mean", "std")})


@query(f"WITH {CUBE} SELECT level, {_MOM} FROM cube GROUP BY ALL")
def moments_by_level(spark: SparkSession, d: str) -> DataFrame:
    return ag.moments(cube(spark), "value", ["level"]).withColumns({c: r6(c) for c in ("nan_pct", "mean", "std")})


@query(f"WITH {CUBE} SELECT t_idx, level, round(avg((value IS NULL)::INT), 6) AS nan_pct, 0::DOUBLE AS inf_pct, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM cube GROUP BY ALL")
def batch_inspect(spark: SparkSession, d: str) -> DataFrame:
    return ag.inspect(cube(spark), "value", ["t_idx", "level"]).withColumns({c: r6(c) for c in ("nan_pct", "mean", "std")})


@query(f"WITH {OBS} SELECT species, round(sum(dist), 6) AS total, round(avg(dist), 6) AS mean, max(dist) AS max, count(*) AS n, min(year(ts))::INT AS first_year, max(year(ts))::INT AS last_year, count(DISTINCT year(ts))::INT AS n_years, count(DISTINCT date_trunc('month', ts))::INT AS n_months FROM obs GROUP BY species")
def species_summary(spark: SparkSession, d: str) -> DataFrame:
    return ag.species_summary(obs(spark, d), "species", "ts", "dist").withColumns({"total": r6("total"), "mean": r6("mean")})


@query("WITH p AS (SELECT c_nationkey AS species, year(o_orderdate)::INT AS year, (o_orderkey % 7)::DOUBLE AS lat, (o_orderkey % 3)::DOUBLE AS lon, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) SELECT species, year, sum(n)::BIGINT AS total, string_agg(lat || ',' || lon || ',' || n, ';' ORDER BY lat, lon) AS places FROM p GROUP BY ALL")
def yearly_occurrence_list(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    x = o.join(c, o["o_custkey"] == c["c_custkey"]).select(F.col("c_nationkey").alias("species"), "o_orderdate", (F.col("o_orderkey") % 7).cast("double").alias("lat"), (F.col("o_orderkey") % 3).cast("double").alias("lon"))
    y = ag.occurrence_lists(x, "species", "o_orderdate", "lat", "lon")
    return y.withColumn("places", F.array_join(F.transform("places", lambda p: F.concat_ws(",", p["lat"].cast("string"), p["lon"].cast("string"), p["n"].cast("string"))), ";"))


@query("WITH p AS (SELECT date_trunc('month', o_orderdate) AS period, sum(o_totalprice) AS v FROM orders WHERE month(o_orderdate) <> 7 GROUP BY 1), s AS (SELECT unnest(generate_series((SELECT min(period) FROM p), (SELECT max(period) FROM p), INTERVAL 1 MONTH)) AS period) SELECT s.period, round(coalesce(v, 0), 2) AS total FROM s LEFT JOIN p ON s.period = p.period")
def resample_spine(spark: SparkSession, d: str) -> DataFrame:
    x = ag.resample(table(spark, d, "orders").filter(F.month("o_orderdate") != 7), "o_orderdate", "o_totalprice")
    return x.select(F.col("period").cast("timestamp_ntz").alias("period"), F.round("total", 2).alias("total"))


@query(f"WITH {CUBE} SELECT time, round(avg(value), 6) AS mean FROM cube GROUP BY time")
def spatial_mean(spark: SparkSession, d: str) -> DataFrame:
    return cube(spark).groupBy("time").agg(r6(F.avg("value")).alias("mean"))


@query(f"WITH {OBS}, x AS (SELECT species, date_trunc('day', ts) AS day, sum(dist) AS v FROM obs GROUP BY ALL) SELECT species, day, round(v, 6) AS v, round(avg(v) OVER (PARTITION BY species ORDER BY day ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS smooth FROM x")
def rolling_mean_3(spark: SparkSession, d: str) -> DataFrame:
    x = obs(spark, d).groupBy("species", F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("day")).agg(F.sum("dist").alias("v"))
    return rs.rolling_mean(x, ["species"], "day", "v", "smooth").withColumns({"v": r6("v"), "smooth": r6("smooth")})


@query(f"WITH {OBS}, x AS (SELECT species AS value, min(event_id) AS o FROM obs GROUP BY 1) SELECT value, row_number() OVER (ORDER BY o, value) - 1 AS id FROM x")
def dense_labels(spark: SparkSession, d: str) -> DataFrame:
    return ag.dense_labels(obs(spark, d), "species", "event_id")


@query(f"WITH {OBS}, k AS (SELECT species AS value, row_number() OVER (ORDER BY min(event_id)) - 1 AS id FROM obs WHERE event_id <= 40 GROUP BY 1), x AS (SELECT species AS value, min(event_id) AS o FROM obs GROUP BY 1) SELECT value, id FROM k UNION ALL SELECT value, (SELECT max(id) FROM k) + row_number() OVER (ORDER BY o, value) FROM x WHERE value NOT IN (SELECT value FROM k)")
def dense_labels_incremental(spark: SparkSession, d: str) -> DataFrame:
    o = obs(spark, d)
    return ag.dense_labels(o, "species", "event_id", ag.dense_labels(o.filter("event_id <= 40"), "species", "event_id"))


@query(f"WITH {CUBE}, t AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS rank FROM (SELECT DISTINCT time FROM cube)) SELECT time, rank, rank // 5 AS chunk FROM t UNION ALL SELECT time, rank, rank // 5 - 1 FROM t WHERE rank % 5 = 0 AND rank > 0")
def chunk_assign(spark: SparkSession, d: str) -> DataFrame:
    return rs.chunked(ag.ranked(cube(spark).select("time").distinct(), ["time"]), "rank", 5, look_ahead=True)


@query(f"WITH {OBS} SELECT species, event_id, dist FROM obs QUALIFY row_number() OVER (PARTITION BY species ORDER BY dist DESC, event_id) <= 5")
def top_per_species(spark: SparkSession, d: str) -> DataFrame:
    return rs.top_per_group(obs(spark, d), ["species"], [F.desc("dist"), F.col("event_id")], 5).select("species", "event_id", "dist")


@query(f"WITH {OBS} SELECT cls, count(*) AS n, round(count(*) / (SELECT count(*) FROM obs), 6) AS share FROM obs GROUP BY cls")
def share_of_total(spark: SparkSession, d: str) -> DataFrame:
    return ag.share_of_total(obs(spark, d), "cls").withColumn("share", r6("share"))


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity)::BIGINT AS quantity, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("bigint").alias("quantity"), F.count(F.lit(1)).alias("n"))
