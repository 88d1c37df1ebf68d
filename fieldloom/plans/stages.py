"""Queries of training windows, time and code parsing, catalogs, JSON and the species fusion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldloom.functions import geo
from fieldloom.functions import time as tm
from fieldloom.operators import aggregates as ag
from fieldloom.operators import batch as bt
from fieldloom.operators import grid as gr
from fieldloom.plans.views import CUBE, OBS, WIDE, Register, cube, indicator_wide, obs
from fieldloom.sources import catalog
from fieldloom.sources.tables import table

query = Register()
r6 = lambda c: F.round(c, 6)
_STATS = "s AS (SELECT level, avg(value) AS m, stddev_pop(value) AS sd FROM cube GROUP BY level)"


def literals(spark: SparkSession, schema: str, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def values(rows: list) -> str:
    one = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)


@query(f"WITH {CUBE}, {_STATS} SELECT t_idx, level, lat_idx, lon_idx, round((value - m) / sd, 6) AS value FROM cube JOIN s USING (level)")
def zscore(spark: SparkSession, d: str) -> DataFrame:
    c = cube(spark)
    return bt.zscore(c, ag.moments(c, "value", ["level"]), ["level"], "value").select("t_idx", "level", "lat_idx", "lon_idx", r6("value").alias("value"))


@query(f"WITH {CUBE} SELECT t_idx, level, lat_idx, lon_idx, round(value, 6) AS value FROM cube")
def unzscore(spark: SparkSession, d: str) -> DataFrame:
    c = cube(spark)
    stats = ag.moments(c, "value", ["level"])
    return bt.zscore(bt.zscore(c, stats, ["level"], "value"), stats, ["level"], "value", inverse=True).select("t_idx", "level", "lat_idx", "lon_idx", r6("value").alias("value"))


@query(f"WITH {CUBE} SELECT t_idx, level, lat_idx, lon_idx, value FROM cube WHERE lat_idx < 15 AND lon_idx < 15")
def crop_truncate(spark: SparkSession, d: str) -> DataFrame:
    return gr.crop_to_multiple(cube(spark), "lat_idx", "lon_idx", 16, 16, 5).select("t_idx", "level", "lat_idx", "lon_idx", "value")


@query(f"WITH {CUBE} SELECT s.t AS t_idx, l.level, a.i::BIGINT AS lat_idx, b.j::BIGINT AS lon_idx, CASE WHEN a.i > 15 OR b.j > 15 THEN 0 ELSE value END AS value FROM range(40) s(t), (VALUES (50::BIGINT), (500), (1000)) l(level), range(20) a(i), range(20) b(j) LEFT JOIN cube ON cube.t_idx = s.t AND cube.level = l.level AND lat_idx = a.i AND lon_idx = b.j")
def crop_pad(spark: SparkSession, d: str) -> DataFrame:
    return gr.pad_to_multiple(cube(spark), "lat_idx", "lon_idx", 16, 16, 5, "value", ["t_idx", "level"])


@query(f"WITH {CUBE}, p AS (SELECT time AS t0, lead(time) OVER (ORDER BY time) AS t1 FROM (SELECT DISTINCT time FROM cube)), w AS (SELECT t0 AS window_start, 0 AS t, t0 AS hit FROM p WHERE t1 IS NOT NULL UNION ALL SELECT t0, 1, t1 FROM p WHERE t1 IS NOT NULL) SELECT window_start, t, level, count(*) AS cells, round(sum(value), 6) AS total FROM w JOIN cube ON time = hit WHERE level IN (50, 1000) GROUP BY ALL")
def window_batch(spark: SparkSession, d: str) -> DataFrame:
    x = bt.windows(cube(spark).filter(F.col("level").isin(50, 1000)), "time")
    return x.groupBy("window_start", "t", "level").agg(F.count(F.lit(1)).alias("cells"), r6(F.sum("value")).alias("total"))


@query(f"WITH {CUBE} SELECT t_idx, level, string_agg(coalesce(value, 0)::DECIMAL(9, 2), ',' ORDER BY lat_idx, lon_idx) AS tensor FROM cube GROUP BY ALL")
def tensor_export(spark: SparkSession, d: str) -> DataFrame:
    x = bt.tensors(cube(spark), ["t_idx", "level"], ["lat_idx", "lon_idx"], "value")
    return x.withColumn("tensor", F.array_join(F.transform("tensor", lambda v: v.cast("decimal(9,2)").cast("string")), ","))


_VARS = [("a", "t2m,msl,x"), ("b", "z"), ("c", "t,q,z"), ("d", "swvl2,foo"), ("e", "tp"), ("f", "foo,bar"), ("g", "msl,tp"), ("h", "")]
_SLOTS = "(VALUES " + ", ".join(f"({i}, '{k}', {v!r})" for i, (k, v) in enumerate(bt.SLOT_VARIABLES.items())) + ") s(o, slot, vs)"


@query(f"WITH f AS (SELECT * FROM (VALUES {values(_VARS)}) v(file, vars)), m AS (SELECT file, slot, len(list_intersect(string_split(vars, ','), vs)) AS n, o FROM f, {_SLOTS}) SELECT file, CASE WHEN max(n) > 0 THEN arg_max(slot, (n, -o)) ELSE 'misc_variables' END AS slot FROM m GROUP BY file")
def slot_infer(spark: SparkSession, d: str) -> DataFrame:
    return literals(spark, "file string, vars string", _VARS).select("file", bt.infer_slot(F.split("vars", ",")).alias("slot"))


_TIMES = [(1, "2020-05-01", "9.20 pm", "+00:00", "2020-05-01 21:20:00"), (2, "2020-05-01", "Dawn", "+02:00", "2020-05-01 04:00:00"), (3, "0000-00-00", "10:00", "+00:00", None), (4, "2020-00-00", "07:30", "+00:00", "2020-01-01 07:30:00"), (5, "2020-05-01", "xx:xx", "+01:00", "2020-04-30 23:00:00"), (6, "2020-05-01", "pm", "+00:00", "2020-05-01 12:00:00"), (7, "2020-05-01", "25:10", "-03:30", "2020-05-01 03:30:00"), (8, "2020-05-01", "17", "+00:00", "2020-05-01 17:00:00"), (9, "2020-13-01", "17:00", "+00:00", None), (10, "2020-05-01", "Unknown", "+00:00", "2020-05-01 00:00:00"), (11, "2020-05-01", "12.05 am", "+00:00", "2020-05-01 00:05:00")]


@query(f"SELECT id::BIGINT AS id, r::TIMESTAMP AS ts FROM (VALUES {values([(t[0], t[4]) for t in _TIMES])}) v(id, r)")
def free_text_time(spark: SparkSession, d: str) -> DataFrame:
    x = literals(spark, "id long, d string, t string, o string", [t[:4] for t in _TIMES])
    return x.select("id", tm.free_text_time(F.col("d"), F.col("t"), F.col("o")).cast("timestamp_ntz").alias("ts"))


_TEXTS = [(1, "2020-05-01 10:20:30"), (2, "2020-05-01T10:20:30"), (3, "2020-05-01"), (4, "01/05/2020"), (5, "not a time"), (6, None), (7, "2020-02-31")]


@query(f"SELECT id::BIGINT AS id, coalesce(try_strptime(s, '%Y-%m-%d %H:%M:%S'), try_strptime(s, '%Y-%m-%dT%H:%M:%S'), try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%d/%m/%Y')) AS ts FROM (VALUES {values(_TEXTS)}) v(id, s)")
def coerce_timestamp(spark: SparkSession, d: str) -> DataFrame:
    x = literals(spark, "id long, s string", _TEXTS)
    return x.select("id", tm.coerced(F.col("s"), ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy"]).cast("timestamp_ntz").alias("ts"))


@query("WITH s AS (SELECT min(date_trunc('month', o_orderdate)) AS a, max(date_trunc('month', o_orderdate)) AS b FROM orders), m AS (SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS t0 FROM s) SELECT t0, t0 + INTERVAL 1 MONTH AS t1, strftime(t0, '%m/%Y') AS tag FROM m WHERE t0 + INTERVAL 1 MONTH <= (SELECT b FROM s)")
def month_windows(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "orders").agg(F.min(F.date_trunc("MONTH", "o_orderdate")).alias("a"), F.max(F.date_trunc("MONTH", "o_orderdate")).alias("b"))
    x = s.select("b", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("t0")).withColumn("t1", F.col("t0") + F.expr("INTERVAL 1 MONTH")).filter("t1 <= b")
    return x.select(F.col("t0").cast("timestamp_ntz").alias("t0"), F.col("t1").cast("timestamp_ntz").alias("t1"), F.date_format("t0", "MM/yyyy").alias("tag"))


@query("""WITH c AS (SELECT DISTINCT upper(trim(eeacellcode)) AS c FROM cell_cube WHERE eeacellcode IS NOT NULL), g AS (SELECT c, regexp_extract(c, '^(10KM)?([EW])([0-9]+)([NS])([0-9]+)$', ['k', 'ew', 'e', 'ns', 'n']) AS g FROM c)
SELECT DISTINCT CASE WHEN g.e <> '' THEN '10km' || g.ew || try_cast(g.e AS INT) || g.ns || try_cast(g.n AS INT) ELSE '10kmE' || try_cast(left(c, 4) AS INT) || 'N' || try_cast(right(c, 4) AS INT) END AS code,
 CASE WHEN g.e <> '' THEN (try_cast(g.e AS BIGINT) * 10000 + 5000) * CASE g.ew WHEN 'W' THEN -1 ELSE 1 END ELSE try_cast(left(c, 4) AS BIGINT) * 10000 + 5000 END AS easting,
 CASE WHEN g.e <> '' THEN (try_cast(g.n AS BIGINT) * 10000 + 5000) * CASE g.ns WHEN 'S' THEN -1 ELSE 1 END ELSE try_cast(right(c, 4) AS BIGINT) * 10000 + 5000 END AS northing
FROM g WHERE g.e <> '' OR regexp_full_match(c, '[0-9]{8}')""")
def eea_decode(spark: SparkSession, d: str) -> DataFrame:
    x = geo.with_eea(table(spark, d, "cell_cube").select("eeacellcode").distinct(), F.col("eeacellcode"), "p").filter("p IS NOT NULL")
    e, n = geo.eea_metres(F.col("p"))
    return x.select("p.code", e.alias("easting"), n.alias("northing")).distinct()


def laea_inverse(spark: SparkSession, d: str) -> DataFrame:
    """Latitude and longitude of every decoded cell's centre; no SQL, checked against the EPSG sample point in the tests."""
    x = eea_decode(spark, d)
    lat, lon = geo.laea_inverse(F.col("easting").cast("double"), F.col("northing").cast("double"))
    return x.select("code", F.round(lat, 7).alias("lat"), F.round(lon, 7).alias("lon"))


query.queries["laea_inverse"] = laea_inverse


@query("SELECT 'events' AS name, 'ts' AS time_column, min(ts) AS time_min, max(ts) AS time_max, count(*) AS row_count, 6::BIGINT AS n_columns FROM events UNION ALL SELECT 'orders', 'o_orderdate', min(o_orderdate), max(o_orderdate), count(*), 6 FROM orders")
def catalog_report(spark: SparkSession, d: str) -> DataFrame:
    x = catalog.describe(table(spark, d, "events"), "events", "ts").unionByName(catalog.describe(table(spark, d, "orders"), "orders", "o_orderdate"))
    return x.select("name", "time_column", "time_min", "time_max", "row_count", "n_columns")


_FILES = [f"/data/era5/{day}-{kind}.nc" for day, kinds in (("2020-01-01", ("pressure", "single", "surface")), ("2020-01-02", ("pressure", "single")), ("2020-01-03", ("surface", "single", "pressure")), ("2020-01-04", ("surface",))) for kind in kinds]


@query(f"WITH f AS (SELECT f, regexp_extract(f, '([0-9-]{{10}})-([a-z]+)\\.nc$', 1) AS day, regexp_extract(f, '([0-9-]{{10}})-([a-z]+)\\.nc$', 2) AS kind FROM (VALUES {values([(f,) for f in _FILES])}) v(f)) SELECT day, max(f) FILTER (kind = 'pressure') AS pressure, max(f) FILTER (kind = 'single') AS single, max(f) FILTER (kind = 'surface') AS surface FROM f GROUP BY day HAVING count(DISTINCT kind) = 3")
def day_file_groups(spark: SparkSession, d: str) -> DataFrame:
    return catalog.group_by_day(literals(spark, "path string", [(f,) for f in _FILES]), "path")


@query("SELECT event_type, round(avg(coalesce((props->>'k')::INT, -1)), 6) AS mean_k, count(*) FILTER ((props->>'missing') IS NULL) AS defaulted FROM events GROUP BY event_type")
def json_defaults(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("j", F.from_json("props", "k INT, missing STRING"))
    x = e.select("event_type", F.coalesce("j.k", F.lit(-1)).alias("k"), F.coalesce("j.missing", F.lit("Unknown")).alias("m"))
    return x.groupBy("event_type").agg(r6(F.avg("k")).alias("mean_k"), F.count_if(F.col("m") == "Unknown").alias("defaulted"))


@query("WITH e AS (SELECT event_id, unnest(range((event_id % 3)::INT)) AS pos FROM events) SELECT event_id, pos::INT AS pos, 'https://img.example/' || event_id || '/' || pos || '/medium.jpg' AS url FROM e UNION ALL SELECT event_id, NULL, NULL FROM events WHERE event_id % 3 = 0")
def posexplode_photos(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 > 0, F.transform(F.sequence(F.lit(0), (F.col("event_id") % 3 - 1).cast("int")), lambda i: F.concat(F.lit("https://img.example/"), F.col("event_id").cast("string"), F.lit("/"), i.cast("string"), F.lit("/square.jpg")))).alias("photos"))
    x = e.select("event_id", F.posexplode_outer("photos").alias("pos", "url"))
    return x.withColumn("url", F.replace("url", F.lit("square"), F.lit("medium"))).filter(F.col("url").isNull() | F.col("url").startswith("https://"))


_HEADERS = ["Agri_2000", "NDVI_03/2019", "2015", "7/2001", "Country", "Land_19", "RLI_1993"]


@query("SELECT * FROM (VALUES ('Agri_2000', 'Agri', NULL::INT, 2000), ('NDVI_03/2019', 'NDVI', 3, 2019), ('2015', NULL, NULL, 2015), ('7/2001', NULL, 7, 2001), ('RLI_1993', 'RLI', NULL, 1993)) v(header, variable, month, year)")
def header_parse(spark: SparkSession, d: str) -> DataFrame:
    from fieldloom.operators.reshape import parse_header

    return literals(spark, "header string, variable string, month int, year int", [(h, v, m, y) for h in _HEADERS if (p := parse_header(h)) for v, m, y in (p,)])


@query("SELECT country, round(sum(v), 2) AS total FROM (WITH " + WIDE + " SELECT country, unnest([agri_1995, agri_1996, agri_1997]) AS v FROM indicator_wide) GROUP BY country")
def indicator_sum(spark: SparkSession, d: str) -> DataFrame:
    w = indicator_wide(spark, d)
    return w.select("country", F.round(F.col("agri_1995") + F.col("agri_1996") + F.col("agri_1997"), 2).alias("total"))


@query(f"""WITH {OBS}, y AS (SELECT * REPLACE (species * 1000 + round(lon, 0)::INT AS species) FROM obs), i AS (SELECT * FROM y WHERE cls = 'view'), s AS (SELECT * FROM y WHERE cls = 'click'), e AS (SELECT * FROM y WHERE cls = 'error'), q AS (SELECT * FROM y WHERE cls = 'purchase'),
u AS (SELECT i.species, 'pair' AS kind, i.event_id AS first_id, s.event_id AS second_id, (i.lat + s.lat) / 2 AS lat, (i.lon + s.lon) / 2 AS lon, 1.0::DOUBLE AS dist FROM i JOIN s USING (species) QUALIFY row_number() OVER (PARTITION BY i.species ORDER BY i.event_id, s.event_id) <= 3
UNION ALL (SELECT species, 'image', event_id, NULL, lat, lon, 1.0 FROM i WHERE species NOT IN (SELECT species FROM s) QUALIFY row_number() OVER (PARTITION BY species ORDER BY event_id) <= 3)
UNION ALL (SELECT species, 'audio', event_id, NULL, lat, lon, 1.0 FROM s WHERE species NOT IN (SELECT species FROM i) QUALIFY row_number() OVER (PARTITION BY species ORDER BY event_id) <= 3)
UNION ALL SELECT species, 'edna', event_id, NULL, lat, lon, 1.0 FROM e WHERE species NOT IN (SELECT species FROM i) AND species NOT IN (SELECT species FROM s)
UNION ALL SELECT species, 'distribution', event_id, NULL, lat, lon, dist FROM q)
SELECT species, kind, first_id, second_id, round(lat, 6) AS lat, round(lon, 6) AS lon, round(dist, 6) AS dist FROM u""")
def species_fusion(spark: SparkSession, d: str) -> DataFrame:
    """All observations; a species is one kind at one longitude, so that some have images, some sounds, some both or neither."""
    o = obs(spark, d).withColumn("species", F.col("species") * 1000 + F.round("lon", 0).cast("int"))
    one = lambda cls: o.filter(F.col("cls") == cls).select("species", F.col("event_id").alias("id"), "lat", "lon", "dist")
    x = bt.fuse_species(one("view"), one("click"), one("error"), one("purchase"))
    return x.withColumns({c: r6(c) for c in ("lat", "lon", "dist")})
