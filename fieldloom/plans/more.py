"""Queries of filters, checks, stacked windows, lookups, regions, pipelines and of the readers, which read what was written from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldloom.functions import register
from fieldloom.functions import sequence as sq
from fieldloom.functions import text as tx
from fieldloom.functions import time as tm
from fieldloom.functions.barrier import computed
from fieldloom.operators import aggregates as ag
from fieldloom.operators import batch as bt
from fieldloom.operators import filters as fl
from fieldloom.operators import joins as jn
from fieldloom.operators import pipelines as pl
from fieldloom.operators import reshape as rs
from fieldloom.operators.timestamps import once
from fieldloom.plans.flows import folder
from fieldloom.plans.texts import _STOP, _WORDS
from fieldloom.plans.views import BOXES, CUBE, OBS, WIDE, Register, boxes, cube, indicator_wide, obs, pure_seq, PURE
from fieldloom.sources import catalog, readers, sinks
from fieldloom.sources.tables import table
from fieldloom.streaming import observations as stream

query = Register()
r6 = lambda c: F.round(c, 6)
ntz = lambda c: c.cast("timestamp_ntz")

# Filters and checks


@query("SELECT o_orderkey, year(o_orderdate)::INT AS year FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996")
def year_range(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return fl.years_between(o, F.col("year"), 1994, 1996)


@query(f"WITH {OBS} SELECT event_id, lat FROM obs WHERE lat BETWEEN 40.125 AND 60")
def half_clipped_window(spark: SparkSession, d: str) -> DataFrame:
    return fl.half_clipped(obs(spark, d), "lat", 40.0, 60.0, 0.25).select("event_id", "lat")


@query("SELECT event_id FROM events WHERE day(ts) = 11")
def day_of_month_files(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.concat(F.lit("https://files.example/"), F.date_format("ts", "yyyyMMdd"), F.lit("/"), F.col("event_id").cast("string"), F.lit(".nc")).alias("path"))
    return fl.day_of_month_folder(e, "path", 11).select("event_id")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-02' AND o_orderdate <= TIMESTAMP '1997-12-31'")
def day_first_bounds(spark: SparkSession, d: str) -> DataFrame:
    return fl.day_first_bounds(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "02/03/1995", "31.12.1997")


@query("SELECT DISTINCT row_id, 'any' AS how FROM agri_grid WHERE agri_1998 IS NOT NULL AND NOT isnan(agri_1998) AND agri_2000 IS NOT NULL AND NOT isnan(agri_2000) UNION ALL SELECT DISTINCT row_id, 'all' FROM agri_grid WHERE (agri_1998 IS NOT NULL AND NOT isnan(agri_1998)) OR (agri_2000 IS NOT NULL AND NOT isnan(agri_2000))")
def null_rows(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "agri_grid").select("row_id", "agri_1998", "agri_2000").distinct()
    part = lambda how: fl.without_nulls(a, ["agri_1998", "agri_2000"], how).select("row_id").distinct().withColumn("how", F.lit(how))
    return part("any").unionByName(part("all"))


@query("SELECT event_type AS modality, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1")
def modality_filter(spark: SparkSession, d: str) -> DataFrame:
    out = folder(spark, "catalog")
    sinks.write_parquet(table(spark, d, "events").select("event_id", F.col("event_type").alias("modality")), out, ["modality"])
    return fl.of_modality(spark.read.parquet(out), "view").groupBy("modality").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT variable_name, count(DISTINCT row_id) AS n FROM agri_grid WHERE variable_name IN ('Agriculture', 'Arable', 'Cropland') GROUP BY 1")
def allowed_variables(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "agri_grid").select("row_id", "variable_name", F.lit("agriculture_variables").alias("slot"))
    return fl.taken_variables(a, "slot", "variable_name").groupBy("variable_name").agg(F.count_distinct("row_id").alias("n"))


@query(f"WITH {OBS} SELECT 'latitude' AS \"check\", count(*) AS rows, count(*) FILTER (NOT coalesce(lat BETWEEN 34 AND 72, false)) AS failed FROM obs UNION ALL SELECT 'longitude', count(*), count(*) FILTER (NOT coalesce(lon BETWEEN -30 AND 50, false)) FROM obs UNION ALL SELECT 'class', count(*), count(*) FILTER (cls IS NULL) FROM obs")
def assertions(spark: SparkSession, d: str) -> DataFrame:
    """Ranges and nulls of all observations; reading it fails where one doesn't hold."""
    return fl.assertions(obs(spark, d), {"latitude": F.col("lat").between(34, 72), "longitude": F.col("lon").between(-30, 50), "class": F.col("cls").isNotNull()})


@query("SELECT c_custkey AS custkey, 'left' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1995) UNION ALL SELECT c_custkey, 'right' FROM customer WHERE false")
def key_difference(spark: SparkSession, d: str) -> DataFrame:
    return fl.same_keys(table(spark, d, "customer").select(F.col("c_custkey").alias("custkey")), table(spark, d, "orders").filter(F.year("o_orderdate") == 1995).select(F.col("o_custkey").alias("custkey")), ["custkey"])


@query(f"WITH {OBS} SELECT cls, round(avg(dist), 6) AS mean, round(stddev_pop(dist), 6) AS std, max(dist) AS max FROM obs GROUP BY cls")
def metrics_combined(spark: SparkSession, d: str) -> DataFrame:
    m = ag.moments(obs(spark, d), "dist", ["cls"])
    x = fl.combined_metrics({k: m.select("cls", F.col(k).alias("v")) for k in ("mean", "std", "max")}, ["cls"], "v")
    return x.withColumns({"mean": r6("mean"), "std": r6("std")})


@query(f"WITH {BOXES} SELECT n_regionkey AS region, min(lat_lo) AS lat_lo, max(lat_hi) AS lat_hi, min(lon_lo) AS lon_lo, max(lon_hi) AS lon_hi FROM boxes JOIN nation ON n_nationkey = k GROUP BY 1")
def region_boxes(spark: SparkSession, d: str) -> DataFrame:
    b = boxes(spark, d).join(table(spark, d, "nation"), F.col("k") == F.col("n_nationkey")).withColumnRenamed("n_regionkey", "region")
    return fl.box_union(b, ["region"], "lat_lo", "lat_hi", "lon_lo", "lon_hi")


@query("WITH i AS (SELECT DISTINCT image_id, genus, latitude AS la, longitude AS lo FROM image_metadata), a AS (SELECT genus, max(latitude) AS la2, min(longitude) AS lo2 FROM audio_metadata GROUP BY 1) SELECT image_id, CASE WHEN la BETWEEN -90 AND 90 AND la2 BETWEEN -90 AND 90 THEN round((la + la2) / 2, 6) END AS lat, CASE WHEN lo BETWEEN -180 AND 180 AND lo2 BETWEEN -180 AND 180 THEN round((lo + lo2) / 2, 6) END AS lon FROM i JOIN a USING (genus)")
def midpoints(spark: SparkSession, d: str) -> DataFrame:
    i = once(table(spark, d, "image_metadata").select("image_id", "genus", F.col("latitude").alias("la"), F.col("longitude").alias("lo")), "image_id")
    a = table(spark, d, "audio_metadata").groupBy("genus").agg(F.max("latitude").alias("la2"), F.min("longitude").alias("lo2"))
    lat, lon = fl.midpoint(F.col("la"), F.col("lo"), F.col("la2"), F.col("lo2"))
    return i.join(a, "genus").select("image_id", r6(lat).alias("lat"), r6(lon).alias("lon"))


# Stacked windows

_SEA = "sea AS (SELECT date_trunc('year', l_shipdate) AS time, l_returnflag AS slot, l_linestatus || l_linenumber % 2 AS variable, l_linenumber AS level, l_partkey % 8 AS lat_idx, l_suppkey % 8 AS lon_idx, l_quantity AS value FROM lineitem)"


def sea(spark: SparkSession, d: str) -> DataFrame:
    """A cube of several slots, variables and levels by year, from the order lines."""
    return table(spark, d, "lineitem").selectExpr("cast(date_trunc('YEAR', l_shipdate) AS timestamp_ntz) AS time", "l_returnflag AS slot", "concat(l_linestatus, cast(l_linenumber % 2 AS string)) AS variable", "l_linenumber AS level", "l_partkey % 8 AS lat_idx", "l_suppkey % 8 AS lon_idx", "l_quantity AS value")


@query(f"""WITH {_SEA}, x AS (SELECT time, slot, variable, level, lat_idx, lon_idx, max(value) AS v FROM sea GROUP BY ALL),
vx AS (SELECT slot, variable, row_number() OVER (PARTITION BY slot ORDER BY variable) - 1 AS vi FROM (SELECT DISTINCT slot, variable FROM x)), lx AS (SELECT slot, level, row_number() OVER (PARTITION BY slot ORDER BY level) - 1 AS li FROM (SELECT DISTINCT slot, level FROM x)),
cx AS (SELECT slot, lat_idx, lon_idx, row_number() OVER (PARTITION BY slot ORDER BY lat_idx, lon_idx) - 1 AS ci FROM (SELECT DISTINCT slot, lat_idx, lon_idx FROM x)),
n AS (SELECT slot, (SELECT count(*) FROM vx WHERE vx.slot = s.slot) AS nv, (SELECT count(*) FROM lx WHERE lx.slot = s.slot) AS nl, (SELECT count(*) FROM cx WHERE cx.slot = s.slot) AS nc FROM (SELECT DISTINCT slot FROM x) s),
p AS (SELECT time AS t0, lead(time) OVER (ORDER BY time) AS t1 FROM (SELECT DISTINCT time FROM x)), w AS (SELECT t0, 0 AS t, t0 AS hit FROM p WHERE t1 IS NOT NULL UNION ALL SELECT t0, 1, t1 FROM p WHERE t1 IS NOT NULL)
SELECT t0 AS window_start, slot, (2 * nv * nl * nc)::INT AS size, nv::INT AS variables, nl::INT AS levels, round(sum(v), 4) AS total, round(sum(v * (((t * nv + vi) * nl + li) * nc + ci)), 2) AS checksum
FROM w JOIN x ON time = hit JOIN vx USING (slot, variable) JOIN lx USING (slot, level) JOIN cx USING (slot, lat_idx, lon_idx) JOIN n USING (slot) GROUP BY ALL""")
def window_stack(spark: SparkSession, d: str) -> DataFrame:
    """Tensors of two steps, all variables and levels of each slot; their order is in the checksum."""
    x = bt.stacked_windows(sea(spark, d), "time", "slot", "variable", "level", ["lat_idx", "lon_idx"], "value")
    total = lambda f: F.aggregate(F.transform("tensor", f), F.lit(0.0), lambda a, v: a + v)
    return x.select("window_start", "slot", F.size("tensor").alias("size"), F.size("variables").alias("variables"), F.size("levels").alias("levels"), F.round(total(lambda v, i: v), 4).alias("total"), F.round(total(lambda v, i: v * i), 2).alias("checksum"))


@query(f"WITH {_SEA} SELECT slot, variable, level, count(value) AS count_valid, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM sea GROUP BY ALL")
def moments_by_variable_level(spark: SparkSession, d: str) -> DataFrame:
    return ag.moments(sea(spark, d), "value", ["slot", "variable", "level"]).select("slot", "variable", "level", "count_valid", r6("mean").alias("mean"), r6("std").alias("std"))


@query(f"WITH {_SEA} SELECT 'sea' AS name, 'time' AS time_column, count(DISTINCT time) AS n_times, string_agg(DISTINCT level, ',' ORDER BY level) AS levels, 'double' AS value_type, count(value) AS n_values FROM sea")
def cube_catalog(spark: SparkSession, d: str) -> DataFrame:
    x = catalog.describe_cube(sea(spark, d).withColumn("valid_time", F.lit("2000-01-01").cast("timestamp_ntz")), "sea", ["valid_time", "time"], "level", "value")
    return x.withColumn("levels", F.array_join(F.transform("levels", lambda v: v.cast("string")), ","))


# Lookups


@query("SELECT species, place FROM (SELECT unnest([7, 3, 999999999])::BIGINT AS species, unnest([1, 2, 3]) AS place) UNION ALL (SELECT user_id, (row_number() OVER (ORDER BY n DESC, user_id) + 3)::INT FROM (SELECT user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, user_id LIMIT 20))")
def top_after_list(spark: SparkSession, d: str) -> DataFrame:
    return ag.top_species_after(obs(spark, d), "species", [7, 3, 999_999_999], 20).withColumn("place", F.col("place").cast("int"))


@query("SELECT event_type AS folder, string_agg(DISTINCT year(ts), ',' ORDER BY year(ts)) AS years FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def folder_years(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "events").select(F.col("event_type").alias("folder"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    return ag.years_by_folder(x, "folder", "ts").withColumn("years", F.array_join(F.transform("years", lambda y: y.cast("string")), ","))


@query("""WITH i AS (SELECT DISTINCT image_id, lower(scientific_name) AS name, genus FROM image_metadata WHERE image_id IS NOT NULL), a AS (SELECT lower(scientific_name) AS name, min(nullif(genus, 'Unknown')) AS genus, min(nullif(country, 'Unknown')) AS family FROM audio_metadata GROUP BY 1)
SELECT image_id, coalesce(a.genus, i.genus, 'Unknown') AS genus, coalesce(a.family, 'Unknown') AS family, 'Unknown' AS phylum, 'Unknown' AS class, 'Unknown' AS "order" FROM i LEFT JOIN a USING (name)""")
def taxonomy_ranks(spark: SparkSession, d: str) -> DataFrame:
    i = once(table(spark, d, "image_metadata").select("image_id", F.lower("scientific_name").alias("name"), "genus"), "image_id")
    a = table(spark, d, "audio_metadata").select(F.lower("scientific_name").alias("name"), "genus", F.col("country").alias("family"))
    return jn.taxonomy(i, [a], "name").select("image_id", *jn.RANKS)


@query(f"""WITH {BOXES}, c AS (SELECT 'N' || n_nationkey AS iso, n_name AS country, r_name AS continent, lat_lo, lat_hi FROM nation JOIN region ON n_regionkey = r_regionkey JOIN boxes ON k = n_nationkey)
SELECT c_custkey, c.iso, coalesce(c.country, 'Unknown') AS country, coalesce(c.continent, 'Unknown') AS continent, c.lat_lo, c.lat_hi FROM customer LEFT JOIN c ON c_nationkey % 2 = 0 AND c.iso = 'N' || c_nationkey OR c_nationkey % 4 = 1 AND c.iso = 'N' || c_nationkey""")
def country_continents(spark: SparkSession, d: str) -> DataFrame:
    """Customers' countries by code, by name with other letter case and blanks, and by a text that is neither."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(boxes(spark, d), F.col("n_nationkey") == F.col("k"))
    countries = n.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iso"), F.col("n_name").alias("country"), F.col("r_name").alias("continent"), "lat_lo", "lat_hi", "lon_lo", "lon_hi")
    key = F.col("c_nationkey")
    named = table(spark, d, "customer").join(table(spark, d, "nation"), key == F.col("n_nationkey"))
    code = F.when(key % 2 == 0, F.concat(F.lit("n"), key.cast("string"))).when(key % 4 == 1, F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))).otherwise(F.lit("nowhere"))
    return jn.country_lookup(named.select("c_custkey", code.alias("code")), "code", countries).select("c_custkey", "iso", "country", "continent", "lat_lo", "lat_hi")


@query(f"WITH {OBS} SELECT event_id, CASE WHEN (event_id * 37 % 3801) % 25 = 0 THEN ((event_id * 37 % 3801) // 25)::INT ELSE -1 END AS idx FROM obs")
def axis_lookup(spark: SparkSession, d: str) -> DataFrame:
    axis = spark.range(153).select((F.lit(34.0) + F.col("id") * 0.25).alias("latitude"), F.col("id").cast("int").alias("idx"))
    return jn.on_axis(obs(spark, d), "lat", axis, "latitude").select("event_id", "idx")


# Regions


def _hollow(spark: SparkSession, d: str) -> DataFrame:
    """Each nation's box with a box cut out of its middle, written as GeoJSON and read again."""
    out = folder(spark, "regions")
    c = F.col
    ring = lambda x0, x1, y0, y1: F.array(*[F.array(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])
    rings = F.array(ring(c("lon_lo"), c("lon_hi"), c("lat_lo"), c("lat_hi")), ring(c("lon_lo") + 2, c("lon_hi") - 2, c("lat_lo") + 1.5, c("lat_hi") - 1.5))
    f = boxes(spark, d).select(F.struct(F.create_map(F.lit("name"), c("country")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates")).alias("geometry")).alias("f"))
    f.agg(F.collect_list("f").alias("features")).write.json(out)  # one feature a nation
    return readers.regions(spark, out)


@query(f"WITH {OBS}, {BOXES} SELECT event_id, country AS name FROM obs, boxes WHERE lat >= lat_lo AND lat < lat_hi AND lon >= lon_lo AND lon < lon_hi AND NOT (lat >= lat_lo + 1.5 AND lat < lat_hi - 1.5 AND lon >= lon_lo + 2 AND lon < lon_hi - 2)")
def points_in_regions(spark: SparkSession, d: str) -> DataFrame:
    return jn.points_in_regions(obs(spark, d).select("event_id", "lat", "lon"), "lat", "lon", _hollow(spark, d), "name", "rings").select("event_id", "name")


@query(f"WITH {BOXES} SELECT country AS name, 5 AS points FROM boxes")
def polygon_rings(spark: SparkSession, d: str) -> DataFrame:
    """Outer rings of the GeoJSON features."""
    out = folder(spark, "rings")
    c = F.col
    ring = F.array(*[F.array(c(x), c(y)) for x, y in (("lon_lo", "lat_lo"), ("lon_hi", "lat_lo"), ("lon_hi", "lat_hi"), ("lon_lo", "lat_hi"), ("lon_lo", "lat_lo"))])
    f = boxes(spark, d).select(F.struct(F.create_map(F.lit("name"), c("country")).alias("properties"), F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring)).alias("coordinates")).alias("geometry")).alias("f"))
    f.agg(F.collect_list("f").alias("features")).write.json(out)
    return readers.polygons(spark, out).select("name", F.size("ring").alias("points"))


# Pipelines


@query(f"WITH {PURE}, k AS (SELECT event_id, substr(dna, unnest(range(1, 28))::INT, 4) AS kmer FROM pure), c AS (SELECT event_id, kmer, count(*) / 27 AS f FROM k GROUP BY ALL) SELECT event_id, 256 AS size, round(max(f), 6) AS largest, round(sum(f * (instr('ACGT', substr(kmer, 1, 1)) * 64 + instr('ACGT', substr(kmer, 2, 1)) * 16 + instr('ACGT', substr(kmer, 3, 1)) * 4 + instr('ACGT', substr(kmer, 4, 1)) - 85)), 4) AS checksum FROM c GROUP BY event_id")
def dna_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned, counted (all 256 words of four bases) and normalised sequences."""
    x = computed(pure_seq(spark, d), {"v": pl.dna_features(F.col("dna"), 4)})
    return x.select("event_id", F.size("v").alias("size"), r6(F.array_max("v")).alias("largest"), F.round(F.aggregate(F.transform("v", lambda f, i: f * i), F.lit(0.0), lambda a, f: a + f), 4).alias("checksum"))


@query(f"WITH {_WORDS} SELECT doc_id, term, n FROM c WHERE term NOT IN {_STOP}")
def text_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return pl.text_terms(table(spark, d, "documents"), "doc_id", "text", stems=False)


@query()
def text_pipeline_stems(spark: SparkSession, d: str) -> DataFrame:
    """The same with stems; without SQL, the stemmer is checked against the pairs published with it."""
    return pl.text_terms(table(spark, d, "documents"), "doc_id", "text")


@query()
def wave_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """The vectors as waves of 8 kHz through the whole pipeline."""
    wave = F.flatten(F.array_repeat(F.transform("embedding", lambda v: v.cast("double")), 32))
    return table(spark, d, "embeddings").select("vec_id", pl.wave_features(wave, 8000, 16_000, 0.25).alias("mfcc"))


@query()
def image_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """The vectors as grey images of 8 by 8."""
    pixels = F.transform("embedding", lambda v: F.greatest(F.lit(0.0), F.least(F.lit(255.0), v.cast("double") * 128 + 128)))
    return table(spark, d, "embeddings").select("vec_id", pl.image_pipeline(pixels, 8, 8, 1, 8).alias("f")).select("vec_id", "f.*")


# Writers and readers


@query(f'WITH {WIDE} SELECT country, round(agri_1995, 2) AS a, round(agri_1997, 2) AS b, round(agri_1996, 2) AS c FROM indicator_wide')
def column_merge(spark: SparkSession, d: str) -> DataFrame:
    """A wide table to which a column is added and one is replaced."""
    out, w = folder(spark, "merged"), indicator_wide(spark, d)
    sinks.merge_columns(w.select("country", F.round("agri_1995", 2).alias("a"), F.lit(0.0).alias("c")), out, ["country"])
    sinks.merge_columns(w.select("country", F.round("agri_1997", 2).alias("b"), F.round("agri_1996", 2).alias("c")), out, ["country"])
    x = spark.read.option("header", "true").csv(out)
    return x.select("country", *[F.col(c).cast("double").alias(c) for c in "abc"])


@query("SELECT run, count(*) AS n FROM (SELECT DISTINCT user_id, CASE WHEN user_id % 3 = 0 THEN 'first' ELSE 'second' END AS run FROM events WHERE user_id IS NOT NULL) GROUP BY run")
def processed_log(spark: SparkSession, d: str) -> DataFrame:
    """Items worked on once over two runs, of which the second has all of the first."""
    log, out = folder(spark, "log"), folder(spark, "done")
    items = table(spark, d, "events").filter("user_id IS NOT NULL").select("user_id").distinct()
    for run, part in (("first", items.filter("user_id % 3 = 0")), ("second", items)):
        sinks.process_once(part, log, "user_id", lambda x, run=run: x.withColumn("run", F.lit(run)).write.mode("append").parquet(out))
    return spark.read.parquet(out).groupBy("run").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, event_type, value FROM events")
def csv_read(spark: SparkSession, d: str) -> DataFrame:
    out = folder(spark, "csv")
    table(spark, d, "events").select("event_id", "event_type", "value").write.option("header", "true").csv(out)
    return readers.csv(spark, out, "event_id long, event_type string, value double")


@query("SELECT c_custkey AS id, 'Åré ' || c_mktsegment AS name FROM customer")
def csv_encodings(spark: SparkSession, d: str) -> DataFrame:
    """Files of two encodings in one folder."""
    out = folder(spark, "encodings")
    x = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("Åré "), F.col("c_mktsegment")).alias("name"))
    for rest, encoding in ((0, "UTF-8"), (1, "ISO-8859-1")):
        x.filter(F.col("id") % 2 == rest).write.mode("append").option("header", "true").option("encoding", encoding).csv(out)
    return readers.csv_any_encoding(spark, out, "id long, name string")


@query("SELECT event_id, event_type FROM events")
def tsv_skip_malformed(spark: SparkSession, d: str) -> DataFrame:
    """Tab-separated lines of which one in three has a field that is no number."""
    out = folder(spark, "tsv")
    e = table(spark, d, "events").select("event_id", "event_type")
    good = e.select(F.concat_ws("\t", F.col("event_id").cast("string"), "event_type").alias("value"))
    bad = e.filter("event_id % 3 = 0").select(F.concat_ws("\t", F.lit("x"), "event_type").alias("value"))
    good.unionByName(bad).withColumn("value", F.col("value")).write.text(out)
    r = spark.read.option("sep", "\t").option("mode", "DROPMALFORMED").schema("event_id long, event_type string")
    return r.csv(out)


@query(f'WITH {WIDE} SELECT country AS name, right(k, 4)::INT AS year, v AS value FROM (UNPIVOT indicator_wide ON agri_1995, agri_1996, agri_1997 INTO NAME k VALUE v)')
def csv_preamble(spark: SparkSession, d: str) -> DataFrame:
    """A table with four lines before its header."""
    out, w = folder(spark, "preamble"), indicator_wide(spark, d)
    line = F.concat_ws(",", F.concat(F.lit('"'), F.col("country"), F.lit('"')), F.lit("C"), F.lit("I"), F.lit("X"), *[F.col(f"agri_{y}").cast("decimal(20,2)").cast("string") for y in (1995, 1996, 1997)])
    head = "Source,World\n\nUpdated,now\n\nCountry Name,Country Code,Indicator Name,Indicator Code,1995,1996,1997\n"
    w.agg(F.concat(F.lit(head), F.array_join(F.collect_list(line), "\n")).alias("value")).write.text(out)  # a line a nation
    return readers.csv_with_preamble(spark, out + "/*.txt").select("name", "year", "value")


@query("SELECT event_id::VARCHAR AS a, event_type AS c FROM events")
def tsv_positions(spark: SparkSession, d: str) -> DataFrame:
    """Lines without header; those of too few fields are left out."""
    out = folder(spark, "positions")
    e = table(spark, d, "events")
    e.select(F.concat_ws("\t", F.col("event_id").cast("string"), F.lit("x"), "event_type").alias("value")).unionByName(e.select(F.col("event_id").cast("string").alias("value"))).write.text(out)
    return readers.positional_tsv(spark, out, {"a": 0, "c": 2}, 3)


@query("SELECT n_name || '.jpg' AS file_name, CASE WHEN n_regionkey < 3 THEN r_name ELSE 'Unknown' END AS family, '640x480' AS dimensions FROM nation JOIN region ON n_regionkey = r_regionkey")
def image_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Annotation JSON with images, annotations and categories; two regions have no category."""
    out = folder(spark, "annotations")
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    images = n.agg(F.collect_list(F.struct(F.concat("n_name", F.lit(".jpg")).alias("file_name"), F.col("n_nationkey").cast("long").alias("id"), F.lit(640).alias("width"), F.lit(480).alias("height"))).alias("images"), F.collect_list(F.struct(F.col("n_nationkey").cast("long").alias("image_id"), F.col("n_regionkey").cast("long").alias("category_id"))).alias("annotations"))
    cats = r.filter("r_regionkey < 3").agg(F.collect_list(F.struct(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("family"))).alias("categories"))
    images.withColumn("one", F.lit(1)).join(cats.withColumn("one", F.lit(1)), "one").drop("one").write.json(out)
    return readers.annotations(spark, out).select("file_name", "family", "dimensions")


@query("SELECT DISTINCT event_type || '.csv' AS name FROM events WHERE event_type IS NOT NULL")
def path_names(spark: SparkSession, d: str) -> DataFrame:
    out = folder(spark, "paths")
    table(spark, d, "events").filter("event_type IS NOT NULL").select(F.concat(F.lit("/store/"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_type"), F.lit(".csv")).alias("value")).write.text(out)
    return readers.names_from_paths(spark, out)


@query("SELECT 'ndvi' AS modality, 2::BIGINT AS folders UNION ALL SELECT 'species', 1")
def file_discovery(spark: SparkSession, d: str) -> DataFrame:
    """Folders with files of each modality, by name pattern."""
    out = folder(spark, "store")
    n = table(spark, d, "nation")
    n.select("n_name").write.parquet(f"{out}/species.parquet")
    for k in ("a", "b"):
        n.select("n_name").write.csv(f"{out}/{k}_ndvi.csv")
    found = catalog.discover(spark, out, {"ndvi": "*.csv", "species": "*.parquet"})
    return found.select("modality", F.regexp_replace("path", r"/[^/]*$", "").alias("folder")).groupBy("modality").agg(F.count_distinct("folder").alias("folders"))


@query("SELECT 'store/' || user_id AS folder, string_agg(DISTINCT CASE event_type WHEN 'view' THEN 'image' WHEN 'click' THEN 'audio' ELSE 'edna' END, '+' ORDER BY CASE event_type WHEN 'view' THEN 'image' WHEN 'click' THEN 'audio' ELSE 'edna' END) AS modalities FROM events WHERE event_type IN ('view', 'click', 'error') GROUP BY user_id")
def folder_modalities(spark: SparkSession, d: str) -> DataFrame:
    end = F.when(F.col("event_type") == "view", ".jpg").when(F.col("event_type") == "click", ".WAV").when(F.col("event_type") == "error", "_edna.csv").otherwise(".txt")
    x = table(spark, d, "events").select(F.concat(F.lit("store/"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_id").cast("string"), end).alias("path"))
    return catalog.folder_modalities(x, "path").withColumn("modalities", F.array_join("modalities", "+"))


@query("SELECT 'parquet' AS kind, true AS valid, 1::BIGINT AS n UNION ALL SELECT 'nc', false, 1")
def file_probe(spark: SparkSession, d: str) -> DataFrame:
    """A whole Parquet file and a file that is no NetCDF."""
    out = folder(spark, "probe")
    table(spark, d, "nation").coalesce(1).write.parquet(f"{out}/whole")
    fs = spark._jvm.org.apache.hadoop.fs
    path = fs.Path(f"{out}/broken.nc")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(88)
    stream.close()
    sinks.write_json(table(spark, d, "region"), f"{out}/text")  # no kind that is probed
    return catalog.probe(spark, out).groupBy("kind", "valid").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id AS species, arg_max('line one line ' || event_id, event_id) FILTER (event_type = 'view') AS text, arg_max(event_type, event_id) AS redlist FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def description_records(spark: SparkSession, d: str) -> DataFrame:
    """The last text and red list code of each species from JSON records in order."""
    e = table(spark, d, "events").filter("user_id IS NOT NULL")
    text = F.when(F.col("event_type") == "view", F.concat(F.lit("line one\r\nline "), F.col("event_id").cast("string")))
    p = e.select(F.col("user_id").alias("species"), F.col("event_id").alias("seq"), F.to_json(F.struct(text.alias("text"), F.col("event_type").alias("redlist"))).alias("payload"))
    return readers.descriptions(p)


@query("SELECT event_id, substr(dna, 1, 3) AS head FROM (SELECT event_id, translate(substring(md5(event_id::VARCHAR), 1, 30), '0123456789abcdef', 'ACGTACGTACGTACGT') AS dna FROM events)")
def dna_barcodes(spark: SparkSession, d: str) -> DataFrame:
    """DNA records as JSON, parsed."""
    s = pure_seq(spark, d)
    seqs = F.struct(F.array(F.struct(F.lit("s").alias("sequenceID"), F.col("dna").alias("nucleotides"))).alias("sequence"))
    p = s.select(F.to_json(F.struct(F.col("event_id").cast("string").alias("record_id"), seqs.alias("sequences"))).alias("payload"))
    return readers.dna_records(p).select(F.col("record_id").cast("long").alias("event_id"), F.substring(sq.clean_dna(F.col("nucleotides")), 1, 3).alias("head"))


def _uri(path: str) -> str:
    """A path as executors' file systems take it: with its scheme, that of local files with three slashes."""
    path = path if "://" in path or path.startswith("file:") else "file://" + path
    return "file:///" + path[5:].lstrip("/") if path.startswith("file:") else path


def _written(spark: SparkSession) -> str:
    """The cube as one NetCDF file a day."""
    out = _uri(folder(spark, "netcdf"))
    x = cube(spark).select(F.date_format("time", "yyyy-MM-dd").alias("day"), "time", F.col("level").alias("pressure_level"), (F.lit(40.0) + F.col("lat_idx") * 0.25).alias("latitude"), (F.lit(5.0) + F.col("lon_idx") * 0.25).alias("longitude"), "value")
    sinks.write_netcdf(x, out, "day", "time", ["pressure_level", "latitude", "longitude"], ["value"]).count()
    return out


@query(f"WITH {CUBE} SELECT time, level::INT AS level, 40 + lat_idx * 0.25::DOUBLE AS latitude, 5 + lon_idx * 0.25::DOUBLE AS longitude, value FROM cube")
def netcdf_read(spark: SparkSession, d: str) -> DataFrame:
    x = readers.netcdf(spark, _written(spark), ["value", "absent"])
    return x.select(ntz(F.col("time")).alias("time"), "level", "latitude", "longitude", "value")


@query(f"WITH {CUBE} SELECT time, level::INT AS level, 40 + lat_idx * 0.25::DOUBLE AS latitude, value FROM cube WHERE strftime(time, '%Y-%m') = '2024-01' AND lat_idx IN (0, 4) AND lon_idx = 3")
def netcdf_selected(spark: SparkSession, d: str) -> DataFrame:
    """Steps of one month, at exact grid points."""
    x = readers.netcdf(spark, _written(spark), ["value"], ["2024-01"], [40.0, 41.0, 40.1], [5.75])
    return x.select(ntz(F.col("time")).alias("time"), "level", "latitude", "value")


# The SQL surface, streams and spelling


@query(f"WITH {OBS} SELECT event_id, round_even(lat / 0.5, 0) * 0.5::DOUBLE AS cell, date_trunc('day', ts) + to_hours(least(18, ceil((hour(ts) * 60 + minute(ts) - 180) / 360.0)::INT * 6)) AS slot, round(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(50 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(50)) * pow(sin(radians(10 - lon) / 2), 2)))), 4) AS km FROM obs")
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """The engine's scalar functions within a SQL text."""
    register.register(spark)
    return spark.sql("SELECT event_id, snap_to(lat, 0.5D) AS cell, CAST(slot_of_six_hours(CAST(ts AS TIMESTAMP)) AS TIMESTAMP_NTZ) AS slot, round(distance_km(lat, canonical_longitude(lon), 50.0D, 10.0D), 4) AS km FROM {o}", o=obs(spark, d))


@query(f"WITH {PURE}, k AS (SELECT event_id, unnest(range(0, 23))::INT AS pos, dna FROM pure) SELECT pos, substr(dna, pos + 1, 8)[1:3] AS head, count(*) AS n FROM k GROUP BY ALL")
def table_function(spark: SparkSession, d: str) -> DataFrame:
    """A table function joined laterally in SQL: words of eight bases, and a user's function on them."""
    register.register(spark)
    register.register_user(spark, "first_three", lambda s: s.str.slice(0, 3), "string")
    return spark.sql("SELECT pos, first_three(kmer) AS head, count(*) AS n FROM {x}, LATERAL kmer_rows(dna, 8) GROUP BY ALL", x=pure_seq(spark, d))


@query(f"WITH {OBS} SELECT species, round_even(lat / 0.25, 0) * 0.25::DOUBLE + 0 AS cell_lat, round_even(lon / 0.25, 0) * 0.25::DOUBLE + 0 AS cell_lon, date_trunc('day', ts) + to_hours(least(18, ceil((hour(ts) * 60 + minute(ts) - 180) / 360.0)::INT * 6)) AS slot, round(sum(dist), 6) AS total, count(*) AS n FROM obs GROUP BY ALL")
def stream_totals(spark: SparkSession, d: str) -> DataFrame:
    """Sums a species, cell and slot of the observations as a stream, kept up to date in a table."""
    out, progress, source = folder(spark, "totals"), folder(spark, "progress"), table(spark, d, "events")
    s = spark.readStream.schema(source.schema).parquet(f"{d}/events.parquet*")
    s = s.selectExpr("user_id AS species", "ts", "34.0D + (event_id * 37 % 3801) / 100.0D AS lat", "-30.0D + (event_id * 91 % 8001) / 100.0D AS lon", "value AS dist")
    stream.keep(stream.slot_totals(s, "ts", "lat", "lon", "species", "dist", "400 days"), out, progress).awaitTermination()
    return spark.read.parquet(out).withColumns({"slot": ntz(F.col("slot")), "total": r6("total"), "cell_lat": F.col("cell_lat") + 0.0, "cell_lon": F.col("cell_lon") + 0.0})


@query(f"WITH {_WORDS}, v AS (SELECT term, sum(n) AS n FROM c WHERE regexp_full_match(term, '[a-z]+') GROUP BY term), p AS (SELECT a.term, b.term AS correction, row_number() OVER (PARTITION BY a.term ORDER BY b.n DESC, b.term) AS r FROM v a JOIN v b ON a.n < 3 AND b.n >= 20 AND length(a.term) >= 4 AND length(b.term) >= 4 AND abs(length(a.term) - length(b.term)) <= 1 AND levenshtein(a.term, b.term) = 1) SELECT term, correction FROM p WHERE r = 1")
def spelling_corrections(spark: SparkSession, d: str) -> DataFrame:
    """Rare words of plain letters with the common word that differs by one letter."""
    v = tx.term_counts(table(spark, d, "documents"), "doc_id", tx.tokens(F.col("text"))).filter(F.col("term").rlike(r"\A[a-z]+\z")).groupBy("term").agg(F.sum("n").alias("n"))
    return pl.corrections(v, "term", "n", 3, 20)


@query("SELECT DISTINCT header, variable, month, year FROM (SELECT 'Agri_' || year(o_orderdate) AS header, 'Agri' AS variable, NULL::INT AS month, year(o_orderdate)::INT AS year FROM orders UNION ALL SELECT 'NDVI_' || strftime(o_orderdate, '%m/%Y'), 'NDVI', month(o_orderdate)::INT, year(o_orderdate)::INT FROM orders UNION ALL SELECT month(o_orderdate) || '/' || year(o_orderdate), NULL, month(o_orderdate)::INT, year(o_orderdate)::INT FROM orders UNION ALL SELECT year(o_orderdate)::VARCHAR, NULL, NULL, year(o_orderdate)::INT FROM orders)")
def header_parts(spark: SparkSession, d: str) -> DataFrame:
    """Names of period columns, among names that are none."""
    o = table(spark, d, "orders")
    forms = F.array(*[F.concat(F.lit(p), F.date_format("o_orderdate", f)) for p, f in (("Agri_", "yyyy"), ("NDVI_", "MM/yyyy"), ("", "M/yyyy"), ("", "yyyy"), ("Land_", "yy"), ("", "yyyy-MM"))])
    x = o.select(F.explode(forms).alias("header")).distinct().withColumn("p", rs.header_parts(F.col("header")))
    return x.filter("p IS NOT NULL").select("header", "p.*")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN date_trunc('day', o_orderdate) END AS ts FROM orders")
def coerced_times(spark: SparkSession, d: str) -> DataFrame:
    """Every order's date in one of three notations or as no date."""
    k, at = F.col("o_orderkey") % 4, lambda f: F.date_format("o_orderdate", f)
    text = F.when(k == 0, at("yyyy-MM-dd HH:mm:ss")).when(k == 1, at("yyyy-MM-dd")).when(k == 2, at("dd/MM/yyyy")).otherwise(F.concat(F.lit("about "), at("yyyy")))
    ts = tm.coerced(F.col("text"), ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy"])
    return table(spark, d, "orders").select("o_orderkey", text.alias("text")).select("o_orderkey", ntz(F.date_trunc("DAY", ts)).alias("ts"))


@query("SELECT event_id, date_trunc('day', ts) + CASE event_id % 5 WHEN 0 THEN to_minutes(hour(ts) * 60 + minute(ts)) WHEN 1 THEN INTERVAL 6 HOUR WHEN 2 THEN to_hours(hour(ts)) WHEN 3 THEN to_minutes(hour(ts) * 60 + minute(ts)) ELSE INTERVAL 12 HOUR END - INTERVAL 2 HOUR AS at FROM events")
def free_text_times(spark: SparkSession, d: str) -> DataFrame:
    """Every event's time in one of five notations, two hours east of UTC."""
    k, at = F.col("event_id") % 5, lambda f: F.date_format("ts", f)
    text = F.when(k == 0, F.concat(at("h.mm"), F.lit(" "), F.lower(at("a")))).when(k == 1, F.lit("Dawn")).when(k == 2, at("HH")).when(k == 3, at("HH:mm")).otherwise(F.lit("PM"))
    return table(spark, d, "events").select("event_id", ntz(tm.free_text_time(at("yyyy-MM-dd"), text, F.lit("+02:00"))).alias("at"))


@query("SELECT DISTINCT date_trunc('hour', ts) AS timestamp FROM events WHERE ts IS NOT NULL")
def sorted_times(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.concat(F.lit("['"), F.date_format(F.date_trunc("HOUR", "ts"), "yyyy-MM-dd HH:mm:ss"), F.lit("']")).alias("t"))
    return sinks.sorted_times(e, "t").select(ntz(F.col("timestamp")).alias("timestamp"))


@query(f"WITH {OBS}, x AS (SELECT cls, CASE WHEN event_id % 7 = 0 THEN 'Infinity'::DOUBLE WHEN event_id % 11 = 0 THEN 'NaN'::DOUBLE ELSE dist END AS v FROM obs) SELECT cls, count(*) FILTER (isfinite(v)) AS count_valid, count(*) FILTER (NOT isfinite(v)) AS count_nan, round(avg(v) FILTER (isfinite(v)), 6) AS mean, max(v) FILTER (isfinite(v)) AS max FROM x GROUP BY cls")
def moments_finite(spark: SparkSession, d: str) -> DataFrame:
    """Moments where some values are infinite or NaN."""
    k = F.col("event_id")
    x = obs(spark, d).withColumn("v", F.when(k % 7 == 0, F.lit(float("inf"))).when(k % 11 == 0, F.lit(float("nan"))).otherwise(F.col("dist")))
    return ag.moments(x, "v", ["cls"], skip_infinite=True).select("cls", "count_valid", "count_nan", r6("mean").alias("mean"), "max")


@query("SELECT vec_id, list_sum(list_transform(embedding, lambda x: (trunc(x::DOUBLE * 1000))::INT))::BIGINT AS total FROM embeddings")
def tensor_cast(spark: SparkSession, d: str) -> DataFrame:
    v = bt.cast_tensor(F.transform("embedding", lambda x: x.cast("double") * 1000), "int")
    return table(spark, d, "embeddings").select("vec_id", F.aggregate(v, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("SELECT image_id AS observation_id, coalesce(scientific_name, 'Unknown') AS scientific_name, coalesce(genus, 'Unknown') AS genus, 0::INT AS photo FROM (SELECT DISTINCT image_id, scientific_name, genus FROM image_metadata)")
def observation_pages(spark: SparkSession, d: str) -> DataFrame:
    """Observation JSON with ranks among ancestors and a photo each, parsed."""
    i = once(table(spark, d, "image_metadata").select("image_id", "scientific_name", "genus"), "image_id")
    ancestors = F.when(F.col("genus").isNotNull(), F.array(F.struct(F.lit("genus").alias("rank"), F.col("genus").alias("name"))))
    o = F.struct(F.col("image_id").alias("id"), F.struct(F.col("scientific_name").alias("name")).alias("taxon"), F.array(F.struct(F.struct(ancestors.alias("ancestors")).alias("taxon"))).alias("identifications"), F.array(F.struct(F.lit("https://img.example/square.jpg").alias("url"))).alias("photos"))
    return readers.observations(i.select(F.to_json(o).alias("payload"))).select("observation_id", "scientific_name", "genus", "photo")


@query("SELECT event_id FROM events WHERE event_type IN ('view', 'click') AND event_id % 3 <> 1")
def good_recordings(spark: SparkSession, d: str) -> DataFrame:
    """Recordings of good quality that name no second species."""
    q = F.when(F.col("event_type") == "view", "A").when(F.col("event_type") == "click", "B").otherwise("C")
    also = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(""))).when(F.col("event_id") % 3 == 1, F.array(F.lit("Parus major")))
    return readers.good_recordings(table(spark, d, "events").select("event_id", q.alias("q"), also.alias("also"))).select("event_id")


@query("SELECT event_type AS kind, event_id::VARCHAR AS id, CASE WHEN event_id % 2 = 0 THEN 'odd later file' ELSE 'first file' END AS note FROM events WHERE event_type IS NOT NULL")
def zipped_tables(spark: SparkSession, d: str) -> DataFrame:
    """ZIP files of tab-separated tables; of a record that two files have, the last file's row."""
    from fieldloom.sources.readers import latest_by_key, zipped_tsv

    out = _uri(folder(spark, "zips"))
    e = table(spark, d, "events").filter("event_type IS NOT NULL").select("event_type", F.col("event_id").cast("string").alias("id"), F.col("event_id").alias("n"))
    first = e.select(F.concat(F.lit("a_"), "event_type").alias("file"), "event_type", "id", F.lit("first file").alias("note"))
    later = e.filter("n % 2 = 0").select(F.concat(F.lit("b_"), "event_type").alias("file"), "event_type", "id", F.lit("odd later file").alias("note"))
    sinks.write_zipped(first.unionByName(later), out, "file", ["event_type", "id", "note"]).count()
    x = latest_by_key(zipped_tsv(spark, out, ["Event_Type", "id", "note"]), "id")
    return x.select(F.col("Event_Type").alias("kind"), "id", "note")
