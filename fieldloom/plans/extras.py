"""Queries of the remaining operators: filters, quality checks, reports, lookups, and the features that SQL can't express."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fieldloom.functions import codec, geo, media, stem
from fieldloom.functions import text as tx
from fieldloom.functions import time as tm
from fieldloom.functions.timeparse import with_instant
from fieldloom.operators import aggregates as ag
from fieldloom.operators import joins as jn
from fieldloom.operators import regular
from fieldloom.operators import reshape as rs
from fieldloom.operators.timestamps import once
from fieldloom.plans.stages import literals, values
from fieldloom.plans.views import BOXES, CUBE, OBS, Register, boxes, cube, obs
from fieldloom.sources.tables import table

query = Register()
r6 = lambda c: F.round(c, 6)


@query(f"WITH {OBS}, {BOXES}, c AS (SELECT country, (lat_lo + lat_hi) / 2 AS la, (lon_lo + lon_hi) / 2 AS lo FROM boxes), x AS (SELECT event_id, arg_min(country, (sqrt(pow(lat - la, 2) + pow(lon - lo, 2)), country)) AS country FROM obs, c GROUP BY event_id) SELECT country, count(*) AS n FROM x GROUP BY country")
def reverse_geocode(spark: SparkSession, d: str) -> DataFrame:
    places = boxes(spark, d).select("country", ((F.col("lat_lo") + F.col("lat_hi")) / 2).alias("la"), ((F.col("lon_lo") + F.col("lon_hi")) / 2).alias("lo"))
    o = obs(spark, d)
    return o.join(jn.nearest_point(o, "lat", "lon", places, "la", "lo", "country"), ["lat", "lon"]).groupBy("country").agg(F.count(F.lit(1)).alias("n"))


# Spellings of two country codes, and of country names.
ISO_ALIASES = {"EL": "GR", "^GR$|^EL$": "GR", "UK": "GB", "^GB$|^UK$": "GB"}
_CODES = [("EL",), ("GR",), ("UK",), ("GB",), ("^GB$|^UK$",), ("FR",), (None,)]


@query(f"SELECT code, CASE WHEN code IN ('EL', '^GR$|^EL$') THEN 'GR' WHEN code IN ('UK', '^GB$|^UK$') THEN 'GB' ELSE code END AS iso FROM (VALUES {values(_CODES)}) v(code)")
def iso_codes(spark: SparkSession, d: str) -> DataFrame:
    return literals(spark, "code string", _CODES).withColumn("iso", F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ISO_ALIASES.items() for x in kv]), "code"), "code"))


@query("SELECT lower(trim(country)) AS name, count(DISTINCT row_id) AS n FROM (SELECT row_id, CASE WHEN lower(trim(country)) = 'iskeland' THEN 'Iceland' WHEN lower(trim(country)) = 'ulmenia' THEN 'Romania' ELSE country END AS country FROM agri_grid) GROUP BY 1")
def alias_replace(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "agri_grid").select("row_id", jn.normal_name(F.col("country")).alias("name")).replace({"iskeland": "iceland", "ulmenia": "romania"}, subset=["name"])
    return x.groupBy("name").agg(F.count_distinct("row_id").alias("n"))


@query("SELECT scientific_name, min(image_id) AS image_id, regexp_replace(arg_min(photo_url, image_id), '\\.jpg$', '.wav') AS media FROM image_metadata WHERE scientific_name IS NOT NULL GROUP BY scientific_name")
def first_row_metadata(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "image_metadata").filter("scientific_name IS NOT NULL")
    return x.groupBy("scientific_name").agg(F.min("image_id").alias("image_id"), F.regexp_replace(F.min_by("photo_url", "image_id"), r"\.jpg$", ".wav").alias("media"))


@query(f"WITH {OBS} SELECT 'rows' AS section, '' AS item, count(*)::DOUBLE AS value FROM obs UNION ALL SELECT 'class', cls, count(*) FROM obs GROUP BY cls UNION ALL SELECT 'richness', cls, count(DISTINCT species) FROM obs GROUP BY cls")
def report_sections(spark: SparkSession, d: str) -> DataFrame:
    o = obs(spark, d)
    row = lambda s, df, i, v: df.select(F.lit(s).alias("section"), i.alias("item"), v.cast("double").alias("value"))
    n = o.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("species").alias("s"))
    return row("rows", o.agg(F.count(F.lit(1)).alias("n")), F.lit(""), F.col("n")).unionByName(row("class", n, F.col("cls"), F.col("n"))).unionByName(row("richness", n, F.col("cls"), F.col("s")))


@query("SELECT label, sum(len(embedding) * 4)::BIGINT AS bytes FROM embeddings GROUP BY label")
def byte_sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").groupBy("label").agg(F.sum(F.size("embedding") * 4).cast("bigint").alias("bytes"))


@query("SELECT record_id, nullif(regexp_extract(timestamp, '(^|[^0-9])([0-9]{4})([^0-9]|$)', 2), '')::INT AS year FROM (SELECT DISTINCT record_id, timestamp FROM species_dataset)")
def fuzzy_years(spark: SparkSession, d: str) -> DataFrame:
    return once(table(spark, d, "species_dataset").select("record_id", "timestamp"), "record_id").select("record_id", tm.fuzzy_year(F.col("timestamp")).alias("year"))


@query(f"WITH {CUBE} SELECT time, level, round(avg(value), 6) AS mean FROM cube WHERE date_trunc('month', time) IN (TIMESTAMP '2024-01-01') AND time = TIMESTAMP '2024-01-02 06:00:00' GROUP BY ALL")
def time_slice(spark: SparkSession, d: str) -> DataFrame:
    x = cube(spark).filter(tm.month_start(F.col("time")).isin("2024-01-01 00:00:00") & (F.col("time") == F.lit("2024-01-02 06:00:00").cast("timestamp_ntz")))
    return x.groupBy("time", "level").agg(r6(F.avg("value")).alias("mean"))


@query("SELECT DISTINCT row_id, ndvi FROM ndvi_grid WHERE ndvi <> 255 AND ndvi > 0.2 AND NOT isnan(ndvi)")
def nodata_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ndvi_grid").select("row_id", "ndvi").filter((F.col("ndvi") != 255) & (F.col("ndvi") > 0.2) & ~F.isnan("ndvi")).distinct()


@query("SELECT count(*) AS rows_checked, count(*) FILTER (coalesce(latitude BETWEEN -90 AND 90, false)) AS good_lat, count(*) FILTER (coalesce(longitude BETWEEN -180 AND 360, false)) AS good_lon, count(DISTINCT record_id) AS records, count(*) FILTER (genus IS NULL) AS no_genus FROM species_dataset")
def quality_checks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "species_dataset").agg(
        F.count(F.lit(1)).alias("rows_checked"), F.count_if(F.col("latitude").between(-90, 90)).alias("good_lat"), F.count_if(F.col("longitude").between(-180, 360)).alias("good_lon"),
        F.count_distinct("record_id").alias("records"), F.count_if(F.col("genus").isNull()).alias("no_genus"),
    )


@query("WITH s AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders), r AS (SELECT unnest(generate_series(a, b, INTERVAL 183 DAY))::DATE AS first_day, b FROM s) SELECT first_day, least(first_day + 182, b) AS last_day FROM r")
def date_ranges(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return s.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 183 DAY"))).alias("first_day"), "b").select("first_day", F.least(F.date_add("first_day", 182), F.col("b")).alias("last_day"))


@query("SELECT round_even((latitude - 32) / 0.5, 0)::INT AS lat_idx, round_even(((CASE WHEN longitude > 180 THEN longitude - 360 ELSE longitude END) + 30) / 0.5, 0)::INT AS lon_idx, month_year, round(avg(ndvi), 9) AS ndvi FROM (SELECT DISTINCT row_id, latitude, longitude, month_year, ndvi FROM ndvi_grid) WHERE ndvi BETWEEN -0.2 AND 1 AND NOT isnan(ndvi) GROUP BY ALL")
def raster_cell_mean(spark: SparkSession, d: str) -> DataFrame:
    x = once(table(spark, d, "ndvi_grid"), "row_id").filter(F.col("ndvi").between(-0.2, 1) & ~F.isnan("ndvi"))
    lon = F.when(F.col("longitude") > 180, F.col("longitude") - 360).otherwise(F.col("longitude"))
    return x.groupBy(geo.axis_index(F.col("latitude"), 32.0, 0.5).alias("lat_idx"), geo.axis_index(lon, -30.0, 0.5).alias("lon_idx"), "month_year").agg(F.round(F.avg("ndvi"), 9).alias("ndvi"))


_MONTHS = [f"{m % 12 + 1:02d}/{2018 + m // 12}" for m in range(18)]  # those of the given tables, which SQL has to name


@query("SELECT latitude, longitude, " + ", ".join(f"max(ndvi) FILTER (month_year = '{m}') AS \"NDVI_{m}\"" for m in _MONTHS) + " FROM ndvi_grid WHERE ndvi BETWEEN -0.2 AND 1 AND NOT isnan(ndvi) GROUP BY ALL")
def ndvi_month_columns(spark: SparkSession, d: str) -> DataFrame:
    """A column for each month that the table has, in the order of the calendar, which also bounds their number."""
    x = table(spark, d, "ndvi_grid")
    found = x.select("month_year").filter(F.col("month_year").rlike("^(0[1-9]|1[0-2])/[0-9]{4}$")).distinct().collect()
    months = sorted((r["month_year"] for r in found), key=lambda m: (m[3:], m[:2]))
    x = x.filter(F.col("ndvi").between(-0.2, 1) & ~F.isnan("ndvi"))
    return x.groupBy("latitude", "longitude").agg(*[F.max(F.when(F.col("month_year") == m, F.col("ndvi"))).alias(f"NDVI_{m}") for m in months])


@query("WITH x AS (SELECT DISTINCT site_id, binomial, latitude, longitude, y1970, y1980, y1990, y2000, y2010, y2020 FROM distribution) SELECT site_id, make_timestamp(right(k, 4)::INT, 1, 1, 0, 0, 0) AS ts, v AS dist FROM (UNPIVOT x ON y1970, y1980, y1990, y2000, y2010, y2020 INTO NAME k VALUE v) WHERE NOT isnan(v)")
def distribution_rows(spark: SparkSession, d: str) -> DataFrame:
    x = once(table(spark, d, "distribution"), "site_id")
    x = x.withColumnsRenamed({c: f"dist_{c[1:]}" for c in x.columns if c[:1] == "y" and c[1:].isdigit()})
    return rs.unpivot_periods(x, ["site_id"], "dist").select("site_id", F.make_timestamp_ntz(F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("ts"), "dist")


@query("WITH x AS (SELECT DISTINCT row_id, variable_name, agri_1998, agri_1999, agri_2000, agri_2001, agri_2002 FROM agri_grid) SELECT variable_name, right(k, 4)::INT AS year, count(*) AS n, round(avg(v), 9) AS mean FROM (UNPIVOT x ON agri_1998, agri_1999, agri_2000, agri_2001, agri_2002 INTO NAME k VALUE v) WHERE v BETWEEN 0 AND 100 AND NOT isnan(v) GROUP BY ALL")
def agriculture_long(spark: SparkSession, d: str) -> DataFrame:
    x = rs.unpivot_periods(once(table(spark, d, "agri_grid"), "row_id"), ["variable_name"]).filter(F.col("value").between(0, 100))
    return x.groupBy("variable_name", "year").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 9).alias("mean"))


@query("""WITH i AS (SELECT DISTINCT image_id, lower(scientific_name) AS name FROM image_metadata), a AS (SELECT DISTINCT audio_id, lower(scientific_name) AS name FROM audio_metadata)
SELECT name, image_id, audio_id FROM i JOIN a USING (name) QUALIFY row_number() OVER (PARTITION BY name ORDER BY image_id, audio_id) <= 3""")
def image_audio_top3(spark: SparkSession, d: str) -> DataFrame:
    side = lambda t, k: once(table(spark, d, t).select(k, F.lower("scientific_name").alias("name")), k).filter("name IS NOT NULL")
    return jn.media_pairs(side("image_metadata", "image_id"), side("audio_metadata", "audio_id"), "name", "image_id", "audio_id")


@query("SELECT i.image_id, coalesce(i.genus, a.genus, 'Unknown') AS genus FROM (SELECT DISTINCT image_id, genus, scientific_name FROM image_metadata) i LEFT JOIN (SELECT scientific_name, min(genus) AS genus FROM audio_metadata GROUP BY 1) a USING (scientific_name)")
def taxonomy_fallback(spark: SparkSession, d: str) -> DataFrame:
    i = once(table(spark, d, "image_metadata").select("image_id", "genus", "scientific_name"), "image_id")
    a = table(spark, d, "audio_metadata").groupBy("scientific_name").agg(F.min("genus").alias("g"))
    return i.join(a, "scientific_name", "left").select("image_id", F.coalesce("genus", "g", F.lit("Unknown")).alias("genus"))


@query(f"WITH {OBS}, k AS (SELECT cls AS value, row_number() OVER (ORDER BY min(event_id)) - 1 AS id FROM obs GROUP BY 1) SELECT event_id, id AS label, value AS name FROM obs JOIN k ON cls = value")
def label_lookup(spark: SparkSession, d: str) -> DataFrame:
    o = obs(spark, d)
    labels = ag.dense_labels(o, "cls", "event_id")
    return o.join(labels, F.col("cls") == F.col("value")).select("event_id", F.col("id").alias("label"), F.col("value").alias("name"))


@query(f"WITH {OBS}, {CUBE}, c AS (SELECT date_trunc('day', time) AS day, avg(value) AS climate FROM cube GROUP BY 1), r AS (SELECT date_trunc('day', ts) AS day, count(DISTINCT species) AS richness FROM obs GROUP BY 1) SELECT day, richness, round(climate, 6) AS climate FROM r JOIN c USING (day)")
def climate_biodiversity(spark: SparkSession, d: str) -> DataFrame:
    day = lambda c: F.date_trunc("DAY", c).cast("timestamp_ntz").alias("day")
    c = cube(spark).groupBy(day("time")).agg(r6(F.avg("value")).alias("climate"))
    return obs(spark, d).groupBy(day("ts")).agg(F.count_distinct("species").alias("richness")).join(c, "day")


@query()
def species_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Observations with snapped coordinates, six-hour slot and the sentinel texts as null; without SQL as the time texts have many notations."""
    x = once(table(spark, d, "species_dataset").select("record_id", "species", "latitude", "longitude", "timestamp", "redlist"), "record_id")
    x = with_instant(x.filter(geo.is_location(F.col("latitude"), F.col("longitude"))), F.col("timestamp"), "seconds").filter("seconds IS NOT NULL")
    return x.select("record_id", "species", geo.snap(F.col("latitude")).alias("lat"), geo.snap(geo.canonical_lon(F.col("longitude"))).alias("lon"), tm.six_hour_slot(F.timestamp_seconds("seconds")).alias("slot"), F.when(F.col("redlist").between(1, 7), F.col("redlist")).alias("redlist"))


@query()
def species_cube(spark: SparkSession, d: str) -> DataFrame:
    """Monthly sums a species and quarter-degree cell of the cell cube; without SQL as it needs the map projection."""
    x = geo.with_eea(regular.cube_readings(table(spark, d, "cell_cube")), F.col("eeacellcode"), "p")
    lat, lon = geo.laea_inverse(*[c.cast("double") for c in geo.eea_metres(F.col("p"))])
    x = x.select("specieskey", geo.snap(lat).alias("latitude"), geo.snap(lon).alias("longitude"), regular.month_text(F.col("__month")).alias("period"), "__count")
    return x.groupBy("specieskey", "latitude", "longitude", "period").agg(F.sum("__count").alias("distribution"))


@query()
def stem_counts(spark: SparkSession, d: str) -> DataFrame:
    """Stems of the words of all documents with their number."""
    x = table(spark, d, "documents").select(F.explode(tx.tokens(F.col("text"))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return x.select(F.element_at(stem.stemmed(F.array("w")), 1).alias("stem"), "n").groupBy("stem").agg(F.sum("n").alias("n"))


@query()
def vector_pca(spark: SparkSession, d: str) -> DataFrame:
    return codec.reduced(table(spark, d, "embeddings"), "embedding", 8).select("vec_id", "reduced")


@query()
def vector_codec(spark: SparkSession, d: str) -> DataFrame:
    """Vectors to base64 text and back."""
    x = table(spark, d, "embeddings").withColumn("code", codec.to_base64("embedding"))
    return x.select("vec_id", "code", (codec.from_base64("code") == F.col("embedding")).alias("same"))


@query()
def audio_features(spark: SparkSession, d: str) -> DataFrame:
    """Cepstral coefficients of the vectors read as short waves."""
    f = media.applied(lambda v: media.mfcc(np.tile(v, 16), 8000, size=256, hop=128, bands=20).mean(1))
    return table(spark, d, "embeddings").select("vec_id", f(F.transform("embedding", lambda v: v.cast("double"))).alias("mfcc"))


@query()
def image_features(spark: SparkSession, d: str) -> DataFrame:
    """Gradient histogram and mean edge of the vectors read as 8 by 8 images."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    h, e = media.applied(lambda a: media.hog(a.reshape(8, 8), 4)), media.applied(lambda a: float(media.edges(a.reshape(8, 8)).mean()), T.DoubleType())
    return table(spark, d, "embeddings").select("vec_id", h(v).alias("hog"), e(v).alias("edge"))
