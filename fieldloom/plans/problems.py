"""Queries of the general data-preparation problems (1, 2, 3, 4 and 6) and the SQL that checks them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldloom.functions.geo import canonical_lon, is_location
from fieldloom.operators import drift, dualtree, impute, regular, timestamps
from fieldloom.operators.joins import points_in_regions
from fieldloom.plans.views import BOXES, boxes
from fieldloom.sources.tables import table

RADIUS_KM = 2.0


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of site and observation at most 2 km apart."""
    return dualtree.dual_tree_pairs(table(spark, d, "distribution"), table(spark, d, "species_dataset"), RADIUS_KM, "site_id", "record_id")


def p1_distances(spark: SparkSession, d: str) -> DataFrame:
    """The same pairs with their distance."""
    x = dualtree.dual_tree_pairs(table(spark, d, "distribution"), table(spark, d, "species_dataset"), RADIUS_KM, "site_id", "record_id", with_distance=True)
    return x.withColumn("distance_km", F.round("distance_km", 6))


def p1_regions(spark: SparkSession, d: str) -> DataFrame:
    """Observations with the region that contains them: the nations' boxes, each with a hole in its middle."""
    c = F.col
    ring = lambda x0, x1, y0, y1: F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])
    b = boxes(spark, d).select("country", F.array(ring(c("lon_lo"), c("lon_hi"), c("lat_lo"), c("lat_hi")), ring(c("lon_lo") + 2, c("lon_hi") - 2, c("lat_lo") + 1.5, c("lat_hi") - 1.5)).alias("rings"))
    s = table(spark, d, "species_dataset").filter(is_location(c("latitude"), c("longitude"))).select("record_id", c("latitude").alias("lat"), canonical_lon(c("longitude")).alias("lon")).distinct()
    return points_in_regions(s, "lat", "lon", b, "country", "rings").select("record_id", "country")


def _filled(spark: SparkSession, d: str, name: str, spec: impute.Spec) -> DataFrame:
    """The rows that got a value; they depend on the decoded value, so that the decoding isn't pruned."""
    x = impute.impute(table(spark, d, name), spec).filter(F.col("filled_value").isNotNull() & ~F.isnan("filled_value"))
    return x.select(F.lit(name).alias("table_name"), F.col(spec.key).alias("row_key"), F.lit(spec.target).alias("field_name"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every value that the dependency tree could fill, of the three tables."""
    specs = (("species_dataset", impute.redlist_spec), ("agri_grid", impute.agri_spec), ("ndvi_grid", impute.ndvi_spec))
    with ThreadPoolExecutor(len(specs)) as pool:  # the three trees are learnt side by side
        parts = list(pool.map(lambda x: _filled(spark, d, x[0], x[1]()), specs))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p2_marks(spark: SparkSession, d: str) -> DataFrame:
    """Every record of the three completed tables: its own value, and whether it got one."""
    parts = []
    for name, spec in (("species_dataset", impute.redlist_spec()), ("agri_grid", impute.agri_spec()), ("ndvi_grid", impute.ndvi_spec())):
        x = impute.complete_table(table(spark, d, name), spec)
        own = F.when(impute.usable(F.col(spec.target), spec.low, spec.high), F.col(spec.target).cast("double"))
        parts.append(x.filter(own.isNotNull() | ~F.col("was_filled") | F.col(f"{spec.target}_filled").between(spec.low, spec.high)).select(F.lit(name).alias("table_name"), F.col(spec.key).alias("row_key"), own.alias("observed"), "was_filled"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p2_species_dataset(spark: SparkSession, d: str) -> DataFrame:
    return impute.complete_table(table(spark, d, "species_dataset"), impute.redlist_spec())


def p2_agri_grid(spark: SparkSession, d: str) -> DataFrame:
    return impute.complete_table(table(spark, d, "agri_grid"), impute.agri_spec())


def p2_ndvi_grid(spark: SparkSession, d: str) -> DataFrame:
    return impute.complete_table(table(spark, d, "ndvi_grid"), impute.ndvi_spec())


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Missing months of the monthly grid that got an estimate; as an estimate is never null or NaN, these are all."""
    return regular.cube_series(table(spark, d, "cell_cube")).filter("is_missing AND filled IS NOT NULL AND NOT isnan(filled)").select("specieskey", "eeacellcode", "period")


def p3_series(spark: SparkSession, d: str) -> DataFrame:
    """The complete monthly series, missing months marked and estimated."""
    return regular.cube_series(table(spark, d, "cell_cube"))


def p3_marks(spark: SparkSession, d: str) -> DataFrame:
    """The complete series with its observed values; every missing month is marked and has an estimate."""
    x = regular.cube_series(table(spark, d, "cell_cube")).filter("filled >= 0 AND (is_missing OR filled = occurrences)")
    return x.select("specieskey", "eeacellcode", "period", F.round("occurrences", 6).alias("occurrences"), "is_missing")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Changes of each file against the one before."""
    return drift.schema_changes(table(spark, d, "raw_records"))


def p4_paths(spark: SparkSession, d: str) -> DataFrame:
    """Changes of all paths, those within objects and arrays too."""
    return drift.schema_changes(table(spark, d, "raw_records"), nested=True)


def p4_cell_cube(spark: SparkSession, d: str) -> DataFrame:
    return drift.consistent_table(table(spark, d, "raw_records"), "cell_cube")


def p4_era5_single(spark: SparkSession, d: str) -> DataFrame:
    return drift.consistent_table(table(spark, d, "raw_records"), "era5_single")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """UTC times of both tables wherever the text denotes exactly one instant."""
    s = table(spark, d, "species_dataset").select("record_id", "timestamp")
    s = timestamps.normalise_single(s.filter(~F.col("timestamp").rlike(timestamps.CANONICAL)))
    o = timestamps.normalise_event(table(spark, d, "occurrence_dump").select("occurrence_id", "eventdate", "eventtime", "eventzone"))
    # The texts are parsed where they are read; only ids and times are shuffled to drop the repeated rows.
    out = lambda x, name, key: timestamps.once(x.filter(F.col("utc_time").isNotNull()).select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"), "utc_time"), "row_key")
    return out(s, "species_dataset", "record_id").unionByName(out(o, "occurrence_dump", "occurrence_id"))


QUERIES = {f.__name__: f for f in (p1_found, p1_distances, p1_regions, p2_found, p2_marks, p2_species_dataset, p2_agri_grid, p2_ndvi_grid, p3_found, p3_marks, p3_series, p4_found, p4_paths, p4_cell_cube, p4_era5_single, p6_found)}

_NEAR = """
WITH s AS (SELECT DISTINCT site_id, latitude AS la, CASE WHEN longitude >= 180 THEN longitude - 360 ELSE longitude END AS lo FROM distribution
           WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 360 AND NOT (latitude = 0 AND longitude = 0)),
     o AS (SELECT DISTINCT record_id, latitude AS la, CASE WHEN longitude >= 180 THEN longitude - 360 ELSE longitude END AS lo FROM species_dataset
           WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 360 AND NOT (latitude = 0 AND longitude = 0)),
     m AS (SELECT site_id, record_id, 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(o.la - s.la) / 2), 2) + cos(radians(s.la)) * cos(radians(o.la)) * pow(sin(radians(o.lo - s.lo) / 2), 2)))) AS km
           FROM s JOIN o ON s.la BETWEEN o.la - 0.02 AND o.la + 0.02)
"""
_DATE3 = """
WITH r AS (SELECT DISTINCT cube_id, specieskey, trim(yearmonthday) AS d, upper(trim(eeacellcode)) AS c, try_cast(trim(occurrences) AS DOUBLE) AS n FROM cell_cube),
     p AS (SELECT cube_id, specieskey, n,
             regexp_extract(c, '^(10KM)?([EW])([0-9]+)([NS])([0-9]+)$', ['k', 'ew', 'e', 'ns', 'n']) AS g, c,
             CASE WHEN regexp_full_match(d, '[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}(T.*)?') THEN regexp_extract(d, '^([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})', ['y', 'm', 'd'])
                  WHEN regexp_full_match(d, '[0-9]{8}') THEN regexp_extract(d, '^([0-9]{4})([0-9]{2})([0-9]{2})', ['y', 'm', 'd'])
                  WHEN regexp_full_match(d, '[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4}') THEN regexp_extract(d, '^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4})$', ['d', 'm', 'y'])
                  WHEN regexp_full_match(d, '[0-9]{4}[-/.][0-9]{1,2}') THEN {'y': split_part(replace(replace(d, '/', '-'), '.', '-'), '-', 1), 'm': split_part(replace(replace(d, '/', '-'), '.', '-'), '-', 2), 'd': '1'} END AS t
           FROM r WHERE n >= 0 AND isfinite(n) AND specieskey IS NOT NULL),
     q AS (SELECT specieskey,
             CASE WHEN g.e <> '' THEN '10km' || g.ew || try_cast(g.e AS BIGINT) || g.ns || try_cast(g.n AS BIGINT)
                  WHEN regexp_full_match(c, '[0-9]{8}') THEN '10kmE' || try_cast(left(c, 4) AS BIGINT) || 'N' || try_cast(right(c, 4) AS BIGINT) END AS cell,
             try_cast(lpad(t.y, 4, '0') || '-' || lpad(t.m, 2, '0') || '-' || lpad(t.d, 2, '0') AS DATE) AS day, t.y AS y, n FROM p),
     v AS (SELECT DISTINCT specieskey, cell, year(day) * 12 + month(day) - 1 AS m FROM q WHERE cell IS NOT NULL AND day IS NOT NULL AND try_cast(y AS INT) > 0),
     w AS (SELECT *, lead(m) OVER (PARTITION BY specieskey, cell ORDER BY m) AS m2 FROM v),
     x AS (SELECT specieskey, cell, unnest(range(m + 1, m2)) AS m FROM w WHERE m2 > m + 1)
"""
_DRIFT = """
WITH r AS (SELECT raw_id, any_value(feed_id) AS feed_id, any_value(feed_kind) AS kind, any_value(file_seq) AS file_seq, any_value(payload) AS p FROM raw_records GROUP BY raw_id),
     g AS (SELECT * FROM r WHERE json_valid(p) AND json_type(p) = 'OBJECT'),
     c AS (SELECT feed_id, file_seq, count(*) AS payloads FROM g GROUP BY ALL),
     k AS (SELECT raw_id, feed_id, kind, file_seq, p, unnest(json_keys(p)) AS key FROM g),
     t AS (SELECT feed_id, kind, file_seq, key, json_type(json_extract(p, '$."' || key || '"')) AS jt FROM k),
     u AS (SELECT feed_id, kind, file_seq, key, CASE jt WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'decimal' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' END AS ty, count(*) AS n FROM t GROUP BY ALL),
     b AS (SELECT feed_id, kind, file_seq, key, sum(n) AS n, arg_min(ty, (-n, ty)) FILTER (ty IS NOT NULL) AS ty FROM u GROUP BY ALL),
     s AS (SELECT b.*, lower(CASE WHEN starts_with(key, '_') OR ends_with(key, '_') THEN key ELSE replace(key, '_', '') END) AS flat FROM b JOIN c USING (feed_id, file_seq) WHERE n * 2 > payloads),
     a(kind, name, flat) AS (VALUES %s),
     f AS (SELECT s.feed_id, s.file_seq, coalesce(a.name, s.key) AS field_name, arg_max(s.key, (n, s.key)) AS key, arg_max(ty, (n, s.key)) AS ty FROM s LEFT JOIN a USING (kind, flat) GROUP BY 1, 2, 3),
     o AS (SELECT feed_id, file_seq, lag(file_seq) OVER (PARTITION BY feed_id ORDER BY file_seq) AS before FROM (SELECT DISTINCT feed_id, file_seq FROM raw_records)),
     now AS (SELECT f.* FROM f JOIN o USING (feed_id, file_seq) WHERE before IS NOT NULL),
     old AS (SELECT o.feed_id, o.file_seq, f.field_name, f.key, f.ty FROM f JOIN o ON f.feed_id = o.feed_id AND f.file_seq = o.before),
     j AS (SELECT coalesce(now.feed_id, old.feed_id) AS feed_id, coalesce(now.file_seq, old.file_seq) AS file_seq, coalesce(now.field_name, old.field_name) AS field_name, now.key AS k, old.key AS k0, now.ty AS t, old.ty AS t0
           FROM now FULL JOIN old ON now.feed_id = old.feed_id AND now.file_seq = old.file_seq AND now.field_name = old.field_name)
SELECT feed_id, file_seq, field_name, 'added' AS change_kind FROM j WHERE k0 IS NULL
UNION ALL SELECT feed_id, file_seq, field_name, 'removed' FROM j WHERE k IS NULL
UNION ALL SELECT feed_id, file_seq, field_name, 'renamed' FROM j WHERE k <> k0
UNION ALL SELECT feed_id, file_seq, field_name, 'retyped' FROM j WHERE t <> t0
"""


def _fillable(name: str, key: str, group: str, target: str, low: float, high: float) -> str:
    ok = f"coalesce({target} BETWEEN {low} AND {high} AND NOT isnan({target}::DOUBLE), false)"
    return f"""SELECT '{name}' AS table_name, k AS row_key, '{target}' AS field_name FROM (
      SELECT k, max(ok) AS ok, max(max(ok)) OVER (PARTITION BY g) AS any_ok FROM (SELECT {key} AS k, {group} AS g, {ok}::INT AS ok FROM {name} WHERE {key} IS NOT NULL AND {group} IS NOT NULL) GROUP BY k, g) WHERE ok = 0 AND any_ok = 1"""


def _marked(name: str, key: str, group: str, target: str, low: float, high: float) -> str:
    ok = f"coalesce({target} BETWEEN {low} AND {high} AND NOT isnan({target}::DOUBLE), false)"
    return f"""SELECT '{name}' AS table_name, k AS row_key, observed, ok = 0 AND coalesce(any_ok, 0) = 1 AND g IS NOT NULL AS was_filled FROM (
      SELECT k, g, max(v) AS observed, max(ok) AS ok, max(max(ok)) OVER (PARTITION BY g) AS any_ok FROM (SELECT {key} AS k, {group} AS g, {ok}::INT AS ok, CASE WHEN {ok} THEN {target}::DOUBLE END AS v FROM {name} WHERE {key} IS NOT NULL) GROUP BY k, g)"""


SQL = {
    "p2_marks": " UNION ALL ".join(
        [
            _marked("species_dataset", "record_id", "species", "redlist", 1, 7),
            _marked("agri_grid", "row_id", "variable_name || '|' || lower(trim(country))", "agri_2000", 0, 100),
            _marked("ndvi_grid", "row_id", "latitude || '|' || longitude", "ndvi", -0.2, 1),
        ]
    ),
    "p3_marks": _DATE3 + """, o AS (SELECT specieskey, cell, year(day) * 12 + month(day) - 1 AS m, sum(n) AS n FROM q WHERE cell IS NOT NULL AND day IS NOT NULL AND try_cast(y AS INT) > 0 GROUP BY ALL),
      a AS (SELECT specieskey, cell, m, round(n, 6) AS occurrences, false AS is_missing FROM o UNION ALL SELECT specieskey, cell, m, NULL, true FROM x)
      SELECT specieskey, cell AS eeacellcode, lpad((m // 12)::VARCHAR, 4, '0') || '-' || lpad((m % 12 + 1)::VARCHAR, 2, '0') AS period, occurrences, is_missing FROM a""",
    "p1_found": _NEAR + "SELECT DISTINCT site_id, record_id FROM m WHERE km <= 2",
    "p1_regions": f"""WITH {BOXES}, o AS (SELECT DISTINCT record_id, latitude AS lat, CASE WHEN longitude >= 180 THEN longitude - 360 ELSE longitude END AS lon FROM species_dataset
           WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 360 AND NOT (latitude = 0 AND longitude = 0))
      SELECT record_id, country FROM o, boxes WHERE lat >= lat_lo AND lat < lat_hi AND lon >= lon_lo AND lon < lon_hi AND NOT (lat >= lat_lo + 1.5 AND lat < lat_hi - 1.5 AND lon >= lon_lo + 2 AND lon < lon_hi - 2)""",
    "p1_distances": _NEAR + "SELECT site_id, record_id, round(min(km), 6) AS distance_km FROM m WHERE km <= 2 GROUP BY ALL",
    "p2_found": " UNION ALL ".join(
        [
            _fillable("species_dataset", "record_id", "species", "redlist", 1, 7),
            _fillable("agri_grid", "row_id", "variable_name || '|' || lower(trim(country))", "agri_2000", 0, 100),
            _fillable("ndvi_grid", "row_id", "latitude || '|' || longitude", "ndvi", -0.2, 1),
        ]
    ),
    "p3_found": _DATE3 + "SELECT specieskey, cell AS eeacellcode, lpad((m // 12)::VARCHAR, 4, '0') || '-' || lpad((m % 12 + 1)::VARCHAR, 2, '0') AS period FROM x",
    "p4_found": _DRIFT % ", ".join(f"('{k}', '{name}', '{f}')" for k, v in drift.SPELLINGS.items() for name, forms in v.items() for f in forms),
}
