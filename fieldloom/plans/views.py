"""Adapter views: the driver's tables in the shape of observations, cubes, boxes, wide indicators and sequences, with the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldloom.sources.tables import table


def obs(spark: SparkSession, d: str) -> DataFrame:
    """event_id, species, ts, lat, lon, dist, cls."""
    return table(spark, d, "events").selectExpr(
        "event_id", "user_id AS species", "ts", "34.0D + (event_id * 37 % 3801) / 100.0D AS lat", "-30.0D + (event_id * 91 % 8001) / 100.0D AS lon", "value AS dist", "event_type AS cls"
    )


def cube(spark: SparkSession, d: str | None = None) -> DataFrame:
    """40 six-hourly steps, 3 levels, 16 by 16 cells; null where (t + lat + lon) % 29 = 0."""
    x = spark.range(40 * 3 * 256).selectExpr("CAST(floor(id / 768) AS BIGINT) AS t_idx", "element_at(array(50L, 500L, 1000L), CAST(floor(id / 256) AS INT) % 3 + 1) AS level", "CAST(floor(id / 16) AS BIGINT) % 16 AS lat_idx", "id % 16 AS lon_idx")
    return x.selectExpr(
        "t_idx", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, CAST(t_idx AS INT) * 6) AS time", "level", "lat_idx", "lon_idx",
        "CASE WHEN (t_idx + lat_idx + lon_idx) % 29 = 0 THEN NULL ELSE ((t_idx * 31 + level * 7 + lat_idx * 13 + lon_idx * 17) % 997) / 4.0D END AS value",
    )


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """country, k, lat_lo, lat_hi, lon_lo, lon_hi of each nation."""
    return table(spark, d, "nation").selectExpr(
        "n_name AS country", "n_nationkey AS k", "34.0D + (n_nationkey % 6) * 6.0D AS lat_lo", "39.0D + (n_nationkey % 6) * 6.0D AS lat_hi", "-25.0D + (n_nationkey % 7) * 10.0D AS lon_lo", "-17.5D + (n_nationkey % 7) * 10.0D AS lon_hi"
    )


YEARS = range(1995, 2001)


def indicator_wide(spark: SparkSession, d: str) -> DataFrame:
    """country, agri_1995 … agri_2000: sums of order prices."""
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    x = o.join(c, o["o_custkey"] == c["c_custkey"]).join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"])  # 25 nations
    return x.groupBy(F.col("n_name").alias("country")).agg(*[F.round(F.sum(F.when(F.year("o_orderdate") == y, F.col("o_totalprice"))), 2).alias(f"agri_{y}") for y in YEARS])


def seq(spark: SparkSession, d: str) -> DataFrame:
    """event_id, dna (with ambiguity codes)."""
    return table(spark, d, "events").selectExpr("event_id", "translate(substring(md5(cast(event_id AS string)), 1, 30), '0123456789abcdef', 'ACGTNACGTYACGTRW') AS dna")


def pure_seq(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr("event_id", "translate(substring(md5(cast(event_id AS string)), 1, 30), '0123456789abcdef', 'ACGTACGTACGTACGT') AS dna")


OBS = "obs AS (SELECT event_id, user_id AS species, ts, 34.0::DOUBLE + (event_id * 37 % 3801) / 100.0::DOUBLE AS lat, -30.0::DOUBLE + (event_id * 91 % 8001) / 100.0::DOUBLE AS lon, value AS dist, event_type AS cls FROM events)"
CUBE = """cube AS (SELECT t AS t_idx, TIMESTAMP '2024-01-01' + to_hours(t * 6) AS time, level, la AS lat_idx, lo AS lon_idx,
  CASE WHEN (t + la + lo) % 29 = 0 THEN NULL ELSE ((t * 31 + level * 7 + la * 13 + lo * 17) % 997) / 4.0::DOUBLE END AS value
  FROM range(40) a(t), (VALUES (50::BIGINT), (500), (1000)) l(level), range(16) b(la), range(16) c(lo))"""
BOXES = "boxes AS (SELECT n_name AS country, n_nationkey AS k, 34.0::DOUBLE + (n_nationkey % 6) * 6 AS lat_lo, 39.0::DOUBLE + (n_nationkey % 6) * 6 AS lat_hi, -25.0::DOUBLE + (n_nationkey % 7) * 10 AS lon_lo, -17.5::DOUBLE + (n_nationkey % 7) * 10 AS lon_hi FROM nation)"
WIDE = (
    "indicator_wide AS (SELECT n_name AS country, "
    + ", ".join(f"round(sum(CASE WHEN year(o_orderdate) = {y} THEN o_totalprice END), 2) AS agri_{y}" for y in YEARS)
    + " FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)"
)
SEQ = "seq AS (SELECT event_id, translate(substring(md5(event_id::VARCHAR), 1, 30), '0123456789abcdef', 'ACGTNACGTYACGTRW') AS dna FROM events)"
PURE = "pure AS (SELECT event_id, translate(substring(md5(event_id::VARCHAR), 1, 30), '0123456789abcdef', 'ACGTACGTACGTACGT') AS dna FROM events)"


class Register:
    """Collects the queries of a module and the SQL that checks them."""

    def __init__(self) -> None:
        self.queries, self.sql = {}, {}

    def __call__(self, sql: str | None = None):
        def add(f):
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add
