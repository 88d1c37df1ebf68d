"""Queries that go through a sink or a stream and back: what was written is read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldloom.durable import ensure_checkpoint_dir
from fieldloom.operators import aggregates as ag
from fieldloom.operators import batch as bt
from fieldloom.plans.views import CUBE, OBS, WIDE, YEARS, Register, cube, indicator_wide, obs
from fieldloom.sources import sinks
from fieldloom.sources.tables import table
from fieldloom.streaming import observations as stream

query = Register()
_SLOT = "date_trunc('day', ts) + to_hours(least(18, ceil((hour(ts) * 60 + minute(ts) - 180) / 360.0)::INT * 6))"


def folder(spark: SparkSession, name: str) -> str:
    """A fresh folder within the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT md5(concat_ws('_', user_id::VARCHAR, event_type)) AS unique_id, user_id, event_type FROM events GROUP BY user_id, event_type")
def sink_append(spark: SparkSession, d: str) -> DataFrame:
    """Three overlapping batches appended; every record once."""
    out = folder(spark, "append")
    e = table(spark, d, "events").select("user_id", "event_type")
    for part in (e.filter("user_id % 2 = 0"), e.filter("user_id % 3 = 0"), e):
        sinks.append_new(part, out, columns=["user_id", "event_type"])
    return spark.read.parquet(out).select("unique_id", "user_id", "event_type")


@query(f"WITH {WIDE} SELECT country, " + ", ".join(f'round(agri_{y}, 2) AS "{y}"' for y in YEARS) + " FROM indicator_wide")
def sink_wide(spark: SparkSession, d: str) -> DataFrame:
    from fieldloom.operators.reshape import unpivot_periods

    out = folder(spark, "wide")
    sinks.write_wide(unpivot_periods(indicator_wide(spark, d), ["country"]), out, ["country"], "year", list(YEARS), "value", 2)
    return spark.read.option("header", "true").schema("country string, " + ", ".join(f"`{y}` double" for y in YEARS)).csv(out)


@query(f"WITH {OBS} SELECT cls, species, count(*) AS n FROM obs GROUP BY ALL")
def sink_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """One folder a class, read back with the partition column."""
    out = folder(spark, "parts")
    sinks.write_parquet(obs(spark, d).select("cls", "species"), out, ["cls"])
    return spark.read.parquet(out).groupBy("cls", "species").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CUBE}, p AS (SELECT time AS t0, lead(time) OVER (ORDER BY time) AS t1 FROM (SELECT DISTINCT time FROM cube)) SELECT t0 AS window_start, count(*) AS n FROM p JOIN cube ON time IN (t0, t1) WHERE t1 IS NOT NULL GROUP BY t0")
def sink_windows(spark: SparkSession, d: str) -> DataFrame:
    """Training windows written twice; the second run adds nothing."""
    out = folder(spark, "windows")
    w = bt.windows(cube(spark), "time").withColumn("start", F.date_format("window_start", "yyyy-MM-dd-HH"))
    for _ in range(2):
        sinks.write_new_windows(w, out, "start")
    return spark.read.parquet(out).groupBy("window_start").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CUBE} SELECT level, count(value) AS count_valid, round(avg(value), 6) AS mean FROM cube GROUP BY level")
def sink_json_stats(spark: SparkSession, d: str) -> DataFrame:
    out = folder(spark, "stats")
    sinks.write_json(ag.moments(cube(spark), "value", ["level"]), out)
    return spark.read.schema("level long, count_valid long, mean double").json(out).withColumn("mean", F.round("mean", 6))


@query(f"WITH {OBS} SELECT event_id, {_SLOT} AS slot, round_even(lat / 0.25, 0) * 0.25::DOUBLE AS cell_lat, round_even(lon / 0.25, 0) * 0.25::DOUBLE AS cell_lon FROM obs")
def stream_append(spark: SparkSession, d: str) -> DataFrame:
    """The observations as a stream: slotted, snapped, without duplicates, appended exactly once over two runs."""
    out, progress = folder(spark, "stream"), folder(spark, "progress")
    source = table(spark, d, "events")
    for _ in range(2):
        s = spark.readStream.schema(source.schema).parquet(f"{d}/events.parquet*")
        s = s.selectExpr("event_id", "user_id", "ts", "34.0D + (event_id * 37 % 3801) / 100.0D AS lat", "-30.0D + (event_id * 91 % 8001) / 100.0D AS lon")
        stream.append(stream.prepared(s, "ts", "lat", "lon", ["event_id", "user_id"], "400 days"), out, progress).awaitTermination()
    return spark.read.parquet(out).select("event_id", F.col("slot").cast("timestamp_ntz").alias("slot"), "cell_lat", "cell_lon")
