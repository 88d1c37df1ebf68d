"""Command line: scan, windows, stats, inspect and cube, each a DataFrame query from Parquet to Parquet or JSON."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession, functions as F

from fieldloom.operators import aggregates, batch
from fieldloom.operators.joins import consecutive_pairs
from fieldloom.sources import catalog, sinks


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="fieldloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    add = lambda name, *opts: [sub.add_parser(name)] and [sub.choices[name].add_argument(*o if isinstance(o, tuple) else (o,), required=True) for o in opts]
    add("scan", "--root", "--out")
    add("windows", "--cube", "--out")
    add("stats", "--cube", "--out")
    add("inspect", "--cube")
    add("species-cube", "--input", "--out")
    add("get-max-index", "--cube")
    add("run-single", "--cube", "--out", "--index")
    for name in ("windows", "run-single"):
        sub.choices[name].add_argument("--fill-nan", type=float)
    sub.choices["get-max-index"].add_argument("--chunk", type=int, default=1)
    sub.choices["run-single"].add_argument("--chunk", type=int, default=1)
    sub.choices["windows"].add_argument("--start")
    sub.choices["windows"].add_argument("--end")
    sub.choices["windows"].add_argument("--max-windows", type=int)
    sub.choices["stats"].add_argument("--by", default="level")
    sub.choices["inspect"].add_argument("--by", default="level")
    a = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if a.command == "scan":
        sinks.write_parquet(catalog.discover(spark, a.root), a.out)
    elif a.command == "windows":
        x = spark.read.parquet(a.cube)
        if a.start:
            x = x.filter(F.col("time") >= F.lit(a.start).cast("timestamp"))
        if a.end:
            x = x.filter(F.col("time") <= F.lit(a.end).cast("timestamp"))
        w = batch.windows(x, "time")
        if a.max_windows:
            w = w.join(F.broadcast(w.select("window_start").distinct().orderBy("window_start").limit(a.max_windows)), "window_start", "left_semi")
        sinks.write_new_windows(w if a.fill_nan is None else w.fillna(a.fill_nan), a.out)
    elif a.command in ("get-max-index", "run-single"):
        # Windows are numbered from 0 by their start; a job of an array takes those of one chunk.
        starts = aggregates.ranked(consecutive_pairs(spark.read.parquet(a.cube), "time").select("t0"), ["t0"])
        if a.command == "get-max-index":
            print((starts.count() - 1) // a.chunk)
        else:
            mine = starts.filter(F.floor(F.col("rank") / a.chunk) == int(a.index)).select(F.col("t0").alias("window_start"))
            w = batch.windows(spark.read.parquet(a.cube), "time").join(mine, "window_start", "left_semi")
            sinks.write_new_windows(w if a.fill_nan is None else w.fillna(a.fill_nan), a.out)
    elif a.command == "stats":
        sinks.write_json(aggregates.moments(spark.read.parquet(a.cube), "value", a.by.split(",")), a.out)
    elif a.command == "inspect":
        aggregates.inspect(spark.read.parquet(a.cube), "value", a.by.split(",")).orderBy(*a.by.split(",")).show(1000, False)
    else:
        from fieldloom.functions.geo import laea_inverse, snap, with_eea, eea_metres
        from fieldloom.operators.regular import cube_readings

        r = with_eea(cube_readings(spark.read.parquet(a.input)), F.col("eeacellcode"), "p")
        e, n = eea_metres(F.col("p"))
        lat, lon = laea_inverse(e.cast("double"), n.cast("double"))
        x = r.select("specieskey", snap(lat).alias("latitude"), snap(lon).alias("longitude"), F.floor(F.col("__month") / 12).alias("year"), (F.col("__month") % 12 + 1).alias("month"), "__count")
        sinks.write_parquet(x.groupBy("specieskey", "latitude", "longitude", "year", "month").agg(F.sum("__count").alias("distribution")), a.out, ["year"])


if __name__ == "__main__":
    main()
