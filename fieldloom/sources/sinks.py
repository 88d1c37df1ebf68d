"""Writers. Appends are idempotent: what is there already isn't written again."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldloom.durable import durable
from fieldloom.operators.joins import fingerprint, new_rows
from fieldloom.sources import classic


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def append_new(df: DataFrame, path: str, key: str = "unique_id", columns: list[str] | None = None) -> None:
    """Append rows whose key isn't in the Parquet table yet, each once. Without a ``key`` column it is made from ``columns`` (all by default).

    Only new files are written; a rerun with the same rows writes none of them.
    """
    spark = df.sparkSession
    if key not in df.columns:
        df = df.withColumn(key, fingerprint(columns or df.columns))
    df = df.dropDuplicates([key])
    if _exists(spark, path):
        df = new_rows(df, spark.read.parquet(path), key)
    df.write.mode("append").parquet(path)


def write_wide(df: DataFrame, path: str, keys: list[str], column: str, columns: list, value: str, digits: int = 4) -> None:
    """CSV with one row a key and one column a value of ``column``; the largest value wins, 0 stays 0, absent is empty."""
    wide = df.groupBy(*keys).agg(*[F.round(F.max(F.when(F.col(column) == c, F.col(value))), digits).alias(str(c)) for c in columns])
    wide.write.mode("overwrite").option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None, codec: str = "zstd", mode: str = "overwrite", rows_a_file: int = 5_000_000) -> None:
    """Parquet, in one folder a value of ``by``. Rows are brought together by it first, so that a folder has few files; a value
    is spread over as many tasks as its number of rows asks for (``rows_a_file`` each), which are counted first."""
    if not by:
        df.write.mode(mode).option("compression", codec).parquet(path)
        return
    sizes = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows_a_file).cast("int").alias("__files")).filter("__files > 1").withColumnsRenamed({c: f"__k_{c}" for c in by})
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__k_{c}`")) for c in by])
    spread = df.join(sizes, same, "left").select(*[F.col(f"`{c}`") for c in df.columns], F.floor(F.rand(1) * F.coalesce("__files", F.lit(1))).alias("__f"))
    spread.repartition(*by, "__f").drop("__f").write.mode(mode).option("compression", codec).partitionBy(*by).parquet(path)


def write_new_windows(df: DataFrame, path: str, window: str = "window_start") -> None:
    """Append training windows that aren't there yet, one folder a window.

    A window counts as there only if it has as many rows as it should: one that a failed run left in part is written anew, as
    its folder is replaced as a whole (dynamic partition overwrite). Each run writes the windows it replaces completely.
    """
    spark = df.sparkSession
    if _exists(spark, path):
        there = spark.read.parquet(path).groupBy(F.col(window).cast(df.schema[window].dataType).alias(window)).agg(F.count(F.lit(1)).alias("__n"))
        wanted = df.groupBy(window).agg(F.count(F.lit(1)).alias("__n"))
        df = df.join(durable(wanted.join(there, [window, "__n"], "left_anti").select(window)), window, "left_semi")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_parquet(df, path, [window])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def write_netcdf(df: DataFrame, path: str, window: str, time: str, axes: list[str], values: list[str]) -> DataFrame:
    """One NetCDF file (classic format) a window, named after it; returns ``window``, file and cells written, and writes when it is read.

    A window's rows are one grid, whose size the data doesn't change; cells without a row are NaN. Axes are the sorted distinct
    values; times are hours since 1970. Of several rows a cell the last in the order of the values counts.
    """
    schema = f"{window} string, file string, cells long"

    def one(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        from pyarrow import fs as pafs

        hours = (f[time] - pd.Timestamp("1970-01-01")) / pd.Timedelta(hours=1)
        at = {"time": np.unique(hours), **{a: np.unique(f[a]) for a in axes}}
        place = tuple(np.searchsorted(at[k], c) for k, c in (("time", hours), *[(a, f[a]) for a in axes]))
        out = {k: classic.Variable([k], v.astype(float), {"units": "hours since 1970-01-01 00:00:00"} if k == "time" else {}) for k, v in at.items()}
        for v in values:
            grid = np.full([len(x) for x in at.values()], np.nan)
            grid[place] = f[v].to_numpy(dtype=float)
            out[v] = classic.Variable(list(at), grid)
        target, folder = pafs.FileSystem.from_uri(path)
        target.create_dir(folder, recursive=True)
        name = f"{folder}/{key[0]}.nc"
        with target.open_output_stream(name) as s:
            s.write(classic.write(out))
        return pd.DataFrame({window: [key[0]], "file": [name], "cells": [len(f)]})

    x = df.select(F.col(window).cast("string").alias(window), F.col(time).cast("timestamp_ntz").alias(time), *[F.col(a).cast("double").alias(a) for a in axes], *[F.col(v).cast("double").alias(v) for v in values])
    return x.groupBy(window).applyInPandas(one, schema)


def write_zipped(df: DataFrame, path: str, file: str, columns: list[str]) -> DataFrame:
    """One ZIP file with a tab-separated table for each value of ``file``; returns file and rows, and writes when it is read. The rows
    of a file go through one task, as a ZIP file has one writer, which holds the compressed file until it is whole."""
    schema = f"{file} string, rows long"
    kept = [file, *columns]

    def run(frames):
        import io
        import zipfile
        from pyarrow import fs as pafs

        target, folder = pafs.FileSystem.from_uri(path)
        target.create_dir(folder, recursive=True)
        now, out, member, n = None, None, None, 0

        def finish():
            member.close()
            z.close()
            with target.open_output_stream(f"{folder}/{now}.zip") as s:
                s.write(out.getvalue())
            return pd.DataFrame({file: [now], "rows": [n]})

        for f in frames:
            for name, part in f.groupby(file, sort=False):
                if name != now:
                    if now is not None:
                        yield finish()
                    now, n, out = name, 0, io.BytesIO()
                    z = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                    member = z.open("table.tsv", "w", force_zip64=True)
                    member.write(("\t".join(columns) + "\n").encode())
                member.write(part[columns].to_csv(sep="\t", index=False, header=False, lineterminator="\n").encode())
                n += len(part)
        if now is not None:
            yield finish()

    x = df.filter(F.col(file).isNotNull()).select(*[F.col(c).cast("string").alias(c) for c in kept])
    return x.repartition(file).sortWithinPartitions(file).mapInPandas(run, schema)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a row, nulls included."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def sorted_times(df: DataFrame, column: str) -> DataFrame:
    """Usable timestamps of a text column with list brackets and quotes around them, distinct and in order."""
    t = F.try_to_timestamp(F.regexp_replace(column, r"[\[\]'\"]", ""))
    return df.select(t.alias("timestamp")).filter("timestamp IS NOT NULL").distinct().orderBy("timestamp")


def process_once(items: DataFrame, log: str, key: str, work: Callable[[DataFrame], None]) -> int:
    """``work`` on the items that the log (a Parquet table of keys) doesn't have yet, which then are added to it; their number.

    Keys are logged only after the work is done, so a failed run is done again. Null keys are never logged and always worked on.
    """
    spark = items.sparkSession
    todo = durable(items.join(spark.read.parquet(log).select(key), key, "left_anti") if _exists(spark, log) else items)
    work(todo)
    append_new(todo.select(key).filter(F.col(key).isNotNull()), log, key)
    return todo.count()


def merge_columns(df: DataFrame, path: str, keys: list[str]) -> None:
    """A wide CSV table with the columns of ``df`` added or replaced: rows are matched by ``keys``, those of one side stay, a
    column that ``df`` has counts as a whole from ``df``; columns after the keys are in order of name. Keys occur once a side
    (of several rows the largest values). The new table is written beside and then takes the place of the old one."""
    spark = df.sparkSession
    new = [c for c in df.columns if c not in keys]
    one = lambda x, cs: x.groupBy(*[F.col(k).cast("string").alias(k) for k in keys]).agg(*[F.max(f"`{c}`").cast("string").alias(c) for c in cs])
    out = one(df, new)
    if _exists(spark, path):
        old = spark.read.option("header", "true").csv(path)
        out = one(old, [c for c in old.columns if c not in keys and c not in new]).join(out, keys, "full")
    out = out.select(*keys, *[F.col(f"`{c}`") for c in sorted(c for c in out.columns if c not in keys)])
    durable(out).write.mode("overwrite").option("header", "true").csv(path)


def write_media_name(path: str) -> str:
    """The media file of a metadata file: its name without the suffix _image.csv or _audio.csv."""
    for kind, end in (("_image.csv", ".jpg"), ("_audio.csv", ".wav")):
        if path.endswith(kind):
            return path[: -len(kind)] + end
    return path
