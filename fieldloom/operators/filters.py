"""Filters and checks of tables: periods, windows of a grid, allow-lists, nulls, and assertions that fail the query."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: The variables of a slot that are taken; a slot that isn't listed, or an empty list, takes all.
TAKEN_VARIABLES = {"edaphic_variables": ["stl1", "stl2", "swvl1", "swvl2"], "agriculture_variables": ["Agriculture", "Arable", "Cropland"]}


def years_between(df: DataFrame, year: Column, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows whose year lies in first…last, both included and either open; null years are left out."""
    x = df.filter(year.isNotNull())
    x = x if first is None else x.filter(year >= first)
    return x if last is None else x.filter(year <= last)


def day_first_bounds(df: DataFrame, time: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows from ``start`` to ``end`` (texts, the day first unless the year is; an end without a clock time is its midnight), either
    open. An unknown bound text, and with bounds a null time, leaves no row."""
    at = lambda s: F.coalesce(*[F.try_to_timestamp(F.lit(s), F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy")])
    t = F.col(time).cast("timestamp")
    x = df if start is None else df.filter(t >= at(start))
    return x if end is None else x.filter(t <= at(end))


def half_clipped(df: DataFrame, column: str, low: float, high: float, step: float) -> DataFrame:
    """Rows within low + step / 2 … high, both included: the cells whose centre is inside; null and NaN are outside."""
    return df.filter(F.col(column).between(low + step / 2, high))


def day_of_month_folder(df: DataFrame, path: str, day: int) -> DataFrame:
    """Rows whose path's folder name ends with the day of the month, two digits."""
    return df.filter(F.element_at(F.split(path, "/"), -2).endswith(f"{day:02d}"))


def without_nulls(df: DataFrame, columns: list[str], how: str = "any") -> DataFrame:
    """Rows without null or NaN in any (or, with ``how`` all, not in all) of the columns."""
    kinds = dict(df.dtypes)
    there = [F.col(c).isNotNull() & ~F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNotNull() for c in columns]
    return df.filter(reduce((lambda a, b: a & b) if how == "any" else (lambda a, b: a | b), there))


def of_modality(report: DataFrame, modality: str) -> DataFrame:
    """Rows of a catalog of one modality; where the catalog is partitioned by it, only that folder is read."""
    return report.filter(F.col("modality") == modality)


def taken_variables(df: DataFrame, slot: str, variable: str, taken: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows of variables that their slot takes; an absent or empty list takes all."""
    lists = {s: v for s, v in (TAKEN_VARIABLES if taken is None else taken).items() if v}
    bad = [(F.col(slot) == s) & ~F.col(variable).isin(v) for s, v in lists.items()]
    return df.filter(~F.coalesce(reduce(lambda a, b: a | b, bad), F.lit(False))) if bad else df


def assertions(df: DataFrame, checks: dict[str, Column], fail: bool = True) -> DataFrame:
    """check, rows, failed: how many rows don't satisfy each condition (null counts as failed); one pass for all checks.
    With ``fail`` reading the result raises an error that names the first check with failures."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    x = row.select("rows", F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("failed")) for n in checks])).alias("c")).select("c.check", "rows", "c.failed")
    return x.withColumn("failed", F.when(F.col("failed") > 0, F.raise_error(F.concat(F.lit("check failed: "), F.col("check"))).cast("long")).otherwise(F.col("failed"))) if fail else x


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one of the two tables has, with ``side`` (left or right); empty if the key sets are equal."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    both = x.withColumn("__l", F.lit(1)).join(y.withColumn("__r", F.lit(1)), keys, "full")
    return both.filter("__l IS NULL OR __r IS NULL").select(*keys, F.when(F.col("__r").isNull(), "left").otherwise("right").alias("side"))


def combined_metrics(parts: dict[str, DataFrame], keys: list[str], value: str) -> DataFrame:
    """One row a key with a column for each part's ``value``; reading it fails if a key is absent from a part. Keys occur once a part."""
    out = None
    for name, df in parts.items():
        x = df.select(*keys, F.col(value).alias(name), F.lit(True).alias(f"__{name}"))
        out = x if out is None else out.join(x, keys, "full")
    there = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"__{n}"), F.lit(False)) for n in parts])
    first = next(iter(parts))
    return out.withColumn(first, F.when(there, F.col(first)).otherwise(F.raise_error(F.lit("key sets differ")).cast(parts[first].schema[value].dataType))).select(*keys, *parts)


def box_union(df: DataFrame, by: list[str], lat_lo: str, lat_hi: str, lon_lo: str, lon_hi: str) -> DataFrame:
    """The box around all boxes of a group; null edges don't count."""
    return df.groupBy(*by).agg(F.min(lat_lo).alias(lat_lo), F.max(lat_hi).alias(lat_hi), F.min(lon_lo).alias(lon_lo), F.max(lon_hi).alias(lon_hi))


def midpoint(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> tuple[Column, Column]:
    """The middle of two coordinates; null where either is no latitude (-90…90) or longitude (-180…180)."""
    lat = lambda c: F.when(c.between(-90, 90), c)
    lon = lambda c: F.when(c.between(-180, 180), c)
    return (lat(lat1) + lat(lat2)) / 2, (lon(lon1) + lon(lon2)) / 2
