"""Wide to long and back, unions and labels in headers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, Window as W

_HEADER = re.compile(r"(?:(?P<var>.+?)_)?(?:(?P<month>\d{1,2})/)?(?P<year>\d{4})")


def parse_header(name: str) -> tuple[str | None, int | None, int] | None:
    """(variable, month, year) of a column name ``Var_YYYY``, ``Var_MM/YYYY``, ``YYYY`` or ``M/YYYY``, else None."""
    m = _HEADER.fullmatch(name)
    if not m or (m["month"] and not 1 <= int(m["month"]) <= 12):
        return None
    return m["var"], int(m["month"]) if m["month"] else None, int(m["year"])


def period_columns(df: DataFrame) -> dict[str, tuple[str | None, int | None, int]]:
    """The columns of ``df`` whose names are periods."""
    return {c: h for c in df.columns if (h := parse_header(c))}


def unpivot_periods(df: DataFrame, keys: list[str], value: str = "value", keep_null: bool = False) -> DataFrame:
    """keys, variable, year, month, ``value``: one row a period column; null and NaN values are left out unless ``keep_null``."""
    columns = period_columns(df)
    parts = [F.struct(F.lit(v).cast("string").alias("variable"), F.lit(y).alias("year"), F.lit(m).cast("int").alias("month"), F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(value)) for c, (v, m, y) in columns.items()]
    x = df.select(*keys, F.inline(F.array(*parts)))
    return x if keep_null else x.filter(F.col(value).isNotNull())


def pivot_first(df: DataFrame, keys: list[str], column: str, values: list, value: str, order: list[str], prefix: str) -> DataFrame:
    """One row a key, one column ``prefix + v`` for each of ``values``: the first value in ``order``."""
    one = lambda v: F.min_by(F.when(F.col(column) == v, F.col(value)), F.when(F.col(column) == v, F.struct(*order)))
    return df.groupBy(*keys).agg(*[one(v).alias(f"{prefix}{v}") for v in values])


def pivot_counts(df: DataFrame, key: str, column: str, values: list) -> DataFrame:
    """Rows of ``key`` by value of ``column``, 0 where there are none."""
    return df.groupBy(key).agg(*[F.count_if(F.col(column) == v).alias(str(v)) for v in values])


def union_tagged(parts: dict[str, DataFrame], tag: str = "variable_name") -> DataFrame:
    """All parts one below the other with their name as ``tag``; absent columns are null."""
    out = None
    for name, df in parts.items():
        x = df.withColumn(tag, F.lit(name))
        out = x if out is None else out.unionByName(x, allowMissingColumns=True)
    return out


def rolling_mean(df: DataFrame, by: list[str], order: str, value: str, out: str, half: int = 1) -> DataFrame:
    """Centred mean over ``half`` rows on either side within ``by``, of what is there; ties of ``order`` must be broken by the caller."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(-half, half)
    return df.withColumn(out, F.avg(value).over(w))


def chunked(df: DataFrame, rank: str, size: int, look_ahead: bool = False) -> DataFrame:
    """``df`` with ``chunk`` = rank div size; with ``look_ahead`` the first row of a chunk is also the last of the one before."""
    own = F.floor(F.col(rank) / size)
    if not look_ahead:
        return df.withColumn("chunk", own)
    both = F.when((F.col(rank) % size == 0) & (F.col(rank) > 0), F.array(own, own - 1)).otherwise(F.array(own))
    return df.withColumn("chunk", F.explode(both))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows a group in ``order`` (a top-k)."""
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("__r") <= n).drop("__r")


def header_parts(name: Column) -> Column:
    """struct of variable, month and year of a column name in the forms of ``parse_header``, null where it names no period or its month is none."""
    pattern = r"^(?:(.+?)_)?(?:(\d{1,2})/)?(\d{4})$"
    part = lambda i: F.nullif(F.regexp_extract(name, pattern, i), F.lit(""))
    month = part(2).try_cast("int")
    fits = part(3).isNotNull() & (month.isNull() | month.between(1, 12))
    return F.when(fits, F.struct(part(1).alias("variable"), month.alias("month"), part(3).try_cast("int").alias("year")))
