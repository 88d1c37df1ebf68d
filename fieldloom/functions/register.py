"""The engine's functions in SQL: scalar functions that the optimizer inlines, table functions, and a hook for a user's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import SparkSession, functions as F, types as T

#: Name, parameters, result and body of each scalar function; null in, null out.
SCALARS = {
    "snap_to": ("x DOUBLE, step DOUBLE", "DOUBLE", "rint(x / step) * step"),
    "canonical_longitude": ("x DOUBLE", "DOUBLE", "CASE WHEN x >= 180 THEN x - 360 ELSE x END"),
    "distance_km": (
        "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE", "DOUBLE",
        "2 * 6371.0D * asin(sqrt(least(1.0D, pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))",
    ),
    "slot_of_six_hours": ("t TIMESTAMP", "TIMESTAMP", "timestampadd(HOUR, least(18, CAST(ceil((hour(t) * 60 + minute(t) - 180) / 360) * 6 AS INT)), date_trunc('DAY', t))"),
}


class _KmerRows:
    """Rows of the overlapping words of ``k`` bases with their places; a null or shorter sequence gives none."""

    def eval(self, seq: str, k: int) -> Iterator[tuple[int, str]]:
        for i in range(len(seq or "") - (k or 0) + 1 if k else 0):
            yield i, seq[i : i + k]


def register(spark: SparkSession) -> None:
    """Make SCALARS and the table function ``kmer_rows(seq, k)`` known to the session's SQL; again is no harm."""
    for name, (parameters, result, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    spark.udtf.register("kmer_rows", F.udtf(_KmerRows, returnType="pos int, kmer string"))


def register_user(spark: SparkSession, name: str, f: Callable[[pd.Series], pd.Series], returns: T.DataType | str) -> None:
    """A user's function of one column for SQL. It gets whole Arrow batches as series and gives series of the same length."""

    def run(x: pd.Series) -> pd.Series:
        return f(x)

    run.__annotations__ = {"x": pd.Series, "return": pd.Series}
    spark.udf.register(name, F.pandas_udf(run, returns))
