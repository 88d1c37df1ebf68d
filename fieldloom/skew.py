"""Joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A key counts as hot from this share of all rows on. By the pigeonhole principle at most 1/HOT_SHARE
#: keys can be hot, so the list of hot keys has a fixed size bound whatever the size of the data.
HOT_SHARE = 1 / 500


def hot_keys(weights: DataFrame, keys: list[str], weight: str, share: float = HOT_SHARE, least: int = 1) -> DataFrame:
    """Keys with more than ``share`` of the summed ``weight`` (at most 1/share of them), with ``__nsalt``.

    ``weights`` has one row a key. Weights that sum to zero or an empty table give no hot key.
    ``least``: keys of no more weight than this are never hot.
    """
    total = weights.agg(F.coalesce(F.sum(weight), F.lit(0)).cast("double").alias("s")).first()["s"]
    limit = max(total * share, float(least))
    return weights.filter(F.col(weight) > limit).select(*keys, F.ceil(F.col(weight) / limit).cast("int").alias("__nsalt"))


def salted_join(large: DataFrame, dim: DataFrame, keys: list[str], weight: str, salt_by: Column, how: str = "left", share: float = HOT_SHARE, least: int = 20_000) -> DataFrame:
    """``large`` joined to ``dim`` (one row a key) where a key may hold any share of ``large``.

    ``dim[weight]`` says how many rows of ``large`` the key has, roughly. Rows of hot keys are spread over
    several salts by ``salt_by`` and the one ``dim`` row of such a key is repeated once a salt. The hot-key
    list that is broadcast has at most ``1/share`` rows. Null keys match nothing, as in any equi-join;
    ``weight`` is not in the result.
    """
    hot = hot_keys(dim, keys, weight, share, least)
    marked = large.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.when(F.col("__nsalt").isNotNull(), F.pmod(F.xxhash64(salt_by), F.col("__nsalt").cast("long")).cast("int")).otherwise(F.lit(0))).drop("__nsalt")
    spread = dim.drop(weight).join(F.broadcast(hot), keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__nsalt"), F.lit(1)) - 1))).drop("__nsalt")
    return marked.join(spread, [*keys, "__salt"], how).drop("__salt")
