"""Aggregates: moments, diversity, rollups and summaries. All combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from fieldloom.durable import durable
from fieldloom.skew import hot_keys


def number(c: Column) -> Column:
    """Null instead of NaN."""
    return F.nanvl(c, F.lit(None).cast("double"))


def finite(c: Column) -> Column:
    """Null instead of NaN and infinities."""
    x = number(c)
    return F.when(F.abs(x) < float("inf"), x)


def moments(df: DataFrame, value: str, by: list[str], skip_infinite: bool = False) -> DataFrame:
    """count_valid, count_nan, nan_pct, mean, std (population), min, max. NaN and null count as missing; without valid
    values mean and std are 0, min and max null, nan_pct 1. ``skip_infinite`` leaves infinities out as well."""
    v = F.col(value).cast("double")
    x = finite(v) if skip_infinite else number(v)
    n, total = F.count(x), F.count(F.lit(1))
    return df.groupBy(*by).agg(
        n.alias("count_valid"), (total - n).alias("count_nan"), F.coalesce((total - n) / total, F.lit(1.0)).alias("nan_pct"),
        F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"), F.coalesce(F.stddev_pop(x), F.lit(0.0)).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
    )


def inspect(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """nan_pct, inf_pct, min, max, mean and sample standard deviation of the finite values."""
    v = F.col(value).cast("double")
    missing, infinite = v.isNull() | F.isnan(v), F.abs(number(v)) == float("inf")
    return df.groupBy(*by).agg(
        F.avg(missing.cast("double")).alias("nan_pct"), F.avg(F.coalesce(infinite, F.lit(False)).cast("double")).alias("inf_pct"), F.min(finite(v)).alias("min"), F.max(finite(v)).alias("max"),
        F.avg(finite(v)).alias("mean"), F.stddev_samp(finite(v)).alias("std"),
    )


def diversity(df: DataFrame, species: str, by: list[str]) -> DataFrame:
    """richness, shannon (natural logarithm) and simpson (1 - sum of squares) a group; null species don't count.

    Species are counted first; what follows works on one row a species and group. The sums of n and n·ln n give the
    index without a second pass.
    """
    n = df.filter(F.col(species).isNotNull()).groupBy(*by, species).agg(F.count(F.lit(1)).cast("double").alias("n"))
    s = n.groupBy(*by).agg(F.count(F.lit(1)).alias("richness"), F.sum("n").alias("t"), F.sum(F.col("n") * F.log("n")).alias("nl"), F.sum(F.col("n") * F.col("n")).alias("nn"))
    return s.select(*by, "richness", (F.log("t") - F.col("nl") / F.col("t")).alias("shannon"), (1 - F.col("nn") / (F.col("t") * F.col("t"))).alias("simpson"))


def endemism(df: DataFrame, species: str, region: str) -> DataFrame:
    """Regions with the number of species found in no other; nulls don't count."""
    x = df.filter(F.col(species).isNotNull() & F.col(region).isNotNull())
    only = x.groupBy(species).agg(F.min(region).alias(region), F.max(region).alias("__m")).filter(F.col(region) == F.col("__m"))
    return only.groupBy(region).agg(F.count(F.lit(1)).alias("endemic"))


def beta_jaccard(df: DataFrame, species: str, region: str, every: bool = False) -> DataFrame:
    """Jaccard dissimilarity of presence of regions (a, b), both ways and with itself, for all that share a species; with
    ``every`` also of those that share none (1).

    Shared species are counted by an equi-join of the distinct (species, region) rows with themselves; a species in very
    many regions is salted on one side. The result has at most regions² rows, and each task combines its pairs before the
    shuffle. Nulls don't count.
    """
    x = df.filter(F.col(species).isNotNull() & F.col(region).isNotNull()).select(F.col(species).alias("s"), F.col(region).alias("r")).distinct()
    x = durable(x)
    size = x.groupBy("r").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(x.groupBy("s").agg(F.count(F.lit(1)).alias("n")), ["s"], "n", least=1000)
    salts = F.coalesce(F.col("__nsalt"), F.lit(1))
    left = x.join(F.broadcast(hot), "s", "left").select("s", F.col("r").alias("a"), F.pmod(F.xxhash64("r"), salts).cast("int").alias("k"))
    right = x.join(F.broadcast(hot), "s", "left").select("s", F.col("r").alias("b"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("k"))
    both = left.join(right, ["s", "k"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("both"))
    if every:  # one row a pair is the result asked for; the list of regions is as long as one side of it
        regions = size.agg(F.collect_list("r")).scalar()
        both = size.select(F.col("r").alias("a"), F.explode(regions).alias("b")).join(both, ["a", "b"], "left").fillna({"both": 0})
    both = both.join(size.select(F.col("r").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("r").alias("b"), F.col("n").alias("nb")), "b")
    return both.select("a", "b", (1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("jaccard"))


def top_species(df: DataFrame, species: str, n: int) -> DataFrame:
    """The ``n`` most frequent species, ties by the smaller id; nulls don't count. The limit is the feature."""
    return df.filter(F.col(species).isNotNull()).groupBy(species).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), species).limit(n)


def resample(df: DataFrame, time: str, value: str, unit: str = "MONTH") -> DataFrame:
    """Sum a period between the first and last, empty periods as 0; the spine is bounded by the calendar."""
    per = df.filter(F.col(time).isNotNull()).groupBy(F.date_trunc(unit, time).alias("period")).agg(F.sum(value).alias("total"))
    span = per.agg(F.min("period").alias("a"), F.max("period").alias("b")).filter("a IS NOT NULL")
    spine = span.select(F.explode(F.sequence("a", "b", F.expr(f"INTERVAL 1 {unit}"))).alias("period"))
    return spine.join(per, "period", "left").fillna({"total": 0.0})


def modality_combinations(df: DataFrame, item: str, modality: str) -> DataFrame:
    """How many items have exactly which set of modalities (sorted, joined by +)."""
    sets = df.filter(F.col(item).isNotNull() & F.col(modality).isNotNull()).groupBy(item).agg(F.concat_ws("+", F.sort_array(F.collect_set(modality))).alias("modalities"))
    return sets.groupBy("modalities").agg(F.count(F.lit(1)).alias("items"))


def occurrence_lists(df: DataFrame, species: str, time: str, lat: str, lon: str) -> DataFrame:
    """Observations a species and year with their coordinates, sorted: species, year, total, places.

    Places are distinct with their number, so the list is bounded by the grid when coordinates are snapped first.
    """
    per = df.groupBy(species, F.year(time).alias("year"), F.col(lat).alias("lat"), F.col(lon).alias("lon")).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(species, "year").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("lat", "lon", "n"))).alias("places"))


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Count a key and its share of all rows; the total is a scalar subquery over the counts."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return n.select(key, "n", (F.col("n") / n.agg(F.sum("n")).scalar()).alias("share"))


def species_summary(df: DataFrame, species: str, time: str, value: str) -> DataFrame:
    """total, mean, max, rows, first and last year, number of years and of distinct months a species."""
    t = F.col(time)
    return df.groupBy(species).agg(
        F.sum(value).alias("total"), F.avg(value).alias("mean"), F.max(value).alias("max"), F.count(F.lit(1)).alias("n"), F.min(F.year(t)).alias("first_year"), F.max(F.year(t)).alias("last_year"),
        F.size(F.collect_set(F.year(t))).alias("n_years"), F.size(F.collect_set(F.year(t) * 12 + F.month(t))).alias("n_months"),
    )


def dense_labels(df: DataFrame, column: str, order: str, known: DataFrame | None = None) -> DataFrame:
    """(value, id) of each distinct non-null value, ids dense from 0 by first appearance (least ``order``, then value).

    ``known`` (value, id) keeps its ids; new values follow after the largest. Values are reduced to one row each first;
    ranks come from range partitions and their sizes, so no task sees all values.
    """
    first = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.min(order).alias("__o"))
    start = 0
    if known is not None:
        first = first.join(known.select("value"), "value", "left_anti")
        start = (known.agg(F.max("id").alias("m")).first()["m"] if known.columns else None)
        start = 0 if start is None else start + 1
    new = ranked(first, ["__o", "value"]).select("value", (F.col("rank") + start).alias("id"))
    return new if known is None else known.select("value", "id").unionByName(new)


def with_next(values: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct non-null ``column`` with ``out``, the next larger one (null for the largest), without a single-task window: values
    are range-partitioned and sorted, each partition looks ahead on its own, and its last value gets the first of the
    next partition (one row each)."""
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = durable(values.select(F.col(column).alias("__v")).filter("__v IS NOT NULL").distinct())
    x = durable(distinct.repartitionByRange(parts, "__v").sortWithinPartitions("__v")).withColumn("__p", F.spark_partition_id())
    firsts = x.groupBy("__p").agg(F.min("__v").alias("__f"))
    ahead = firsts.withColumn("__f", F.lead("__f").over(W.orderBy("__p")))  # a row a task
    own = F.lead("__v").over(W.partitionBy("__p").orderBy("__v"))
    y = x.withColumn("__n", own).join(F.broadcast(ahead), "__p", "left")
    return y.select(F.col("__v").alias(column), F.coalesce("__n", "__f").alias(out))


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``rank``, its place from 0 in the global order, without a single-task window: rows are range-partitioned and
    sorted, each partition is numbered on its own, and the sizes of the partitions before (one row each) are added."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = durable(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)).withColumn("__p", F.spark_partition_id())
    sizes = x.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__b", F.coalesce(F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    own = F.row_number().over(W.partitionBy("__p").orderBy(*order)) - 1
    return x.withColumn("__own", own).join(F.broadcast(before), "__p").withColumn("rank", (F.col("__own") + F.col("__b")).cast("long")).drop("__p", "__own", "__b")


def top_species_after(df: DataFrame, species: str, first: list[int], n: int) -> DataFrame:
    """``species`` and ``place`` from 1: the listed ids in their order, whether observed or not, then the ``n`` most frequent species
    (ties by the smaller id). A listed species that is frequent too is there twice, as the two lists are independent."""
    listed = df.sparkSession.createDataFrame([(s, i) for i, s in enumerate(first, 1)], f"{species} long, place int")
    top = top_species(df, species, n)
    numbered = top.withColumn("place", (F.row_number().over(W.orderBy(F.desc("n"), species)) + len(first)).cast("int"))  # n rows
    return listed.unionByName(numbered.select(F.col(species).cast("long").alias(species), "place"))


def years_by_folder(df: DataFrame, folder: str, time: str) -> DataFrame:
    """The distinct years of each folder's records, sorted; texts that name no time don't count. The list is bounded by the calendar."""
    t = F.coalesce(*[F.try_to_timestamp(F.col(time).cast("string"), F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")])
    return df.withColumn("__y", F.year(t)).filter(F.col(folder).isNotNull() & F.col("__y").isNotNull()).groupBy(folder).agg(F.sort_array(F.collect_set("__y")).alias("years"))
