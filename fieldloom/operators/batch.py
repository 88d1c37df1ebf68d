"""Training windows: consecutive steps, normalising, slots, tensors, and the fusion of species records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldloom.operators.joins import consecutive_pairs, media_pairs
from fieldloom.operators.reshape import top_per_group

# The variables by which a file's slot is known, in order of precedence.
SLOT_VARIABLES = {
    "surface_variables": ["msl", "t2m", "u10", "v10"],
    "single_variables": ["stl", "z", "lsm"],
    "atmospheric_variables": ["t", "q", "u", "v", "z"],
    "edaphic_variables": ["stl1", "swvl2", "stl2"],
    "climate_variables": ["d2m", "tp", "avg_sdswrf", "avg_sdswrfcs", "avg_snlwrf", "avg_snswrf", "avg_tprate", "csfr", "sd", "smlt"],
}


def infer_slot(variables: Column) -> Column:
    """Slot with the largest overlap of an array of variable names; ties by order, no overlap or null: misc_variables."""
    scores = F.array(*[F.struct(F.size(F.array_intersect(variables, F.array(*[F.lit(v) for v in names]))).alias("n"), F.lit(-i).alias("o"), F.lit(slot).alias("slot")) for i, (slot, names) in enumerate(SLOT_VARIABLES.items())])
    best = F.array_max(scores)
    return F.when(best["n"] > 0, best["slot"]).otherwise(F.lit("misc_variables"))


def zscore(df: DataFrame, stats: DataFrame, by: list[str], value: str, inverse: bool = False) -> DataFrame:
    """``value`` as (x - mean) / std, or back; a std of 0 gives null. ``stats`` (by, mean, std) has one row a variable and
    level, so it is small by nature; it is left to the optimizer to broadcast by its size."""
    x = df.join(stats.select(*by, F.col("mean").alias("__m"), F.col("std").alias("__s")), by)
    new = F.col(value) * F.col("__s") + F.col("__m") if inverse else (F.col(value) - F.col("__m")) / F.nullif(F.col("__s"), F.lit(0.0))
    return x.withColumn(value, new).drop("__m", "__s")


def windows(cube: DataFrame, time: str) -> DataFrame:
    """Every pair of consecutive times as a window: ``window_start``, ``t`` (0 or 1) and the rows of ``cube`` at that time.

    All windows come from one equi-join on time; a row is repeated twice, once a window it is in. Columns of ``cube`` of these two
    names get ``_cube`` behind them.
    """
    clash = {c: f"{c}_cube" for c in cube.columns if c in ("window_start", "t")}
    cube, time = cube.withColumnsRenamed(clash), clash.get(time, time)
    pairs = consecutive_pairs(cube, time)
    parts = pairs.select(F.col("t0").alias("window_start"), F.explode(F.array(F.struct(F.lit(0).alias("t"), F.col("t0").alias("__at")), F.struct(F.lit(1).alias("t"), F.col("t1").alias("__at")))).alias("p"))
    return cube.join(parts.select("window_start", "p.t", "p.__at"), F.col(time) == F.col("__at")).drop("__at")


def tensors(df: DataFrame, by: list[str], cell: list[str], value: str, fill: float = 0.0) -> DataFrame:
    """One array a group, in the order of ``cell``; nulls as ``fill``. Its length is that of the grid, whatever the data."""
    return df.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct(*cell, F.coalesce(F.col(value), F.lit(fill)).alias("__v")))), lambda s: s["__v"]).alias("tensor"))


def fuse_species(images: DataFrame, sounds: DataFrame, edna: DataFrame, distribution: DataFrame, most: int = 3) -> DataFrame:
    """species, kind, first_id, second_id, lat, lon, dist of each species' records.

    With images and sounds the first ``most`` pairs (midpoint); with one kind its first ``most`` records; with neither all
    eDNA records. Distribution rows are always added. Inputs: species, id, lat, lon (and dist in ``distribution``); ids
    order the records. Null species drop out.
    """
    keyed = lambda df: df.filter(F.col("species").isNotNull())
    images, sounds, edna = keyed(images), keyed(sounds), keyed(edna)
    i = images.select("species", F.col("id").alias("first_id"), F.col("lat").alias("la"), F.col("lon").alias("lo"))
    s = sounds.select("species", F.col("id").alias("second_id"), F.col("lat").alias("la2"), F.col("lon").alias("lo2"))
    pairs = media_pairs(i, s, "species", "first_id", "second_id", most).select("species", F.lit("pair").alias("kind"), "first_id", "second_id", ((F.col("la") + F.col("la2")) / 2).alias("lat"), ((F.col("lo") + F.col("lo2")) / 2).alias("lon"))
    has_i, has_s = images.select("species").distinct(), sounds.select("species").distinct()

    def single(df: DataFrame, kind: str) -> DataFrame:
        return df.select("species", F.lit(kind).alias("kind"), F.col("id").alias("first_id"), F.lit(None).cast(df.schema["id"].dataType).alias("second_id"), "lat", "lon")

    only_i = single(top_per_group(images.join(has_s, "species", "left_anti"), ["species"], [F.col("id")], most), "image")
    only_s = single(top_per_group(sounds.join(has_i, "species", "left_anti"), ["species"], [F.col("id")], most), "audio")
    rest = single(edna.join(has_i.union(has_s), "species", "left_anti"), "edna")
    observed = pairs.unionByName(only_i).unionByName(only_s).unionByName(rest).withColumn("dist", F.lit(1.0))
    spread = keyed(distribution).select("species", F.lit("distribution").alias("kind"), F.col("id").alias("first_id"), F.lit(None).cast(distribution.schema["id"].dataType).alias("second_id"), "lat", "lon", "dist")
    return observed.unionByName(spread)


def stacked_windows(df: DataFrame, time: str, slot: str, variable: str, level: str, cell: list[str], value: str, fill: float | None = 0.0) -> DataFrame:
    """Tensors of each window and slot: window_start, ``slot``, ``variables`` and ``levels`` (sorted names and levels), and ``tensor``,
    the values in the order of step (two), variable, level and cell, row-major.

    Rows are reduced to one a step, variable, level and cell first (the largest value). A cell that has no value, or NaN, at a
    step gets ``fill`` (with None it stays null); a variable that has no value at a level is filled too, so every tensor of a slot
    has the same shape. Its length is that of the grid, whatever the data. Null keys drop out.
    """
    name, cells = slot, [f"__c{i}" for i in range(len(cell))]
    names = dict(zip([time, slot, variable, level, *cell], ["__time", "__slot", "__var", "__lev", *cells]))
    x = df.select(*[F.col(c).alias(n) for c, n in names.items()], F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")).alias("__v"))
    x = x.dropna(subset=[*names.values()]).groupBy(*names.values()).agg(F.max("__v").alias("__v"))
    time, slot, variable, level, cell = "__time", "__slot", "__var", "__lev", cells
    w = windows(x, time)
    axes = x.groupBy(slot).agg(F.sort_array(F.collect_set(variable)).alias("variables"), F.sort_array(F.collect_set(level)).alias("levels"), F.sort_array(F.collect_set(F.struct(*cell))).alias("__cells"))
    at = w.join(axes, slot)
    place = ((F.col("t") * F.size("variables") + F.array_position("variables", F.col(variable)) - 1) * F.size("levels") + F.array_position("levels", F.col(level)) - 1) * F.size("__cells") + F.array_position("__cells", F.struct(*[F.col(c) for c in cell])) - 1
    at = at.select("window_start", slot, place.cast("int").alias("__p"), "__v")
    have = at.groupBy("window_start", slot).agg(F.map_from_entries(F.collect_list(F.struct("__p", "__v"))).alias("__m")).join(axes, slot)
    n = 2 * F.size("variables") * F.size("levels") * F.size("__cells")
    tensor = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.try_element_at("__m", i), F.lit(fill).cast("double")))
    return have.select("window_start", F.col(slot).alias(name), "variables", "levels", tensor.alias("tensor"))


def cast_tensor(tensor: Column, kind: str = "float") -> Column:
    """Every value of a tensor as another type; values that don't fit are null."""
    return F.transform(tensor, lambda v: v.try_cast(kind))
