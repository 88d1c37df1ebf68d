"""Catalogs of files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The file name patterns by which a modality's files are found.
PATTERNS = {"era5": "*.nc", "species": "*.parquet", "agriculture": "*griculture*.csv", "forest": "*orest*.csv", "land": "*and*.csv", "ndvi": "*ndvi*.csv", "redlist": "*red_list*.csv"}
MEDIA = {"image": r"(?i)\.(jpg|jpeg|png)$", "audio": r"(?i)\.(wav|mp3)$", "edna": r"_edna\.csv$", "description": r"_description\.csv$", "distribution": r"_distribution\.csv$"}


def discover(spark: SparkSession, root: str, patterns: dict[str, str] | None = None) -> DataFrame:
    """modality, path, length, modified of the files under ``root`` by name pattern; contents aren't read."""
    out = None
    for modality, pattern in (patterns or PATTERNS).items():
        x = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
        x = x.select(F.lit(modality).alias("modality"), "path", "length", F.col("modificationTime").alias("modified"))
        out = x if out is None else out.unionByName(x)
    return out


def describe(df: DataFrame, name: str, time: str | None = None, lat: str | None = None, lon: str | None = None, species: str | None = None) -> DataFrame:
    """One row: columns, bounds of time and place, and number of distinct species; one aggregate over all rows."""
    null = F.lit(None)
    bound = lambda c, kind: [(F.min(c) if c else F.min(null.cast(kind))), (F.max(c) if c else F.max(null.cast(kind)))]
    a, b, c, d, e, f = *bound(time, "timestamp_ntz"), *bound(lat, "double"), *bound(lon, "double")
    return df.agg(a.alias("time_min"), b.alias("time_max"), c.alias("lat_min"), d.alias("lat_max"), e.alias("lon_min"), f.alias("lon_max"), F.count(F.lit(1)).alias("row_count"), (F.count_distinct(species) if species else F.count(null)).alias("n_species")).select(
        F.lit(name).alias("name"), F.array(*[F.lit(x) for x in df.columns]).alias("variables"), F.lit(time).cast("string").alias("time_column"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "*"
    )


def group_by_day(files: DataFrame, path: str, kinds: tuple[str, ...] = ("pressure", "single", "surface")) -> DataFrame:
    """day and the path of each kind, for the days that have all kinds; of several files of a kind the last by name."""
    pattern = r"(\d{4}-\d{2}-\d{2})[-_](" + "|".join(kinds) + r")\.[A-Za-z0-9]+$"
    x = files.select(path, F.regexp_extract(path, pattern, 1).alias("day"), F.regexp_extract(path, pattern, 2).alias("kind")).filter("day <> ''")
    y = x.groupBy("day").agg(*[F.max(F.when(F.col("kind") == k, F.col(path))).alias(k) for k in kinds])
    return y.dropna(subset=list(kinds))


def folder_modalities(files: DataFrame, path: str) -> DataFrame:
    """folder and its sorted modalities by file name."""
    kind = F.coalesce(*[F.when(F.col(path).rlike(p), F.lit(m)) for m, p in MEDIA.items()])
    x = files.select(F.regexp_replace(path, r"/[^/]*$", "").alias("folder"), kind.alias("m")).filter("m IS NOT NULL")
    return x.groupBy("folder").agg(F.sort_array(F.collect_set("m")).alias("modalities"))


def describe_cube(df: DataFrame, name: str, times: list[str], level: str, value: str) -> DataFrame:
    """One row: name, the time column with the most distinct values (of equals the first), their number, the sorted levels, the type
    of the value and how many rows have one. Levels are bounded by the cube's axis."""
    n = [F.count_distinct(t).alias(f"__{i}") for i, t in enumerate(times)]
    x = df.agg(*n, F.sort_array(F.collect_set(level)).alias("levels"), F.count(value).alias("n_values"))
    best = F.array_max(F.array(*[F.struct(F.col(f"__{i}").alias("n"), F.lit(-i).alias("o"), F.lit(t).alias("t")) for i, t in enumerate(times)]))
    return x.select(F.lit(name).alias("name"), best["t"].alias("time_column"), best["n"].alias("n_times"), "levels", F.lit(dict(df.dtypes)[value]).alias("value_type"), "n_values")


def probe(spark: SparkSession, root: str) -> DataFrame:
    """path, kind and valid of the Parquet and NetCDF files under ``root``, by the marks at their beginning and end; cut-off files are invalid, empty ones aren't listed."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).filter(F.col("path").rlike(r"\.(parquet|nc)$"))
    head, tail = F.hex(F.substring("content", 1, 8)), F.hex(F.substring("content", -4, 4))
    parquet = (head.startswith("50415231")) & (tail == "50415231") & (F.col("length") > 8)
    netcdf = head.rlike("^43444601|^43444602|^43444605") | (head == "894844460D0A1A0A")
    kind = F.regexp_extract("path", r"\.([a-z]+)$", 1)
    return x.select("path", kind.alias("kind"), F.when(kind == "parquet", parquet).otherwise(netcdf).alias("valid"))
