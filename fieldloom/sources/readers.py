"""Readers of the raw file kinds. Each gives a DataFrame with an explicit schema; malformed lines are left out where the kind says so."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T, Window as W

from fieldloom.sources import classic


def csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, encoding: str = "UTF-8", sep: str = ",", skip_malformed: bool = False) -> DataFrame:
    """CSV with a header. Without ``schema`` every column is text, so nothing is read twice to guess types."""
    r = spark.read.option("header", "true").option("encoding", encoding).option("sep", sep).option("mode", "DROPMALFORMED" if skip_malformed else "PERMISSIVE").option("quote", '"' if sep == "," else "\u0000")
    return (r.schema(schema) if schema else r).csv(path)


def csv_with_preamble(spark: SparkSession, path: str, header_starts: str = "Country Name", ids: int = 4) -> DataFrame:
    """Files of a few lines before the header (which starts with ``header_starts``): the id columns, year and value.

    One row a line and year column; blank values are null. Files whose header is never found give nothing.
    """
    schema = "name string, code string, indicator string, indicator_code string, year int, value double"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv as c

        for f in frames:
            for content in f["content"]:
                lines = c.reader(io.StringIO(bytes(content).decode("utf-8-sig", "replace")))
                years, out = None, []
                for line in lines:
                    if years is None:
                        if line and line[0].strip() == header_starts:
                            years = [(i, int(x)) for i, x in enumerate(line) if i >= ids and re.fullmatch(r"\d{4}", x.strip())]
                        continue
                    if not line or not line[0].strip():
                        continue
                    head = (line + [""] * ids)[:ids]
                    for i, y in years:
                        v = line[i].strip() if i < len(line) else ""
                        try:
                            out.append((*head[:4], y, float(v) if v else None))
                        except ValueError:
                            out.append((*head[:4], y, None))
                yield pd.DataFrame(out, columns=["name", "code", "indicator", "indicator_code", "year", "value"]).astype({"year": "int32"})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def positional_tsv(spark: SparkSession, path: str, fields: dict[str, int], least: int = 160) -> DataFrame:
    """Fields of a headerless TSV by place (from 0); lines with fewer than ``least`` fields are left out, absent fields are null."""
    x = spark.read.text(path).select(F.split("value", "\t").alias("f")).filter(F.size("f") >= least)
    return x.select(*[F.nullif(F.get("f", F.lit(i)), F.lit("")).alias(n) for n, i in fields.items()])


def zipped_tsv(spark: SparkSession, path: str, columns: list[str], sep: str = "\t") -> DataFrame:
    """Rows of the first member of each ZIP (UTF-8, with a header, names without regard to letter case): path and ``columns`` as text.

    Absent columns are null. Files are read by the executors, one ZIP at a time and in blocks of rows.
    """
    schema = T.StructType([T.StructField("path", T.StringType()), *[T.StructField(c, T.StringType()) for c in columns]])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path_, content in zip(f["path"], f["content"]):
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as z, z.open(z.namelist()[0]) as member:
                    for block in pd.read_csv(member, sep=sep, dtype=str, keep_default_na=False, na_values=[""], on_bad_lines="skip", chunksize=50_000):
                        names = {n.strip().lower(): n for n in block.columns}
                        out = pd.DataFrame({c: block[names[c.lower()]] if c.lower() in names else None for c in columns}, index=block.index)
                        out.insert(0, "path", path_)
                        yield out

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return files.mapInPandas(run, schema)


def latest_by_key(df: DataFrame, key: str, path: str = "path") -> DataFrame:
    """Rows of the last file (by path) that has a key."""
    last = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(path).alias(path))
    return df.join(last, [key, path], "left_semi")


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Image annotation JSON (arrays images, annotations, categories): one row an image that has an annotation, with the category of its first."""
    j = spark.read.option("multiLine", "true").schema(
        "images array<struct<file_name string, id long, latitude double, longitude double, date string, width int, height int>>, annotations array<struct<image_id long, category_id long>>, "
        "categories array<struct<id long, kingdom string, phylum string, `class` string, `order` string, family string, genus string, specific_epithet string, common_name string>>"
    ).json(path)
    images = j.select(F.inline("images"))
    first = j.select(F.posexplode("annotations").alias("pos", "a")).groupBy(F.col("a.image_id").alias("id")).agg(F.min_by("a.category_id", "pos").alias("category_id"))
    cats = j.select(F.inline("categories")).withColumnRenamed("id", "category_id")
    ranks = ["kingdom", "phylum", "class", "order", "family", "genus", "specific_epithet", "common_name"]
    x = images.join(first, "id").join(cats, "category_id", "left")
    return x.fillna("Unknown", subset=ranks).withColumn("dimensions", F.concat_ws("x", "width", "height"))


def regions(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """GeoJSON features: ``name`` and ``rings`` (array of arrays of x, y), all outer rings and holes of a polygon or multipolygon."""
    j = spark.read.option("multiLine", "true").schema("features array<struct<properties map<string, string>, geometry struct<type string, coordinates string>>>").json(path)
    x = j.select(F.inline("features")).select(F.try_element_at("properties", F.lit(name)).alias(name), F.col("geometry.type").alias("type"), F.col("geometry.coordinates").alias("c"))
    one = F.from_json("c", "array<array<array<double>>>")
    many = F.from_json("c", "array<array<array<array<double>>>>")
    points = lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return x.select(name, F.transform(F.when(F.col("type") == "Polygon", one).otherwise(F.flatten(many)), points).alias("rings"))


def polygons(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """GeoJSON features: ``name`` and ``ring`` (array of x, y), one row an outer ring of a polygon or multipolygon; holes are in ``regions``."""
    j = spark.read.option("multiLine", "true").schema("features array<struct<properties map<string, string>, geometry struct<type string, coordinates string>>>").json(path)
    x = j.select(F.inline("features")).select(F.try_element_at("properties", F.lit(name)).alias(name), F.col("geometry.type").alias("type"), F.col("geometry.coordinates").alias("c"))
    one = F.from_json("c", "array<array<array<double>>>")
    many = F.from_json("c", "array<array<array<array<double>>>>")
    rings = F.when(F.col("type") == "Polygon", F.array(F.get(one, F.lit(0)))).otherwise(F.transform(many, lambda p: F.get(p, F.lit(0))))
    return x.select(name, F.explode(rings).alias("r")).select(name, F.transform("r", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))).alias("ring"))


def csv_any_encoding(spark: SparkSession, path: str, schema: str, second: str = "ISO-8859-1") -> DataFrame:
    """CSV files with a header, each in UTF-8 or, where its bytes are none, in ``second``. Only the names of the latter come to the driver."""
    lines = spark.read.text(path).select("value", "_metadata.file_path")
    other = [r["file_path"] for r in lines.filter(~F.is_valid_utf8("value")).select("file_path").distinct().collect()]
    x = csv(spark, path, schema)
    if not other:
        return x
    first = x.select("*", F.col("_metadata.file_path").alias("__file")).filter(~F.col("__file").isin(other)).drop("__file")
    r = spark.read.option("header", "true").option("encoding", second).schema(schema).csv(other)
    return first.unionByName(r)


def descriptions(pages: DataFrame, key: str = "species", order: str = "seq", payload: str = "payload") -> DataFrame:
    """Species descriptions from JSON records (text, redlist): the last record (by ``order``) with a text and with a red list code wins;
    line breaks become blanks. Records that are no JSON give nothing."""
    x = pages.select(key, order, F.from_json(payload, "text string, redlist string").alias("r")).filter("r IS NOT NULL")
    flat = lambda c: F.nullif(F.trim(F.replace(F.replace(c, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(" "))), F.lit(""))
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), F.col(order)))
    return x.groupBy(key).agg(last(flat(F.col("r.text"))).alias("text"), last(F.nullif(F.col("r.redlist"), F.lit(""))).alias("redlist"))


def names_from_paths(spark: SparkSession, path: str) -> DataFrame:
    """Distinct last parts of the paths in a text file."""
    return spark.read.text(path).select(F.element_at(F.split(F.trim("value"), "/"), -1).alias("name")).filter("name <> ''").distinct()


def observations(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows of observation JSON (one object a row): id, time, ranks from the ancestors, coordinates, and one row a photo."""
    schema = "id long, time_observed_at string, place_guess string, taxon struct<name string, preferred_common_name string>, identifications array<struct<taxon struct<ancestors array<struct<rank string, name string>>>>>, photos array<struct<url string>>, geojson struct<coordinates array<double>>"
    x = pages.select(F.from_json(payload, schema).alias("o")).filter("o.id IS NOT NULL")
    ancestors = F.coalesce(F.get("o.identifications", F.lit(0))["taxon"]["ancestors"], F.array().cast("array<struct<rank string, name string>>"))
    rank = lambda r: F.coalesce(F.get(F.filter(ancestors, lambda a: a["rank"] == r), F.lit(0))["name"], F.lit("Unknown")).alias(r)
    y = x.select(F.col("o.id").alias("observation_id"), F.coalesce("o.taxon.name", F.lit("Unknown")).alias("scientific_name"), F.col("o.time_observed_at").alias("timestamp"), *[rank(r) for r in ("kingdom", "phylum", "class", "order", "family", "genus")], F.get("o.geojson.coordinates", F.lit(1)).alias("latitude"), F.get("o.geojson.coordinates", F.lit(0)).alias("longitude"), F.posexplode_outer("o.photos").alias("photo", "p"))
    return y.withColumn("photo_url", F.replace("p.url", F.lit("square"), F.lit("medium"))).drop("p").filter(F.col("photo_url").isNull() | F.col("photo_url").startswith("https://"))


def good_recordings(df: DataFrame, quality: str = "q", also: str = "also") -> DataFrame:
    """Recordings better than C that name no second species."""
    return df.filter(F.col(quality).isin("A", "B") & (F.coalesce(F.size(F.filter(also, lambda s: s != "")), F.lit(0)) == 0))


def dna_records(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """DNA barcode JSON (one record a row): ranks, coordinates and the first sequence, Unknown where absent."""
    schema = "record_id string, bin_uri string, taxonomy map<string, struct<taxon struct<name string>>>, collection_event struct<country string, coordinates struct<lat double, lon double>>, sequences struct<sequence array<struct<sequenceID string, nucleotides string>>>"
    x = pages.select(F.from_json(payload, schema).alias("r")).filter("r.record_id IS NOT NULL")
    rank = lambda n: F.coalesce(F.try_element_at("r.taxonomy", F.lit(n))["taxon"]["name"], F.lit("Unknown")).alias(n)
    first = F.get("r.sequences.sequence", F.lit(0))
    return x.select("r.record_id", F.coalesce("r.bin_uri", F.lit("Unknown")).alias("bin_uri"), *[rank(n) for n in ("phylum", "class", "order", "family", "genus", "species")], F.coalesce("r.collection_event.country", F.lit("Unknown")).alias("country"), F.col("r.collection_event.coordinates.lat").alias("latitude"), F.col("r.collection_event.coordinates.lon").alias("longitude"), first["sequenceID"].alias("sequence_id"), first["nucleotides"].alias("nucleotides"))


def _opened(content: bytes) -> dict[str, classic.Variable]:
    """Variables of a NetCDF file: classic formats are read here, others need the netCDF4 library."""
    if classic.is_classic(content):
        return classic.read(content)[0]
    try:
        import netCDF4
    except ImportError as e:
        raise RuntimeError("reading NetCDF files that are not of a classic format needs the netCDF4 library on the executors") from e
    import numpy as np

    with netCDF4.Dataset("file", memory=content) as d:
        d.set_auto_maskandscale(False)
        return {k: classic.Variable(list(v.dimensions), np.asarray(v[:]), {n: v.getncattr(n) for n in v.ncattrs()}) for k, v in d.variables.items()}


def netcdf(spark: SparkSession, path: str, variables: list[str], months: list[str] | None = None, latitudes: list[float] | None = None, longitudes: list[float] | None = None) -> DataFrame:
    """Long cube (time, variable, level, latitude, longitude, value) of the NetCDF files under ``path``, missing values null.

    The time axis is the longer of ``valid_time`` and ``time``; longitudes of 180 and more become negative. ``months``
    (yyyy-MM) picks time steps, ``latitudes`` and ``longitudes`` the cells exactly at these coordinates; both within the worker, so
    that only what is asked for leaves it. A file is read by one task and given out a time step at a time; absent
    variables are left out.
    """
    schema = "time timestamp, variable string, level int, latitude double, longitude double, value double"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        on = lambda x, wanted: np.ones(len(x), dtype=bool) if wanted is None else np.isin(np.round(x, 6), np.round(np.array(wanted, dtype=float), 6))
        for f in frames:
            for content in f["content"]:
                d = _opened(bytes(content))
                axis = max((n for n in ("valid_time", "time") if n in d), key=lambda n: d[n].data.size)
                when = classic.decoded_times(d[axis])
                lat, lon = d["latitude"].values(), d["longitude"].values()
                lon = np.where(lon >= 180, lon - 360, lon)
                levels = [int(x) for x in d["pressure_level"].values()] if "pressure_level" in d else [None]
                i, j = np.flatnonzero(on(lat, latitudes)), np.flatnonzero(on(lon, longitudes))
                a, b = (g.ravel() for g in np.meshgrid(lat[i], lon[j], indexing="ij"))
                for v in (v for v in variables if v in d):
                    x = d[v].values()
                    deep = "pressure_level" in d[v].dims
                    for t, at in enumerate(when):
                        if months is not None and at.strftime("%Y-%m") not in months:
                            continue
                        for k, level in enumerate(levels if deep else [None]):
                            block = (x[t, k] if deep else x[t])[np.ix_(i, j)]
                            yield pd.DataFrame({"time": pd.Timestamp(at), "variable": v, "level": pd.array([level] * len(a), dtype="Int32"), "latitude": a, "longitude": b, "value": block.ravel()})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.nc").load(path).select("content")
    return files.mapInPandas(run, schema).withColumn("value", F.nanvl("value", F.lit(None).cast("double")))


def ndvi_points(spark: SparkSession, path: str, variable: str = "NDVI") -> DataFrame:
    """latitude, longitude, month_year (MM/yyyy) and ndvi of the first time step of each NetCDF file; missing values are left out."""
    x = netcdf(spark, path, [variable]).withColumn("f", F.min("time").over(W.partitionBy(F.date_trunc("MONTH", "time"), "latitude", "longitude")))
    return x.filter((F.col("time") == F.col("f")) & F.col("value").isNotNull()).select("latitude", "longitude", F.date_format("time", "MM/yyyy").alias("month_year"), F.col("value").alias("ndvi"))
