"""Schemas that drift between files (problem 4).

Payloads are loaded as maps from path to raw value with its raw type. Statistics by file, path and type are
aggregated, which leaves a few rows a file; fields, types and changes follow from them. Typed tables are
projected with the casts that failed reported beside.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from fieldloom.durable import durable
from fieldloom.operators.timestamps import once

#: The spellings of each standard field by feed kind, without regard to letter case and separators.
SPELLINGS = {
    "cell_cube": {
        "specieskey": ["specieskey", "taxonkey", "taxonid"],
        "yearmonthday": ["yearmonthday", "ymd", "obsdate"],
        "year": ["year"],
        "month": ["month"],
        "day": ["day"],
        "eeacellcode": ["eeacellcode", "cellcode", "grid10km"],
        "occurrences": ["occurrences", "occcount", "n"],
        "phylum": ["phylum", "phylumname"],
        "family": ["family", "familyname"],
        "genus": ["genus", "genusname"],
    },
    "era5_single": {
        "valid_time": ["validtime", "time", "fctime"],
        "latitude": ["latitude", "lat"],
        "longitude": ["longitude", "lon", "lng"],
        "t2m": ["t2m", "temperature2m"],
        "msl": ["msl", "meansealevelpressure"],
        "u10": ["u10", "windu10m"],
        "v10": ["v10", "windv10m"],
    },
}
TYPES = {
    "cell_cube": {"specieskey": "bigint", "yearmonthday": "string", "year": "int", "month": "int", "day": "int", "eeacellcode": "string", "occurrences": "double", "phylum": "string", "family": "string", "genus": "string"},
    "era5_single": {"valid_time": "string", "latitude": "double", "longitude": "double", "t2m": "double", "msl": "double", "u10": "double", "v10": "double"},
}


#: Orders in which the least hash of a field's values is kept, to tell whether two fields have values in common.
HASHES = 4


def standard_name(kind: Column, key: Column, spellings: dict = SPELLINGS) -> Column:
    """The standard name of a key; any other key stays as it is. A trailing separator (``day_``) makes another key."""
    plain = F.lower(F.regexp_replace(key, r"(?<=[A-Za-z0-9])[_\- ](?=[A-Za-z0-9])", ""))
    out = key
    for k, names in spellings.items():
        table = F.create_map(*[F.lit(x) for name, forms in names.items() for f in forms for x in (f, name)])
        out = F.when((kind == k) & F.map_contains_key(table, plain), F.try_element_at(table, plain)).otherwise(out)
    return out


def raw_type(schema: Column) -> Column:
    """Raw type of a JSON value by its variant schema: integer, decimal, text, boolean, object, array; null for a JSON null."""
    return (
        F.when(schema.isin("TINYINT", "SMALLINT", "INT", "BIGINT"), "integer").when(schema.startswith("DECIMAL") | schema.isin("DOUBLE", "FLOAT"), "decimal").when(schema == "STRING", "text")
        .when(schema == "BOOLEAN", "boolean").when(schema == "VOID", F.lit(None).cast("string")).when(schema.startswith("ARRAY"), "array").otherwise("object")
    )


def path_values(records: DataFrame, nested: bool = False) -> DataFrame:
    """One row for each key of each payload: raw_id, feed_id, feed_kind, file_seq, pos, key, type, value (as text); an empty
    object has one row without key.

    ``nested``: also for every path below, however deep, as ``key``: ``a.b`` for b in the object a, ``a[]`` for the elements of
    the array a. A payload that is no complete JSON object (null, empty, cut off, a bare value) gives none; a record
    delivered more than once counts once.
    """
    x = once(records.select("raw_id", "feed_id", "feed_kind", "file_seq", "payload"), "raw_id")
    x = x.withColumn("__v", F.try_parse_json("payload")).filter(F.trim("payload").rlike(r"(?s)\A\{.*\}\z"))
    x = x.select("raw_id", "feed_id", "feed_kind", "file_seq", F.schema_of_variant("__v").alias("__s"), "__v").filter(F.col("__s").startswith("OBJECT"))
    pairs = records.sparkSession.tvf.variant_explode_outer(F.col("__v").outer())
    y = x.lateralJoin(pairs)
    kind = raw_type(F.schema_of_variant("value"))
    y = y.select("raw_id", "feed_id", "feed_kind", "file_seq", "pos", "key", kind.alias("type"), F.try_variant_get("value", "$", "string").alias("value"))
    if not nested:
        return y
    levels = [durable(y)]
    while True:  # a level of nesting at a time, as deep as the payloads are
        below = levels[-1].filter(F.col("type").isin("object", "array")).select("raw_id", "feed_id", "feed_kind", "file_seq", F.col("key").alias("__up"), F.try_parse_json("value").alias("__v"))
        below = below.lateralJoin(records.sparkSession.tvf.variant_explode(F.col("__v").outer()))
        path = F.concat(F.col("__up"), F.coalesce(F.concat(F.lit("."), F.col("key")), F.lit("[]")))
        below = durable(below.select("raw_id", "feed_id", "feed_kind", "file_seq", (F.col("pos") + 1).alias("pos"), path.alias("key"), raw_type(F.schema_of_variant("value")).alias("type"), F.try_variant_get("value", "$", "string").alias("value")))
        if below.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        levels.append(below)


def file_fields(records: DataFrame, spellings: dict = SPELLINGS, nested: bool = False) -> DataFrame:
    """Fields of each file: feed_id, file_seq, field_name, key, type, and how its values of that type look: ``like`` (mean length,
    share of digits, mean and standard deviation of numbers, and the least hashes of the values in several orders).

    A field belongs to a file if more than half of its payloads have the key; its type is the commonest among its
    values other than null (of equally common ones the first by name), null if all are null. Counting is combined
    before the shuffle, so a feed may hold any share of the rows.
    """
    paths = path_values(records, nested)
    if nested:  # a payload has a path once, however many elements of an array have it
        paths = paths.groupBy("raw_id", "feed_id", "feed_kind", "file_seq", "key").agg(F.min("type").alias("type"), F.min("value").alias("value"), F.min("pos").alias("pos"))
    number = F.col("value").try_cast("double")
    length = F.length("value")
    sums = [F.sum(length).alias("len"), F.sum(length - F.length(F.translate("value", "0123456789", ""))).alias("dig"), F.sum(number).alias("s"), F.sum(number * number).alias("ss"), *[F.min(F.xxhash64(F.lit(i), "value")).alias(f"h{i}") for i in range(HASHES)]]
    # Each payload counts where its first key (or, if it is empty, its only row) stands.
    counts = paths.groupBy("feed_id", "feed_kind", "file_seq", "key", "type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("first"), *sums)
    of_file = W.partitionBy("feed_id", "feed_kind", "file_seq")
    counts = counts.withColumn("payloads", F.sum("first").over(of_file))
    by_key = counts.groupBy("feed_id", "feed_kind", "file_seq", "key").agg(F.sum("n").alias("n"), F.max("payloads").alias("payloads"), F.expr("min(struct(-n AS m, type, len, dig, s, ss, " + ", ".join(f"h{i}" for i in range(HASHES)) + ")) FILTER (WHERE type IS NOT NULL)").alias("best"))
    kept = by_key.filter(F.col("key").isNotNull() & (F.col("n") * 2 > F.col("payloads")))
    m, mean = -F.col("best.m"), F.col("best.s") / -F.col("best.m")
    like = F.struct((F.col("best.len") / m).alias("len"), (F.col("best.dig") / F.greatest(F.col("best.len"), F.lit(1))).alias("dig"), mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.col("best.ss") / m - mean * mean)).alias("std"), F.array(*[F.col(f"best.h{i}") for i in range(HASHES)]).alias("least"))
    named = kept.select("feed_id", "file_seq", standard_name(F.col("feed_kind"), F.col("key"), spellings).alias("field_name"), "key", F.col("best.type").alias("type"), "n", like.alias("like"))
    return named.groupBy("feed_id", "file_seq", "field_name").agg(F.max_by(F.struct("key", "type", "like"), F.struct("n", "key")).alias("f")).select("feed_id", "file_seq", "field_name", "f.key", "f.type", "f.like")


def _alike(a: Column, b: Column, kind: Column) -> Column:
    """Whether the values of two fields look the same: numbers by mean and spread, texts with digits by length and share of
    digits, words by the values themselves (any of their least hashes in common)."""
    numbers = (F.abs(a["mean"] - b["mean"]) <= F.greatest(a["std"], b["std"]) / 2 + 1e-9) & (F.least(a["std"], b["std"]) * 2 >= F.greatest(a["std"], b["std"]))
    texts = (F.abs(a["len"] - b["len"]) <= F.greatest(a["len"], b["len"]) * 0.1 + 0.5) & (F.abs(a["dig"] - b["dig"]) <= 0.05)
    words = F.greatest(a["dig"], b["dig"]) < 0.05
    common = F.exists(F.zip_with(a["least"], b["least"], lambda x, y: x == y), lambda x: x)
    return F.when(kind.isin("integer", "decimal"), numbers).otherwise(texts & (~words | common))


def with_inferred_renames(both: DataFrame, standard: list[str]) -> DataFrame:
    """``both`` with a standard field that goes and an unknown key that comes in the same file as one field, where type and
    statistics agree and neither has another partner. ``both``: feed_id, file_seq, field_name, k, t, like, k0, t0, like0."""
    gone = both.filter(F.col("k").isNull() & F.col("field_name").isin(standard)).select("feed_id", "file_seq", F.col("field_name").alias("name"), "k0", "t0", "like0")
    come = both.filter(F.col("k0").isNull() & (F.col("field_name") == F.col("k")) & ~F.col("field_name").isin(standard)).select("feed_id", "file_seq", "k", "t", "like")
    met = gone.join(come, (gone["feed_id"] == come["feed_id"]) & (gone["file_seq"] == come["file_seq"]) & (gone["t0"] == come["t"]) & _alike(F.col("like0"), F.col("like"), F.col("t")))
    met = met.select(gone["feed_id"], gone["file_seq"], "name", "k0", "t0", "like0", "k", "t", "like")
    one = lambda c: F.count(F.lit(1)).over(W.partitionBy("feed_id", "file_seq", c))
    pairs = durable(met.withColumns({"__a": one("name"), "__b": one("k")}).filter("__a = 1 AND __b = 1").drop("__a", "__b"))
    away = pairs.select("feed_id", "file_seq", F.explode(F.array("name", "k")).alias("field_name"))
    return both.join(away, ["feed_id", "file_seq", "field_name"], "left_anti").unionByName(pairs.withColumnRenamed("name", "field_name"))


def schema_changes(records: DataFrame, spellings: dict = SPELLINGS, nested: bool = False, infer: bool = True) -> DataFrame:
    """Changes of each file against the next lower file_seq of its feed: feed_id, file_seq, field_name, change_kind.

    Kinds: added, removed, renamed, retyped (the last two may both hold). The first file of a feed has none. Keys of one
    field are known by ``spellings``; with ``infer`` also by their statistics, where one standard field goes and one unknown
    key with alike values comes. ``nested`` reports all paths, not the keys of the payload alone.
    """
    fields = durable(file_fields(records, spellings, nested))  # read twice, so that no payload is parsed twice
    files = records.select("feed_id", "file_seq").distinct().withColumn("before", F.lag("file_seq").over(W.partitionBy("feed_id").orderBy("file_seq")))
    now = fields.join(files.filter(F.col("before").isNotNull()), ["feed_id", "file_seq"]).select("feed_id", "file_seq", "field_name", F.col("key").alias("k"), F.col("type").alias("t"), "like")
    earlier = fields.withColumnRenamed("file_seq", "before").join(files.filter(F.col("before").isNotNull()), ["feed_id", "before"]).select("feed_id", "file_seq", "field_name", F.col("key").alias("k0"), F.col("type").alias("t0"), F.col("like").alias("like0"))
    both = now.join(earlier, ["feed_id", "file_seq", "field_name"], "full")
    if infer:
        both = with_inferred_renames(durable(both), [n for names in spellings.values() for n in names])
    kinds = F.when(F.col("k0").isNull(), F.array(F.lit("added"))).when(F.col("k").isNull(), F.array(F.lit("removed"))).otherwise(F.array_compact(F.array(F.when(F.col("k") != F.col("k0"), "renamed"), F.when(F.col("t") != F.col("t0"), "retyped"))))
    return both.select("feed_id", "file_seq", "field_name", F.explode(kinds).alias("change_kind"))


def common_types(records: DataFrame, spellings: dict = SPELLINGS) -> dict[str, str]:
    """Fields that most files of the records have, with their commonest type; as many rows as there are names of fields come to the driver."""
    f = file_fields(records, spellings)
    files = records.select("feed_id", "file_seq").distinct().count()
    n = f.groupBy("field_name", "type").agg(F.count(F.lit(1)).alias("n")).groupBy("field_name").agg(F.sum("n").alias("all"), F.max_by("type", F.struct("n", "type")).alias("type"))
    names = {"integer": "bigint", "decimal": "double", "boolean": "boolean"}
    return {r["field_name"]: names.get(r["type"], "string") for r in n.filter(F.col("all") * 2 > files).orderBy("field_name").collect()}


def consistent_table(records: DataFrame, kind: str, spellings: dict = SPELLINGS, types: dict = TYPES) -> DataFrame:
    """One typed row for each complete payload of a feed kind: raw_id, feed_id, file_seq, the standard fields, ``others``
    (a map of the remaining keys to their raw text), ``failed_casts`` (names of fields whose value doesn't fit the type) and
    ``conflicts`` (names of fields that two keys of the payload give different values; the larger text is taken). A kind
    that ``types`` doesn't have gets the fields of most of its files.
    """
    columns = types.get(kind) or common_types(records.filter(F.col("feed_kind") == kind), spellings)
    paths = path_values(records.filter(F.col("feed_kind") == kind))
    paths = paths.withColumn("field", standard_name(F.col("feed_kind"), F.col("key"), spellings))
    pick = [F.max(F.when((F.col("field") == c) & ((F.col("type") != "boolean") | F.lit(columns[c] == "boolean")), F.col("value"))).alias(f"__{c}") for c in columns]
    least = [F.min(F.when((F.col("field") == c) & ((F.col("type") != "boolean") | F.lit(columns[c] == "boolean")), F.col("value"))).alias(f"__l_{c}") for c in columns]
    stray = [F.max((F.col("field") == c) & (F.col("type") == "boolean") & F.lit(columns[c] != "boolean")).alias(f"__b_{c}") for c in columns]
    others = F.map_from_entries(F.collect_set(F.when(~F.col("field").isin(*columns) & F.col("key").isNotNull(), F.struct("key", "value")))).alias("others")
    one = paths.groupBy("raw_id", "feed_id", "file_seq").agg(*pick, *least, *stray, others)
    typed = {c: F.col(f"__{c}").try_cast(t) for c, t in columns.items()}
    failed = F.array_compact(F.array(*[F.when(F.coalesce(F.col(f"__b_{c}"), F.lit(False)) | (F.col(f"__{c}").isNotNull() & typed[c].isNull()), F.lit(c)) for c in columns]))
    conflicts = F.array_compact(F.array(*[F.when(F.col(f"__{c}") != F.col(f"__l_{c}"), F.lit(c)) for c in columns]))
    return one.select("raw_id", "feed_id", "file_seq", *[v.alias(c) for c, v in typed.items()], "others", failed.alias("failed_casts"), conflicts.alias("conflicts"))
