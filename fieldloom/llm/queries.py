"""Queries of the problems of language-model training data (5, 7, 8 and 9) and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldloom.functions.barrier import computed
from fieldloom.functions.geo import canonical_lon, is_location, snap
from fieldloom.functions.timeparse import with_instant
from fieldloom.llm import abuse, asof, contain, tokens
from fieldloom.operators.timestamps import once
from fieldloom.sources.tables import table

TOLERANCE_SECONDS = 30 * 60
#: Rows of both sides that a task of the time join should hold at most.
ROWS_A_TASK = 1_000_000


def _sightings(df: DataFrame, key: str) -> DataFrame:
    """Usable records of image or audio metadata: key, name, lat and lon of the quarter-degree cell, seconds."""
    x = df.select(key, "scientific_name", "latitude", "longitude", "timestamp").filter(is_location(F.col("latitude"), F.col("longitude")))
    x = with_instant(x, F.col("timestamp"), "seconds")
    name = F.lower(F.trim(F.regexp_replace("scientific_name", r"[\s_ ]+", " ")))
    lon = snap(canonical_lon(F.col("longitude")))
    x = computed(x, {"name": F.nullif(name, F.lit("")), "cell_lat": (snap(F.col("latitude")) * 4).cast("int"), "cell_lon": (F.when(lon >= 180.0, lon - 360.0).otherwise(lon) * 4).cast("int")})
    return once(x.filter(F.col("seconds").isNotNull() & F.col("name").isNotNull()).select(key, "name", "cell_lat", "cell_lon", "seconds"), key)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Each image with the sound recording of its species and cell that is nearest in time."""
    images, sounds = table(spark, d, "image_metadata"), table(spark, d, "audio_metadata")
    rows = images.count() + sounds.count()  # from the files' footers
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK))
    return asof.nearest_in_time(_sightings(images, "image_id"), _sightings(sounds, "audio_id"), ["name", "cell_lat", "cell_lon"], "seconds", "image_id", "audio_id", TOLERANCE_SECONDS, tasks)


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode(table(spark, d, "documents"), "doc_id", "text")


def p7_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Token ids with the characters they cover."""
    return tokens.encode(table(spark, d, "documents"), "doc_id", "text", offsets=True)


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Every document decoded from its token ids."""
    return tokens.decode(p7_ids(spark, d), "doc_id")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the test items they leak."""
    return contain.leaked_items(table(spark, d, "documents"), table(spark, d, "benchmark_items")).select("item_id", "doc_id")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Test items that leak, with the number of documents and the longest passage."""
    x = contain.leaked_items(table(spark, d, "documents"), table(spark, d, "benchmark_items"))
    return x.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("passage_words").alias("longest_passage"))


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    """Calibrated probability of abuse of every document."""
    return abuse.score(table(spark, d, "documents"), table(spark, d, "doc_labels")).select("doc_id", "source", "score", "abusive")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Abusive documents."""
    return p9_scores(spark, d).filter("abusive").select("doc_id")


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    """Documents, abusive documents and their rate by source."""
    x = p9_scores(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if("abusive").alias("abusive"), F.avg("score").alias("mean_score"))
    return x.withColumn("rate", F.col("abusive") / F.col("documents"))


QUERIES = {f.__name__: f for f in (p5_found, p7_ids, p7_offsets, p7_decoded, p8_found, p8_items, p9_found, p9_scores, p9_rates)}

_SIGHT = """SELECT DISTINCT {key} AS id, lower(trim(regexp_replace(scientific_name, '[\\s_]+', ' ', 'g'))) AS name, round_even(latitude / 0.25, 0) AS la,
  CASE WHEN round_even(lo / 0.25, 0) >= 720 THEN round_even(lo / 0.25, 0) - 1440 ELSE round_even(lo / 0.25, 0) END AS lo,
  epoch(CASE WHEN regexp_full_match(timestamp, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9:]{{8}}') THEN try_cast(timestamp AS TIMESTAMP)
             WHEN regexp_full_match(timestamp, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9:]{{8}}(Z|[+-][0-9]{{2}}:[0-9]{{2}})') THEN
               try_cast(left(timestamp, 19) AS TIMESTAMP) - CASE WHEN right(timestamp, 1) = 'Z' THEN INTERVAL 0 MINUTE ELSE
                 to_minutes((CASE WHEN substr(timestamp, 20, 1) = '-' THEN -1 ELSE 1 END) * (try_cast(substr(timestamp, 21, 2) AS INT) * 60 + try_cast(substr(timestamp, 24, 2) AS INT))) END END)::BIGINT AS t
  FROM (SELECT *, CASE WHEN longitude >= 180 THEN longitude - 360 ELSE longitude END AS lo FROM {table} WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 360 AND NOT (latitude = 0 AND longitude = 0))"""
SQL = {
    "p5_found": f"""WITH i AS ({_SIGHT.format(key="image_id", table="image_metadata")}), a AS ({_SIGHT.format(key="audio_id", table="audio_metadata")}),
      m AS (SELECT i.id AS image_id, a.id AS audio_id, row_number() OVER (PARTITION BY i.id ORDER BY abs(a.t - i.t), a.t, a.id) AS r FROM i JOIN a USING (name, la, lo) WHERE name <> '' AND abs(a.t - i.t) <= 1800)
      SELECT image_id, audio_id FROM m WHERE r = 1""",
}
