"""Observations as a stream: snapped, slotted, without duplicates, appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldloom.functions.geo import snap
from fieldloom.functions.time import six_hour_slot
from fieldloom.operators.joins import fingerprint


def prepared(stream: DataFrame, time: str, lat: str, lon: str, keys: list[str], late: str = "10 days") -> DataFrame:
    """``stream`` with ``slot``, ``cell_lat``, ``cell_lon`` and ``unique_id``, each record once within the lateness.

    The watermark is on the raw time; records later than ``late`` may be dropped from the check for duplicates. Null times
    and coordinates pass with null slots and cells.
    """
    x = stream.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    x = x.withColumns({"slot": six_hour_slot(F.col("__t")), "cell_lat": snap(F.col(lat)), "cell_lon": snap(F.col(lon)), "unique_id": fingerprint(keys)})
    return x.dropDuplicatesWithinWatermark(["unique_id"]) if stream.isStreaming else x.dropDuplicates(["unique_id"])


def slot_totals(stream: DataFrame, time: str, lat: str, lon: str, species: str, value: str, late: str = "1 day") -> DataFrame:
    """Sums a species, cell and six-hour slot; grouping is by the nearest slot, not by a window, with the watermark on the slot."""
    x = stream.withColumn("slot", six_hour_slot(F.col(time).cast("timestamp"))).withWatermark("slot", late)
    return x.groupBy(species, snap(F.col(lat)).alias("cell_lat"), snap(F.col(lon)).alias("cell_lon"), "slot").agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything there is, appended to Parquet exactly once, then stopped; run again for what has come since."""
    return stream.drop("__t").writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def keep(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All there is of an aggregated stream as a Parquet table that is replaced after each batch, then stopped; run again for what
    has come since. A replaced batch is the same batch, so a restart changes nothing."""
    write = lambda batch, _: batch.write.mode("overwrite").parquet(path)
    return totals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start()
