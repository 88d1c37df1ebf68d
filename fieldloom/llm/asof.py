"""Pairing records with the nearest record in time (problem 5).

Both sides are unioned and range-partitioned globally by entity and time, so that an entity may fill many
tasks. Each task scans its own sorted rows; what it lacks are the nearest right records beyond its edges. Those
come from a prefix scan in parallel blocks over the edge records of all partitions (two rows a partition).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T, Window as W

from fieldloom.durable import durable


def _scanned(edges: DataFrame, out: str, value: str, forwards: bool, partitions: int) -> DataFrame:
    """Exclusive running maximum (or, backwards, minimum) of ``value`` by ``pid``: within blocks in parallel, then over the block totals."""
    width = max(1, math.isqrt(partitions - 1) + 1)
    best = F.max if forwards else F.min
    span = (W.unboundedPreceding, -1) if forwards else (1, W.unboundedFollowing)
    blocks = edges.withColumn("block", F.floor(F.col("pid") / width))
    inner = blocks.withColumn("within", best(value).over(W.partitionBy("block").orderBy("pid").rowsBetween(*span)))
    totals = blocks.groupBy("block").agg(best(value).alias("total"))  # at most about sqrt(partitions) rows
    outer = totals.withColumn("beyond", best("total").over(W.orderBy("block").rowsBetween(*span))).select("block", "beyond")
    return inner.join(outer, "block").select("pid", F.coalesce("within", "beyond").alias(out))


def nearest_in_time(left: DataFrame, right: DataFrame, keys: list[str], time: str, left_id: str, right_id: str, tolerance: int, partitions: int | None = None) -> DataFrame:
    """(left_id, right_id) of each left row with the right row of equal keys nearest in time, at most ``tolerance`` away.

    ``time``: whole numbers of one unit in both inputs. Of two equally near the earlier wins, then the smaller id.
    Rows with a null key, time or id take no part; equal right rows (same keys and time) are reduced to the smallest
    id first. An id of the left side that occurs more than once gives one row a distinct (keys, time). Empty inputs
    give an empty result. Other columns play no role, whatever their names. A task holds its own range only: an
    entity with any share of the rows is split over several.
    """
    spark = left.sparkSession
    n = max(1, partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = [f"k{i}" for i in range(len(keys))]
    tidy = lambda df, key: df.select(*[F.col(k).alias(a) for k, a in zip(keys, names)], F.col(time).cast("long").alias("t"), F.col(key).cast("long").alias("id")).dropna()
    r = tidy(right, right_id).groupBy(*names, "t").agg(F.min("id").alias("id")).withColumn("side", F.lit(0))
    lf = tidy(left, left_id).distinct().withColumn("side", F.lit(1))
    order = [*names, "t", "side", "id"]
    both = durable(r.select(*order).unionByName(lf.select(*order)))  # range partitioning reads its input twice, once to sample it
    rows = durable(both.repartitionByRange(n, *order).sortWithinPartitions(*order)).withColumn("pid", F.spark_partition_id())
    record = F.when(F.col("side") == 0, F.struct(*names, "t", "id"))
    edges = rows.groupBy("pid").agg(F.max(record).alias("last"), F.min(record).alias("first"))
    edges = durable(edges)
    carried = _scanned(edges, "before", "last", True, n).join(_scanned(edges, "after", "first", False, n), "pid")
    # Two records for each partition: bounded by the number of tasks, not by the data.
    brought = {x["pid"]: (x["before"], x["after"]) for x in carried.collect()}
    count = len(names)

    def scan(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        before, after = brought[table.column("pid")[0].as_py()]
        size = table.num_rows
        new = np.zeros(size, dtype=bool)
        for a in names:
            c = table.column(a).combine_chunks()
            if size > 1:
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, size - 1)).to_numpy(zero_copy_only=False)
        group = np.cumsum(new)
        t, ident, is_right = table.column("t").to_numpy(), table.column("id").to_numpy(), table.column("side").to_numpy() == 0
        at = np.arange(size)
        prior = np.maximum.accumulate(np.where(is_right, at, -1))
        nxt = np.minimum.accumulate(np.where(is_right, at, size)[::-1])[::-1]
        far = np.iinfo(np.int64).max
        best, who = np.full(size, far), np.full(size, -1, dtype=np.int64)

        def offer(rows: np.ndarray, times, ids) -> None:
            gap = np.abs(t[rows] - times)
            better = gap < best[rows]
            chosen = rows[better]
            best[chosen] = gap[better]
            who[chosen] = (ids[better] if isinstance(ids, np.ndarray) else ids)

        key_of = lambda i: tuple(table.column(a)[int(i)].as_py() for a in names)
        lefts = at[~is_right]
        own = lefts[(prior[lefts] >= 0)]
        own = own[group[prior[own]] == group[own]]
        offer(own, t[prior[own]], ident[prior[own]])
        if before is not None and key_of(0) == tuple(before)[:count]:
            rest = lefts[(group[lefts] == 0) & (prior[lefts] < 0)]
            offer(rest, before["t"], before["id"])
        own = lefts[nxt[lefts] < size]
        own = own[group[nxt[own]] == group[own]]
        offer(own, t[nxt[own]], ident[nxt[own]])
        if after is not None and key_of(size - 1) == tuple(after)[:count]:
            rest = lefts[(group[lefts] == group[-1]) & (nxt[lefts] >= size)]
            offer(rest, after["t"], after["id"])
        hit = lefts[(best[lefts] <= tolerance) & (who[lefts] >= 0)]
        hit = hit[best[hit] < far]
        yield pa.RecordBatch.from_arrays([pa.array(ident[hit]), pa.array(who[hit])], names=[left_id, right_id])

    schema = T.StructType([T.StructField(left_id, T.LongType()), T.StructField(right_id, T.LongType())])
    return rows.select(*names, "t", "side", "id", "pid").mapInArrow(scan, schema)
