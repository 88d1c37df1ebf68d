"""Normalising mixed timestamp texts to UTC (problem 6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldloom.functions.barrier import computed
from fieldloom.functions.timeparse import utc_text, with_instant

CANONICAL = r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"


def event_text(date: Column, time: Column) -> Column:
    """One text of a date and a clock time in two columns; a time without digits adds nothing to a date that has its own clock."""
    time = F.trim(F.coalesce(time.cast("string"), F.lit("")))
    return F.when(time.rlike(r"\d"), F.concat_ws(" ", F.trim(date), time)).otherwise(date)


def normalise_single(df: DataFrame, text: str = "timestamp", zone: str = "UTC") -> DataFrame:
    """``df`` with ``utc_seconds`` and ``utc_time`` of one text column; a text without zone is in ``zone``.

    Texts that denote no single instant (null, empty, dates only, impossible or ambiguous times) get nulls.
    """
    x = with_instant(df, F.col(text), "utc_seconds", F.lit(zone))
    return computed(x, {"utc_time": utc_text(F.col("utc_seconds"))})


def normalise_event(df: DataFrame, date: str = "eventdate", time: str = "eventtime", zone: str = "eventzone") -> DataFrame:
    """``df`` with ``utc_seconds`` and ``utc_time`` of date, clock time and zone columns.

    A zone or offset within date or time goes before the zone column; without any the instant is unknown.
    """
    x = with_instant(df, event_text(F.col(date), F.col(time)), "utc_seconds", F.col(zone), allow_epoch=False)
    return computed(x, {"utc_time": utc_text(F.col("utc_seconds"))})


def once(df: DataFrame, key: str) -> DataFrame:
    """Each record once; ``df`` has only the columns used. Repeated deliveries are equal in them, so equal rows are reduced to one,
    by hash and without a sort; rows of one key that differ are different records. Rows with a null key are dropped."""
    return df.filter(F.col(key).isNotNull()).distinct()
