"""Slots, months and free-text times as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def six_hour_slot(ts: Column) -> Column:
    """The nearest of 0, 6, 12 and 18 o'clock of the same day, seconds aside, of two equally near the earlier; null stays null."""
    minutes = F.hour(ts) * 60 + F.minute(ts)
    slot = F.least(F.lit(18), (F.ceil((minutes - 180) / 360) * 6).cast("int"))
    return F.timestamp_add("HOUR", slot, F.date_trunc("DAY", ts))


def month_start(ts: Column) -> Column:
    return F.date_trunc("MONTH", ts)


def coerced(text: Column, formats: list[str]) -> Column:
    """The timestamp of the first format that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


# Words for a part of the day and the clock times they stand for.
DAY_PARTS = {"Midday": "12:00", "Dawn": "06:00", "Dawn (at dusk)": "06:00", "Sunset (at dusk)": "18:00", "Sunset": "18:00", "Night": "20:00", "dusk": "18:00", "early": "06:00", "am": "00:00", "pm": "12:00"}


def free_clock(time: Column) -> Column:
    """HH:mm of a free-text time: parts of the day by DAY_PARTS (am and pm in any letter case), ``9.20 pm``, a bare hour of two digits; any other or impossible text is 00:00."""
    t = F.trim(time)
    dotted = F.replace(t, F.lit("."), F.lit(":"))
    table = F.create_map(*[F.lit(x) for kv in DAY_PARTS.items() for x in kv])
    half_day = F.lower(t)
    words = F.coalesce(F.try_element_at(table, t), F.when(half_day.isin("am", "pm"), F.try_element_at(table, half_day)))
    h, m = F.regexp_extract(dotted, r"^(\d{1,2}):(\d{1,2})(?: ([ap]m))?$", 1).try_cast("int"), F.regexp_extract(dotted, r"^(\d{1,2}):(\d{1,2})(?: ([ap]m))?$", 2).try_cast("int")
    half = F.regexp_extract(dotted, r"^\d{1,2}:\d{1,2} ([ap]m)$", 1)
    hour = F.when(half == "", F.when(h.between(0, 23), h)).when(h.between(1, 12), h % 12 + F.when(half == "pm", 12).otherwise(0))
    clock = F.when(hour.isNotNull() & m.between(0, 59), F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), F.lpad(m.cast("string"), 2, "0")))
    bare = F.when(t.rlike(r"^\d{2}$"), F.when(t.try_cast("int") < 24, F.concat(t, F.lit(":00"))))
    return F.when(t.contains("x") | t.contains("?:?"), F.lit("00:00")).otherwise(F.coalesce(words, clock, bare, F.lit("00:00")))


def free_text_time(date: Column, time: Column, offset: Column) -> Column:
    """UTC timestamp of a date text, a free-text time and an offset (+HH:MM): year 0000 gives null, a 00 month or day counts as 01."""
    day = F.replace(date, F.lit("-00"), F.lit("-01"))
    local = F.try_to_timestamp(F.concat_ws(" ", day, free_clock(time)), F.lit("yyyy-MM-dd HH:mm"))
    sign = F.when(offset.startswith("-"), -1).otherwise(1)
    minutes = sign * (F.substring(offset, -5, 2).try_cast("int") * 60 + F.substring(offset, -2, 2).try_cast("int"))
    return F.when(~date.startswith("0000"), F.timestamp_add("MINUTE", -minutes, local))


def header_year(name: Column) -> Column:
    """Year at the end of a header text, else null."""
    return F.nullif(F.regexp_extract(name, r"(\d{4})$", 1), F.lit("")).try_cast("int")


def fuzzy_year(text: Column) -> Column:
    """First run of four digits as a year, else null."""
    return F.nullif(F.regexp_extract(text, r"(?<!\d)(\d{4})(?!\d)", 1), F.lit("")).try_cast("int")
