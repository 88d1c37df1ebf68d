"""Timestamps in many notations to one UTC instant.

Every notation is one alternative of a single regular expression with named groups. It is matched once a
text; the named groups go into a separated string, so no component is extracted twice. What follows is
integer arithmetic on the components: the calendar is checked, days are counted, and zones are applied.
Everything stays in the JVM as built-in expressions.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldloom.functions.barrier import computed

#: English month names by their first three letters, and zone abbreviations in their European meaning (hours from UTC).
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
ABBREVIATIONS = {"z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 1, "bst": 1, "ist": 1, "cet": 1, "cest": 2, "met": 1, "mest": 2, "mez": 1, "mesz": 2, "eet": 2, "eest": 3, "msk": 3}

_MONTH = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_DATE = "|".join(
    [
        r"(?<ya>\d{4})(?<sa>[-/.])(?<ma>\d{1,2})\k<sa>(?<da>\d{1,2})",
        r"(?<yb>\d{4})(?<mb>\d{2})(?<db>\d{2})",
        r"(?<dc>\d{1,2})(?<sc>[-/.])(?<mc>\d{1,2})\k<sc>(?<yc>\d{4})",
        rf"(?<dd>\d{{1,2}})(?:st|nd|rd|th)?\.?[ -](?<nd>{_MONTH})\.?,?[ -](?<yd>\d{{4}})",
        rf"(?<ne>{_MONTH})\.?[ -](?<de>\d{{1,2}})(?:st|nd|rd|th)?,?[ -](?<ye>\d{{4}})",
    ]
)
_MONTH_ONLY = "|".join([r"(?<yf>\d{4})[-/.](?<mf>\d{1,2})", r"(?<yg>\d{4})(?<mg>\d{2})", r"(?<mh>\d{1,2})[-/.](?<yh>\d{4})", rf"(?<ni>{_MONTH})\.?,?[ -](?<yi>\d{{4}})"])
_CLOCK = "|".join([r"(?<ha>\d{1,2})[:.h](?<ia>\d{2})(?:[:.](?<sx>\d{2})(?:[.,]\d{1,9})?)?(?:\s*(?<pa>[ap])\.?m\.?)?", r"(?<hb>\d{2})(?<ib>\d{2})(?<sb>\d{2})?", r"(?<hc>\d{1,2})\s*(?<pc>[ap])\.?m\.?"])
_ZONE = r"(?:\s*(?<za>[+-]\d{1,2}(?::?\d{2})?|[a-z]{1,5}|[a-z]+(?:/[a-z0-9_+-]+){1,2}))?(?:\s*\[(?<zb>[a-z]+(?:/[a-z0-9_+-]+){0,2})\])?"
#: The one alternation: an epoch number, a date with an optional clock time and zone, or a month.
PATTERN = (
    rf"(?i)\A[\s ﻿]*(?:\[\s*['\"])?\s*(?:(?<ep>\d{{9,14}})|(?:{_DATE})(?:(?:\s*t\s*|[\s,]+)(?:{_CLOCK}){_ZONE})?|(?:{_MONTH_ONLY}))\s*(?:['\"]\s*\])?[\s ]*\z"
)
_SEP = "\u0001"
_REPLACEMENT = "=" + _SEP.join(
    "".join("${%s}" % g for g in groups.split())
    for groups in ("ya yb yc yd ye yf yg yh yi", "ma mb mc mf mg mh", "nd ne ni", "da db dc dd de", "ha hb hc", "ia ib", "sx sb", "pa pc", "za", "zb", "ep", "hc")
)


@lru_cache(maxsize=1)
def zone_names() -> tuple[str, ...]:
    """IANA names with an area (Europe/Berlin) that the session's Java knows; the table of zones is the installed one, so its size is fixed."""
    spark = SparkSession.active()
    known = {z.strip() for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds().toString().strip("[]").split(",")}
    return tuple(sorted(z for z in known if "/" in z and not z.startswith("SystemV")))


def components(text: Column) -> Column:
    """struct of the raw components of a date text, null where no notation fits (also for null and empty texts)."""
    marked = F.regexp_replace(text.cast("string"), F.lit(PATTERN), F.lit(_REPLACEMENT))
    return F.when(marked.startswith("="), F.split(F.substring(marked, 2, 1_000_000), _SEP))


def days_in_month(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a Gregorian date, in integer arithmetic (years counted from March)."""
    yy = F.when(m <= 2, y - 1).otherwise(y).cast("long")
    mm = F.pmod(m + 9, F.lit(12)).cast("long")
    return yy * 365 + _div(yy, 4) - _div(yy, 100) + _div(yy, 400) + _div(mm * 153 + 2, 5) + d.cast("long") - 1 - 719468


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("long")


def offset_seconds(zone: Column) -> Column:
    """Seconds east of UTC of an offset (+05:45, -0330, +02) or a European abbreviation; null for anything else."""
    z = F.lower(F.trim(zone))
    sign = F.when(z.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(z, "[^0-9]", "")
    hh = F.when(F.length(digits) <= 2, digits).otherwise(F.expr("NULL").cast("string"))
    hours = F.coalesce(hh, F.substring(digits, 1, 2), F.lit(""))
    hours = F.when(F.length(digits) == 3, F.substring(digits, 1, 1)).otherwise(hours).try_cast("int")
    minutes = F.when(F.length(digits) == 4, F.substring(digits, 3, 2)).when(F.length(digits) == 3, F.substring(digits, 2, 2)).otherwise(F.lit("0")).try_cast("int")
    numeric = F.when(z.rlike(r"\A[+-]\d{1,2}(?::?\d{2})?\z") & (hours <= 18) & (minutes <= 59), sign * (hours * 3600 + minutes * 60))
    named = F.create_map(*[F.lit(x) for k, v in ABBREVIATIONS.items() for x in (k, v * 3600)])
    return F.coalesce(numeric, F.try_element_at(named, z)).cast("long")


def _offset_at(utc: Column, zone: Column) -> Column:
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(utc), zone)) - utc


def with_instant(df: DataFrame, text: Column, out: str, default_zone: Column | None = None, allow_epoch: bool = True) -> DataFrame:
    """``df`` with ``out``: UTC seconds since 1970 (bigint) of the instant that ``text`` denotes, else null.

    Null for: null, empty and unknown texts, dates without a clock time, periods, parts of the day,
    impossible dates and times, zones that are unknown, and wall-clock times that a named zone has twice or
    never unless the text has an offset. ``default_zone`` holds for texts without zone or offset (offset,
    abbreviation or IANA name; null or unknown: no instant). Fractions of a second are cut off, absent
    seconds are 0. Dates not beginning with the year begin with the day unless the month is a word.
    ``allow_epoch``: 9 to 11 digits alone are seconds, 12 to 14 milliseconds since 1970.
    """
    default_zone = F.lit("UTC") if default_zone is None else default_zone
    t = "__t_"
    num = lambda i: F.get(F.col(t + "c"), F.lit(i)).try_cast("int")
    txt = lambda i: F.nullif(F.get(F.col(t + "c"), F.lit(i)), F.lit(""))
    x = computed(df, {t + "c": components(text), t + "dz": F.trim(default_zone.cast("string"))})
    x = x.withColumns(
        {
            t + "y": num(0), t + "m": F.coalesce(num(1), F.when(txt(2).isNotNull(), ((F.instr(F.lit(MONTHS), F.lower(F.substring(txt(2), 1, 3))) + 2) / 3).cast("int"))), t + "d": num(3),
            t + "h0": num(4), t + "i": F.coalesce(num(5), F.when(txt(11).isNotNull(), F.lit(0))), t + "s": F.coalesce(num(6), F.lit(0)), t + "p": F.lower(txt(7)),
            t + "za": txt(8), t + "zb": txt(9), t + "ep": txt(10).try_cast("long"), t + "el": F.length(txt(10)),
        }
    )
    h0, p = F.col(t + "h0"), F.col(t + "p")
    x = x.withColumn(t + "h", F.when(p.isNull(), F.when(h0.between(0, 23), h0)).when(h0.between(1, 12), h0 % 12 + F.when(p == "p", 12).otherwise(0)))
    y, m, d, h, i, s = (F.col(t + k) for k in "ymdhis")
    good = y.between(1, 9999) & m.between(1, 12) & (d >= 1) & (d <= days_in_month(y, m)) & h.isNotNull() & i.between(0, 59) & s.between(0, 59)
    x = x.withColumns({t + "l": F.when(good, days_from_civil(y, m, d) * 86400 + h * 3600 + i * 60 + s), t + "z": F.coalesce(F.col(t + "za"), F.col(t + "zb"), F.col(t + "dz"))})
    local, zone = F.col(t + "l"), F.col(t + "z")
    x = x.withColumns({t + "o": F.when(local.isNotNull(), offset_seconds(zone)), t + "n": F.when(local.isNotNull() & zone.isin(*zone_names()), zone)})
    name = F.col(t + "n")
    # Offsets a day before and after: the wall-clock time may have either, and counts if exactly one of them holds at its own instant.
    x = x.withColumns({t + "o1": F.when(name.isNotNull(), _offset_at(local - 86400, name)), t + "o2": F.when(name.isNotNull(), _offset_at(local + 86400, name))})
    o1, o2 = F.col(t + "o1"), F.col(t + "o2")
    x = x.withColumns({t + "v1": F.when(name.isNotNull(), _offset_at(local - o1, name) == o1), t + "v2": F.when(name.isNotNull(), _offset_at(local - o2, name) == o2)})
    v1, v2 = F.col(t + "v1"), F.col(t + "v2")
    by_name = F.when(v1 & ((o1 == o2) | ~v2), local - o1).when(v2 & ~v1, local - o2)
    epoch = F.when(F.col(t + "el") <= 11, F.col(t + "ep")).otherwise(_div(F.col(t + "ep"), 1000)) if allow_epoch else F.expr("CAST(NULL AS BIGINT)")
    made = F.when(F.col(t + "ep").isNotNull(), epoch).when(F.col(t + "o").isNotNull(), local - F.col(t + "o")).otherwise(by_name)
    return computed(x, {out: made.cast("long")}).drop(*[c for c in x.columns if c.startswith(t)])


def utc_text(seconds: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of UTC seconds, whatever the session's time zone."""
    day = _div(seconds, 86400)
    rest = seconds - day * 86400
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(F.date_from_unix_date(day.cast("int")).cast("string"), F.lit(" "), two(_div(rest, 3600)), F.lit(":"), two(F.pmod(_div(rest, 60), F.lit(60))), F.lit(":"), two(F.pmod(rest, F.lit(60))))


def with_month_index(df: DataFrame, text: Column, out: str) -> DataFrame:
    """``df`` with ``out``: months since year 0 (12 * year + month - 1) of a text that names a real calendar day or a month of a year, else null."""
    # The commonest notation is cut at its places; the large pattern is only matched for the others.
    whole = text.cast("string")
    cut = F.array(F.substring(whole, 1, 4), F.substring(whole, 6, 2), F.lit(""), F.substring(whole, 9, 2))
    x = computed(df, {"__mc": F.when(whole.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), cut).otherwise(components(text))})
    return computed(x, {out: _month_of(F.col("__mc"))}).drop("__mc")


def _month_of(c: Column) -> Column:
    num = lambda i: F.get(c, F.lit(i)).try_cast("int")
    word = F.nullif(F.get(c, F.lit(2)), F.lit(""))
    y, d = num(0), num(3)
    m = F.coalesce(num(1), F.when(word.isNotNull(), ((F.instr(F.lit(MONTHS), F.lower(F.substring(word, 1, 3))) + 2) / 3).cast("int")))
    has_day = F.nullif(F.get(c, F.lit(3)), F.lit("")).isNotNull()
    ok = y.between(1, 9999) & m.between(1, 12) & (~has_day | ((d >= 1) & (d <= days_in_month(y, m))))
    return F.when(ok, y * 12 + m - 1)
