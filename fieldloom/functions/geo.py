"""Coordinates: conventions, grids, distances and the European equal-area grid, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from fieldloom.functions.barrier import computed

EARTH_RADIUS_KM = 6371.0


def is_location(lat: Column, lon: Column) -> Column:
    """Latitude in -90..90, longitude in -180..360 and not exactly (0, 0); null and NaN give false."""
    lat, lon = lat.cast("double"), lon.cast("double")
    ok = lat.between(-90.0, 90.0) & lon.between(-180.0, 360.0) & ~((lat == 0.0) & (lon == 0.0))
    return F.coalesce(ok, F.lit(False))


def canonical_lon(lon: Column) -> Column:
    """Longitudes of either convention (-180..180 or 0..360) as -180 <= x < 180."""
    return F.when(lon >= 180.0, lon - 360.0).otherwise(lon)


def wrap_lon(lon: Column) -> Column:
    """Any finite longitude wrapped to -180 <= x < 180."""
    return F.pmod(lon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def snap(x: Column, step: float = 0.25) -> Column:
    """Nearest multiple of ``step``, halves to the even multiple."""
    return F.rint(x / F.lit(float(step))) * F.lit(float(step))


def cell_centre(x: Column, step: float = 0.25) -> Column:
    """Centre of the half-open cell of width ``step`` that holds x."""
    return F.floor(x / F.lit(float(step))) * F.lit(float(step)) + F.lit(float(step) / 2)


def axis_index(x: Column, start: float, step: float = 0.25) -> Column:
    """Index of the nearest point of the axis start, start + step, … (halves to even); may lie outside the axis."""
    return F.rint((x - F.lit(float(start))) / F.lit(float(step))).cast("int")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance on a sphere; null if any part is null."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def with_eea(df: DataFrame, code: Column, out: str) -> DataFrame:
    """``df`` with ``out``: struct(ew, easting, ns, northing, code) of a 10 km cell code, null if the text names no cell.

    Accepted, letter case and outer blanks aside: an optional ``10km``, E or W with digits, N or S with
    digits; or eight digits, four of easting and four of northing. ``code`` is the canonical spelling, as
    10kmE384N584, without leading zeros. Null and empty texts name no cell.
    """
    text = F.upper(F.regexp_replace(code.cast("string"), r"^[\s\u00a0]+|[\s\u00a0]+$", ""))
    one = r"\A(?:10KM)?(?:(?<ew>[EW])(?<e>\d{1,9})(?<ns>[NS])(?<n>\d{1,9})|(?<e8>\d{4})(?<n8>\d{4}))\z"
    x = computed(df, {"__eea": F.regexp_replace(text, one, "=${ew},${e}${e8},${ns},${n}${n8}")})
    x = computed(x, {"__eea": F.when(F.col("__eea").startswith("="), F.split(F.substring("__eea", 2, 60), ","))})
    part = lambda i: F.get("__eea", F.lit(i))
    ew, ns, e, n = F.coalesce(F.nullif(part(0), F.lit("")), F.lit("E")), F.coalesce(F.nullif(part(2), F.lit("")), F.lit("N")), part(1).try_cast("int"), part(3).try_cast("int")
    made = F.struct(ew.alias("ew"), e.alias("easting"), ns.alias("ns"), n.alias("northing"), F.concat(F.lit("10km"), ew, e.cast("string"), ns, n.cast("string")).alias("code"))
    return computed(x, {out: F.when(F.col("__eea").isNotNull(), made)}).drop("__eea")


def eea_metres(parts: Column) -> tuple[Column, Column]:
    """Cell centre in metres (easting, northing); W and S negate."""
    e = parts["easting"].cast("long") * 10_000 + 5_000
    n = parts["northing"].cast("long") * 10_000 + 5_000
    return F.when(parts["ew"] == "W", -e).otherwise(e), F.when(parts["ns"] == "S", -n).otherwise(n)


def laea_inverse(easting: Column, northing: Column) -> tuple[Column, Column]:
    """(latitude, longitude) in degrees of ETRS89 / LAEA Europe metres: the ellipsoidal inverse of EPSG method 9820 on GRS80."""
    # Fixed values of EPSG:3035.
    a, inv_f, lat0, lon0, fe, fn = 6378137.0, 298.257222101, math.radians(52.0), math.radians(10.0), 4321000.0, 3210000.0
    f = 1 / inv_f
    e2 = 2 * f - f * f
    e = math.sqrt(e2)

    def q_of(phi: float) -> float:
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - (1 / (2 * e)) * math.log((1 - e * s) / (1 + e * s)))

    qp, q0 = q_of(math.pi / 2), q_of(lat0)
    beta0, rq = math.asin(q0 / qp), a * math.sqrt(qp / 2)
    d = a * (math.cos(lat0) / math.sqrt(1 - e2 * math.sin(lat0) ** 2)) / (rq * math.cos(beta0))
    x, y = easting - F.lit(fe), northing - F.lit(fn)
    rho = F.sqrt(F.pow(x / d, 2) + F.pow(y * d, 2))
    c = F.lit(2.0) * F.asin(F.least(F.lit(1.0), rho / (2 * rq)))
    safe = F.when(rho == 0, F.lit(1.0)).otherwise(rho)
    beta = F.asin(F.cos(c) * math.sin(beta0) + F.when(rho == 0, F.lit(0.0)).otherwise(d * y * F.sin(c) * math.cos(beta0) / safe))
    lon = F.lit(lon0) + F.atan2(x * F.sin(c), d * rho * math.cos(beta0) * F.cos(c) - d * d * y * math.sin(beta0) * F.sin(c))
    lat = beta + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * beta) + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * beta) + (761 * e2**3 / 45360) * F.sin(6 * beta)
    return F.degrees(lat), F.degrees(lon)
