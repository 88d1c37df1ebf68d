"""Irregular readings onto a regular monthly grid (problem 3).

A harmonic seasonal regression with trend is fitted for each group by distributed normal equations: every row
adds to the group's sums of products, and only the few sums of a group are solved. Missing months get the
regression's value plus the residuals of the observed neighbours, bridged: the residual of an end counts the more, the
nearer it is and the stronger neighbouring residuals of the group resemble each other (their autocorrelation, from the
same sums). Where they resemble each other fully the bridge is a straight line, where they don't it is the regression.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T, Window as W

from fieldloom.durable import durable
from fieldloom.functions.barrier import computed
from fieldloom.functions.geo import with_eea
from fieldloom.functions.timeparse import with_month_index
from fieldloom.operators.timestamps import once
from fieldloom.skew import salted_join

#: Months from which the trend is counted, and months a unit of it; both only condition the equations.
TREND_ORIGIN, TREND_UNIT = 12 * 2000, 120.0


def design(month: Column, harmonics: int) -> list[Column]:
    """Regressors of a month index: 1, trend, and cosine and sine of each harmonic of the year."""
    x = [F.lit(1.0), (month - TREND_ORIGIN) / TREND_UNIT]
    for k in range(1, harmonics + 1):
        x += [F.cos(month * (2 * math.pi * k / 12)), F.sin(month * (2 * math.pi * k / 12))]
    return x


def fit_harmonic(monthly: DataFrame, group: list[str], month: str, value: str, harmonics: int = 1, ridge: float = 1e-3, ahead: tuple[str, str] | None = None) -> DataFrame:
    """One row a group: ``coef`` (array of doubles), ``n`` and, given the month and value of each row's next reading
    (``ahead``), ``rho``: the autocorrelation of the residuals of readings one month apart, less its standard error and
    within 0…1; null without such readings. The sums are built-in aggregates, combined before the shuffle. The ridge
    leaves the level (the first coefficient) alone.
    """
    x, v = design(F.col(month).cast("double"), harmonics), F.col(value)
    p = len(x)
    upper = [(i, j) for i in range(p) for j in range(i, p)]
    sums = [x[i] * x[j] for i, j in upper] + [x[i] * v for i in range(p)]
    if ahead:
        # For residuals r and r' one month apart: what r r' and (r² + r'²) / 2 are made of, as quadratic forms of the coefficients.
        one = F.col(ahead[0]) - F.col(month) == 1
        x2, v2 = design(F.col(ahead[0]).cast("double"), harmonics), F.col(ahead[1])
        for a, b, w, z in ((x, x2, v, v2), (x2, x, v2, v), (x, x, v, v), (x2, x2, v2, v2)):
            # Σ w z, Σ a z (twice with the roles changed) and Σ a b.
            sums += [F.when(one, c) for c in (w * z, *[a[i] * z for i in range(p)], *[a[i] * b[j] for i in range(p) for j in range(p)])]
        sums.append(F.when(one, F.lit(1.0)))
    equations = monthly.groupBy(*group).agg(F.array(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in sums]).alias("__sums"), F.count(F.lit(1)).alias("n"))

    @F.pandas_udf(T.StructType([T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("rho", T.DoubleType())]))
    def solve(s: pd.Series) -> pd.DataFrame:
        if not len(s):
            return pd.DataFrame({"coef": pd.Series([], dtype=object), "rho": pd.Series([], dtype=float)})
        a = np.array(s.tolist(), dtype=float)
        xtx = np.zeros((len(a), p, p))
        for c, (i, j) in enumerate(upper):
            xtx[:, i, j] = xtx[:, j, i] = a[:, c]
        xtx += ridge * np.maximum(1.0, xtx[:, :1, :1]) * np.diag([0.0] + [1.0] * (p - 1)) + 1e-9 * np.eye(p)
        coef = np.linalg.solve(xtx, a[:, len(upper) : len(upper) + p, None])[:, :, 0]
        rho = np.full(len(a), np.nan)
        if ahead:
            at, size, q = len(upper) + p, 1 + p + p * p, []
            for k in range(4):
                part = a[:, at + k * size : at + (k + 1) * size]
                form = np.einsum("ni,nij,nj->n", coef, part[:, 1 + p :].reshape(-1, p, p), coef)
                q.append((part[:, 0], (coef * part[:, 1 : 1 + p]).sum(1), form))
            cross = q[0][0] - q[0][1] - q[1][1] + q[0][2]
            own = (q[2][0] + q[3][0] - 2 * q[2][1] - 2 * q[3][1] + q[2][2] + q[3][2]) / 2
            pairs = a[:, -1]
            with np.errstate(all="ignore"):
                rho = np.where(own > 1e-9 * np.abs(q[2][0]), np.clip(cross / own - 1 / np.sqrt(pairs), 0.0, 1.0), np.nan)
        return pd.DataFrame({"coef": list(coef), "rho": rho})

    solved = computed(equations, {"__f": solve("__sums")})
    return solved.select(*group, F.col("__f.coef").alias("coef"), F.when(~F.isnan("__f.rho"), F.col("__f.rho")).alias("rho"), "n")


def regular_monthly(readings: DataFrame, series: list[str], month: str, value: str, group: list[str], harmonics: int = 1, least: float = 0.0) -> DataFrame:
    """The complete monthly grid of every series between its first and last reading.

    ``readings``: valid readings with non-null series, month index (12 * year + month - 1) and numeric value; the
    values of one month of one series are summed first, so a series has at most as many rows as the calendar has
    months and its window is bounded however many readings it has. Result: ``series``, ``month``, ``value`` (null
    in missing months), ``filled`` (observed, or estimated and then not below ``least``, as counts can't be), ``is_missing``.
    Empty input gives an empty result; a series of one month has no gaps. Groups without readings one month apart
    bridge in straight lines.
    """
    if [c for c in series if c in group] != group:
        raise ValueError("group must be part of series")
    monthly = readings.groupBy(*series, F.col(month).alias("__m")).agg(F.sum(value).cast("double").alias("__v"))
    w = W.partitionBy(*series).orderBy("__m")
    ahead = durable(monthly.withColumns({"__m2": F.lead("__m").over(w), "__v2": F.lead("__v").over(w)}))
    coef = durable(fit_harmonic(ahead, group, "__m", "__v", harmonics, ahead=("__m2", "__v2")))
    x = salted_join(ahead, coef, group, "n", F.concat_ws("|", *[F.col(c).cast("string") for c in series]), "left")
    model = lambda m: sum((F.get("coef", F.lit(i)) * d for i, d in enumerate(design(m.cast("double"), harmonics))), F.lit(0.0))
    x = computed(x, {"__r": F.col("__v") - model(F.col("__m")), "__r2": F.col("__v2") - model(F.col("__m2"))})
    x = x.withColumn("__at", F.explode(F.sequence(F.col("__m"), F.coalesce(F.col("__m2") - 1, F.col("__m")))))
    one, two, rho = F.col("__at") - F.col("__m"), F.col("__m2") - F.col("__at"), F.least(F.coalesce(F.col("rho"), F.lit(1.0)), F.lit(0.9999))
    share = one / (one + two)
    near, far, both = F.pow(rho, one), F.pow(rho, two), F.pow(rho, one + two)
    bridged = model(F.col("__at")) + (F.col("__r") * (near - both * far) + F.col("__r2") * (far - both * near)) / (1 - both * both)
    # Where the sums of a group overflow, there is no model: the readings themselves are bridged.
    bridged = F.nanvl(F.coalesce(bridged, F.lit(math.nan)), F.col("__v") * (1 - share) + F.col("__v2") * share)
    missing = F.col("__at") != F.col("__m")
    return x.select(*series, F.col("__at").alias(month), F.when(~missing, F.col("__v")).alias(value), F.when(missing, F.greatest(F.lit(float(least)), bridged)).otherwise(F.col("__v")).alias("filled"), missing.alias("is_missing"))


def month_text(month: Column) -> Column:
    """``yyyy-MM`` of a month index."""
    return F.concat(F.lpad(F.floor(month / 12).cast("string"), 4, "0"), F.lit("-"), F.lpad((F.pmod(month, F.lit(12)) + 1).cast("string"), 2, "0"))


def cube_readings(cube: DataFrame) -> DataFrame:
    """Readings of a cell cube that count: specieskey, eeacellcode (canonical), __month, __count.

    A reading counts if its date names a real day or month, its code one cell and its number is at least 0; nulls
    and anything else drop it. A record delivered more than once counts once.
    """
    x = cube.select("cube_id", "specieskey", "yearmonthday", "eeacellcode", "occurrences")
    number = F.trim("occurrences")
    x = with_eea(with_month_index(x, F.col("yearmonthday"), "__month"), F.col("eeacellcode"), "__cell")
    x = computed(x, {"__count": F.when(number.rlike(r"\A\+?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\z"), number.try_cast("double"))})
    x = x.filter(F.col("specieskey").isNotNull() & F.col("__month").isNotNull() & F.col("__cell").isNotNull() & (F.col("__count") >= 0))
    return once(x.select("cube_id", "specieskey", F.col("__cell.code").alias("eeacellcode"), "__month", "__count"), "cube_id").drop("cube_id")


def cube_series(cube: DataFrame) -> DataFrame:
    """Monthly series of every species and cell of a cell cube: specieskey, eeacellcode, period, occurrences, filled, is_missing."""
    grid = regular_monthly(cube_readings(cube), ["specieskey", "eeacellcode"], "__month", "__count", ["specieskey"])
    return grid.select("specieskey", "eeacellcode", month_text(F.col("__month")).alias("period"), F.col("__count").alias("occurrences"), "filled", "is_missing")
