"""Filling missing values from similar records (problem 2).

A Chow-Liu dependency tree is learnt over the group, the discretised and the categorical fields: the maximum
spanning tree of their mutual information, from distributed pair counts. The group (of any number of values) is a
node like any other, tied to the target. A field that the group determines hangs from the group and, as the group
is known, tells nothing more about the target; it isn't counted twice. Categories of any number of values are
leaves, whose values are joined and never pooled. Messages passed along the tree give the posterior of a missing
target; it is decoded to the mode, or to a median of the bin in the middle of the posterior: that of the fifth of
the group's values in the bin where the middle lies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from fieldloom.durable import durable
from fieldloom.skew import salted_join


#: Parts of a bin whose medians are kept for each group.
PARTS = 5


@dataclass(frozen=True)
class Spec:
    """What to fill: ``key`` names a record, ``group`` the expressions of its group, ``target`` the field with the range of values that count."""

    key: str
    group: dict[str, Column]
    target: str
    low: float
    high: float
    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    whole: bool = False  # whole numbers low…high are classes of their own; else the target is cut into bins
    bins: int = 16


def usable(c: Column, low: float, high: float) -> Column:
    """Not null, not NaN and within low…high."""
    x = c.cast("double")
    return F.coalesce(~F.isnan(x) & x.between(low, high), F.lit(False))


def _bin(c: Column, cuts: list[float]) -> Column:
    """Index of the bin of a number: how many cut points it reaches, by halving."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(c >= float(cuts[middle]), within(middle + 1, high)).otherwise(within(low, middle))

    return within(0, len(cuts))


def _prepared(df: DataFrame, spec: Spec) -> DataFrame:
    """Key, group columns, target and fields of each record once, all under names of their own; outer blanks and letter case of a category aside."""
    return df.filter(F.col(spec.key).isNotNull()).select(
        F.col(spec.key).alias("__key"), *[e.alias(f"__g_{n}") for n, e in spec.group.items()], F.when(usable(F.col(spec.target), spec.low, spec.high), F.col(spec.target).cast("double")).alias("__target"),
        *[clean_name(F.col(c).cast("string")).alias(f"__c_{c}") for c in spec.categorical], *[F.when(~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < 1e9), F.col(c).cast("double")).alias(f"__n_{c}") for c in spec.numeric],
    ).distinct()


def _indexed(x: DataFrame, spec: Spec) -> tuple[DataFrame, list[int]]:
    """The records with the target (``__i_0``) and the numbers (``__i_1`` …) as small class indexes, and the numbers of classes.

    Cut points are bounded lists: at most ``bins`` a number. Categories stay as they are.
    """
    quantiles = [i / spec.bins for i in range(1, spec.bins)]
    numbers = [f"__n_{c}" for c in spec.numeric]
    cut = numbers + ([] if spec.whole else ["__target"])
    row = x.agg(*[F.percentile_approx(c, quantiles, 2000).alias(c) for c in cut]).first() if cut else {}
    cuts = {c: sorted(set(row[c] or [])) for c in cut}
    index = lambda c: F.when(F.col(c).isNotNull(), _bin(F.col(c), cuts[c])).cast("int")
    first = (F.col("__target") - spec.low).cast("int") if spec.whole else index("__target")
    sizes = [int(spec.high - spec.low) + 1 if spec.whole else len(cuts["__target"]) + 1, *(len(cuts[c]) + 1 for c in numbers)]
    kept = ["__key", *[f"__g_{n}" for n in spec.group], "__target", *[f"__c_{c}" for c in spec.categorical]]
    return x.select(*kept, first.alias("__i_0"), *[index(c).alias(f"__i_{i}") for i, c in enumerate(numbers, 1)]), sizes


def _decoded(y: DataFrame, spec: Spec, size: int) -> list[float]:
    """The value each class of the target stands for: the whole number, or the median of the bin."""
    if spec.whole:
        return [spec.low + i for i in range(size)]
    found = {r["__i_0"]: r["m"] for r in y.filter(F.col("__i_0").isNotNull()).groupBy("__i_0").agg(F.percentile_approx("__target", 0.5, 2000).alias("m")).collect()}
    return [float(found.get(i, np.nan)) for i in range(size)]


def spanning_tree(weight: dict[tuple[int, int], float], fields: int, edges: list[tuple[int, int]] = (), leaves: frozenset[int] = frozenset()) -> list[tuple[int, int]]:
    """Edges (parent, child) of the maximum spanning tree from the root 0 outwards; ``edges`` are given, ``leaves`` are no parents."""
    inside, out = {0, *(b for _, b in edges)}, list(edges)
    while len(inside) < fields:
        a, b = max(((a, b) for a in inside - leaves for b in range(fields) if b not in inside), key=lambda e: (weight[min(e), max(e)], -e[1], -e[0]))
        out.append((a, b))
        inside.add(b)
    return out


def chow_liu_tree(counts: dict[tuple[int, int], np.ndarray], fields: int) -> list[tuple[int, int]]:
    """The tree of whole tables of pair counts."""

    def information(c: np.ndarray) -> float:
        n = c.sum()
        if n <= 0:
            return 0.0
        p = c / n
        e = p.sum(1, keepdims=True) * p.sum(0, keepdims=True)
        return float((p[p > 0] * np.log(p[p > 0] / e[p > 0])).sum())

    return spanning_tree({k: information(c) for k, c in counts.items()}, fields)


def pair_counts(y: DataFrame, fields: list[Column], pairs: list[tuple[int, int]]) -> DataFrame:
    """How often each two values of each pair of fields meet: p (index of the pair), a, b, n. Null values aren't counted; counts are combined before the shuffle."""
    each = F.array(*[F.struct(F.lit(i).alias("p"), fields[a].cast("long").alias("a"), fields[b].cast("long").alias("b")) for i, (a, b) in enumerate(pairs)])
    return y.select(F.explode(each).alias("e")).select("e.*").filter("a IS NOT NULL AND b IS NOT NULL").groupBy("p", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def mutual_information(counts: DataFrame, pairs: list[tuple[int, int]]) -> dict[tuple[int, int], float]:
    """Mutual information of each pair, less its bias from finite counts (Miller and Madow). Three rows a pair come to the driver, whatever the number of values."""
    sides = [counts.select("p", F.lit("ab").alias("side"), "n"), *[counts.groupBy("p", c).agg(F.sum("n").alias("n")).select("p", F.lit(c).alias("side"), "n") for c in ("a", "b")]]
    n = F.col("n").cast("double")
    found = sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy("p", "side").agg(F.sum(n).alias("n"), F.sum(n * F.log(n)).alias("s"), F.count(F.lit(1)).alias("k")).collect()
    at = {(r["p"], r["side"]): r for r in found}
    out = dict.fromkeys(pairs, 0.0)
    for i, pair in enumerate(pairs):
        if (i, "ab") in at:
            both, a, b = (at[i, s] for s in ("ab", "a", "b"))
            out[pair] = (both["s"] - a["s"] - b["s"]) / both["n"] + float(np.log(both["n"])) - (both["k"] - a["k"] - b["k"] + 1) / (2 * both["n"])
    return out


def posterior(own: np.ndarray, observed: np.ndarray, edges: list[tuple[int, int]], counts: dict, sizes: list[int], smooth: float = 0.5, sent: dict[int, list[np.ndarray]] | None = None) -> np.ndarray:
    """Posterior of the root for many records by message passing from the leaves.

    ``own``: counts of the root's classes within the record's group, unsmoothed, so that classes the group never
    had stay impossible. ``observed``: class index of each field, -1 where missing. An observed child sends the
    column of its value, a missing one the sum over its classes weighted with what its own children sent.
    ``sent``: messages that fields have already got from leaves of their own.
    """
    table = {}
    for a, b in edges:
        c = (counts[a, b] if a < b else counts[b, a].T) + smooth
        table[a, b] = c / c.sum(1, keepdims=True)
    belief: dict[int, np.ndarray] = {}
    for a, messages in (sent or {}).items():
        for m in messages:
            belief[a] = belief[a] * m if a in belief else m
    for a, b in reversed(edges):
        t = table[a, b]
        below = belief.get(b)
        up = t[:, np.maximum(observed[:, b], 0)].T
        hidden = observed[:, b] < 0
        if hidden.any():
            up = up.copy()
            up[hidden] = 1.0 if below is None else below[hidden] @ t.T
        belief[a] = up if a not in belief else belief[a] * up
    p = own * belief.get(0, np.ones((len(own), sizes[0])))
    return p / np.maximum(p.sum(1, keepdims=True), 1e-300)


def _near_target(edges: list[tuple[int, int]], group: int) -> list[tuple[int, int]]:
    """Edges that reach the target otherwise than through the group; as the group is known, the others tell nothing."""
    inside, out = {0}, []
    for a, b in edges:
        if b != group and a in inside:
            inside.add(b)
            out.append((a, b))
    return out


def impute(df: DataFrame, spec: Spec) -> DataFrame:
    """Filled values only: ``spec.key`` and ``filled_value`` of every record whose target is missing and whose group has
    at least one record with a value (group parts equal and none of them null or NaN).

    Missing: null, NaN or outside low…high. Records delivered more than once (equal in all the fields used) count once;
    records without key are left out. An empty table, or one without any value, gives an empty result. A group or a
    category's value may hold any share of the rows: its class counts are combined before the shuffle and its row is
    repeated for salted chunks of its records.
    """
    groups = [f"__g_{n}" for n in spec.group]
    y, sizes = _indexed(durable(_prepared(df, spec)), spec)
    y = durable(y)
    values, whole, size = np.array(_decoded(y, spec, sizes[0]), dtype=float), spec.whole, sizes[0]
    has_group = F.lit(True)
    for g in groups:
        has_group = has_group & F.col(g).isNotNull()
    numbers, categories = len(sizes), [f"__c_{c}" for c in spec.categorical]
    fields = [*[F.col(f"__i_{i}") for i in range(numbers)], *[F.when(F.col(c).isNotNull(), F.xxhash64(c)) for c in categories], F.when(has_group, F.xxhash64(*groups))]
    group, leaves = len(fields) - 1, frozenset(range(numbers, numbers + len(categories)))
    pairs = [(a, b) for a in range(len(fields)) for b in range(a + 1, len(fields)) if not {a, b} <= leaves and (a, b) != (0, group)]
    counted = durable(pair_counts(y, fields, pairs))
    edges = _near_target(spanning_tree(mutual_information(counted, pairs), len(fields), [(0, group)], leaves), group)
    inner = [e for e in edges if e[1] not in leaves]
    counts = {}
    for a, b in inner:  # at most sizes² numbers a pair
        counts[min(a, b), max(a, b)] = np.zeros((sizes[min(a, b)], sizes[max(a, b)]))
        for r in counted.filter(F.col("p") == pairs.index((min(a, b), max(a, b)))).collect():
            counts[min(a, b), max(a, b)][r["a"], r["b"]] = r["n"]
    known = y.filter(has_group)
    classes = known.groupBy(*groups, "__i_0").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("__target", [(i + 0.5) / PARTS for i in range(PARTS)], 2000).alias("m"))
    in_class = lambda c: F.map_from_entries(F.collect_list(F.when(F.col("__i_0").isNotNull(), F.struct("__i_0", c))))
    dense = lambda m, other: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(m, i), other))
    none = F.array_repeat(F.lit(float("nan")), PARTS)
    by_group = classes.groupBy(*groups).agg(in_class("n").alias("__own"), in_class("m").alias("__at"), F.sum("n").alias("__n")).filter(F.size("__own") > 0)
    by_group = durable(by_group.select(*groups, dense(F.col("__own"), F.lit(0).cast("long")).alias("__own"), F.flatten(dense(F.col("__at"), none)).alias("__at"), "__n"))
    x = salted_join(known.filter(F.col("__i_0").isNull()), by_group, groups, "__n", F.col("__key").cast("string"), "inner")
    sends = []
    for a, b in edges:
        if b in leaves:
            c, m = categories[b - numbers], f"__m_{b}"
            met = y.filter(F.col(c).isNotNull() & F.col(f"__i_{a}").isNotNull()).groupBy(c).agg(F.array(*[F.count_if(F.col(f"__i_{a}") == i).cast("double") for i in range(sizes[a])]).alias(m), F.count(F.lit(1)).alias("__n"))
            met = durable(met)
            sums = met.agg(F.count(F.lit(1)).alias("k"), *[F.sum(F.get(m, F.lit(i))).alias(f"s{i}") for i in range(sizes[a])]).first()
            sends.append((a, 0.5, np.array([(sums[f"s{i}"] or 0.0) for i in range(sizes[a])]) + 0.5 * sums["k"], m))
            x = salted_join(x, met, [c], "__n", F.col("__key").cast("string"), "left")

    @F.pandas_udf(T.DoubleType())
    def decode(own: pd.Series, at: pd.Series, indexes: pd.DataFrame, messages: pd.DataFrame) -> pd.Series:
        if not len(own):
            return pd.Series([], dtype=float)
        o, shift = np.array(own.tolist(), dtype=float), np.array(at.tolist(), dtype=float) - np.repeat(values, PARTS)
        f = np.concatenate([np.full((len(o), 1), -1), indexes.fillna(-1).to_numpy(dtype=int)[:, 1:]], axis=1)
        sent: dict[int, list[np.ndarray]] = {}
        for a, smooth, total, m in sends:
            seen = np.array([np.ones(len(total)) if v is None else (np.asarray(v, dtype=float) + smooth) / total for v in messages[m]])
            sent.setdefault(a, []).append(seen)
        p = posterior(o / o.sum(1, keepdims=True), f, inner, counts, sizes, sent=sent)
        if whole:  # classes of a category: the mode
            return pd.Series(values[p.argmax(1)])
        # Bins of a number: where the posterior's median lies, and the median of the group's values in that part of the bin.
        sums, rows = p.cumsum(1), np.arange(len(p))
        middle = 0.5 * sums[:, -1]
        best = (sums >= middle[:, None]).argmax(1)
        part = np.clip((PARTS * (middle - sums[rows, best] + p[rows, best]) / np.maximum(p[rows, best], 1e-300)).astype(int), 0, PARTS - 1)
        return pd.Series(values[best] + shift[rows, best * PARTS + part])

    struct = F.struct(*[F.col(f"__i_{i}") for i in range(numbers)])
    return x.select(F.col("__key").alias(spec.key), decode("__own", "__at", struct, F.struct(F.lit(0).alias("none"), *[F.col(m) for *_, m in sends])).alias("filled_value"))


def complete_table(df: DataFrame, spec: Spec) -> DataFrame:
    """The whole table, each record once, with ``<target>_filled`` (observed or filled value, null if neither) and ``was_filled``."""
    rows = df.filter(F.col(spec.key).isNotNull()).dropDuplicates([spec.key])
    own = F.when(usable(F.col(spec.target), spec.low, spec.high), F.col(spec.target).cast("double"))
    filled = impute(df, spec).withColumnRenamed("filled_value", "__filled")
    return rows.join(filled, spec.key, "left").withColumns({f"{spec.target}_filled": F.coalesce(own, F.col("__filled")), "was_filled": F.col("__filled").isNotNull()}).drop("__filled")


def clean_name(c: Column) -> Column:
    """Outer blanks and letter case aside."""
    return F.lower(F.trim(c))


def place(c: Column) -> Column:
    """A coordinate as a group part; NaN names no place."""
    return F.when(~F.isnan(c), c)


def redlist_spec() -> Spec:
    return Spec("record_id", {"species": F.col("species")}, "redlist", 1, 7, ("phylum", "tax_class", "tax_order", "family"), ("latitude",), whole=True, bins=8)


def agri_spec() -> Spec:
    return Spec("row_id", {"variable": F.col("variable_name"), "country": clean_name(F.col("country"))}, "agri_2000", 0, 100, ("variable_name",), ("agri_1998", "agri_1999", "agri_2001", "agri_2002"), bins=64)


def ndvi_spec() -> Spec:
    return Spec("row_id", {"lat": place(F.col("latitude")), "lon": place(F.col("longitude"))}, "ndvi", -0.2, 1.0, ("month_year", "country"), ("latitude",), bins=24)
