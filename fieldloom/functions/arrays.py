"""Arrays as vectors: lengths, padding, normalising."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fieldloom.functions.let import let


def fit_length(vector: Column, n: int) -> Column:
    """Cut or padded with zeros to ``n`` values; null stays null."""
    return F.concat(F.slice(vector, 1, n), F.array_repeat(F.lit(0.0), F.greatest(F.lit(n) - F.size(vector), F.lit(0))))


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double"))


def peak_normalised(wave: Column) -> Column:
    """Centred on the mean, then over the largest absolute value; a constant wave is all 0."""
    centred = let(total(wave) / F.size(wave), lambda mean: F.transform(wave, lambda x: x - mean))
    return let(centred, lambda c: let(F.array_max(F.transform(c, lambda x: F.abs(x))), lambda peak: F.transform(c, lambda x: F.when(peak > 0, x / peak).otherwise(0.0))))


def mono(channels: Column) -> Column:
    """Mean of equally long channels."""
    return F.transform(F.element_at(channels, 1), lambda _, i: F.aggregate(channels, F.lit(0.0), lambda a, c: a + F.get(c, i)) / F.size(channels))


def histogram(values: Column, bins: int, low: float, high: float) -> Column:
    """Counts of ``bins`` equal bins from low to high, the last one closed; values outside don't count."""
    width = (high - low) / bins
    place = F.transform(F.filter(values, lambda x: (x >= low) & (x <= high)), lambda x: F.least(F.floor((x - low) / width).cast("int"), F.lit(bins - 1)))
    return let(place, lambda p: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.size(F.filter(p, lambda x: x == b))))
