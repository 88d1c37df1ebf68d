"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns``, which later filters and projections can't copy back to where they are used.

    The optimizer moves a filter below a projection by repeating the projected expression in it, and filters
    evaluate repeated parts again. For a costly expression (one large regular expression, say) that multiplies
    its cost. Columns made by a generator of one row stay where they are.
    """
    kept = [c for c in df.columns if c not in columns]
    made = F.inline(F.array(F.struct(*[e.alias(n) for n, e in columns.items()])))
    return df.select(*[F.col(f"`{c}`") for c in kept], made)
