"""Naming a value within an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` evaluated once, however often body uses it (within a lambda it would be evaluated for each element)."""
    return F.element_at(F.transform(F.array(value), body), 1)
