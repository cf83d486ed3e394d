"""Local names inside Column expressions.

A Column used twice is copied twice into the plan, and nested uses multiply: the generated code of a
long text rule soon passes the JVM's method limit. A bound value is computed once and referred to by
a lambda variable, so expressions stay as long as they are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def let_both(first: Column, second: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body(first, second)`` with both values evaluated once."""
    pair = F.struct(first.alias("first"), second.alias("second"))
    return let(pair, lambda bound: body(bound["first"], bound["second"]))
