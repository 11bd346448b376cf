"""Evaluate an expression once and use its value inside a lambda."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(body: Callable[..., Column], **values: Column) -> Column:
    """``body`` applied to the values by name.

    A lambda of a higher-order function evaluates whatever expression it refers to for each element;
    a bound value is computed once per row.
    """
    holder = F.array(F.struct(*[value.alias(name) for name, value in values.items()]))
    return F.transform(holder, lambda bound: body(**{name: bound[name] for name in values}))[0]
