"""One evaluation of an expression that a larger one uses many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value`` as a lambda variable.

    Expressions inside lambdas are evaluated per element, so an array built there from the row would be
    built again for each of its elements; a bound variable holds it once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
