"""Name a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it.

    Inside the lambda the value is a variable. Writing the expression itself
    several times would compute it again each time, and once per element
    where it stands inside another lambda.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
