"""Name a value once and use it many times inside one Column.

A Column is a tree: using it five times copies it five times. ``let`` evaluates its inputs
once per row and hands them to the body as lambda variables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(body: Callable[[Column], Column], **values: Column) -> Column:
    bound = F.array(F.struct(*(v.alias(k) for k, v in values.items())))
    return F.transform(bound, body)[0]
