"""Null predicates over several columns. Neither ever evaluates to NULL."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cleargrist.functions.columns import named


def all_null(columns: Iterable[Column | str]) -> Column:
    """True when every column is null; true for no columns."""
    return reduce(operator.and_, (named(c).isNull() for c in columns), F.lit(True))


def any_null(columns: Iterable[Column | str]) -> Column:
    """True when at least one column is null; false for no columns."""
    return reduce(operator.or_, (named(c).isNull() for c in columns), F.lit(False))
