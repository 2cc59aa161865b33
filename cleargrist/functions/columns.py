"""Column lookup by literal name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(column: Column | str) -> Column:
    """Return the column with exactly this name, dots and backticks included."""
    if isinstance(column, Column):
        return column
    return F.col("`" + column.replace("`", "``") + "`")
