"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cleargrist.functions.columns import named


def normalize_text(column: Column | str) -> Column:
    """Title-case space-separated words, collapse whitespace runs, strip outer spaces.

    Title-casing runs first and splits on the space only, so a word after a tab or a line
    break stays lower-case. NULL stays NULL and nothing else becomes NULL: the result is
    null exactly when the input is, which lets null checks read the raw column instead.
    """
    titled = F.initcap(named(column))
    return F.trim(F.regexp_replace(titled, r"\s+", " "))
