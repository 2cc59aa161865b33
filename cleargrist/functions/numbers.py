"""String-to-number conversion that yields NULL on bad input, whatever the ANSI setting.

``try_cast`` on text that does not parse builds and discards an exception for every row, some
8 microseconds each. Both functions therefore test the shape of the text first, so that only
text that very likely parses reaches the cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cleargrist.functions.columns import named

# ``$`` would also match before a line end at the end of the text, ``\z`` does not.
# Spark ignores these characters around a number: ASCII control characters and the space.
_PAD = r"[\x00-\x20\x7f]*"
_WHOLE_PART = rf"^{_PAD}[+-]?[0-9]+(?:\.[0-9]*)?{_PAD}\z"
_FRACTION_ONLY = rf"^{_PAD}[+-]?\.[0-9]*{_PAD}\z"
# Every text that casts to double begins this way; not every such text casts.
_DOUBLE_START = rf"^{_PAD}[+-]?(?:\.?[0-9]|(?i:inf|nan))"


def tolerant_int(column: Column | str) -> Column:
    """Parse text as int the way a non-ANSI cast does.

    A fraction is cut off (``12.9`` is 12, ``.5`` is 0); exponents, other text and values out
    of the 32-bit range give NULL. ``try_cast`` alone would reject every fraction.
    """
    text = named(column)
    whole_part = F.substring_index(text, ".", 1)
    return F.when(text.rlike(_WHOLE_PART), whole_part.try_cast("int")).when(
        text.rlike(_FRACTION_ONLY), F.lit(0)
    )


def tolerant_double(column: Column | str) -> Column:
    """Parse text as double; text that is not a number gives NULL, ``NaN`` stays a value."""
    text = named(column)
    return F.when(text.rlike(_DOUBLE_START), text.try_cast("double"))
