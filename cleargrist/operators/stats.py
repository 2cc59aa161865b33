"""Grouped count, average, minimum and maximum."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrist.functions import named

# How the statistics of a materials table are grouped, and over what.
MATERIALS_KEYS = ("name_cleaned", "manufacturer_name_cleaned", "category_cleaned")
MATERIALS_VALUE = "requested_unit_price_cleaned"


# Up to here a double holds every whole number.
_WHOLE = 2**53
# Whole numbers are summed in three parts of 18 bits; none overflows below 2^45 rows of a group.
_LIMB = 18


@dataclass(frozen=True)
class _Sums:
    """What the average of a group needs, as aggregates of its rows or of parts of them."""

    high: Column
    middle: Column
    low: Column
    whole: Column
    values: Column
    total: Column

    def average(self, scale: int, floating: Column) -> Column:
        """Rounded half up; the floating-point average where some value is not such a decimal."""
        high, middle, low = (part.cast("decimal(19,0)") for part in (self.high, self.middle, self.low))
        step = F.lit(1 << _LIMB).cast("decimal(6,0)")
        total = (high * step + middle) * step + low
        rounded = F.call_function("div", F.abs(total) * 2 + self.whole, self.whole * 2)
        whole = F.signum(total) * rounded / F.lit(float(10**scale))
        complete = (self.whole > 0) & (self.whole == self.values)
        return F.when(complete, whole).otherwise(floating)


def _sums(value: Column, scale: int) -> _Sums:
    """Sums of whole numbers of the last decimal place, in three parts, however large they get.

    Values that are not a decimal of this scale only count among ``values`` and in ``total``.
    """
    unit = F.lit(float(10**scale))
    units = F.rint(value * unit)
    fits = F.when((units / unit == value) & (F.abs(units) <= float(_WHOLE)), units.cast("bigint"))
    mask = F.lit((1 << _LIMB) - 1).cast("bigint")
    return _Sums(
        F.sum(F.shiftright(fits, 2 * _LIMB)),
        F.sum(F.shiftright(fits, _LIMB).bitwiseAND(mask)),
        F.sum(fits.bitwiseAND(mask)),
        F.count(fits),
        F.count(value),
        F.sum(value.cast("double")),
    )


def price_stats(
    df: DataFrame,
    keys: Sequence[str] = MATERIALS_KEYS,
    value: str = MATERIALS_VALUE,
    exact: bool = False,
    scale: int = 2,
) -> DataFrame:
    """Rows, average, minimum and maximum per group, rounded half up to ``scale`` places.

    Every task sums its own rows up first, so one row per group and task is shuffled, however
    many rows a group has. A floating-point average depends on the order of the rows in its
    last bits, and so on a rounding tie; ``exact`` removes that for values of ``scale`` places up to
    2^53 units of the last one, beyond which a double has no such places. A group with any other
    value, NaN included, gets the floating-point average.
    """
    price = named(value)
    floating = F.round(F.avg(price), scale)
    average = _sums(price, scale).average(scale, floating) if exact else floating
    return df.groupBy(*map(named, keys)).agg(
        F.count(F.lit(1)).alias("item_count"),
        average.alias("avg_price"),
        F.round(F.min(price), scale).alias("min_price"),
        F.round(F.max(price), scale).alias("max_price"),
    )


#: The column that holds what ``group_states`` knows of a group.
STATE = "group_state"
_PARTS = ("high", "middle", "low", "whole", "values", "total")


def group_states(
    df: DataFrame,
    keys: Sequence[str] = MATERIALS_KEYS,
    value: str = MATERIALS_VALUE,
    scale: int = 2,
) -> DataFrame:
    """Per group, all that its statistics need, in a form that can be merged with other rows' states.

    The keys and one struct column; as many rows as groups, whatever the number of rows.
    """
    if STATE in keys:
        raise ValueError(f"a key cannot be named {STATE}")
    price = named(value)
    sums = _sums(price, scale)
    return df.groupBy(*map(named, keys)).agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            *(getattr(sums, part).alias(part) for part in _PARTS),
            F.min(price).alias("least"),
            F.max(price).alias("most"),
        ).alias(STATE)
    )


def merge_states(states: DataFrame, keys: Sequence[str] = MATERIALS_KEYS) -> DataFrame:
    """One state for each group, from a table that may hold several: those of all its rows together."""
    part = {c: named(STATE).getField(c) for c in ("rows", *_PARTS, "least", "most")}
    merged = {c: F.sum(column) for c, column in part.items()}
    merged |= {"least": F.min(part["least"]), "most": F.max(part["most"])}
    state = F.struct(*(column.alias(c) for c, column in merged.items()))
    return states.groupBy(*map(named, keys)).agg(state.alias(STATE))


def stats_of_states(
    states: DataFrame, keys: Sequence[str] = MATERIALS_KEYS, exact: bool = False, scale: int = 2
) -> DataFrame:
    """The statistics of ``price_stats`` over all rows that the states stand for."""
    part = {c: named(STATE).getField(c) for c in ("rows", *_PARTS, "least", "most")}
    floating = F.round(F.try_divide(part["total"], part["values"]), scale)
    average = _Sums(*(part[c] for c in _PARTS)).average(scale, floating) if exact else floating
    return states.select(
        *map(named, keys),
        part["rows"].alias("item_count"),
        average.alias("avg_price"),
        F.round(part["least"], scale).alias("min_price"),
        F.round(part["most"], scale).alias("max_price"),
    )
