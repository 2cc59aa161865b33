"""Clean columns, flag rows, split them, profile nulls, drop sparse columns.

All functions but ``clean`` are lazy; ``clean`` runs one aggregate, because the columns it
keeps depend on the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, NumericType, StructField, StructType

from cleargrist.functions import (
    all_null,
    any_null,
    named,
    normalize_text,
    tolerant_double,
    tolerant_int,
)

CLEANED_SUFFIX = "_cleaned"
FLAG = "is_valid"
VALID, INVALID = "Y", "N"
LOAD_TIME = "ingestion_time"

TOTAL, VALID_COUNT = "total_rows", "valid_rows"
_VALUES = "values in "


@dataclass(frozen=True)
class CleaningRules:
    """Which columns to clean and how, which must have a value, and what to keep.

    ``required`` and ``output`` name raw columns; where a column is cleaned, the cleaned value
    is the one that counts. ``bad_lines`` names the column that holds the raw line of rows that did
    not fit the table (see ``ReadOptions``); such rows are invalid, and quarantined with their line.
    """

    text: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    output: tuple[str, ...] = ()
    bad_lines: str | None = None

    def is_cleaned(self, name: str) -> bool:
        return name in self.text or name in self.integers or name in self.doubles

    def result_name(self, name: str) -> str:
        """The name under which a raw column appears in the clean table."""
        return name + CLEANED_SUFFIX if self.is_cleaned(name) else name

    @property
    def output_names(self) -> list[str]:
        return [self.result_name(name) for name in self.output]

    def numeric_columns(self, schema: StructType) -> dict[str, Column]:
        """The cleaned numbers; a column of numbers, as after inference, is just cast.

        Dates, times and booleans are judged as the text they would be under a contract.
        """

        def number(name: str, parse: Callable[[Column], Column], kind: str) -> Column:
            if isinstance(schema[name].dataType, NumericType):
                return named(name).try_cast(kind)
            return parse(named(name).cast("string"))

        integers = {self.result_name(c): number(c, tolerant_int, "int") for c in self.integers}
        doubles = {self.result_name(c): number(c, tolerant_double, "double") for c in self.doubles}
        return integers | doubles

    def text_columns(self) -> dict[str, Column]:
        return {self.result_name(c): normalize_text(named(c).cast("string")) for c in self.text}

    @property
    def added_names(self) -> list[str]:
        """The names of the columns that cleaning adds."""
        return [self.result_name(c) for c in (*self.text, *self.integers, *self.doubles)] + [FLAG]

    def check(self, columns: Iterable[str]) -> None:
        """Raise ValueError if a raw column has the name of one that cleaning adds."""
        if taken := sorted(set(self.added_names) & set(columns)):
            raise ValueError(f"columns that cleaning would replace: {', '.join(taken)}")

    def null_probe(self, name: str) -> Column:
        """A column that is null exactly when the cleaned value is, at the least cost.

        Normalising text neither adds nor removes nulls, so the raw column serves: no regular
        expression runs for a null check, and the check can reach the scan.
        """
        return named(name if name in self.text else self.result_name(name))

    def null_probes(self) -> dict[str, Column]:
        return {self.result_name(name): self.null_probe(name) for name in self.output}


# How a materials table is cleaned.
MATERIALS_RULES = CleaningRules(
    text=("name", "description", "manufacturer_name", "competitor_name", "category"),
    integers=("id",),
    doubles=("unit_quantity", "requested_quantity", "requested_unit_price"),
    required=("id", "name", "category"),
    output=(
        "id",
        "name",
        "description",
        "long_description",
        "customer_part_id",
        "manufacturer_name",
        "manufacturer_part_id",
        "competitor_name",
        "competitor_part_name",
        "competitor_part_id",
        "category",
        "unit_of_measure",
        "unit_quantity",
        "requested_quantity",
        "requested_unit_price",
    ),
)


def flag_rows(df: DataFrame, rules: CleaningRules = MATERIALS_RULES) -> DataFrame:
    """Add the cleaned numbers and the ``is_valid`` flag, Y or N: all that tells rows apart.

    A row is invalid if a required value is missing. Without required columns, it is invalid
    if all its columns are null; with them, such a row is invalid already. A row with a bad line is
    invalid in any case.
    """
    rules.check(df.columns)
    if rules.required:
        invalid = any_null(map(rules.null_probe, rules.required))
    else:
        invalid = all_null([c for c in df.columns if c != rules.bad_lines])
    if rules.bad_lines:
        invalid = invalid | named(rules.bad_lines).isNotNull()
    flag = F.when(invalid, INVALID).otherwise(VALID)
    return df.withColumns(rules.numeric_columns(df.schema)).withColumn(FLAG, flag)


def tag(df: DataFrame, rules: CleaningRules = MATERIALS_RULES) -> DataFrame:
    """Add a ``*_cleaned`` column per cleaned column and the ``is_valid`` flag."""
    return flag_rows(df, rules).withColumns(rules.text_columns())


def quarantine_rows(tagged: DataFrame, rules: CleaningRules = MATERIALS_RULES) -> DataFrame:
    """The invalid rows with the flag and all columns but those that cleaning has added."""
    added = set(rules.added_names) - {FLAG}
    raw = [c for c in tagged.columns if c not in added]
    return tagged.filter(named(FLAG) == INVALID).select(*map(named, raw))


def valid_rows(tagged: DataFrame, rules: CleaningRules = MATERIALS_RULES) -> DataFrame:
    """The valid rows with their cleaned columns and the flag."""
    return tagged.filter(named(FLAG) == VALID).select(*map(named, rules.output_names), named(FLAG))


def profile_measures(values: Mapping[str, Column]) -> list[Column]:
    """Aggregates over flagged rows: all rows, valid rows, and the non-null values among those."""
    valid = named(FLAG) == VALID
    return [
        F.count(F.lit(1)).alias(TOTAL),
        F.count(F.when(valid, 1)).alias(VALID_COUNT),
        *(F.count(F.when(valid, value)).alias(_VALUES + name) for name, value in values.items()),
    ]


def profile(tagged: DataFrame, rules: CleaningRules = MATERIALS_RULES) -> DataFrame:
    """Row and value counts as one row, from one pass that shuffles one row per task."""
    return tagged.agg(*profile_measures(rules.null_probes()))


@dataclass(frozen=True)
class Profile:
    """A profile that a pass over the rows has brought to the driver: one number per column."""

    counts: Mapping[str, int]
    rules: CleaningRules = MATERIALS_RULES

    def frame(self, spark: SparkSession) -> DataFrame:
        """The same row as ``profile`` computes."""
        names = [TOTAL, VALID_COUNT, *(_VALUES + name for name in self.rules.output_names)]
        schema = StructType([StructField(name, LongType()) for name in names])
        return spark.createDataFrame([tuple(self.counts[name] for name in names)], schema)

    @property
    def ratios(self) -> dict[str, float] | None:
        """Null ratio per column of the valid rows; None if there are none."""
        rows = self.counts[VALID_COUNT]
        if rows == 0:
            return None
        values = {name: self.counts[_VALUES + name] for name in self.rules.output_names}
        return {name: (rows - n) / rows for name, n in values.items()} | {FLAG: 0.0}


def _ratios(rules: CleaningRules) -> dict[str, Column]:
    """Null ratio per column of the valid rows, over a profile; null if there are none.

    The flag is one of those columns, and never null.
    """
    values = {name: named(_VALUES + name) for name in rules.output_names}
    values[FLAG] = named(VALID_COUNT)
    rows = named(VALID_COUNT)
    return {c: F.try_divide((rows - n).cast("double"), rows) for c, n in values.items()}


def null_ratios(profiled: DataFrame, rules: CleaningRules = MATERIALS_RULES) -> DataFrame:
    """Turn a profile into one row with the null ratio of each column of the valid rows."""
    return profiled.select(*(ratio.alias(name) for name, ratio in _ratios(rules).items()))


def cleaning_summary(
    profiled: DataFrame,
    threshold: float,
    rules: CleaningRules = MATERIALS_RULES,
    include_metadata: bool = False,
    protect: Iterable[str] = (),
) -> DataFrame:
    """Turn a profile into one row: counts, threshold, columns removed and columns retained.

    Without valid rows there is no clean table, so no column is removed or retained.
    """
    protected = set(protect)

    def kept(name: str, ratio: Column) -> Column:
        some = named(VALID_COUNT) > 0
        return some if name in protected else some & (ratio < threshold)

    def names_where(conditions: Mapping[str, Column]) -> Column:
        return F.array_compact(F.array(*(F.when(c, name) for name, c in conditions.items())))

    keep = {name: kept(name, ratio) for name, ratio in _ratios(rules).items()}
    shown = {name: c for name, c in keep.items() if include_metadata or name != FLAG}
    return profiled.select(
        # The field names of a cleaning summary.
        named(TOTAL),
        named(VALID_COUNT),
        (named(TOTAL) - named(VALID_COUNT)).alias("invalid_rows"),
        F.lit(float(threshold)).alias("null_threshold"),
        names_where({name: ~c & (named(VALID_COUNT) > 0) for name, c in keep.items()}).alias(
            "columns_removed_due_to_nulls"
        ),
        names_where(shown).alias("columns_retained"),
    )


def drop_sparse(
    valid: DataFrame,
    ratios: Mapping[str, float],
    threshold: float,
    include_metadata: bool = False,
    protect: Iterable[str] = (),
) -> DataFrame:
    """Keep the columns whose null ratio is below the threshold, and the protected ones."""
    protected = set(protect)
    kept = [c for c in valid.columns if c in protected or ratios[c] < threshold]
    return valid.select(*(named(c) for c in kept if include_metadata or c != FLAG))


def stamp(df: DataFrame, at: datetime | Column | None = None) -> DataFrame:
    """Add the load time: the given moment, or the start time of each query that runs."""
    if at is None:
        at = F.current_timestamp()
    return df.withColumn(LOAD_TIME, (at if isinstance(at, Column) else F.lit(at)).cast("timestamp"))


def clean(
    tagged: DataFrame,
    threshold: float,
    rules: CleaningRules = MATERIALS_RULES,
    include_metadata: bool = False,
    protect: Iterable[str] = (),
    at: datetime | Column | None = None,
) -> DataFrame | None:
    """The valid rows without sparse columns, stamped; None if no row is valid."""
    ratios = Profile(profile(tagged, rules).first().asDict(), rules).ratios
    if ratios is None:
        return None
    kept = drop_sparse(valid_rows(tagged, rules), ratios, threshold, include_metadata, protect)
    return stamp(kept, at)
