"""Schema contract: the expected columns, the comparison with a table, the refusal."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    DataType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The columns of a materials table, in file order. All are nullable text.
MATERIALS_COLUMNS = (
    "Unnamed: 0",
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
)

MATERIALS_CONTRACT = StructType([StructField(name, StringType()) for name in MATERIALS_COLUMNS])

MISSING = "missing_column"
TYPE_MISMATCH = "type_mismatch"
UNEXPECTED = "unexpected_column"

# The fields of a report.
_ISSUE_SCHEMA = "kind string, column string, expected string, actual string"
_TEXT_LIST = ArrayType(StringType())
_MISMATCH = StructType([StructField(name, StringType()) for name in ("column", "expected", "actual")])
_DOCUMENT_SCHEMA = StructType(
    [
        StructField("status", StringType()),
        StructField("errors", _TEXT_LIST),
        StructField("missing_columns", _TEXT_LIST),
        StructField("type_mismatches", ArrayType(_MISMATCH)),
        StructField("unexpected_columns", _TEXT_LIST),
        StructField("actual_schema", StringType()),
        StructField("expected_schema", StringType()),
        StructField("checked_at", TimestampType()),
    ]
)


class ContractError(ValueError):
    """A table was refused because its columns do not meet the contract."""

    def __init__(self, report: SchemaReport):
        self.report = report
        super().__init__("schema contract not met: " + "; ".join(report.errors))


@dataclass(frozen=True)
class SchemaIssue:
    kind: str
    column: str
    expected: str | None = None
    actual: str | None = None

    def __str__(self) -> str:
        text = f"{self.kind.replace('_', ' ')} '{self.column}'"
        if self.kind == TYPE_MISMATCH:
            text += f" (expected {self.expected}, got {self.actual})"
        return text


@dataclass(frozen=True)
class SchemaReport:
    """The differences between an actual and an expected schema."""

    actual: StructType
    expected: StructType
    issues: tuple[SchemaIssue, ...]
    checked_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    @property
    def passed(self) -> bool:
        return not self.issues

    @property
    def errors(self) -> list[str]:
        return [str(issue) for issue in self.issues]

    def columns(self, kind: str) -> list[str]:
        return [issue.column for issue in self.issues if issue.kind == kind]

    def require(self, allow_type_changes: bool = False) -> None:
        """Raise ContractError on any issue; type mismatches may be let through."""
        tolerated = {TYPE_MISMATCH} if allow_type_changes else set()
        if any(issue.kind not in tolerated for issue in self.issues):
            raise ContractError(self)

    def issues_frame(self, spark: SparkSession) -> DataFrame:
        """One row per issue."""
        rows = [(i.kind, i.column, i.expected, i.actual) for i in self.issues]
        return spark.createDataFrame(rows, _ISSUE_SCHEMA)

    def document_frame(self, spark: SparkSession) -> DataFrame:
        """One row holding the whole report, for any sink."""
        row = (
            "PASSED" if self.passed else "FAILED",
            self.errors,
            self.columns(MISSING),
            [(i.column, i.expected, i.actual) for i in self.issues if i.kind == TYPE_MISMATCH],
            self.columns(UNEXPECTED),
            json.dumps(self.actual.jsonValue()),
            json.dumps(self.expected.jsonValue()),
            self.checked_at,
        )
        return spark.createDataFrame([row], _DOCUMENT_SCHEMA)


def compare_schema(actual: StructType, expected: StructType) -> SchemaReport:
    """Compare two schemas by column name and type; nullability and order do not count."""

    def types(schema: StructType) -> dict[str, DataType]:
        return {f.name: f.dataType for f in schema.fields}

    have, want = types(actual), types(expected)
    issues = [SchemaIssue(MISSING, n, t.simpleString()) for n, t in want.items() if n not in have]
    issues += [
        SchemaIssue(TYPE_MISMATCH, n, t.simpleString(), have[n].simpleString())
        for n, t in want.items()
        if n in have and have[n] != t
    ]
    issues += [
        SchemaIssue(UNEXPECTED, n, actual=t.simpleString())
        for n, t in have.items()
        if n not in want
    ]
    return SchemaReport(actual, expected, tuple(issues))
