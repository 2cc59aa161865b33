"""One entry point for CSV, JSON, Parquet and ORC tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from cleargrist.formats import checked_format
from cleargrist.functions import named
from cleargrist.operators.observed import PATIENCE, observed_metrics
from cleargrist.sinks.writers import write_table
from cleargrist.sources.contract import SchemaReport, compare_schema

# Spark's CSV reader drops NUL characters from quoted fields, unless ``extra`` holds this.
KEEP_NUL = {"charToEscapeQuoteEscaping": '"'}


@dataclass(frozen=True)
class ReadOptions:
    """How to read a table.

    ``multiline`` lets quoted CSV fields hold line breaks, but Spark then cannot split a file,
    so the read has one task per file: keep it off unless fields need it, and store such input
    as many files. ``infer`` costs one more pass over CSV data and ignores the contract.
    ``coerce`` casts typed columns to the contract instead of refusing them. ``check=False``
    reads without a gate; CSV columns are still matched by header name, those that a file lacks come
    as null, and only a file without a header goes by position. For JSON it saves the pass
    that finds its field names, and accepts files that leave out null fields. ``spread``
    redistributes the rows of files that Spark cannot split, at the price of a shuffle, so
    that only the reading itself is bound to one task per file. ``extra`` goes to Spark's
    reader as is.

    ``bad_lines`` names a column for the raw text of each line that does not fit: a CSV row with more
    or fewer fields than the table has columns, or with a value that is not of its column's type,
    and a JSON record that does not parse. It is null for all other rows. Without it surplus fields
    are lost, missing ones are null, and a JSON record that does not parse is a row of nulls. With it
    every field of a CSV file is parsed, also those that no one asks for.
    """

    fmt: str = "csv"
    header: bool = True
    delimiter: str = ","
    quote: str = '"'
    escape: str = '"'
    multiline: bool = False
    infer: bool = False
    check: bool = True
    coerce: bool = True
    spread: bool = False
    bad_lines: str | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str | bool]:
        fmt = checked_format(self.fmt)
        options: dict[str, str | bool] = {}
        if fmt == "csv":
            options = {
                "header": self.header,
                "sep": self.delimiter,
                "quote": self.quote,
                "escape": self.escape,
            }
        if fmt in ("csv", "json"):
            options["multiLine"] = self.multiline
            if self.bad_lines:
                options["mode"] = "PERMISSIVE"
                options["columnNameOfCorruptRecord"] = self.bad_lines
                # A pruned row has as many fields as are asked for, however many the line has.
                options["columnPruning"] = False
        elif self.bad_lines:
            raise ValueError(f"bad lines are a matter of CSV and JSON, not of {fmt}")
        return {**options, **self.extra}

    def with_bad_lines(self, schema: StructType) -> StructType:
        """The schema to read with."""
        if not self.bad_lines:
            return schema
        if self.bad_lines in schema.names:
            raise ValueError(f"the table has a column {self.bad_lines!r} of its own")
        return StructType([*schema.fields, StructField(self.bad_lines, StringType())])

    def bad_line(self, columns: Sequence[str]) -> list[Column]:
        """The column of bad lines, if asked for, beside others of the table.

        Spark refuses to read it alone, so it is tied to another column.
        """
        if not self.bad_lines:
            return []
        first = named(columns[0])
        tied = F.when(first.isNull() | first.isNotNull(), named(self.bad_lines))
        return [tied.alias(self.bad_lines)]


def preview_schema(
    spark: SparkSession, path: str | Sequence[str], options: ReadOptions = ReadOptions()
) -> StructType:
    """Return the schema the files themselves show.

    CSV reads the first header line, Parquet and ORC a footer, JSON every record.
    """
    reader = spark.read.format(options.fmt).options(**options.reader_options())
    return reader.load(path).schema


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    contract: StructType | None = None,
    options: ReadOptions = ReadOptions(),
    report_path: str | None = None,
) -> DataFrame:
    """Read files as one DataFrame, under a contract if one is given.

    The gate compares the files' own columns with the contract and raises ContractError before
    any data is read. Under a contract, CSV columns are matched to it by header name, so a
    file with its columns in another order reads right, and Spark checks the header of each
    file against the first one's. A CSV without a header is read by position, and its number of
    columns must be the contract's. Typed columns are cast to the contract; a value that does not
    fit becomes null, with ANSI mode on or off. The gate's report is added to the JSON table at
    ``report_path``, passed or not. For JSON the gate takes a pass over all records to find
    their field names, so a large source is read twice unless ``check`` is off; ``read_watched``
    finds them on the way. A column of bad lines, if asked for, comes last.
    """
    fmt = checked_format(options.fmt)
    reader = spark.read.format(fmt).options(**options.reader_options())

    def load(schema: StructType) -> DataFrame:
        return reader.schema(options.with_bad_lines(schema)).load(path)

    if options.infer or contract is None:
        if fmt == "csv" and options.infer:
            reader = reader.option("inferSchema", True)
        table = reader.load(path)
        if options.bad_lines:
            own = [f for f in table.schema.fields if fmt == "csv" or f.name != options.bad_lines]
            table = load(StructType(own)).select(*(named(f.name) for f in own), *options.bad_line([own[0].name]))
    elif fmt == "csv" and options.header:
        found = preview_schema(spark, path, options)
        if options.check:
            _judge(spark, found, contract, options, report_path)
        known = set(contract.names)
        in_file_order = StructType([contract[n] if n in known else found[n] for n in found.names])
        reader = reader.option("enforceSchema", False)
        table = load(in_file_order).select(
            *(
                named(f.name) if f.name in found.names else F.lit(None).cast(f.dataType).alias(f.name)
                for f in contract.fields
            ),
            *options.bad_line(found.names),
        )
    elif fmt == "csv" and options.check:
        found = _by_position(preview_schema(spark, path, options), contract)
        _judge(spark, found, contract, options, report_path)
        table = load(contract).select(*map(named, contract.names), *options.bad_line(contract.names))
    elif fmt == "csv" or not options.check:
        table = load(contract).select(*map(named, contract.names), *options.bad_line(contract.names))
    else:
        table = reader.load(path)
        seen = StructType([f for f in table.schema.fields if f.name != options.bad_lines])
        _judge(spark, seen, contract, options, report_path)
        if fmt == "json":
            table = load(contract)
        table = table.select(
            *(named(f.name).try_cast(f.dataType).alias(f.name) for f in contract.fields),
            *options.bad_line(contract.names),
        )
    return table.hint("rebalance") if options.spread else table


def _judge(
    spark: SparkSession,
    found: StructType,
    contract: StructType,
    options: ReadOptions,
    report_path: str | None,
) -> None:
    report = compare_schema(found, contract)
    if report_path is not None:
        write_table(report.document_frame(spark), report_path, "json", "append")
    report.require(allow_type_changes=options.coerce)


@dataclass(frozen=True)
class Watched:
    """A table whose gate may have to wait until its rows have been read once.

    ``rows`` are for one query. When it has ended, ``judge`` raises ContractError if the table is to be
    refused, and tells whether ``rows`` were those of the table to the letter; if not, the query is to
    be run again. ``again`` are the table's rows for that and all later queries. Where the gate
    could decide beforehand, ``waits`` is false, and ``judge`` is content.
    """

    rows: DataFrame
    again: DataFrame
    judge: Callable[[], bool]
    waits: bool


def read_watched(
    spark: SparkSession,
    path: str | Sequence[str],
    contract: StructType | None = None,
    options: ReadOptions = ReadOptions(),
    report_path: str | None = None,
    patience: float = PATIENCE,
) -> Watched:
    """Read a table as ``read_table`` does, but without a pass over JSON records for the gate.

    The field names of JSON records, and their types, are gathered as the first query reads the
    records. What that query writes must not be used before ``judge`` has been asked. Numbers and
    nested values that a contract wants as text come out in another notation on this way, as
    do lists of records; then ``judge`` asks for the query again, and nothing is gained. JSON values over
    several lines or in a given encoding, and bad lines of a contract with types other than
    text, are read as by ``read_table``. If the names do not arrive within ``patience`` seconds
    after the query, another pass finds them, with a warning.
    """
    fmt = checked_format(options.fmt)
    own = {name.lower() for name in options.extra}
    lines = fmt == "json" and not options.multiline and not own & {"encoding", "charset"}
    if options.bad_lines and contract is not None:
        lines = lines and all(isinstance(f.dataType, StringType) for f in contract.fields)
    if not lines or contract is None or options.infer or not options.check:
        table = read_table(spark, path, contract, options, report_path)
        return Watched(table, table, lambda: True, False)
    again = read_table(spark, path, contract, replace(options, check=False))
    text = spark.read.options(**options.extra).text(path)
    raw = named("value")
    # As Spark's JSON source does: lines of white space are no rows, and null is a row of nulls.
    blank, null = raw.rlike(r"^[ \t\r\n]*\z"), raw.rlike(r"^[ \t\r\n]*null[ \t\r\n]*\z")
    listed = raw.rlike(r"^[ \t\r\n]*\[")
    value = F.when(raw.rlike(r"^[ \t\r\n]*\{"), F.try_parse_json(raw))
    measures = [
        F.schema_of_variant_agg(value).alias("records"),
        F.count(F.when(listed, 1)).alias("lists"),
        F.count(F.when(value.isNull() & ~blank & ~null & ~listed, 1)).alias("broken"),
    ]
    watch = Observation()
    parse = {k: str(v) for k, v in options.reader_options().items()}
    record = F.from_json(raw, options.with_bad_lines(contract), parse)
    rows = text.observe(watch, *measures).filter(~blank)
    rows = rows.select(record.alias("record")).select(
        *(named("record").getField(name).alias(name) for name in again.columns)
    )

    def measured() -> Row:
        return text.agg(*measures).first()

    def judge() -> bool:
        seen = observed_metrics(watch, measured, patience)
        found = None if seen["lists"] else _fields_of(seen["records"])
        if found is None:
            found = preview_schema(spark, path, options)
        elif seen["broken"]:  # as inference says it
            name = options.bad_lines or spark.conf.get("spark.sql.columnNameOfCorruptRecord")
            found = StructType([*found.fields, StructField(name, StringType())])
        found = StructType([f for f in found.fields if f.name != options.bad_lines])
        inferred = StructType([StructField(f.name, _as_inferred(f.dataType)) for f in found.fields])
        _judge(spark, inferred, contract, options, report_path)
        texts = {f.name for f in contract.fields if isinstance(f.dataType, StringType)}
        plain = all(isinstance(f.dataType, _AS_WRITTEN) for f in found.fields if f.name in texts)
        return plain and not seen["lists"]

    return Watched(rows.hint("rebalance") if options.spread else rows, again, judge, True)


# JSON values of these types have one notation only.
_AS_WRITTEN = (StringType, BooleanType, NullType)


def _fields_of(records: str) -> StructType | None:
    """The fields of JSON records, or None where the aggregate cannot tell."""
    kind = _json_type(records)
    if isinstance(kind, NullType):  # no record at all
        return StructType([])
    return kind if isinstance(kind, StructType) else None


def _json_type(text: str) -> DataType:
    """The type that ``schema_of_variant_agg`` has written."""
    outside = re.sub(r"(`(?:[^`]|``)*`)|OBJECT<", lambda m: m[1] or "STRUCT<", text)
    return StructType.fromDDL(f"t {outside}")[0].dataType


def _as_inferred(kind: DataType) -> DataType:
    """The type that Spark's JSON source would infer."""
    if isinstance(kind, DecimalType):
        return DoubleType()
    if isinstance(kind, NullType | VariantType):
        return StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(_as_inferred(kind.elementType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _as_inferred(f.dataType)) for f in kind.fields])
    return kind


def _by_position(found: StructType, contract: StructType) -> StructType:
    """The columns of a file without a header, under the names that their places give them."""
    places = [*contract.fields, *found.fields[len(contract) :]]
    return StructType(places[: len(found)])


def contract_report(
    spark: SparkSession,
    path: str | Sequence[str],
    contract: StructType,
    options: ReadOptions = ReadOptions(),
) -> SchemaReport:
    """Compare the files' own columns with the contract without reading the table."""
    found = preview_schema(spark, path, options)
    if checked_format(options.fmt) == "csv" and not options.header:
        found = _by_position(found, contract)
    return compare_schema(found, contract)
