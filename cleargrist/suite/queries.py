"""One query per operator. Each takes a session and the folder of the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from cleargrist.functions import all_null, named, normalize_text, tolerant_double, tolerant_int
from cleargrist.operators.quality import (
    FLAG,
    clean,
    cleaning_summary,
    flag_rows,
    null_ratios,
    profile,
    quarantine_rows,
    stamp,
    tag,
    valid_rows,
)
from cleargrist.operators.reuse import checkpoint, input_fingerprint, materialize
from cleargrist.operators.stats import price_stats
from cleargrist.plans.curate import (
    CurationOptions,
    curate,
    current_release,
    stage,
    write_quarantine,
)
from cleargrist.sinks.writers import partitioned_schema, restore_keys, write_table
from cleargrist.sources.contract import MATERIALS_CONTRACT, ContractError
from cleargrist.sources.tables import ReadOptions, contract_report, read_table
from cleargrist.suite.inputs import (
    ORDER_LINE_CONTRACT,
    ORDER_LINE_RULES,
    dirty_materials,
    dirty_order_lines,
    ragged_lines,
    stored,
    table,
)
from cleargrist.workspace import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

THRESHOLD = 0.9
LOADED_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


# Sources


@query("csv_contract_scan")
def csv_contract_scan(spark, sf_dir):
    path = stored(dirty_materials(spark, sf_dir), "csv", "contract-scan")
    return read_table(spark, path, MATERIALS_CONTRACT)


@query("csv_reordered_scan")
def csv_reordered_scan(spark, sf_dir):
    """Columns in another order than the contract's are matched to it by name."""
    source = dirty_materials(spark, sf_dir)
    path = stored(source.select(*map(named, reversed(source.columns))), "csv", "reordered")
    return read_table(spark, path, MATERIALS_CONTRACT)


@query("csv_dialect_scan")
def csv_dialect_scan(spark, sf_dir):
    """Quotes, delimiters and line breaks inside fields, another delimiter, no header."""
    documents = table(spark, sf_dir, "documents").select(
        named("doc_id").cast("string").alias("doc_id"),
        F.concat(F.lit('|"'), "source", F.lit('", ')).alias("source"),
        "text",
    )
    path = scratch_path(spark, "dialect")
    written = {"sep": "|", "quote": "'", "escape": "'", "header": "false"}
    write_table(documents, path, "csv", options=written)
    dialect = ReadOptions(header=False, delimiter="|", quote="'", escape="'", multiline=True)
    contract = StructType([StructField(c, StringType()) for c in documents.columns])
    return read_table(spark, path, contract, dialect)


@query("csv_infer_scan")
def csv_infer_scan(spark, sf_dir):
    path = stored(dirty_materials(spark, sf_dir), "csv", "infer")
    return read_table(spark, path, options=ReadOptions(infer=True))


@query("typed_contract_scan")
def typed_contract_scan(spark, sf_dir):
    """A Parquet table with typed columns, cast to an all-text contract."""
    names = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    contract = StructType([StructField(c, StringType()) for c in names])
    return read_table(spark, f"{sf_dir}/customer.parquet", contract, ReadOptions(fmt="parquet"))


@query("schema_report")
def report_of_changed_table(spark, sf_dir):
    """A table that lacks a column, has another one, and has one of another type."""
    source = dirty_materials(spark, sf_dir)
    changed = source.drop("category").withColumns(
        {"id": tolerant_int("id"), "colour": F.lit("red")}
    )
    path = stored(changed, "parquet", "report")
    report = contract_report(spark, path, MATERIALS_CONTRACT, ReadOptions(fmt="parquet"))
    return report.issues_frame(spark)


@query("headerless_csv_scan")
def headerless_csv_scan(spark, sf_dir):
    """A CSV without a header: its number of columns must be the contract's."""
    path = scratch_path(spark, "headerless")
    write_table(dirty_materials(spark, sf_dir), path, "csv", options={"header": "false"})
    return read_table(spark, path, MATERIALS_CONTRACT, ReadOptions(header=False))


@query("csv_by_name_scan")
def csv_by_name_scan(spark, sf_dir):
    """Read unchecked, a CSV that lacks a column and has another one: the rest goes by name."""
    source = dirty_materials(spark, sf_dir).drop("long_description")
    path = stored(source.withColumn("colour", F.lit("red")).select("colour", *source.columns), "csv", "by-name")
    return read_table(spark, path, MATERIALS_CONTRACT, ReadOptions(check=False))


RAGGED = ReadOptions(header=False, check=False, bad_lines="raw_line")


def _ragged(spark, sf_dir) -> str:
    path = scratch_path(spark, "ragged")
    ragged_lines(spark, sf_dir).write.text(path)
    return path


@query("csv_bad_lines_scan")
def csv_bad_lines_scan(spark, sf_dir):
    """Rows with too many or too few fields keep their raw line."""
    return read_table(spark, _ragged(spark, sf_dir), MATERIALS_CONTRACT, RAGGED)


# A contract that the orders table breaks in each of the three ways.
_ORDERS_CONTRACT = StructType(
    [
        StructField("o_orderkey", StringType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
        StructField("o_colour", StringType()),
    ]
)


def _orders_report(spark, sf_dir):
    path = f"{sf_dir}/orders.parquet"
    return contract_report(spark, path, _ORDERS_CONTRACT, ReadOptions(fmt="parquet"))


@query("schema_report_orders")
def schema_report_orders(spark, sf_dir):
    """The issues of a given table."""
    return _orders_report(spark, sf_dir).issues_frame(spark)


@query("schema_report_document")
def schema_report_document(spark, sf_dir):
    """The whole report as one row, and how many rows of the table it is about."""
    document = _orders_report(spark, sf_dir).document_frame(spark)
    n = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n_rows"))
    mismatches = F.transform("type_mismatches", lambda m: F.concat_ws(":", m["column"], m["expected"], m["actual"]))
    return document.crossJoin(F.broadcast(n)).select(
        "status",
        F.array_join("missing_columns", ",").alias("missing_columns"),
        F.array_join(mismatches, ",").alias("type_mismatches"),
        F.array_join(F.array_sort("unexpected_columns"), ",").alias("unexpected_columns"),
        F.size("errors").alias("n_errors"),
        "n_rows",
    )


@query("contract_gate_refusal")
def contract_gate_refusal(spark, sf_dir):
    """A table that is refused before its rows are read: why, and that the report says so."""
    source = dirty_materials(spark, sf_dir).drop("category").withColumn("colour", F.lit("red"))
    path = stored(source, "csv", "refused")
    report_path = scratch_path(spark, "refused-report")
    try:
        read_table(spark, path, MATERIALS_CONTRACT, report_path=report_path)
    except ContractError as error:
        issues = error.report.issues_frame(spark)
    status = spark.read.json(report_path).first()["status"]
    return issues.select("kind", "column", F.lit(status).alias("status"), F.lit(source.count()).alias("n_rows"))


@query("unknown_format_refusal")
def unknown_format_refusal(spark, sf_dir):
    """A format that is none, refused by the writer and the reader before they do anything."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    path = scratch_path(spark, "unknown")
    refused = 0
    for attempt in (
        lambda: write_table(suppliers, path, "xlsx"),
        lambda: read_table(spark, path, options=ReadOptions(fmt="xlsx")),
    ):
        try:
            attempt()
        except ValueError:
            refused += 1
    write_table(suppliers, path, mode="errorifexists")  # nothing is there
    return spark.read.parquet(path).withColumn("refused", F.lit(refused))


# Expressions


@query("text_normalize")
def text_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", normalize_text("text").alias("text_cleaned"))


@query("text_normalize_turns")
def text_normalize_turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", normalize_text("text").alias("text_cleaned")
    )


@query("text_normalize_pages")
def text_normalize_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", normalize_text("html").alias("html_cleaned"))


@query("text_normalize_columns")
def text_normalize_columns(spark, sf_dir):
    tagged = tag(dirty_materials(spark, sf_dir))
    return tagged.select(
        "manufacturer_part_id",
        "name_cleaned",
        "description_cleaned",
        "manufacturer_name_cleaned",
        "competitor_name_cleaned",
        "category_cleaned",
    )


@query("tolerant_int")
def tolerant_int_values(spark, sf_dir):
    quantity = named("l_quantity").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", tolerant_int(quantity).alias("quantity")
    )


@query("tolerant_int_ids")
def tolerant_int_ids(spark, sf_dir):
    return dirty_materials(spark, sf_dir).select("id", tolerant_int("id").alias("id_cleaned"))


@query("tolerant_double")
def tolerant_double_values(spark, sf_dir):
    """Numbers written as text, and text that is no number."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        tolerant_double(named("value").cast("string")).alias("value"),
        tolerant_double("event_type").alias("event_type"),
        tolerant_double("props").alias("props"),
    )


@query("tolerant_double_documents")
def tolerant_double_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tolerant_double("text").alias("number"))


# Row quality


@query("validity_flag")
def validity_flag(spark, sf_dir):
    return tag(dirty_materials(spark, sf_dir)).select("manufacturer_part_id", FLAG)


@query("all_null_rows")
def all_null_rows(spark, sf_dir):
    source = dirty_materials(spark, sf_dir)
    return source.filter(all_null(["long_description", "competitor_name"]))


@query("quarantine_rows")
def quarantine(spark, sf_dir):
    return quarantine_rows(tag(dirty_materials(spark, sf_dir)))


@query("valid_rows")
def valid(spark, sf_dir):
    return valid_rows(tag(dirty_materials(spark, sf_dir)))


@query("null_ratios")
def null_ratio_profile(spark, sf_dir):
    return null_ratios(profile(tag(dirty_materials(spark, sf_dir))))


@query("drop_sparse_columns")
def drop_sparse_columns(spark, sf_dir):
    return clean(tag(dirty_materials(spark, sf_dir)), THRESHOLD).drop("ingestion_time")


@query("clean_with_metadata")
def clean_with_metadata(spark, sf_dir):
    kept = clean(tag(dirty_materials(spark, sf_dir)), THRESHOLD, include_metadata=True)
    return kept.drop("ingestion_time")


@query("ingestion_stamp")
def ingestion_stamp(spark, sf_dir):
    rows = valid_rows(tag(dirty_materials(spark, sf_dir))).select("id_cleaned", "name_cleaned")
    return stamp(rows, LOADED_AT)


def _flat_summary(summary: DataFrame) -> DataFrame:
    """Lists as text, for the comparison."""
    lists = ("columns_removed_due_to_nulls", "columns_retained")
    return summary.withColumns({c: F.array_join(c, ",") for c in lists})


@query("cleaning_summary")
def summary(spark, sf_dir):
    return _flat_summary(cleaning_summary(profile(tag(dirty_materials(spark, sf_dir))), THRESHOLD))


@query("cleaning_summary_observed")
def summary_while_writing(spark, sf_dir):
    """The counts observed as the quarantine is written."""
    path = scratch_path(spark, "quarantine")
    observed = write_quarantine(dirty_materials(spark, sf_dir), path)
    return _flat_summary(cleaning_summary(observed.frame(spark), THRESHOLD))


@query("order_line_ratios")
def order_line_ratios(spark, sf_dir):
    """The same operators on a table of another shape."""
    tagged = tag(dirty_order_lines(spark, sf_dir), ORDER_LINE_RULES)
    return null_ratios(profile(tagged, ORDER_LINE_RULES), ORDER_LINE_RULES)


@query("inferred_other_ids")
def inferred_other_ids(spark, sf_dir):
    """Ids that inference took for dates, times or booleans are judged as the text they are."""
    source = dirty_materials(spark, sf_dir)
    key = F.col("manufacturer_part_id").cast("int")
    typed = {
        "date": F.date_add(F.lit("2024-01-01").cast("date"), key % 1000),
        "time": F.timestamp_seconds(key),
        "boolean": key % 2 == 0,
    }
    kinds = [
        flag_rows(source.withColumn("id", ids)).select(
            F.lit(kind).alias("kind"), "manufacturer_part_id", "id_cleaned", FLAG
        )
        for kind, ids in typed.items()
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@query("tolerant_int_line_ends")
def tolerant_int_line_ends(spark, sf_dir):
    """Numbers that end in a line feed or in one of the line ends that are no ASCII."""
    ends = F.array(F.lit(""), F.lit("\n"), F.lit("\u0085"), F.lit("\u2028"), F.lit("\u2029"))
    number = F.concat(F.col("l_quantity").cast("string"), F.get(ends, F.col("l_linenumber") % 5))
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", tolerant_int(number).alias("quantity"))


# Statistics


@query("category_stats")
def category_stats(spark, sf_dir):
    return price_stats(valid_rows(tag(dirty_materials(spark, sf_dir))))


@query("category_stats_exact")
def category_stats_exact(spark, sf_dir):
    return price_stats(valid_rows(tag(dirty_materials(spark, sf_dir))), exact=True)


@query("category_only_stats")
def category_only_stats(spark, sf_dir):
    """Grouped by category alone: few groups, and large ones."""
    good = valid_rows(tag(dirty_materials(spark, sf_dir)))
    return price_stats(good, ["category_cleaned"], exact=True)


@query("grouped_price_stats")
def grouped_price_stats(spark, sf_dir):
    keys = ["l_suppkey", "l_returnflag", "l_linestatus"]
    return price_stats(table(spark, sf_dir, "lineitem"), keys, "l_extendedprice")


@query("grouped_line_stats_exact")
def grouped_line_stats_exact(spark, sf_dir):
    keys = ["l_suppkey", "l_returnflag", "l_linestatus"]
    return price_stats(table(spark, sf_dir, "lineitem"), keys, "l_extendedprice", exact=True)


@query("huge_sum_stats_exact")
def huge_sum_stats_exact(spark, sf_dir):
    """Groups whose sums of cents pass 2^61."""
    price = F.floor("l_extendedprice") * F.lit(1e8) + F.col("l_linenumber") * F.lit(0.25)
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", price.alias("price"))
    return price_stats(lines, ["l_returnflag"], "price", exact=True)


@query("grouped_price_stats_exact")
def grouped_price_stats_exact(spark, sf_dir):
    return price_stats(table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", exact=True)


@query("event_value_stats_exact")
def event_value_stats_exact(spark, sf_dir):
    return price_stats(table(spark, sf_dir, "events"), ["event_type"], "value", exact=True)


# Sinks, each read back


def _roundtrip(spark, sf_dir, fmt: str) -> DataFrame:
    path = stored(dirty_materials(spark, sf_dir), fmt, f"{fmt}-roundtrip")
    return read_table(spark, path, MATERIALS_CONTRACT, ReadOptions(fmt=fmt, check=False))


@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "csv")


@query("json_roundtrip")
def json_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "json")


@query("parquet_roundtrip")
def parquet_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "parquet")


@query("orc_roundtrip")
def orc_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "orc")


@query("partitioned_roundtrip")
def partitioned_roundtrip(spark, sf_dir):
    stats = price_stats(valid_rows(tag(dirty_materials(spark, sf_dir))), exact=True)
    path = stored(stats, "parquet", "partitioned", partition_by="category_cleaned")
    return read_table(spark, path, stats.schema, ReadOptions(fmt="parquet", check=False))


@query("partitioned_csv_roundtrip")
def partitioned_csv_roundtrip(spark, sf_dir):
    """Order lines by priority, in text files, whose types come from the schema alone."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = stored(orders, "csv", "partitioned-csv", partition_by="o_orderpriority")
    schema = StructType(
        [
            StructField("o_orderkey", LongType()),
            StructField("o_totalprice", DoubleType()),
            StructField("o_orderpriority", StringType()),
        ]
    )
    return read_table(spark, path, schema, ReadOptions(check=False))


@query("partitioned_blank_keys_csv")
def partitioned_blank_keys_csv(spark, sf_dir):
    """Empty and missing partition keys, in text files, come back apart."""
    priority = F.when(F.col("o_orderkey") % 5 == 0, "").when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", priority.alias("priority"))
    path = scratch_path(spark, "blank-keys")
    write_table(orders, path, "csv", partition_by="priority", key_copies=True)
    schema = partitioned_schema(orders.schema, ["priority"])
    return restore_keys(read_table(spark, path, schema, ReadOptions(check=False)), ["priority"])


@query("append_mode")
def append_mode(spark, sf_dir):
    source = dirty_materials(spark, sf_dir)
    path = stored(source, "parquet", "append")
    write_table(source, path, mode="append")
    return read_table(spark, path, MATERIALS_CONTRACT, ReadOptions(fmt="parquet"))


@query("ignore_mode")
def ignore_mode(spark, sf_dir):
    """What is there stays; a new path is written."""
    source = dirty_materials(spark, sf_dir)
    path = stored(source, "parquet", "ignore", mode="ignore")
    write_table(source.limit(0), path, mode="ignore")
    return read_table(spark, path, MATERIALS_CONTRACT, ReadOptions(fmt="parquet"))


@query("errorifexists_mode")
def errorifexists_mode(spark, sf_dir):
    """A second write is refused and changes nothing."""
    source = dirty_materials(spark, sf_dir)
    path = stored(source, "parquet", "error", mode="errorifexists")
    refused = False
    try:
        write_table(source, path, mode="errorifexists")
    except AnalysisException as error:
        refused = error.getCondition() == "PATH_ALREADY_EXISTS"
    stored_once = read_table(spark, path, MATERIALS_CONTRACT, ReadOptions(fmt="parquet"))
    return stored_once.withColumn("refused", F.lit(refused))


@query("quarantine_roundtrip")
def quarantine_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "quarantine")
    write_quarantine(dirty_materials(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("checkpoint_reuse")
def stored_then_reused(spark, sf_dir):
    """Stored by the first call, read back by the second."""
    path = scratch_path(spark, "checkpoint")
    key = input_fingerprint(spark, f"{sf_dir}/part.parquet")
    valid_part = valid_rows(tag(dirty_materials(spark, sf_dir)))
    materialize(valid_part, path, key)
    again = materialize(valid_part, path, key)
    return again.table.withColumn("reused", F.lit(again.reused))


@query("checkpointed_valid_rows")
def checkpointed_valid_rows(spark, sf_dir):
    """Spark's reliable checkpoint, written by the query that reads it."""
    return checkpoint(valid_rows(tag(dirty_materials(spark, sf_dir))), eager=False)


@query("staged_valid_rows")
def staged_valid_rows(spark, sf_dir):
    """The valid half of order lines that were tagged and stored in one pass."""
    path = scratch_path(spark, "staged")
    return stage(dirty_order_lines(spark, sf_dir), path, "order lines", ORDER_LINE_RULES).valid


# The whole job, from a CSV file to stored statistics


@query("curated_category_stats")
def curated_category_stats(spark, sf_dir):
    source = stored(dirty_materials(spark, sf_dir), "csv", "curate-input")
    out = scratch_path(spark, "curate")
    options = CurationOptions(
        source, f"{out}/clean", f"{out}/quarantine", f"{out}/stats", exact_stats=True
    )
    return curate(spark, options).stats


@query("curated_inferred_stats")
def curated_inferred_stats(spark, sf_dir):
    """Without a contract: types come from the data, and numbers arrive as numbers."""
    source = stored(dirty_materials(spark, sf_dir), "csv", "curate-infer-input")
    out = scratch_path(spark, "curate-infer")
    options = CurationOptions(
        source,
        f"{out}/clean",
        f"{out}/quarantine",
        f"{out}/stats",
        read=ReadOptions(infer=True),
        contract=None,
        exact_stats=True,
    )
    return curate(spark, options).stats


def _curation(spark, source: str, label: str, **settings) -> CurationOptions:
    out = scratch_path(spark, label)
    return CurationOptions(source, f"{out}/clean", f"{out}/quarantine", f"{out}/stats", **settings)


@query("curated_blank_category_stats")
def curated_blank_category_stats(spark, sf_dir):
    """Every fifth category is blank, which is a value, and stays one in partitioned files."""
    source = dirty_materials(spark, sf_dir)
    blank = F.when(F.col("manufacturer_part_id").cast("int") % 5 == 0, "  ").otherwise(F.col("category"))
    path = stored(source.withColumn("category", blank), "csv", "curate-blank-input")
    return curate(spark, _curation(spark, path, "curate-blank")).stats


@query("curated_rerun_without_valid_rows")
def curated_rerun_without_valid_rows(spark, sf_dir):
    """Rows on disk after a second run in which no row is valid: nothing of the first is left."""
    source = dirty_materials(spark, sf_dir)
    good = stored(source, "csv", "curate-good-input")
    bad = stored(source.withColumn("id", F.lit("bad")), "csv", "curate-bad-input")
    options = _curation(spark, good, "curate-rerun")
    first = curate(spark, options)
    rows = first.summary.select(F.lit("first").alias("run"), "valid_rows")
    second = curate(spark, replace(options, input_path=bad)).summary
    left = {
        name: spark.read.schema("name_cleaned string").parquet(path).count()
        for name, path in (("clean", options.clean_path), ("stats", options.stats_path))
    }
    rows = rows.unionByName(second.select(F.lit("second").alias("run"), "valid_rows"))
    return rows.withColumns({f"{name}_left": F.lit(n) for name, n in left.items()})


@query("curated_appended_clean_rows")
def curated_appended_clean_rows(spark, sf_dir):
    """Two appended runs, the first of which drops a sparse column that the second keeps."""
    source = dirty_materials(spark, sf_dir)
    first = stored(source, "csv", "curate-append-input")
    second = stored(source.withColumn("competitor_name", F.lit("acme corp")), "csv", "curate-append-input")
    options = _curation(spark, first, "curate-append", mode="append")
    curate(spark, options)
    both = curate(spark, replace(options, input_path=second)).clean
    return both.select("id_cleaned", "competitor_name_cleaned")


@query("curated_order_line_stats")
def curated_order_line_stats(spark, sf_dir):
    source = stored(dirty_order_lines(spark, sf_dir), "csv", "curate-lines-input")
    out = scratch_path(spark, "curate-lines")
    options = CurationOptions(
        source,
        f"{out}/clean",
        f"{out}/quarantine",
        f"{out}/stats",
        contract=ORDER_LINE_CONTRACT,
        rules=ORDER_LINE_RULES,
        stats_keys=("supplier", "status_cleaned"),
        stats_value="price_cleaned",
        stats_partition="status_cleaned",
        exact_stats=True,
    )
    return curate(spark, options).stats


@query("curated_bad_lines_quarantine")
def curated_bad_lines_quarantine(spark, sf_dir):
    """Lines with too many or too few fields reach the quarantine as they are."""
    return curate(spark, _curation(spark, _ragged(spark, sf_dir), "curate-ragged", read=RAGGED)).quarantine


@query("curated_json_stats")
def curated_json_stats(spark, sf_dir):
    """JSON input, whose field names are gathered as its rows are read."""
    source = dirty_materials(spark, sf_dir)
    path = scratch_path(spark, "curate-json-input")
    write_table(source, path, "json", options={"ignoreNullFields": "false"})
    return curate(spark, _curation(spark, path, "curate-json", read=ReadOptions(fmt="json"))).stats


def _releases(spark, label: str, source: str, **settings) -> CurationOptions:
    return CurationOptions(source, publish_path=scratch_path(spark, label), **settings)


@query("released_appended_stats")
def released_appended_stats(spark, sf_dir):
    """Two appended releases: the statistics are those of all rows."""
    source = dirty_materials(spark, sf_dir)
    odd = F.col("manufacturer_part_id").cast("int") % 2 == 1
    halves = [stored(source.filter(half), "csv", "release-input") for half in (odd, ~odd)]
    options = _releases(spark, "release-append", halves[0], mode="append")
    curate(spark, options)
    return curate(spark, replace(options, input_path=halves[1])).stats


@query("released_order_line_stats")
def released_order_line_stats(spark, sf_dir):
    """The same order lines appended three times, in CSV: three times the rows, the same averages."""
    source = stored(dirty_order_lines(spark, sf_dir), "csv", "release-lines-input")
    options = _releases(
        spark,
        "release-lines",
        source,
        contract=ORDER_LINE_CONTRACT,
        rules=ORDER_LINE_RULES,
        stats_keys=("supplier", "status_cleaned"),
        stats_value="price_cleaned",
        stats_partition="status_cleaned",
        write_format="csv",
        mode="append",
    )
    for _ in range(3):
        curate(spark, options)
    return current_release(spark, options.publish_path).stats


@query("released_rows_after_a_failed_run")
def released_rows_after_a_failed_run(spark, sf_dir):
    """A run that fails after two of its outputs are written leaves all of the release before it."""
    source = dirty_materials(spark, sf_dir)
    options = _releases(spark, "release-failed", stored(source, "csv", "release-input"))
    curate(spark, options)
    other = stored(source.limit(10), "csv", "release-input")
    failed = False
    try:
        curate(spark, replace(options, input_path=other, stats_keys=("no_such_column",)))
    except AnalysisException:
        failed = True
    clean_rows = current_release(spark, options.publish_path).clean
    return clean_rows.drop("ingestion_time").withColumn("failed", F.lit(failed))
