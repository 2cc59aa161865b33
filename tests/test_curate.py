import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cleargrist import (
    MATERIALS_CONTRACT,
    ContractError,
    CurationOptions,
    ReadOptions,
    cleaning_summary,
    curate,
    profile,
    quarantine_rows,
    read_table,
    stage,
    tag,
    valid_rows,
    write_quarantine,
    write_table,
)
from cleargrist.suite.inputs import dirty_materials

SF_DIR = "/root/testdata/sf0.01"
# The columns that the clean table of this input keeps.
CLEAN = [
    "id_cleaned",
    "name_cleaned",
    "description_cleaned",
    "customer_part_id",
    "manufacturer_name_cleaned",
    "manufacturer_part_id",
    "category_cleaned",
    "unit_of_measure",
    "unit_quantity_cleaned",
    "requested_quantity_cleaned",
    "requested_unit_price_cleaned",
]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "materials")
    write_table(dirty_materials(spark, SF_DIR), path, "csv")
    return path


@pytest.fixture
def options(source, out):
    return CurationOptions(source, out("clean"), out("quarantine"), out("stats"))


def check(spark, result):
    summary = result.summary.first()
    assert (summary["total_rows"], summary["valid_rows"], summary["invalid_rows"]) == (2000, 1706, 294)
    assert summary["columns_retained"] == CLEAN
    assert result.clean.columns == [*CLEAN, "ingestion_time"]
    assert (result.clean.count(), result.quarantine.count(), result.stats.count()) == (1706, 294, 1546)
    assert result.quarantine.columns == [*MATERIALS_CONTRACT.names, "is_valid"]
    assert result.clean.select("ingestion_time").distinct().count() == 1
    tagged = tag(dirty_materials(spark, SF_DIR))
    assert rows(result.clean.drop("ingestion_time")) == rows(valid_rows(tagged).select(CLEAN))
    assert rows(result.quarantine) == rows(quarantine_rows(tagged))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats(spark, options, fmt):
    check(spark, curate(spark, replace(options, write_format=fmt)))


def test_stats_do_not_depend_on_the_way_there(spark, options, out):
    direct = curate(spark, options).stats
    as_json = curate(spark, replace(options, write_format="json", stats_path=out("s2"), clean_path=out("c2"))).stats
    staged = curate(spark, replace(options, checkpoint_path=out("k"), stats_path=out("s3"))).stats
    assert rows(direct) == rows(as_json) == rows(staged)


def test_checkpoint_is_reused_for_the_same_input_only(spark, options, out):
    kept = replace(options, checkpoint_path=out("kept"))
    check(spark, curate(spark, kept))
    raw = read_table(spark, options.input_path, MATERIALS_CONTRACT)
    assert stage(raw, out("kept"), kept.checkpoint_key(spark)).reused
    check(spark, curate(spark, kept))

    write_table(raw.filter("category is not null"), out("other"), "csv")
    other = replace(kept, input_path=out("other"))
    assert other.checkpoint_key(spark) != kept.checkpoint_key(spark)
    assert curate(spark, other).summary.first()["total_rows"] < 2000


def test_overwrite_and_append(spark, options):
    curate(spark, options)
    check(spark, curate(spark, options))
    again = curate(spark, replace(options, mode="append"))
    assert again.clean.count() == 2 * 1706
    assert again.quarantine.count() == 2 * 294
    # The second half of the statistics is about the rows of this run alone.
    assert again.stats.groupBy(*again.stats.columns).count().filter("count != 2").count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_appended_runs_are_read_back_with_all_their_columns(spark, options, out, fmt):
    options = replace(options, mode="append", write_format=fmt)
    curate(spark, options)
    full = dirty_materials(spark, SF_DIR).withColumn("competitor_name", F.lit("acme corp"))
    write_table(full, out("full"), "csv")
    curate(spark, replace(options, input_path=out("full")))
    again = curate(spark, options).clean
    counts = {r[0]: r[1] for r in again.groupBy("competitor_name_cleaned").count().collect()}
    if fmt != "csv":
        assert counts == {None: 2 * 1706, "Acme Corp": 1706}
    assert counts["Acme Corp"] >= 1706 and sum(counts.values()) == 3 * 1706


def test_ignore_keeps_what_is_there(spark, options):
    curate(spark, options)
    result = curate(spark, replace(options, mode="ignore"))
    check(spark, result)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_stale_quarantine_is_replaced(spark, options, out, fmt):
    options = replace(options, write_format=fmt)
    curate(spark, options)
    good = dirty_materials(spark, SF_DIR).withColumns(
        {"id": F.lit("1"), "name": F.lit("n"), "category": F.lit("c")}
    )
    write_table(good, out("good"), "csv")
    result = curate(spark, replace(options, input_path=out("good")))
    assert result.quarantine.count() == 0
    assert result.summary.first()["invalid_rows"] == 0
    assert result.stats.agg(F.sum("item_count")).first()[0] == 2000


@pytest.mark.parametrize("checkpoint", [None, "k"])
def test_no_valid_rows(spark, options, out, checkpoint):
    bad = dirty_materials(spark, SF_DIR).withColumn("id", F.lit("bad"))
    write_table(bad, out("bad"), "csv")
    path = out(checkpoint) if checkpoint else None
    result = curate(spark, replace(options, input_path=out("bad"), checkpoint_path=path))
    assert result.clean is None and result.stats is None
    assert result.quarantine.count() == 2000
    assert result.summary.first()["valid_rows"] == 0
    assert result.summary.first()["columns_retained"] == []


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_outputs_of_an_earlier_run_are_emptied(spark, options, out, fmt):
    options = replace(options, write_format=fmt)
    curate(spark, options)
    bad = dirty_materials(spark, SF_DIR).withColumn("id", F.lit("bad"))
    write_table(bad, out("bad"), "csv")
    curate(spark, replace(options, input_path=out("bad")))
    for path in (options.clean_path, options.stats_path):
        assert spark.read.schema("x string").option("header", True).format(fmt).load(path).count() == 0


def test_a_file_that_arrives_while_the_job_runs_is_seen_by_the_next(spark, options, out, monkeypatch):
    folder = Path(out("late"))
    write_table(dirty_materials(spark, SF_DIR).limit(100), str(folder), "csv")
    kept = replace(options, input_path=str(folder), checkpoint_path=out("kept"))
    from cleargrist.plans import curate as module

    write, arrived = module.materialize, []

    def late(*args, **named):
        if not arrived:
            arrived.append(write_table(dirty_materials(spark, SF_DIR).limit(50), str(folder), "csv", "append"))
        return write(*args, **named)

    monkeypatch.setattr(module, "materialize", late)
    with pytest.warns(UserWarning, match="changed"):
        curate(spark, kept)
    assert curate(spark, kept).summary.first()["total_rows"] == 150


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_no_rows_at_all(spark, options, out, fmt):
    write_table(dirty_materials(spark, SF_DIR).limit(0), out("empty"), "csv")
    result = curate(spark, replace(options, input_path=out("empty"), write_format=fmt))
    assert result.clean is None and result.quarantine.count() == 0
    assert result.summary.first()["total_rows"] == 0


def test_sparse_columns_that_statistics_need_stay(spark, options, out):
    sparse = dirty_materials(spark, SF_DIR).withColumns(
        {"manufacturer_name": F.lit(None).cast("string"), "requested_unit_price": F.lit("n/a")}
    )
    write_table(sparse, out("sparse"), "csv")
    result = curate(spark, replace(options, input_path=out("sparse")))
    assert {"manufacturer_name_cleaned", "requested_unit_price_cleaned"} <= set(result.clean.columns)
    assert rows(result.stats.select("manufacturer_name_cleaned", "avg_price").distinct()) == [(None, None)]


def test_contract_gate(spark, options, out):
    write_table(dirty_materials(spark, SF_DIR).drop("id"), out("short"), "csv")
    with pytest.raises(ContractError, match="missing column 'id'"):
        curate(spark, replace(options, input_path=out("short")))


def write_json(frame, path):
    write_table(frame, path, "json", options={"ignoreNullFields": "false"})
    return path


@pytest.mark.parametrize("checkpoint", [None, "kept"])
def test_json_that_is_refused_replaces_nothing(spark, options, out, checkpoint):
    """Its field names are known only once its rows have been read."""
    source = dirty_materials(spark, SF_DIR)
    kept = out(checkpoint) if checkpoint else None
    good = replace(options, input_path=write_json(source, out("good")), read=ReadOptions(fmt="json"), checkpoint_path=kept)
    result = curate(spark, good)
    check(spark, result)
    before = [rows(t) for t in (result.quarantine, result.clean, result.stats)]
    for changed, message in (
        (source.drop("category"), "missing column 'category'"),
        (source.withColumn("colour", F.lit("red")), "unexpected column 'colour'"),
    ):
        path = write_json(changed, out(message))
        for _ in range(2):  # nor is a refused table reused
            with pytest.raises(ContractError, match=message):
                curate(spark, replace(good, input_path=path))
    assert [rows(t) for t in (result.quarantine, result.clean, result.stats)] == before


@pytest.mark.parametrize("checkpoint", [None, "kept"])
def test_json_numbers_are_quarantined_as_they_are_written(spark, options, out, checkpoint):
    Path(out("in")).mkdir()
    fields = {c: None for c in MATERIALS_CONTRACT.names}
    lines = [json.dumps(fields | {"id": "x", "name": "n", "unit_quantity": "Q"}).replace('"Q"', "2.50")]
    lines += [json.dumps(fields | {"id": i, "name": "n", "category": "c", "requested_unit_price": 1.5}) for i in range(3)]
    Path(out("in"), "t.json").write_text("\n".join(lines))
    kept = out(checkpoint) if checkpoint else None
    options = replace(options, input_path=out("in"), read=ReadOptions(fmt="json"), checkpoint_path=kept)
    for _ in range(2):
        result = curate(spark, options)
        assert rows(result.quarantine.select("id", "unit_quantity")) == [("x", "2.50")]
        assert rows(result.stats.select("item_count", "avg_price")) == [(3, 1.5)]


def test_bad_lines_are_quarantined(spark, options, out):
    lines = ["a,b,c", "1,x,2.5", "2,y,3.5,surplus", "3", "4,,1", ",,"]
    Path(out("in")).mkdir()
    Path(out("in"), "t.csv").write_text("\n".join(lines) + "\n")
    from cleargrist import CleaningRules
    from pyspark.sql.types import StringType, StructField, StructType

    contract = StructType([StructField(c, StringType()) for c in "abc"])
    plain = replace(
        options,
        input_path=out("in"),
        contract=contract,
        rules=CleaningRules(integers=("a",), text=("b",), doubles=("c",), required=("a",), output=("a", "b", "c")),
        stats_keys=("b_cleaned",),
        stats_value="c_cleaned",
        stats_partition=None,
    )
    assert rows(curate(spark, plain).clean.select("a_cleaned")) == [(1,), (2,), (3,), (4,)]
    for checkpoint in (None, out("kept")):
        strict = replace(plain, read=ReadOptions(bad_lines="raw"), checkpoint_path=checkpoint)
        result = curate(spark, strict)
        assert rows(result.clean.select("a_cleaned")) == [(1,), (4,)]
        assert result.quarantine.columns == ["a", "b", "c", "raw", "is_valid"]
        assert rows(result.quarantine) == [
            ("2", "y", "3.5", "2,y,3.5,surplus", "N"),
            ("3", None, None, "3", "N"),
            (None, None, None, None, "N"),
        ]
        assert result.summary.first()["invalid_rows"] == 3


def test_blank_keys_survive(spark, options, out):
    """A blank name is a value: it stays apart from a missing one in Parquet statistics."""
    blank = dirty_materials(spark, SF_DIR).withColumn("manufacturer_name", F.lit("   "))
    write_table(blank, out("blank"), "csv")
    result = curate(spark, replace(options, input_path=out("blank"), read=ReadOptions(multiline=True)))
    assert rows(result.stats.select("manufacturer_name_cleaned").distinct()) == [("",)]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_a_blank_partition_key_survives(spark, options, out, fmt):
    blank = dirty_materials(spark, SF_DIR).withColumn("category", F.lit("   "))
    write_table(blank, out("blank"), "csv")
    result = curate(spark, replace(options, input_path=out("blank"), write_format=fmt, read=ReadOptions(multiline=True)))
    assert rows(result.stats.select("category_cleaned").distinct()) == [("",)]
    assert result.stats.columns[:3] == ["name_cleaned", "manufacturer_name_cleaned", "category_cleaned"]


def test_typed_input(spark, options, out):
    typed = dirty_materials(spark, SF_DIR).withColumn(
        "requested_unit_price", F.col("requested_unit_price").cast("double")
    )
    write_table(typed, out("typed"))
    check(spark, curate(spark, replace(options, input_path=out("typed"), read=ReadOptions(fmt="parquet"))))


@pytest.mark.parametrize("mode", ["overwrite", "ignore"])
def test_observed_profile_equals_the_aggregate(spark, out, mode):
    frame = dirty_materials(spark, SF_DIR)
    observed = write_quarantine(frame, out("q"), mode=mode)
    assert rows(observed.frame(spark)) == rows(profile(tag(frame)))
    assert rows(spark.read.parquet(out("q"))) == rows(quarantine_rows(tag(frame)))
    staged = stage(frame, out("s"), "k")
    assert staged.profile == observed
    assert rows(staged.valid) == rows(valid_rows(tag(frame)))
    assert rows(staged.quarantine) == rows(quarantine_rows(tag(frame)))
    summary = cleaning_summary(observed.frame(spark), 0.9).first()
    assert summary["columns_removed_due_to_nulls"] == [
        "long_description", "competitor_name_cleaned", "competitor_part_name", "competitor_part_id"
    ]


def test_records_of_each_run(spark, options, out):
    recorded = replace(options, schema_report_path=out("reports"), summary_path=out("summaries"))
    curate(spark, recorded)
    curate(spark, recorded)
    assert [r["status"] for r in spark.read.json(out("reports")).collect()] == ["PASSED"] * 2
    summaries = spark.read.json(out("summaries"))
    assert summaries.select("ingestion_time").distinct().count() == 2
    assert rows(summaries.select("total_rows", "columns_retained")) == [(2000, CLEAN)] * 2


def test_spread_input_is_counted_once(spark, options):
    read = ReadOptions(multiline=True, spread=True)
    check(spark, curate(spark, replace(options, read=read)))
    check(spark, curate(spark, replace(options, read=read, checkpoint_path=options.clean_path + "-k")))
