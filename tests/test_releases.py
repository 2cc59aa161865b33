"""Outputs that change together: readers see all tables of one run, or all of the one before."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cleargrist import (
    ContractError,
    CurationOptions,
    ReadOptions,
    curate,
    current_release,
    price_stats,
    tag,
    valid_rows,
    write_table,
)
from cleargrist.plans import curate as module
from cleargrist.plans.releases import latest, publish
from cleargrist.suite.inputs import dirty_materials

SF_DIR = "/root/testdata/sf0.001"
FORMATS = ["parquet", "orc", "json", "csv"]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def everything(spark, path):
    now = current_release(spark, path)
    return [rows(t) for t in (now.summary, now.quarantine, now.clean, now.stats)]


@pytest.fixture(scope="module")
def halves(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("in")
    source = dirty_materials(spark, SF_DIR)
    odd = F.col("manufacturer_part_id").cast("int") % 2 == 1
    for name, part in (("odd", source.filter(odd)), ("even", source.filter(~odd)), ("all", source)):
        write_table(part, str(folder / name), "csv")
    return {name: str(folder / name) for name in ("odd", "even", "all")}


@pytest.fixture
def options(halves, out):
    return CurationOptions(halves["odd"], publish_path=out("releases"))


@pytest.mark.parametrize("fmt", FORMATS)
def test_a_release_holds_what_a_plain_run_writes(spark, options, halves, out, fmt):
    released = curate(spark, replace(options, input_path=halves["all"], write_format=fmt))
    plain = curate(spark, CurationOptions(halves["all"], out("c"), out("q"), out("s"), write_format=fmt))
    assert rows(released.summary) == rows(plain.summary)
    assert rows(released.quarantine) == rows(plain.quarantine)
    assert rows(released.clean.drop("ingestion_time")) == rows(plain.clean.drop("ingestion_time"))
    assert rows(released.stats) == rows(plain.stats)
    assert released.clean.columns == plain.clean.columns and released.stats.columns == plain.stats.columns


@pytest.mark.parametrize("fmt", FORMATS)
def test_appended_releases_are_about_all_rows(spark, options, halves, fmt):
    options = replace(options, mode="append", write_format=fmt)
    curate(spark, options)
    both = curate(spark, replace(options, input_path=halves["even"]))
    source = dirty_materials(spark, SF_DIR)
    good = valid_rows(tag(source))
    assert both.clean.count() == good.count()
    assert both.quarantine.count() == source.count() - good.count()
    assert rows(both.stats) == rows(price_stats(good, exact=True))
    assert [r["valid_rows"] for r in both.summary.collect()] == [
        good.filter("cast(manufacturer_part_id as int) % 2 = 0").count()
    ]


@pytest.mark.parametrize("output", ["clean", "stats", "states"])
@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_a_failed_run_changes_nothing(spark, options, halves, monkeypatch, output, mode):
    curate(spark, options)
    before = everything(spark, options.publish_path)
    write = module.write_table

    def failing(df, path, *args, **named):
        if path.endswith(f"/{output}"):
            raise OSError("disk full")
        write(df, path, *args, **named)

    again = replace(options, input_path=halves["even"], mode=mode)
    with monkeypatch.context() as patched:
        patched.setattr(module, "write_table", failing)
        with pytest.raises(OSError, match="disk full"):
            curate(spark, again)
    assert everything(spark, options.publish_path) == before
    curate(spark, again)
    assert everything(spark, options.publish_path) != before


def test_a_table_in_use_survives_the_next_release(spark, options, halves):
    first = curate(spark, options)
    before = rows(first.clean)
    curate(spark, replace(options, input_path=halves["even"]))
    assert rows(first.clean) == before != rows(current_release(spark, options.publish_path).clean)


def test_runs_with_other_columns(spark, options, out):
    options = replace(options, mode="append")
    curate(spark, options)
    full = dirty_materials(spark, SF_DIR).withColumn("competitor_name", F.lit("acme corp"))
    write_table(full, out("full"), "csv")
    both = curate(spark, replace(options, input_path=out("full"))).clean
    counts = {r[0]: r[1] for r in both.groupBy("competitor_name_cleaned").count().collect()}
    assert counts.keys() == {None, "Acme Corp"}
    place = both.columns.index("competitor_name_cleaned")
    assert both.columns[place - 1] == "manufacturer_part_id" and both.columns[-1] == "ingestion_time"


@pytest.mark.parametrize("fmt", FORMATS)
def test_runs_without_valid_rows(spark, options, out, fmt):
    options = replace(options, write_format=fmt)
    bad = dirty_materials(spark, SF_DIR).withColumn("id", F.lit("bad"))
    write_table(bad, out("bad"), "csv")
    first = curate(spark, options)
    kept, stats = rows(first.clean), rows(first.stats)
    appended = curate(spark, replace(options, input_path=out("bad"), mode="append"))
    assert (rows(appended.clean), rows(appended.stats)) == (kept, stats)
    assert appended.quarantine.count() == first.quarantine.count() + bad.count()
    replaced = curate(spark, replace(options, input_path=out("bad")))
    assert replaced.clean is None and replaced.stats is None
    now = current_release(spark, options.publish_path)
    assert now.clean.count() == now.stats.count() == 0 and now.quarantine.count() == bad.count()


def test_the_first_run_without_valid_rows(spark, options, out, halves):
    write_table(dirty_materials(spark, SF_DIR).withColumn("id", F.lit("bad")), out("bad"), "csv")
    empty = curate(spark, replace(options, input_path=out("bad"), mode="append"))
    assert empty.clean is None and empty.stats is None
    both = curate(spark, replace(options, mode="append"))
    assert both.clean.count() > 0 and both.stats.agg(F.sum("item_count")).first()[0] == both.clean.count()


def test_modes(spark, options, halves):
    errorifexists, ignore = (replace(options, mode=m) for m in ("errorifexists", "ignore"))
    curate(spark, errorifexists)
    before = everything(spark, options.publish_path)
    with pytest.raises(ValueError, match="release"):
        curate(spark, errorifexists)
    curate(spark, replace(ignore, input_path=halves["even"]))
    assert everything(spark, options.publish_path) == before


def test_of_two_runs_at_a_time_one_is_refused(spark, options, halves):
    curate(spark, options)
    before = latest(spark, options.publish_path)
    curate(spark, replace(options, input_path=halves["even"]))
    now = everything(spark, options.publish_path)
    with pytest.raises(RuntimeError, match="run again"):
        publish(spark, options.publish_path, "late", before.tables, before)
    assert everything(spark, options.publish_path) == now


def test_refused_json_is_not_published(spark, options, out):
    source = dirty_materials(spark, SF_DIR)
    keep = {"ignoreNullFields": "false"}
    write_table(source, out("json"), "json", options=keep)
    options = replace(options, input_path=out("json"), read=ReadOptions(fmt="json"))
    curate(spark, options)
    before = everything(spark, options.publish_path)
    write_table(source.drop("category").withColumn("colour", F.lit("red")), out("other"), "json", options=keep)
    with pytest.raises(ContractError, match="missing column 'category'.*unexpected column 'colour'"):
        curate(spark, replace(options, input_path=out("other")))
    assert everything(spark, options.publish_path) == before


def test_no_release(spark, out):
    assert current_release(spark, out("none")) is None


def test_paths_are_either_three_or_one():
    for paths in ({}, {"clean_path": "c"}, {"clean_path": "c", "publish_path": "p"}):
        with pytest.raises(ValueError, match="all three outputs"):
            CurationOptions("in", **paths)


def test_checkpointed_releases(spark, options, out):
    options = replace(options, checkpoint_path=out("kept"))
    curate(spark, options)
    first = everything(spark, options.publish_path)
    curate(spark, options)
    second = everything(spark, options.publish_path)
    assert first[0] == second[0] and first[1] == second[1] and first[3] == second[3]


def test_load_times_in_csv_are_those_that_spark_writes(spark, options, out):
    released = curate(spark, replace(options, write_format="csv"))
    folder = latest(spark, options.publish_path).tables["clean"].parts[0].folder
    typed = released.clean.select("ingestion_time")
    write_table(typed, out("times"), "csv")
    texts = spark.read.option("header", True).csv(f"{options.publish_path}/{folder}").select("ingestion_time")
    assert rows(texts) == rows(spark.read.option("header", True).csv(out("times")))
    assert texts.distinct().count() == 1
