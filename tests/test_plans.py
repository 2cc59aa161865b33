"""The physical plans that the scaling claims rest on."""

import re

import pytest
from pyspark.sql import Observation

from cleargrist import MATERIALS_RULES, clean, flag_rows, price_stats, profile, quarantine_rows, stage, tag, valid_rows, write_table
from cleargrist.operators.quality import profile_measures
from cleargrist.suite.inputs import dirty_materials


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    write_table(dirty_materials(spark, "/root/testdata/sf0.001"), path)
    return spark.read.parquet(path)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(frame):
    listed = re.search(r"FileScan parquet \[(.*?)\]", plan(frame)).group(1)
    return {column.split("#")[0] for column in listed.split(",")}


def test_splitting_shuffles_nothing(source):
    for frame in (quarantine_rows(tag(source)), valid_rows(tag(source))):
        assert "Exchange" not in plan(frame)


def test_validity_checks_reach_the_scan(source):
    assert "PushedFilters: [IsNotNull(name), IsNotNull(category)]" in plan(valid_rows(tag(source)))


def test_the_first_pass_normalises_no_text(source):
    flagged = flag_rows(source)
    watched = flagged.observe(Observation(), *profile_measures(MATERIALS_RULES.null_probes()))
    for frame in (quarantine_rows(watched), quarantine_rows(tag(source)), profile(tag(source))):
        assert "initcap" not in plan(frame)
        assert "regexp_replace" not in plan(frame)


def test_sparse_columns_are_not_read(source):
    kept = clean(tag(source), 0.9)
    names = read_columns(kept)
    assert "name" in names
    assert not names & {"long_description", "competitor_name", "competitor_part_name", "competitor_part_id", "Unnamed: 0"}


def test_statistics_read_and_shuffle_little(source):
    stats = price_stats(valid_rows(tag(source)))
    assert read_columns(stats) == {"id", "name", "manufacturer_name", "category", "requested_unit_price"}
    text = plan(stats)
    assert text.count("Exchange") == 1
    assert text.index("partial_avg") > text.index("Exchange")


def test_stored_statistics_are_pruned_by_partition(spark, source, out):
    write_table(price_stats(valid_rows(tag(source))), out("stats"), partition_by="category_cleaned")
    one = spark.read.parquet(out("stats")).filter("category_cleaned = 'Promo'")
    assert "PartitionFilters: [isnotnull(category_cleaned" in plan(one)


def test_a_round_trip_runs_no_python(source):
    text = plan(price_stats(valid_rows(tag(source)), exact=True))
    assert "Python" not in text and "Arrow" not in text


def test_each_staged_half_is_read_by_its_folder(source, out):
    staged = stage(source, out("staged"), "k")
    for half, flag in ((staged.valid, "Y"), (staged.quarantine, "N")):
        text = plan(half)
        assert "PartitionFilters: [isnotnull(is_valid" in text and f"= {flag})" in text
