from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from cleargrist import (
    CleaningRules,
    clean,
    cleaning_summary,
    drop_sparse,
    null_ratios,
    profile,
    quarantine_rows,
    stamp,
    tag,
    valid_rows,
)

RULES = CleaningRules(
    text=("name",), integers=("id",), doubles=("price",), required=("id", "name"),
    output=("id", "name", "price", "note"),
)
SCHEMA = "id string, name string, price string, note string"


def tagged(spark, rows):
    return tag(spark.createDataFrame(rows, SCHEMA), RULES)


def test_flag(spark):
    rows = [
        ("1", "a", "2", "x"),
        ("x1", "a", "2", "x"),
        (None, "a", "2", "x"),
        ("1", None, "2", "x"),
        ("1", "   ", "n/a", None),
        (None, None, None, None),
    ]
    flags = [r["is_valid"] for r in tagged(spark, rows).collect()]
    assert flags == ["Y", "N", "N", "N", "Y", "N"]


def test_without_required_columns_only_empty_rows_are_invalid(spark):
    rules = CleaningRules(text=("name",), output=("name",))
    frame = spark.createDataFrame([(None, None), (None, "x"), ("y", None)], "name string, other string")
    assert [r["is_valid"] for r in tag(frame, rules).collect()] == ["N", "Y", "Y"]


def test_split_is_a_partition_of_the_rows(spark):
    rows = [(str(i) if i % 3 else "bad", "a" if i % 5 else None, "1", None) for i in range(100)]
    frame = tagged(spark, rows)
    bad, good = quarantine_rows(frame, RULES), valid_rows(frame, RULES)
    assert bad.columns == ["id", "name", "price", "note", "is_valid"]
    assert good.columns == ["id_cleaned", "name_cleaned", "price_cleaned", "note", "is_valid"]
    assert bad.count() + good.count() == 100
    assert {r["is_valid"] for r in bad.collect()} == {"N"}


def sparse_rows():
    """Ten valid rows, with a column each at null ratio 0, 0.8, 0.9 and 1."""
    return [
        (str(i), "a", "1" if i < 2 else "n/a", "note" if i < 1 else None) for i in range(10)
    ] + [(None, None, "1", "note")] * 5


def test_null_ratios_look_at_valid_rows_only(spark):
    row = null_ratios(profile(tagged(spark, sparse_rows()), RULES), RULES).first().asDict()
    assert row == {
        "id_cleaned": 0.0,
        "name_cleaned": 0.0,
        "price_cleaned": 0.8,
        "note": 0.9,
        "is_valid": 0.0,
    }


def test_nan_and_blank_are_values(spark):
    row = null_ratios(profile(tagged(spark, [("1", "", "NaN", "")]), RULES), RULES).first().asDict()
    assert set(row.values()) == {0.0}


@pytest.mark.parametrize(
    ("threshold", "kept"),
    [
        (0.9, ["id_cleaned", "name_cleaned", "price_cleaned"]),
        (0.91, ["id_cleaned", "name_cleaned", "price_cleaned", "note"]),
        (0.8, ["id_cleaned", "name_cleaned"]),
        (0.0, []),
    ],
)
def test_a_column_at_the_threshold_is_dropped(spark, threshold, kept):
    frame = tagged(spark, sparse_rows())
    assert clean(frame, threshold, RULES).columns == [*kept, "ingestion_time"]
    summary = cleaning_summary(profile(frame, RULES), threshold, RULES).first()
    assert summary["columns_retained"] == kept
    assert (summary["total_rows"], summary["valid_rows"], summary["invalid_rows"]) == (15, 10, 5)
    assert summary["null_threshold"] == threshold


def test_metadata_and_protected_columns(spark):
    frame = tagged(spark, sparse_rows())
    kept = clean(frame, 0.9, RULES, include_metadata=True, protect=["note"])
    names = ["id_cleaned", "name_cleaned", "price_cleaned", "note", "is_valid"]
    assert kept.columns == [*names, "ingestion_time"]
    summary = cleaning_summary(profile(frame, RULES), 0.9, RULES, True, ["note"]).first()
    assert summary["columns_retained"] == names
    assert summary["columns_removed_due_to_nulls"] == []


def test_flag_is_not_listed_as_removed(spark):
    frame = tagged(spark, sparse_rows())
    summary = cleaning_summary(profile(frame, RULES), 0.9, RULES).first()
    assert summary["columns_removed_due_to_nulls"] == ["note"]
    assert "is_valid" not in summary["columns_retained"]


def test_no_valid_rows(spark):
    frame = tagged(spark, [(None, "a", "1", "x")])
    assert clean(frame, 0.9, RULES) is None
    assert set(null_ratios(profile(frame, RULES), RULES).first()) == {None}
    summary = cleaning_summary(profile(frame, RULES), 0.9, RULES).first()
    assert (summary["total_rows"], summary["valid_rows"], summary["invalid_rows"]) == (1, 0, 1)
    assert summary["columns_retained"] == []


def test_drop_sparse_takes_ratios_from_anywhere(spark):
    frame = spark.createDataFrame([(1, 2, "Y")], "a int, b int, is_valid string")
    ratios = {"a": 0.1, "b": 0.95, "is_valid": 0.0}
    assert drop_sparse(frame, ratios, 0.9).columns == ["a"]
    assert drop_sparse(frame, ratios, 0.9, include_metadata=True).columns == ["a", "is_valid"]


def test_stamp(spark):
    frame = spark.range(3)
    at = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)
    texts = stamp(frame, at).select(F.date_format("ingestion_time", "yyyy-MM-dd HH:mm:ss").alias("t"))
    assert {r["t"] for r in texts.collect()} == {"2024-05-06 07:08:09"}
    now = stamp(frame).select("ingestion_time").distinct().collect()
    assert len(now) == 1
    assert dict(stamp(frame).dtypes)["ingestion_time"] == "timestamp"


def test_column_names_with_dots_and_spaces(spark):
    rules = CleaningRules(text=("na.me",), integers=("Unnamed: 0",), required=("na.me",), output=("na.me", "Unnamed: 0"))
    frame = spark.createDataFrame([(" a  B", "1.5"), (None, "2")], "`na.me` string, `Unnamed: 0` string")
    out = tag(frame, rules)
    assert [tuple(r) for r in valid_rows(out, rules).collect()] == [("A B", 1, "Y")]
    assert [tuple(r) for r in quarantine_rows(out, rules).collect()] == [(None, "2", "N")]
    assert clean(out, 0.9, rules).columns == ["na.me_cleaned", "Unnamed: 0_cleaned", "ingestion_time"]


def test_typed_columns(spark):
    rules = CleaningRules(
        text=("code",), integers=("id",), doubles=("price",), required=("id",), output=("id", "code", "price")
    )
    rows = [(1e7, 12, 3), (12.9, None, None), (float("nan"), 1, 1), (None, 1, 1)]
    frame = spark.createDataFrame(rows, "id double, code int, price int")
    good = valid_rows(tag(frame, rules), rules).collect()
    assert [tuple(r) for r in good] == [(10_000_000, "12", 3.0, "Y"), (12, None, None, "Y")]


def test_quarantine_keeps_raw_columns_named_like_cleaned_ones(spark):
    rules = CleaningRules(text=("a",), required=("a",), output=("a",))
    frame = spark.createDataFrame([(None, "x")], "a string, note_cleaned string")
    bad = quarantine_rows(tag(frame, rules), rules)
    assert bad.columns == ["a", "note_cleaned", "is_valid"]
    assert [tuple(r) for r in bad.collect()] == [(None, "x", "N")]


@pytest.mark.parametrize("taken", ["a_cleaned", "is_valid"])
def test_columns_that_cleaning_would_replace_are_refused(spark, taken):
    rules = CleaningRules(text=("a",), required=("a",), output=("a",))
    with pytest.raises(ValueError, match=taken):
        tag(spark.createDataFrame([("x", "y")], f"a string, {taken} string"), rules)
