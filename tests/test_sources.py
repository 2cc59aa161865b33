import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cleargrist import (
    MATERIALS_CONTRACT,
    ContractError,
    ReadOptions,
    compare_schema,
    contract_report,
    preview_schema,
    read_table,
    read_watched,
)

ABC = StructType([StructField(c, StringType()) for c in ("a", "b", "c")])


@pytest.fixture
def csv(tmp_path):
    def write(*contents):
        for i, text in enumerate(contents):
            Path(tmp_path / f"part-{i}.csv").write_text(text, newline="")
        return str(tmp_path)

    return write


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_contract_has_the_expected_shape():
    assert len(MATERIALS_CONTRACT) == 16
    assert MATERIALS_CONTRACT.names[0] == "Unnamed: 0"
    assert all(f.dataType == StringType() and f.nullable for f in MATERIALS_CONTRACT)


DIALECT = 'a,b,c\n1,"x ""q"" y",3\n,"",z\nshort\nlong,2,3,4,5\n,,\n\n  pad , in ner ,"line\nbreak"\n'


def test_csv_dialect(spark, csv):
    path = csv(DIALECT)
    expected = [
        ("1", 'x "q" y', "3"),
        (None, None, "z"),
        ("short", None, None),
        ("long", "2", "3"),
        (None, None, None),
        ("  pad ", " in ner ", "line\nbreak"),
    ]
    read = read_table(spark, path, ABC, ReadOptions(multiline=True))
    assert rows(read) == sorted(expected, key=repr)
    assert read.count() == 6


RAGGED = ReadOptions(multiline=True, bad_lines="raw")


def test_bad_lines_are_kept(spark, csv):
    read = read_table(spark, csv(DIALECT), ABC, RAGGED)
    expected = [
        ("1", 'x "q" y', "3", None),
        (None, None, "z", None),
        ("short", None, None, "short"),
        ("long", "2", "3", "long,2,3,4,5"),
        (None, None, None, None),
        ("  pad ", " in ner ", "line\nbreak", None),
    ]
    assert read.columns == ["a", "b", "c", "raw"]
    assert rows(read) == sorted(expected, key=repr)


@pytest.mark.parametrize("multiline", [False, True])
def test_bad_lines_do_not_depend_on_what_is_asked_for(spark, csv, multiline):
    path = csv("c,a,b\n3,1,2\n6,4,5,surplus\n9\n,,\n")
    read = read_table(spark, path, ABC, ReadOptions(multiline=multiline, bad_lines="raw"))
    assert read.filter("raw is not null").count() == 2
    assert rows(read.select("raw")) == [("6,4,5,surplus",), ("9",), (None,), (None,)]
    assert rows(read.filter("raw is null").select("b")) == [("2",), (None,)]
    assert rows(read.filter("raw is not null and c = '6'").select("b", "raw")) == [("5", "6,4,5,surplus")]


def test_bad_lines_of_other_reads(spark, csv, out):
    path = csv("1,2,3\n4,5,6,7\n")
    read = read_table(spark, path, ABC, ReadOptions(header=False, bad_lines="raw"))
    assert rows(read) == [("1", "2", "3", None), ("4", "5", "6", "4,5,6,7")]
    inferred = read_table(spark, path, options=ReadOptions(header=False, infer=True, bad_lines="raw"))
    assert inferred.dtypes == [("_c0", "int"), ("_c1", "int"), ("_c2", "int"), ("raw", "string")]
    assert rows(inferred)[1] == (4, 5, 6, "4,5,6,7")
    typed = StructType([StructField("a", IntegerType()), ABC["b"], ABC["c"]])
    (Path(out("typed.csv"))).write_text("a,b,c\nx,y,z\n1,y,z\n")
    read = read_table(spark, out("typed.csv"), typed, ReadOptions(bad_lines="raw"))
    assert rows(read) == [(1, "y", "z", None), (None, "y", "z", "x,y,z")]


def test_bad_json_records(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"a": "1", "b": "2", "c": "3"}\nbroken {\n\n{"a": "4", "b": null, "c": "5"}\n')
    read = read_table(spark, str(tmp_path), ABC, ReadOptions(fmt="json", bad_lines="raw"))
    assert rows(read) == [("1", "2", "3", None), ("4", None, "5", None), (None, None, None, "broken {")]


def test_bad_lines_need_a_name_of_their_own_and_text(spark, csv, out):
    path = csv("a,b,c\n1,2,3\n")
    with pytest.raises(ValueError, match="'a' of its own"):
        read_table(spark, path, ABC, ReadOptions(bad_lines="a"))
    spark.range(1).write.parquet(out("t"))
    with pytest.raises(ValueError, match="not of parquet"):
        read_table(spark, out("t"), options=ReadOptions(fmt="parquet", bad_lines="raw"))


def test_multiline_changes_the_row_count(spark, csv):
    assert read_table(spark, csv(DIALECT), ABC).count() == 7


def test_delimiter_quote_and_escape_are_applied(spark, csv):
    path = csv("a;b;c\n'x;y';'it\\'s';2\n")
    read = read_table(spark, path, ABC, ReadOptions(delimiter=";", quote="'", escape="\\"))
    assert rows(read) == [("x;y", "it's", "2")]


def test_the_gate_uses_the_dialect_too(spark, csv):
    assert preview_schema(spark, csv("a;b;c\n1;2;3\n"), ReadOptions(delimiter=";")).names == ["a", "b", "c"]


def test_missing_and_unexpected_columns_are_refused(spark, csv):
    path = csv("a,c,d\n1,2,3\n")
    with pytest.raises(ContractError, match="missing column 'b'.*unexpected column 'd'") as caught:
        read_table(spark, path, ABC)
    report = caught.value.report
    assert not report.passed
    assert report.columns("missing_column") == ["b"]
    assert report.columns("unexpected_column") == ["d"]


def test_columns_in_another_order_are_matched_by_name(spark, csv):
    path = csv("c,a,b\n3,1,2\n")
    read = read_table(spark, path, ABC)
    assert read.columns == ["a", "b", "c"]
    assert rows(read) == [("1", "2", "3")]


def test_files_with_differing_headers_are_refused(spark, csv):
    path = csv("a,b,c\n1,2,3\n", "c,a,b\n3,1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_table(spark, path, ABC).collect()


def test_blank_and_repeated_header_names(spark, csv):
    report = contract_report(spark, csv(",id,id,name\n1,2,3,4\n"), ABC)
    assert report.actual.names == ["_c0", "id1", "id2", "name"]
    assert report.columns("missing_column") == ["a", "b", "c"]


def test_no_header_reads_by_position(spark, csv):
    assert rows(read_table(spark, csv("1,2,3\n"), ABC, ReadOptions(header=False))) == [("1", "2", "3")]


@pytest.mark.parametrize(("text", "message"), [("1,2\n", "missing column 'c'"), ("1,2,3,4\n", "unexpected column '_c3'")])
def test_no_header_and_another_number_of_columns_is_refused(spark, csv, out, text, message):
    with pytest.raises(ContractError, match=message):
        read_table(spark, csv(text), ABC, ReadOptions(header=False), out("report"))
    assert spark.read.json(out("report")).first()["status"] == "FAILED"


def test_unchecked_columns_go_by_name(spark, csv):
    path = csv("c,other,a\n3,x,1\n")
    assert rows(read_table(spark, path, ABC, ReadOptions(check=False))) == [("1", None, "3")]


def test_values_that_do_not_fit_become_null(spark, out):
    spark.createDataFrame([("x", "1", "y")], ABC).write.parquet(out("t"))
    contract = StructType([StructField("a", IntegerType()), StructField("b", IntegerType()), ABC["c"]])
    read = read_table(spark, out("t"), contract, ReadOptions(fmt="parquet"))
    assert rows(read) == [(None, 1, "y")]


def test_inference(spark, csv):
    read = read_table(spark, csv("a,b,c\n1,x,2.5\n2,y,3\n"), ABC, ReadOptions(infer=True))
    assert read.dtypes == [("a", "int"), ("b", "string"), ("c", "double")]


def test_several_paths(spark, tmp_path):
    for name in "xy":
        (tmp_path / f"{name}.csv").write_text(f"a,b,c\n{name},2,3\n")
    read = read_table(spark, [str(tmp_path / "x.csv"), str(tmp_path / "y.csv")], ABC)
    assert rows(read) == [("x", "2", "3"), ("y", "2", "3")]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_typed_files_are_cast_or_refused(spark, out, fmt):
    spark.createDataFrame([(12.5, 1, "x")], "b double, a int, c string").write.format(fmt).save(out("t"))
    assert rows(read_table(spark, out("t"), ABC, ReadOptions(fmt=fmt))) == [("1", "12.5", "x")]
    with pytest.raises(ContractError, match="type mismatch 'a'"):
        read_table(spark, out("t"), ABC, ReadOptions(fmt=fmt, coerce=False))


def test_json_may_leave_out_nulls_when_unchecked(spark, out):
    frame = spark.createDataFrame([("1", None, "3")], "a string, b string, c string")
    frame.write.json(out("t"))
    with pytest.raises(ContractError, match="missing column 'b'"):
        read_table(spark, out("t"), ABC, ReadOptions(fmt="json"))
    assert rows(read_table(spark, out("t"), ABC, ReadOptions(fmt="json", check=False))) == [("1", None, "3")]


JSON_LINES = [
    '{"a": "1", "b": "2", "c": null}',
    '{"a": "2.50", "b": null, "c": true}',
    "",
    "broken {",
    " \t ",
    '  {"b": "12345678901234567890", "a": "\\u00e9\\n"}  ',
    '"text"',
    '{"a": "{}", "b": "[1, 2]", "a": "twice"}',
    "{}",
    "null",
]


def watched(spark, folder, contract=ABC, **options):
    return read_watched(spark, str(folder), contract, ReadOptions(fmt="json", **options))


def unchecked(spark, folder, contract=ABC, **options):
    return read_table(spark, str(folder), contract, ReadOptions(fmt="json", check=False, **options))


@pytest.mark.parametrize(("bad_lines", "left_out"), [(None, [3, 6, 7]), ("raw", []), ("raw", [3, 6, 7])])
def test_watched_json_gives_the_rows_of_the_json_source(spark, tmp_path, bad_lines, left_out):
    lines = [line for i, line in enumerate(JSON_LINES) if i not in left_out]
    (tmp_path / "t.json").write_text("\n".join(lines))
    read = watched(spark, tmp_path, bad_lines=bad_lines)
    assert read.waits
    expected = rows(unchecked(spark, tmp_path, bad_lines=bad_lines))
    assert rows(read.rows) == rows(read.again) == expected
    assert read.judge()


def test_watched_json_that_does_not_parse_is_refused_as_by_inference(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"a": "1", "b": "2", "c": "3"}\nbroken {\n')
    read = watched(spark, tmp_path)
    read.rows.collect()
    for refused in (read.judge, lambda: read_table(spark, str(tmp_path), ABC, ReadOptions(fmt="json"))):
        with pytest.raises(ContractError, match="unexpected column '_corrupt_record'"):
            refused()


@pytest.mark.parametrize("line", ['{"a": 2.50}', '{"a": {"x": 1}}', '{"a": -0}', '[{"a": "7"}, {"a": "8"}]', "[]"])
def test_watched_json_in_another_notation_is_read_again(spark, tmp_path, line):
    (tmp_path / "t.json").write_text('{"a": "1", "b": "2", "c": "3"}\n' + line + "\n")
    read = watched(spark, tmp_path)
    read.rows.collect()
    assert not read.judge()
    assert rows(read.again) == rows(unchecked(spark, tmp_path))


def test_watched_json_is_refused_after_its_first_query(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"a": "1", "d.e": 1}\n{"b": "2", "f`g": null}\n')
    read = watched(spark, tmp_path)
    assert read.rows.count() == 2
    with pytest.raises(ContractError, match="missing column 'c'.*unexpected column 'd.e'") as caught:
        read.judge()
    assert caught.value.report.columns("unexpected_column") == ["d.e", "f`g"]


def test_watched_json_knows_types(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"a": 1, "b": "x", "c": 2.5}\n{"a": 2, "b": 1, "c": null}\n')
    typed = StructType([StructField("a", IntegerType()), StructField("b", StringType()), StructField("c", StringType())])
    read = watched(spark, tmp_path, coerce=False)
    read.rows.collect()
    with pytest.raises(ContractError, match=r"'a' \(expected string, got bigint\).*'c' \(expected string, got double\)"):
        read.judge()
    read = watched(spark, tmp_path, typed)
    assert rows(read.rows) == rows(read.again) == [(1, "x", "2.5"), (2, "1", None)]
    assert not read.judge()  # as 2.5 could have been written 2.50


def test_watched_json_with_values_that_do_not_fit(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"a": "x", "b": "1", "c": "2"}\n{"a": 3, "b": "[1, 2]", "c": null}\n')
    typed = StructType([StructField("a", IntegerType()), *ABC.fields[1:]])
    read = watched(spark, tmp_path, typed)
    assert rows(read.rows) == rows(read.again) == rows(read_table(spark, str(tmp_path), typed, ReadOptions(fmt="json")))
    assert not watched(spark, tmp_path, typed, bad_lines="raw").waits


def test_other_tables_are_judged_beforehand(spark, csv, tmp_path):
    with pytest.raises(ContractError, match="missing column 'b'"):
        read_watched(spark, csv("a,c\n1,2\n"), ABC)
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "t.json").write_text('[{"a": "1",\n "b": "2", "c": "3"}]')
    read = watched(spark, tmp_path / "j", multiline=True)
    assert not read.waits and rows(read.rows) == [("1", "2", "3")]
    read.judge()


def test_multiline_json(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"a": "1",\n "b": "2", "c": "3"},\n {"a": "4", "b": "5", "c": null}]')
    read = read_table(spark, str(tmp_path), ABC, ReadOptions(fmt="json", multiline=True))
    assert rows(read) == [("1", "2", "3"), ("4", "5", None)]


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unsupported format 'xml'"):
        read_table(spark, "nowhere", ABC, ReadOptions(fmt="xml"))


def test_format_names_ignore_case(spark, out):
    spark.range(1).write.parquet(out("t"))
    assert read_table(spark, out("t"), options=ReadOptions(fmt="PARQUET")).count() == 1


def test_report_frames(spark):
    actual = StructType([StructField("a", IntegerType()), StructField("z", StringType())])
    report = compare_schema(actual, ABC)
    assert rows(report.issues_frame(spark)) == [
        ("missing_column", "b", "string", None),
        ("missing_column", "c", "string", None),
        ("type_mismatch", "a", "string", "int"),
        ("unexpected_column", "z", None, "string"),
    ]
    document = report.document_frame(spark).first()
    assert document["status"] == "FAILED"
    assert document["missing_columns"] == ["b", "c"]
    assert [tuple(m) for m in document["type_mismatches"]] == [("a", "string", "int")]
    assert document["unexpected_columns"] == ["z"]
    assert len(document["errors"]) == 4
    assert StructType.fromJson(json.loads(document["expected_schema"])) == ABC
    assert document["checked_at"] is not None


def test_report_that_passes(spark):
    report = compare_schema(ABC, ABC)
    assert report.passed
    assert report.document_frame(spark).first()["status"] == "PASSED"
    assert report.issues_frame(spark).count() == 0


def test_only_needed_columns_are_parsed(spark, csv):
    read = read_table(spark, csv("a,b,c\n1,2,3\n"), ABC).select("b").filter(F.col("b") == "2")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<b:string>" in plan
    assert "EqualTo(b,2)" in plan


def test_reports_are_kept_passed_or_not(spark, csv, out):
    path = csv("a,b,c\n1,2,3\n")
    read_table(spark, path, ABC, report_path=out("reports"))
    wider = StructType([*ABC.fields, StructField("d", StringType())])
    with pytest.raises(ContractError):
        read_table(spark, path, wider, report_path=out("reports"))
    kept = spark.read.json(out("reports")).select("status", F.concat_ws(",", "missing_columns"))
    assert rows(kept) == [("FAILED", "d"), ("PASSED", "")]


def test_spread_rows_of_files_that_cannot_be_split(spark, tmp_path):
    rng = random.Random(1)
    lines = "".join(f'{i},"x\ny{i}",{rng.randbytes(200).hex()}\n' for i in range(40_000))
    (tmp_path / "one.csv").write_text("a,b,c\n" + lines)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "100kb")
    try:
        whole = read_table(spark, str(tmp_path / "one.csv"), ABC, ReadOptions(multiline=True))
        spread = read_table(spark, str(tmp_path / "one.csv"), ABC, ReadOptions(multiline=True, spread=True))
        whole.write.parquet(str(tmp_path / "whole"))
        spread.write.parquet(str(tmp_path / "spread"))
        assert len(list((tmp_path / "whole").glob("*.parquet"))) == 1
        assert len(list((tmp_path / "spread").glob("*.parquet"))) > 4
        assert rows(whole) == rows(spread)
    finally:
        spark.conf.set(size, before)
