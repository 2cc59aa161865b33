import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cleargrist import ReadOptions, read_table, write_jdbc, write_table
from cleargrist.sinks.writers import partitioned_schema, restore_keys
from cleargrist.sources.tables import KEEP_NUL

ABC = StructType([StructField(c, StringType()) for c in ("a", "b", "c")])
TRICKY = [
    ('a "q" b', "  padded  ", "x"),
    ("line\nbreak", "comma, inside", "back\\slash"),
    ("crlf\r\nhere", "\ttab", 'quote at end"'),
    (None, "b", "c"),
    ("'", '"', "\\"),
    ("ßé日本", "\u00a0", "1"),
]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv", "CSV"])
def test_round_trip(spark, out, fmt):
    write_table(spark.createDataFrame(TRICKY, ABC), out("t"), fmt)
    read = read_table(spark, out("t"), ABC, ReadOptions(fmt=fmt, check=False, multiline=fmt.lower() == "csv"))
    assert rows(read) == sorted(TRICKY, key=repr)


@pytest.mark.parametrize(
    ("fmt", "codec", "suffix"),
    [("csv", "gzip", ".csv.gz"), ("json", "gzip", ".json.gz"), ("parquet", "zstd", ".zstd.parquet")],
)
def test_writer_options_are_passed_on(spark, out, fmt, codec, suffix):
    frame = spark.createDataFrame([("1", "2", "3")], ABC)
    write_table(frame, out("t"), fmt, options={"compression": codec})
    assert any(p.name.endswith(suffix) for p in Path(out("t")).iterdir())
    assert rows(read_table(spark, out("t"), ABC, ReadOptions(fmt=fmt))) == [("1", "2", "3")]


def test_csv_turns_empty_text_into_null(spark, out):
    write_table(spark.createDataFrame([("", " ", "x")], ABC), out("t"), "csv")
    assert rows(read_table(spark, out("t"), ABC)) == [(None, " ", "x")]


def test_csv_can_keep_nul_characters(spark, out):
    data = [('a\x00"b', "\x00", ",\x00")]
    write_table(spark.createDataFrame(data, ABC), out("t"), "csv")
    assert rows(read_table(spark, out("t"), ABC, ReadOptions(multiline=True, extra=KEEP_NUL))) == data


def test_random_text_survives_csv(spark, out):
    rng = random.Random(3)
    alphabet = '",\n\r\\ \t\'a\x00#b; \x0b\x0c\u00a0\ufeff|'
    cells = ["".join(rng.choices(alphabet, k=rng.randint(1, 6))) for _ in range(9_000)]
    data = sorted(zip(*[iter(cells)] * 3), key=repr)
    write_table(spark.createDataFrame(data, ABC), out("t"), "csv")
    assert rows(read_table(spark, out("t"), ABC, ReadOptions(multiline=True, extra=KEEP_NUL))) == data


def test_csv_has_a_header(spark, out):
    write_table(spark.createDataFrame([("1", "2", "3")], ABC).coalesce(1), out("t"), "csv")
    (file,) = Path(out("t")).glob("*.csv")
    assert file.read_text() == "a,b,c\n1,2,3\n"


def test_modes(spark, out):
    frame = spark.range(3)
    write_table(frame, out("t"))
    write_table(frame, out("t"))
    assert spark.read.parquet(out("t")).count() == 3
    write_table(frame, out("t"), mode="append")
    assert spark.read.parquet(out("t")).count() == 6
    write_table(frame, out("t"), mode="ignore")
    assert spark.read.parquet(out("t")).count() == 6
    with pytest.raises(AnalysisException):
        write_table(frame, out("t"), mode="errorifexists")


def test_unknown_format_raises_before_any_write(spark, out):
    with pytest.raises(ValueError, match="unsupported format 'xlsx'"):
        write_table(spark.range(1), out("t"), "xlsx")
    assert not Path(out("t")).exists()


def test_a_failed_write_raises(spark, out):
    bad = spark.range(1).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no"):
        write_table(bad, out("t"))


PARTITION_KEYS = ["1", "01", None, "A/B: c", "2024-01-01"]


def test_partition_values(spark, out):
    frame = spark.createDataFrame([(k, str(i)) for i, k in enumerate(PARTITION_KEYS)], "k string, v string")
    write_table(frame, out("t"), partition_by="k")
    read = read_table(spark, out("t"), frame.schema, ReadOptions(fmt="parquet", check=False))
    assert read.columns == ["k", "v"]
    assert rows(read) == rows(frame)


def test_an_empty_partition_key_is_refused_or_kept(spark, out):
    frame = spark.createDataFrame([("", 1, "x"), ("a", 2, "y"), (None, 3, "z")], "k string, n int, v string")
    with pytest.raises(Exception, match="empty text in partition column k"):
        write_table(frame, out("t"), partition_by="k")
    write_table(frame, out("u"), partition_by=["k", "n"], key_copies=True)
    schema = partitioned_schema(frame.schema, ["k", "n"])
    read = read_table(spark, out("u"), schema, ReadOptions(fmt="parquet", check=False))
    assert rows(restore_keys(read, ["k", "n"])) == rows(frame)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_blank_and_missing_keys_stay_apart(spark, out, fmt):
    data = [("", "1"), (None, "2"), ("=", "3"), ("a", "4"), (" ", "5")]
    frame = spark.createDataFrame(data, "k string, v string")
    write_table(frame, out("t"), fmt, partition_by="k", key_copies=True)
    schema = partitioned_schema(frame.schema, ["k"])
    read = read_table(spark, out("t"), schema, ReadOptions(fmt=fmt, check=False))
    assert rows(restore_keys(read, ["k"]).select("k", "v")) == sorted(data, key=repr)


def test_a_column_named_like_a_copy_is_refused(spark, out):
    frame = spark.createDataFrame([("data", "precious", 1)], "cat string, cat_key string, n int")
    with pytest.raises(ValueError, match="cat_key"):
        write_table(frame, out("t"), partition_by="cat", key_copies=True)
    assert not Path(out("t")).exists()
    write_table(frame, out("u"), partition_by="cat")
    assert spark.read.parquet(out("u")).first()["cat_key"] == "precious"


def test_restoring_drops_only_what_was_added(spark, out):
    frame = spark.createDataFrame([("a", 1, "own")], "k string, n int, n_key string")
    write_table(frame, out("t"), partition_by=["k", "n"], key_copies=True)
    schema = partitioned_schema(frame.schema, ["k", "n"])
    read = read_table(spark, out("t"), schema, ReadOptions(fmt="parquet", check=False))
    assert rows(restore_keys(read, ["k", "n"]).select("k", "n", "n_key")) == rows(frame)


def test_rebalancing_needs_adaptive_execution(spark, out):
    frame = spark.createDataFrame([("a", 1)], "k string, n int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError, match="adaptive"):
            write_table(frame, out("t"), partition_by="k")
        write_table(frame, out("t"), partition_by="k", rebalance=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_partition_by_two_columns(spark, out):
    frame = spark.createDataFrame([("x", "1", "p"), ("y", "2", "q")], ABC)
    write_table(frame, out("t"), partition_by=["a", "b"])
    assert {p.name for p in Path(out("t")).glob("a=*")} == {"a=x", "a=y"}
    assert {p.name for p in Path(out("t")).glob("a=x/*")} == {"b=1"}
    assert rows(spark.read.schema(ABC).parquet(out("t")).select("a", "b", "c")) == [("x", "1", "p"), ("y", "2", "q")]


def test_partition_by_an_odd_name(spark, out):
    frame = spark.createDataFrame([("x", "1"), ("y", "2")], "`Unnamed: 0` string, v string")
    write_table(frame, out("t"), partition_by="Unnamed: 0")
    read = read_table(spark, out("t"), frame.schema, ReadOptions(fmt="parquet", check=False))
    assert rows(read) == [("x", "1"), ("y", "2")]


def test_few_files_per_small_partition(spark, out):
    frame = spark.range(0, 20_000, 1, 16).select((F.col("id") % 10).cast("string").alias("k"), "id")
    write_table(frame, out("t"), partition_by="k")
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in Path(out("t")).glob("k=*"))


def test_no_shuffle_when_told_so(spark, out):
    frame = spark.range(0, 400, 1, 4).select((F.col("id") % 2).cast("string").alias("k"), "id")
    write_table(frame, out("t"), partition_by="k", rebalance=False)
    assert [len(list(p.glob("*.parquet"))) for p in Path(out("t")).glob("k=*")] == [4, 4]


def test_a_hot_partition_is_written_by_several_tasks(spark, out):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "200kb")
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string"))
        frame = spark.range(0, 300_000, 1, 16).select(hot.alias("k"), F.uuid().alias("v"))
        write_table(frame, out("t"), partition_by="k")
    finally:
        spark.conf.set(size, before)
    assert len(list(Path(out("t")).glob("k=hot/*.parquet"))) > 3
    assert spark.read.parquet(out("t")).filter("k = 'hot'").count() == 100_000
    assert spark.read.parquet(out("t")).count() == 300_000


def test_jdbc_passes_everything_on():
    """Without a database: the call that reaches Spark's writer."""
    calls = []
    frame = SimpleNamespace(write=SimpleNamespace(jdbc=lambda **kw: calls.append(kw)))
    write_jdbc(frame, "jdbc:x://h/d", "t", properties={"user": "u"}, connections=8)
    write_jdbc(frame, "jdbc:x://h/d", "t", mode="append")
    assert calls == [
        {
            "url": "jdbc:x://h/d",
            "table": "t",
            "mode": "overwrite",
            "properties": {"user": "u", "numPartitions": "8"},
        },
        {"url": "jdbc:x://h/d", "table": "t", "mode": "append", "properties": {}},
    ]


def test_jdbc_failure_raises(spark):
    with pytest.raises(Exception, match="[Nn]o suitable driver"):
        write_jdbc(spark.range(1), "jdbc:nosuchdatabase://h/d", "t")
