import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cleargrist.functions import all_null, any_null, normalize_text, tolerant_double, tolerant_int


def one_column(spark, values):
    schema = StructType([StructField("v", StringType())])
    return spark.createDataFrame([(v,) for v in values], schema)


def results(spark, values, expression):
    frame = one_column(spark, values).select(F.col("v"), expression("v").alias("r"))
    return {row["v"]: row["r"] for row in frame.collect()}


@pytest.fixture
def ansi_off(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_normalize_text(spark):
    expected = {
        "  STEEL   bolt ": "Steel Bolt",
        "foo\tbar\nbaz": "Foo bar baz",
        "\tlead tab": "lead Tab",
        "a\x0bb\x0cc\rd": "A b c d",
        "o'neil-smith": "O'neil-smith",
        "50% off!": "50% Off!",
        "nbsp\u00a0stays": "Nbsp\u00a0stays",
        "em\u2003space": "Em\u2003space",
        "ßtraße": "Sstraße",
        "   ": "",
        "": "",
        None: None,
    }
    assert results(spark, list(expected), normalize_text) == expected


def test_normalize_text_is_null_exactly_where_the_input_is(spark):
    values = ["", " ", "\t", "x", "\u00a0", "ß", "\x00", None]
    out = results(spark, values, normalize_text)
    assert [v for v in values if out[v] is None] == [None]


INTS = {
    "12": 12,
    " 12 ": 12,
    "+12": 12,
    "-3": -3,
    "12.0": 12,
    "12.9": 12,
    "-12.9": -12,
    ".5": 0,
    "5.": 5,
    ".": 0,
    "-.": 0,
    "-": None,
    "+": None,
    "1e3": None,
    "abc": None,
    "": None,
    "   ": None,
    "1 2": None,
    "--1": None,
    "1.2.3": None,
    "2147483647": 2147483647,
    "2147483648": None,
    "-2147483648": -2147483648,
    "-2147483648.9": -2147483648,
    "99999999999999999999": None,
    "\t7\n": 7,
    "\x007\x7f": 7,
    "7\u00a0": None,
    "١٢": None,
    "1_000": None,
    None: None,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_tolerant_int(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert results(spark, list(INTS), tolerant_int) == INTS
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def random_strings(seed, count=20_000):
    rng = random.Random(seed)
    alphabet = "0123456789+-. eEdf\t\n\x00\x7fNaInity"
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 13))) for _ in range(count)] + [
        "".join(rng.choices("0123456789.+- ", k=rng.randint(0, 12))) for _ in range(count)
    ]


def assert_same_as_cast(spark, expression, kind):
    frame = one_column(spark, random_strings(kind) + list(INTS)).select(
        "v", expression("v").alias("ours"), F.col("v").cast(kind).alias("legacy")
    )
    differing = frame.filter(~F.col("ours").eqNullSafe(F.col("legacy")))
    assert differing.collect() == []
    assert frame.filter("legacy is not null").count() > 1000


def test_tolerant_int_equals_the_cast_without_ansi(spark, ansi_off):
    assert_same_as_cast(spark, tolerant_int, "int")


def test_tolerant_double_equals_the_cast_without_ansi(spark, ansi_off):
    assert_same_as_cast(spark, tolerant_double, "double")


def test_tolerant_double(spark):
    expected = {
        "12": 12.0,
        " 12.5 ": 12.5,
        "1e3": 1000.0,
        "1.5d": 1.5,
        "1.5f": 1.5,
        "-.5": -0.5,
        "5.": 5.0,
        "Infinity": float("inf"),
        "-inf": float("-inf"),
        "+INFINITY": float("inf"),
        "n/a": None,
        "1_000": None,
        "1,5": None,
        ".": None,
        "": None,
        None: None,
    }
    assert results(spark, list(expected), tolerant_double) == expected
    for text in ("NaN", " nan "):
        value = results(spark, [text], tolerant_double)[text]
        assert value != value


def test_null_predicates(spark):
    rows = [(None, None), (None, "x"), ("x", "x")]
    frame = spark.createDataFrame(rows, "`a.b` string, c string").select(
        all_null(["a.b", "c"]).alias("every"),
        any_null(["a.b", "c"]).alias("some"),
        all_null([]).alias("none_asked_all"),
        any_null([]).alias("none_asked_any"),
    )
    assert [tuple(r) for r in frame.collect()] == [
        (True, True, True, False),
        (False, True, True, False),
        (False, False, True, False),
    ]


@pytest.mark.parametrize("end", ["\u0085", "\u2028", "\u2029"])
def test_line_ends_beyond_ascii_are_no_part_of_a_number(spark, end):
    frame = spark.createDataFrame([(f"12.5{end}",), (f".5{end}",), (f"12{end}",), ("12\n",)], "v string")
    assert [r[0] for r in frame.select(tolerant_int("v")).collect()] == [None, None, None, 12]
