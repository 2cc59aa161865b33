import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from cleargrist import group_states, merge_states, price_stats, stats_of_states


def stats(spark, rows, **options):
    frame = spark.createDataFrame(rows, "k string, v double")
    return {r["k"]: tuple(r)[1:] for r in price_stats(frame, ["k"], "v", **options).collect()}


def test_rounds_half_up_on_the_shortest_decimal(spark):
    out = stats(spark, [("a", 2.675), ("b", 1.005), ("c", -0.125), ("d", 0.125)])
    assert out["a"] == (1, 2.68, 2.68, 2.68)
    assert out["b"] == (1, 1.01, 1.01, 1.01)
    assert out["c"] == (1, -0.13, -0.13, -0.13)
    assert out["d"] == (1, 0.13, 0.13, 0.13)


@pytest.mark.parametrize("exact", [False, True])
def test_nulls_and_nan(spark, exact):
    rows = [(None, 1.0), (None, None), ("n", None), ("x", 1.0), ("x", math.nan), ("i", math.inf), ("i", 2.0)]
    out = stats(spark, rows, exact=exact)
    assert out[None] == (2, 1.0, 1.0, 1.0)
    assert out["n"] == (1, None, None, None)
    count, average, low, high = out["x"]
    assert (count, low) == (2, 1.0) and math.isnan(average) and math.isnan(high)
    assert out["i"] == (2, math.inf, 2.0, math.inf)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_exact_average_is_the_true_one_half_up(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_exact_average(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def check_exact_average(spark):
    rng = random.Random(5)
    rows = [(f"g{i % 400}", rng.randint(-10**7, 10**7) / 100) for i in range(10_000)]
    rows += [("large", rng.randint(-10**15, 10**15) / 100) for _ in range(999)]
    rows += [("tie", 0.01), ("tie", 0.02), ("negative tie", -0.01), ("negative tie", -0.02), ("zero", 0.0)]
    out = stats(spark, rows, exact=True)
    groups = {}
    for key, value in rows:
        groups.setdefault(key, []).append(Decimal(repr(value)))
    for key, values in groups.items():
        mean = sum(values) / len(values)
        assert out[key][1] == float(mean.quantize(Decimal("0.01"), ROUND_HALF_UP)), key


def test_exact_average_of_other_values_is_the_plain_one(spark):
    rows = [("thirds", 1 / 3), ("thirds", 2.0), ("huge", 1e20), ("huge", 3e20), ("low", -1e300)]
    assert stats(spark, rows, exact=True) == stats(spark, rows)


def test_sums_beyond_64_bits_are_exact(spark):
    rows = [("a", 9e13)] * 1100 + [("b", 8e13 + i * 0.25) for i in range(295)]
    rows += [("c", -(8e13 + i * 0.25)) for i in range(295)]
    out = stats(spark, rows, exact=True)
    assert out["a"][1] == 9e13
    mean = sum(Decimal(80000000000000) + i * Decimal("0.25") for i in range(295)) / 295
    rounded = float(mean.quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert (out["b"][1], out["c"][1]) == (rounded, -rounded)


def test_other_scale(spark):
    assert stats(spark, [("a", 1.2345), ("a", 1.2346)], scale=4, exact=True)["a"] == (2, 1.2346, 1.2345, 1.2346)


def test_one_shuffle_after_partial_aggregation(spark):
    frame = price_stats(spark.createDataFrame([("a", 1.0)], "k string, v double"), ["k"], "v", exact=True)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan and "partial_avg" in plan


VALUES = [("a", 1.005), ("a", 2.675), ("a", None), ("b", 1e17), ("b", 0.25), ("c", None), ("d", 0.1234), ("d", float("nan")), (None, -0.125)]


@pytest.mark.parametrize("exact", [True, False])
def test_merged_states_are_the_statistics_of_all_rows(spark, exact):
    frame = spark.createDataFrame(VALUES * 3, "k string, v double")
    parts = [spark.createDataFrame(VALUES[i::2] * 3, "k string, v double") for i in range(2)]
    one, two = (group_states(p, ["k"], "v") for p in parts)
    merged = merge_states(merge_states(one.unionByName(two), ["k"]), ["k"])
    actual = stats_of_states(merged, ["k"], exact)
    expected = price_stats(frame, ["k"], "v", exact)
    assert actual.dtypes == expected.dtypes
    assert sorted(map(repr, actual.collect())) == sorted(map(repr, expected.collect()))


def test_merging_sums_exactly(spark):
    """Sums beyond 2^53 of cents, in parts that a double would round."""
    rows = [("a", 2.0**45 + 0.25 * i) for i in range(64)]
    parts = [group_states(spark.createDataFrame(rows[i::8], "k string, v double"), ["k"], "v") for i in range(8)]
    states = parts[0]
    for part in parts[1:]:
        states = states.unionByName(part)
    stats = stats_of_states(merge_states(states, ["k"]), ["k"], exact=True).first()
    assert stats["avg_price"] == round(2.0**45 + 0.25 * 63 / 2, 2)


def test_states_of_other_types_and_odd_keys(spark):
    frame = spark.createDataFrame([(1, 2), (1, 3), (None, 4)], "`a.b` int, n int")
    stats = stats_of_states(group_states(frame, ["a.b"], "n"), ["a.b"])
    assert sorted(map(repr, stats.collect())) == sorted(map(repr, price_stats(frame, ["a.b"], "n").collect()))
    with pytest.raises(ValueError, match="group_state"):
        group_states(frame.withColumnRenamed("n", "group_state"), ["group_state"], "a.b")
