"""The whole job against a row-by-row model on random dirty rows."""

import random
import re
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from cleargrist import CleaningRules, CurationOptions, ReadOptions, curate, write_table

COLUMNS = ("key", "id", "name", "group", "price", "rare")
SCHEMA = StructType([StructField(c, StringType()) for c in COLUMNS])
RULES = CleaningRules(
    text=("name", "group"),
    integers=("id",),
    doubles=("price",),
    required=("id", "name", "group"),
    output=("key", "id", "name", "group", "price", "rare"),
)


def random_rows(seed, count=3000):
    rng = random.Random(seed)
    ids = ["7", " 8 ", "9.9", "-4.", ".5", "x", "", "1e3", "99999999999", None]
    names = ["steel  BOLT", " a\tb\nc ", "o'neil-smith", "   ", "quo\"ted, field", "", None]
    prices = ["n/a", "", None, "1.005", "2.675", "-0.125", "100", " 3.10 ", "0.01", "0.02"]
    return [
        (
            str(i),
            rng.choice(ids),
            rng.choice(names),
            "hot" if i % 3 == 0 else rng.choice(["HOT ", "cold  One", "Warm\ntwo", None]),
            rng.choice(prices),
            "here" if rng.random() < 0.05 else None,
        )
        for i in range(count)
    ]


def model_text(text):
    if text is None:
        return None
    titled = " ".join(word[:1].upper() + word[1:].lower() for word in text.split(" "))
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", titled).strip(" ")


def model_int(text):
    match = re.fullmatch(r"\s*([+-]?)([0-9]*)(\.[0-9]*)?\s*", text or "")
    if not match or not (match[2] or match[3]):
        return None
    number = int(match[1] + (match[2] or "0"))
    return number if -(2**31) <= number < 2**31 else None


def model_double(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def two_places(value):
    return float(Decimal(value).quantize(Decimal("0.01"), ROUND_HALF_UP))


def model(raw, keep_empty):
    """Valid rows, quarantine and statistics; an empty CSV field reads as missing."""
    if not keep_empty:
        raw = [tuple(v or None for v in row) for row in raw]
    valid, quarantine, groups = [], [], defaultdict(list)
    for row in raw:
        key, id_, name, group, price, _ = row
        cleaned = (model_int(id_), model_text(name), model_text(group))
        if None in cleaned:
            quarantine.append((*row, "N"))
            continue
        valid.append((key, *cleaned, model_double(price)))
        groups[cleaned[1:]].append(model_double(price))
    stats = []
    for names, prices in groups.items():
        known = [Decimal(repr(p)) for p in prices if p is not None]
        measures = (sum(known) / len(known), min(known), max(known)) if known else (None,) * 3
        rounded = (None if m is None else two_places(m) for m in measures)
        stats.append((*names, len(prices), *rounded))
    return valid, quarantine, stats


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("fmt", ["csv", "parquet"])
@pytest.mark.parametrize("checkpoint", [None, "kept"])
def test_curate(spark, out, seed, fmt, checkpoint):
    raw = random_rows(seed)
    write_table(spark.createDataFrame(raw, SCHEMA), out("in"), fmt)
    result = curate(
        spark,
        CurationOptions(
            out("in"),
            out("clean"),
            out("quarantine"),
            out("stats"),
            read=ReadOptions(fmt=fmt, multiline=fmt == "csv"),
            contract=SCHEMA,
            rules=RULES,
            stats_keys=("name_cleaned", "group_cleaned"),
            stats_value="price_cleaned",
            stats_partition="group_cleaned",
            checkpoint_path=out(checkpoint) if checkpoint else None,
        ),
    )
    valid, quarantine, stats = model(raw, keep_empty=fmt == "parquet")
    assert ordered(result.clean.drop("ingestion_time").collect()) == ordered(valid)
    assert ordered(result.quarantine.collect()) == ordered(quarantine)
    summary = result.summary.first()
    assert summary["columns_removed_due_to_nulls"] == ["rare"]
    assert (summary["valid_rows"], summary["invalid_rows"]) == (len(valid), len(quarantine))
    actual = {tuple(r)[:2]: tuple(r)[2:] for r in result.stats.collect()}
    expected = {row[:2]: row[2:] for row in stats}
    assert actual.keys() == expected.keys()
    for key, (count, average, low, high) in expected.items():
        assert actual[key][0] == count
        # Of the measures, only a plain average may miss a rounding tie.
        assert actual[key][1] == pytest.approx(average, abs=0.0101)
        assert actual[key][2:] == (low, high)
