"""The quota tree over many sources."""

import time

import pytest
from pyspark.sql import functions as F

from cleargrist.llm import mixing


def quotas(spark, values):
    rows = spark.createDataFrame(list(enumerate(values)), "rank long, quota long")
    return rows.repartition(3)


@pytest.mark.parametrize("bits", [1, 2, 5])
@pytest.mark.parametrize("values", [[7], [0, 0], [5, 0, 12, 3], [40, 1, 1, 1, 1, 90, 3, 0, 17]])
def test_shards_share_all_quotas_evenly(spark, monkeypatch, bits, values):
    monkeypatch.setattr(mixing, "FAN_BITS", bits)
    cuts = {r["rank"]: r["cuts"] for r in mixing.split_quotas(quotas(spark, values), 3, 7).collect()}
    assert {k: c[-1] for k, c in cuts.items()} == dict(enumerate(values))
    assert all(len(c) == 8 and c == sorted(c) for c in cuts.values())
    shards = [sum(c[i] - (c[i - 1] if i else 0) for c in cuts.values()) for i in range(8)]
    assert max(shards) - min(shards) <= 1
    again = {r["rank"]: r["cuts"] for r in mixing.split_quotas(quotas(spark, values), 3, 7).collect()}
    assert again == cuts


def test_ranges_draw_as_one_draw_would(spark, monkeypatch):
    """Mean and spread of a source's share of the left half, over many seeds."""
    monkeypatch.setattr(mixing, "FAN_BITS", 1)
    values = [30, 10, 20, 40, 25]
    source = quotas(spark, values)
    seen = []
    for seed in range(16):
        cuts = {r["rank"]: r["cuts"] for r in mixing.split_quotas(source, 1, seed).collect()}
        seen.append([cuts[i][0] for i in range(5)])
    total = sum(values)
    for i, n in enumerate(values):
        got = [s[i] for s in seen]
        mean = sum(got) / len(got)
        spread = (n / 2 * (1 - n / total) * 0.5 * total / (total - 1)) ** 0.5
        assert abs(mean - n * 63 / total) < 4.5 * spread / len(got) ** 0.5
        assert 0.3 * spread < (sum((x - mean) ** 2 for x in got) / len(got)) ** 0.5 < 2 * spread


def test_thousands_of_sources_take_seconds(spark):
    rows = quotas(spark, [1 + i % 50 for i in range(3000)])
    started = time.monotonic()
    found = mixing.split_quotas(rows, 4, 7)
    assert found.agg(F.sum(F.element_at("cuts", -1))).first()[0] == sum(1 + i % 50 for i in range(3000))
    assert time.monotonic() - started < 60


def test_taken_words_are_those_of_the_drawn_blocks(spark):
    """Every document's ``taken`` from its place in its source and the blocks drawn there."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mixture = mixing.mix(docs, shards=4, least_blocks=60, seed=7)
    source = mixture.sources.select(
        F.col("source").alias("of"), "quota", "n_blocks", F.pmod(F.xxhash64(F.lit(7), "source"), F.greatest("n_blocks", F.lit(1))).alias("shift")
    )
    rows = mixture.documents.join(source, F.col("source").eqNullSafe(F.col("of")))
    rows = rows.withColumn("order", F.xxhash64(F.lit(7), "doc_id", "key")).collect()
    n_docs = {}
    for r in rows:
        n_docs[r["source"]] = n_docs.get(r["source"], 0) + 1
    assert max(n_docs.values()) < 2000  # so each source is one bucket, in the order of the hash
    start = {}
    for r in sorted(rows, key=lambda r: (r["order"], r["doc_id"], r["key"])):
        low = start.get(r["source"], 0)
        high = start[r["source"]] = low + r["size"]
        n, total, taken = r["n_blocks"], r["source_size"], 0
        for block in range(n):
            first, end = block * total // n, (block + 1) * total // n
            times = sum(turn * n + (block + r["shift"]) % n < r["quota"] for turn in range(4))
            taken += times * max(0, min(high, end) - max(low, first))
        assert r["taken"] == taken
    assert sum(r["taken"] for r in rows) > 0
