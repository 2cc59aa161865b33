"""The registered queries over whole tables, against plain models."""

import zlib
from collections import defaultdict
from pathlib import Path

import pytest

import __spark_entry__ as contract
import brute
from cleargrist.llm import token_counts
from cleargrist.llm.queries import VOCABULARY

SF_DIR = "/root/testdata/sf0.001"


def run(spark, name, sf_dir=SF_DIR):
    return contract.queries()[name](spark, sf_dir).collect()


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source")
    return [tuple(r) for r in rows.collect()]


def compare(rows, columns, expected):
    actual = {r["doc_id"]: tuple(r[c] for c in columns.split()) for r in rows}
    assert len(actual) == len(rows)
    assert actual == expected


def spans_query(rows, docs, kinds, rules):
    columns = " ".join(f"n_{k}" for k in kinds) + " base_sha256"
    expected, listed = {}, {}
    for i, text, _ in docs:
        spans, n = brute.matches(text, rules)
        expected[i] = (*n, brute.sha(spans))
        listed[i] = [s for s in spans.split(",") if s]
    compare(rows, columns, expected)
    for r in rows:
        assert set(listed[r["doc_id"]]) <= set(r["spans"].split(","))


def test_secret_scan(spark, docs):
    rows = run(spark, "op1_secret_scan")
    spans_query(rows, docs, ["assign", "access", "hex"], brute.SECRETS)


def test_personal_data(spark, docs):
    rows = run(spark, "op9_personal_data")
    spans_query(rows, docs, ["email", "ip", "card", "phone"], brute.PERSONAL)


def labelled(spark, sf_dir):
    return {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}


def test_quality_classifier_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = run(spark, "op2_quality_classifier", sf_dir)
    labels = labelled(spark, sf_dir)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = [p for p, label in held if label]
    bad = [p for p, label in held if not label]
    assert sum(good) / len(good) > 0.98
    assert sum(bad) / len(bad) < 0.15


def test_line_dedup(spark, docs):
    expected = brute.line_dedup([t for _, t, _ in docs])
    expected = {d[0]: (*e[:2], brute.sha(e[2])) for d, e in zip(docs, expected, strict=True)}
    compare(run(spark, "op3_line_dedup"), "n_lines n_dropped kept_sha256", expected)


def test_token_counts(spark, docs):
    encoding = token_counts._encoder(Path(VOCABULARY).read_bytes(), token_counts.PATTERN).pieces
    expected = {}
    for i, text, _ in docs:
        found = brute.token_counts(text or "", encoding, brute.line_sections(text or ""), "most")
        expected.update({(i, n): c for n, c in found.items()})
    rows = run(spark, "op4_token_counts")
    assert {(r["doc_id"], r["section"]): (r["n_tokens"], r["n_crossing"]) for r in rows} == expected
    assert len(rows) == len(expected)


def test_near_dedup(spark, docs):
    found = brute.near_dedup([d[:2] for d in docs], 4)
    expected = {i: (n, root, root == i) for i, (n, root) in found.items()}
    compare(run(spark, "op5_near_dedup"), "n_shingles component_id kept", expected)


def test_substring_dedup(spark, docs):
    expected = brute.substring_dedup([t for _, t, _ in docs], 200)
    expected = {d[0]: (*e[:3], brute.sha(e[3])) for d, e in zip(docs, expected, strict=True)}
    compare(run(spark, "op6_substring_dedup"), "n_bytes n_removed n_spans kept_sha256", expected)


def test_decontamination(spark, docs):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    found = brute.decontamination([t for _, t, _ in docs], [(r["item_id"], r["text"]) for r in items])
    expected = {
        d[0]: (n, len(hit), len(names), brute.sha(",".join(sorted(names))), bool(hit))
        for d, (n, hit, names) in zip(docs, found, strict=True)
    }
    compare(run(spark, "op7_decontamination"), "n_words n_hit n_items items_sha256 contaminated", expected)


def test_mixing(spark, docs):
    rows = run(spark, "op8_mixing")
    size = {i: len(brute.WORD.findall(t or "")) for i, t, _ in docs}
    source = {i: s for i, _, s in docs}
    totals = defaultdict(int)
    for i, s in source.items():
        totals[s] += size[i]
    targets = brute.mixture_targets(totals)
    taken = defaultdict(int)
    for r in rows:
        own = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], totals[own])
        assert r["target"] == pytest.approx(targets[own])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[own] += r["taken"]
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 0.002 * totals[s] + 4
    assert sorted(rows) == sorted(run(spark, "op8_mixing"))


def test_quality_rules(spark, docs):
    rows = run(spark, "op10_quality_rules")
    columns = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed"
    compare(rows, columns, {i: brute.statistics(t) for i, t, _ in docs})
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_quality_rules_follow_the_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = labelled(spark, sf_dir)
    rows = [r for r in run(spark, "op10_quality_rules", sf_dir) if not r["base_failed"]]
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and r["doc_id"] in labels]
    right = sum(r["kept"] == bool(labels[r["doc_id"]]) for r in held)
    assert right / len(held) > 0.99


def test_quality_rules_decide_as_a_walk_through_the_trees(spark, docs):
    """Every verdict from features counted one text at a time and trees walked node by node."""
    import math

    from cleargrist.llm import quality_rules
    from cleargrist.llm.queries import labels
    from cleargrist.llm.tables import documents

    trees = quality_rules.fit(documents(spark, SF_DIR), labels(spark, SF_DIR))
    rated = {r["doc_id"]: r for r in run(spark, "op10_quality_rules")}
    for i, text, _ in docs:
        row, total = brute.document_features(text), trees.start
        for at in trees.roots.tolist():
            while trees.feature[at] >= 0:
                at = int(trees.left[at] + (row[trees.feature[at]] > trees.threshold[at]))
            total += trees.value[at]
        score = 1 / (1 + math.exp(-total))
        assert rated[i]["score"] == pytest.approx(score)
        assert rated[i]["kept"] == (score >= 0.5 and not rated[i]["base_failed"])
