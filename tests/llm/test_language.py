"""Language identification: held-out accuracy, windows, and the edges."""

import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
from cleargrist.llm import arrays as A
from cleargrist.llm import language_id as li


@pytest.fixture(scope="module")
def network(spark):
    return li.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = contract.queries()["op13_language_id"](spark, sf_dir).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and sum(held) / len(held) > 0.99


def test_labels_are_no_input(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    held = li.fold(F.col("doc_id"))
    other = docs.withColumns(
        {"lang": F.when(held, "xx").otherwise(F.col("lang")), "source": F.lit("s")}
    )
    own, changed = (li.fit(d, epochs=1) for d in (docs, other))
    assert own.languages == changed.languages
    assert np.array_equal(own.embedding, changed.embedding)


def test_edges(frame, network):
    prose = "Ist der die einütz eine von enberein einverlich geheit sich lichäkeit. "
    texts = [
        (1, None),
        (2, ""),
        (3, " 123 --- \n"),
        (4, "é"),
        (None, prose),
        (None, None),
        (5, prose * 5),
        (5, prose * 5),
        (6, prose * 20_000),
        (7, "\u0000\u0000" + prose),
    ]
    rows = li.identify(frame(texts), network).collect()
    assert len(rows) == len(texts)
    for r in rows:
        blank = r["doc_id"] in (1, 2, 3) or (r["doc_id"] is None and r["score"] == 0)
        assert (r["lang_pred"] == "und") == blank and 0 <= r["score"] <= 1
    same = {tuple(r) for r in rows if r["doc_id"] == 5}
    assert len(same) == 1 and same.pop()[2] == "de"
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert li.identify(frame(texts).limit(0), network).count() == 0


def test_without_labels(frame):
    from pyspark.sql import functions as F

    docs = frame([(1, "some text"), (2, None)])
    for table in (docs.withColumn("lang", F.lit(None).cast("string")), docs.withColumn("lang", F.lit("en")).limit(0)):
        assert li.fit(table) is None
    rows = li.identify(docs, None).collect()
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in rows} == {(1, "und", 0.0), (2, "und", 0.0)}


def test_windows_cover_whole_texts():
    texts = [b"", b"a" * li.WINDOW, b"b" * (li.WINDOW * 3 + 1), b"c"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    block = A.Block(0, data, ends - [len(t) for t in texts], ends)
    rows, starts, sizes = li.windows(block)
    assert rows.tolist() == [1, 2, 2, 2, 2, 3]
    assert np.bincount(rows, sizes).tolist() == [0, li.WINDOW, li.WINDOW * 3 + 1, 1]
    found = li.cut(block.data, starts, block.ends[rows])
    assert found.shape == (6, li.WINDOW + 3)
    assert [bytes(w[:s].astype(np.uint8)) for w, s in zip(found, sizes, strict=True)][4] == b"b"
    assert (found[4, 1:] == 0).all() and (found[5, 1:] == 0).all()


def test_pooling_is_the_convolution(network):
    """The tables give what sliding the filters over the embedded bytes gives."""
    rng = np.random.default_rng(1)
    bytes_ = rng.integers(0, 256, (3, li.WINDOW + 3))
    embedded = network.embedding[bytes_]
    full = np.stack(
        [np.einsum("wje,jef->wf", embedded[:, i : i + 4], network.filters) for i in range(li.WINDOW)], 1
    )
    assert np.allclose(network.pooled(bytes_), full.max(axis=1), atol=1e-4)
    widths = np.repeat(li.WIDTHS, network.filters.shape[2] // len(li.WIDTHS))
    assert all(not network.filters[j, :, widths <= j].any() for j in range(4))
