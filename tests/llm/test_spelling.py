"""Spelling variants against a plain model, and at their edges."""

import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
import brute
from cleargrist.llm import spelling_variants as sv
from cleargrist.llm.tables import stored

SF_DIR = "/root/testdata/sf0.001"


def found(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = contract.queries()["op11_spelling_variants"](spark, SF_DIR)
    assert found(rows) == brute.spelling_variants(docs)


def misspelt(seed, words):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abeéßÿo") for _ in range(rng.randint(7, 11))) for _ in range(40)]
    out = []
    for _ in range(words):
        w = stems[int(rng.random() ** 3 * len(stems))]
        if rng.random() < 0.2:
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "x", w[at] + "é"]) + w[at + 1 :]
        out.append(w.upper() if rng.random() < 0.1 else w)
    return " ".join(out)


def test_many_variants_and_chains(frame):
    texts = [(i, misspelt(i, 400)) for i in range(20)]
    # Chains of forms: each word a hundred times as frequent as the one before.
    texts += [(50, "abcdefg " * 2 + "abcdefgh " * 40 + "abcdefghi " * 900 + "abcdefghij " * 20000)]
    expected = brute.spelling_variants(texts)
    assert expected["abcdefg"][1] == "abcdefghij"
    assert found(sv.group_variants(frame(texts), drop_every=31)) == expected


def test_edges(frame):
    texts = [
        (1, None),
        (2, ""),
        (3, " \n12345678 "),
        (None, "Straße STRAßE straßen Straßen"),
        (None, None),
        (4, "ÀÉÎÕÜß× ÀÉÎÕÜß÷ ÀÉÎÕÜß× ÀÉÎÕÜß÷ ÀÉÎÕÜßx"),
        (5, "aaaaaaa aaaaaaaa aaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa"),
        (5, "aaaaaaa aaaaaaaa aaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa"),
        (6, "kitchen kitchen😀kitchens kitchens Ā kitchin Ākitchin"),
    ]
    assert found(sv.group_variants(frame(texts))) == brute.spelling_variants(texts, every=None)
    assert found(sv.group_variants(frame(texts), drop_every=3)) == brute.spelling_variants(texts, every=3)
    assert found(sv.group_variants(frame([(1, "x")]).limit(0))) == {}
    with pytest.raises(ValueError, match="circles"):
        sv.group_variants(frame(texts), ratio=1)


def test_very_long_words(frame):
    texts = [(1, "a" * 200_000), (2, "a" * 200_000), (3, "a" * 199_999 + " " + "a" * 199_999)]
    texts += [(4, "b" * 80 + " " + "b" * 79 + "c " + "b" * 80 + " " + "b" * 79 + "c")]
    rows = found(sv.group_variants(frame(texts)))
    assert {len(w): (r[2], r[3]) for w, r in rows.items() if w[0] == "a"} == {200_000: (2, 1), 199_999: (2, 1)}
    assert [r[3] for w, r in rows.items() if w[0] == "b"] == [1, 1]


def test_filters_in_passes(spark, frame):
    texts = [(i, misspelt(i, 300)) for i in range(10)]
    vocabulary = stored(sv.count_words(frame(texts)), "vocabulary")
    whole = sorted(map(tuple, sv.near_words(vocabulary).collect()))
    # Parts of two blocks, one part at a time.
    assert sorted(map(tuple, sv.near_words(vocabulary, 1, part_blocks=8).collect())) == whole
    assert len(whole) > 30


def test_crc32s():
    rng = random.Random(1)
    spans = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 500]))) for _ in range(300)]
    seeds = [zlib.crc32(str(i).encode()) for i in range(300)]
    ends = np.cumsum([len(s) for s in spans])
    starts = ends - [len(s) for s in spans]
    data = np.frombuffer(b"".join(spans), np.uint8)
    actual = sv.crc32s(np.array(seeds, np.uint32), data, starts, ends)
    assert actual.tolist() == [zlib.crc32(s, seed) for s, seed in zip(spans, seeds, strict=True)]
