"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL-proximal updates.

Tokens are runs of letters, of digits or of marks. Features are the hashes of single tokens, of
pairs of tokens, and of triples of token shapes (how a word is cased, digits, or the marks
themselves), each weighted by its share among the features of its kind; and one word each for
how long the text is, how many of its triples repeat and how many tokens follow their like. A
score is the logistic function of one sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrist.llm import arrays as A
from cleargrist.llm.tables import batch, held_out, keyed, rows_between, training_rows

_UPPER = A.byte_table(bytes(range(ord("A"), ord("Z") + 1)))
_LETTER = _UPPER | A.byte_table(bytes(range(ord("a"), ord("z") + 1))) | (np.arange(256) >= 128)
_DIGIT = A.byte_table(b"0123456789")
_MARK = ~(_LETTER | _DIGIT | A.SPACE)


@dataclass(frozen=True)
class Features:
    """Of a block: the row, slot and value of each feature, ordered by row, repeats included."""

    rows: np.ndarray
    slots: np.ndarray
    values: np.ndarray


def features(block: A.Block, dims: int) -> Features:
    n = len(block)
    kinds = [A.runs(block, table) for table in (_LETTER, _DIGIT, _MARK)]
    starts = np.concatenate([k.starts for k in kinds])
    ends = np.concatenate([k.ends for k in kinds])
    rows = np.concatenate([k.rows for k in kinds])
    kind = np.repeat(np.arange(3, dtype=np.uint64), [len(k.starts) for k in kinds])
    order = np.argsort(starts, kind="stable")
    starts, ends, rows, kind = starts[order], ends[order], rows[order], kind[order]

    words = A.Hasher(A.LOWER[block.data])(starts, ends)
    upper = np.concatenate([[0], np.cumsum(_UPPER[block.data])])
    n_upper = upper[ends] - upper[starts]
    cased = np.minimum(n_upper, 1) + (n_upper > 1) + (n_upper == ends - starts)
    shapes = A.mix(np.where(kind == 2, words, kind * np.uint64(8) + cased.astype(np.uint64)))

    found_rows, found, values = [], [], []
    groups = [(words, rows)]
    for hashes, size in ((words, 2), (shapes, 3)):
        grams, firsts = A.n_grams(hashes, rows, size)
        groups.append((grams, rows[firsts]))
    for salt, (hashes, own) in enumerate(groups):
        found_rows.append(own)
        found.append(A.mix(hashes + np.uint64(salt)))
        values.append((1 / np.maximum(A.counts(own, n), 1))[own])

    triples, firsts = A.n_grams(words, rows, 3)
    own = rows[firsts]
    again = A.repeated(A.mix(triples + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    share = A.counts(own[again], n) / np.maximum(A.counts(own, n), 1)
    after = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    twice = A.counts(rows[1:][after], n) / np.maximum(A.counts(rows, n), 1)
    length = np.log2(A.counts(rows, n) + 1)
    levels = ((11, np.ceil(share * 10)), (12, np.ceil(twice * 10)), (13, length), (14, length * 0))
    for salt, level in levels:
        found_rows.append(np.arange(n))
        found.append(A.mix(level.astype(np.uint64) + np.uint64(salt << 32)))
        values.append(np.full(n, 0.1))
    slots = np.concatenate(found) % np.uint64(dims)
    all_rows = np.concatenate(found_rows)
    order = np.argsort(all_rows, kind="stable")
    return Features(
        all_rows[order], slots[order].astype(np.int64), np.concatenate(values)[order] * 10
    )


def train_rows(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    dims: int,
    epochs: int,
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
) -> np.ndarray:
    """Weights after FTRL-proximal updates over (slots, values, label) in the order given."""
    z, n = np.zeros(dims), np.zeros(dims)

    def weights(at) -> np.ndarray:
        rate = (beta + np.sqrt(n[at])) / alpha + l2
        return np.where(np.abs(z[at]) <= l1, 0.0, (np.sign(z[at]) * l1 - z[at]) / rate)

    for _ in range(epochs):
        for slots, values, label in examples:
            w = weights(slots)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            sigma = (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / alpha
            z[slots] += g - sigma * w
            n[slots] += g * g
    return weights(slice(None))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = 20_000,
    dims: int = 1 << 18,
    shards: int = 8,
    epochs: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 1e-4,
    l2: float = 1e-4,
) -> np.ndarray:
    """Weights of a 0/1 label, ``dims`` floats, from at most ``max_rows`` rows of the fold.

    The rows are dealt to ``shards`` tasks by a hash of their id; each runs the online updates
    over its own rows, and the weights of the tasks that had rows are averaged, in the order of the
    shards. A task holds the distinct features of ``max_rows / shards`` texts. Without any labelled row
    all weights are zero, so scores are 0.5.
    """
    rows = training_rows(docs, labels, id_col, text_col, label_col, max_rows)
    rank = F.xxhash64("id", "text")
    rows = rows.select("text", "label", rank.alias("rank"), F.pmod(rank, F.lit(shards)).alias("shard"))
    names = pa.schema(
        [
            ("shard", pa.int64()),
            ("rank", pa.int64()),
            ("label", pa.int32()),
            ("slots", pa.list_(pa.int32())),
            ("values", pa.list_(pa.float32())),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                found = features(block, dims)
                key, where = np.unique(found.rows * dims + found.slots, return_inverse=True)
                sums = np.bincount(where, found.values, len(key)).astype(np.float32)
                cuts = np.searchsorted(key, np.arange(len(block) + 1) * dims).astype(np.int32)
                slots = pa.array((key % dims).astype(np.int32))
                yield batch(
                    names,
                    [
                        *(
                            rows_between(source, c, block.first, len(block))
                            for c in ("shard", "rank", "label")
                        ),
                        pa.ListArray.from_arrays(cuts, slots),
                        pa.ListArray.from_arrays(cuts, pa.array(sums)),
                    ],
                )

    def train(table: pa.Table) -> pa.Table:
        order = np.argsort(table["rank"].to_numpy(), kind="stable")
        labels_, slots, values = (table[c].combine_chunks() for c in ("label", "slots", "values"))
        examples = [
            (slots[i].values.to_numpy(), values[i].values.to_numpy(), labels_[i].as_py())
            for i in map(int, order)
        ]
        weights = train_rows(examples, dims, epochs, alpha, beta, l1, l2)
        at = np.flatnonzero(weights)
        shard = np.full(len(at) + 1, table["shard"][0].as_py())
        # The first row says that the shard had rows, whatever its weights.
        slot = np.concatenate([[-1], at]).astype(np.int32)
        return pa.table({"shard": shard, "slot": slot, "weight": np.concatenate([[1.0], weights[at]])})

    encoded = rows.mapInArrow(
        encode, "shard long, rank long, label int, slots array<int>, values array<float>"
    )
    trained = encoded.groupBy("shard").applyInArrow(train, "shard long, slot int, weight double")
    # At most one row for each of the dims slots, and as many numbers in it as there are shards.
    listed = F.array_sort(F.collect_list(F.struct("shard", "weight")))
    total = F.aggregate(listed, F.lit(0.0), lambda a, x: a + x["weight"])
    sums = trained.groupBy("slot").agg(total.alias("weight")).toArrow()
    slots, found = sums["slot"].to_numpy(), sums["weight"].to_numpy()
    weights = np.zeros(dims, np.float32)
    weights[slots[slots >= 0]] = found[slots >= 0] / max(1.0, found[slots < 0].sum())
    return weights


def score_documents(
    docs: DataFrame,
    weights: np.ndarray,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_score: float = 0.7,
) -> DataFrame:
    """One row per document: ``score`` between 0 and 1, and ``predicted`` 1 from ``min_score``.

    ``held_out`` tells the rows that training never sees. A null or empty text has only the
    length and repetition words; repeated rows are scored each for itself; columns other than
    the two named are not read; an empty table gives an empty table. The weights are a fixed
    number of floats, a megabyte by default, and broadcast.
    """
    dims = len(weights)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                found = features(block, dims)
                margin = A.counts(
                    found.rows, len(block), found.values * shared.value[found.slots]
                )
                ids = rows_between(source, "id", block.first, len(block))
                scores = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(scores)], ["id", "score"])

    rows = keyed(docs, id_col, text_col).select("id", "text")
    id_type = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"id {id_type}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= min_score, 1).otherwise(0).alias("predicted"),
    )
