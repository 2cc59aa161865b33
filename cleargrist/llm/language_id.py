"""Language identification by a byte convolutional network, in numpy.

Bytes are embedded, filters of several widths slide over a window of fixed length, each filter's
largest value in the window is kept (max pooling), and a softmax layer turns those into one
probability per language. A text is cut into windows, all of it; its probabilities are the means of
its windows', weighted by their length.

The network is trained by Adam on windows of a bounded sample of labelled texts. For scoring, what
two neighbouring bytes add to each filter is tabulated once, so that a filter's value is the sum of
two table rows, whatever its width.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cleargrist.llm import arrays as A
from cleargrist.llm.tables import rows_between

UNKNOWN = "und"
WINDOW = 256
#: Widths of the filters, the widest first; at most four bytes.
WIDTHS = (4, 3, 2)
_REACH = max(WIDTHS)
_WINDOWS_AT_ONCE = 32
_PARTS = 64


def fold(id_col: Column, n: int = 5) -> Column:
    """Whether an id is held out: crc32 of its text is divisible by n. A null id is not."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % n == 0, F.lit(False))


def windows(block: A.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and length of each window of a block's texts."""
    sizes = block.ends - block.starts
    n = -(-sizes // WINDOW)
    rows = np.repeat(np.arange(len(block)), n)
    first = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    starts = block.starts[rows] + first * WINDOW
    return rows, starts, np.minimum(block.ends[rows] - starts, WINDOW)


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Windows as rows of bytes, with what the widest filter reaches beyond them; zeros after the text."""
    at = starts[:, None] + np.arange(WINDOW + _REACH - 1)
    inside = at < ends[:, None]
    return np.where(inside, data[np.minimum(at, len(data) - 1)], 0) if len(data) else at * 0


@dataclass(frozen=True)
class Network:
    """Weights: bytes x channels, offset x channels x filters, and filters x languages."""

    languages: tuple[str, ...]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray
    _pairs: list[np.ndarray] = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pairs": []}

    def tables(self) -> np.ndarray:
        """What a byte adds to each filter at each offset."""
        return np.einsum("be,jef->jbf", self.embedding, self.filters)

    def _pair_tables(self) -> list[np.ndarray]:
        if not self._pairs:
            own = self.tables()
            wide = own.shape[2] * sum(w > 2 for w in WIDTHS) // len(WIDTHS)
            for low, n in ((0, own.shape[2]), (2, wide)):
                both = own[low, :, None, :n] + own[low + 1, None, :, :n]
                self._pairs.append(both.reshape(1 << 16, n))
        return self._pairs

    def pooled(self, bytes_: np.ndarray) -> np.ndarray:
        """Per window, each filter's largest value."""
        near, far = self._pair_tables()
        out = np.empty((len(bytes_), near.shape[1]), np.float32)
        pairs = (bytes_[:, :-1].astype(np.int32) << 8) | bytes_[:, 1:]
        for low in range(0, len(bytes_), _WINDOWS_AT_ONCE):
            own = pairs[low : low + _WINDOWS_AT_ONCE]
            z = near[own[:, :WINDOW]]
            z[:, :, : far.shape[1]] += far[own[:, 2 : WINDOW + 2]]
            z.max(axis=1, out=out[low : low + _WINDOWS_AT_ONCE])
        return out

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        return _softmax(np.maximum(pooled + self.bias, 0) @ self.dense + self.offset)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    bytes_: np.ndarray,
    labels: np.ndarray,
    languages: tuple[str, ...],
    channels: int,
    n_filters: int,
    epochs: int,
    rate: float,
) -> Network:
    """A network after some epochs of Adam over windows and the numbers of their languages."""
    rng = np.random.default_rng(0)
    n_all, c = n_filters * len(WIDTHS), len(languages)
    widths = np.repeat(WIDTHS, n_filters)
    used = (np.arange(_REACH)[:, None] < widths).astype(np.float32)  # offset x filter
    params = [
        rng.normal(0, 0.5, (256, channels)),
        rng.normal(0, 0.3, (_REACH, channels, n_all)) * used[:, None, :],
        np.zeros(n_all),
        rng.normal(0, 0.2, (n_all, c)),
        np.zeros(c),
    ]
    params = [p.astype(np.float32) for p in params]
    means, squares = ([np.zeros_like(p) for p in params] for _ in range(2))
    # Every third window is cut short, so that short texts are known too.
    bytes_ = bytes_.copy()
    short = np.arange(len(bytes_)) % 3 == 0
    limits = rng.integers(12, WINDOW, len(bytes_))
    bytes_[short[:, None] & (np.arange(bytes_.shape[1]) >= limits[:, None])] = 0
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bytes_))
        for low in range(0, len(order), 64):
            at = order[low : low + 64]
            x, n = bytes_[at], len(at)
            net = Network(languages, *params)
            tables = net.tables()
            z = sum(tables[j][x[:, j : j + WINDOW]] for j in range(_REACH))
            place = z.argmax(axis=1)
            pooled = np.take_along_axis(z, place[:, None, :], axis=1)[:, 0] + params[2]
            active = np.maximum(pooled, 0)
            error = _softmax(active @ params[3] + params[4])
            error[np.arange(n), labels[at]] -= 1
            error /= n
            back = (error @ params[3].T) * (pooled > 0)
            filters = np.arange(n_all)
            d_tables = np.zeros((_REACH, 256, n_all), np.float32)
            for j in range(_REACH):
                seen = x[np.arange(n)[:, None], place + j]
                slots = (seen.astype(np.int64) * n_all + filters).ravel()
                sums = np.bincount(slots, (back * used[j]).ravel(), 256 * n_all)
                d_tables[j] = sums.reshape(256, n_all)
            grads = [
                np.einsum("jbf,jef->be", d_tables, params[1]),
                np.einsum("be,jbf->jef", params[0], d_tables),
                back.sum(axis=0),
                active.T @ error,
                error.sum(axis=0),
            ]
            step += 1
            for p, g, m, v in zip(params, grads, means, squares, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(languages, *params)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 5,
    max_rows: int = 2_400,
    windows_per_row: int = 3,
    max_languages: int = 256,
    channels: int = 8,
    n_filters: int = 16,
    epochs: int = 12,
    rate: float = 5e-3,
) -> Network | None:
    """A network for the most frequent ``max_languages`` values of ``lang``, or None without any.

    It learns from at most ``max_rows`` rows outside the held-out fold, the same number of every
    language, those of the smallest hashes; and from ``windows_per_row`` windows of each, evenly
    spaced over the text. The driver gets these windows, two megabytes by default, and trains on
    them. Rows with a null id or language, or with a text that is null or has no letter, are not learned
    from; of rows that repeat one counts.
    """
    rows = docs.select(
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")).alias("key"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        (F.col(f"`{id_col}`").isNotNull() & ~fold(F.col(f"`{id_col}`"), folds)).alias("learn"),
    )
    rows = rows.filter(F.col("learn") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = rows.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(max_languages)
    languages = tuple(sorted(r["lang"] for r in known.collect()))
    if not languages:
        return None
    each = max(1, max_rows // len(languages))
    # In two steps, since a language may have most rows: the smallest keys of each of its parts first.
    chosen = rows.filter(F.col("lang").isin(*languages)).select("lang", "key").distinct()
    chosen = chosen.withColumn("part", F.pmod("key", F.lit(_PARTS)))
    for columns in (("lang", "part"), ("lang",)):
        order = Window.partitionBy(*columns).orderBy("key")
        chosen = chosen.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= each)
    chosen = chosen.select("lang", "key")  # max_rows rows at most
    sample = rows.join(F.broadcast(chosen), ["lang", "key"]).groupBy("lang", "key")
    sample = sample.agg(F.min("text").alias("text"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                size = block.ends - block.starts
                rows_ = np.repeat(np.arange(len(block)), windows_per_row)
                share = np.tile(np.arange(windows_per_row), len(block)) / max(1, windows_per_row - 1)
                starts = block.starts[rows_] + (share * np.maximum(size - WINDOW, 0)[rows_]).astype(int)
                found = cut(block.data, starts, block.ends[rows_]).astype(np.uint8)
                own = rows_between(source, "lang", block.first, len(block)).take(pa.array(rows_))
                keys = rows_between(source, "key", block.first, len(block)).take(pa.array(rows_))
                packed = pa.array([w.tobytes() for w in found], pa.binary())
                yield pa.RecordBatch.from_arrays([own, keys, packed], ["lang", "key", "window"])

    picked = sample.mapInArrow(pick, "lang string, key long, window binary").toArrow()
    picked = picked.sort_by([("key", "ascending"), ("lang", "ascending"), ("window", "ascending")])
    bytes_ = np.frombuffer(b"".join(picked["window"].to_pylist()), np.uint8)
    number = {lang: i for i, lang in enumerate(languages)}
    labels = np.array([number[lang] for lang in picked["lang"].to_pylist()])
    bytes_ = bytes_.reshape(len(labels), WINDOW + _REACH - 1)
    return train(bytes_, labels, languages, channels, n_filters, epochs, rate)


def identify(
    docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text", folds: int = 5
) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred`` and ``score``, its probability.

    A text that is null, empty or without a letter is ``und`` with a score of 0, as is every text if
    there is no network. All windows of a text count, however long it is; they are scored a few
    thousand bytes at a time. Repeated rows are scored each for itself, columns other than the two
    named are not read, and an empty table gives an empty table.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.when(text.rlike(r"\p{L}"), text).alias("text"),
    )
    if network is None:
        unknown = rows.select("id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        return _named(unknown, id_col, folds)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        names = np.array([*net.languages, UNKNOWN], object)
        for source in batches:
            for block in A.blocks(source.column("text")):
                n, c = len(block), len(net.languages)
                own, starts, sizes = windows(block)
                total = np.zeros((n, c))
                for low in range(0, len(own), 512):
                    part = slice(low, low + 512)
                    found = cut(block.data, starts[part], block.ends[own[part]])
                    p = net.probabilities(net.pooled(found)) * sizes[part, None]
                    np.add.at(total, own[part], p)
                weight = np.maximum(block.ends - block.starts, 1)
                best = total.argmax(axis=1)
                scores = np.minimum(total[np.arange(n), best] / weight, 1.0)
                best[block.ends == block.starts] = c
                ids = rows_between(source, "id", block.first, n)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(names[best], pa.string()), pa.array(scores, pa.float64())],
                    ["id", "lang_pred", "score"],
                )

    id_type = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"id {id_type}, lang_pred string, score double")
    return _named(scored, id_col, folds)


def _named(scored: DataFrame, id_col: str, folds: int) -> DataFrame:
    return scored.select(
        F.col("id").alias(id_col), fold(F.col("id"), folds).alias("held_out"), "lang_pred", "score"
    )
