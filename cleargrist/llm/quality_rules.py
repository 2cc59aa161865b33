"""Quality rules: gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled rows and flattened into numpy node arrays;
documents are scored in Arrow tasks, a block of texts at a time. Statistics listed in
``DECREASING`` can only lower a score: a split on one of them is refused if it would put the
higher value on the side of the larger values, and the children keep to that side's bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrist.llm import arrays as A
from cleargrist.llm.tables import batch, keyed, rows_between, training_rows

SYMBOLS = A.byte_table(b"#*$%&|<>")
UPPER = A.byte_table(bytes(range(ord("A"), ord("Z") + 1)))
DIGITS = A.byte_table(b"0123456789")
LETTERS = UPPER | A.byte_table(bytes(range(ord("a"), ord("z") + 1))) | (np.arange(256) >= 128)
MARKS = ~(LETTERS | DIGITS | A.SPACE | SYMBOLS)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words",
    "word_length",
    "symbols_per_word",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "distinct_share",
    "words_per_line",
    "short_line_share",
    "longest_word",
)
DECREASING = ("symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "mark_share")


def statistics(block: A.Block) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts of each text, and the matrix of FEATURES.

    Words are runs outside space, tab, LF, VT, FF and CR. A line is repeated if it holds a word
    and equals an earlier line of its text; a word is repeated if it lies in a window of three
    words that occurs twice or more in the text.
    """
    n = len(block)
    words = A.runs(block, A.WORD)
    hasher = A.Hasher(block.data)
    hashes = hasher(words.starts, words.ends)
    n_words = A.counts(words.rows, n)

    def bytes_of(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[block.data])])
        return total[block.ends] - total[block.starts]

    word_chars = bytes_of(A.LEAD & A.WORD)

    grams, firsts = A.n_grams(hashes, words.rows, 3)
    own = A.mix(grams + words.rows[firsts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    again = firsts[A.repeated(own)]
    covered = np.zeros(len(hashes), bool)
    for shift in range(3):
        covered[again + shift] = True

    lines = A.lines(block)
    first_word = np.searchsorted(words.starts, lines.starts)
    after_word = np.searchsorted(words.starts, lines.ends)
    line_words = after_word - first_word
    full = np.flatnonzero(line_words > 0)
    rows = lines.rows[full]
    keys = hasher(lines.starts[full], lines.ends[full])
    order = np.lexsort((keys, rows))
    same = (keys[order[1:]] == keys[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
    n_dup = A.counts(rows[order[1:]][same], n)

    base = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": bytes_of(SYMBOLS),
        "n_dup_lines": n_dup,
        "n_repeat_words": A.counts(words.rows[covered], n),
    }
    lengths = words.ends - words.starts
    longest = np.zeros(n)
    np.maximum.at(longest, words.rows, lengths)
    pairs = np.lexsort((hashes, words.rows))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[pairs[1:]] != hashes[pairs[:-1]]) | (
        words.rows[pairs[1:]] != words.rows[pairs[:-1]]
    )
    n_distinct = A.counts(words.rows[pairs[fresh]], n)
    n_lines = np.maximum(A.counts(rows, n), 1)
    short = A.counts(rows[line_words[full] < 3], n)
    per_word = np.maximum(n_words, 1)
    chars = np.maximum(word_chars, 1)
    features = np.column_stack(
        [
            np.log1p(n_words),
            word_chars / per_word,
            base["n_symbols"] / per_word,
            n_dup / n_lines,
            base["n_repeat_words"] / per_word,
            bytes_of(UPPER) / chars,
            bytes_of(DIGITS) / chars,
            bytes_of(MARKS) / chars,
            n_distinct / per_word,
            n_words / n_lines,
            short / n_lines,
            np.log1p(longest),
        ]
    )
    return base, features


@dataclass(frozen=True)
class Trees:
    """Flattened trees: node arrays of all trees, one after the other, and where each begins.

    An inner node sends a value of at most its threshold to ``left``, else to ``left + 1``; a
    leaf has feature -1 and points at itself.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all trees at once, a level at a time."""
        n = len(features)
        at = np.broadcast_to(self.roots, (n, len(self.roots))).copy()
        row = np.arange(n)[:, None]
        for _ in range(self.depth):
            feature = self.feature[at]
            inner = feature >= 0
            beyond = features[row, np.maximum(feature, 0)] > self.threshold[at]
            at = np.where(inner, self.left[at] + beyond, at)
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit_trees(
    features: np.ndarray,
    labels: np.ndarray,
    n_trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    n_bins: int = 64,
    ridge: float = 2.0,
    min_rows: float = 10,
    decreasing: tuple[int, ...] = tuple(FEATURES.index(c) for c in DECREASING),
) -> Trees:
    """Second-order boosting of the logistic loss over histograms of binned statistics.

    Without rows, or with one label only, the trees are single leaves and the score is the
    smoothed share of label 1.
    """
    n, width = features.shape
    share = (labels.sum() + 1) / (n + 2)
    start = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    roots = []
    edges = [
        np.unique(np.quantile(features[:, f], np.linspace(0, 1, n_bins + 1)[1:-1]))
        if n
        else np.zeros(0)
        for f in range(width)
    ]
    binned = np.column_stack(
        [np.searchsorted(edges[f], features[:, f], side="left") for f in range(width)]
    )
    margin = np.full(n, start)
    grow = 0 < labels.sum() < n
    for _ in range(n_trees if grow else 0):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = labels - p, np.maximum(p * (1 - p), 1e-9)
        roots.append(len(nodes))
        nodes.append([-1, 0.0, len(nodes), 0.0])
        level = [(roots[-1], np.arange(n), -np.inf, np.inf)]
        for d in range(depth + 1):
            below = []
            for node, rows, low, high in level:
                g, h = gradient[rows], hessian[rows]
                value = float(np.clip(g.sum() / (h.sum() + ridge), low, high))
                nodes[node][3] = rate * value
                best = None
                if d < depth and len(rows) >= 2 * min_rows:
                    best = _best_split(
                        binned[rows], g, h, edges, ridge, min_rows, decreasing, low, high
                    )
                if best is None:
                    margin[rows] += rate * value
                    continue
                f, cut, left_value, right_value = best
                right = binned[rows, f] > cut
                first = len(nodes)
                nodes[node][:3] = [f, float(edges[f][cut]), first]
                nodes.extend([[-1, 0.0, first, 0.0], [-1, 0.0, first + 1, 0.0]])
                left_low = right_low = low
                left_high = right_high = high
                if f in decreasing:
                    left_low = right_high = (left_value + right_value) / 2
                below.append((first, rows[~right], left_low, left_high))
                below.append((first + 1, rows[right], right_low, right_high))
            level = below
    table = np.array(nodes).reshape(-1, 4)
    return Trees(
        table[:, 0].astype(np.int32),
        table[:, 1],
        table[:, 2].astype(np.int32),
        # The sum over trees runs over leaves only, where the walk ends.
        table[:, 3],
        np.array(roots, np.int32),
        depth,
        start,
    )


def _best_split(binned, g, h, edges, ridge, min_rows, decreasing, low, high):
    """(feature, bin, left value, right value) of the split that gains most, or None."""
    total_g, total_h = g.sum(), h.sum()
    best, found = 1e-6, None
    for f in range(binned.shape[1]):
        size = len(edges[f]) + 1
        if size < 2:
            continue
        of = binned[:, f]
        left_g = np.cumsum(np.bincount(of, g, size))[:-1]
        left_h = np.cumsum(np.bincount(of, h, size))[:-1]
        left_n = np.cumsum(np.bincount(of, minlength=size))[:-1]
        left = np.clip(left_g / (left_h + ridge), low, high)
        right = np.clip((total_g - left_g) / (total_h - left_h + ridge), low, high)
        gain = left_g**2 / (left_h + ridge) + (total_g - left_g) ** 2 / (total_h - left_h + ridge)
        gain = gain - total_g**2 / (total_h + ridge)
        allowed = (left_n >= min_rows) & (len(of) - left_n >= min_rows)
        if f in decreasing:
            allowed &= left >= right
        gain = np.where(allowed, gain, -np.inf)
        cut = int(np.argmax(gain))
        if gain[cut] > best:
            best, found = gain[cut], (f, cut, float(left[cut]), float(right[cut]))
    return found


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = 20_000,
) -> Trees:
    """Trees for a 0/1 label, fitted on at most ``max_rows`` rows outside the held-out fold.

    Executors compute the statistics; the driver gets one short row of numbers for each of the
    ``max_rows`` texts (some 2 MB) and fits the trees in seconds.
    """
    rows = training_rows(docs, labels, id_col, text_col, label_col, max_rows)
    schema = ", ".join(f"{c} double" for c in (*FEATURES, "label")) + ", id_hash long"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.schema([*((c, pa.float64()) for c in (*FEATURES, "label"))])
        names = names.append(pa.field("id_hash", pa.int64()))
        for source in batches:
            for block in A.blocks(source.column("text")):
                _, features = statistics(block)
                label = rows_between(source, "label", block.first, len(block))
                rank = rows_between(source, "id_hash", block.first, len(block))
                yield batch(names, [*features.T, label.cast(pa.float64()), rank])

    ranked = rows.select("text", "label", F.xxhash64("id", "text").alias("id_hash"))
    table = ranked.mapInArrow(measure, schema).toArrow()
    order = np.argsort(table["id_hash"].to_numpy(), kind="stable")
    matrix = np.column_stack([table[c].to_numpy() for c in FEATURES])[order]
    return fit_trees(matrix, table["label"].to_numpy()[order])


def rate_documents(
    docs: DataFrame,
    trees: Trees,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_score: float = 0.5,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    keep_columns: bool = False,
) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, ``score`` and ``kept``.

    A document fails the base rules with fewer than ``min_words`` words or with more than
    ``max_repeat_percent`` percent of repeated words; otherwise it is kept if its score reaches
    ``min_score``. A null text counts as empty, so it fails; rows with equal ids are rated each
    for itself; an empty table gives an empty table. With ``keep_columns`` the input rows that
    are kept come back as they were, and nothing else.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(trees)

    def verdicts(source: pa.RecordBatch, column: str):
        for block in A.blocks(source.column(column)):
            base, features = statistics(block)
            failed = (base["n_words"] < min_words) | (
                100 * base["n_repeat_words"] > max_repeat_percent * base["n_words"]
            )
            score = shared.value.score(features)
            yield block, base, failed, score, ~failed & (score >= min_score)

    if keep_columns:

        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for source in batches:
                for block, *_, keep in verdicts(source, text_col):
                    yield source.slice(block.first, len(block)).filter(pa.array(keep))

        return docs.mapInArrow(kept, docs.schema)

    rows = keyed(docs, id_col, text_col).select("id", "text")
    names = pa.schema(
        [
            *((c, pa.int64()) for c in BASE),
            ("base_failed", pa.bool_()),
            ("score", pa.float64()),
            ("kept", pa.bool_()),
        ]
    )
    schema = ", ".join(f"{c} long" for c in BASE)
    schema += ", base_failed boolean, score double, kept boolean"

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block, base, failed, score, keep in verdicts(source, "text"):
                out = batch(names, [*(base[c] for c in BASE), failed, score, keep])
                ids = rows_between(source, "id", block.first, len(block))
                yield pa.RecordBatch.from_arrays([ids, *out.columns], names=["id", *out.schema.names])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(rate, f"id {id_type}, {schema}").withColumnRenamed("id", id_col)
