"""Hard negatives by exact search over Hilbert-ordered blocks with zone maps.

Vectors become whole numbers, and rows are sorted by label and by their place on a Hilbert curve
through the dimensions of largest variance, then stored as blocks of some hundred rows: one Parquet
row per block, with its ids, labels and vectors packed, and the smallest and largest value of every
dimension and of the label as its zone map. For an anchor, interval arithmetic over a zone map
bounds the scores of all rows of a block from both sides. A block is read for an anchor only if the
bounds meet what is still asked for: a score as high as the fifth best positive so far, or one
inside a window around a positive. The bounds never exclude a row that counts, so results are exact.

Anchors are dealt into teams, and blocks lie in parts, both of bounded size. The zone maps alone
choose which blocks a team must read; a task then has one team and its chosen blocks of one part,
reads a block only for those anchors whose bounds still ask for it, and keeps their best rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cleargrist.llm.tables import batch, stored

BLOCK_ROWS = 512
_ANCHORS_PER_TEAM = 1 << 15
_ZONES_PER_GROUP = 1 << 14
_TILE = 2048
#: One part in so many is searched first.
_FIRST_SHARE = 16
_CURVE_DIMS, _CURVE_BITS = 15, 4
_MINED = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long,"
    " negative_score long"
)
_NEVER = np.iinfo(np.int64).min
#: Larger numbers count as not finite, so that scores of up to 128 dimensions fit 64 bits.
_LARGEST = 1 << 28


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places along a Hilbert curve of rows of whole numbers below 2^bits; dims * bits < 64."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(points), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where(x[-1] & q, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, -1, -1):
        for own in x:
            key = (key << 1) | ((own ^ turn) >> bit & 1)
    return key


def bounds(vectors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each vector with any point of each box."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return up @ lows.T + down @ highs.T, up @ highs.T + down @ lows.T


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Lists of numbers as rows, short ones filled up with zeros."""
    sizes = lists.value_lengths().to_numpy(False).astype(np.int64)
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy(False)
    return out


def _unpacked(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


class Best:
    """The best ``k`` (score, id) of each of n lists: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), _NEVER)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer each of some lists the scores of one row; ids ascend, _NEVER is no score."""
        k, n = self.scores.shape[1], len(ids)
        at = np.broadcast_to(np.arange(n), scores.shape)
        if n > k and np.abs(np.where(scores == _NEVER, 0, scores)).max(initial=0) < 2**62 // n:
            # One number that sorts by score, then by place; ~ turns the order round.
            keys = np.where(scores == _NEVER, _NEVER, scores * n + np.arange(n - 1, -1, -1))
            at = np.argpartition(~keys, k - 1, axis=1)[:, :k]
        both = np.concatenate([self.scores[rows], np.take_along_axis(scores, at, axis=1)], axis=1)
        both_ids = np.concatenate([self.ids[rows], ids[at]], axis=1)
        order = np.lexsort((both_ids, ~both), axis=1)[:, :k]
        self.scores[rows] = np.take_along_axis(both, order, axis=1)
        self.ids[rows] = np.take_along_axis(both_ids, order, axis=1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, place = np.nonzero(self.scores != _NEVER)
        return at, self.scores[at, place], self.ids[at, place]


def _numbers(rows: DataFrame, is_anchor: Column, scale: int, columns: tuple[str, str, str]) -> DataFrame:
    """The rows that take part: ``id``, ``label``, ``values`` and ``anchor``."""
    id_col, vector_col, label_col = (F.col(f"`{c}`") for c in columns)
    limit = F.lit(float(_LARGEST) / scale)
    fine = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < limit))
    values = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return rows.filter(id_col.isNotNull() & label_col.isNotNull() & fine).select(
        id_col.cast("long").alias("id"),
        label_col.cast("long").alias("label"),
        values.alias("values"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )


def _dimensions(rows: DataFrame) -> list:
    """Per dimension, by number: rows, sum, sum of squares, largest absolute value."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            values = source.column("values")
            dims = max(values.value_lengths().to_pylist(), default=0) or 0
            x = _matrix(values, dims).astype(float)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(dims)),
                    pa.array(np.full(dims, len(x))),
                    pa.array(x.sum(axis=0)),
                    pa.array((x * x).sum(axis=0)),
                    pa.array(np.abs(x).max(axis=0)),
                ],
                ["dim", "n", "total", "squares", "largest"],
            )

    schema = "dim long, n long, total double, squares double, largest double"
    sums = rows.select("values").mapInArrow(measure, schema).groupBy("dim")
    sums = sums.agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.sum("squares").alias("squares"),
        F.max("largest").alias("largest"),
    )
    return sorted(sums.collect())  # a row for each dimension


_BLOCKS = pa.schema(
    [
        ("block", pa.int64()),
        ("part", pa.int64()),
        ("low_label", pa.int64()),
        ("high_label", pa.int64()),
        ("lows", pa.binary()),
        ("highs", pa.binary()),
        ("ids", pa.binary()),
        ("labels", pa.binary()),
        ("anchors", pa.binary()),
        ("vectors", pa.binary()),
    ]
)
_BLOCK_COLUMNS = (
    "block long, part long, low_label long, high_label long, lows binary, highs binary,"
    " ids binary, labels binary, anchors binary, vectors binary"
)


def write_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """Blocks of the rows of ``_numbers`` in Hilbert order, as a stored table, and the dimensions.

    A block's number says which task has written it, and ``part`` which run of blocks it is in.
    """
    measured = _dimensions(rows)
    dims = max(1, len(measured))  # vectors without components are points at zero
    n = measured[0]["n"] if measured else 0
    total = max((r["n"] for r in measured), default=0)
    # Short vectors count as zeros: divide by all rows.
    means = np.array([r["total"] / total for r in measured] or [0.0])
    squares = np.array([r["squares"] / total for r in measured] or [0.0])
    spreads = np.sqrt(np.maximum(squares - means**2, 0) + 1e-9)
    chosen = np.sort(np.argsort(-spreads, kind="stable")[:_CURVE_DIMS])
    part_rows = min(1 << 18, max(8 * block_rows, n // 64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = (1 << _CURVE_BITS) - 1
        for source in batches:
            x = _matrix(source.column("values"), dims)
            scaled = (x[:, chosen] - means[chosen]) / spreads[chosen]
            cells = np.clip(np.floor((scaled + 2) / 4 * (top + 1)), 0, top)
            keys = hilbert_keys(cells, _CURVE_BITS)
            packed = [v.astype(np.int32).tobytes() for v in x]
            columns = [source.column(c) for c in ("id", "label", "anchor")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(keys), pa.array(packed, pa.binary())],
                ["id", "label", "anchor", "key", "vector"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        waiting: list[pa.RecordBatch] = []
        made = 0

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, made
            table = pa.Table.from_batches(waiting)
            while table.num_rows >= block_rows or (last and table.num_rows):
                head, table = table.slice(0, block_rows), table.slice(block_rows)
                # By id, so that of rows with equal scores the first one counts.
                head = head.sort_by("id")
                labels = head["label"].to_numpy()
                x = _unpacked(head["vector"], np.int32).reshape(len(labels), dims)
                yield batch(
                    _BLOCKS,
                    [
                        [task << 24 | made],
                        [task << 24 | made // max(1, part_rows // block_rows)],
                        [labels.min()],
                        [labels.max()],
                        [x.min(axis=0).tobytes()],
                        [x.max(axis=0).tobytes()],
                        [head["id"].to_numpy().tobytes()],
                        [labels.tobytes()],
                        [head["anchor"].to_numpy().tobytes()],
                        [x.tobytes()],
                    ],
                )
                made += 1
            waiting = table.to_batches()

        for source in batches:
            waiting.append(source)
            if sum(b.num_rows for b in waiting) >= block_rows:
                yield from blocks(False)
        if waiting:
            yield from blocks(True)

    placed = rows.mapInArrow(place, "id long, label long, anchor boolean, key long, vector binary")
    order = ("label", "key", "id")
    placed = placed.repartitionByRange(max(1, -(-n // part_rows)), *order)
    packed = placed.sortWithinPartitions(*order).mapInArrow(pack, _BLOCK_COLUMNS)
    return stored(packed, "vector-blocks"), dims


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products, exact: by floats as long as they hold them, else by whole numbers."""
    largest = [float(np.abs(x).max(initial=0)) for x in (left, right)]
    if largest[0] * largest[1] * left.shape[1] < 2.0**53:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def _anchors(blocks: DataFrame, dims: int, k: int) -> DataFrame:
    """Anchors with a score that their ``k``-th best positive has at least, from their own block."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for row in source.to_pylist():
                at = np.flatnonzero(np.frombuffer(row["anchors"], bool))
                if not len(at):
                    continue
                labels = np.frombuffer(row["labels"], np.int64)
                ids = np.frombuffer(row["ids"], np.int64)
                x = np.frombuffer(row["vectors"], np.int32).reshape(len(ids), dims)
                scores = _scores(x[at], x)
                scores[labels[at][:, None] != labels] = _NEVER
                scores[np.arange(len(at)), at] = _NEVER
                best = Best(len(at), k)
                best.add(np.arange(len(at)), scores, ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((row["block"] << 12) + at),
                        pa.array(ids[at]),
                        pa.array(labels[at]),
                        pa.array(best.scores[:, k - 1]),
                        pa.array([v.tobytes() for v in x[at]], pa.binary()),
                    ],
                    ["row", "id", "label", "floor", "vector"],
                )

    schema = "row long, id long, label long, floor long, vector binary"
    return blocks.select("block", "ids", "labels", "anchors", "vectors").mapInArrow(gather, schema)


class Wanted:
    """What the anchors of a group still ask for, and what has been found for them.

    Every anchor has some windows of scores, ``lows`` to ``highs``, over rows of its own label or
    of the others.
    """

    def __init__(self, anchors: pa.Table, dims: int, k: int, same: bool):
        self.rows = anchors["row"].to_numpy()
        self.labels = anchors["label"].to_numpy()
        self.vectors = _unpacked(anchors["vector"], np.int32).reshape(len(self.rows), dims)
        self.same = same
        windows = [_unpacked(anchors[c], np.int64).reshape(len(self.rows), -1) for c in ("lows", "highs")]
        self.lows, self.highs = windows
        n = self.lows.shape[1]
        self.best = [Best(len(self.rows), k) for _ in range(n)]

    def limits(self, zones: pa.Table, tile: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For anchors of a tile and blocks: least and largest score, and whether labels may fit."""
        dims = self.vectors.shape[1]
        lows, highs = (_unpacked(zones[c], np.int32).reshape(-1, dims).astype(float) for c in ("lows", "highs"))
        least, most = bounds(self.vectors[tile].astype(float), lows, highs)
        # A little more each way than floats of this size can be off.
        slack = (np.abs(least) + np.abs(most)) * 1e-12
        first, last = (zones[c].to_numpy() for c in ("low_label", "high_label"))
        own = self.labels[tile][:, None]
        labels = (own >= first) & (own <= last) if self.same else (own != first) | (own != last)
        return least - slack, most + slack, labels

    def asked(self, least: np.ndarray, most: np.ndarray, labels: np.ndarray, tile: slice) -> np.ndarray:
        """Whether a block may hold a row that an anchor still asks for."""
        asked = np.zeros(labels.shape, bool)
        for w, best in enumerate(self.best):
            low = np.maximum(self.lows[tile, w], best.scores[tile, -1])
            asked |= (most >= low[:, None]) & (least <= self.highs[tile, w][:, None])
        return asked & labels

    def read(self, block: dict, at: np.ndarray) -> None:
        """Score a block's rows for some anchors, given by their places."""
        ids = np.frombuffer(block["ids"], np.int64)
        labels = np.frombuffer(block["labels"], np.int64)
        x = np.frombuffer(block["vectors"], np.int32).reshape(len(ids), -1)
        scores = _scores(self.vectors[at], x)
        equal = self.labels[at][:, None] == labels
        allowed = equal if self.same else ~equal
        itself = self.rows[at] - (block["block"] << 12)
        inside = np.flatnonzero((itself >= 0) & (itself < len(ids)))
        allowed[inside, itself[inside]] = False
        for w, best in enumerate(self.best):
            low = np.maximum(self.lows[at, w], best.scores[at, -1])[:, None]
            fits = allowed & (scores >= low) & (scores <= self.highs[at, w][:, None])
            some = np.flatnonzero(fits.any(axis=1))
            if len(some):
                best.add(at[some], np.where(fits[some], scores[some], _NEVER), ids)

    def found(self) -> pa.Table:
        parts = [(w, *best.found()) for w, best in enumerate(self.best)]
        return pa.table(
            {
                "row": np.concatenate([self.rows[at] for _, at, _, _ in parts]),
                "window": np.concatenate([np.full(len(at), w, np.int32) for w, at, _, _ in parts]),
                "score": np.concatenate([s for _, _, s, _ in parts]),
                "other": np.concatenate([i for _, _, _, i in parts]),
            }
        )


_ZONE = ("block", "part", "low_label", "high_label", "lows", "highs")


def _tiles(n: int) -> Iterator[slice]:
    return (slice(low, min(low + _TILE, n)) for low in range(0, n, _TILE))


def search(
    blocks: DataFrame, anchors: DataFrame, dims: int, k: int, same: bool, n_anchors: int, n_blocks: int
) -> DataFrame:
    """The best ``k`` rows of each anchor's windows: ``row``, ``window``, ``rank``, ``score``, ``other``.

    ``anchors`` has ``row``, ``label``, ``vector``, ``lows`` and ``highs``, the last two packed and of
    one length for all. A share of the parts is searched first: what a window has found there is the
    least that rows of all other parts must score, so most of their blocks need not be read, and
    the rows that tasks report do not grow with the number of parts.
    """
    size = (dims, k, same, n_anchors, n_blocks)
    ahead = F.pmod(F.xxhash64("part", F.lit("first")), F.lit(_FIRST_SHARE)) == 0
    first = stored(_best(_found(blocks.filter(ahead), anchors, *size), k), "first-parts")
    known = F.map_from_entries(F.collect_list(F.struct("window", "score")))  # one for each window
    floors = first.filter(F.col("rank") == k).groupBy("row").agg(known.alias("floors"))
    raised = anchors.join(floors, "row", "left")

    def raise_lows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            lows = []
            for packed, floor in zip(source.column("lows").to_pylist(), source.column("floors").to_pylist(), strict=True):
                low = np.frombuffer(packed, np.int64).copy()
                for window, score in floor or ():
                    low[window] = max(low[window], score)
                lows.append(low.tobytes())
            kept = [source.column(c) for c in ("row", "label", "vector", "highs")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lows, pa.binary())], ["row", "label", "vector", "highs", "lows"])

    schema = "row long, label long, vector binary, highs binary, lows binary"
    columns = ("row", "label", "vector", "highs", "lows", "floors")
    raised = stored(raised.select(*columns).mapInArrow(raise_lows, schema), "raised-anchors")
    rest = _found(blocks.filter(~ahead), raised, *size)
    return _best(first.drop("rank").unionByName(rest), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "window").orderBy(F.col("score").desc(), "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _found(
    blocks: DataFrame, anchors: DataFrame, dims: int, k: int, same: bool, n_anchors: int, n_blocks: int
) -> DataFrame:
    """Rows (row, window, score, other): the best of each window in each part of the blocks."""
    teams, zone_groups = -(-n_anchors // _ANCHORS_PER_TEAM), -(-n_blocks // _ZONES_PER_GROUP)
    team = F.pmod(F.xxhash64("row"), F.lit(teams)).cast("int").alias("team")
    anchors = anchors.select("row", "label", "vector", "lows", "highs", team)

    def copies(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def choose(asking: pa.Table, zones: pa.Table) -> pa.Table:
        needed = np.zeros(zones.num_rows, bool)
        if asking.num_rows and zones.num_rows:
            wanted = Wanted(asking, dims, k, same)
            for tile in _tiles(asking.num_rows):
                for piece in _tiles(zones.num_rows):
                    limits = wanted.limits(zones.slice(piece.start, _TILE), tile)
                    needed[piece] |= wanted.asked(*limits, tile).any(axis=0)
        return zones.filter(pa.array(needed, pa.bool_())).select(["team", "block", "part"])

    zone = F.pmod(F.xxhash64("block"), F.lit(zone_groups)).cast("int").alias("zone")
    zones = blocks.select(*_ZONE, zone).withColumn("team", copies(teams))
    asking = anchors.withColumn("zone", copies(zone_groups))
    chosen = asking.groupBy("team", "zone").cogroup(zones.groupBy("team", "zone"))
    chosen = chosen.applyInArrow(choose, "team int, block long, part long")
    chosen = stored(chosen, "chosen-blocks")

    def read(asking: pa.Table, data: pa.Table) -> pa.Table:
        wanted = Wanted(asking, dims, k, same)
        for tile in _tiles(asking.num_rows if data.num_rows else 0):
            least, most, labels = wanted.limits(data, tile)
            for i in np.argsort(-most.max(axis=0), kind="stable").tolist():
                one = slice(i, i + 1)
                asked = wanted.asked(least[:, one], most[:, one], labels[:, one], tile)
                at = tile.start + np.flatnonzero(asked[:, 0])
                if len(at):
                    wanted.read(data.slice(i, 1).to_pylist()[0], at)
        return wanted.found()

    data = blocks.drop("anchors").join(chosen.drop("part"), "block")
    asking = anchors.join(chosen.select("team", "part").distinct(), "team")
    cells = asking.groupBy("team", "part").cogroup(data.groupBy("team", "part"))
    return cells.applyInArrow(read, "row long, window int, score long, other long")


def _windows(low: int, high: int, n: int, scores: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """From ``low`` to ``high`` percent of each score; what is missing up to n windows is empty."""
    lows = np.full((len(scores), n), np.iinfo(np.int64).max)
    highs = np.full((len(scores), n), _NEVER)
    there = np.arange(n) < scores.value_lengths().to_numpy()[:, None]
    found = scores.flatten().to_numpy()
    lows[there], highs[there] = -(-low * found // 100), high * found // 100
    return lows, highs


def mine_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Hard negatives of every anchor and each of its positives, one row each.

    Components become ``floor(scale * x)``, and scores are inner products. The positives of an
    anchor are its best ``n_positives`` other rows of its label; for each, the negatives are the
    best ``n_negatives`` rows of other labels whose score lies between ``low`` and ``high`` percent
    of the positive's. The best have the highest scores and, of those, the smallest ids. The columns
    are ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score`` and
    ``negative_score``.

    Rows with a null id, label or vector, or with a component that is null, not finite or 2^28 or
    more once scaled, take no part. A shorter vector counts as filled up with zeros. Rows that
    repeat are rows of their own: a copy of an anchor is one of its positives. Anchors without
    positives, or without negatives in a window, have no rows there; an empty table gives an empty
    table. Columns other than the three named, and those that ``is_anchor`` reads, do not matter.
    """
    rows = _numbers(vectors, is_anchor, scale, (id_col, vector_col, label_col))
    blocks, dims = write_blocks(rows, block_rows)
    anchors = stored(_anchors(blocks, dims, n_positives), "anchors")
    n_blocks, n_anchors = blocks.count(), anchors.count()
    if not n_anchors:
        return vectors.sparkSession.createDataFrame([], _MINED)

    def pack(batches: Iterator[pa.RecordBatch], windows) -> Iterator[pa.RecordBatch]:
        for source in batches:
            packed = [pa.array([v.tobytes() for v in x], pa.binary()) for x in windows(source)]
            kept = [source.column(c) for c in ("row", "label", "vector")]
            yield pa.RecordBatch.from_arrays([*kept, *packed], ["row", "label", "vector", "lows", "highs"])

    def asking(table: DataFrame, windows) -> DataFrame:
        schema = "row long, label long, vector binary, lows binary, highs binary"
        return table.mapInArrow(lambda batches: pack(batches, windows), schema)

    def above(source: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        floors = source.column("floor").to_numpy()[:, None]
        return floors, np.full_like(floors, np.iinfo(np.int64).max)

    def around(source: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return _windows(low, high, n_positives, source.column("scores"))

    size = (n_anchors, n_blocks)
    positives = search(blocks, asking(anchors, above), dims, n_positives, True, *size)
    positives = stored(positives.drop("window"), "positives")
    ranked = F.sort_array(F.collect_list(F.struct("rank", "score")))  # at most n_positives
    scores = positives.groupBy("row").agg(F.transform(ranked, lambda p: p["score"]).alias("scores"))
    negatives = search(
        blocks, asking(anchors.join(scores, "row"), around), dims, n_negatives, False, *size
    )
    pairs = anchors.select("row", F.col("id").alias("anchor_id")).join(positives, "row").select(
        "row",
        (F.col("rank") - 1).alias("window"),
        "anchor_id",
        F.col("other").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return pairs.join(negatives, ["row", "window"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("other").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
