"""Repeated substrings across a corpus, by bucket-pointer refinement over sampled positions.

A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else. As in
bucket-pointer refinement of suffix arrays, positions first fall into buckets by a short gram;
then a position is told apart from others of its bucket by the identifiers of the buckets at later
offsets, and identifiers that a round has made for twice the reach are what the next round reads.
Only buckets of several positions go on, and what a round has settled is never looked at again.

1. Anchors. Of every window of ``length`` bytes the gram with the smallest hash is its anchor
   (the leftmost of equals), so equal windows have their anchors at equal offsets. A text has an
   anchor for some 70 bytes. Grams that occur once in the corpus end here.
2. Regions. An anchor's region is the union of the windows it serves. It is named from the grams at
   all multiples of a gram's length before and after the anchor: one round joins a gram's identifier
   with the one a gram further on, the next round joins what this one has made with that of two
   grams further on, then four. The bytes that are left at both ends go along. Anchors
   whose gram and region are equal repeat each other entirely: all their windows are settled.
3. Cells. Where a gram has several regions, the windows of each are cut into cells by offset.
   Windows of one cell share a core, and a core that occurs once settles its cell as unique; cells
   whose hulls, all their windows together, are equal repeat each other entirely.
4. Windows. Only where a core has several hulls are windows compared one by one.

Identifiers are 64-bit hashes, compared only within a bucket that another hash has made, so 128 bits
decide. All rounds over the corpus are grouped counts and joins on them, which combine copies
before they shuffle; no bucket is gathered in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrist.llm import arrays as A
from cleargrist.llm.tables import keyed, possible_members, rows_between, sized, stored

CELL = 16


def _ends(firsts: np.ndarray, n: int) -> np.ndarray:
    """The last of the n entries in each group, given the first of each."""
    return np.append(firsts[1:], n)[: len(firsts)] - 1


def anchors_of(block: A.Block, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, gram hash, region hash) of a block's anchors."""
    n = len(block.data)
    span = length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    hasher = A.Hasher(block.data)
    starts = np.arange(n - gram + 1)
    grams = hasher(starts, starts + gram)
    # The position rides in the low bits: the smallest number is the leftmost of the smallest. The
    # split is the same in every block, so that equal windows choose alike.
    bits = np.uint64(32)
    ranked = (grams >> bits << bits) | starts.astype(np.uint64)
    pad = -len(ranked) % span
    tiles = np.append(ranked, np.full(pad, np.iinfo(np.uint64).max)).reshape(-1, span)
    ahead = np.minimum.accumulate(tiles, axis=1).ravel()
    behind = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    n_windows = n - length + 1
    least = np.minimum(behind[:n_windows], ahead[span - 1 : span - 1 + n_windows])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    long_rows = np.flatnonzero(block.ends - block.starts >= length)
    edge = np.zeros(n_windows + 1, np.int8)
    edge[block.starts[long_rows]] += 1
    edge[block.ends[long_rows] - length + 1] -= 1
    windows = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8) > 0)
    at = at[windows]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    last = _ends(first, len(at))
    anchor, low, high = at[first], windows[first], windows[last]
    return anchor, low, high, grams[anchor], _region_names(block, anchor, low, high, length, gram)


_JOIN = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _joined(one: np.ndarray, two: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """The identifier of two strings of known identifiers, the second one ``gap`` bytes on."""
    return A.mix(one * _JOIN[0] + A.mix(two * _JOIN[1] + gap.astype(np.uint64) * _JOIN[2]))


def _region_names(
    block: A.Block, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, gram: int
) -> np.ndarray:
    """Identifiers of the regions (``low`` to ``high`` + ``length``) of a block's anchors."""
    if not len(anchor):
        return np.zeros(0, np.uint64)
    hasher = A.Hasher(block.data, second=True)
    end = high + length
    # The offsets from the anchor that are multiples of a gram, and whose grams lie in the region.
    before = (anchor - low) // gram
    n = before + (end - anchor) // gram
    start = anchor - before * gram
    level = np.frexp(n)[1] - 1
    at = start[:, None] + gram * np.minimum(np.arange(n.max()), n[:, None] - 1)
    names = hasher(at.ravel(), at.ravel() + gram).reshape(at.shape)
    out = np.zeros(len(anchor), np.uint64)
    for k in range(int(level.max()) + 1):
        reach = 1 << k
        own = np.flatnonzero(level == k)
        # Two stretches of the last reach make up the whole; they may overlap.
        rest = n[own] - reach
        out[own] = _joined(names[own, 0], names[own, rest], rest)
        if names.shape[1] > reach:
            # This round reads the identifiers that the last one has made, its own reach further on.
            names = _joined(names[:, :-reach], names[:, reach:], np.full(1, reach))
    edges = A.mix(hasher(low, start)) + A.mix(A.mix(hasher(start + n * gram, end)) + _JOIN[1])
    return _joined(out, edges, (anchor - low) * (length + 1) + high - low)


#: A longer text is searched in stretches of so many windows.
STRETCH = 1 << 20


def _stretches(block: A.Block, length: int) -> Iterator[tuple[int, A.Block]]:
    """A block as it is, or one long text in pieces that have each of its windows once.

    An anchor whose windows two pieces share has a region in both, which changes no result.
    """
    n = len(block.data)
    if len(block) > 1 or n < 2 * STRETCH:
        yield 0, block
        return
    for at in range(0, n - length + 1, STRETCH):
        piece = block.data[at : at + STRETCH + length - 1]
        yield at, A.Block(0, piece, np.zeros(1, np.int64), np.array([len(piece)]))


def _anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["id", "key", "gram", "region", "anchor", "low", "high"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                for at, piece in _stretches(block, length):
                    anchor, low, high, grams, region = anchors_of(piece, length, gram)
                    of = A.rows_of(piece, anchor)
                    own = source.slice(block.first, len(block)).select(["id", "key"]).take(pa.array(of))
                    start = piece.starts[of] - at
                    yield pa.RecordBatch.from_arrays(
                        [
                            *own.columns,
                            pa.array(grams.view(np.int64)),
                            pa.array(region.view(np.int64)),
                            *(pa.array((x - start).astype(np.int32)) for x in (anchor, low, high)),
                        ],
                        names,
                    )

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, key long, gram long, region long, anchor int, low int, high int"
    return rows.mapInArrow(find, schema)


def _per_document(spots: DataFrame, fields: list[str], name: str) -> DataFrame:
    """One row per (id, key): an array of its spots, at most as many as its text has bytes."""
    return spots.groupBy("id", "key").agg(F.collect_list(F.struct(*fields)).alias(name))


def _with_texts(rows: DataFrame, per_doc: DataFrame, row_bytes: int, how: str, limit: int) -> DataFrame:
    """Texts with what ``per_doc`` has for them, which is broadcast if it fits the limit.

    Beyond it, a fixed-size filter spares most other texts the shuffle.
    """
    right = per_doc.withColumnRenamed("id", "own_id").withColumnRenamed("key", "own_key")
    same = (F.col("key") == F.col("own_key")) & F.col("id").eqNullSafe(F.col("own_id"))
    if per_doc.count() * row_bytes <= limit:
        return rows.join(F.broadcast(right), same, how)
    marked = rows.withColumn("due", possible_members(per_doc, "key"))
    joined = marked.filter("due").join(right.hint("shuffle_hash"), same, how)
    if how == "inner":
        return joined
    others = marked.filter("not due")
    missing = {f.name: F.lit(None).cast(f.dataType) for f in right.schema.fields}
    return joined.unionByName(others.withColumns(missing))


def _merged(per_doc: DataFrame) -> DataFrame:
    """The runs of each document, those that overlap or touch as one."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            n = source.num_rows
            found = source.column("found")
            of = np.repeat(np.arange(n), found.value_lengths().to_numpy(False))
            low, high = (f.to_numpy(False).astype(np.int64) for f in found.flatten().flatten())
            order = np.lexsort((low, of))
            of, low, high = of[order], low[order], high[order]
            reach = np.maximum.accumulate(high + (of << 32))
            new = np.ones(len(of), bool)
            new[1:] = (low[1:] + (of[1:] << 32)) > reach[:-1] + 1
            first = np.flatnonzero(new)
            last = _ends(first, len(of))
            ends = (reach[last] - (of[last] << 32)).astype(np.int32)
            runs = pa.StructArray.from_arrays(
                [pa.array(low[first].astype(np.int32)), pa.array(ends.astype(np.int32))], ["low", "high"]
            )
            cuts = np.searchsorted(of[first], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [source.column("id"), source.column("key"), pa.ListArray.from_arrays(cuts, runs)],
                ["id", "key", "found"],
            )

    return per_doc.select("id", "key", "found").mapInArrow(merge, per_doc.schema)


def _regions(texts: DataFrame, length: int) -> DataFrame:
    """(node, back, n, bytes): the region of each mixed bucket's region class."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                spots = rows_between(source, "spots", block.first, len(block))
                of = np.repeat(np.arange(len(block)), spots.value_lengths().to_numpy(False))
                node, anchor, low, high = (f.to_numpy(False) for f in spots.flatten().flatten())
                data = block.data.tobytes()
                start = block.starts[of]
                pieces = [
                    data[a:b]
                    for a, b in zip((start + low).tolist(), (start + high + length).tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node),
                        pa.array((anchor - low).astype(np.int32)),
                        pa.array(pieces, pa.binary()),
                    ],
                    ["node", "back", "bytes"],
                )

    return texts.select("text", "spots").mapInArrow(cut, "node long, back int, bytes binary")


def _offsets(block: A.Block, back: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and offset (anchor minus window start) of every window of the regions in a block."""
    n = block.ends - block.starts - length + 1
    of = np.repeat(np.arange(len(block)), n)
    step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    return of, back[of] - step


def _cells(regions: DataFrame, length: int) -> DataFrame:
    """(node, cell, core, hull, low, high): identifiers of each cell of the regions.

    The core is what all windows of a cell share, the hull is all of them together. A cell that a
    region holds in part only has a hull of its own. ``low`` and ``high`` are its windows.
    """
    names = ["node", "cell", "core", "hull", "low", "high"]

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("bytes")):
                back = rows_between(source, "back", block.first, len(block)).to_numpy()
                node = rows_between(source, "node", block.first, len(block)).to_numpy()
                of, offset = _offsets(block, back, length)
                cell = offset // CELL
                first = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(cell, prepend=-1) != 0))
                last = _ends(first, len(of))
                low, high = (back[of[x]] - offset[x] for x in (first, last))
                of, cell = of[first], cell[first]
                begin = block.starts[of] + back[of] - cell * CELL
                salt = cell.astype(np.uint64)
                hasher = A.Hasher(block.data, second=True)
                core = A.mix(hasher(begin, begin + length - CELL + 1) + salt)
                full = high - low + 1 == CELL
                hull = A.mix(node[of].astype(np.uint64) * np.uint64(131) + salt)
                begin = begin[full] - CELL + 1
                hull[full] = A.mix(hasher(begin, begin + length + CELL - 1) + salt[full])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node[of]),
                        pa.array(cell.astype(np.int32)),
                        pa.array(core.view(np.int64)),
                        pa.array(hull.view(np.int64)),
                        *(pa.array(x.astype(np.int32)) for x in (low, high)),
                    ],
                    names,
                )

    return regions.mapInArrow(
        identify, "node long, cell int, core long, hull long, low int, high int"
    )


def _windows(regions: DataFrame, length: int) -> DataFrame:
    """(node, step, string_1, string_2): names of the windows of the cells listed with each region."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("bytes")):
                back = rows_between(source, "back", block.first, len(block)).to_numpy()
                node = rows_between(source, "node", block.first, len(block)).to_numpy()
                cells = rows_between(source, "cells", block.first, len(block))
                of, offset = _offsets(block, back, length)
                width = length // CELL + 2
                wanted = np.zeros(len(block) * width, bool)
                owner = np.repeat(np.arange(len(block)), cells.value_lengths().to_numpy(False))
                wanted[owner * width + cells.flatten().to_numpy()] = True
                chosen = wanted[of * width + offset // CELL]
                of, offset = of[chosen], offset[chosen]
                step = back[of] - offset
                start = block.starts[of] + step
                one, two = (A.Hasher(block.data, s)(start, start + length) for s in (False, True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node[of]),
                        pa.array(step.astype(np.int32)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                    ],
                    ["node", "step", "string_1", "string_2"],
                )

    return regions.mapInArrow(strings, "node long, step int, string_1 long, string_2 long")


def _several(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that several rows have."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys)


def _refine(rows: DataFrame, bucket: str, finer: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """One round: rows (node, bucket, finer) are told apart by the finer identifier.

    Returns the finer classes of several rows, which are settled, and one node of each class of
    the buckets that the finer identifier has split, which go on.
    """
    classes = rows.groupBy(bucket, finer).agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
    classes = stored(classes, f"{finer}-classes")
    whole = stored(classes.filter("n > 1").select(bucket, finer), f"{finer}-whole")
    split = stored(_several(classes, bucket), f"{bucket}-split")
    reps = classes.join(sized(split, 32, limit), bucket).select("node", finer)
    return sized(whole, 40, limit), stored(reps, f"{finer}-next")


def repeated_spans(rows: DataFrame, length: int, gram: int, limit: int) -> DataFrame:
    """(id, key, low, high): first and last start of runs of repeated windows, several per text."""
    anchors = stored(_anchors(rows, length, gram), "anchors")
    live = stored(_several(anchors, "gram"), "live-grams")
    if live.count() * 32 <= limit:
        alive = anchors.join(F.broadcast(live), "gram")
    else:
        alive = anchors.filter(possible_members(live, "gram")).join(live, "gram")
    alive = stored(alive.withColumn("node", F.monotonically_increasing_id()), "live-anchors")
    whole, reps = _refine(alive, "gram", "region", limit)
    by_region = alive.join(whole, ["gram", "region"]).select("id", "key", "low", "high")

    mixed = alive.join(sized(reps.select("node"), 32, limit), "node")
    mixed = stored(mixed.select("node", "id", "key", "anchor", "low", "high"), "mixed-regions")
    spots = stored(_per_document(mixed, ["node", "anchor", "low", "high"], "spots"), "spots")
    size = 64 + 48 * mixed.count() // max(1, spots.count())
    texts = _with_texts(rows, spots, size, "inner", limit)
    # A text that repeats in full gives its regions as often.
    regions = stored(_regions(texts, length), "region-bytes")

    cells = stored(_cells(regions, length), "cells")
    whole, reps = _refine(cells, "core", "hull", limit)
    by_cell = cells.join(whole, ["core", "hull"]).select("node", "low", "high")
    due = cells.join(sized(reps, 40, limit), ["node", "hull"])
    due = stored(due.groupBy("node").agg(F.collect_set("cell").alias("cells")), "open-cells")
    windows = stored(_windows(regions.join(sized(due, 64, limit), "node"), length), "windows")
    string = ("string_1", "string_2")
    again = windows.join(_several(windows, *string), list(string))
    by_window = again.select("node", F.col("step").alias("low"), F.col("step").alias("high"))

    steps = by_cell.unionByName(by_window).select("node", *(F.col(c).alias(f"{c}_step") for c in ("low", "high")))
    start = mixed.select("node", "id", "key", "low")
    found = start.join(steps, "node").select(
        "id", "key", (F.col("low") + F.col("low_step")).alias("low"), (F.col("low") + F.col("high_step")).alias("high")
    )
    return by_region.unionByName(found)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 200,
    gram: int = 64,
    broadcast_bytes: int = 96 << 20,
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``spans``, ``n_removed`` and the ``kept`` bytes.

    ``spans`` are the maximal runs of removed bytes (start, end). Texts are UTF-8 bytes, and so is
    what is kept, as a run may begin inside a code point. Matches never cross texts; strings are
    judged on the input. A null or empty text has no bytes; of rows that repeat in full each is a
    copy of the other, so texts of ``length`` bytes or more lose everything; an empty table gives
    an empty table; columns other than the two named are not read. Tables of positions larger
    than ``broadcast_bytes`` are joined with the texts by a shuffle instead of a broadcast.
    """
    rows = keyed(docs, id_col, text_col)
    found = repeated_spans(rows, length, gram, broadcast_bytes)
    per_doc = stored(_merged(_per_document(found, ["low", "high"], "found")), "spans")
    total = per_doc.agg(F.sum(F.size("found"))).first()[0] or 0
    size = 64 + 32 * total // max(1, per_doc.count())
    texts = _with_texts(rows, per_doc, size, "left", broadcast_bytes).select("id", "text", "found")
    names = ["id", "n_bytes", "spans", "n_removed", "kept"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                n, size = len(block), len(block.data)
                found = rows_between(source, "found", block.first, n)
                of = np.repeat(np.arange(n), found.value_lengths().fill_null(0).to_numpy(False))
                low, high = (f.to_numpy(False) for f in found.flatten().flatten())
                change = np.zeros(size + 1, np.int32)
                np.add.at(change, block.starts[of] + low, 1)
                np.subtract.at(change, block.starts[of] + high + length, 1)
                gone = np.cumsum(change[:-1], out=change[:-1]) > 0
                runs = A.runs(A.Block(0, gone.view(np.uint8), block.starts, block.ends), A.byte_table(b"\1"))
                begin = block.starts[runs.rows]
                spans = pa.StructArray.from_arrays(
                    [pa.array((x - begin).astype(np.int32)) for x in (runs.starts, runs.ends)],
                    ["start", "end"],
                )
                cuts = np.searchsorted(runs.rows, np.arange(n + 1)).astype(np.int32)
                left = np.zeros(size + 1, np.int32)
                np.cumsum(~gone, out=left[1:])
                kept_at = np.append(left[block.starts], left[-1])
                kept = pa.Array.from_buffers(
                    pa.binary(),
                    n,
                    [None, pa.py_buffer(kept_at.tobytes()), pa.py_buffer(block.data[~gone].tobytes())],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        rows_between(source, "id", block.first, n),
                        pa.array(block.ends - block.starts),
                        pa.ListArray.from_arrays(cuts, spans),
                        pa.array((block.ends - block.starts) - np.diff(kept_at)),
                        kept,
                    ],
                    names,
                )

    id_type = rows.schema["id"].dataType.simpleString()
    return texts.mapInArrow(
        cut,
        f"id {id_type}, n_bytes long, spans array<struct<start:int,end:int>>, n_removed long, "
        "kept binary",
    ).withColumnRenamed("id", id_col)
