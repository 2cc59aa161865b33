"""Reversible line dedup: exact reference counts per line, with sharded cuckoo filters in front.

A line's key is the line without blanks at its ends, ASCII letters in lower case; tables hold its
128-bit hash. ``LineIndex`` keeps two tables: the exact number of documents that hold each key,
and one cuckoo filter per shard with a fingerprint for each key that at least ``min_docs``
documents hold. Inserting documents raises counts, deleting them lowers the counts by the same
keys, and only keys that cross the threshold enter or leave the filters, so both are exactly
reversible. Every change writes a new generation beside the old one, which stays readable.

Texts are cleaned without a shuffle: a task asks the filters, which never miss a common line. The
few rare lines that they take for common ones are known beforehand, since every key in the counts
is asked once (``exceptions``). Filters and exceptions are broadcast if they fit
``max_broadcast_bytes``; beyond it, the keys of all lines are shuffled by shard, a task asks the
stored filter of one shard, and the keys that it lets pass are checked against the exact counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrist.llm import arrays as A
from cleargrist.llm.tables import keyed, rows_between, sized, stored

SLOTS = 4
_KEYS_PER_SHARD = 1 << 17
_KEYS_PER_TASK = 1 << 20


@dataclass(frozen=True)
class Lines:
    """Lines of a block, their hashes, and whether they are long enough to count."""

    spans: A.Spans
    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray


def line_keys(block: A.Block, min_chars: int) -> Lines:
    spans = A.lines(block)
    words = A.runs(block, A.WORD)
    low = np.searchsorted(words.starts, spans.starts)
    high = np.searchsorted(words.starts, spans.ends) - 1
    filled = high >= low
    starts, ends = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
    starts[filled] = words.starts[low[filled]]
    ends[filled] = words.ends[high[filled]]
    chars = np.zeros(len(block.data) + 1, np.int32)
    np.cumsum(A.LEAD[block.data], out=chars[1:])
    lowered = A.LOWER[block.data]
    return Lines(
        spans,
        A.Hasher(lowered)(starts, ends),
        A.Hasher(lowered, second=True)(starts, ends),
        filled & (chars[ends] - chars[starts] >= min_chars),
    )


def fingerprints(second: np.ndarray) -> np.ndarray:
    """Nonzero 32-bit fingerprints; zero marks an empty slot."""
    return np.maximum((second >> np.uint64(32)).astype(np.uint32), 1)


def _jump(prints: np.ndarray) -> np.ndarray:
    return A.mix(prints.astype(np.uint64))


class CuckooFilter:
    """Buckets of four fingerprints; a key lies in one of two buckets, so it can be removed.

    Keys with equal fingerprints and buckets take a slot each, so that removing one keeps the
    others. When a fingerprint finds no place, ``insert`` says so and the owner rebuilds the
    filter at twice the size from the exact keys.
    """

    def __init__(self, table: np.ndarray):
        self.table = table.reshape(-1, SLOTS)

    @classmethod
    def empty(cls, n_keys: int) -> CuckooFilter:
        buckets = 1 << max(1, math.ceil(math.log2(max(1, n_keys) / SLOTS / 0.8)))
        return cls(np.zeros(buckets * SLOTS, np.uint32))

    @classmethod
    def of(cls, first: np.ndarray, second: np.ndarray) -> CuckooFilter:
        size = len(first)
        while True:
            out = cls.empty(size)
            if out.insert(first, second):
                return out
            size *= 2

    def _buckets(self, first: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        one = first & mask
        return one.astype(np.int64), (one ^ (_jump(prints) & mask)).astype(np.int64)

    def insert(self, first: np.ndarray, second: np.ndarray, max_kicks: int = 500) -> bool:
        prints = fingerprints(second)
        one, two = self._buckets(first, prints)
        mask = len(self.table) - 1
        for p, a, b in zip(prints, one, two, strict=True):
            at = a if (self.table[a] == 0).any() else b
            for kick in range(max_kicks):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = p
                    break
                slot = (int(p) + kick) % SLOTS
                p, self.table[at, slot] = self.table[at, slot], p
                at = int(at) ^ (int(_jump(np.array([p], np.uint32))[0]) & mask)
            else:
                return False
        return True

    def delete(self, first: np.ndarray, second: np.ndarray) -> None:
        prints = fingerprints(second)
        one, two = self._buckets(first, prints)
        for p, a, b in zip(prints, one, two, strict=True):
            for at in (a, b):
                slots = np.flatnonzero(self.table[at] == p)
                if len(slots):
                    self.table[at, slots[0]] = 0
                    break

    def contains(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        prints = fingerprints(second)
        one, two = self._buckets(first, prints)
        own = prints[:, None]
        return (self.table[one] == own).any(axis=1) | (self.table[two] == own).any(axis=1)


@dataclass(frozen=True)
class Filters:
    """All shards' filters, and the rare keys that they take for common ones."""

    bits: int
    shards: dict[int, CuckooFilter]
    exceptions: np.ndarray

    def common(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first), bool)
        shard = shard_of(first, self.bits)
        for s in np.unique(shard):
            known = self.shards.get(int(s))
            if known is not None:
                own = np.flatnonzero(shard == s)
                out[own] = known.contains(first[own], second[own])
        at = np.flatnonzero(out)
        if len(self.exceptions) and len(at):
            keys = np.rec.fromarrays([first[at], second[at]])
            out[at] = ~np.isin(keys, self.exceptions)
        return out


def shard_of(first: np.ndarray, bits: int) -> np.ndarray:
    """The top bits of a key's first hash; buckets use the low ones."""
    if not bits:
        return np.zeros(len(first), np.int64)
    return (first >> np.uint64(64 - bits)).astype(np.int64)


def _hashes(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(table[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))


@dataclass(frozen=True)
class LineIndex:
    """Reference counts (h1, h2, n_docs) and filters (shard, slots) of a set of documents."""

    counts: DataFrame
    filters: DataFrame
    bits: int
    min_docs: int
    min_chars: int
    id_col: str
    text_col: str

    @classmethod
    def build(
        cls,
        docs: DataFrame,
        min_docs: int = 10,
        min_chars: int = 1,
        id_col: str = "doc_id",
        text_col: str = "text",
    ) -> LineIndex:
        """Index a first set of documents; each row counts as a document of its own.

        Keys of fewer than ``min_chars`` code points, empty ones above all, are never counted.
        A null text is one empty line. An empty table gives an index in which no line is common.
        """
        empty = docs.sparkSession.createDataFrame([], "h1 long, h2 long, n_docs long")
        none = docs.sparkSession.createDataFrame([], "shard int, slots binary")
        index = cls(empty, none, 0, min_docs, min_chars, id_col, text_col)
        counts = stored(index._counted(docs), "line-counts")
        return index._with_counts(counts)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with more documents."""
        return self._changed(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """The index without documents that it holds, given as they were inserted."""
        return self._changed(docs, -1)

    def _changed(self, docs: DataFrame, sign: int) -> LineIndex:
        delta = self._counted(docs).withColumn("n_docs", F.col("n_docs") * sign)
        merged = self.counts.unionByName(delta).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))
        counts = stored(merged.filter("n_docs > 0"), "line-counts")
        return self._with_counts(counts)

    def _with_counts(self, counts: DataFrame) -> LineIndex:
        """The index after its counts have become ``counts``, with more shards if these are full.

        More shards mean other keys in each of them, so all filters are built anew.
        """
        common = counts.filter(F.col("n_docs") >= self.min_docs).count()
        bits = max(0, math.ceil(math.log2(max(1, common) / _KEYS_PER_SHARD)))
        index = self
        if bits > self.bits:
            none = self.counts.limit(0), self.filters.limit(0)
            index = replace(self, bits=bits, counts=none[0], filters=none[1])
        return replace(index, counts=counts, filters=index._moved(counts))

    def _counted(self, docs: DataFrame) -> DataFrame:
        """Number of rows that hold each key."""
        min_chars = self.min_chars

        def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for source in batches:
                for block in A.blocks(source.column("text")):
                    lines = line_keys(block, min_chars)
                    at = np.flatnonzero(lines.counts)
                    h1, h2, rows = lines.first[at], lines.second[at], lines.spans.rows[at]
                    order = np.lexsort((h2, h1, rows))
                    h1, h2, rows = h1[order], h2[order], rows[order]
                    new = np.ones(len(order), bool)
                    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (rows[1:] != rows[:-1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[new].view(np.int64)) for h in (h1, h2)], ["h1", "h2"]
                    )

        texts = keyed(docs, self.id_col, self.text_col).select("text")
        keys = texts.mapInArrow(distinct, "h1 long, h2 long")
        return keys.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"))

    def _shard(self) -> Column:
        """``shard_of`` for a column h1."""
        top = F.shiftrightunsigned("h1", 64 - self.bits) if self.bits else F.lit(0)
        return top.cast("int")

    def _moved(self, counts: DataFrame) -> DataFrame:
        """The filters after the counts have become ``counts``: a task for each shard.

        A task gets the shard's common keys, old and new; it applies the crossings to the old
        filter, or builds a larger one from the exact keys if there is no room.
        """
        least = self.min_docs

        def common(table: DataFrame, name: str) -> DataFrame:
            return table.filter(F.col("n_docs") >= least).select("h1", "h2", F.lit(1).alias(name))

        keys = common(self.counts, "before").join(common(counts, "now"), ["h1", "h2"], "full")
        keys = keys.withColumn("shard", self._shard())

        def move(old: pa.Table, new: pa.Table) -> pa.Table:
            h1, h2 = _hashes(new)
            before, now = (new[c].is_valid().to_numpy() for c in ("before", "now"))
            shard = (old if old.num_rows else new)["shard"][0].as_py()
            kept = None
            if old.num_rows:
                kept = CuckooFilter(np.frombuffer(old["slots"][0].as_py(), np.uint32).copy())
                gone, come = before & ~now, now & ~before
                kept.delete(h1[gone], h2[gone])
                if not kept.insert(h1[come], h2[come]):
                    kept = None
            if kept is None:
                kept = CuckooFilter.of(h1[now], h2[now])
            return pa.table(
                {"shard": pa.array([shard], pa.int32()), "slots": [kept.table.tobytes()]}
            )

        moved = self.filters.groupBy("shard").cogroup(keys.groupBy("shard"))
        return stored(moved.applyInArrow(move, "shard int, slots binary"), "line-filters")

    def loaded(self, max_bytes: int) -> Filters | None:
        """The filters for broadcasting, or None if they and the exceptions exceed a size."""
        size = self.filters.agg(F.sum(F.length("slots"))).first()[0] or 0
        if size > max_bytes:
            return None
        shards = {
            r["shard"]: CuckooFilter(np.frombuffer(r["slots"], np.uint32))
            for r in self.filters.collect()
        }
        none = np.rec.fromarrays([np.zeros(0, np.uint64)] * 2)
        plain = Filters(self.bits, shards, none)
        shared = self.counts.sparkSession.sparkContext.broadcast(plain)

        def mistaken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for source in batches:
                yield source.filter(pa.array(shared.value.common(*_hashes(source))))

        rare = self.counts.filter(F.col("n_docs") < self.min_docs).select("h1", "h2")
        most = (max_bytes - size) // 16
        found = rare.mapInArrow(mistaken, "h1 long, h2 long").limit(most + 1).toArrow()
        if found.num_rows > most:
            return None
        return replace(plain, exceptions=np.rec.fromarrays(list(_hashes(found))))

    def clean(
        self,
        docs: DataFrame,
        keep_columns: bool = False,
        max_broadcast_bytes: int = 64 << 20,
    ) -> DataFrame:
        """One row per document: its id, ``n_lines``, ``n_dropped`` and the cleaned ``text``.

        Lines whose key at least ``min_docs`` indexed documents hold are dropped wherever they
        occur; the others stay, joined by line feeds. The documents must be part of the index.
        Null and empty texts have one line and become an empty text. With ``keep_columns`` the
        documents come back with all their columns and the cleaned text; a null text stays null.
        """
        known = self.loaded(max_broadcast_bytes)
        if known is None:
            return self._clean_dealt(docs, keep_columns)
        shared = docs.sparkSession.sparkContext.broadcast(known)
        min_chars = self.min_chars

        def dropped(block: A.Block) -> tuple[Lines, np.ndarray]:
            lines = line_keys(block, min_chars)
            out = np.zeros(len(lines.counts), bool)
            at = np.flatnonzero(lines.counts)
            out[at] = shared.value.common(lines.first[at], lines.second[at])
            return lines, out

        if keep_columns:
            return _with_texts(docs, self.text_col, lambda source, block: dropped(block))
        rows = keyed(docs, self.id_col, self.text_col).select("id", "text")
        return _cleaned(rows, self.id_col, lambda source, block: dropped(block))

    def _slices(self) -> np.ndarray:
        """In how many slices the keys of each shard are dealt; none where no key is common."""
        loads = self.counts.withColumn("shard", self._shard()).groupBy("shard").agg(
            F.ceil(F.sum("n_docs") / _KEYS_PER_TASK).cast("int").alias("n_slices")
        )
        rows = loads.join(self.filters.select("shard"), "shard", "left_semi").collect()
        slices = np.zeros(1 << self.bits, np.int64)
        slices[[r["shard"] for r in rows]] = [r["n_slices"] for r in rows]
        return slices

    def _common_in(self, rows: DataFrame) -> DataFrame:
        """Common keys of rows (id, key, text), with the numbers of the lines that have them.

        Each slice of a shard's keys meets a copy of the shard's filter in a task, so that a line
        in very many documents, which is in one shard, is dealt to several tasks too.
        """
        min_chars, bits, slices = self.min_chars, self.bits, self._slices()
        names = ["id", "key", "lines", "h1", "h2"]

        def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for source in batches:
                for block in A.blocks(source.column("text")):
                    lines = line_keys(block, min_chars)
                    first = np.searchsorted(lines.spans.rows, np.arange(len(block)))
                    number = np.arange(len(lines.counts)) - first[lines.spans.rows]
                    shard = shard_of(lines.first, bits)
                    at = np.flatnonzero(lines.counts & (slices[shard] > 0))
                    at = at[np.lexsort((lines.second[at], lines.first[at], lines.spans.rows[at]))]
                    h1, h2, own = lines.first[at], lines.second[at], lines.spans.rows[at]
                    new = np.ones(len(at), bool)
                    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (own[1:] != own[:-1])
                    heads = np.flatnonzero(new)
                    cuts = np.append(heads, len(at)).astype(np.int32)
                    part = source.slice(block.first, len(block)).select(["id", "key"])
                    part = part.take(pa.array(own[heads]))
                    # The row's key deals a line's rows to slices, whatever the line.
                    keys = part.column("key").to_numpy().view(np.uint64)
                    dealt = A.mix(keys) % slices[shard[at[heads]]].astype(np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *part.columns,
                            pa.ListArray.from_arrays(cuts, pa.array(number[at].astype(np.int32))),
                            *(pa.array(h[heads].view(np.int64)) for h in (h1, h2)),
                            pa.array(shard[at[heads]].astype(np.int32)),
                            pa.array(dealt.astype(np.int32)),
                        ],
                        [*names, "shard", "slice"],
                    )

        def ask(known: pa.Table, asked: pa.Table) -> pa.Table:
            asked = asked.select(names)
            if not known.num_rows or not asked.num_rows:
                return asked.slice(0, 0)
            kept = CuckooFilter(np.frombuffer(known["slots"][0].as_py(), np.uint32))
            return asked.filter(pa.array(kept.contains(*_hashes(asked))))

        schema = f"id {rows.schema['id'].dataType.simpleString()}, key long, lines array<int>, h1 long, h2 long"
        keys = rows.select("id", "key", "text").mapInArrow(numbered, f"{schema}, shard int, slice int")
        spark = rows.sparkSession
        copies = spark.createDataFrame(
            [(s, n) for s, n in enumerate(slices.tolist()) if n], "shard int, n_slices int"
        )
        filters = self.filters.join(F.broadcast(copies), "shard").select(
            "shard", "slots", F.explode(F.sequence(F.lit(0), F.col("n_slices") - 1)).alias("slice")
        )
        groups = filters.groupBy("shard", "slice").cogroup(keys.groupBy("shard", "slice"))
        passed = stored(groups.applyInArrow(ask, schema), "line-keys")
        common = self.counts.filter(F.col("n_docs") >= self.min_docs)
        mistaken = passed.select("h1", "h2").distinct().join(common, ["h1", "h2"], "left_anti")
        mistaken = sized(stored(mistaken, "line-mistakes"), 16)
        return passed.join(mistaken, ["h1", "h2"], "left_anti")

    def _clean_dealt(self, docs: DataFrame, keep_columns: bool) -> DataFrame:
        """The same with filters that are too large to broadcast."""
        min_chars = self.min_chars
        common = self._common_in(keyed(docs, self.id_col, self.text_col))
        gone = common.select("id", "key", F.explode("lines").alias("line")).groupBy("id", "key")
        gone = gone.agg(F.collect_set("line").alias("dropped_lines"))
        whole = docs.select(F.struct("*").alias("row"))
        ids, text = F.col(f"row.`{self.id_col}`"), F.col(f"row.`{self.text_col}`")
        whole = whole.select(
            "row", F.xxhash64(ids, F.coalesce(text.cast("string"), F.lit(""))).alias("row_key")
        )
        match = (whole["row_key"] == gone["key"]) & ids.eqNullSafe(gone["id"])
        joined = whole.join(gone, match, "left")

        def listed(source: pa.RecordBatch, block: A.Block) -> tuple[Lines, np.ndarray]:
            lines = line_keys(block, min_chars)
            first = np.searchsorted(lines.spans.rows, np.arange(len(block)))
            out = np.zeros(len(lines.counts), bool)
            gone = rows_between(source, "dropped_lines", block.first, len(block))
            parents = np.repeat(
                np.arange(len(block)), gone.value_lengths().fill_null(0).to_numpy(False)
            )
            out[first[parents] + gone.flatten().to_numpy()] = True
            return lines, out

        if keep_columns:
            flat = joined.select("row.*", F.col("dropped_lines"))
            return _with_texts(flat, self.text_col, listed, docs)
        flat = joined.select(
            ids.alias("id"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), "dropped_lines"
        )
        return _cleaned(flat, self.id_col, listed)


def _texts(block: A.Block, lines: Lines, gone: np.ndarray) -> list[str]:
    """The texts of a block without some lines."""
    out = []
    cuts = np.searchsorted(lines.spans.rows, np.arange(len(block) + 1))
    touched = A.counts(lines.spans.rows[gone], len(block)) > 0
    data = block.data.tobytes()
    for row in range(len(block)):
        if touched[row]:
            own = slice(cuts[row], cuts[row + 1])
            stay = ~gone[own]
            spans = zip(
                lines.spans.starts[own][stay].tolist(), lines.spans.ends[own][stay].tolist(), strict=True
            )
            text = b"\n".join(data[a:b] for a, b in spans)
        else:
            text = data[block.starts[row] : block.ends[row]]
        out.append(text.decode("utf-8", "replace"))
    return out


def _cleaned(rows: DataFrame, id_col: str, dropped) -> DataFrame:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                lines, gone = dropped(source, block)
                n = len(block)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows_between(source, "id", block.first, n),
                        pa.array(A.counts(lines.spans.rows, n)),
                        pa.array(A.counts(lines.spans.rows[gone], n)),
                        pa.array(_texts(block, lines, gone), pa.string()),
                    ],
                    ["id", "n_lines", "n_dropped", "text"],
                )

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n_lines long, n_dropped long, text string"
    return rows.mapInArrow(clean, schema).withColumnRenamed("id", id_col)


def _with_texts(rows: DataFrame, text_col: str, dropped, docs: DataFrame | None = None) -> DataFrame:
    """Rows with their texts cleaned, in the columns of ``docs`` (by default their own)."""
    schema = (docs if docs is not None else rows).schema
    position, width = schema.names.index(text_col), len(schema)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column(text_col)):
                lines, gone = dropped(source, block)
                part = source.slice(block.first, len(block))
                columns = list(part.columns[:width])
                valid = columns[position].is_valid().to_pylist()
                texts = _texts(block, lines, gone)
                columns[position] = pa.array(
                    [t if v else None for t, v in zip(texts, valid, strict=True)],
                    part.schema.field(position).type,
                )
                yield pa.RecordBatch.from_arrays(columns, part.schema.names[:width])

    return rows.mapInArrow(clean, schema)
