"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

Every word generates the words one deletion away, and those with one code point replaced by a later
one of the alphabet; so each pair of near words is generated from exactly one side. An edit's hash
follows from its word's in a few operations, and is looked up in a blocked Bloom filter of the
vocabulary: a block is two 64-bit words, four bits of a key lie in each, and the second word is
read only where the first one holds its bits. Filters are sharded by word length and broadcast,
as many shards at a time as fit a given number of bytes. Only the edits that a filter lets pass
become text and shuffle, to an exact join with the vocabulary that removes the false positives.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrist.llm import arrays as A
from cleargrist.llm.tables import stored

#: Words are runs of a to z, in either case, and of the letters that UTF-8 writes as C3 and a byte.
_ASCII = A.byte_table(bytes([*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]))
_LATIN = 0xC3

_ODD = np.uint64(0x9E3779B97F4A7C15)
_VALUES = A.mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_LONG = 64  # all words from this length on share a shard
_KEYS_PER_BLOCK, _BLOCKS_PER_LONG_KEY = 5, 2
_BLOCK_BYTES = 16
_EDITS_AT_ONCE = 1 << 18
_FLUSH_CHARS = 1 << 22


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def crc32s(seeds: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of spans of bytes, each carried on from that of the bytes before it."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    at, lengths = starts[order], lengths[order]
    state = ~seeds[order]
    n_long = int(np.searchsorted(-lengths, -_LONG))  # few: one by one
    for i in range(n_long):
        span = data[at[i] : at[i] + lengths[i]].tobytes()
        state[i] = ~np.uint32(zlib.crc32(span, int(~state[i])))
    for j in range(int(lengths[n_long]) if n_long < len(lengths) else 0):
        active = slice(n_long, int(np.searchsorted(-lengths, -j)))
        s = state[active]
        state[active] = _CRC[(s ^ data[at[active] + j]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    return out


def _words(
    block: A.Block, ids: list[str], min_chars: int, drop_every: int | None
) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a block's words, one after the other, and the length of each in bytes."""
    data = A.LOWER[block.data]
    latin = data == _LATIN
    if len(data):
        latin[:-1] &= ~A.LEAD[data[1:]]
        latin[-1] = False
    inside = _ASCII[data] | latin
    inside[1:] |= latin[:-1]
    spans = A.marked_runs(block, inside)
    leads = np.flatnonzero(A.LEAD[data])
    first = np.searchsorted(leads, spans.starts)
    chars = np.searchsorted(leads, spans.ends) - first
    enough = chars >= min_chars
    starts, ends, rows = (x[enough] for x in (spans.starts, spans.ends, spans.rows))
    first, chars = first[enough], chars[enough]
    keep = np.zeros(len(data) + 1, np.int8)
    lengths = ends - starts
    if drop_every:
        seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
        hashes = crc32s(seeds[rows], data, starts, ends).astype(np.int64)
        hit = np.flatnonzero(hashes % drop_every == 0)
        lost = leads[first[hit] + hashes[hit] % chars[hit]]
        width = 1 + latin[lost]
        chars[hit] -= 1
        lengths[hit] -= width
    else:
        lost = width = np.zeros(0, np.int64)
    enough = chars >= min_chars
    keep[starts[enough]] += 1
    keep[ends[enough]] -= 1
    kept = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    kept[lost] = False
    kept[lost[width == 2] + 1] = False
    return data[kept], lengths[enough]


def count_words(
    docs: DataFrame,
    min_chars: int = 7,
    min_count: int = 2,
    drop_every: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Words of at least ``min_chars`` code points that occur ``min_count`` times: ``word``, ``n``.

    Words are maximal runs of A to Z, a to z and U+00C0 to U+00FF; only A to Z are lower-cased.
    ``drop_every`` plants typing errors that can be made again: a run loses one code point if it
    divides the crc32 of ``<id>:<run>``, namely the one at that number modulo the run's length. A
    null id counts as empty there. Null and empty texts have no words, repeated rows count each for
    itself, and an empty table has no words. Words are summed up in each task before they shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def counted() -> pa.RecordBatch:
            data = np.concatenate([d for d, _ in waiting])
            ends = np.cumsum(np.concatenate([n for _, n in waiting]), dtype=np.int64)
            offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64))
            words = pa.LargeStringArray.from_buffers(len(ends), offsets, pa.py_buffer(data))
            found = pc.value_counts(words)
            return pa.RecordBatch.from_arrays(
                [found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"]
            )

        size = 0
        for source in batches:
            ids = source.column("id")
            for block in A.blocks(source.column("text")):
                own = ids.slice(block.first, len(block)).to_pylist()
                data, lengths = _words(block, own, min_chars, drop_every)
                if len(lengths):
                    waiting.append((data, lengths))
                    size += len(data)
                if size > _FLUSH_CHARS:
                    yield counted()
                    waiting, size = [], 0
        if waiting:
            yield counted()

    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    words = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.filter(F.col("n") >= min_count)


@dataclass(frozen=True)
class Letters:
    """Words of one length as rows of letters, with all that their edits' hashes need."""

    at: np.ndarray
    letters: np.ndarray
    terms: np.ndarray
    up: np.ndarray
    inverse: np.uint64

    @property
    def length(self) -> int:
        return self.letters.shape[1]

    def hashes(self) -> np.ndarray:
        return _finish(self.terms.sum(axis=1, dtype=np.uint64), self.length)


def _finish(sums: np.ndarray, length: int) -> np.ndarray:
    return A.mix(sums + np.uint64(length << 40))


def by_length(words: pa.Array, rows_at_once: int = 4096) -> Iterator[Letters]:
    """The words of an array in groups of one length, with their places in the array."""
    column = words.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    lead = A.LEAD[data]
    letters = data[lead]
    tails = np.cumsum(lead)[~lead] - 1
    letters[tails] = 0xC0 + (data[~lead] & 0x3F)
    ends = np.concatenate([[0], np.cumsum(lead)])[at - at[0]]
    lengths = np.diff(ends)
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        up, down = A.powers(_ODD, length + 1)
        step = max(1, min(rows_at_once, (1 << 20) // length))
        for low in range(0, len(own), step):
            part = own[low : low + step]
            block = letters[ends[part][:, None] + np.arange(length)]
            yield Letters(part, block, _VALUES[block] * up[:length], up[:length], down[1])


@dataclass(frozen=True)
class Layout:
    """Where the filter of each length has its blocks: those from 64 on share one."""

    first: np.ndarray
    blocks: np.ndarray
    part_blocks: int

    @classmethod
    def of(cls, counts: dict[int, int], part_blocks: int) -> Layout:
        blocks = np.zeros(_LONG + 1, np.int64)
        for length, n in counts.items():
            blocks[length] = n * _BLOCKS_PER_LONG_KEY if length == _LONG else -(-n // _KEYS_PER_BLOCK)
        return cls(np.concatenate([[0], np.cumsum(blocks)[:-1]]), blocks, part_blocks)

    @property
    def total(self) -> int:
        return int(self.blocks.sum())

    def block(self, hashes: np.ndarray, length: int) -> np.ndarray:
        shard = min(length, _LONG)
        return A.bit_block(hashes, int(self.blocks[shard])) + self.first[shard]

    def meets(self, length: int, low: int, high: int) -> bool:
        """Whether some block of a length lies in a range of blocks."""
        shard = min(max(length, 0), _LONG)
        first, n = int(self.first[shard]), int(self.blocks[shard])
        return n > 0 and first < high and first + n > low


@dataclass(frozen=True)
class Filters:
    """The blocks from ``low`` on of a layout; a block is two words."""

    layout: Layout
    low: int
    words: np.ndarray

    def passes(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Indices of the hashes that may be those of words of a length, among these blocks."""
        block = self.layout.block(hashes, length) - self.low
        n = len(self.words) // 2
        shard = min(length, _LONG)
        first = int(self.layout.first[shard]) - self.low
        whole = first >= 0 and first + int(self.layout.blocks[shard]) <= n
        at = block if whole else np.clip(block, 0, n - 1)
        mask = A.first_mask(hashes)
        hit = np.flatnonzero(self.words[2 * at] & mask == mask)
        if not whole:
            hit = hit[(block[hit] >= 0) & (block[hit] < n)]
        mask = A.second_mask(hashes[hit])
        return hit[self.words[2 * at[hit] + 1] & mask == mask]


def build_filters(vocabulary: DataFrame, layout: Layout) -> DataFrame:
    """Parts of the filters, ``part`` and ``bits``; a task builds one part from its keys' hashes."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for words in by_length(source.column("word")):
                hashes = words.hashes()
                block = layout.block(hashes, words.length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block // layout.part_blocks),
                        pa.array(block % layout.part_blocks),
                        pa.array(hashes.view(np.int64)),
                    ],
                    ["part", "block", "hash"],
                )

    def build(table: pa.Table) -> pa.Table:
        block = table["block"].to_numpy()
        hashes = table["hash"].to_numpy().view(np.uint64)
        bits = np.zeros(2 * layout.part_blocks, np.uint64)
        np.bitwise_or.at(bits, 2 * block, A.first_mask(hashes))
        np.bitwise_or.at(bits, 2 * block + 1, A.second_mask(hashes))
        return pa.table({"part": [table["part"][0].as_py()], "bits": [bits.tobytes()]})

    placed = vocabulary.mapInArrow(place, "part long, block long, hash long")
    return placed.groupBy("part").applyInArrow(build, "part long, bits binary")


def edits(words: Letters, alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[int, int, int]]:
    """Edits that the filters let pass: the word's place, the position, the new letter or -1.

    Of equal neighbours only the first is deleted, and letters are replaced by later ones only.
    """
    n, length = words.letters.shape
    total = words.terms.sum(axis=1, dtype=np.uint64)
    layout, low, high = filters.layout, filters.low, filters.low + len(filters.words) // 2
    step = max(1, _EDITS_AT_ONCE // max(1, n))
    if length > 1 and layout.meets(length - 1, low, high):
        before = np.zeros(n, np.uint64)
        for at in range(0, length, step):
            terms = words.terms[:, at : at + step]
            through = before[:, None] + np.cumsum(terms, axis=1, dtype=np.uint64)
            sums = through - terms + (total[:, None] - through) * words.inverse
            before = through[:, -1]
            hit = filters.passes(_finish(sums.ravel(), length - 1), length - 1)
            row, place = hit // terms.shape[1], at + hit % terms.shape[1]
            new = (place == 0) | (words.letters[row, place] != words.letters[row, place - 1])
            yield from ((int(words.at[r]), int(p), -1) for r, p in zip(row[new], place[new], strict=True))
    if layout.meets(length, low, high):
        m = len(alphabet)
        values = _VALUES[alphabet]
        step = max(1, step // max(1, m))
        for at in range(0, length, step):
            terms = words.terms[:, at : at + step]
            width = terms.shape[1]
            added = words.up[at : at + step, None] * values
            sums = (total[:, None] - terms)[:, :, None] + added
            hit = filters.passes(_finish(sums.ravel(), length), length)
            row, place, letter = hit // (width * m), at + hit // m % width, alphabet[hit % m]
            later = letter > words.letters[row, place]
            yield from (
                (int(words.at[r]), int(p), int(c))
                for r, p, c in zip(row[later], place[later], letter[later], strict=True)
            )


def near_words(
    vocabulary: DataFrame, max_filter_bytes: int = 64 << 20, part_blocks: int = 1 << 15
) -> DataFrame:
    """Each two words one inserted, deleted or replaced code point apart, once.

    The columns are ``word``, ``n``, ``near`` and ``near_n``. ``vocabulary`` is a stored table of
    distinct words in small letters and their counts. At most ``max_filter_bytes`` of filters pass
    through the driver and are broadcast at a time; a larger vocabulary takes more passes, each over
    the words whose length meets the filters of that pass. A task builds ``part_blocks`` blocks of
    five words each.
    """
    spark = vocabulary.sparkSession

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            lengths, letters = np.zeros(_LONG + 1, np.int64), np.zeros(256, np.int64)
            for words in by_length(source.column("word")):
                lengths[min(words.length, _LONG)] += len(words.at)
                letters += np.bincount(words.letters.ravel(), minlength=256)
            both = np.concatenate([lengths, letters])
            at = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(both[at])], ["what", "n"])

    # At most 65 lengths and 256 letters.
    seen = vocabulary.mapInArrow(survey, "what long, n long").groupBy("what").agg(F.sum("n")).collect()
    layout = Layout.of({int(w): int(n) for w, n in seen if w <= _LONG}, part_blocks)
    alphabet = np.array(sorted(w - _LONG - 1 for w, _ in seen if w > _LONG), np.uint8)
    none = spark.createDataFrame([], "word string, n long, near string, near_n long")
    if not layout.total:
        return none
    parts = stored(build_filters(vocabulary, layout), "word-filters")
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    parts_at_once = max(1, max_filter_bytes // (_BLOCK_BYTES * part_blocks))
    n_parts = -(-layout.total // part_blocks)
    passed = []
    for first in range(0, n_parts, parts_at_once):
        last = min(first + parts_at_once, n_parts)
        bits = np.zeros((last - first, 2 * part_blocks), np.uint64)
        for row in parts.filter((F.col("part") >= first) & (F.col("part") < last)).toLocalIterator():
            bits[row["part"] - first] = np.frombuffer(row["bits"], np.uint64)
        filters = Filters(layout, first * part_blocks, bits.ravel())
        shared = spark.sparkContext.broadcast(filters)
        low, high = first * part_blocks, last * part_blocks
        lengths = [
            k for k in range(_LONG + 1) if layout.meets(k, low, high) or layout.meets(k - 1, low, high)
        ]
        chars = F.least(F.char_length("word"), F.lit(_LONG))
        own = vocabulary.filter(chars.isin(lengths)) if passed or last < n_parts else vocabulary

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for source in batches:
                yield from _probed(source, alphabet, shared.value)

        passed.append(own.mapInArrow(probe, "word string, n long, near string"))
    positives = passed[0]
    for more in passed[1:]:
        positives = positives.unionByName(more)
    return positives.join(known, "near").select(none.columns)


def _probed(
    source: pa.RecordBatch, alphabet: np.ndarray, filters: Filters
) -> Iterator[pa.RecordBatch]:
    words = source.column("word")
    counts = source.column("n")
    names = ["word", "n", "near"]
    at: list[int] = []
    near: list[str] = []
    size = 0

    def rows() -> pa.RecordBatch:
        own = pa.array(at, pa.int64())
        return pa.RecordBatch.from_arrays([words.take(own), counts.take(own), pa.array(near)], names)

    for group in by_length(words):
        texts = dict(zip(group.at.tolist(), words.take(pa.array(group.at)).to_pylist(), strict=True))
        for i, place, letter in edits(group, alphabet, filters):
            word = texts[i]
            at.append(i)
            near.append(word[:place] + (chr(letter) if letter >= 0 else "") + word[place + 1 :])
            size += 2 * len(word)
            if size > _FLUSH_CHARS:
                yield rows()
                at, near, size = [], [], 0
    if at:
        yield rows()


def _forms(vocabulary: DataFrame, pairs: DataFrame, ratio: int) -> DataFrame:
    """Per word: ``n``, ``n_near``, and the near word that it is a variant of, ``form``."""

    def seen_from(word: str, n: str, near: str, near_n: str) -> Column:
        values = (word, n, near, near_n)
        names = ("word", "n", "near", "near_n")
        return F.struct(*(F.col(v).alias(c) for v, c in zip(values, names, strict=True)))

    both = pairs.select(
        F.explode(
            F.array(
                seen_from("word", "n", "near", "near_n"), seen_from("near", "near_n", "word", "n")
            )
        ).alias("pair")
    ).select("pair.*")
    alone = vocabulary.select(
        "word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")
    )
    # The largest count first; of equals, the first in code-point order, which is that of bytes.
    rank = F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near"))
    found = both.unionByName(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.count("near").alias("n_near"), F.min(rank).alias("best")
    )
    leads = -F.col("best.less") >= ratio * F.col("n")
    return found.select(
        "word",
        "n",
        "n_near",
        F.when(leads, F.col("best.near")).alias("form"),
        F.when(leads, -F.col("best.less")).alias("form_n"),
    )


def _roots(links: DataFrame) -> DataFrame:
    """The last form of each word, by pointer doubling over (``word``, ``root``).

    A form occurs ``ratio`` times as often as its word, so chains are short and have no circles.
    """
    roots = stored(links, "word-roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = stored(moved, "word-roots")
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return roots


def group_variants(
    docs: DataFrame,
    min_chars: int = 7,
    min_count: int = 2,
    ratio: int = 10,
    drop_every: int | None = None,
    max_filter_bytes: int = 64 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per word: ``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``.

    Words are those of ``count_words``. ``n_near`` counts the words one edit away. ``form`` is the
    most frequent of them (of equals, the first in code-point order), if it occurs ``ratio`` times
    as often as the word or more, else null. ``root`` follows forms to the last, and is the word itself where it has none.

    A word of a million letters works like others, only slower: its edits are tried in bounded
    pieces. Nulls, empty texts, repeated rows and empty tables are as in ``count_words``; columns
    other than the two named are not read.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, or forms could go in circles")
    words = count_words(docs, min_chars, min_count, drop_every, id_col, text_col)
    vocabulary = stored(words, "vocabulary")
    found = stored(_forms(vocabulary, near_words(vocabulary, max_filter_bytes), ratio), "word-forms")
    links = found.filter("form is not null").select("word", F.col("form").alias("root"))
    rooted = found.join(_roots(links), "word", "left")
    return rooted.withColumn("root", F.coalesce("root", "word"))
