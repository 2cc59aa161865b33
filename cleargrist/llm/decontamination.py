"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and texts are reduced to words: ASCII letters in lower case, digits and all bytes beyond
ASCII. One automaton holds all substrings of the words of a block of items; the words of a text
are streamed through it and the longest match that ends at each word is tracked. A word is hit if
it lies in a window of ``window`` words that an item contains; an item of fewer words is one
window. Hit spans are cut out, and a text of which too much is hit is dropped.

Items are taken in blocks of a bounded number of words, so that an automaton, which is
broadcast, has a bounded size; a longer item is cut into stretches that overlap by half. Tasks
build the automata and store them, and the driver passes their bytes on, one at a time. Of a text,
only stretches whose neighbouring words also neighbour each other in some item are streamed; no
window can lie anywhere else. With several blocks the documents are scanned once, against a Bloom
filter of the windows of all items, and only texts that it lets pass meet every block.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrist.llm import arrays as A
from cleargrist.llm.tables import all_of, keyed, rows_between, same_row, sized, stored

_BLOCKS_PER_TASK = 2

WORD_BYTES = (
    A.byte_table(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
    | (np.arange(256) >= 128)
)


def words_of(block: A.Block) -> tuple[A.Spans, np.ndarray]:
    spans = A.runs(block, WORD_BYTES)
    return spans, A.Hasher(A.LOWER[block.data])(spans.starts, spans.ends)


class Automaton:
    """Suffix automaton of several word sequences, and the windows that end in its states."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.names = [name for name, _ in items]
        self.token = {}
        for _, words in items:
            for word in words:
                self.token.setdefault(word, len(self.token))
        self.width = max(1, len(self.token))
        self.next: dict[int, int] = {}
        self.link, self.length = [-1], [0]
        self._out: list[list[int]] = [[]]
        coded = [[self.token[w] for w in words] for _, words in items]
        for words in coded:
            last = 0
            for token in words:
                last = self._extend(last, token)
        del self._out
        by_length = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.window_of = self._window_states(by_length)
        self.windows: dict[int, list[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, words in enumerate(coded):
            self._register(item, words)
        self.short_above = self._short_states(by_length)
        pairs = {(a, b) for _, words in items for a, b in zip(words, words[1:], strict=False)}
        first, second = (np.array([p[i] for p in pairs], np.uint64) for i in (0, 1))
        self.pairs = np.sort(pair_keys(first, second))
        self.single = np.sort(
            np.array([words[0] for _, words in items if len(words) == 1], np.uint64)
        )

    def _extend(self, last: int, token: int) -> int:
        """Add one word after state ``last``; the state of the whole sequence so far."""
        width, following, link, length = self.width, self.next, self.link, self.length
        known = following.get(last * width + token)
        if known is not None and length[known] == length[last] + 1:
            return known
        if known is not None:
            return self._split(last, token, known)
        new = self._add(length[last] + 1, 0, [])
        at = last
        while at >= 0 and (at * width + token) not in following:
            self._set(at, token, new)
            at = link[at]
        if at >= 0:
            target = following[at * width + token]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                link[new] = self._split(at, token, target)
        return new

    def _add(self, length: int, link: int, out: list[int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append(list(out))
        return len(self.length) - 1

    def _set(self, state: int, token: int, target: int) -> None:
        if state * self.width + token not in self.next:
            self._out[state].append(token)
        self.next[state * self.width + token] = target

    def _split(self, state: int, token: int, target: int) -> int:
        clone = self._add(self.length[state] + 1, self.link[target], [])
        for t in self._out[target]:
            self._set(clone, t, self.next[target * self.width + t])
        self.link[target] = clone
        while state >= 0 and self.next.get(state * self.width + token) == target:
            self._set(state, token, clone)
            state = self.link[state]
        return clone

    def _register(self, item: int, words: list[int]) -> None:
        state = 0
        for i, token in enumerate(words):
            state = self.next[state * self.width + token]
            if i + 1 >= self.window:
                found = self.windows.setdefault(self.window_of[state], [])
                if not found or found[-1] != item:
                    found.append(item)
        if 0 < len(words) < self.window:
            self.short.setdefault(state, []).append((len(words), item))

    def _window_states(self, by_length: list[int]) -> list[int]:
        """For each state, the one that holds the last ``window`` words of a longer match."""
        out = list(range(len(self.link)))
        for state in by_length[1:]:
            if self.length[self.link[state]] >= self.window:
                out[state] = out[self.link[state]]
        return out

    def _short_states(self, by_length: list[int]) -> list[int]:
        """For each state, the nearest on the way to the root that is a whole short item, or 0."""
        out = [0] * len(self.link)
        for state in by_length[1:]:
            out[state] = state if state in self.short else out[self.link[state]]
        return out

    def stream(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Windows found as (first word, end), the items that have them, the longest match.

        A state's items are looked up once, and a word ends at most ``window`` short items of
        different lengths, so the time is in proportion to the words.
        """
        following, link, length, width = self.next, self.link, self.length, self.width
        found, seen, state, match, longest = [], set(), 0, 0, 0
        for i, word in enumerate(words):
            token = self.token.get(word)
            if token is None:
                state = match = 0
                continue
            to = following.get(state * width + token)
            while to is None and state:
                state = link[state]
                match = length[state]
                to = following.get(state * width + token)
            if to is None:
                match = 0
                continue
            state = to
            match += 1
            longest = max(longest, match)
            if match >= self.window:
                found.append((i + 1 - self.window, i + 1))
                seen.add(self.window_of[state])
            at = self.short_above[state]
            while at:
                size = self.short[at][0][0]
                if size <= match:
                    found.append((i + 1 - size, i + 1))
                    seen.add(-at)
                at = self.short_above[link[at]]
        items: set[int] = set()
        for at in seen:
            items.update((item for _, item in self.short[-at]) if at < 0 else self.windows.get(at, ()))
        return found, items, longest


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return A.mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values a sorted array holds."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


@dataclass
class Lookup:
    """An automaton as it is broadcast, with a table of bits that rules most pairs out at once."""

    automaton: Automaton
    bits: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self.automaton.pairs >> np.uint64(42)] = True

    def stretches(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end of the stretches of words that can hold a window."""
        n = len(hashes)
        linked = np.zeros(n + 1, bool)
        if n > 1:
            keys = pair_keys(hashes[:-1], hashes[1:])
            maybe = np.flatnonzero(self.bits[keys >> np.uint64(42)] & (rows[1:] == rows[:-1]))
            linked[maybe[member(keys[maybe], self.automaton.pairs)] + 1] = True
        # linked[i]: word i follows word i - 1 in some item.
        firsts = np.flatnonzero(linked[1:] & ~linked[:-1])
        ends = np.flatnonzero(linked[:-1] & ~linked[1:]) + 1
        alone = np.flatnonzero(member(hashes, self.automaton.single))
        if len(alone):
            inside = np.searchsorted(firsts, alone, side="right") - 1
            if len(ends):
                alone = alone[(inside < 0) | (alone >= ends[np.maximum(inside, 0)])]
            firsts = np.concatenate([firsts, alone])
            ends = np.concatenate([ends, alone + 1])
        return firsts, ends


def item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for source in batches:
        for block in A.blocks(source.column("text")):
            spans, hashes = words_of(block)
            cuts = np.searchsorted(spans.rows, np.arange(len(block) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    rows_between(source, "name", block.first, len(block)),
                    pa.ListArray.from_arrays(cuts, pa.array(hashes.view(np.int64))),
                ],
                ["name", "words"],
            )


class Packed:
    """The bytes of a stored automaton; a process that scans texts opens them once."""

    def __init__(self, data: bytes):
        self.data = data

    def __getstate__(self) -> dict:
        return {"data": self.data}

    @cached_property
    def lookup(self) -> Lookup:
        return Lookup(pickle.loads(self.data))


@dataclass(frozen=True)
class Benchmark:
    """Items as words (name, words), and the automata of their blocks (block, automaton)."""

    items: DataFrame
    blocks: DataFrame
    most: int
    overlap: int

    def packed(self) -> Iterator[Packed]:
        """The automata one by one; an empty one if there are no items."""
        numbers = [r["block"] for r in self.blocks.select("block").distinct().collect()]
        for number in sorted(numbers):
            yield Packed(bytes(self.blocks.filter(F.col("block") == number).first()["automaton"]))
        if not numbers:
            yield Packed(pickle.dumps(Automaton([], 1)))


def stretches_of(words: Column, most: int, overlap: int) -> Column:
    """Stretches of at most ``most`` words; every ``overlap`` + 1 neighbours share one."""
    step = most - overlap
    last = F.ceil(F.greatest(F.size(words) - most, F.lit(0)) / step).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(words, i * step + 1, most))


def prepared(
    items: DataFrame, item_col: str, text_col: str, window: int, block_words: int
) -> Benchmark:
    """Store the items' words and the automata; one has ``block_words`` words at most.

    That is, if it is at least two windows; a block of fewer words has two windows at most.
    """
    most = max(block_words, 2 * window)
    overlap = max(window - 1, most // 2)
    rows = keyed(items, item_col, text_col).select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("name"), "text"
    )
    listed = rows.mapInArrow(item_words, "name string, words array<long>").distinct()
    listed = stored(listed.filter(F.size("words") > 0), "benchmark-words")
    pieces = listed.select("name", F.explode(stretches_of(F.col("words"), most, overlap)).alias("words"))
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    n_groups = max(1, math.ceil(total / most / _BLOCKS_PER_TASK))
    group = F.pmod(F.xxhash64("name", "words"), F.lit(n_groups)).cast("int")

    def build(table: pa.Table) -> pa.Table:
        number = table["group"][0].as_py()
        rows = table.sort_by([("name", "ascending")])
        sizes = np.array([len(words) for words in rows["words"]])
        out, first = [], 0
        while first < len(sizes):
            end = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), most, side="right")))
            part = rows.slice(first, end - first)
            taken = sorted(
                (name, words.values.to_numpy().view(np.uint64).tolist())
                for name, words in zip(part["name"].to_pylist(), part["words"], strict=True)
            )
            out.append(pickle.dumps(Automaton(taken, window)))
            first = end
        blocks = pa.array([number + n_groups * i for i in range(len(out))], pa.int32())
        return pa.table({"block": blocks, "automaton": pa.array(out, pa.binary())})

    built = pieces.withColumn("group", group).groupBy("group")
    blocks = stored(built.applyInArrow(build, "block int, automaton binary"), "benchmark-automata")
    return Benchmark(listed, blocks, most, overlap)


def longest_shared(one: np.ndarray, two: np.ndarray) -> int:
    """The most words in a row that two sequences share, by ranks of stretches of 2^k words."""
    _, words = np.unique(np.concatenate([one, two]), return_inverse=True)
    # A number of its own parts the two, so that no shared stretch crosses from one to the other.
    ranks = [np.concatenate([words[: len(one)], [len(words)], words[len(one) :]]).astype(np.int64)]
    n = len(ranks[0]) + 1
    while 2 << len(ranks) - 1 <= min(len(one), len(two)):
        last, half = ranks[-1], 1 << len(ranks) - 1
        ranks.append(np.unique(last[:-half] * n + last[half:], return_inverse=True)[1])
    length, own = 0, np.zeros(n, np.int64)
    for k in reversed(range(len(ranks))):
        after = ranks[k][length:]
        longer = np.unique(own[: len(after)] * n + after, return_inverse=True)[1]
        if len(np.intersect1d(longer[: len(one)], longer[len(one) + 1 :])):
            length, own = length + (1 << k), longer
    return length


def scan_block(block: A.Block, lookup: Lookup):
    """(words per row, hit words as a mask, spans, items per row, longest match per row)."""
    spans, hashes = words_of(block)
    firsts, ends = lookup.stretches(hashes, spans.rows)
    hit = np.zeros(len(hashes), bool)
    items: dict[int, set[int]] = {}
    longest = np.zeros(len(block), np.int64)
    for first, end in zip(firsts.tolist(), ends.tolist(), strict=True):
        found, own, match = lookup.automaton.stream(hashes[first:end].tolist())
        row = int(spans.rows[first])
        longest[row] = max(longest[row], match)
        for low, high in found:
            hit[first + low : first + high] = True
        if own:
            items.setdefault(row, set()).update(own)
    return spans, hit, items, longest


def hit_runs(spans: A.Spans, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each maximal run of hit words of one text."""
    if not len(hit):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = spans.rows[1:] == spans.rows[:-1]
    begins = hit.copy()
    begins[1:] &= ~(hit[:-1] & same)
    closes = hit.copy()
    closes[:-1] &= ~(hit[1:] & same)
    return np.flatnonzero(begins), np.flatnonzero(closes)


def _match(rows: DataFrame, packed: Packed) -> DataFrame:
    """Per row of (id, key, text): words, hit word runs with their bytes, items, longest match."""
    shared = rows.sparkSession.sparkContext.broadcast(packed)
    names = ["id", "key", "n_words", "longest", "items", "runs"]
    run = pa.struct([(c, pa.int32()) for c in ("first", "end", "start_byte", "end_byte")])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.lookup
        for source in batches:
            for block in A.blocks(source.column("text")):
                n = len(block)
                spans, hit, items, longest = scan_block(block, known)
                begins, closes = hit_runs(spans, hit)
                of = spans.rows[begins]
                first_word = np.searchsorted(spans.rows, np.arange(n))
                runs = pa.StructArray.from_arrays(
                    [
                        pa.array((begins - first_word[of]).astype(np.int32)),
                        pa.array((closes + 1 - first_word[of]).astype(np.int32)),
                        pa.array((spans.starts[begins] - block.starts[of]).astype(np.int32)),
                        pa.array((spans.ends[closes] - block.starts[of]).astype(np.int32)),
                    ],
                    fields=list(run),
                )
                cuts = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
                named = [
                    sorted({known.automaton.names[i] for i in items.get(r, ())}) for r in range(n)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows_between(source, "id", block.first, n),
                        rows_between(source, "key", block.first, n),
                        pa.array(A.counts(spans.rows, n).astype(np.int64)),
                        pa.array(np.where(np.diff(cuts) > 0, longest, 0)),
                        pa.array(named, pa.list_(pa.string())),
                        pa.ListArray.from_arrays(cuts, runs),
                    ],
                    names,
                )

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "key", "text").mapInArrow(
        match,
        f"id {id_type}, key long, n_words long, longest long, items array<string>, "
        "runs array<struct<first:int,end:int,start_byte:int,end_byte:int>>",
    )


def find_matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_words: int = 200_000,
) -> DataFrame:
    """One row per document: ``n_words``, ``n_hit``, ``longest``, ``items`` and ``runs``.

    ``longest`` is the longest run of words shared with one item, 0 where no window is hit; ``runs`` are the maximal runs of hit words, with word and byte offsets. A null text
    or item has no words; items without words and repeated items change nothing; repeated
    documents get a row each; an empty table of items hits nothing. Columns other than
    those named are not read.
    """
    rows = keyed(docs, id_col, text_col)
    known = prepared(items, item_col, item_text_col, window, block_words)
    found = _whole_runs(_found(rows, known, window), rows, known)
    n_hit = F.aggregate("runs", F.lit(0), lambda n, r: n + r["end"] - r["first"])
    return found.select(
        F.col("id").alias(id_col), "key", "n_words", n_hit.cast("long").alias("n_hit"),
        "longest", "items", "runs",
    )


def _found(rows: DataFrame, known: Benchmark, window: int) -> DataFrame:
    blocks = known.packed()
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _match(rows, first)
    marked = stored(_marked(rows, known, window), "marked")
    due = stored(marked.filter("text is not null").dropDuplicates(["id", "key"]), "candidates")
    parts = [stored(_match(due, packed), "matches") for packed in chain((first, second), blocks)]
    found = _merged(parts)
    found = stored(found.filter(F.size("runs") > 0), "matches")
    found = found.withColumnRenamed("id", "own_id").withColumnRenamed("key", "own_key").drop("n_words")
    size = F.size("items") * 32 + F.size("runs") * 32 + 96
    total = found.agg(F.sum(size)).first()[0] or 0
    same = (F.col("key") == F.col("own_key")) & F.col("id").eqNullSafe(F.col("own_id"))
    joined = marked.join(sized(found, max(1, total // max(1, found.count()))), same, "left")
    none = {f.name: F.array().cast(f.dataType) for f in found.schema.fields if f.name in ("items", "runs")}
    return joined.select(
        "id",
        "key",
        "n_words",
        F.coalesce("longest", F.lit(0).cast("long")).alias("longest"),
        *(F.coalesce(name, empty).alias(name) for name, empty in none.items()),
    )


_MOST_BLOCKS = 1 << 22


def _window_hashes(hashes: np.ndarray, rows: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all stretches of some numbers of words, and the row of each."""
    found = [A.n_grams(hashes, rows, size) for size in sizes]
    grams = [A.mix(g + np.uint64(size)) for size, (g, _) in zip(sizes, found, strict=True)]
    return np.concatenate(grams), np.concatenate([rows[at] for _, at in found])


def _window_filter(known: Benchmark, window: int) -> tuple[np.ndarray, list[int]]:
    """A Bloom filter of the windows of all items, and the lengths that windows have.

    It has 128 bits for four windows, at most 64 MB; a fuller one lets more texts pass.
    """
    sized_ = known.items.withColumn("n", F.least(F.size("words"), F.lit(window)))
    counts = sized_.groupBy("n").agg(F.sum(F.greatest(F.size("words") - window + 1, F.lit(1)))).collect()
    sizes = sorted(r[0] for r in counts)  # at most ``window`` of them
    n_blocks = max(1, min(_MOST_BLOCKS, sum(r[1] for r in counts) // 4))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for words in source.column("words"):
                own = words.values.to_numpy().view(np.uint64)
                size = min(len(own), window)
                hashes, _ = _window_hashes(own, np.zeros(len(own), np.int64), [size])
                columns = [A.bit_block(hashes, n_blocks)]
                columns += [m.view(np.int64) for m in (A.first_mask(hashes), A.second_mask(hashes))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "one", "two"])

    placed = known.items.select("words").mapInArrow(place, "block long, one long, two long")
    bits = placed.groupBy("block").agg(F.expr("bit_or(one)").alias("one"), F.expr("bit_or(two)").alias("two"))
    table = bits.toArrow()  # a row for each block
    words = np.zeros((n_blocks, 2), np.uint64)
    at = table["block"].to_numpy()
    words[at, 0], words[at, 1] = (table[c].to_numpy().view(np.uint64) for c in ("one", "two"))
    return words.ravel(), sizes


def _marked(rows: DataFrame, known: Benchmark, window: int) -> DataFrame:
    """(id, key, n_words, text): the text only of rows that may hold a window of some item."""
    bits, sizes = _window_filter(known, window)
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                n = len(block)
                spans, hashes = words_of(block)
                windows, of = _window_hashes(hashes, spans.rows, sizes)
                due = np.zeros(n, bool)
                due[of[A.in_bits(windows, shared.value)]] = True
                own = source.slice(block.first, n)
                text = own.column("text").take(pa.array(np.arange(n), mask=~due))
                n_words = pa.array(A.counts(spans.rows, n).astype(np.int64))
                columns = [own.column("id"), own.column("key"), n_words, text]
                yield pa.RecordBatch.from_arrays(columns, ["id", "key", "n_words", "text"])

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, key long, n_words long, text string"
    return rows.select("id", "key", "text").mapInArrow(mark, schema)


def _whole_runs(found: DataFrame, rows: DataFrame, known: Benchmark) -> DataFrame:
    """Matches whose ``longest`` also counts runs that no stretch of a cut item holds as a whole.

    Such a run is longer than the overlap of stretches, and so is what was found of it.
    """
    cut_items = known.items.filter(F.size("words") > known.most)
    if cut_items.isEmpty():
        return found
    found = stored(found, "matches")
    long = found.filter(F.col("longest") > known.overlap)
    long = long.select("id", "key", F.explode("items").alias("name")).distinct()
    texts = rows.join(long.select("id", "key").distinct().alias("l"), ["key"], "left_semi").distinct()
    pairs = texts.join(long.withColumnRenamed("id", "own").withColumnRenamed("key", "own_key"),
        F.col("id").eqNullSafe(F.col("own")) & (F.col("key") == F.col("own_key"))
    ).drop("own", "own_key").join(cut_items, "name")
    pairs = pairs.withColumn("item", F.xxhash64("name", "words"))
    id_type = rows.schema["id"].dataType.simpleString()

    def measure(table: pa.Table) -> pa.Table:
        longest = 0
        for batch in table.to_batches():
            for block in A.blocks(batch.column("text")):
                spans, hashes = words_of(block)
                for row in range(len(block)):
                    words = batch.column("words")[block.first + row].values.to_numpy()
                    own = hashes[spans.rows == row]
                    longest = max(longest, longest_shared(own, words.view(np.uint64)))
        return table.slice(0, 1).select(["id", "key"]).append_column("whole", pa.array([longest]))

    schema = f"id {id_type}, key long, whole long"
    measured = pairs.groupBy("id", "key", "item").applyInArrow(measure, schema)
    measured = measured.groupBy("id", "key").agg(F.max("whole").alias("whole"))
    joined = found.join(measured, same_row(found, measured), "left")
    longest = F.greatest(found["longest"], F.coalesce("whole", F.lit(0))).alias("longest")
    return joined.select(*(longest if c == "longest" else found[c] for c in found.columns))


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Matches with several blocks of items; runs that overlap or touch become one."""
    grouped = all_of(parts).groupBy("id", "key").agg(
        F.max("n_words").alias("n_words"),
        F.max("longest").alias("longest"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("runs")))).alias("found"),
    )
    joined = F.expr(
        """aggregate(found, cast(array() as array<struct<first:int,end:int,start_byte:int,end_byte:int>>),
             (done, r) -> if(size(done) > 0 and r.first <= element_at(done, -1).end,
               concat(slice(done, 1, size(done) - 1), array(named_struct(
                 'first', element_at(done, -1).first,
                 'end', greatest(element_at(done, -1).end, r.end),
                 'start_byte', element_at(done, -1).start_byte,
                 'end_byte', greatest(element_at(done, -1).end_byte, r.end_byte)))),
               concat(done, array(r))))"""
    )
    return grouped.withColumn("runs", joined).drop("found")


def cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """A text without some spans of bytes; a blank keeps the words around a span apart."""
    out, at = [], 0
    for start, end in runs:
        out.append(text[at:start].rstrip(b" "))
        at = end
    out.append(text[at:])
    return b" ".join(piece for piece in out if piece)


def remove_matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    max_coverage: float = 0.5,
    block_words: int = 200_000,
) -> DataFrame:
    """The documents, all columns as they were, without hit spans in their texts.

    A document of which a larger share of words than ``max_coverage`` is hit is dropped; the share
    is taken as the decimal number it is written as, and compared in whole numbers. Texts
    without a hit, null ones included, stay as they are.
    """
    known = prepared(items, item_col, item_text_col, window, block_words)
    share = Fraction(str(max_coverage))
    blocks = known.packed()
    first = next(blocks)
    if next(blocks, None) is not None:
        found = _found(keyed(docs, id_col, text_col), known, window)
        return _cut_joined(docs, found, id_col, text_col, share)
    shared = docs.sparkSession.sparkContext.broadcast(first)
    position = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column(text_col)):
                n = len(block)
                part = source.slice(block.first, n)
                spans, hit, _, _ = scan_block(block, shared.value.lookup)
                begins, closes = hit_runs(spans, hit)
                of = spans.rows[begins]
                cuts = np.searchsorted(of, np.arange(n + 1))
                starts, ends = spans.starts[begins], spans.ends[closes]
                yield _without(
                    part,
                    position,
                    {
                        int(row): list(zip(starts[own] - at, ends[own] - at, strict=True))
                        for row in np.unique(of)
                        for own in [slice(cuts[row], cuts[row + 1])]
                        for at in [block.starts[row]]
                    },
                    A.counts(spans.rows[hit], n),
                    A.counts(spans.rows, n),
                    share,
                )

    return docs.mapInArrow(clean, docs.schema)


def _without(
    rows: pa.RecordBatch,
    position: int,
    runs: dict[int, list[tuple[int, int]]],
    n_hit: np.ndarray,
    n_words: np.ndarray,
    share: Fraction,
) -> pa.RecordBatch:
    """Rows without the runs of bytes in their texts, and without rows that are hit too much."""
    if not runs:
        return rows
    keep = np.ones(rows.num_rows, bool)
    texts = rows.column(position).to_pylist()
    for row, own in runs.items():
        keep[row] = int(n_hit[row]) * share.denominator <= share.numerator * int(n_words[row])
        texts[row] = cut(texts[row].encode(), own).decode("utf-8", "replace")
    columns = list(rows.columns)
    columns[position] = pa.array(texts, rows.schema.field(position).type)
    return pa.RecordBatch.from_arrays(columns, schema=rows.schema).filter(pa.array(keep))


def _cut_joined(
    docs: DataFrame, found: DataFrame, id_col: str, text_col: str, share: Fraction
) -> DataFrame:
    """The same with matches that lie in a table: it is joined to the documents."""
    n_hit = F.aggregate("runs", F.lit(0), lambda n, r: n + r["end"] - r["first"])
    hits = found.filter(F.size("runs") > 0).select(
        "id", "key", F.struct("n_words", n_hit.cast("long").alias("n_hit"), "runs").alias("hits"),
    ).dropDuplicates(["id", "key"])
    hits = stored(hits, "hits")
    total = hits.agg(F.sum(F.size("hits.runs"))).first()[0] or 0
    left = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    left = left.withColumn("id", F.col(f"row.`{id_col}`")).withColumn(
        "key", F.xxhash64(F.col("id"), text)
    )
    joined = left.join(sized(hits, 64 + 32 * total // max(1, hits.count())), same_row(left, hits), "left")
    extra = "hits"
    while extra in docs.columns:
        extra += "_"
    position, width = docs.columns.index(text_col), len(docs.columns)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            rows = source.select(list(range(width)))
            own = source.column(width)
            at = np.flatnonzero(own.is_valid().to_numpy(False))
            listed = own.take(pa.array(at)).to_pylist()
            counts = np.zeros((2, rows.num_rows), np.int64)
            for row, hit in zip(at.tolist(), listed, strict=True):
                counts[:, row] = hit["n_hit"], hit["n_words"]
            runs = {
                row: [(r["start_byte"], r["end_byte"]) for r in hit["runs"]]
                for row, hit in zip(at.tolist(), listed, strict=True)
            }
            yield _without(rows, position, runs, *counts, share)

    flat = joined.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns), F.col("hits").alias(extra))
    return flat.mapInArrow(clean, docs.schema)
