"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct shingles of ``size`` words, ASCII letters in lower case; equal
sets form a class. For each class, registers of 16 bits hold the leading-zero count and some
mantissa bits of the smallest hash in each of ``REGISTERS`` buckets. Four registers make a band;
classes that agree in a whole band meet in a bucket. There the Jaccard similarity is estimated
from the registers, corrected for chance collisions, and pairs far below the threshold are
left; pairs that stay tie their classes into families. Inside a family every two classes that
are not linked yet are compared on their full sets. Documents connected by links form a
component, named by its smallest id.

With 28 bands of 4 registers, two sets at a similarity of 0.8 miss each other in all bands with a
probability of 4e-7, and their estimate falls below the cut (5 standard deviations) about as
rarely. Tasks report a spanning forest of links, not pairs, and no group has a size limit:

- A bucket of more than ``BLOCK_CLASSES`` classes is cut into blocks, and every pair of blocks is a
  task's group. A bucket of more than ``HOT_CLASSES`` holds near copies of one text, or texts that
  share a line and little else: its classes meet in smaller buckets instead, by their rarest
  registers, so many of them that any two whose estimate reaches the cut share one. If such a
  bucket is as large again, it is one family without a comparison, which can only add comparisons
  later on.
- A family too large for one task is cut into blocks too. Each block is linked within itself, then
  one class stands for all that are linked, and these meet in ever fewer blocks, as long as that
  makes them a quarter fewer; last, the large groups meet once more among themselves. A class is in one
  block of a turn, so what a turn links are stars already and only renames groups. Where all
  become one, as with the near copies of one text, that is all. Else the classes outside the
  largest linked group meet all others of the family, first as registers; texts are fetched only
  for classes whose registers come near each other, and compared as in a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrist.llm import arrays as A
from cleargrist.llm.components import components
from cleargrist.llm.tables import (
    block_pairs,
    fitting,
    group_bounds,
    keyed,
    rows_between,
    sized,
    stored,
    whole_groups,
)

BANDS, ROWS = 28, 4
REGISTERS = BANDS * ROWS
EMPTY = np.uint16(0xFFFF)
MANTISSA = 10
#: Chance that two different minima give one register: equal leading zeros, then equal bits.
COLLISION = 2.0**-MANTISSA / 3
#: A bucket is cut into blocks of about so many classes, a family into blocks of so many shingles.
BLOCK_CLASSES, BLOCK_SHINGLES = 512, 1 << 17
#: Classes of larger buckets meet by their rarest registers; if these buckets are larger too, each is one family.
HOT_CLASSES = 8 * BLOCK_CLASSES
#: Large are linked groups of at least this share of the classes that the family's largest group has.
LARGE = 1 / 16
#: Classes of one side of a group when registers are compared across a large family.
BLOCK_SKETCHES = 4096


def shingles(block: A.Block, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``size`` words.

    A text of fewer words, but not none, has one shingle: all its words.
    """
    words = A.runs(block, A.WORD)
    hashes = A.Hasher(A.LOWER[block.data])(words.starts, words.ends)
    cuts = np.searchsorted(words.rows, np.arange(len(block) + 1))
    grams, firsts = A.n_grams(hashes, words.rows, size)
    gram_cuts = np.searchsorted(firsts, cuts)
    out = []
    for row in range(len(block)):
        low, high = cuts[row], cuts[row + 1]
        if 0 < high - low < size:
            short, _ = A.n_grams(hashes[low:high], np.zeros(high - low, np.int64), high - low)
            out.append(A.mix(short + np.uint64(high - low)))
        else:
            out.append(np.unique(grams[gram_cuts[row] : gram_cuts[row + 1]]))
    return out


_WIDTH = (1 << 64) // REGISTERS + 1
_BOUNDS = np.array([i * _WIDTH for i in range(REGISTERS)], np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set of hashes.

    The range of hashes is cut into equal buckets. A register holds, for the smallest hash of its
    bucket as a fraction of the bucket's width, how many leading zeros it has (6 bits) and the
    ``MANTISSA`` bits after its leading one; an empty bucket is marked.
    """
    out = np.full(REGISTERS, EMPTY)
    at = np.searchsorted(hashes, _BOUNDS)
    full = np.flatnonzero(at < np.append(at[1:], len(hashes)))
    least = (hashes[at[full]] - _BOUNDS[full]) * np.uint64(REGISTERS - 1)
    part, exponent = np.frexp((least >> np.uint64(11)).astype(np.float64))
    bits = np.floor(np.maximum(part * 2 - 1, 0) * (1 << MANTISSA)).astype(np.uint16)
    out[full] = ((53 - exponent).astype(np.uint16) << np.uint16(MANTISSA)) | bits
    return out


def similarity(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of one row of registers with each of several."""
    used = ((one != EMPTY) | (others != EMPTY)).sum(axis=1)
    equal = ((one == others) & (one != EMPTY)).sum(axis=1) / np.maximum(used, 1)
    return (equal - COLLISION) / (1 - COLLISION)


def cut_for(threshold: float) -> float:
    """Five standard deviations of the estimate below a similarity."""
    return threshold - 5 * (threshold * (1 - threshold) / REGISTERS) ** 0.5


def rarest(own: np.ndarray, ranks: np.ndarray, cut: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, token) of the rarest registers of each row; two rows whose estimate reaches the cut share one.

    A token is a place among the registers and the value there, and ``ranks`` tells how common
    each is. If the estimate reaches the cut, at least a share of the registers that either row
    has are equal. So if both leave out one register less than that share, the most common
    ones in one order for all, what they keep still has a register in common.
    """
    tokens = np.arange(REGISTERS, dtype=np.int64) << 16 | own
    order = np.where(own != EMPTY, ranks[tokens].astype(np.int64) << 32 | tokens, np.iinfo(np.int64).max)
    order.sort(axis=1)
    n = (own != EMPTY).sum(axis=1)
    equal = np.maximum(np.ceil((cut * (1 - COLLISION) + COLLISION) * n - 1e-6), 1).astype(np.int64)
    rows, at = np.nonzero(np.arange(REGISTERS) < (n - equal + 1)[:, None])
    return rows, order[rows, at] & 0xFFFFFFFF


def forest(
    labels: np.ndarray, linked: Callable[[int, np.ndarray], np.ndarray]
) -> list[tuple[int, int]]:
    """Links between rows of different labels: enough to connect all that are linked.

    ``linked(row, others)`` tells which of the others a row is linked with. A row is only asked
    about rows that it is not connected with yet.
    """
    _, group = np.unique(labels, return_inverse=True)
    found = []
    waiting = np.ones(len(labels), bool)
    for first in range(len(labels)):
        if not waiting[first]:
            continue
        reached = list(np.flatnonzero(group == group[first]))
        waiting[reached] = False
        while reached:
            row = reached.pop()
            others = np.flatnonzero(waiting)
            if not len(others):
                return found
            for other in others[linked(row, others)]:
                if waiting[other]:
                    found.append((row, int(other)))
                    more = np.flatnonzero((group == group[other]) & waiting)
                    waiting[more] = False
                    reached += list(more)
    return found


_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _stars(nodes: np.ndarray, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    """Links between rows, as links from each node to the smallest that they connect it with."""
    above: dict[int, int] = {}

    def root(node: int) -> int:
        path = []
        while (up := above.setdefault(node, node)) != node:
            path.append(node)
            node = up
        for passed in path:
            above[passed] = node
        return node

    for one, two in pairs:
        low, high = sorted((root(int(nodes[one])), root(int(nodes[two]))))
        above[high] = low
    links = [(node, low) for node in above if (low := root(node)) != node]
    ends = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, i]) for i in (0, 1)], schema=_EDGES)


def sketches(rows: DataFrame, size: int) -> DataFrame:
    """Per row of (id, key, text): the size of its set, a 128-bit name of it, and its bands."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                sets = shingles(block, size)
                n = len(sets)
                names = np.zeros((2, n), np.uint64)
                bands = np.empty((n, BANDS), np.int64)
                for row, own in enumerate(sets):
                    names[0, row] = own.sum(dtype=np.uint64)
                    names[1, row] = np.bitwise_xor.reduce(A.mix(own)) if len(own) else 0
                    bands[row] = registers(own).view(np.int64)
                cuts = np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows_between(source, "id", block.first, n),
                        rows_between(source, "key", block.first, n),
                        pa.array([len(own) for own in sets], pa.int64()),
                        *(pa.array(name.view(np.int64)) for name in names),
                        pa.ListArray.from_arrays(cuts, pa.array(bands.ravel())),
                    ],
                    ["id", "key", "n_shingles", "name_1", "name_2", "bands"],
                )

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "key", "text").mapInArrow(
        sketch,
        f"id {id_type}, key long, n_shingles long, name_1 long, name_2 long, bands array<long>",
    )


def _shared(rows: DataFrame) -> DataFrame:
    """Rows (node, bucket) of buckets of several rows, with their number ``n`` and their ``least`` node."""
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least"))
    return rows.join(shared.filter("n > 1"), "bucket")


def _registers_of(source: pa.RecordBatch) -> np.ndarray:
    return source.column("bands").flatten().to_numpy().reshape(-1, BANDS).view(np.uint16)


def _by_rarest(classes: DataFrame, cut: float) -> DataFrame:
    """(node, bucket) of stored classes (node, bands): two whose estimate reaches the cut share a bucket.

    The driver gets a byte for each register's value that several classes have, and broadcasts
    a table of 7 MB, however many classes there are.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(REGISTERS << 16, np.int32)
        for source in batches:
            own = _registers_of(source)
            tokens, n = np.unique((np.arange(REGISTERS) << 16 | own)[own != EMPTY], return_counts=True)
            counts[tokens] += n.astype(np.int32)
        found = np.flatnonzero(counts)
        for first in range(0, len(found), 1 << 16):
            part = found[first : first + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part].astype(np.int64))], ["token", "n"])

    counts = classes.select("bands").mapInArrow(tally, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rank = F.floor(F.log2("n")).cast("byte").alias("rank")
    found = counts.filter("n > 1").select(F.col("token").cast("int"), rank).toArrow()
    ranks = np.zeros(REGISTERS << 16, np.uint8)
    ranks[found["token"].to_numpy()] = found["rank"].to_numpy()
    shared = classes.sparkSession.sparkContext.broadcast(ranks)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            rows, tokens = rarest(_registers_of(source), shared.value, cut)
            yield pa.RecordBatch.from_arrays(
                [source.column("node").take(pa.array(rows)), pa.array(tokens)], ["node", "token"]
            )

    dealt = classes.mapInArrow(deal, "node long, token long")
    return dealt.select("node", F.xxhash64(F.lit("rarest"), "token").alias("bucket"))


def families(classes: DataFrame, cut: float) -> DataFrame:
    """(node, component): classes tied together by estimates that reach the cut."""
    empty = np.full(ROWS, EMPTY).view(np.int64)[0].item()
    bands = classes.select("node", F.posexplode("bands").alias("band", "value"))
    bands = bands.filter(F.col("value") != empty)
    bands = stored(_shared(bands.select("node", F.xxhash64("band", "value").alias("bucket"))), "buckets")
    is_hot = F.col("n") > HOT_CLASSES
    hot = bands.filter(is_hot)
    met = bands.filter(~is_hot)
    if not hot.isEmpty():
        nodes = classes.join(hot.select("node").distinct(), "node", "left_semi").select("node", "bands")
        again = stored(_shared(_by_rarest(stored(nodes, "hot-classes"), cut)), "hot-buckets")
        hot = again.filter(is_hot & (F.col("node") != F.col("least")))
        met = met.unionByName(again.filter(~is_hot))
    hot = hot.select(F.col("node").alias("u"), F.col("least").alias("v")).distinct()
    members = block_pairs(met, "bucket", F.ceil(F.col("n") / BLOCK_CLASSES), "node")
    members = members.select("node", "pair").join(classes.select("node", "bands"), "node")

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "pair"):
            nodes = table["node"].to_numpy()
            flat = table["bands"].combine_chunks().flatten().to_numpy()
            own = flat.reshape(-1, BANDS).view(np.uint16)
            pairs = []
            for first, end in zip(*group_bounds(table["pair"].to_numpy()), strict=True):
                if end - first > 1:
                    part = own[first:end]
                    near = forest(
                        np.arange(end - first),
                        lambda row, others, part=part: similarity(part[row], part[others]) >= cut,
                    )
                    pairs += [(first + a, first + b) for a, b in near]
            yield _stars(nodes, pairs)

    dealt = members.repartition("pair").sortWithinPartitions("pair")
    tied = dealt.select("pair", "node", "bands").mapInArrow(tie, "u long, v long")
    return components(tied.unionByName(hot), "family")


def _linked(members: DataFrame, size: int, threshold: int) -> DataFrame:
    """Links (u, v) between labels, from the texts of each pair of blocks that have different ones.

    If no label is in two pairs, these are stars: each ``u`` is there once, and is no ``v``.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "pair"):
            labels = table["label"].to_numpy()
            texts = table["text"].combine_chunks()
            pairs = []
            for first, end in zip(*group_bounds(table["pair"].to_numpy()), strict=True):
                if end - first > 1:
                    sets = []
                    for block in A.blocks(texts.slice(first, end - first)):
                        sets += shingles(block, size)
                    found = forest(labels[first:end], _similar(sets, threshold))
                    pairs += [(first + a, first + b) for a, b in found]
            yield _stars(labels, pairs)

    dealt = members.select("pair", "label", "text")
    dealt = dealt.repartition("pair").sortWithinPartitions("pair")
    return dealt.mapInArrow(compare, "u long, v long")


def _similar(sets: list[np.ndarray], threshold: int) -> Callable[[int, np.ndarray], np.ndarray]:
    """The exact test: 100 * intersection >= threshold * union."""
    sizes = np.array([len(s) for s in sets])
    sketch = np.array([registers(s) for s in sets])
    cut = cut_for(threshold / 100)

    def linked(row: int, others: np.ndarray) -> np.ndarray:
        out = np.zeros(len(others), bool)
        small = np.minimum(sizes[row], sizes[others])
        large = np.maximum(sizes[row], sizes[others])
        maybe = np.flatnonzero(100 * small >= threshold * large)
        maybe = maybe[similarity(sketch[row], sketch[others[maybe]]) >= cut]
        if not len(maybe):
            return out
        own = sets[row]
        flat = np.concatenate([sets[i] for i in others[maybe]])
        at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        lengths = sizes[others[maybe]]
        starts = np.cumsum(lengths) - lengths
        both = np.add.reduceat((own[at] == flat).astype(np.int64), starts)
        out[maybe] = 100 * both >= threshold * (lengths + sizes[row] - both)
        return out

    return linked


def _blocks(texts: DataFrame, turn: int) -> DataFrame:
    """Rows (node, component, total, text) with ``pair``: the one block of the family that a row is in."""
    n_blocks = F.ceil(F.col("total") / BLOCK_SHINGLES)
    block = F.pmod(F.xxhash64("node", F.lit(turn)), n_blocks)
    return texts.withColumn("pair", F.xxhash64("component", block, F.lit(turn)))


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Rows with ``label``, renamed by links (u, v) that are stars, stored."""
    named = links.select(F.col("u").alias("label"), F.col("v").alias("root"))
    joined = labels.join(sized(named, 16), "label", "left")
    return stored(joined.withColumn("label", F.coalesce("root", "label")).drop("root"), "labels")


def _labels_across(
    wide: DataFrame, links: DataFrame, sketches_of: DataFrame, size: int, threshold: int
) -> DataFrame:
    """(node, label) of families whose blocks have each been linked within itself: one label for all that are connected."""
    nodes = wide.select("node", "component", "n_shingles", F.col("node").alias("label"))
    labels = _relabelled(nodes, links)
    turn = 0
    for large in (False, True):
        before = None
        while True:
            turn += 1
            left, heads = _heads(labels, turn, large, before)
            n_open, n_heads = left.agg(F.count(F.lit(1)), F.sum(F.when(F.col("going"), F.col("labels")))).first()
            if not n_open and not large:
                return labels.select("node", "label")
            if not n_heads:
                break
            left = left.filter("going")
            heads = heads.join(left, "component").select("node", "label", "total")
            own = wide.drop("total").join(fitting(heads, 32 * n_heads), "node")
            found = stored(_linked(_blocks(own, turn), size, threshold), "links")
            if found.isEmpty():
                break
            labels = _relabelled(labels, found)
            before = left.select("component", F.col("labels").alias("before"))
    several = labels.groupBy("component").agg((F.min("label") != F.max("label")).alias("several")).filter("several")
    open_nodes = labels.join(several, "component", "left_semi")
    near = _near_across(stored(open_nodes, "open-nodes"), sketches_of, threshold)
    weight = near.join(nodes.select("node", "n_shingles"), "node").groupBy("pair")
    weight = weight.agg(F.sum("n_shingles").alias("weight"))
    near = near.withColumnRenamed("pair", "place").join(weight.withColumnRenamed("pair", "place"), "place")
    dealt = block_pairs(near, "place", F.ceil(F.col("weight") / BLOCK_SHINGLES), "node")
    dealt = dealt.select("pair", "node", "label").join(wide.select("node", "text"), "node")
    found = stored(_linked(dealt, size, threshold), "links")
    if not found.isEmpty():
        # A label may be in several pairs here, so these links are no stars yet.
        joined = components(found, "joined").select(F.col("node").alias("u"), F.col("component").alias("v"))
        labels = _relabelled(labels, joined)
    return labels.select("node", "label")


def _heads(labels: DataFrame, turn: int, large: bool, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Families (component, total, labels, going) of several labels, and a class (node, n, component, label) for each label.

    Of large labels alone, if so asked. A family is going on if it was before, and a quarter of
    its labels are gone since. The hash of the turn chooses another class every time.
    """
    heads = labels.groupBy("component", "label").agg(
        F.min_by(F.struct("node", "n_shingles"), F.struct(F.xxhash64("node", F.lit(turn)), "node")).alias("head"),
        F.count(F.lit(1)).alias("members"),
    )
    heads = heads.select("component", "label", "members", "head.node", F.col("head.n_shingles").alias("n"))
    heads = stored(heads, "heads")
    if large:
        most = heads.groupBy("component").agg(F.max("members").alias("most"))
        least = F.greatest(F.lit(2), F.col("most") * LARGE)
        heads = heads.join(most, "component").filter(F.col("members") >= least)
    left = heads.groupBy("component").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("labels"))
    left = left.filter("labels > 1")
    if before is None:
        left = left.withColumn("going", F.lit(True))
    else:
        going = F.coalesce(F.expr("4 * labels <= 3 * before"), F.lit(False))
        left = left.join(before, "component", "left").withColumn("going", going).drop("before")
    return stored(left, "open-families"), heads


def _near_across(labels: DataFrame, sketches_of: DataFrame, threshold: int) -> DataFrame:
    """(pair, node, label): classes of families (node, component, label) that come near one of another label.

    Within a family, the classes outside the largest label meet all others, in blocks; ``pair`` is
    a group in which two classes have met whose estimate reaches the cut.
    """
    cut = cut_for(threshold / 100)
    counts = labels.groupBy("component", "label").agg(F.count(F.lit(1)).alias("n"))
    families_of = counts.groupBy("component").agg(
        F.max_by("label", F.struct("n", "label")).alias("major"), F.sum("n").alias("n"), F.max("n").alias("most")
    )
    n_all = F.ceil(F.col("n") / BLOCK_SKETCHES).cast("int")
    n_minor = F.ceil((F.col("n") - F.col("most")) / BLOCK_SKETCHES).cast("int")
    families_of = families_of.select("component", "major", n_all.alias("n_all"), n_minor.alias("n_minor"))
    rows = labels.join(families_of, "component").join(sketches_of, "node")
    own = F.pmod(F.xxhash64("node", F.lit("all")), F.col("n_all"))
    lesser = F.pmod(F.xxhash64("node", F.lit("minor")), F.col("n_minor"))

    def dealt(df: DataFrame, minor: Column, other: Column, asks: bool) -> DataFrame:
        dealt_to = df.withColumns({"i": minor, "j": other})
        pair = F.xxhash64("component", F.col("i").cast("long"), F.col("j").cast("long"))
        return dealt_to.select(pair.alias("pair"), "node", "label", "bands", F.lit(asks).alias("asks"))

    each = F.explode(F.sequence(F.lit(0), F.col("n_minor") - 1))
    every = F.explode(F.sequence(F.lit(0), F.col("n_all") - 1))
    met = dealt(rows, each, own, False).unionByName(
        dealt(rows.filter(F.col("label") != F.col("major")), lesser, every, True)
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "pair"):
            flat = table["bands"].combine_chunks().flatten().to_numpy()
            own = flat.reshape(-1, BANDS).view(np.uint16)
            label, asks = table["label"].to_numpy(), table["asks"].to_numpy()
            near = np.zeros(table.num_rows, bool)
            for first, end in zip(*group_bounds(table["pair"].to_numpy()), strict=True):
                part = slice(first, end)
                for row in first + np.flatnonzero(asks[part]):
                    others = first + np.flatnonzero(~asks[part] & (label[part] != label[row]))
                    hit = others[similarity(own[row], own[others]) >= cut]
                    near[hit] = True
                    near[row] |= len(hit) > 0
            yield from table.filter(pa.array(near)).select(["pair", "node", "label"]).to_batches()

    sorted_ = met.repartition("pair").sortWithinPartitions("pair")
    found = sorted_.mapInArrow(compare, "pair long, node long, label long").distinct()
    return stored(found, "near-across")


def link_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: int = 80,
) -> DataFrame:
    """One row per document: id, ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Two documents are linked if 100 * intersection >= ``threshold`` * union of their sets. A text
    with fewer words than ``size`` has one shingle, all its words; null, empty and blank texts
    have none and are linked with nothing, not even each other. ``component_id`` is the smallest
    id that a document is connected with, its own included, and ``kept`` marks the document of
    that id (of several, that of the smallest key); null ids count as larger than all others. Rows that repeat in full count as one
    document, and each gets the same answer. An empty table gives an empty table.
    """
    rows = keyed(docs, id_col, text_col)
    sketched = stored(sketches(rows, size), "sketches")
    named = sketched.filter("n_shingles > 0").groupBy("name_1", "name_2")
    classes = named.agg(
        F.min_by(F.struct("id", "key"), F.struct(F.col("id").isNull(), "id", "key")).alias("first"),
        F.max("n_shingles").alias("n_shingles"),
        F.min("bands").alias("bands"),
    ).withColumn("node", F.monotonically_increasing_id())
    classes = stored(classes, "classes")

    family = stored(families(classes, cut_for(threshold / 100)), "families")
    reps = classes.join(family, "node").select("node", "component", "first.id", "first.key", "n_shingles")
    total = reps.groupBy("component").agg(F.sum("n_shingles").alias("total"))
    reps = stored(reps.join(total, "component"), "family-members")
    texts = rows.join(sized(reps.withColumnRenamed("id", "rep_id"), 64), ["key"])
    texts = texts.filter(F.col("id").eqNullSafe(F.col("rep_id"))).dropDuplicates(["node"])
    texts = stored(texts.select("node", "component", "total", "n_shingles", "text"), "family-texts")

    links = stored(_linked(_blocks(texts, 0).withColumn("label", F.col("node")), size, threshold), "links")
    wide = texts.filter(F.col("total") > BLOCK_SHINGLES)
    found = links.select(F.col("u").alias("node"), F.col("v").alias("label"))
    if not wide.isEmpty():
        labels = _labels_across(wide, links, classes.select("node", "bands"), size, threshold)
        found = found.join(wide.select("node"), "node", "left_anti").unionByName(labels)

    root = F.coalesce("label", "node").alias("root")
    rooted = classes.join(found, "node", "left").select(root, "name_1", "name_2", "first")
    own = F.struct(F.col("first.id").isNull(), "first.id", "first.key")
    lowest = rooted.groupBy("root").agg(F.min_by("first", own).alias("lowest"))
    by_name = rooted.join(lowest, "root").select("name_1", "name_2", "lowest")
    answer = sketched.drop("bands").join(by_name, ["name_1", "name_2"], "left")
    alone = F.col("n_shingles") == 0
    first = F.col("id").eqNullSafe(F.col("lowest.id")) & (F.col("key") == F.col("lowest.key"))
    return answer.select(
        F.col("id").alias(id_col),
        "key",
        "n_shingles",
        F.when(alone, F.col("id")).otherwise(F.col("lowest.id")).alias("component_id"),
        (alone | first).alias("kept"),
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: int = 80,
) -> DataFrame:
    """The documents, all columns as they were, one of each component.

    Of rows that repeat in full one stays; texts without a shingle all stay. Documents of one id
    whose texts differ are told apart by their text.
    """
    linked = stored(link_documents(docs, id_col, text_col, size, threshold), "near-dedup")
    gone = stored(linked.filter("not kept").select(F.col(id_col).alias("gone_id"), "key"), "gone")
    same_rows = linked.filter("kept and n_shingles > 0").groupBy(F.col(id_col).alias("twice_id"), "key")
    twice = same_rows.count().filter("count > 1").select("twice_id", F.col("key").alias("twice_key"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("key"))
    ids = F.col(f"row.`{id_col}`")
    same = (own["key"] == gone["key"]) & ids.eqNullSafe(gone["gone_id"])
    left = own.join(sized(gone, 32), same, "left_anti")
    twice = stored(twice, "twice")
    if not twice.isEmpty():
        # A component's first document is there several times: one of those rows stays.
        is_twice = (left["key"] == twice["twice_key"]) & ids.eqNullSafe(twice["twice_id"])
        single = left.join(sized(twice, 32), is_twice, "left_anti")
        one = left.join(sized(twice, 32), is_twice, "left_semi").withColumn("id", ids)
        left = single.unionByName(one.dropDuplicates(["key", "id"]).drop("id"))
    return left.select("row.*")
