"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is a stream of words: its documents in the order of a hash, cut into blocks of equal
width. A source's target gives its quota of blocks, exact in number. The quotas are split among
output shards down a binary tree: a node's left child gets half of the node's blocks, and how
many of each source they are is one draw from the multivariate hypergeometric distribution, so
every shard is a fair sample of the mix. Then a source's blocks, whose documents the
hash has permuted, are dealt to the shards in runs of those counts, from a random one on; a block
is drawn again only when all blocks of its source have been drawn as often. Runs keep documents
whole but for those at a border. Inside a shard pieces are put in the order of a hash.

All work is built-in expressions. Draws are functions of the seed, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cleargrist.llm.tables import sized, stored

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mixture:
    """A row per document with its draws, and a row per source with its leaf counts."""

    documents: DataFrame
    sources: DataFrame


def ranked(df: DataFrame, column: str) -> DataFrame:
    """Rows with ``rank``, from 0 in the order of a column, nulls last, without one task for all."""
    place = F.monotonically_increasing_id()
    order = stored(df.orderBy(F.col(column).asc_nulls_last()).withColumn("place", place), "sorted")
    order = order.withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = order.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per sort partition
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.col("place").bitwiseAND((1 << 33) - 1)
    return order.join(parts, "part").withColumn("rank", F.col("offset") + within).drop(
        "place", "part", "offset"
    )


def targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Sources (source, source_size, ...) with ``weight``, ``target`` and ``rank``.

    Weights repeat over the sources in order. All sources share the total size by weight; a
    target stops at ``most`` times its source, and what is over is shared again until no target
    is above. Each round is one aggregate over the sources, of which one row comes back.
    """
    cycle = F.array(*(F.lit(w) for w in weights))
    out = ranked(sources, "source")
    weight = F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))
    out = out.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    out = stored(out, "sources")
    total = out.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        over = F.col("most") < F.lit(level) * F.col("weight")
        now = out.agg(
            F.count_if(over),
            F.sum(F.when(over, F.col("most")).otherwise(0)),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))),
        ).first()
        if now[0] == stopped or not now[2]:
            break
        stopped, level = now[0], (total - now[1]) / now[2]
    target = F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight"))
    return out.withColumn("target", target).drop("most")


def hypergeometric(total: Column, good: Column, draws: Column, uniform: Column) -> Column:
    """How many of ``good`` among ``total`` are drawn, by inversion of the distribution.

    Probabilities are built outwards from the mode by their ratios, over 12 standard deviations,
    so a draw takes time in proportion to the standard deviation.
    """
    least = F.greatest(F.lit(0).cast("long"), draws - (total - good))
    most = F.least(good, draws)
    share = good / F.greatest(total, F.lit(1))
    spread = F.sqrt(draws * share * (1 - share) * (total - draws) / F.greatest(total - 1, F.lit(1)))
    reach = (F.ceil(spread * 12) + 5).cast("long")
    mode = F.floor((good + 1) * ((draws + 1) / (total + 2))).cast("long")
    mode = F.greatest(least, F.least(most, mode))
    low, high = F.greatest(least, mode - reach), F.least(most, mode + reach)

    def ratio(x: Column) -> Column:
        """Probability of x + 1 over that of x."""
        return ((good - x) * ((draws - x) / (x + 1))).cast("double") / (total - good - draws + x + 1)

    def steps(first: Column, end: Column) -> Column:
        """first, ..., end - 1, or nothing."""
        return F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<long>"))

    one = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("mass"))

    def add(state: Column, p: Column) -> Column:
        return F.struct(p.alias("p"), (state["mass"] + p).alias("mass"))

    above = F.aggregate(steps(mode, high), one, lambda s, x: add(s, s["p"] * ratio(x)))
    below = F.aggregate(
        F.reverse(steps(low, mode)), one, lambda s, x: add(s, s["p"] / ratio(x))
    )
    wanted = uniform * (above["mass"] + below["mass"] + 1)
    # The mass to reach is part of the state, so that it is worked out once for a draw.
    walk = F.struct(
        below["p"].alias("p"), below["p"].alias("mass"), low.alias("x"), wanted.alias("wanted")
    )

    def climb(s: Column, x: Column) -> Column:
        p = s["p"] * ratio(x)
        return F.struct(
            p.alias("p"),
            (s["mass"] + p).alias("mass"),
            F.when(s["mass"] < s["wanted"], x + 1).otherwise(s["x"]).alias("x"),
            s["wanted"].alias("wanted"),
        )

    return F.aggregate(steps(low, high), walk, climb, lambda s: s["x"])


def _uniform(*parts: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11) + 0.5) / float(1 << 53)


#: Sources, or ranges of them, that one row of the tree has counts of.
FAN_BITS = 5


def split_quotas(sources: DataFrame, depth: int, seed: int) -> DataFrame:
    """(rank, cuts): for each source, the running sums of its blocks over the 2^depth shards.

    A node of the tree has rows of counts, one for each range of 32 sources, and above them rows of
    totals, one for each 32 ranges, and so on. A draw starts at the top: how many blocks come from
    each range is a draw too, and then each range draws its own share among its sources. That is the
    same distribution as one draw over all of them, but no row grows with the number of sources.
    """
    fan = 1 << FAN_BITS
    n_sources = sources.count()
    levels = 1
    while n_sources > fan**levels:
        levels += 1
    zero = F.lit(0).cast("long")

    def above(rows: DataFrame, part: Column) -> DataFrame:
        """Rows of counts (node, range, counts) of rows (node, place, n)."""
        listed = F.array_sort(F.collect_list(F.struct("place", "n")))
        counts = F.transform(listed, lambda c: c["n"]).alias("counts")
        return rows.groupBy("node", part.alias("range")).agg(counts)

    def total(counts: Column | str) -> Column:
        return F.aggregate(counts, zero, lambda a, c: a + c)

    def drawn(rows: DataFrame, level: int) -> DataFrame:
        """Rows (node, range, counts, draws) with ``left``: how many of the draws are of each entry."""
        start = F.struct(
            total("counts").alias("total"),
            F.col("draws").alias("draws"),
            F.array().cast("array<long>").alias("left"),
        )

        def draw(s: Column, count: Column) -> Column:
            u = _uniform(F.lit(seed), F.col("node"), F.lit(level), F.col("range"), F.size(s["left"]))
            got = hypergeometric(s["total"], count, s["draws"], u)
            return F.struct(
                (s["total"] - count).alias("total"),
                (s["draws"] - got).alias("draws"),
                F.concat(s["left"], F.array(got)).alias("left"),
            )

        return rows.withColumn("left", F.aggregate("counts", start, draw, lambda s: s["left"]))

    place = F.shiftright("place", FAN_BITS)
    first = sources.select(F.lit(1).cast("long").alias("node"), F.col("rank").alias("place"), F.col("quota").alias("n"))
    nodes = above(first, place)
    for _ in range(depth):
        rows = [nodes]
        for _ in range(levels - 1):
            ranges = rows[-1].select("node", F.col("range").alias("place"), total("counts").alias("n"))
            rows.append(above(ranges, place))
        half = F.floor((total("counts") + 1) / 2).cast("long")
        split = drawn(rows[-1].withColumn("draws", half), levels - 1)
        for level in reversed(range(levels - 1)):
            shares = split.select("node", "range", F.posexplode("left").alias("i", "draws"))
            shares = shares.select("node", (F.col("range") * fan + F.col("i")).alias("range"), "draws")
            split = drawn(rows[level].join(shares, ["node", "range"]), level)
        split = stored(split, "quota-tree")
        right = F.transform("counts", lambda c, i: c - F.get("left", i))
        pair = F.explode(
            F.array(
                F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("counts")),
                F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("counts")),
            )
        )
        nodes = split.select("range", pair.alias("child")).select("child.node", "range", "child.counts")
    leaves = nodes.select("node", "range", F.posexplode("counts").alias("i", "count"))
    leaves = leaves.select("node", (F.col("range") * fan + F.col("i")).alias("rank"), "count")
    ahead = Window.partitionBy("rank").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    ends = leaves.select("rank", "node", F.sum("count").over(ahead).alias("end"))
    cuts = F.array_sort(F.collect_list(F.struct("node", "end")))
    return ends.groupBy("rank").agg(F.transform(cuts, lambda c: c["end"]).alias("cuts"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    shards: int = 16,
    block_words: int = 4096,
    least_blocks: int = 1024,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> Mixture:
    """What the mix takes of each document, and how much of each source.

    ``documents`` has a row per document: id, ``key``, source, ``size`` (words), ``source_size``,
    ``target``, ``taken`` (words, repeats counted) and ``draws``, an array of (shard, place,
    first_word, n_words): the pieces of its text, to be read within a shard by place. A block has
    ``block_words`` words, fewer in a source that would have under ``least_blocks`` blocks, so a
    source is off its target by half a block at most, and by the shortness of its last block.

    A null source is a source of its own, last in order; a null text has no words and no draws;
    sources without words have the target 0; repeated rows are documents each; an empty table
    gives an empty table. ``shards`` is a power of two. Other columns are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    ids = F.col(f"`{id_col}`")
    sizes = docs.select(
        ids.alias("id"),
        F.xxhash64(ids, text).alias("key"),
        F.col(f"`{source_col}`").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )
    sizes = stored(sizes, "sizes")
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    sources = targets(sources, weights, most)
    size = F.col("source_size")
    # At most 2^18 blocks of a source, so that a word's number times theirs fits 64 bits.
    n_blocks = F.greatest(F.ceil(size / block_words), F.least(size, F.lit(least_blocks)))
    n_blocks = F.least(n_blocks, F.lit(1 << 18)).cast("long")
    sources = sources.withColumn("n_blocks", n_blocks)
    quota = F.least(
        F.col("n_blocks") * most,
        F.round(F.col("target") * (F.col("n_blocks") / F.greatest(size, F.lit(1)))).cast("long"),
    )
    quota = F.when(size > 0, quota).otherwise(0)
    sources = sources.withColumns(
        {
            "quota": quota,
            "shift": F.pmod(F.xxhash64(F.lit(seed), "source"), F.greatest("n_blocks", F.lit(1))),
            # A prefix sum over a source's documents takes two levels of about equal depth.
            "n_buckets": F.ceil(F.col("n_docs") / F.greatest(F.lit(2000), F.sqrt("n_docs"))),
        }
    )
    sources = stored(sources, "quotas")
    cuts = split_quotas(sources, shards.bit_length() - 1, seed)
    sources = stored(sources.join(cuts, "rank"), "leaf-counts")

    own = sizes.join(sources.withColumnRenamed("source", "of"), sizes["source"].eqNullSafe(F.col("of")))
    own = own.drop("of", "rank", "weight", "n_docs")
    order = F.xxhash64(F.lit(seed), "id", "key")
    own = own.withColumn("order", order)
    own = own.withColumn("bucket", F.pmod(F.xxhash64("order"), F.col("n_buckets").cast("long")))
    totals = own.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    behind = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("words").over(behind), F.lit(0))
    offsets = totals.select(
        F.col("source").alias("of"), F.col("bucket").alias("in"), offset.alias("offset")
    )
    here = (
        Window.partitionBy("source", "bucket")
        .orderBy("order", "id", "key")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = own.withColumn("start", F.sum("size").over(here) - F.col("size"))
    placed = placed.join(
        offsets, placed["source"].eqNullSafe(F.col("of")) & (placed["bucket"] == F.col("in"))
    )
    placed = placed.withColumn("start", F.col("start") + F.col("offset"))
    drawn = placed.withColumn("draws", _draws(seed))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["n_words"])
    columns = ["id", "key", "source", "size", "source_size", "target"]
    out = drawn.select(*columns, taken.alias("taken"), "draws")
    return Mixture(
        out.withColumnRenamed("id", id_col),
        sources.select("source", "source_size", "weight", "target", "quota", "n_blocks", "cuts"),
    )


def _draws(seed: int) -> Column:
    """The pieces of a document that the mix takes, an array of (shard, place, first_word, n_words)."""
    n, total = F.col("n_blocks"), F.col("source_size")
    end = F.col("start") + F.col("size")

    def block_of(word: Column) -> Column:
        return F.call_function("div", (word + 1) * n - 1, total)

    def border(block: Column) -> Column:
        """First word of a block: borders are spread evenly over the source's words."""
        return F.call_function("div", block * total, n)

    first, last = block_of(F.col("start")), block_of(end - 1)
    def pieces(turn: Column) -> Column:
        def add(done: Column, block: Column) -> Column:
            draw = turn * n + F.pmod(block + F.col("shift"), n)
            shard = F.size(F.filter("cuts", lambda c: c <= draw))
            begin = F.greatest(F.col("start"), border(block)) - F.col("start")
            words = F.least(end, border(block + 1)) - F.col("start") - begin
            last = F.get(done, F.size(done) - 1)
            grows = (last["shard"] == shard) & (last["first_word"] + last["n_words"] == begin)
            more = F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(_piece(shard, last["first_word"], last["n_words"] + words)),
            )
            new = F.concat(done, F.array(_piece(shard, begin, words)))
            taken = F.when(F.coalesce(grows, F.lit(False)), more).otherwise(new)
            return F.when(draw < F.col("quota"), taken).otherwise(done)

        none = F.array().cast("array<struct<shard:int,first_word:bigint,n_words:bigint>>")
        found = F.aggregate(F.sequence(first, last), none, add)
        place = F.xxhash64(F.lit(seed + 1), "source", "start", turn)

        def placed(p: Column) -> Column:
            where = F.xxhash64(place, p["first_word"])
            return F.struct(p["shard"], where.alias("place"), p["first_word"], p["n_words"])

        return F.transform(found, placed)

    n_turns = F.ceil(F.col("quota") / n)
    turns = F.sequence(F.lit(0).cast("long"), n_turns.cast("long") - 1)
    taken = F.flatten(F.transform(turns, pieces))
    none = F.array().cast("array<struct<shard:int,place:bigint,first_word:bigint,n_words:bigint>>")
    return F.when((F.col("size") > 0) & (F.col("quota") > 0), taken).otherwise(none)


def _piece(shard: Column, first_word: Column, n_words: Column) -> Column:
    return F.struct(shard.alias("shard"), first_word.alias("first_word"), n_words.alias("n_words"))


def piece_text(text: Column, first_word: Column, n_words: Column, size: Column) -> Column:
    """Some words of a text with the blanks between and after them; the whole text as it is."""
    words = F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    part = F.array_join(F.slice(words, (first_word + 1).cast("int"), n_words.cast("int")), "")
    return F.when(n_words == size, text).otherwise(part)


def write_order(
    docs: DataFrame, mixture: Mixture, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The mix itself: a row per drawn piece, all columns of its document and ``shard``, ``place``,
    ``first_word``, ``n_words``, the text cut to the piece. Sort a shard by place to read it.

    Columns of the documents that clash with these names are replaced.
    """
    added = ("shard", "place", "first_word", "n_words")
    once = mixture.documents.filter(F.size("draws") > 0)
    once = once.select(F.col(id_col).alias("own_id"), F.col("key").alias("own_key"), "size", "draws")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("key"))
    # Rows that repeat in full have draws of their own each, but one text serves them all.
    grouped = once.groupBy("own_id", "own_key", "size").agg(
        F.count(F.lit(1)).alias("copies"), F.flatten(F.collect_list("draws")).alias("draws")
    )
    grouped = stored(grouped, "draws-by-text")
    same = (F.col("key") == F.col("own_key")) & F.col(f"row.`{id_col}`").eqNullSafe(F.col("own_id"))
    joined = rows.join(sized(grouped, 128), same)
    if not grouped.filter("copies > 1").isEmpty():
        joined = joined.dropDuplicates(["own_id", "own_key"])
    drawn = joined.select("row", "size", F.explode("draws").alias("draw"))
    own = F.col(f"row.`{text_col}`")
    cut = piece_text(own, F.col("draw.first_word"), F.col("draw.n_words"), F.col("size"))
    return drawn.select(
        *(
            cut.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
            if c not in added
        ),
        *(F.col(f"draw.{c}").alias(c) for c in added),
    )
