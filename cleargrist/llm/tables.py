"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from cleargrist.workspace import scratch_path

#: Characters that separate words, as in ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\f\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``id``, ``text`` (null as empty) and ``key``, which tells rows of one id apart.

    Rows that repeat in full share a key, which is right: whatever holds for one holds for all.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    out = df.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    return out.withColumn("key", F.xxhash64("id", "text"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return (left["key"] == right["key"]) & left["id"].eqNullSafe(right["id"])


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int
) -> DataFrame:
    """At most ``max_rows`` labelled rows (``id``, ``text``, ``label``), outside the held-out fold.

    The sample is the rows of the smallest id hashes, so it does not depend on partitioning. An
    id with two labels counts with the larger one; null labels do not count.
    """
    label = F.max(F.col(f"`{label_col}`").cast("int")).alias("label")
    known = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(label)
    known = known.filter(~held_out(F.col("id")) & F.col("label").isNotNull())
    rank = F.xxhash64("id")
    chosen = known.orderBy(rank, "id").limit(max_rows)
    rows = keyed(docs, id_col, text_col).drop("key")
    return rows.join(F.broadcast(chosen), "id")  # max_rows ids and labels


def held_out(id_col: Column) -> Column:
    """Whether the fold kept for measuring holds an id: crc32 of its text modulo 4 is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """A record batch of numpy arrays, lists or arrow arrays."""
    arrays = [
        c if isinstance(c, pa.Array | pa.ChunkedArray) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def rows_between(source: pa.RecordBatch, column: str, first: int, n: int) -> pa.Array:
    return source.column(column).slice(first, n)


def all_of(parts: Iterator[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def sized(df: DataFrame, row_bytes: int, limit: int = 32 << 20) -> DataFrame:
    """A stored table to join texts with: broadcast if its rows fit the limit, by size in bytes.

    A row counts with ``row_bytes`` and the bytes of its texts, which are measured. Beyond the
    limit both sides are shuffled and this one is hashed, so texts are not sorted.
    """
    return fitting(df, size_of(df, row_bytes), limit)


def fitting(df: DataFrame, size: int, limit: int = 32 << 20) -> DataFrame:
    """A table of that many bytes to join texts with, as ``sized`` has it."""
    return F.broadcast(df) if size <= limit else df.hint("shuffle_hash")


def size_of(df: DataFrame, row_bytes: int) -> int:
    """Bytes of a stored table: some for each row, and the lengths of its texts and binaries."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType | BinaryType)]
    lengths = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in wide]
    n, *texts = df.agg(F.count(F.lit(1)), *lengths).first()
    return n * row_bytes + sum(texts)


def possible_members(df: DataFrame, column: str, bits: int = 27) -> Column:
    """A test for a column of that name: false only for values that the table does not hold.

    One bit for each of 2^bits hash values, whatever the size of the table: the driver gets at
    most a 64-bit word for 64 of them, and broadcasts 16 MB. A full table only filters less.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(1 << bits))
    words = df.select(F.shiftright(slot, 6).alias("word"), (slot % 64).cast("int").alias("bit"))
    mask = F.expr("bit_or(shiftleft(1L, bit))").alias("mask")
    found = words.groupBy("word").agg(mask).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def there(slots: pd.Series) -> pd.Series:
        at = slots.to_numpy(np.uint64)
        hit = shared.value[at >> np.uint64(6)] >> (at & np.uint64(63))
        return pd.Series((hit & np.uint64(1)).astype(bool))

    return there(slot)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches that are sorted by a key: many small, or one large."""
    waiting: list[pa.RecordBatch] = []
    for source in batches:
        if not source.num_rows:
            continue
        keys = source.column(key).to_numpy(False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut or (waiting and waiting[-1].column(key)[-1].as_py() != keys[-1]):
            table = pa.Table.from_batches([*waiting, source.slice(0, cut)])
            if table.num_rows:
                yield table
            waiting = []
        waiting.append(source.slice(cut))
    if waiting:
        yield pa.Table.from_batches(waiting)


def group_bounds(keys: np.ndarray) -> tuple[list[int], list[int]]:
    """First row and end of each group of equal, sorted keys."""
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return firsts.tolist(), np.append(firsts[1:], len(keys)).tolist()


def block_pairs(df: DataFrame, group: str, blocks: Column, node: str) -> DataFrame:
    """Rows of each group dealt to blocks by a hash, once for each pair of blocks they are in.

    Adds ``pair``, a hash of the group and the two blocks: all rows of a pair of blocks share it,
    so that every two rows of a group meet in some pair, and a pair holds two blocks at most.
    """
    own = F.pmod(F.xxhash64(node, F.lit(group)), F.col("n_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    dealt = df.withColumn("n_blocks", blocks.cast("int")).withColumn("block", own)
    dealt = dealt.withColumn("other", other)
    pair = F.xxhash64(group, F.least("block", "other"), F.greatest("block", "other"))
    return dealt.withColumn("pair", pair)
