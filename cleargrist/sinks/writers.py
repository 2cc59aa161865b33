"""Writers for files and JDBC tables. A failed write raises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cleargrist.formats import checked_format
from cleargrist.functions import named

# A CSV dialect that the default reader dialect reads back unchanged.
_CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
    rebalance: bool = True,
    key_copies: bool = False,
) -> None:
    """Write a table as Parquet, ORC, JSON lines or CSV, optionally in Hive-style partitions.

    A partitioned write first rebalances the rows on the partition columns. Otherwise every
    task would leave one small file in every partition. Adaptive execution splits a partition
    value that holds too many rows over several tasks, so a hot value does not end in one.
    Rows that lie together by those columns already need no such shuffle: ``rebalance=False``.
    The splitting is up to ``spark.sql.adaptive.enabled``; without it this is refused.

    A folder's name cannot tell an empty text from a missing one, so a row whose partition key is
    empty fails the write, unless ``key_copies`` stores text keys once more as columns of the
    files; ``partitioned_schema`` and ``restore_keys`` read such a table. A copy is the key after an
    equals sign, since CSV cannot tell empty from missing either. It is named after the key, with
    ``_key`` behind it; a column of the table that has this name already is refused.
    """
    name = checked_format(fmt)
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
    if keys:
        df = _with_key_copies(df, keys) if key_copies else _without_blank_keys(df, keys)
    if keys and rebalance:
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled").lower() != "true":
            raise ValueError("rebalancing needs spark.sql.adaptive.enabled, or pass rebalance=False")
        df = df.hint("rebalance", *map(named, keys))
    writer = df.write.format(name).mode(mode)
    if name == "csv":
        writer = writer.options(**_CSV_OPTIONS)
    if options:
        writer = writer.options(**options)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.save(path)


_COPY = "_key"
# Before every key that is not null.
_MARK = "="


def _text_keys(schema: StructType, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if isinstance(schema[k].dataType, StringType)]


def _without_blank_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    def checked(key: str) -> Column:
        blank = F.raise_error(F.lit(f"empty text in partition column {key}")).cast("string")
        return F.when(named(key) == "", blank).otherwise(named(key))

    return df.withColumns({key: checked(key) for key in _text_keys(df.schema, keys)})


def _with_key_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    copies = {key + _COPY: key for key in _text_keys(df.schema, keys)}
    if taken := sorted(set(copies) & set(df.columns)):
        raise ValueError(f"columns that copies of keys would replace: {', '.join(taken)}")
    return df.withColumns({copy: F.concat(F.lit(_MARK), named(key)) for copy, key in copies.items()})


def partitioned_schema(schema: StructType, keys: Sequence[str]) -> StructType:
    """The schema of a table as stored with ``key_copies``."""
    copies = [StructField(key + _COPY, StringType()) for key in _text_keys(schema, keys)]
    return StructType([*schema.fields, *copies])


def restore_keys(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table stored with ``key_copies``, its keys as they were written.

    Only the copies of text keys go, which are no columns of the table that was written.
    """
    copies = {key: key + _COPY for key in _text_keys(stored.schema, keys)}
    exact = {key: F.substr(named(copy), F.lit(len(_MARK) + 1)) for key, copy in copies.items()}
    return stored.withColumns(exact).drop(*map(named, copies.values()))


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    properties: Mapping[str, str] | None = None,
    connections: int | None = None,
) -> None:
    """Write a table over JDBC. The driver jar is the caller's to supply.

    Each task opens a connection of its own; ``connections`` bounds how many run at once.
    A task that Spark retries after its commit writes its rows again, so load a large table
    into a staging table with a unique key or into one that is swapped in afterwards.
    """
    settings = dict(properties or {})
    if connections is not None:
        settings["numPartitions"] = str(connections)
    df.write.jdbc(url=url, table=table, mode=mode, properties=settings)
