"""Store a result once and read it back, in this run or a later one."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from hashlib import sha256
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cleargrist.operators.observed import PATIENCE, observed_metrics
from cleargrist.workspace import scratch_path


@dataclass(frozen=True)
class Materialized:
    """A stored table, the metrics observed as it was written, and whether it was there before."""

    table: DataFrame
    metrics: dict[str, int | float | str | None]
    reused: bool


def input_fingerprint(spark: SparkSession, path: str | Sequence[str]) -> str:
    """A key that changes when a file under the path is added, removed, resized or rewritten.

    Spark lists the files and hashes their names, sizes and times; it does not open them.
    """
    paths = [path] if isinstance(path, str) else list(path)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(paths)
        .select(F.xxhash64("path", "modificationTime", "length").alias("file"), "length")
    )
    row = files.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("size"),
        F.hex(F.coalesce(F.bit_xor("file"), F.lit(0))).alias("files"),
    ).first()
    return f"{row['n']}-{row['size']}-{row['files']}"


def materialize(
    df: DataFrame,
    path: str,
    key: str,
    metrics: Sequence[Column] = (),
    still_true: Callable[[], bool] | None = None,
    patience: float = PATIENCE,
    partition_by: str | None = None,
) -> Materialized:
    """Write a table as Parquet and read it back, which cuts its lineage; reuse it if present.

    Every run that writes has a folder of its own, which no other run touches, so a table that was
    returned before stays readable, and two runs of one key at a time do not disturb each other:
    both write, and later ones all read the same one of the two. A table may be stored in
    folders by the values of a column, which then comes last. A stored table is reused only if its write ended and its key, schema and metrics
    are the same: make the key from ``input_fingerprint``, taken before the input is read, and
    whatever else shapes the table. ``still_true`` is asked after the write whether the key still
    describes the input; if not, the table is returned but never reused. ``metrics`` are
    aggregates over the table, computed as its rows pass by on their way into the files, without
    a second scan, and stored along with it; ``patience`` is how many seconds to wait for them.
    """
    spark = df.sparkSession
    schema = json.loads(df.schema.json())
    wanted = {"key": key, "schema": schema, "metrics": [str(m) for m in metrics], "by": partition_by}
    folder = f"{path}/{sha256(json.dumps(wanted).encode()).hexdigest()[:32]}"
    manifest_path = f"{folder}/manifest"

    def read_data(name: str) -> DataFrame:
        return spark.read.schema(StructType.fromJson(schema)).parquet(f"{folder}/{name}")

    known = _manifest(spark, manifest_path)
    if known is not None:
        return Materialized(read_data(known["data"]), json.loads(known["content"]), True)
    own = f"data-{uuid4().hex}"
    observation = Observation()
    rows = df.observe(observation, *metrics) if metrics else df
    writer = rows.write.partitionBy(partition_by) if partition_by else rows.write
    writer.parquet(f"{folder}/{own}")
    observed = {}
    if metrics:
        observed = observed_metrics(
            observation, lambda: read_data(own).agg(*metrics).first(), patience
        )
    if still_true is None or still_true():
        # Written last, and only ever added to, the manifest never vouches for unfinished data.
        entry = spark.createDataFrame([(own, json.dumps(observed))], _MANIFEST)
        entry.coalesce(1).write.mode("append").json(manifest_path)
    else:
        warnings.warn("the input changed while it was stored; the table is not kept", stacklevel=2)
    return Materialized(read_data(own), observed, False)


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Spark's reliable checkpoint: the rows as files in a shared folder, which cuts their lineage.

    They outlive executors but not the session, unlike those of ``materialize``, which later runs
    can read. With ``eager=False`` they are written by the first query that needs them. The folder is
    that of ``spark.checkpoint.dir``; only where none is set, a new one in the scratch folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager)


_MANIFEST = "data string, content string"


def _manifest(spark: SparkSession, path: str) -> Row | None:
    """The folder and metrics of a table whose write has ended: the first by name, if several."""
    try:
        return spark.read.schema(_MANIFEST).json(path).orderBy("data").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
