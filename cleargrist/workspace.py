"""Where intermediate tables go."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """Return a new, unused path for one intermediate table.

    It lies in the shared folder that ``spark.checkpoint.dir`` names, so that every executor
    can reach it and a lost executor takes no data along. Where that is unset, a local-mode
    session uses its warehouse folder; on a cluster this is refused, as the folder may be local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/cleargrist/{label}-{uuid4().hex}"
