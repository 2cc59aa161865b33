import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

# Columns named like those that the operators use inside.
CLASHING = ("key", "id", "row", "n_words", "spans", "found", "own_key", "draws", "node", "shard", "size")


@pytest.fixture
def frame(spark):
    """A documents table with nulls, odd columns and clashing names, from (id, text) or triples."""

    def make(rows, source="s"):
        full = [(r[0], r[1], r[2] if len(r) > 2 else source) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, source string")
        from pyspark.sql import functions as F

        return df.withColumns({c: F.lit(None).cast("string") for c in CLASHING}).repartition(3)

    return make
