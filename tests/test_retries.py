"""Counts and outputs when tasks fail and run again."""

import json
import subprocess
import sys
from pathlib import Path

JOB = """
import json
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
sys.path.insert(0, sys.argv[1])
from cleargrist import profile, stage, tag, write_quarantine
from cleargrist.suite.inputs import dirty_materials

out = sys.argv[2]
spark = (
    SparkSession.builder.master("local[4, 3]")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")


@F.udf("string")
def fails_at_first(key):
    if int(key) % 500 == 499 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")
    return key


source = dirty_materials(spark, "/root/testdata/sf0.01").repartition(8, "manufacturer_part_id")
flaky = source.withColumn("manufacturer_part_id", fails_at_first("manufacturer_part_id"))
expected = profile(tag(source)).first().asDict()
observed = dict(write_quarantine(flaky, out + "/quarantine").counts)
staged = stage(flaky, out + "/staged", "k")
print(json.dumps({
    "observed": observed == expected,
    "staged": dict(staged.profile.counts) == expected,
    "quarantine": spark.read.parquet(out + "/quarantine").count(),
    "valid": staged.valid.count(),
}))
"""


def test_retried_tasks_count_once(tmp_path):
    repo = Path(__file__).resolve().parents[1]
    run = subprocess.run(
        [sys.executable, "-c", JOB, str(repo), str(tmp_path)],
        check=True,
        timeout=300,
        capture_output=True,
        text=True,
    )
    result = json.loads(run.stdout.strip().splitlines()[-1])
    assert result == {"observed": True, "staged": True, "quarantine": 294, "valid": 1706}
