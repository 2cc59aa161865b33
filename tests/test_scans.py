"""How often the whole job reads its source, from Spark's event log."""

import json
import subprocess
import sys
from pathlib import Path

import pytest

JOB = """
import sys
from dataclasses import replace
from pyspark.sql import SparkSession
sys.path.insert(0, sys.argv[1])
from cleargrist import CurationOptions, ReadOptions, curate, write_table
from cleargrist.suite.inputs import dirty_materials

out, kind = sys.argv[2], sys.argv[3]
spark = (
    SparkSession.builder.master("local[4]")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.dir", out + "/events")
    .config("spark.eventLog.compress", "false")
    .config("spark.sql.warehouse.dir", out + "/warehouse")
    .getOrCreate()
)
source_format = "json" if kind == "json source" else "csv"
write_table(
    dirty_materials(spark, "/root/testdata/sf0.01"), out + "/source", source_format,
    options={"ignoreNullFields": "false"} if source_format == "json" else None,
)
released = kind.startswith("released")
places = {"publish_path": out + "/releases"} if released else {
    "clean_path": out + "/clean", "quarantine_path": out + "/quarantine", "stats_path": out + "/stats"
}
options = CurationOptions(
    out + "/source", **places, read=ReadOptions(fmt=source_format),
    checkpoint_path=out + "/kept" if kind == "checkpoint" else None,
    write_format=kind.split()[-1] if kind.split()[-1] in ("csv", "json") else "parquet",
    mode="append" if kind.endswith("append") else "overwrite",
)
for run in range(2):
    spark.sparkContext.setJobDescription(f"run {run}")
    curate(spark, options)
spark.stop()
"""


def scans_of_source(folder: Path) -> list[int]:
    """For each run of the job, the queries whose plan reads the source, and other passes over files.

    Spark's inference of JSON fields is a job that belongs to no query.
    """
    counts = [0, 0]
    for log in (p for p in (folder / "events").rglob("*") if p.is_file() and "appstatus" not in p.name):
        for line in log.read_text().splitlines():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                own = event.get("Properties", {})
                run = own.get("spark.job.description", "")
                names = [r["Name"] for s in event["Stage Infos"] for r in s["RDD Info"]]
                if run.startswith("run") and "spark.sql.execution.id" not in own and "FileScanRDD" in names:
                    counts[int(run.split()[1])] += 1
            if not event["Event"].endswith("SparkListenerSQLExecutionStart"):
                continue
            plan = event["physicalPlanDescription"]
            scan = any(f"Scan {fmt}" in plan for fmt in ("csv", "json", "text"))
            if event["description"].startswith("run") and scan and "/source]" in plan:
                counts[int(event["description"].split()[1])] += 1
    return counts


@pytest.mark.parametrize(
    ("kind", "scans"),
    [
        ("plain", [2, 2]),
        ("json", [2, 2]),
        ("csv", [2, 2]),
        ("append", [2, 2]),
        ("checkpoint", [1, 0]),
        ("json source", [2, 2]),
        ("released", [2, 2]),
        ("released append", [2, 2]),
    ],
)
def test_scans(tmp_path, kind, scans):
    (tmp_path / "events").mkdir()
    repo = Path(__file__).resolve().parents[1]
    subprocess.run(
        [sys.executable, "-c", JOB, str(repo), str(tmp_path), kind], check=True, timeout=300, capture_output=True
    )
    assert scans_of_source(tmp_path) == scans


@pytest.mark.parametrize("mode", ["", "append "])
def test_a_release_in_csv_reads_its_source_once(tmp_path, mode):
    (tmp_path / "events").mkdir()
    repo = Path(__file__).resolve().parents[1]
    job = JOB.replace('kind.endswith("append")', '"append" in kind')
    subprocess.run(
        [sys.executable, "-c", job, str(repo), str(tmp_path), f"released {mode}csv"],
        check=True,
        timeout=300,
        capture_output=True,
    )
    assert scans_of_source(tmp_path) == [1, 1]
