from pathlib import Path
from threading import Event

import pytest
from pyspark.sql import functions as F

from cleargrist import checkpoint, input_fingerprint, materialize
from cleargrist.operators.observed import observed_metrics
from cleargrist.workspace import scratch_path

def count():
    return F.count(F.lit(1)).alias("n")


def test_reuse_with_the_same_key_only(spark, out):
    first = materialize(spark.range(5), out("t"), "k1", [count()])
    assert (first.reused, first.metrics, first.table.count()) == (False, {"n": 5}, 5)
    again = materialize(spark.range(7), out("t"), "k1", [count()])
    assert (again.reused, again.metrics, again.table.count()) == (True, {"n": 5}, 5)
    other = materialize(spark.range(7), out("t"), "k2", [count()])
    assert (other.reused, other.metrics, other.table.count()) == (False, {"n": 7}, 7)


def test_other_columns_or_metrics_are_not_reused(spark, out):
    materialize(spark.range(5), out("t"), "k")
    assert not materialize(spark.range(5).withColumnRenamed("id", "x"), out("t"), "k").reused
    assert not materialize(spark.range(5).withColumnRenamed("id", "x"), out("t"), "k", [count()]).reused


def test_a_write_that_failed_is_not_reused(spark, out):
    materialize(spark.range(5), out("t"), "k1")
    bad = spark.range(5).filter(F.raise_error(F.lit("no")).isNull())
    with pytest.raises(Exception, match="no"):
        materialize(bad, out("t"), "k2")
    assert not materialize(spark.range(5), out("t"), "k2").reused
    assert materialize(spark.range(5), out("t"), "k2").reused


def test_lineage_is_cut(spark, out):
    stored = materialize(spark.range(5).withColumn("r", F.rand()), out("t"), "k").table
    plan = stored._jdf.queryExecution().optimizedPlan().toString()
    assert "rand" not in plan and "Range" not in plan
    assert stored.collect() == stored.collect()


def test_empty_table(spark, out):
    empty = materialize(spark.range(0), out("t"), "k", [count()])
    assert (empty.metrics, empty.table.count()) == ({"n": 0}, 0)


def test_column_names_survive(spark, out):
    frame = spark.createDataFrame([(1, 2)], "`Unnamed: 0` int, `a.b` int")
    stored = materialize(frame, out("t"), "k").table
    assert stored.columns == ["Unnamed: 0", "a.b"]
    assert [tuple(r) for r in stored.collect()] == [(1, 2)]


class LostEvent:
    """An observation whose event never comes."""

    @property
    def get(self):
        Event().wait()


def test_metrics_are_computed_again_if_their_event_is_lost(spark):
    def recompute():
        return spark.range(5).agg(count()).first()

    with pytest.warns(RuntimeWarning, match="computing them again"):
        assert observed_metrics(LostEvent(), recompute, patience=0.1) == {"n": 5}


def test_an_older_table_stays_readable(spark, out):
    first = materialize(spark.range(5), out("t"), "k1").table
    materialize(spark.range(7), out("t"), "k2")
    assert first.count() == 5
    assert materialize(spark.range(9), out("t"), "k1").table.count() == 5


def test_a_key_that_went_stale_is_not_kept(spark, out):
    with pytest.warns(UserWarning, match="changed"):
        assert materialize(spark.range(5), out("t"), "k", still_true=lambda: False).table.count() == 5
    assert not materialize(spark.range(5), out("t"), "k", still_true=lambda: True).reused
    assert materialize(spark.range(5), out("t"), "k", still_true=lambda: False).reused


def test_fingerprint_follows_the_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x\n1\n")
    first = input_fingerprint(spark, str(folder))
    assert input_fingerprint(spark, str(folder)) == first
    (folder / "b.csv").write_text("x\n2\n")
    second = input_fingerprint(spark, str(folder))
    (folder / "b.csv").write_text("x\n23\n")
    third = input_fingerprint(spark, str(folder))
    both = [str(folder / "a.csv"), str(folder / "b.csv")]
    assert len({first, second, third}) == 3
    assert input_fingerprint(spark, both) == third


def test_scratch_paths_are_new_and_in_the_shared_folder(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or one.startswith(shared.rstrip("/") + "/")
    assert not Path(one).exists()


class FakeSession:
    def __init__(self, **settings):
        self.conf = settings


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession(**{"spark.master": "yarn"}), "x")
    local = {"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/w"}
    assert scratch_path(FakeSession(**local), "x").startswith("file:/w/cleargrist/x-")
    shared = {"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://n/shared/"}
    assert scratch_path(FakeSession(**shared), "x").startswith("hdfs://n/shared/cleargrist/x-")


def test_two_runs_of_one_key_do_not_disturb_each_other(spark, out):
    """The second run begins before the first has ended, and writes while its table is in use."""
    first = []

    def slower_run():
        first.append(materialize(spark.range(5), out("t"), "k", [count()]))
        return True

    second = materialize(spark.range(5).repartition(2), out("t"), "k", [count()], still_true=slower_run)
    assert not first[0].reused and not second.reused
    assert first[0].table.count() == second.table.count() == 5
    files = [set(run.table.inputFiles()) for run in (*first, second)]
    assert not files[0] & files[1]
    third, fourth = (materialize(spark.range(9), out("t"), "k", [count()]) for _ in range(2))
    assert third.reused and third.metrics == {"n": 5}
    assert set(third.table.inputFiles()) == set(fourth.table.inputFiles()) in files


def test_a_table_in_folders_by_a_value(spark, out):
    frame = spark.range(6).select("id", F.when(F.col("id") % 3 == 0, "Y").otherwise("N").alias("flag"))
    for reused in (False, True):
        stored = materialize(frame, out("t"), "k", [count()], partition_by="flag")
        assert (stored.reused, stored.metrics) == (reused, {"n": 6})
        assert sorted(map(tuple, stored.table.collect())) == sorted(map(tuple, frame.collect()))
    assert not materialize(frame, out("t"), "k", [count()]).reused


@pytest.mark.parametrize("eager", [True, False])
def test_reliable_checkpoint(spark, eager):
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = len(list(folder.rglob("part-*")))
    kept = checkpoint(spark.range(0, 20, 1, 2).withColumn("r", F.rand()), eager)
    assert (len(list(folder.rglob("part-*"))) > before) == eager
    assert kept.collect() == kept.collect()
    assert len(list(folder.rglob("part-*"))) > before
    assert "rand" not in kept._jdf.queryExecution().optimizedPlan().toString()
