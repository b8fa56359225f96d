from types import SimpleNamespace

import pytest

from conftest import values
from yieldmill import session


def fake(master, setting=None, checkpoint=None):
    context = SimpleNamespace(
        master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: checkpoint
    )
    conf = SimpleNamespace(get=lambda name, default: setting or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_setting_comes_first():
    assert session.shared_folder(fake("yarn", "hdfs://x/cp/", "hdfs://y")) == "hdfs://x/cp"
    assert session.shared_folder(fake("yarn", None, "hdfs://y")) == "hdfs://y"


def test_only_a_local_session_may_go_without():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("yarn"))
    first = session.shared_folder(fake("local[2]"))
    assert first == session.shared_folder(fake("local[2]"))


def test_materialised_rows_are_read_from_the_shared_folder(spark):
    df = session.materialise(spark.range(3), "numbers")
    assert values(df) == [(0,), (1,), (2,)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan


def test_few_rows_go_to_few_files(spark):
    df = spark.range(300).repartition(100, "id")
    assert df.rdd.getNumPartitions() == 100
    held = session.materialise(df, "few", rows=300)
    assert len(held.inputFiles()) <= spark.sparkContext.defaultParallelism
    many = session.materialise(df, "many", rows=50 * session.FILE_ROWS)
    assert spark.sparkContext.defaultParallelism < len(many.inputFiles()) <= 50
    assert sorted(r.id for r in held.collect()) == sorted(r.id for r in many.collect()) == list(range(300))
