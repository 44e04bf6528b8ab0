"""Tables that outlive executors."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from touchline.session import SHUFFLE_CLEANUP, durable_dir, shuffles_dropped, written

from tests.league import rows


def fake(master, configured=None, current=None):
    state = SimpleNamespace(directory=current)
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state.directory,
        setCheckpointDir=lambda path: setattr(state, "directory", path),
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured or default))


def test_the_configured_folder_is_used():
    assert durable_dir(fake("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert durable_dir(fake("yarn", "hdfs:///shared", "hdfs:///current")) == "hdfs:///current"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        durable_dir(fake("yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        durable_dir(fake("spark://host:7077"))


def test_local_mode_makes_its_own(tmp_path):
    assert "touchline-" in durable_dir(fake("local[4]"))


def test_written_tables_are_read_from_files(spark):
    df = written(spark.range(5).selectExpr("id", "cast(id as string) AS s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Range" not in plan
    assert rows(df) == [(i, str(i)) for i in range(5)]


def test_writing_a_table_leaves_the_callers_setting(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP)
    held = written(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count())
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
    assert sorted(held.collect()) == sorted(written(held).collect())
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
