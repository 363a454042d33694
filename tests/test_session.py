"""Where checkpoints and scratch output go."""

from types import SimpleNamespace

import pytest

from linkrank.session import (
    WIDTH_SETTING,
    clear_scratch,
    default_width,
    ensure_checkpoint_dir,
    fit_width,
    scratch_path,
    shuffle_width,
)


def fake(master, settings, current=None):
    sc = SimpleNamespace(master=master, folder=current)
    sc.getCheckpointDir = lambda: sc.folder
    sc.setCheckpointDir = lambda folder: setattr(sc, "folder", folder)
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)))


def test_the_named_folder_is_used():
    assert ensure_checkpoint_dir(fake("yarn", {"spark.checkpoint.dir": "hdfs:///ck"})) == "hdfs:///ck"
    assert ensure_checkpoint_dir(fake("yarn", {}, current="hdfs:///set")) == "hdfs:///set"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake("spark://host:7077", {}))
    assert "linkrank-checkpoints-" in ensure_checkpoint_dir(fake("local[4]", {}))


def test_scratch_paths_lie_in_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(ensure_checkpoint_dir(spark))


def test_scratch_can_be_cleared(spark):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_width_for_a_time(spark):
    with pytest.raises(ZeroDivisionError), shuffle_width(spark, 3):
        assert default_width(spark) == 3
        1 / 0
    assert default_width(spark) == 8


def test_width_is_that_of_a_shuffle():
    adaptive = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
    }
    assert default_width(fake("local", adaptive)) == 8
    initial = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40"}
    assert default_width(fake("local", adaptive | initial)) == 40
    assert default_width(fake("local", adaptive | initial | {"spark.sql.adaptive.enabled": "false"})) == 8


def test_fitted_width(spark):
    own = spark.newSession()
    table = own.range(0, 100, 1, 30)
    assert fit_width(table) == 8  # configured for this session
    assert fit_width(table, 12) == 12 and own.conf.get(WIDTH_SETTING) == "12"
    assert default_width(spark) == 8


@pytest.mark.parametrize("splits,cores,width", [(3, 16, 16), (500, 16, 500), (10**6, 16, 10**6)])
def test_width_follows_the_input(splits, cores, width):
    settings = {WIDTH_SETTING: "200", "spark.sql.adaptive.enabled": "false"}
    session = fake("yarn", settings)
    session.conf.set = lambda key, value: settings.__setitem__(key, str(value))
    session.sparkContext.defaultParallelism = cores
    session.sparkContext.getConf = lambda: SimpleNamespace(contains=lambda key: False)
    table = SimpleNamespace(sparkSession=session, rdd=SimpleNamespace(getNumPartitions=lambda: splits))
    assert fit_width(table) == width
