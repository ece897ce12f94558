"""Scratch folder resolution: shared folder from the session, local only in local mode."""

import pytest

from storefront_etl.sources.parquet import drop_scratch, scratch_path, scratch_root


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master = master
        self.checkpoint = checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


class _Session:
    def __init__(self, conf_value, master, checkpoint=None):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Context(master, checkpoint)


def test_shared_folder_from_session_conf():
    s = _Session("hdfs:///shared/scratch/", "yarn")
    assert scratch_root(s) == "hdfs:///shared/scratch"
    assert scratch_path(s, "x").startswith("hdfs:///shared/scratch/x-")


def test_checkpoint_dir_set_on_context_is_used():
    assert scratch_root(_Session(None, "yarn", "s3a://bucket/ckpt")) == "s3a://bucket/ckpt"


def test_missing_setting_is_an_error_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_Session(None, "spark://master:7077"))


def test_local_mode_gets_a_local_folder_and_the_session_stays_as_it_is():
    s = _Session(None, "local[4]")
    root = scratch_root(s)
    assert root == scratch_root(s) and s.sparkContext.checkpoint is None


def test_drop_scratch_deletes_what_was_written(spark):
    path = scratch_path(spark, "dropped")
    spark.range(3).write.parquet(path)
    other = f"{scratch_root(spark)}/kept"
    spark.range(3).write.mode("overwrite").parquet(other)
    assert drop_scratch(spark) >= 1
    assert spark.read.parquet(other).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_scratch_of_one_step_is_dropped(spark):
    from storefront_etl.sources.parquet import given_scratch

    first = scratch_path(spark, "first")
    spark.range(3).write.parquet(first)
    before = set(given_scratch())
    second = scratch_path(spark, "second")
    spark.range(5).write.parquet(second)
    assert drop_scratch(spark, [p for p in given_scratch() if p not in before]) == 1
    assert first in given_scratch() and second not in given_scratch()
    assert spark.read.parquet(first).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(second).count()
