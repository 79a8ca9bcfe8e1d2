"""Scratch-folder rules: read spark.checkpoint.dir from the session, set one
only for a local master, refuse a cluster without a shared folder."""

import pytest

from kestrel import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, ckpt=None):
        self.master, self.ckpt = master, ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.ckpt = path


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf, self.sparkContext = _Conf(conf or {}), _Context(master, ckpt)


def test_configured_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt/"})
    assert session.checkpoint_dir(s) == "hdfs://nn/ckpt"
    assert session.scratch_path(s, "x").startswith("hdfs://nn/ckpt/kestrel/x-")


def test_cluster_without_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(_Session("spark://master:7077"))


def test_local_without_folder_gets_a_temp_one():
    s = _Session("local[2]")
    base = session.checkpoint_dir(s)
    assert base and s.sparkContext.getCheckpointDir() == base


def test_scratch_is_deleted_on_request(spark):
    from kestrel.session import clear_scratch, scratch_path

    clear_scratch(spark)
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
