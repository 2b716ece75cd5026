"""Checkpoint folder policy: read the cluster's setting; never invent a local one on a cluster."""

from __future__ import annotations

import pytest

from pitchside.session import checkpoint_dir


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):  # noqa: N802  (Spark's name)
        return self._ckpt

    def setCheckpointDir(self, path):  # noqa: N802
        self._ckpt = path


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.sparkContext = _Ctx(master, ckpt)
        self.conf = _Conf(conf or {})


def test_cluster_without_setting_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn"))


def test_cluster_setting_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"


def test_existing_context_dir_wins():
    assert checkpoint_dir(_Session("yarn", ckpt="s3a://b/ckpt")) == "s3a://b/ckpt"


def test_local_mode_gets_a_scratch_folder():
    s = _Session("local[4]")
    path = checkpoint_dir(s)
    assert path and s.sparkContext.getCheckpointDir() == path


def test_discard_removes_what_the_application_wrote(spark):
    import os

    from pitchside.sources import store

    kept = store.materialize(spark.range(4), "numbers")
    path = kept.inputFiles()[0].removeprefix("file://")
    assert kept.count() == 4 and os.path.exists(path)
    spark.sql(f"CREATE DATABASE {store.database_prefix(spark)}gone")
    spark.range(2).write.saveAsTable(f"{store.database_prefix(spark)}gone.t")
    spark.sql("CREATE DATABASE IF NOT EXISTS staying")
    other = store.folder(spark).replace(spark.sparkContext.applicationId, "another-application").removeprefix("file:")
    os.makedirs(other, exist_ok=True)
    real, store.folder = store.folder, lambda s: f"{real(s)}/inner"  # other tests' files stay
    try:
        store.materialize(spark.range(2), "inner")
        store.discard(spark)
        left = {d.name for d in spark.catalog.listDatabases()}
        assert "staying" in left and not any(d.startswith(store.database_prefix(spark)) for d in left)
        assert not os.path.exists(real(spark).removeprefix("file:") + "/inner") and os.path.exists(path) and os.path.exists(other)
    finally:
        store.folder = real
