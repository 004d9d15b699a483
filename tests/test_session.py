"""Session helpers: checkpoint folder rules, lineage cuts, scopes, bounded lookups."""

import pytest
from pyspark.sql import functions as F

from tessera import session as sess
from tessera.operators import aggregates as agg
from tessera.sources.tables import Tables
from tests.conftest import SF_SMALL


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master = master
        self._ckpt = ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Ctx(master, ckpt)


def test_checkpoint_root_rules():
    assert sess.checkpoint_root(_Session("yarn", {"spark.checkpoint.dir": "hdfs:///ck"})) == "hdfs:///ck"
    assert sess.checkpoint_root(_Session("yarn", ckpt="s3a://b/ck")) == "s3a://b/ck"
    with pytest.raises(RuntimeError):
        sess.checkpoint_root(_Session("spark://host:7077"))
    local = _Session("local[2]")
    root = sess.checkpoint_root(local)
    assert root and local.sparkContext.getCheckpointDir() == root


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).select((F.col("id") * 2).alias("x"))
    cut = sess.materialize(df, "t")
    assert sorted(r.x for r in cut.collect()) == list(range(0, 20, 2))
    root = sess.checkpoint_root(spark).rstrip("/").removeprefix("file:")
    files = cut.inputFiles()
    assert files and all(root in f for f in files)


def test_lookup_checks_its_bound(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, name string")
    small = spark.createDataFrame([(2, 10.0), (9, 1.0)], "k long, v double")
    got = sorted(tuple(r) for r in agg.lookup(small, dim, "k", 2).collect())
    assert got == [(2, 10.0, "b"), (9, 1.0, None)]
    with pytest.raises(ValueError):
        agg.lookup(small, dim, "k", 1)


def test_scratch_scope_removes_only_its_tables(spark):
    import os
    keep = sess.materialize(spark.range(3), "keep")
    with sess.scratch_scope(spark) as created:
        tmp = sess.materialize(spark.range(5), "tmp")
        assert tmp.count() == 5
        paths = list(created)
    assert len(paths) == 1
    local = [p.removeprefix("file:") for p in paths]
    assert not any(os.path.exists(p) for p in local)
    assert keep.count() == 3
