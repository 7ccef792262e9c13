from __future__ import annotations

import pytest

from moodstream import session


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self.folder


class _Spark:
    def __init__(self, context, conf):
        self.sparkContext, self.conf = context, conf


def test_shared_folder_of_the_cluster_is_used():
    assert session.shared_dir(_Spark(_Context("spark://x"), {"spark.checkpoint.dir": "hdfs://a/b"})) == "hdfs://a/b"
    assert session.shared_dir(_Spark(_Context("spark://x", "hdfs://c"), {})) == "hdfs://c"


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        session.shared_dir(_Spark(_Context("spark://x"), {}))


def test_paths_are_fresh_and_tables_survive(spark):
    assert session.new_path(spark, "x") != session.new_path(spark, "x")
    df = session.materialise(spark.range(5), "five")
    assert df.count() == 5 and "parquet" in df._jdf.queryExecution().executedPlan().toString().lower()
