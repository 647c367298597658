"""Shared folders and kept inputs."""

import pytest
from pyspark.sql import functions as F

from tablewright import session


class Named:
    """A session on a cluster, with or without a shared folder in its settings."""

    def __init__(self, folder):
        self.conf = self
        self.sparkContext = self
        self.master = "spark://cluster:7077"
        self.folder = folder

    def get(self, name, default=None):
        return self.folder

    def getConf(self):
        return self


def test_shared_folder_is_the_clusters():
    assert session.shared_folder(Named("/shared/work/")) == "/shared/work"
    with pytest.raises(ValueError, match="every executor"):
        session.shared_folder(Named(None))


def test_durable_cuts_the_lineage(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    kept = session.durable(df)
    assert sorted(r["x"] for r in kept.collect()) == list(range(0, 20, 2))
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_reused_releases_the_table(spark):
    df = spark.range(10)
    with session.reused(df) as kept:
        assert kept.is_cached
    assert not df.is_cached
