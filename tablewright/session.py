"""Session settings shared by tests, the benchmark and interactive use."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_shipped: set[str] = set()


def build_session(app: str = "tablewright", master: str | None = None, cpus: int = 8) -> SparkSession:
    """A session with adaptive execution on; a cluster's own settings win over these defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master is not None:
        builder = (
            builder.master(master)
            .config("spark.sql.shuffle.partitions", str(cpus))
            .config("spark.driver.memory", "12g")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a local one only where none is named and the
    master is local."""
    shared = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="tablewright-", dir=os.environ.get("TMPDIR", "/tmp"))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python tasks can import it wherever
    the application was started."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):  # else the package already came as an archive
        archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), "tablewright_package.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.join("tablewright", os.path.relpath(path, package)))
        spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` for the several passes of an iterative learner. A lost block is recomputed."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's shared checkpoint folder, so that several passes over it
    read the same stored rows and a lost executor costs a re-read instead of a recomputation."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
