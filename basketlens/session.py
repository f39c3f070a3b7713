"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "basketlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    ``master`` is left to spark-submit unless given.  Keyword settings use
    ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="4000"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a single-machine session (tests, trials) gets one folder of its own; any other raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and every executor can reach")
        root = tempfile.mkdtemp(prefix="basketlens-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files: for writes, whose plan is not run again."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


def materialise(df, purpose: str):
    """Write ``df`` once to the shared folder and read it back.

    Used for intermediate tables that several later steps read: they are
    computed once, survive the loss of an executor, and have known sizes.
    Their shuffle files go as soon as they are written.
    """
    path = scratch_path(df.sparkSession, purpose)
    with freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one operation.

    Results are lazy and may read them, so they stay until ``drop`` is called, or until the shared folder is cleared after the job.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark, self.root = spark, scratch_path(spark, purpose)

    def write(self, df, name: str):
        """``df`` written below this scratch folder and read back; ``name`` is used once."""
        path = f"{self.root}/{name}"
        with freed(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the named tables, or everything when none is named."""
        for name in names or [""]:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
