"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def get_session(app: str = "stackweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and Arrow batches sized for whole frames."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # One Arrow row is one whole frame, so the row count per batch bounds worker memory.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Not needed where it is installed on the cluster or given with ``--py-files``.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="stackweave-code-"), "stackweave")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="stackweave-")
    return _local_dirs[app]


def fit_arrow_batches(spark: SparkSession, pixels: int, megabytes: int = 64) -> None:
    """Set the rows per Arrow batch so that a batch of frames with ``pixels`` values stays small."""
    rows = max(1, min(10_000, megabytes * 1024 * 1024 // (8 * max(pixels, 1))))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def hadoop_path(spark: SparkSession, path: str):
    """The file system and path handle Spark itself would use for ``path``."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def delete_path(spark: SparkSession, path: str) -> None:
    fs, handle = hadoop_path(spark, path)
    fs.delete(handle, True)


#: Frees the shuffle files of a statement when it ends, not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Written intermediates of one job: cut lineage, survive lost executors, keep statistics."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.step = 0

    def write(self, df: DataFrame, **options: str) -> DataFrame:
        self.step += 1
        path = f"{self.root}/{self.step:04d}"
        before = self.spark.conf.get(FREE_SHUFFLES, None)
        self.spark.conf.set(FREE_SHUFFLES, "true")
        try:
            df.write.options(**options).parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(FREE_SHUFFLES)
            else:
                self.spark.conf.set(FREE_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_before(self, step: int) -> None:
        """Remove a step that no later step reads any more."""
        if step > 0:
            delete_path(self.spark, f"{self.root}/{step:04d}")

    def clear(self) -> None:
        delete_path(self.spark, self.root)
