"""Session settings and the shared scratch folder that long plans cut their lineage with."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings of a local session; on a cluster the submit command decides.
LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.host": "127.0.0.1",
}


def local_session(cpus: int = 8, **settings: str) -> SparkSession:
    """A session for tests and the bench, with as many shuffle partitions as cores."""
    conf = LOCAL_SETTINGS | {"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "12g"} | settings
    return SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor sees: spark.checkpoint.dir of the session.

    Unset, a local session gets a temporary folder; on a cluster that would be a folder
    of one machine, so it is an error there.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


_LOCAL: list[tempfile.TemporaryDirectory] = []


def _local_folder() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.TemporaryDirectory(prefix="quantarium-"))
        atexit.register(_LOCAL[0].cleanup)
    return "file://" + _LOCAL[0].name


_ROOTS: list[tuple] = []


def _clean() -> None:
    """Delete this driver's scratch tables as it ends; results may read them until then."""
    for sc, root in _ROOTS:
        try:
            path = sc._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(sc._jsc.hadoopConfiguration() if sc._jsc else sc._jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
        except Exception:  # the JVM went first; whoever owns the folder clears it
            return


class Scratch:
    """Tables written to the shared folder, each under a name of its own, until the driver ends.

    A table written here is read back from files, so a lost executor costs a reread and not
    a recomputation, and the plan above it starts anew.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        if not _ROOTS:
            atexit.register(_clean)
        _ROOTS.append((spark.sparkContext, self.root))

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no plan reads any more, and let Spark drop the shuffle files of plans that are gone.

        Spark does so when the driver's memory is cleaned; it holds the last job until another one has run.
        """
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
        self.spark.range(1).count()
        jvm.System.gc()


#: Bytes of one Arrow batch on its way to a Python worker and back, where the session has Spark's default.
ARROW_BATCH_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers started elsewhere than in the repository, and keep their batches small."""
    batch = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(batch, str(64 << 20)).rstrip("b") == str(64 << 20):
        spark.conf.set(batch, str(ARROW_BATCH_BYTES))
    root = Path(__file__).resolve().parent.parent
    here = {str(Path(p or ".").resolve()) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)} | {os.getcwd()}
    sc = spark.sparkContext
    if str(root) in here or sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    # the driver serves the file to executors as they come, so it stays until the driver ends
    folder = tempfile.TemporaryDirectory(prefix="quantarium-package-")
    atexit.register(folder.cleanup)
    sc.addPyFile(shutil.make_archive(f"{folder.name}/quantarium", "zip", root, "quantarium"))


#: Applications whose executors have the package.
_SHIPPED: set[str] = set()


#: Rows of one batch of the Parquet reader over a table of texts, where the session has Spark's default.
READ_BATCH_ROWS = 256


def small_reads(spark: SparkSession) -> None:
    """Keep the Parquet reader's batches small: it holds a batch's texts as one array and doubles it as it fills, so the heap grows by tens of megabytes a task at 4096 rows."""
    rows = "spark.sql.parquet.columnarReaderBatchSize"
    if spark.conf.get(rows, "4096") == "4096":
        spark.conf.set(rows, str(READ_BATCH_ROWS))
