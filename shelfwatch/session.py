"""Spark session helpers.

Everything in the library takes a ``SparkSession`` from the caller; these helpers only
exist so tests, the bench and the entry module build the same session, and so jobs that
need a lineage cut find the shared checkpoint folder the cluster configures.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime defaults, set only where the session has no value of its own.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HTML pages can be large; keep Arrow batches small so a Python worker never holds
    # more than a few thousand pages at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "shelfwatch",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build one; unset keys get the library defaults.

    A key that the submitter or the caller has set (``--conf``, spark-defaults, session
    configuration) keeps its value.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", "16g")
    spark = SparkSession.getActiveSession() or builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    have = spark.conf.getAll
    wanted = dict(_DEFAULTS)
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in wanted.items():
        if k not in have:
            spark.conf.set(k, v)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the workers, once per Spark context.

    Python stages refer to their functions by module name. Where the driver alone has the
    package on its path, Spark distributes a zip of it; a submitter's ``--py-files`` or an
    installed package does no harm.
    """
    sc = spark.sparkContext
    if getattr(sc, "_shelfwatch_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="shelfwatch-ship-")       # of the driver; Spark serves the file from it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "shelfwatch.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._shelfwatch_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is never overridden; without it
    a cluster job stops here, because a machine-local folder would lose data. Only a local
    master (tests) gets a private folder.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if path:
        if not current.isDefined():
            sc.setCheckpointDir(path)
        return path
    if not current.isDefined():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        # ``spark.checkpoint.dir`` itself cannot be changed at run time, so the context's
        # checkpoint directory is set instead.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwatch-ckpt-"))
        current = sc._jsc.sc().getCheckpointDir()
    return current.get()


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A new folder under the shared checkpoint folder, for tables that lazy results read.

    The file system removes it when the application ends, so repeated jobs leave nothing behind
    and results stay readable as long as they can be used.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


@contextlib.contextmanager
def checkpointed(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared checkpoint folder for the time of the block.

    Reliable (it survives lost executors) and removed afterwards, so repeated loads leave
    nothing behind.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/shelfwatch-tmp-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        p = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
