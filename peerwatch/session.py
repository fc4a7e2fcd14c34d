"""Session settings and the shared working folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "*", *, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("peerwatch")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Plans are built from many small expressions; do not look up the
        # Python line of each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="peerwatch-warehouse-"))
        .getOrCreate()
    )


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies; none is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder: one call to the file system, no job."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]


#: Partitions that a writing task keeps open at once, each with a file buffer; beyond them it sorts the rest.
OPEN_PARTITIONS = 16


@contextmanager
def unsorted_partitions(spark: SparkSession):
    """Partitioned writes within need no sort: a task that fills few partitions keeps a file of each open.

    A task with more of them sorts its other rows, as all tasks do otherwise.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(OPEN_PARTITIONS, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def work_folder(spark: SparkSession) -> str:
    """A fresh folder path below the cluster's shared checkpoint folder.

    Only a local session may fall back to a folder of this machine: on a
    cluster other executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="peerwatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/peerwatch-{uuid.uuid4().hex}"
