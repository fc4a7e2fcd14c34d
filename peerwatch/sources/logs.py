"""Reading and writing the log and other plain columnar tables."""

from contextlib import nullcontext

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from peerwatch.operators.filters import in_window
from peerwatch.schema import LOG
from peerwatch.session import unsorted_partitions


def write_log(
    log: DataFrame,
    path: str,
    *,
    partition_by=("f31",),
    mode: str = "append",
    files: int | None = None,
    rebalance: bool = False,
    compression: str = "zlib",
    file_rows: int = 0,
    sort_by=(),
    look_up=(),
) -> None:
    """Append a log as partitioned ORC.

    ``files`` merges tasks down to that number without a shuffle.
    ``rebalance`` shuffles by partition value towards even file sizes: small
    partitions share a task and a large one is split over many.  The default
    partition column is the one that batches filter on, so that they skip
    whole folders; ``cp`` and ``ld`` are ordinary columns.  ``file_rows``
    bounds the rows of a file, so that a large hour gets many files.

    ``sort_by`` sorts the rows of each task within a partition, so that a
    row group holds a narrow range of them; ``look_up`` names columns that get
    Bloom filters per row group.  With both, one sender's rows are found by
    reading few row groups of an hour (see :func:`sender_history`).  Otherwise
    rows are written as they come, without a sort by partition, where a task
    has few partitions.
    """
    if rebalance:
        log = log.hint("rebalance", *partition_by)
    if files is not None:
        log = log.coalesce(files)
    if sort_by:
        log = log.sortWithinPartitions(*partition_by, *sort_by)
    writer = log.write.mode(mode).partitionBy(*partition_by).option("compression", compression)
    if look_up:
        writer = writer.option("orc.bloom.filter.columns", ",".join(look_up)).option("orc.bloom.filter.fpp", "0.01")
    # What is sorted on purpose must stay so within each partition.
    with nullcontext() if sort_by else unsorted_partitions(log.sparkSession):
        writer.option("maxRecordsPerFile", file_rows).orc(path)


def sender_history(log: DataFrame, numbers, window: tuple[int, int]) -> DataFrame:
    """All rows of a few senders within a window of hours.

    Hours outside the window are not opened; within the others the filter on
    the number reaches the ORC reader, which skips the row groups whose range
    or Bloom filter tells that no such number is there.
    """
    return in_window(log, "f31", *window).where(F.col("f02").isin([int(n) for n in numbers]))


def read_log(spark: SparkSession, path: str, schema: StructType = LOG) -> DataFrame:
    return spark.read.schema(schema).orc(path)


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def literal_rows(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    """A few driver-side rows, handed over as one Arrow table."""
    columns = list(zip(*rows)) if rows else [()] * len(schema.fields)
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(
        pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow), schema
    )


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, all columns."""
    return literal_rows(spark, [], schema)
