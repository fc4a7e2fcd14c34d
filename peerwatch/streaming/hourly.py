"""Hourly detection as a stream.

An exact distinct count cannot be kept by a streaming aggregation, but it is
the row count of a stream without duplicates: drop repeated (group, peer)
pairs, then count per group and hour.  Both are built-in stateful operators,
spread over all tasks by their whole key; the watermark drops the state of
closed hours.  Use the RocksDB state store when an hour's pairs outgrow
executor memory.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from peerwatch.functions import hours
from peerwatch.operators.detect import GROUP_KEYS, HOURLY, finish, prepare
from peerwatch.operators.exclusion import without_listed
from peerwatch.schema import LOG, RESULT, RESULT_PARTITIONS

_EVER = (1000_01_01_00, 9999_12_31_23)


def stream_log(spark: SparkSession, path: str, *, files_per_trigger: int | None = None) -> DataFrame:
    """New files of a log folder as a stream."""
    reader = spark.readStream.schema(LOG)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.orc(path)


def stream_mass_senders(
    log: DataFrame,
    exclusion: DataFrame | None,
    *,
    lateness: str = "1 hour",
    code: int | None = 49,
    min_len: int = 10,
    min_peers: int = 10,
    broadcast: bool | None = None,
) -> DataFrame:
    """The result rows of every hour that is closed.

    An hour closes once rows later than its end by ``lateness`` (at least one
    hour, the length of a batch) have been seen; rows after that are dropped.
    """
    rows = prepare(log, _EVER, batch_ids=HOURLY, code=code, min_len=min_len)
    rows = rows.withColumn("closes", hours.hour_timestamp("ad")).withWatermark("closes", lateness)
    if exclusion is not None:
        rows = without_listed(rows, exclusion, "f02", broadcast=broadcast)
    pairs = rows.dropDuplicates([*GROUP_KEYS, "closes", "f04"])
    groups = pairs.groupBy(*GROUP_KEYS, "closes").agg(F.count("f04").alias("cnt"))
    return finish(groups.where(F.col("cnt") > min_peers), hours.BUCKET_HOUR)


def run_stream(
    log: DataFrame,
    exclusion: DataFrame | None,
    path: str,
    checkpoint: str,
    *,
    files_per_hour: int = 1,
    **options,
) -> StreamingQuery:
    """Process what is there, append all closed hours below ``path`` and stop.

    The file sink takes each micro-batch once, also after a failure.  The
    folder is the stream's own: read it with ``ResultStore(spark, path)``, but
    do not mix it with batch writes.  ``files_per_hour`` spreads the writing
    of a large hour over that many tasks.
    """
    rows = stream_mass_senders(log, exclusion, **options).select(*RESULT.names)
    part = F.pmod(F.xxhash64("f02", "f16"), F.lit(files_per_hour))
    return (
        rows.repartition(*RESULT_PARTITIONS, part)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*RESULT_PARTITIONS)
        .trigger(availableNow=True)
        .start()
    )
