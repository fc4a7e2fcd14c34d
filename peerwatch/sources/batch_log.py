"""The log of finished batches and the restart point read from it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.schema import BATCH_LOG
from peerwatch.sources.logs import empty, literal_rows


class BatchLog:
    """One row per finished batch, also for a batch without result rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def create(self) -> "BatchLog":
        empty(self.spark, BATCH_LOG).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path)
        return self

    def read(self) -> DataFrame:
        return self.spark.read.schema(BATCH_LOG).parquet(self.path)

    def append(self, batch_ids) -> None:
        """Add batches that are not there yet, all of them in one small file."""
        rows = literal_rows(self.spark, [(b,) for b in dict.fromkeys(str(int(b)) for b in batch_ids)], BATCH_LOG)
        rows = rows.join(self.read(), "batchId", "left_anti").coalesce(1)
        rows.write.mode("append").parquet(self.path)

    def last(self) -> int:
        """The newest finished batch: where the next run starts."""
        newest = last_batch(self.read()).first()["lastdate"]
        if newest is None:
            raise LookupError(f"no batch has finished yet according to {self.path}")
        return newest


def last_batch(log: DataFrame) -> DataFrame:
    """One row with the newest batch id, compared as a number."""
    return log.agg(F.max(F.col("batchId").cast("bigint")).alias("lastdate"))
