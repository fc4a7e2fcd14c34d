"""The stored detection result: one folder per batch, replaced as a whole.

Running a batch again must leave exactly its new rows, also when there are
fewer of them or none, in any session and for any bucket format:

1. the new rows are written aside, so a detection that fails leaves the former
   batch as it was;
2. one dynamic overwrite puts them in place, bucket by bucket;
3. folders of buckets that the batches have no longer are removed.

What is stored is read from the names of folders, so neither clearing nor
replacing runs a job per batch.  A failure between the last two steps leaves
buckets of the former run beside the new ones, never a batch without rows; the
next run of the batch removes them.
"""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from peerwatch.schema import RESULT, RESULT_PARTITIONS
from peerwatch.session import child_names, remove_folder, work_folder
from peerwatch.sources.logs import empty


def observed(observation: Observation) -> dict:
    """The observed values, or none of them if the rows were found to be
    empty at run time and the observed step was skipped."""
    try:
        return observation.get
    except (Py4JJavaError, PySparkException):
        return {}


class ResultStore:
    """Detection results below one path, partitioned by (``ad``, ``bd``)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def create(self) -> "ResultStore":
        """Start (again) with no rows."""
        self._writer(empty(self.spark, RESULT), "overwrite").partitionBy(*RESULT_PARTITIONS).parquet(self.path)
        return self

    truncate = create

    def read(self) -> DataFrame:
        return self.spark.read.schema(RESULT).parquet(self.path)

    def read_batches(self, batch_ids) -> DataFrame:
        """Rows of some batches; the others' folders are not opened."""
        return self.read().where(F.col("ad").isin([int(b) for b in batch_ids]))

    def append(self, rows: DataFrame) -> None:
        """Add rows, each to its own (``ad``, ``bd``) partition."""
        self._writer(self._by_partition(rows), "append").partitionBy(*RESULT_PARTITIONS).parquet(self.path)

    def overwrite_partitions(self, rows: DataFrame) -> None:
        """Replace the (``ad``, ``bd``) partitions that ``rows`` fill and leave
        all others alone."""
        self._writer(self._by_partition(rows), "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *RESULT_PARTITIONS
        ).parquet(self.path)

    def replace_batch(self, rows: DataFrame, batch_id: int) -> bool:
        """Make ``rows`` the whole content of one batch; rows of others are
        left out.  True if the batch had rows before."""
        return bool(self.replace_batches(rows.where(F.col("ad") == F.lit(int(batch_id))), [batch_id]))

    def replace_batches(self, rows: DataFrame, batch_ids) -> set[int]:
        """Make ``rows`` the whole content of many batches, from one pass over
        them.  Returns the batches that had rows before."""
        wanted = [int(b) for b in batch_ids]
        ad = F.col("ad")
        checked = F.when(ad.isin(wanted), ad).otherwise(
            F.raise_error(F.concat(F.lit("row of a batch that is not replaced: "), ad.cast("string"))).cast("bigint")
        )
        aside = ResultStore(self.spark, work_folder(self.spark))
        aside._writer(self._by_partition(rows.withColumn("ad", checked)), "overwrite").partitionBy(*RESULT_PARTITIONS).parquet(aside.path)
        before, new = self._held(wanted), aside._held(wanted)
        self.overwrite_partitions(aside.read())
        self._remove(before - new)
        remove_folder(self.spark, aside.path)
        return {ad for ad, _ in before}

    def clear_batches(self, batch_ids) -> None:
        """Leave no row of the batches: folders are removed, no job runs."""
        self._remove(self._held(batch_ids))

    def filled(self, batch_ids) -> set[int]:
        """Those of some batches that have rows."""
        return {ad for ad, _ in self._held(batch_ids)}

    def _held(self, batch_ids) -> set[tuple[int, str]]:
        """(batch, folder name of the bucket) of what is stored of some batches."""
        stored = set(child_names(self.spark, self.path))
        found = [int(b) for b in batch_ids if f"ad={int(b)}" in stored]
        return {(ad, name) for ad in found for name in child_names(self.spark, f"{self.path}/ad={ad}") if name.startswith("bd=")}

    def _remove(self, held: set[tuple[int, str]]) -> None:
        for ad, name in sorted(held):
            remove_folder(self.spark, f"{self.path}/ad={ad}/{name}")

    @staticmethod
    def _by_partition(rows: DataFrame) -> DataFrame:
        """Few even files per partition; a large partition is split."""
        return rows.select(*RESULT.names).hint("rebalance", *RESULT_PARTITIONS)

    @staticmethod
    def _writer(rows: DataFrame, mode: str):
        """An overwrite replaces all of its path, also where the session overwrites
        single partitions."""
        return rows.write.mode(mode).option("partitionOverwriteMode", "static")
