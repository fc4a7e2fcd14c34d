"""Distinct (group, peer) rows of every hour, stored once and merged for any window.

A distinct count cannot be merged from counts, but it can from the distinct
rows below it.  They are the log's own reduction: texts are normalised, hours
turned into buckets, rows of other codes gone, repeats within an hour made
one.  Batches of days or months, the hourly batches, and batches with another
list or threshold are then counted without reading the log again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peerwatch.functions import hours
from peerwatch.operators.detect import HOURLY, prepare, senders_of
from peerwatch.schema import LOG
from peerwatch.session import child_names, remove_folder, work_folder
from peerwatch.sources.logs import empty


class PeerPartials:
    """One folder per hour, named by the end of the hour (its batch id).

    The bucket format, code and text length are those of all batches that are
    to be counted from it.  ``log_schema`` tells whether numbers are stored
    as such or as text.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        code: int | None = 49,
        min_len: int = 10,
        bucket_format: str = hours.BUCKET_HOUR,
        log_schema: StructType = LOG,
    ):
        self.spark = spark
        self.path = path
        self.bucket_format = bucket_format
        self._conditions = {"code": code, "min_len": min_len, "bucket_format": bucket_format}
        self.schema = self._rows(empty(spark, log_schema), (0, 0)).schema

    def _rows(self, log: DataFrame, window: tuple[int, int]) -> DataFrame:
        return prepare(log, window, batch_ids=HOURLY, **self._conditions)

    def create(self) -> "PeerPartials":
        """Start (again) without any hour."""
        self._writer(empty(self.spark, self.schema), "static").parquet(self.path)
        return self

    def add(self, log: DataFrame, window: tuple[int, int]) -> None:
        """Make the hours of a window what the log says, also those that were there before.

        The new rows lie aside before any folder is replaced.  A failure
        leaves former or new hours, and the same call mends it.
        """
        staged = work_folder(self.spark)
        self._rows(log, window).distinct().write.parquet(staged)
        rows = self.spark.read.schema(self.schema).parquet(staged)
        new = {r["ad"] for r in rows.select("ad").distinct().collect()}  # at most one for each hour of the window
        stored = {hour for hour in self.stored_hours() if window[0] < hour <= window[1]}
        self._writer(rows.hint("rebalance", "ad"), "dynamic").parquet(self.path)
        for hour in sorted(stored - new):
            remove_folder(self.spark, f"{self.path}/ad={hour}")
        remove_folder(self.spark, staged)

    def stored_hours(self) -> list[int]:
        """Ends of the hours that have rows, from the names of their folders."""
        names = child_names(self.spark, self.path)
        return sorted(int(n.removeprefix("ad=")) for n in names if n.startswith("ad=") and n[3:].isdigit())

    @staticmethod
    def _writer(rows: DataFrame, mode: str):
        return rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("ad")

    def read(self, window: tuple[int, int]) -> DataFrame:
        """The rows of a window of real hours; other folders are not opened."""
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        start, end = window
        return rows.where((F.col("ad") > int(start)) & (F.col("ad") <= int(end)))

    def mass_senders(
        self, exclusion: DataFrame | None, window: tuple[int, int], *, batch_ids=None, min_peers: int = 10, broadcast: bool | None = None
    ) -> DataFrame:
        """The answer of :func:`peerwatch.operators.detect.mass_senders`, from the stored rows."""
        return senders_of(
            self.read(window), exclusion, window, batch_ids=batch_ids, min_peers=min_peers, broadcast=broadcast, bucket_format=self.bucket_format
        )
