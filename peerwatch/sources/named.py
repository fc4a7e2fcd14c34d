"""The tables of the batch jobs kept in a Spark catalog.

They have the methods of the stores by path, so that the same jobs run on either.  What a table holds is read from its
partition metadata, never from its rows, and many batches are replaced in one commit:

1. the new rows are written aside, so a detection that fails leaves everything as it was;
2. one dynamic overwrite puts them in place, partition by partition;
3. one ``ALTER TABLE .. DROP PARTITION`` with full keys removes what the batches had before and have no longer.

A failure between the last two steps leaves partitions of the former run beside the new ones, never a batch without rows; the
next run of the batches removes them.  The number of jobs does not depend on the number of batches.
"""

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peerwatch.schema import BATCH_LOG, LATEST, RESULT, RESULT_PARTITIONS, RUN_METRICS, SEEN
from peerwatch.session import remove_folder, work_folder
from peerwatch.sources import catalog
from peerwatch.sources.batch_log import last_batch
from peerwatch.sources.logs import literal_rows

#: What partition names say for NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """(ad, bd) of every partition, as its name says it: catalog metadata, no file is opened."""
    names = spark.sql(f"SHOW PARTITIONS {table}")
    return names.select(
        F.regexp_extract("partition", r"(?:^|/)ad=([^/]*)", 1).cast("bigint").alias("ad"),
        F.regexp_extract("partition", r"(?:^|/)bd=([^/]*)", 1).alias("bd"),
    )


def _literal(name: str) -> str:
    """A partition name as a value in SQL."""
    if name == NO_VALUE:
        return "null"
    return "'" + unquote(name).replace("\\", "\\\\").replace("'", "\\'") + "'"


class NamedResults:
    """Detection results in a table partitioned by (``ad``, ``bd``)."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark = spark
        self.table = table

    def create(self) -> "NamedResults":
        catalog.create_result_table(self.spark, self.table)
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.table).select(*RESULT.names)

    def read_batches(self, batch_ids) -> DataFrame:
        return self.read().where(F.col("ad").isin([int(b) for b in batch_ids]))

    def append(self, rows: DataFrame) -> None:
        catalog.insert_partitions(rows, self.table)

    def held(self, batch_ids) -> set[tuple[int, str]]:
        """(batch, partition name of the bucket) of what the table holds of some batches."""
        wanted = [int(b) for b in batch_ids]
        return {(r.ad, r.bd) for r in partitions(self.spark, self.table).where(F.col("ad").isin(wanted)).collect()}

    def filled(self, batch_ids) -> set[int]:
        return {ad for ad, _ in self.held(batch_ids)}

    def replace_batch(self, rows: DataFrame, batch_id: int) -> bool:
        """Make ``rows`` the whole content of one batch; rows of others are left out."""
        return bool(self.replace_batches(rows.where(F.col("ad") == F.lit(int(batch_id))), [batch_id]))

    def replace_batches(self, rows: DataFrame, batch_ids) -> set[int]:
        """Make ``rows`` the whole content of many batches.  Returns the batches that had rows before."""
        wanted = [int(b) for b in batch_ids]
        ad = F.col("ad")
        foreign = F.raise_error(F.concat(F.lit("row of a batch that is not replaced: "), ad.cast("string"))).cast("bigint")
        checked = rows.withColumn("ad", F.when(ad.isin(wanted), ad).otherwise(foreign)).select(*RESULT.names)
        staged = work_folder(self.spark)
        checked.hint("rebalance", *RESULT_PARTITIONS).write.parquet(staged)
        new = self.spark.read.schema(RESULT).parquet(staged)
        before = self.held(wanted)
        with catalog.overwrite_mode(self.spark, "dynamic"):
            new.hint("rebalance", *RESULT_PARTITIONS).write.mode("overwrite").insertInto(self.table)
        pairs = {(r.ad, _literal(NO_VALUE if r.bd is None else r.bd)) for r in new.select("ad", _bucket_name()).distinct().collect()}
        self._drop({(ad, bd) for ad, bd in before if (ad, _literal(bd)) not in pairs})
        remove_folder(self.spark, staged)
        return {ad for ad, _ in before}

    def clear_batches(self, batch_ids) -> None:
        """Leave no row of the batches: one statement, no job."""
        self._drop(self.held(batch_ids))

    def _drop(self, held: set[tuple[int, str]]) -> None:
        """Drop partitions by their full keys (part of a key silently drops nothing in the built-in catalog)."""
        if held:
            keys = ", ".join(f"PARTITION (ad = {ad}, bd = {_literal(bd)})" for ad, bd in sorted(held))
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {keys}")


def _bucket_name():
    """The bucket as partition names have it: an empty text is no value there."""
    return F.when(F.col("bd") != "", F.replace("bd", F.lit("%"), F.lit("%25"))).alias("bd")


class NamedLog:
    """The log of finished batches as a table."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark = spark
        self.table = table

    def create(self) -> "NamedLog":
        catalog.create_table(self.spark, self.table, BATCH_LOG)
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, batch_ids) -> None:
        """Add batches that are not there yet, all of them in one small file."""
        rows = literal_rows(self.spark, [(b,) for b in dict.fromkeys(str(int(b)) for b in batch_ids)], BATCH_LOG)
        rows.join(self.read(), "batchId", "left_anti").coalesce(1).write.mode("append").insertInto(self.table)

    def last(self) -> int:
        newest = last_batch(self.read()).first()["lastdate"]
        if newest is None:
            raise LookupError(f"no batch has finished yet according to {self.table}")
        return newest


class NamedSnapshot:
    """A table that is rebuilt aside and swapped in by name."""

    def __init__(self, spark: SparkSession, table: str, schema: StructType):
        self.spark = spark
        self.table = table
        self.schema = schema

    def create(self) -> "NamedSnapshot":
        catalog.create_table(self.spark, self.table, self.schema)
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.table).select(*self.schema.names)

    def swap(self, rows: DataFrame) -> None:
        """Build the next version, which may read the current one, then give it the name."""
        staged = f"{self.table}_staged"
        catalog.create_table_as(rows.select(*self.schema.names), staged)
        catalog.swap(self.spark, staged, self.table)


class NamedTables:
    """All tables of one installation in a database of the catalog; the jobs take it in place of ``Tables``."""

    def __init__(self, spark: SparkSession, database: str, prefix: str = ""):
        self.spark = spark
        self.database = database
        name = lambda table: f"{database}.{prefix}{table}"
        self.results = NamedResults(spark, name("results"))
        self.batch_log = NamedLog(spark, name("batch_log"))
        # The stored form keeps the batch, which decides between equal buckets.
        self.latest = NamedSnapshot(spark, name("latest"), RESULT)
        self.seen = NamedSnapshot(spark, name("seen"), SEEN)
        self.metrics = name("metrics")

    def create(self) -> "NamedTables":
        """Start (again) with empty tables."""
        catalog.use_database(self.spark, self.database)
        for store in (self.results, self.batch_log, self.latest, self.seen):
            store.create()
        catalog.create_table(self.spark, self.metrics, RUN_METRICS)
        return self

    def read_latest(self) -> DataFrame:
        return self.latest.read().select(*LATEST.names)

    def read_metrics(self) -> DataFrame:
        return self.spark.table(self.metrics)

    def add_metrics(self, rows) -> None:
        literal_rows(self.spark, rows, RUN_METRICS).write.mode("append").insertInto(self.metrics)
