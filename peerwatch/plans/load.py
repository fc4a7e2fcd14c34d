"""The load job: generate a log, build its exclusion list, compute the statistics of both tables."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from peerwatch.operators.sample import build_exclusion
from peerwatch.schema import EXCLUSION
from peerwatch.session import unsorted_partitions
from peerwatch.sources import catalog
from peerwatch.sources.generator import PLANTED_FIRST, PLANTED_NUMBERS, LogPlan, generate_log


@dataclass
class BaseTables:
    """The log and the exclusion list of an installation, by name."""

    spark: SparkSession
    database: str
    prefix: str = ""

    def __post_init__(self):
        self.log = f"{self.database}.{self.prefix}log"
        self.exclusion = f"{self.database}.{self.prefix}exclusion"

    def read_log(self) -> DataFrame:
        return self.spark.table(self.log)

    def read_exclusion(self) -> DataFrame:
        return self.spark.table(self.exclusion)

    def reset(self) -> None:
        catalog.reset(self.spark, self.database, (f"{self.prefix}log", f"{self.prefix}exclusion"))


def run_load(
    tables: BaseTables,
    plan: LogPlan,
    *,
    listed: int,
    drop: bool = False,
    partition_by=("f31",),
    file_rows: int = 0,
) -> dict[str, DataFrame]:
    """Append a plan's log, make its exclusion list anew, ANALYZE both.

    ``drop`` starts with empty tables.  The list has ``listed`` random (sender,
    name) pairs of the whole stored log, never of a planted sender.  Returns
    the description of each table, statistics included.
    """
    if drop:
        tables.reset()
    catalog.use_database(tables.spark, tables.database)
    rows = generate_log(tables.spark, plan)
    if not tables.spark.catalog.tableExists(tables.log):
        catalog.create_table(tables.spark, tables.log, rows.schema, partition_by)
    # A table has its partition columns last.
    columns = tables.read_log().columns
    # A task makes the rows of few hours; a sort of them would only spill.
    with unsorted_partitions(tables.spark):
        rows.select(*columns).write.option("maxRecordsPerFile", file_rows).insertInto(tables.log)
    keep_out = (PLANTED_FIRST, PLANTED_FIRST + PLANTED_NUMBERS)
    pairs = build_exclusion(tables.read_log(), listed, keep_out=keep_out, seed=plan.seed)
    catalog.create_table_as(pairs.select(*EXCLUSION.names), tables.exclusion)
    return {name: catalog.analyze(tables.spark, name) for name in (tables.log, tables.exclusion)}
