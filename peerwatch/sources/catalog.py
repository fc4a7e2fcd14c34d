"""The same tables kept in a Spark catalog, for users who work by name.

Everything here is Spark SQL on datasource tables and needs no Hive support.
"""

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peerwatch.schema import RESULT, RESULT_PARTITIONS
from peerwatch.session import remove_folder

_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def overwrite_mode(spark: SparkSession, mode: str):
    """What overwriting replaces, whatever the session says: all below a named partition ("static"), or the partitions that rows come for ("dynamic")."""
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)


def use_database(spark: SparkSession, database: str, *, current: bool = False) -> None:
    """Make the database if need be; ``current`` makes it the session's own."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if current:
        spark.sql(f"USE {database}")


def reset(spark: SparkSession, database: str, tables) -> None:
    """Drop the given tables, if they exist, and keep an empty database.

    Folders that a failed run left in their places are removed as well, or
    they would stand in the way of the next table of that name.
    """
    use_database(spark, database)
    place = spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").first()["info_value"]
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
        remove_folder(spark, f"{place.rstrip('/')}/{table.lower()}")


def create_table(spark: SparkSession, table: str, schema: StructType, partition_by=(), using: str = "orc") -> None:
    """Drop and create an empty table with a declared schema."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {using}{partitions}")


def create_result_table(spark: SparkSession, table: str) -> None:
    create_table(spark, table, RESULT, RESULT_PARTITIONS)


def create_table_as(rows: DataFrame, table: str, *, using: str = "orc") -> None:
    """Create a table from a query; replaces one of the same name."""
    rows.write.mode("overwrite").format(using).saveAsTable(table)


def insert_partitions(rows: DataFrame, table: str) -> None:
    """Append result rows, each to the partition its ``ad`` and ``bd`` name."""
    rows.select(*RESULT.names).hint("rebalance", *RESULT_PARTITIONS).write.mode("append").insertInto(table)


def overwrite_batch(rows: DataFrame, table: str, batch_id: int) -> None:
    """Make ``rows`` the whole content of one batch.

    A static ``ad`` clears every bucket of the batch, also when no rows
    follow.  (``ALTER TABLE .. DROP PARTITION`` with part of the key silently
    does nothing in the built-in catalog.)
    """
    spark = rows.sparkSession
    inner = [c for c in RESULT.names if c != "ad"]
    values = rows.where(f"ad = {int(batch_id)}").select(*inner).hint("rebalance", "bd")
    with overwrite_mode(spark, "static"):
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (ad = {int(batch_id)}, bd) SELECT * FROM {{rows}}", rows=values
        )


def clear_batches(spark: SparkSession, table: str, batch_ids) -> None:
    """Leave no row of the batches, however many, by one statement on the partitions that the table holds."""
    from peerwatch.sources.named import NamedResults  # which is made of this module

    NamedResults(spark, table).clear_batches(batch_ids)


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def swap(spark: SparkSession, staged: str, live: str) -> None:
    """Put a finished table in the place of another.

    The live table is only moved aside until the other one has its name; any
    failure puts it back.
    """
    if not spark.catalog.tableExists(staged):
        raise LookupError(f"no table {staged} to put in the place of {live}")
    aside = f"{live}_replaced"
    if spark.catalog.tableExists(aside):
        # A former swap ended half-way: what it moved aside is live if nothing else is.
        if spark.catalog.tableExists(live):
            spark.sql(f"DROP TABLE {aside}")
        else:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {live}")
    had_one = spark.catalog.tableExists(live)
    if had_one:
        spark.sql(f"ALTER TABLE {live} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {live}")
    except Exception:
        if had_one:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {live}")
        raise
    if had_one:
        spark.sql(f"DROP TABLE {aside}")


def write_bucketed(
    rows: DataFrame, table: str, *, buckets: int = 32, key: str = "f02", sort: str = "f01", partition_by=()
) -> None:
    """Append to a table bucketed by ``key``: later joins and groupings on the
    key need no shuffle of this table."""
    writer = rows.write.mode("append").format("orc").option("compression", "zlib")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, key).sortBy(sort).saveAsTable(table)


def co_bucketed(spark: SparkSession, *tables: tuple[str, str]) -> list[DataFrame]:
    """Tables (name, key) that are each bucketed by their key into the same number of buckets.

    Others are an error: their join would give the same rows, but by
    shuffling the log.
    """
    numbers = set()
    for table, key in tables:
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        if described.get("Bucket Columns") != f"[`{key}`]":
            raise ValueError(f"{table} is not bucketed by {key}")
        numbers.add(described["Num Buckets"])
    if len(numbers) > 1:
        raise ValueError(f"different numbers of buckets: {sorted(numbers)}")
    return [spark.table(t) for t, _ in tables]


def without_listed_by_bucket(spark: SparkSession, log: str, exclusion: str, key: str = "f02", list_key: str = "id") -> DataFrame:
    """Anti join of two tables bucketed alike: each task reads one bucket of both, and nothing is shuffled.

    Rows without a number match nothing and stay.  The list may repeat ids.
    """
    rows, listed = co_bucketed(spark, (log, key), (exclusion, list_key))
    # A hint, as the size of a list that has no statistics may be taken for small.
    return rows.join(listed.select(list_key).hint("merge"), F.col(key) == F.col(list_key), "left_anti")


def column_statistics(spark: SparkSession, table: str, columns) -> DataFrame:
    """What ANALYZE found out about columns: (column, statistic, value)."""
    out = None
    for column in columns:
        rows = spark.sql(f"DESCRIBE EXTENDED {table} `{column}`").selectExpr(
            f"'{column}' AS column", "info_name AS statistic", "info_value AS value"
        )
        out = rows if out is None else out.unionByName(rows)
    return out.where("statistic IN ('min', 'max', 'num_nulls', 'distinct_count')")


_HISTOGRAMS = {"spark.sql.statistics.histogram.enabled": "true"}


def histograms(spark: SparkSession, table: str, columns, bins: int = 20) -> DataFrame:
    """Equi-height histograms by ANALYZE: (column, bin, lower, upper), each bin an equal share of the rows.

    Bounds are approximate percentiles.  The optimiser uses the stored
    histograms for its estimates of ranges and joins.
    """
    settings = {**_HISTOGRAMS, "spark.sql.statistics.histogram.numBins": str(bins)}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    out = None
    for column in columns:
        described = spark.sql(f"DESCRIBE EXTENDED {table} `{column}`").where(F.col("info_name").startswith("bin_"))
        bound = lambda name: F.regexp_extract("info_value", rf"{name}: ([^,]+)", 1).cast("double").alias(name.split("_")[0])
        number = F.regexp_extract("info_name", r"(\d+)", 1).cast("int").alias("bin")
        rows = described.select(F.lit(column).alias("column"), number, bound("lower_bound"), bound("upper_bound"))
        out = rows if out is None else out.unionByName(rows)
    return out


def analyze(spark: SparkSession, table: str) -> DataFrame:
    """Compute statistics of all columns and describe the table."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.sql(f"DESCRIBE EXTENDED {table}")
