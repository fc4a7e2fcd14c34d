"""The driver's tables seen as message logs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.functions.hours import hour_of


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _log_columns(local, peer, text, ts, name):
    return [
        F.col(local).cast("bigint").alias("f02"),
        F.col(name).alias("f03"),
        F.col(peer).cast("bigint").alias("f04"),
        F.lit(0).cast("bigint").alias("f06"),
        F.lit(7).cast("bigint").alias("f07"),
        F.lit(49).cast("bigint").alias("f14"),
        text.alias("f16"),
        F.lit(3).cast("bigint").alias("f22"),
        hour_of(ts).alias("f30"),
        hour_of(ts).alias("f31"),
    ]


def order_log(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as messages: a supplier writes to the orders it serves.

    No hint on the join: Spark broadcasts the supplier table while its size
    allows and falls back to a shuffle when it does not.
    """
    items = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_shipdate")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    joined = items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    text = F.concat(F.lit("  msg??? "), F.col("s_name"), F.lit(" \t 000 "))
    return joined.select(*_log_columns("l_suppkey", "l_orderkey", text, "l_shipdate", "s_name"))


def order_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with a low balance are left out."""
    low = table(spark, folder, "supplier").where(F.col("s_acctbal") < 1000)
    return low.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


# The five event types, numbered from 1.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages: an event type writes to the users it touches."""
    events = table(spark, folder, "events").select("event_type", "user_id", "ts")
    types = F.array(*[F.lit(t) for t in EVENT_TYPES])
    # An event of another type has no number and is no message.
    numbered = events.withColumn("local", F.array_position(types, F.col("event_type"))).where("local > 0")
    text = F.concat(F.lit("  event??? "), F.col("event_type"), F.lit(" \t 000 "))
    return numbered.select(*_log_columns("local", "user_id", text, "ts", "event_type"))


def event_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    """One event type is left out."""
    types = table(spark, folder, "events").select("event_type").distinct().where(F.col("event_type") == "error")
    position = F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), F.col("event_type"))
    return types.select(position.cast("bigint").alias("id"), F.col("event_type").alias("name"))
