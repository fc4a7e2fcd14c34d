"""What several operators share: tables, written steps, links to classes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.session import remove_folder, work_folder

#: Tables are folders or files ``<name>.parquet`` below the folder of a data set.
WHITE = r"[ \t-\r]+"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str = "step") -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there, and a lost executor costs one read."""
    path = f"{work_folder(spark)}-{name}"
    # Once the table is there, nothing needs the shuffle files that led to it.
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.step_folder = path
    return out


def removed(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete the folders of tables of ``written`` that nothing reads any more; frames made from them are left alone."""
    for df in tables:
        if path := df.__dict__.get("step_folder"):
            remove_folder(spark, path)


def text_of(docs: DataFrame) -> Column:
    """The text, null as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def classes(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): rows (node, root), root the smallest node reached.

    Alternating large-star and small-star steps (Kiveris et al., 2014) over tables; every step is written, and
    nothing but the number of changed links comes to the driver.  Nodes without links are not listed.
    """
    a, b = F.col("a"), F.col("b")
    now = written(
        spark,
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "links",
    )
    while True:
        both = now.select("a", "b").union(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), a).alias("m"))
        large = (
            both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
        ).distinct()
        large = written(spark, large, "large")
        # Every node is linked to the least of its smaller neighbours, and so are these.
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(smallest, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        small = written(spark, small, "small")
        same = small.count() == now.count() and small.exceptAll(now).isEmpty()
        removed(spark, now, large)
        now = small
        if same:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )


def constant(spark: SparkSession, values: np.ndarray) -> Column:
    """An array that every row sees.  As a literal it would stand in the text of each plan, in the driver's memory."""
    return spark.createDataFrame(pa.table({"values": pa.ListArray.from_arrays([0, len(values)], pa.array(values))})).scalar()


#: Bits of the table below: 128 kB.
TABLE_BITS = 1 << 20


def in_bit_table(ids: DataFrame, column: str, value: Column) -> Column:
    """True if the value is in the (long) column of ``ids``, and for few others: a table of fixed size, however many
    ids there are; with very many it only lets more pass."""
    place = F.pmod(F.xxhash64(value), F.lit(TABLE_BITS))
    words = ids.select(
        F.expr(f"cast(pmod(xxhash64({column}), {TABLE_BITS}) div 64 as int)").alias("at"),
        F.expr(f"shiftleft(1L, cast(pmod(xxhash64({column}), {TABLE_BITS}) % 64 as int))").alias("bit"),
    )
    found = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(TABLE_BITS // 64, np.int64)
    table[found["at"].to_numpy()] = found["bits"].to_numpy()
    bits = constant(ids.sparkSession, table)
    word = F.element_at(bits, (F.call_function("shiftright", place, F.lit(6)) + 1).cast("int"))
    return F.call_function("shiftright", word, F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
