"""Column statistics of any DataFrame in one aggregation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType


def column_profile(df: DataFrame, columns=None, *, distinct: bool = True, rsd: float = 0.05) -> DataFrame:
    """One row per column: row count, NULLs, distinct values (a sketch, so
    nothing is shuffled but one row per task), bounds and text lengths."""
    names = list(columns or df.columns)
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(names):
        c = F.col(f"`{name}`")
        textual = isinstance(df.schema[name].dataType, (StringType, BinaryType))
        size = F.length(c) if textual else F.lit(None).cast("int")
        aggregates += [
            F.count(c).alias(f"filled_{i}"),
            F.min(c).cast("string").alias(f"min_{i}"),
            F.max(c).cast("string").alias(f"max_{i}"),
            F.sum(size).cast("bigint").alias(f"len_{i}"),
            F.max(size).cast("bigint").alias(f"maxlen_{i}"),
        ]
        if distinct:
            aggregates.append(F.approx_count_distinct(c, rsd).alias(f"ndv_{i}"))

    entries = []
    for i, name in enumerate(names):
        fields = [
            F.lit(name).alias("column"),
            F.col("rows"),
            (F.col("rows") - F.col(f"filled_{i}")).alias("nulls"),
            F.col(f"min_{i}").alias("min"),
            F.col(f"max_{i}").alias("max"),
            F.try_divide(F.col(f"len_{i}").cast("double"), F.col(f"filled_{i}")).alias("avg_len"),
            F.col(f"maxlen_{i}").alias("max_len"),
        ]
        if distinct:
            fields.append(F.col(f"ndv_{i}").alias("distinct"))
        entries.append(F.struct(*fields))
    return df.select(*[F.col(f"`{n}`") for n in names]).agg(*aggregates).select(F.inline(F.array(*entries)))
