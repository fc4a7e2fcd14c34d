"""Read-back reports."""

from pyspark.sql import DataFrame


def ordered_result(result: DataFrame) -> DataFrame:
    """The result by batch and bucket.

    Further columns only refine that order; they let range partitioning split
    a bucket that holds a large part of all rows.
    """
    return result.orderBy("ad", "bd", "f02", "f22", "f16", "f06", "f07")


def peek(df: DataFrame, n: int = 10, *, order=()) -> DataFrame:
    """``n`` rows; the first ones of an order if one is given."""
    return (df.orderBy(*order) if order else df).limit(n)
