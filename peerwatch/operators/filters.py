"""Row predicates of the log scan.

Literals are typed to the column, never the column to the literal, so each
predicate reaches the file reader as a pushed filter or a partition filter.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from peerwatch.functions.text import clean_text


def _literal_like(df: DataFrame, column: str, value) -> Column:
    if isinstance(df.schema[column].dataType, StringType):
        return F.lit(str(value))
    return F.lit(int(value)).cast(df.schema[column].dataType)


def in_window(df: DataFrame, column: str, start: int, end: int) -> DataFrame:
    """Rows with ``start <= column < end``.

    Hours may be integers or ten-digit texts; both sort like time.
    """
    c = F.col(column)
    return df.where((c >= _literal_like(df, column, start)) & (c < _literal_like(df, column, end)))


def with_code(df: DataFrame, column: str, code: int) -> DataFrame:
    """Rows whose event code equals ``code``, for integer or text codes."""
    return df.where(F.col(column) == _literal_like(df, column, code))


def outside_range(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Rows below ``low`` or above ``high``; both bounds are left out."""
    c = F.col(column)
    return df.where((c < _literal_like(df, column, low)) | (c > _literal_like(df, column, high)))


def longer_than(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose normalised text has more than ``n`` characters.

    Normalising never lengthens a text, so the raw length is a cheap first
    test that spares most short texts the normalisation.
    """
    return df.where((F.length(column) > n) & (F.length(clean_text(column)) > n))
