"""Tables derived from detection results."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerwatch.functions import hours
from peerwatch.schema import LATEST, SEEN

SEEN_KEYS = ("f22", "f02", "f06", "f07")


def latest_per_sender(result: DataFrame, columns=LATEST.names) -> DataFrame:
    """The newest result row of every sender.

    The order is total, so ties on the bucket are always broken alike.  Rank
    pruning drops all but one row per sender and task before the shuffle, so
    a sender with very many rows is no burden.
    """
    newest = Window.partitionBy("f02").orderBy(
        F.desc_nulls_last("bd"),
        F.desc_nulls_last("ad"),
        F.desc_nulls_last("cnt"),
        F.asc_nulls_last("f22"),
        F.asc_nulls_last("f16"),
        F.asc_nulls_last("f06"),
        F.asc_nulls_last("f07"),
    )
    ranked = result.select("*", F.row_number().over(newest).alias("rn"))
    return ranked.where(F.col("rn") == 1).select(*columns)


def _seen_range(rows: DataFrame, first: str, last: str, bucket_format: str | None) -> DataFrame:
    """Minimum of ``first`` and maximum of ``last`` per sender key.

    Buckets of a known format are compared as integers, since text minima
    force a sort-based aggregation; a text of another format is an error
    rather than a wrong order.  Without a format they are compared as text.
    """
    if bucket_format is None:
        lowest, highest = F.min(first), F.max(last)
    else:
        lowest = F.min(hours.bucket_text_key(first, bucket_format))
        highest = F.max(hours.bucket_text_key(last, bucket_format))
    seen = rows.groupBy(*SEEN_KEYS).agg(lowest.alias("f_date"), highest.alias("l_date"))
    if bucket_format is not None:
        for c in ("f_date", "l_date"):
            seen = seen.withColumn(c, hours.bucket_key_text(c, bucket_format))
    return seen.select(*SEEN.names)


def first_last(result: DataFrame, *, bucket_format: str | None = hours.BUCKET_HOUR) -> DataFrame:
    """First and last bucket in which a sender (with its attributes) was seen."""
    return _seen_range(result, "bd", "bd", bucket_format)


def merge_first_last(
    new: DataFrame, history: DataFrame, *, bucket_format: str | None = hours.BUCKET_HOUR
) -> DataFrame:
    """Combine first/last rows with those already known."""
    both = new.select(*SEEN.names).unionByName(history.select(*SEEN.names))
    return _seen_range(both, "f_date", "l_date", bucket_format)
