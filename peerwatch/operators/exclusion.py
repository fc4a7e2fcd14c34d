"""Leaving out the senders of an exclusion list."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# A broadcast id costs some tens of bytes on every executor, so this many stay
# well below 100 MB.  Longer lists are joined by shuffle.
BROADCAST_IDS = 1_000_000


def fits_broadcast(ids: DataFrame, limit: int = BROADCAST_IDS) -> bool:
    """Count the list (from file footers, for a stored one) against the bound."""
    return ids.count() <= limit


def exclusion_key(df: DataFrame, column: str) -> Column:
    """The join key as a bigint; text that is no number matches nothing and
    is therefore kept."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.col(column).try_cast("bigint")
    return F.col(column).cast("bigint")


def without_listed(df: DataFrame, exclusion: DataFrame, column: str, *, broadcast: bool | None = None) -> DataFrame:
    """Anti join: rows of ``df`` whose ``column`` is not an ``id`` of the list.

    NULL ids match nothing and repeated ids do no harm.  ``broadcast=None``
    counts the list first; True states that its size is already known.

    Without broadcast ids are made distinct map-side, so a much repeated one
    is a single row, and a hot sender is split by Spark's skew join.  Rows
    without a number match nothing; they are dealt out by their other values.
    """
    ids = exclusion.select(F.col("id").cast("bigint").alias("_excluded"))
    if broadcast is None:
        broadcast = fits_broadcast(ids)
    key = exclusion_key(df, column)
    if broadcast:
        return df.join(F.broadcast(ids), key == F.col("_excluded"), "left_anti")

    ids = ids.where(F.col("_excluded").isNotNull()).distinct().withColumn("_number", F.lit(True))
    place = F.coalesce(key, F.xxhash64(*df.columns))
    return df.join(ids, (place == F.col("_excluded")) & (key.isNotNull() == F.col("_number")), "left_anti")


# A word of the table below answers for this many ids, four bits each: about
# two in a hundred other numbers pass.  At most 2^20 words, some 40 MB once broadcast.
IDS_PER_WORD = 5
MAX_WORDS = 1 << 20


def _place(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words).cast("bigint"))


def _bits(key: Column) -> Column:
    """Four of 64 bits, from another hash than the place."""
    hashed = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.call_function("shiftrightunsigned", hashed, F.lit(8 * i)).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def listed_words(exclusion: DataFrame, words: int) -> DataFrame:
    """(place, word): a Bloom filter of the list, at most ``words`` rows of 16 bytes.

    Filters of parts of a list are merged by bit_or per place.
    """
    ids = exclusion.select(F.col("id").cast("bigint").alias("id")).where("id is not null")
    return ids.groupBy(_place(F.col("id"), words).alias("place")).agg(F.bit_or(_bits(F.col("id"))).alias("word"))


def split_by_words(df: DataFrame, column: str, filter_rows: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """(rows that are surely not listed, rows that may be), by the filter of :func:`listed_words`.

    Both parts have the columns of ``df``; each reads ``df`` again, but
    neither shuffles it.
    """
    key = exclusion_key(df, column)
    # The filter's columns get names that the rows do not have.
    place, word = (name + "_" * max(map(len, df.columns)) for name in ("place", "word"))
    table = F.broadcast(filter_rows.select(F.col("place").alias(place), F.col("word").alias(word)))
    wanted = _bits(key)
    met = (_place(key, words) == F.col(place)) & (F.col(word).bitwiseAND(wanted) == wanted) & key.isNotNull()
    return df.join(table, met, "left_anti"), df.join(table, met, "left_semi")


def without_listed_split(df: DataFrame, exclusion: DataFrame, column: str, *, words: int | None = None) -> DataFrame:
    """:func:`without_listed` for a list too long to broadcast that meets few rows.

    The list is turned into a Bloom filter of bounded size, which is
    broadcast.  Rows that it does not know pass by the join; only the others,
    listed ones and some two in a hundred more, are shuffled to the list.  The
    answer is exact for any size of the filter; ``words=None`` takes it from
    the length of the list, and beyond ``MAX_WORDS`` it only lets more rows
    into the shuffle.  It pays if reading the rows twice is cheaper than
    shuffling them, as with a columnar log of which few columns are read.
    """
    if words is None:
        words = max(1, min(MAX_WORDS, -(-exclusion.count() // IDS_PER_WORD)))
    passed, open_rows = split_by_words(df, column, listed_words(exclusion, words), words)
    return passed.unionByName(without_listed(open_rows, exclusion, column, broadcast=False))
