"""Distinct rows and a repeatable random sample of an exact size."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerwatch.operators.filters import outside_range

_PREFIX_DIGITS = 4  # 65,536 possible prefixes bound the histogram


def random_order(seed: int, columns):
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def seeded_sample(rows: DataFrame, n: int, *, seed: int = 0, columns=None) -> DataFrame:
    """Exactly ``n`` distinct rows (or all, if fewer), in a random choice that
    depends only on the seed and the rows.

    The choice is the ``n`` smallest digests, without sorting everything: a
    histogram of digest prefixes (at most 65,536 rows) tells which prefixes
    are taken whole, and only rows of the prefix at the border, one of
    65,536 parts of all, are ranked in one task.
    """
    names = list(columns or rows.columns)
    # No second aggregation if the rows are a ``distinct`` already.
    keyed = rows.distinct().withColumn("_d", random_order(seed, names))
    order = ["_d", *names]
    prefix = F.substring("_d", 1, _PREFIX_DIGITS)
    keyed = keyed.withColumn("_p", prefix)
    upto = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = (
        keyed.groupBy("_p")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_p", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"), F.sum("_n").over(upto).alias("_upto"))
    )
    inner = steps.where(F.col("_before") < n)  # at most 65,536 rows, so safe to broadcast
    taken = keyed.join(F.broadcast(inner), "_p")
    whole = taken.where(F.col("_upto") <= n).select(*rows.columns)
    border = taken.where(F.col("_upto") > n)
    ranked = border.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    rest = ranked.where(F.col("_r") <= n - F.col("_before")).select(*rows.columns)
    return whole.unionByName(rest)


def random_sample(rows: DataFrame, n: int, *, seed: int | None = None) -> DataFrame:
    """``n`` rows in ``rand`` order: a top-k, so meant for a small ``n``, and
    repeatable only for equal partitioning.  See :func:`seeded_sample`."""
    return rows.orderBy(F.rand(seed) if seed is not None else F.rand()).limit(n)


def sender_names(log: DataFrame, keep_out: tuple[int, int]) -> DataFrame:
    """Distinct (sender, name) pairs outside the protected number range."""
    pairs = outside_range(log, "f02", *keep_out)
    return pairs.select(F.col("f02").cast("bigint").alias("id"), F.col("f03").alias("name")).distinct()


def build_exclusion(log: DataFrame, n: int, *, keep_out: tuple[int, int], seed: int = 0) -> DataFrame:
    """A random exclusion list of ``n`` (id, name) pairs of the log."""
    return seeded_sample(sender_names(log, keep_out), n, seed=seed)


def merged_exclusion(kept: DataFrame, n: int, *, seed: int = 0) -> DataFrame:
    """The list of the whole log from the stored lists of its parts.

    Parts may be any sets of rows that make up the log, each with its own
    :func:`build_exclusion` of at least ``n`` pairs and the same seed.  A
    pair's place depends on the pair alone, so the ``n`` first of all parts
    are among the ``n`` first of their own part, and the merged list is that
    of one pass over the log.
    """
    return seeded_sample(kept, n, seed=seed)
