"""Operator 1: exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes.  All different blocks are sorted, and the place of a block in
that order is its integer name.  Then neighbouring pairs of names are named in the same way, again and again, until
each text has one name (Karp, Miller and Rosenberg, 1972).  Two texts have one name if and only if they are equal.

Scale: block texts are shuffled once, reduced to different ones before the shuffle; from then on only integers move.
Blocks are brought together by a 64-bit key; where two different blocks share one (checked, not assumed), they are
told apart by the blocks themselves.  A group of copies of any size is only ever counted and joined with its one
name, never gathered.  The number of rounds is the logarithm of the longest text.

Defined results: a null text counts as empty; an empty text is one empty block; a null ``doc_id`` is larger than any
other; of rows equal in id and text the first one read stays; other columns are not touched; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.llm.common import WHITE, table, text_of, written

BLOCK_BYTES = 8192


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, " ")


def _blocks(text: Column, size: int) -> Column:
    raw = F.encode(text, "UTF-8")
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(text) / F.lit(size)).cast("int"))
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(raw, (i - 1) * F.lit(size) + 1, F.lit(size)))


def _in_order(df: DataFrame, *columns: str) -> DataFrame:
    """A name for each (distinct) row: increasing in the order of the columns."""
    ordered = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return ordered.withColumn("name", F.monotonically_increasing_id())


def exact_duplicates(
    spark: SparkSession, docs: DataFrame, *, block_bytes: int = BLOCK_BYTES, key=None
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``key`` maps a block to the long by which equal blocks meet; any function of the block gives the same result.
    """
    key = key or (lambda block: F.xxhash64(block))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(text_of(docs)).alias("t"))
    hashed = texts.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2("t", 256).alias("text_sha256"),
        F.transform(_blocks(F.col("t"), block_bytes), key).alias("keys"),
    )
    rows = written(spark, hashed, "rows")
    different = texts.select(F.explode(_blocks(F.col("t"), block_bytes)).alias("block"))
    different = different.select(key(F.col("block")).alias("key"), "block").distinct()
    keys = written(spark, different.groupBy("key").count(), "keys")
    level = rows.select("row", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key"))
    shared = keys.where("count > 1")
    if shared.isEmpty():
        names = written(spark, _in_order(keys.select("key"), "key"), "names")
        level = level.join(names, "key").select("row", "n", "pos", "name")
    else:
        level = _told_apart(spark, rows, texts, different, level, keys, shared, block_bytes, key)
    level = written(spark, level, "level")
    done = level.where("n = 1").select("row", "name")
    open_ = level.where("n > 1").withColumn("left", F.col("n"))
    while not open_.isEmpty():
        even = F.col("pos") % 2 == 0
        pairs = open_.groupBy("row", "n", "left", F.shiftright("pos", 1).alias("pos")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"),
            # A name without a right neighbour is paired with no name.
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("b"),
        )
        pairs = written(spark, pairs.withColumn("left", F.shiftright(F.col("left") + 1, 1)), "pairs")
        names = written(spark, _in_order(pairs.select("a", "b").distinct(), "a", "b"), "names")
        level = written(spark, pairs.join(names, ["a", "b"]).select("row", "n", "pos", "name", "left"), "level")
        done = done.union(level.where("left = 1").select("row", "name"))
        open_ = level.where("left > 1")
    named = rows.withColumn("n", F.size("keys")).drop("keys").join(done, "row")
    named = written(spark, named, "named")
    groups = named.groupBy("n", "name").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"),
        F.count("*").alias("group_size"),
    )
    return named.join(groups, ["n", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def _told_apart(spark, rows, texts, different, level, keys, shared, size, key):
    """Names of blocks when some different blocks have one key."""
    blocks = different.join(shared.select("key"), "key")
    one = keys.where("count = 1").select("key", F.lit(None).cast("binary").alias("block"))
    names = written(spark, _in_order(one.unionByName(blocks), "key", "block"), "names")
    plain = level.join(names.where("block is null").drop("block"), "key").select("row", "n", "pos", "name")
    where = texts.select("doc_id", F.sha2("t", 256).alias("text_sha256"), F.posexplode(_blocks(F.col("t"), size)))
    where = where.select("doc_id", "text_sha256", F.col("pos"), F.col("col").alias("block")).distinct()
    where = where.withColumn("key", key(F.col("block"))).join(names.where("block is not null"), ["key", "block"])
    ids = rows.select("row", F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"), F.size("keys").alias("n"))
    mine = ids.join(where, (F.col("sha") == F.col("text_sha256")) & F.col("id").eqNullSafe(F.col("doc_id")))
    return plain.unionByName(mine.select("row", "n", "pos", "name"))


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(spark, table(spark, folder, "documents"))


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""
