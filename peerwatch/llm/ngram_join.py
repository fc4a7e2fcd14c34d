"""Operator 9: n-gram Jaccard join with parity sketches.

A document's set is its distinct word n-grams.  Two sets link when their Jaccard similarity reaches the threshold.

Candidates: sizes are cut into bands, each as wide as the threshold, so linked sets lie in one band or in neighbouring ones.  For a
band, the symmetric difference of linked sets is at most ``d``.  Every n-gram is hashed to one of ``m > d`` parts and
a pattern of the 64 bits of that part, and the patterns are XORed: at most as many parts differ as the symmetric
difference has n-grams.  (One bit for each n-gram would leave 2016 values to a part of two, which many sets share by chance.)  So at least ``m - d`` parts of linked sets hold the same n-grams (pigeonhole), and sets that share a part meet.  A part
with fewer than two n-grams says little and is left out, unless the set has so many of them that they could be all
that is equal; then they are used too.  A set is sketched for its own band and for the next larger one.

As ``m`` is about 1.3 d, a set that links with another shares not one part with others but at least ``m - d``, less those that it left
out.  Sets that share fewer, as texts with a common passage do, are dropped with their keys before any pair is made.

Candidates whose whole sketches are further apart than linked sets can be are dropped; of the rest the sets of words themselves
are compared.  Nothing else makes a link.

Scale: equal sets are one before the join.  Sketch parts are shuffled once.  Sets that share a part are first compared with one
pivot each, the smallest id among all they meet, which joins groups of near copies without their pairs.  What is still in
different classes is then compared over each shared part: the members outside the largest class of that part with all others, so every pair
that could still change a class is looked at, and no pair within a class.  Classes are found by star contraction over tables.  Tables of
steps go when nothing reads them any more.

Defined results: a null or blank text has an empty set and links with nothing; with fewer words than n, the whole
sequence is the only n-gram; rows that repeat an id are one document each, in the class of their own text, named by its
smallest id; a null id counts as larger than any other; a very long text is a set like any other; an empty table gives an empty one; other
columns, also with the names used here, are not touched.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerwatch.llm.common import classes, in_bit_table, removed, table, text_of, written

SEEN_WORDS = 500_000
#: Words of 64 bits of the short sketch that pairs are first compared by.
SHORT = 8
#: n-grams that a part must have to be used by itself.
FULL_PART = 2
#: Pieces in which shared keys are looked at, one after the other: sketches lie on disk for one piece at a time.
PIECES = 8
#: Parts above the least number, as a share of it.
MORE_PARTS = 0.3


def words(text: str) -> list[bytes]:
    """Lower-cased A-Z, cut at the white space of ASCII."""
    return text.encode("utf-8", "replace").lower().split()


def grams(text: str, n: int) -> set[bytes]:
    """The set of a text: distinct n-grams, the whole sequence if it is shorter."""
    found = words(text)
    if not found:
        return set()
    return {b" ".join(found[i : i + n]) for i in range(max(1, len(found) - n + 1))}


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) >= SEEN_WORDS:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def _mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit depends on all bits."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(text: str, n: int, hashes: _Hashes) -> np.ndarray:
    """Distinct 64-bit hashes of the n-grams, in order."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    size = min(n, len(found))
    # The number of words counts: a short sequence is no n-gram of others.
    out = np.full(len(found) - size + 1, size, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + each[i : len(found) - size + 1 + i]
    return np.unique(_mixed(out))


class Bands:
    """Size bands and parts for a threshold of ``percent``."""

    def __init__(self, percent: int):
        self.percent = percent
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            # The smallest size that cannot link with the first size of this band.
            self.starts.append(100 * self.starts[-1] // percent + 1)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def parts(self, band: int) -> tuple[int, int]:
        """(largest symmetric difference of linked sets that meet in this band, number of parts)."""
        largest = self.starts[band + 1] - 1
        # 100 i >= p u and u + i = a + b give u - i <= (100 - p)(a + b) / (100 + p).
        d = (100 - self.percent) * 2 * largest // (100 + self.percent)
        return d, d + 1 + math.ceil(MORE_PARTS * (d + 1))


def sketch_keys(hashed: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Keys by which the set meets others, hashes of (band, part, XORed patterns of the part), and for each twice the number of keys of its band that a
    linked set has as well, plus one in the larger band."""
    out, needs = [], []
    own = bands.of(len(hashed))
    for band in (own, own + 1):
        d, m = bands.parts(band)
        place = _mixed(hashed, band + 1)
        part = ((place >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        bits = np.zeros(m, np.uint64)
        np.bitwise_xor.at(bits, part, _mixed(place))
        filled = np.bincount(part, minlength=m)
        use = filled >= FULL_PART
        if m - use.sum() >= m - d:
            use[:] = True
        which = np.flatnonzero(use).astype(np.uint64)
        salt = np.uint64(band * 2654435761 + 17)
        out.append(_mixed(_mixed(which * np.uint64(0x9E3779B97F4A7C15) + salt) + bits[use]))
        # Of the m - d equal parts those that are left out are no keys.
        needs.append(np.full(len(which), 2 * (len(which) - d) + band - own, np.int32))
    return np.concatenate(out), np.concatenate(needs)


def _sets(rows: DataFrame, n: int) -> DataFrame:
    """n_shingles, a 128-bit name and the sketch of the set for each row (rid, doc_id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            sizes, names, sketches = [], [], []
            for value in batch.column(2):
                hashed = gram_hashes(value.as_py(), n, hashes)
                sizes.append(len(hashed))
                names.append(_name(hashed))
                sketches.append(parity(hashed).tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["rid", "doc_id", "n_shingles", "name", "sketch"])

    return rows.mapInArrow(work, "rid long, doc_id long, n_shingles long, name binary, sketch binary")


def _name(hashed: np.ndarray) -> bytes:
    return hashlib.blake2b(hashed.tobytes(), digest_size=16).digest()


def _keys(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """(key, rid, need) for the sketch parts of each row (rid, doc_id, text).

    Within a task only the first row of equal sets is sketched: the others have the same keys, and all rows are mapped
    to their set later.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bands, seen = _Hashes(), Bands(percent), set()
        for batch in batches:
            keys, ids, needs, size = [], [], [], 0
            for rid, value in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                hashed = gram_hashes(value.as_py(), n, hashes)
                if not len(hashed) or (name := _name(hashed)) in seen:
                    continue
                if len(seen) >= SEEN_WORDS:
                    seen.clear()
                seen.add(name)
                some, need = sketch_keys(hashed, bands)
                keys.append(some)
                needs.append(need)
                ids.append(np.full(len(some), rid, np.int64))
                size += len(some)
                if size > 200_000:
                    yield _keyed(keys, ids, needs)
                    keys, ids, needs, size = [], [], [], 0
            if keys:
                yield _keyed(keys, ids, needs)

    return rows.mapInArrow(work, "key long, rid long, need int")


def _keyed(keys, ids, needs) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(needs))]
    return pa.RecordBatch.from_arrays(columns, ["key", "rid", "need"])


def parity(hashed: np.ndarray) -> np.ndarray:
    """The whole set as one sketch, two bits or more for each n-gram (within bounds); halves XORed are the shorter sketch."""
    bits = min(max(64 * SHORT, 1 << int(2 * len(hashed)).bit_length()), 1 << 16)
    place = _mixed(hashed, 977) % np.uint64(bits)
    out = np.zeros(bits // 64, np.uint64)
    np.bitwise_xor.at(out, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out


def may_link(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int, percent: int) -> bool:
    """False only if sizes or the Hamming distance of the sketches rule a link out."""
    if 100 * min(n_a, n_b) < percent * max(n_a, n_b):
        return False
    size = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(x.reshape(-1, size), axis=0) for x in (a, b))
    return int(np.bitwise_count(a ^ b).sum()) <= (100 - percent) * (n_a + n_b) // (100 + percent)


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sketches do not rule out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(i).to_pylist() for i in range(2, 6))
            for i, (n_a, a, n_b, b) in enumerate(zip(*columns, strict=True)):
                if may_link(np.frombuffer(a, np.uint64), n_a, np.frombuffer(b, np.uint64), n_b, percent):
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])

    left = sketches.select(F.col("rid").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = sketches.select(F.col("rid").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "s_a", "n_b", "s_b")
    return both.mapInArrow(work, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sets of words link; texts: (rid, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, set()
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            keep = []
            for i, (left, right) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                if last != (key := a[i].as_py()):
                    last, mine = key, grams(left.as_py(), n)
                other = grams(right.as_py(), n)
                both = len(mine & other)
                if both and 100 * both >= percent * (len(mine) + len(other) - both):
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(keep), b.take(keep)], ["a", "b"])

    left = texts.select(F.col("rid").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("rid").alias("b"), F.col("text").alias("right"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return both.mapInArrow(work, "a long, b long")


def ngram_classes(spark: SparkSession, docs: DataFrame, *, n: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    repeated = rows.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if repeated.limit(1).isEmpty():
        rows = rows.select(F.col("doc_id").alias("rid"), "doc_id", "text")
    else:
        rows = written(spark, rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text"), "rows")
    found = written(spark, _sets(rows, n), "sets")
    # One row stands for all with an equal set.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))["doc_id"]
    named = found.where("n_shingles > 0").groupBy("name").agg(least.alias("first"), F.min("rid").alias("set"))
    named = written(spark, named, "named")
    mapped = written(spark, found.drop("sketch").join(named.drop("first"), "name", "left").drop("name"), "mapped")
    part = Window.partitionBy("key")
    # Of equal sets (almost) only the one that stands for them is sketched.
    met = _keys(rows.where(in_bit_table(named, "set", F.col("rid"))), n, percent)
    met = met.withColumns({"low": F.min("rid").over(part), "high": F.max("rid").over(part), "larger": F.min(F.col("need") % 2).over(part)})
    # Sets that all have a key from the next band meet by their own band's keys, too.
    met = written(spark, met.where("low < high and larger = 0").select("key", "rid", "need"), "met")
    enough = met.groupBy("rid", "need").agg(F.count("*").alias("keys")).where("2 * keys >= need - need % 2").drop("keys")
    sets = met.join(enough, ["rid", "need"], "left_semi").join(named.select("set"), F.col("rid") == F.col("set"), "left_semi").select("key", F.col("rid").alias("set"))
    sets = sets.withColumns({"low": F.min("set").over(part), "high": F.max("set").over(part)})
    sets = written(spark, sets.where("low < high").select("key", "set", "low"), "shared")
    removed(spark, met)
    # The sketches of all sets that meet another.
    members = sets.select(F.col("set").alias("rid")).distinct()
    sketches = found.select("rid", F.col("n_shingles").alias("n"), "sketch").join(members, "rid", "left_semi")
    sketches = written(spark, sketches, "sketches")
    removed(spark, found)
    pivots = sets.groupBy("set").agg(F.min("low").alias("a")).where("set != a").select("a", F.col("set").alias("b"))

    def check(pairs: DataFrame) -> DataFrame:
        possible = written(spark, _possible(pairs, sketches, percent), "possible")
        ids = possible.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
        texts = written(spark, rows.where(in_bit_table(ids, "rid", F.col("rid"))).join(ids, "rid").select("rid", "text"), "texts")
        out = written(spark, _verified(possible, texts, n, percent), "links")
        removed(spark, possible, texts)
        return out

    links = check(pivots)
    root = classes(spark, links)
    placed = sets.select("key", "set").join(root, sets["set"] == root["node"], "left")
    placed = written(spark, placed.select("key", "set", F.coalesce("root", "set").alias("root")), "placed")
    more = check(_between_classes(spark, placed, sketches, percent))
    removed(spark, sets, placed, sketches)
    root = classes(spark, links.union(more))
    whole = named.join(root, named["set"] == root["node"], "left")
    whole = written(spark, whole.select("set", "first", F.coalesce("root", "set").alias("class")), "whole")
    low = whole.groupBy("class").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first"))["first"].alias("component_id"))
    ids = whole.join(low, "class").select("set", "component_id")
    out = mapped.join(ids, "set", "left")
    in_class = F.when(F.col("set").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", in_class.alias("component_id"))


def _short(sketches: DataFrame) -> DataFrame:
    """(set, n, q0, q1, ...): the sketches folded to SHORT words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded = [np.bitwise_xor.reduce(np.frombuffer(v.as_py(), np.int64).reshape(-1, SHORT), axis=0) for v in batch.column(2)]
            words = np.stack(folded, axis=1) if folded else np.empty((SHORT, 0), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(w) for w in words)], ["set", "n", *(f"q{i}" for i in range(SHORT))])

    return sketches.mapInArrow(work, "set long, n long, " + ", ".join(f"q{i} long" for i in range(SHORT)))


def _between_classes(spark: SparkSession, placed: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) that share a key and are in different classes, from rows (key, set, root).

    Those that their sizes or short sketches rule out are left out at once.
    """
    part = Window.partitionBy("key")
    several = placed.withColumns({"low": F.min("root").over(part), "high": F.max("root").over(part)}).where("low < high")
    several = written(spark, several.select("key", "set", "root"), "several")
    counts = several.groupBy("key", "root").agg(F.count("*").alias("n"))
    most = counts.groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("largest"))
    open_ = written(spark, several.join(most, "key"), "open")
    short = written(spark, _short(sketches), "short")
    found = [_pairs_at_keys(spark, open_.where(F.pmod("key", F.lit(PIECES)) == i), short, percent) for i in range(PIECES)]
    pairs = written(spark, functools.reduce(DataFrame.union, found).distinct(), "pairs")
    removed(spark, several, open_, short, *found)
    return pairs


def _pairs_at_keys(spark: SparkSession, open_: DataFrame, short: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of different classes at some of the keys."""
    open_ = written(spark, open_.join(short, "set"), "piece")
    words = [f"q{i}" for i in range(SHORT)]
    side = lambda c: ["key", F.col("set").alias(c), *(F.col(o).alias(f"{c}_{o}") for o in ("root", "n", *words))]
    left = open_.where("root != largest").select(*side("x"))
    right = open_.select(*side("y"), (F.col("root") == F.col("largest")).alias("in_largest"))
    # Pairs of two that are both outside the largest class are taken once.
    pairs = left.join(right, "key").where("x_root != y_root and (in_largest or x < y)")
    pairs = pairs.where(f"100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n)")
    distance = " + ".join(f"bit_count(x_{q} ^ y_{q})" for q in words)
    pairs = pairs.where(f"{100 + percent} * ({distance}) <= {100 - percent} * (x_n + y_n)")
    out = written(spark, pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "pairs")
    removed(spark, open_)
    return out


def without_near_duplicates(spark: SparkSession, docs: DataFrame, *, n: int, percent: int) -> DataFrame:
    """One document of each class, with all its columns: that with the smallest id; of rows with one id that with the smallest text hash, null ids
    last.  Texts without words are no copies, but of equal ones under one id one stays."""
    doc_id = F.col("doc_id").cast("long")
    repeated = docs.groupBy(doc_id.alias("doc_id")).count().where("count > 1").limit(1)
    if repeated.isEmpty():
        found = ngram_classes(spark, docs, n=n, percent=percent)
        out = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("gone")).distinct()
        out = written(spark, out, "gone")
        return docs.join(out, docs["doc_id"].cast("long").eqNullSafe(out["gone"]), "left_anti")
    # Ids do not tell the rows apart: numbers, written once, do.  No column has the name of all together.
    number = "number_" + "_".join(docs.columns)
    rows = written(spark, docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = ngram_classes(spark, rows.select(F.col(number).alias("doc_id"), "text"), n=n, percent=percent)
    order = F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), F.xxhash64("text").alias("hash"), F.col(number).alias("row"))
    members = rows.select(F.col(number).alias("row"), order.alias("place"), F.xxhash64("text").alias("hash"), doc_id.alias("id"))
    members = members.join(found.select(F.col("doc_id").alias("row"), "component_id", "n_shingles"), "row")
    kept = members.groupBy("component_id").agg(F.min("place")["row"].alias("kept"), F.first("id").alias("id"), F.first("hash").alias("hash"), F.first("n_shingles").alias("n"))
    # Texts without words are classes of their own; equal rows are one.
    blank = kept.where("n = 0").groupBy("id", "hash").agg(F.min("kept").alias("kept")).select("kept")
    kept = written(spark, kept.where("n > 0").select("kept").union(blank), "kept")
    return rows.join(kept, rows[number] == kept["kept"], "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_classes(spark, table(spark, folder, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(len(w) - 3), lambda i: array_to_string(w[i + 1 : i + 4], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b WHERE 100 * i.i >= 85 * (x.n + y.n - i.i)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.b AS doc_id, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id
FROM documents d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n
"""
