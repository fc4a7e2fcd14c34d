"""Operator 3: quality classifier by importance resampling.

Two kinds of text are modelled by hashed n-grams: the target (labelled good and not toxic) and raw text.  Raw text is a
mixture: the documents at large that are not the labelled target, and one component for each other label.  Counted are words,
their beginnings of four letters, pairs of neighbouring word shapes ("THE!!" is ``A!``) and runs of one word, each once a
text.  The log-weight of a document is the log of the ratio of the two likelihoods.  As many documents as the target explains
better, at the labelled shares, are then drawn by Gumbel top-k: those with the largest log-weight plus ``temperature`` times
Gumbel noise, which is a fixed function of seed and id.

Every bucket weighs in: the log of its two smoothed rates, times G^3 / (G^3 + SURE^3), G the statistic of the likelihood-ratio
test of the two counts, so that a rare n-gram says as much as its count is sure.  Two kinds of n-grams are no independent
evidence: those that occur in exactly the same documents (a passage, the own words of one document) share one weight, and a
word and its beginning have half a weight each.  Near copies (by min-hashes of their n-grams) are counted once in all models.

Scale: n-grams are taken from each text once and stored; counting adds up in arrays of a fixed size per task before anything
is shuffled, and the driver sees tables of fixed size.  Of copies, the one with the least hash counts: minima per min-hash are
taken map-side, and the others are told by a filter of fixed size, so that a family of a third of all rows is no burden.  The
raw model counts all documents; of each label at most ``SAMPLE`` rows are learned from, those with the smallest hash of the id
(documented bound, which makes the broadcast of their ids safe).  The k-th largest key is found by counting in bins, so nothing
is sorted.

Defined results: a text without a word (null, empty) is never selected; without a target label or without any other all weights
are 0 and all documents with words are selected; equal keys are taken by smaller id, a null id last; rows that repeat an id are
drawn together if their texts are equal, each by its own text else; labels for ids that are not there are ignored; very long
texts are read whole, their n-grams are as many as there are buckets at most; other columns are not touched, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.llm.common import removed, table, text_of, written
from peerwatch.operators.exclusion import IDS_PER_WORD, MAX_WORDS, listed_words, split_by_words

#: Rows of each label that are learned from.
SAMPLE = 20_000
WORD_BUCKETS, START_BUCKETS, SHAPE_BUCKETS = 1 << 20, 1 << 18, 1 << 14
SHAPES_AT = WORD_BUCKETS + START_BUCKETS
BUCKETS = SHAPES_AT + SHAPE_BUCKETS
START = 4
#: Texts that every rate borrows, and the statistic at which a bucket has half its weight.
BORROWED, SURE = 1.0, 25.0
#: Share of the documents at large in the raw mixture, as a part of that of the labels.
AT_LARGE = 0.1
#: Min-hashes in a band, and bands: texts with an equal band count as copies.
ROWS, BANDS = 6, 4
TEMPERATURE, SEED = 0.25, 17
SEEN_WORDS = 500_000
TARGET, REST = "good", "at large"
FEW = 5_000
BINS = 4096
#: Key of a document without words.
NOTHING = -1e300

_EDGES = ".,;:!?()[]{}\"'*&%$#|<>-_/\\"
_SHAPE = ((re.compile(r"[^\W\d_]"), "a"), (re.compile(r"\d"), "9"), (re.compile(r"(.)\1+"), r"\1"))
_ODD = np.random.default_rng(SEED).integers(1, 1 << 62, ROWS * BANDS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _shape(word: str) -> str:
    if word.isalpha() and word[1:].islower():
        return "a" if word[0].islower() else "Aa"
    shape = "".join("A" if c.isupper() else c for c in word[:64])
    for pattern, by in _SHAPE:
        shape = pattern.sub(lambda m, by=by: m[0] if by == "a" and m[0] == "A" else m.expand(by), shape)
    return shape


def _number(gram: str, size: int) -> int:
    """Bucket 0 of every kind stands for a repeated word."""
    return 1 + zlib.crc32(gram.encode("utf-8", "replace")) % (size - 1)


class _Words(dict):
    """Bucket of a word, of its beginning, and shape number, in one integer."""

    def __missing__(self, word):
        if len(self) >= SEEN_WORDS:
            self.clear()
        inner = word.lower().strip(_EDGES)
        both = _number(inner, WORD_BUCKETS) << 18 | _number(inner[:START], START_BUCKETS)
        value = self[word] = both << 20 | _number(_shape(word), 1 << 20)
        return value


def features(text: str, seen: _Words) -> np.ndarray:
    """The buckets of the n-grams of a text, ascending, each once: words come in bursts, so their number in one text says little."""
    words = text.split()
    if not words:
        return np.empty(0, np.int64)
    each = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
    again = np.concatenate(([False], each[1:] == each[:-1]))
    each[again] = 0
    shape = each & 0xFFFFF
    before = np.concatenate(([0], shape[:-1]))
    pairs = np.unique((before * 1_000_003 + shape * 7_919 + 1) % SHAPE_BUCKETS)
    both = np.unique(each >> 20)
    found = (np.unique(both >> 18), WORD_BUCKETS + np.unique(both & 0x3FFFF), SHAPES_AT + pairs)
    if not again.any():
        return np.concatenate(found)
    # Long n-grams of one word: only how long they are, in powers of two.
    edges = np.flatnonzero(np.diff(np.concatenate(([0], again.astype(np.int8), [0]))))
    runs = np.log2(edges[1::2] - edges[::2]).astype(np.int64)
    return np.unique(np.concatenate((*found, BUCKETS - 1 - runs)))


def bands(found: np.ndarray) -> list[int]:
    """Hashes of the bands of min-hashes of a set of buckets; of no bucket there are none."""
    if not len(found):
        return []
    least = np.full(len(_ODD), np.iinfo(np.uint64).max, np.uint64)
    for piece in np.array_split(found.astype(np.uint64) + np.uint64(1), -(-len(found) // 4096)):
        mixed = piece[:, None] * _ODD
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, (mixed ^ mixed >> np.uint64(32)).min(axis=0), out=least)
    names = np.bitwise_xor.reduce(least.reshape(BANDS, ROWS) * _ODD[:ROWS], axis=1)
    return names.view(np.int64).tolist()


def _packed(found: np.ndarray) -> bytes:
    return np.diff(found, prepend=0).astype("<u4").tobytes()


def _unpacked(value: bytes) -> np.ndarray:
    return np.frombuffer(value, "<u4").cumsum(dtype=np.int64)


def _featured(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, bands, grams) of every document; the mark is a hash of id and text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Words()
        for batch in batches:
            found = [features(value.as_py(), seen) for value in batch.column(2)]
            near = pa.array([bands(f) for f in found], pa.list_(pa.int64()))
            grams = pa.array([_packed(f) for f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), near, grams], ["doc_id", "mark", "bands", "grams"])

    return _marked(docs).mapInArrow(work, "doc_id long, mark long, bands array<long>, grams binary")


def _mark(docs: DataFrame):
    return F.xxhash64(docs["doc_id"].cast("long"), text_of(docs))


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), _mark(docs).alias("mark"), text_of(docs).alias("text"))


def _sample(labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, kind) of the labelled rows that are learned from."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"), F.col("toxic").cast("int").alias("t"))
    rows = rows.where("doc_id is not null and q in (0, 1) and t in (0, 1)")
    kind = F.when((F.col("q") == 1) & (F.col("t") == 0), TARGET).otherwise(F.concat(F.lit("raw"), F.col("q"), F.lit("-"), F.col("t")))
    rows = rows.select("doc_id", kind.alias("kind")).distinct()
    order = F.xxhash64("doc_id", F.lit("quality")), F.col("doc_id")
    parts = (rows.where(F.col("kind") == k).orderBy(*order).limit(sample) for k in (TARGET, "raw0-0", "raw0-1", "raw1-1"))
    return reduce(DataFrame.union, parts)


def _open_to(df: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose mark is surely not listed, rows whose mark may be)."""
    words = max(1, min(MAX_WORDS, -(-listed.count() // IDS_PER_WORD)))
    return split_by_words(df, "mark", listed_words(listed.select(F.col("mark").alias("id")), words), words)


def _copies(featured: DataFrame) -> DataFrame:
    """Marks of the documents that are near copies of one with a smaller mark."""
    near = featured.where(F.size("bands") > 0).select("mark", F.posexplode("bands").alias("i", "band"))
    least = near.groupBy("i", "band").agg(F.min("mark").alias("mark"))
    firsts = least.groupBy("mark").agg(F.count("*").alias("n")).where(F.col("n") == BANDS)
    return featured.select("mark").distinct().join(firsts, "mark", "left_anti")


def _counts(rows: DataFrame) -> DataFrame:
    """Of rows (kind, mark, grams): in how many texts of a kind each bucket occurs, and the exclusive or of their marks.

    The bucket after the last one counts texts.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {}
        for batch in batches:
            for kind, mark, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if kind not in counts:
                    counts[kind] = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
                n, marks = counts[kind]
                found = _unpacked(value)
                n[found] += 1
                marks[found] ^= mark
                n[BUCKETS] += 1
        for kind, (n, marks) in counts.items():
            full = np.flatnonzero(n)
            columns = [pa.array([kind] * len(full), pa.string()), pa.array(full), pa.array(n[full]), pa.array(marks[full])]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "bucket", "n", "marks"])

    found = rows.select("kind", "mark", "grams").mapInArrow(work, "kind string, bucket long, n long, marks long")
    return found.groupBy("kind", "bucket").agg(F.sum("n").alias("n"), F.bit_xor("marks").alias("marks"))


def tilt(t: np.ndarray, texts: int, r: np.ndarray, raw_texts: int) -> np.ndarray:
    """Log of the raw rate of each bucket over the target's, as far as the counts are sure of it."""
    t, r = t.astype(float), r.astype(float)
    rate = (t + r) / (texts + raw_texts)
    part = lambda n, of: n * np.log(np.where(n > 0, n, 1) / np.where(rate > 0, of * rate, 1))
    g = np.maximum(2 * (part(t, texts) + part(r, raw_texts)), 0)
    log = np.log((r + BORROWED) / (raw_texts * rate + BORROWED)) - np.log((t + BORROWED) / (texts * rate + BORROWED))
    return log * g**3 / (g**3 + SURE**3)


def evidence(n: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The weight of each bucket, by its documents: those with the same documents share one, words and beginnings a half."""
    order = np.lexsort((marks, n))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(n[order]) != 0) | (marks[order[1:]] != marks[order[:-1]])
    starts = np.flatnonzero(new)
    many = np.diff(starts, append=len(order))
    out = np.empty(len(order), np.float32)
    out[order] = np.repeat(1 / many, many)
    out[:SHAPES_AT] /= 2
    out[n == 0] = 1
    return out


def model_of(counts: dict, marks: np.ndarray, shares: dict) -> dict:
    """The model from the texts that each bucket is in, of all documents under ``REST`` and of each label; last the number of
    texts.  ``marks`` are those of all documents.  Buckets are taken in slices, as the driver's memory is bounded."""
    t, weigh = counts[TARGET], evidence(counts[REST][:-1], marks[:-1])
    raws = sorted(shares.keys() - {TARGET})
    raw = sum(shares[k] for k in raws)
    tilts = np.empty((BUCKETS, len(raws) + 1), np.float32)
    for low in range(0, BUCKETS, 1 << 16):
        part = slice(low, min(low + (1 << 16), BUCKETS))
        for i, kind in enumerate((*raws, REST)):
            n, texts = counts[kind][part], counts[kind][-1]
            if kind == REST:
                n, texts = np.maximum(n - t[part], 0), max(texts - t[-1], 1)
            tilts[part, i] = weigh[part] * tilt(t[part], t[-1], n, texts)
    each = np.array([*(shares[k] for k in raws), AT_LARGE * raw])
    return {"tilts": tilts, "shares": np.log(each / each.sum()), "odds": float(np.log(shares[TARGET] / raw))}


def first_of_copies(rows: pa.Table) -> pa.Table:
    """(doc_id, mark, kind) of the rows that share no band with one before them, by id and kind.

    Of copies and near copies one is learned from, or their words would count as typical of their label.
    """
    rows = rows.sort_by([("doc_id", "ascending"), ("kind", "ascending")])
    # By column of arrays: as Python objects the bands of all labelled rows would be the most that the driver holds.
    names = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    first = np.ones(len(names), bool)
    for band in names.T:
        new = np.zeros(len(names), bool)
        new[np.unique(band, return_index=True)[1]] = True
        first &= new
    return rows.select(["doc_id", "mark", "kind"]).filter(pa.array(first))


def _model(spark: SparkSession, featured: DataFrame, labels: DataFrame, sample: int) -> dict:
    chosen = written(spark, _sample(labels, sample), "sample")
    # One row of each labelled id, however many there are.
    rows = featured.join(F.broadcast(chosen), "doc_id").where(F.size("bands") > 0)
    rows = rows.groupBy("doc_id", "kind").agg(F.min("mark").alias("mark"), F.min_by("bands", "mark").alias("bands")).toArrow()
    shares, kept = Counter(rows.column("kind").to_pylist()), first_of_copies(rows)
    del rows
    if TARGET not in shares or len(shares) < 2:
        return {}
    few = F.broadcast(spark.createDataFrame(kept, "doc_id long, mark long, kind string"))
    labelled = featured.join(few, ["doc_id", "mark"])
    copies = written(spark, _copies(featured), "copies")
    rest = F.lit(REST).alias("kind")
    sure, open_rows = _open_to(featured.select("mark", "grams"), copies)
    at_large = sure.union(open_rows.join(copies, "mark", "left_anti"))
    parts = labelled.select("kind", "mark", "grams").union(at_large.select(rest, "mark", "grams"))
    counted = written(spark, _counts(parts), "counts")
    counts, marks = {}, np.zeros(BUCKETS + 1, np.int64)
    for kind in (*shares, REST):
        columns = ["bucket", "n", *(["marks"] if kind == REST else [])]
        arrow = counted.where(F.col("kind") == kind).select(*columns).toArrow()
        at = arrow.column("bucket").to_numpy()
        counts[kind] = np.zeros(BUCKETS + 1, np.int64)
        counts[kind][at] = arrow.column("n").to_numpy()
        if kind == REST:
            marks[at] = arrow.column("marks").to_numpy()
        del arrow, at
    removed(spark, chosen, copies, counted)
    return model_of(counts, marks, shares)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> dict:
    """For each component of raw text the log of its rate of every bucket over the target's, and the shares of the components."""
    featured = written(spark, _featured(docs), "grams")
    model = _model(spark, featured, labels, sample)
    removed(spark, featured)
    return model


class Scorer:
    def __init__(self, model: dict):
        self.seen, self.model = _Words(), model

    def log_weight(self, text: str) -> float | None:
        """Of the target against raw text, at the labelled odds; None without words."""
        return self.of_grams(features(text, self.seen))

    def of_grams(self, found: np.ndarray) -> float | None:
        if not len(found):
            return None
        if not self.model:
            return 0.0
        each = self.model["tilts"][found].sum(axis=0, dtype=np.float64) + self.model["shares"]
        most = each.max()
        return self.model["odds"] - float(most + np.log(np.exp(each - most).sum()))


def gumbel(doc_id: int | None, seed: int) -> float:
    raw = hashlib.blake2b(f"{seed}:{doc_id}".encode(), digest_size=8).digest()
    u = ((int.from_bytes(raw, "little") >> 11) + 0.5) / (1 << 53)
    return -float(np.log(-np.log(u)))


def _scores(featured: DataFrame, model: dict, temperature: float, seed: int) -> DataFrame:
    """(doc_id, log_weight, key, mark) of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for doc_id, value in zip(ids, batch.column(2).to_pylist(), strict=True):
                weight = scorer.of_grams(_unpacked(value))
                out.append((weight, NOTHING if weight is None else weight + temperature * gumbel(doc_id, seed)))
            columns = [batch.column(0), *(pa.array([o[i] for o in out], pa.float64()) for i in (0, 1)), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "log_weight", "key", "mark"])

    return featured.select("doc_id", "mark", "grams").mapInArrow(work, "doc_id long, log_weight double, key double, mark long")


def kth_largest(df: DataFrame, column: str, k: int) -> tuple[float, int]:
    """(the k-th largest value, how many of the rows with that value are among the k), by counting in bins."""
    x = F.col(column)
    low, high, n = df.agg(F.min(x), F.max(x), F.count(x)).first()
    while low < high and n > FEW:
        width = (high - low) / BINS
        number = F.least(F.lit(BINS - 1), F.floor((x - low) / width)) if width > 0 else F.when(x > low, 1).otherwise(0)
        inside = df.where((x >= low) & (x <= high)).groupBy(number.alias("bin"))
        for r in sorted(inside.agg(F.count("*").alias("n"), F.min(x).alias("a"), F.max(x).alias("b")).collect(), key=lambda r: -r.bin):
            if k <= r.n:
                low, high, n = r.a, r.b, r.n
                break
            k -= r.n
    if low == high:
        return low, k
    values = sorted((r[0] for r in df.where((x >= low) & (x <= high)).select(x).collect()), reverse=True)
    value = values[k - 1]
    return value, k - sum(v > value for v in values)


def _border(scored: DataFrame) -> tuple[float, float]:
    """(key, id) of the last selected document: larger keys are in, and equal keys up to this id."""
    k = scored.where("log_weight >= 0").count()
    if not k:
        return inf, -inf
    key, among = kth_largest(scored.where("log_weight is not null"), "key", k)
    same = scored.where(F.col("key") == key).select((-F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("back"))
    return key, -kth_largest(same, "back", among)[0]


def _is_in(border):
    key, doc_id = F.col("key"), F.col("doc_id")
    return (key > border[0]) | ((key == border[0]) & (F.coalesce(doc_id, F.lit((1 << 63) - 1)) <= F.lit(border[1])))


def _scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, temperature: float, seed: int, sample: int) -> DataFrame:
    featured = written(spark, _featured(docs), "grams")
    scored = written(spark, _scores(featured, _model(spark, featured, labels, sample), temperature, seed), "scored")
    removed(spark, featured)
    return scored.withColumn("selected", _is_in(_border(scored)))


def resample(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, *, temperature: float = TEMPERATURE, seed: int = SEED, sample: int = SAMPLE
) -> DataFrame:
    """One row per document: doc_id, log_weight (null without words), key, selected."""
    return _scored(spark, docs, labels, temperature, seed, sample).drop("mark")


def selected_documents(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, *, temperature: float = TEMPERATURE, seed: int = SEED, sample: int = SAMPLE
) -> DataFrame:
    """The selected documents with all their columns.

    A filter of the rejected documents' marks lets most of the selected ones pass; only the rest of the texts meets the list.
    """
    scored = _scored(spark, docs, labels, temperature, seed, sample)
    out = written(spark, scored.where(~F.col("selected")).select("doc_id", "mark").distinct(), "rejected")
    # Names that the documents do not have.
    inner = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*(docs[c].alias(n) for c, n in inner.items()), _mark(docs).alias("mark"))
    sure, open_rows = _open_to(rows, out)
    doc_id = F.col(inner["doc_id"]).cast("long")
    listed = out.select(F.col("doc_id").alias("out_id"), F.col("mark").alias("out_mark"))
    open_rows = open_rows.join(listed, (F.col("mark") == F.col("out_mark")) & doc_id.eqNullSafe(F.col("out_id")), "left_anti")
    return sure.union(open_rows).select(*(F.col(n).alias(c) for c, n in inner.items()))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return resample(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))
