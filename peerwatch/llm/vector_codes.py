"""Operator 11: vector codes by product quantisation, the nearest entries found by Orchard's search.

Vectors become integers floor(1024 x) and are cut into four parts; each part has a codebook of up to 256 entries, refined in rounds: every
part goes to its nearest entry (squared distance, ties to the lower index), then every entry becomes the floor of the mean of its parts.

Nearest entries come from Orchard's search.  A codebook keeps, for every entry, all entries in order of their distance to it.  A search stands at an entry
and walks its list; a better entry is jumped to, and its list is walked from the start; entries once seen are marked and never measured again.  When the
list is more than twice the current distance away, the triangle inequality says that nothing better is left (entries at exactly
twice the distance may tie and are still looked at).  Searches of many parts go on side by side, a run of their lists at a time.

Scale: a round reads the vectors once.  Tasks add up their parts for each entry, and what is shuffled is one row for each task and cell of the codebooks, at
most 4 x 256 x (width + 1) cells.  The codebooks, of that fixed size, are what comes to the driver and goes to the tasks.  Errors
are summed by label before any join, and Spark's adaptive join splits a frequent label.

Defined results: vectors that are null or hold a null or non-finite component are left out; other vectors are taken as followed by zeros up to the longest
length, rounded up to a multiple of four; rows without vec_id come last in the choice of the first entries, rows that repeat one are ordered by their integers, and each gets its row;
equal entries are one place of two indices, of which the lower one is used; with fewer than 256 vectors the codebooks are
as small as that.  Numbers too large for 64 bits are worked out in Python's; an error beyond a long is given as the largest long.  An empty
table has no rows.  Further columns and clashing names are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.llm.common import table, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries of a list that are measured at once.
RUN = 16
#: Parts that are searched side by side.
BLOCK = 4096
LARGEST = (1 << 63) - 1
#: Sums travel in pieces of so many bits.
LIMB = 40


def integers(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are kept, their components as integers, followed by zeros up to ``width``)."""
    n = len(vectors)
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.values.slice(vectors.offsets[0].as_py(), vectors.offsets[-1].as_py() - vectors.offsets[0].as_py())
    numbers = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), lengths)
    bad = np.bincount(row[~np.isfinite(numbers)], minlength=n) > 0
    keep = vectors.is_valid().to_numpy(zero_copy_only=False) & ~bad
    scaled = np.floor(np.where(np.isfinite(numbers), numbers, 0.0) * SCALE)
    place = np.arange(len(numbers)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    large = bool(len(scaled)) and np.abs(scaled).max() >= 1 << 62
    out = np.zeros((n, width), object if large else np.int64)
    out[row, place] = [int(x) for x in scaled] if large else scaled.astype(np.int64)
    return np.flatnonzero(keep), out[keep]


class Codebook:
    """The entries of one part, with the list of neighbours of each."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        between = [self.distances(e, entries) for e in entries]
        self.neighbours = np.stack([np.argsort(row, kind="stable") for row in between])
        self.away = np.stack([row[order] for row, order in zip(between, self.neighbours, strict=True)])

    @staticmethod
    def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        d = x - y
        return (d * d).sum(axis=-1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of every part, by Orchard's search."""
        n, size = len(parts), len(self.entries)
        at = np.zeros(n, np.int64)
        best = self.distances(parts, self.entries[at])
        seen = np.zeros((n, size), bool)
        seen[:, 0] = True
        step = np.zeros(n, np.int64)
        going = np.arange(n)
        while len(going):
            columns = step[going, None] + np.arange(min(RUN, size))
            inside = columns < size
            columns = np.minimum(columns, size - 1)
            here = at[going, None]
            reach = 4 * best[going, None]
            # Squares: beyond twice the distance.
            inside &= self.away[here, columns] <= reach
            entries = self.neighbours[here, columns]
            who, column = np.nonzero(inside & ~seen[going[:, None], entries])
            entry = entries[who, column]
            row = going[who]
            seen[row, entry] = True
            measured = self.distances(parts[row], self.entries[entry])
            better = (measured < best[row]) | ((measured == best[row]) & (entry < at[row]))
            row, entry, measured = row[better], entry[better], measured[better]
            # Of the better entries of a run the best one is jumped to.
            order = np.lexsort((entry, measured, row))
            row, entry, measured = row[order], entry[order], measured[order]
            first = np.ones(len(row), bool)
            first[1:] = row[1:] != row[:-1]
            step[going] += RUN
            at[row[first]], best[row[first]], step[row[first]] = entry[first], measured[first], 0
            jumped = np.zeros(n, bool)
            jumped[row[first]] = True
            going = going[jumped[going] | (inside[:, -1] & (step[going] < size))]
        return at, best


def _safe(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as Python's integers where 64 bits could be too few."""
    most = max((int(np.abs(x).max()) for x in (parts, entries) if x.size), default=0)
    if parts.dtype != object and entries.dtype != object and 4 * parts.shape[1] * 4 * most * most < 1 << 62:
        return parts, entries
    return parts.astype(object), entries.astype(object)


class Books:
    """The codebooks of all parts: integers by (part, entry, position)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.made: dict[tuple[int, str], Codebook] = {}

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices, squared distances) by (vector, part)."""
        at, away = [], []
        for p, entries in enumerate(self.entries):
            width = entries.shape[1]
            own, entries = _safe(vectors[:, p * width : (p + 1) * width], entries)
            book = self.made.get((p, kind := str(entries.dtype)))
            if book is None:
                book = self.made[p, kind] = Codebook(entries)
            found = [book.nearest(own[i : i + BLOCK]) for i in range(0, len(own), BLOCK)]
            at.append(np.concatenate([f[0] for f in found]))
            away.append(np.concatenate([f[1] for f in found]))
        return np.stack(at, axis=1), np.stack(away, axis=1)

    def refined(self, sums: dict[int, int]) -> Books:
        """The next codebooks; sums: by cell of (part, entry, position), the last position the count."""
        out = self.entries.astype(object)
        width = out.shape[2]
        for p in range(out.shape[0]):
            for e in range(out.shape[1]):
                cell = (p * out.shape[1] + e) * (width + 1)
                if count := sums.get(cell + width, 0):
                    out[p, e] = [sums.get(cell + i, 0) // count for i in range(width)]
        small = not out.size or max(abs(x) for x in out.flat) < 1 << 62
        return Books(out.astype(np.int64) if small else out)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.flat).encode()).hexdigest()


def cell_sums(vectors: np.ndarray, at: np.ndarray, books: Books) -> dict[int, int]:
    """Sums and counts of the vectors by cell."""
    out = {}
    parts, entries, width = books.entries.shape
    for p in range(parts):
        own = vectors[:, p * width : (p + 1) * width]
        order = np.argsort(at[:, p], kind="stable")
        chosen, starts, counts = np.unique(at[order, p], return_index=True, return_counts=True)
        if own.dtype != object and own.size and int(np.abs(own).max()) * len(own) >= 1 << 62:
            own = own.astype(object)
        sums = np.add.reduceat(own[order], starts, axis=0) if len(starts) else []
        for e, row, count in zip(chosen, sums, counts, strict=True):
            cell = (p * entries + int(e)) * (width + 1)
            out[cell + width] = int(count)
            out.update((cell + i, int(x)) for i, x in enumerate(row) if x)
    return out


def _sums(rows: DataFrame, books: Books, dim: int) -> dict[int, int]:
    """The sums of all vectors by cell: each task adds up its own, then one row for each task and cell is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            _, vectors = integers(batch.column(0), dim)
            if len(vectors):
                for cell, x in cell_sums(vectors, books.nearest(vectors)[0], books).items():
                    total[cell] = total.get(cell, 0) + x
        keys, limbs = [], []
        for cell, x in total.items():
            # The last piece keeps the sign.
            for limb in range(5):
                rest = x >> LIMB * (limb + 1)
                last = rest in (0, -1) or limb == 4
                keys.append(cell * 5 + limb)
                limbs.append(x >> LIMB * limb if last else (x >> LIMB * limb) & ((1 << LIMB) - 1))
                if last:
                    break
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(limbs, pa.int64())], ["cell", "x"])

    sums: dict[int, int] = {}
    for r in rows.mapInArrow(work, "cell long, x long").groupBy("cell").agg(F.sum("x").alias("x")).collect():
        sums[r.cell // 5] = sums.get(r.cell // 5, 0) + (r.x << LIMB * (r.cell % 5))
    return sums


def _finite(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))


def codebooks(spark: SparkSession, vectors: DataFrame, *, rounds: int = ROUNDS) -> tuple[Books, int]:
    """The codebooks of rows (vec_id, embedding) after all rounds, and the padded length of a vector."""
    kept = vectors.where(_finite(F.col("embedding")))
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    dim = max(PARTS, -(-longest // PARTS) * PARTS)
    # Doubles from 2^53 on are whole numbers, and too large for floor.
    whole = F.transform("embedding", lambda x: F.when(F.abs(x) * SCALE < 1 << 53, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), whole).limit(ENTRIES).select("embedding").toArrow().column(0)
    kind = pa.list_(pa.float64())
    rows = integers(first.cast(kind).combine_chunks(), dim)[1] if len(first) else np.zeros((0, dim), np.int64)
    books = Books(rows.reshape(len(rows), PARTS, dim // PARTS).swapaxes(0, 1))
    for _ in range(rounds if len(rows) else 0):
        books = books.refined(_sums(kept.select("embedding"), books, dim))
    return books, dim


CODES = "vec_id long, code string, error long, label_key string"


def vector_codes(spark: SparkSession, vectors: DataFrame, *, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        # Null labels are equal.
        F.coalesce(F.concat(F.lit("+"), F.col("label").cast("string")), F.lit("")).alias("label_key"),
    )
    books, dim = codebooks(spark, rows.select("vec_id", "embedding"), rounds=rounds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "code", "error", "label_key"]
        for batch in batches:
            keep, own = integers(batch.column(1), dim)
            at, away = books.nearest(own) if len(own) else (np.zeros((0, PARTS), np.int64), np.zeros((0, PARTS), np.int64))
            codes = [bytes(row).hex() for row in at.astype(np.uint8)]
            errors = [min(LARGEST, sum(map(int, row))) for row in away]
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), pa.array(codes, pa.string()), pa.array(errors, pa.int64()), batch.column(2).take(keep)], names)

    coded = written(spark, rows.where(_finite(F.col("embedding"))).mapInArrow(work, CODES), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    by_label = coded.groupBy(F.col("label_key").alias("of_label")).agg(total.alias("label_error"))
    out = coded.join(by_label, F.col("label_key") == F.col("of_label"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes(spark, table(spark, folder, "embeddings"))


def _sql(rounds: int = ROUNDS) -> str:
    """The same in SQL, every distance worked out: a codebook b0, b1, ... and an assignment a0, a1, ... for each round."""
    width = f"(SELECT len(v) // {PARTS} FROM k LIMIT 1)"
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS (SELECT vec_id, p, min(ROW(d, e)) AS best FROM (SELECT q.vec_id, q.p, b.e, "
            f"list_sum(list_transform(list_zip(q.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d "
            f"FROM q JOIN b{i} b USING (p)) GROUP BY vec_id, p)"
        )
        if i < rounds:
            steps.append(
                f"m{i} AS (SELECT p, e, j, floor(sum(x)::HUGEINT / count(*))::BIGINT AS x FROM (SELECT q.p, best[2] AS e, "
                f"unnest(q.x) AS x, generate_subscripts(q.x, 1) AS j FROM q JOIN a{i} USING (vec_id, p)) GROUP BY p, e, j), "
                f"b{i + 1} AS (SELECT b.p, b.e, coalesce(n.x, b.x) AS x FROM b{i} b LEFT JOIN "
                f"(SELECT p, e, list(x ORDER BY j) AS x FROM m{i} GROUP BY p, e) n USING (p, e))"
            )
    return f"""
WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS MATERIALIZED (SELECT vec_id, p, v[p * {width} + 1 : (p + 1) * {width}] AS x FROM k, range({PARTS}) AS r(p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM q QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {ENTRIES}),
{", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)},
c AS (SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM c JOIN k USING (vec_id)
"""


SQL = _sql()
