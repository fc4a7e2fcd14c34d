"""Operator 12: language-model scores of texts by subword lattices.

A text is its words (lower-cased A-Z, cut at the white space of ASCII) and one end.  A word, after the mark of a word's begin, is spelt by
pieces of an existing vocabulary.  Every way to spell it is a path through a lattice whose arcs are the pieces found in it, weighted by their
unigram scores, and the lattice's probability of the word is the sum over all paths, worked out from left to right in log space.  Pieces that
begin a word and those inside are two distributions, and a word ends after each piece with one probability, so that words have a proper
distribution; every byte is a piece inside, so that every word has a path.

A word of the training documents is one more arc, from end to end, with the probability of its count less a discount d; the discounts of all words,
d * V / N, are the weight of the spelt paths.  d is n1 / (n1 + 2 n2), from the numbers of words that occur once and twice.  A text's probability
is the product over its words and its end, the marginal over all paths through the text.

The vocabulary, its pieces and their ranks, is given and never trained.  Its unigram scores start from the ranks (Zipf's law) and are fitted to
the distinct training words by expectation maximisation: a forward pass, then shares of the paths from the last place backward.

The base score is that of a unigram model of whole words, with 0.1 added to every count.

Scale: documents are read twice.  Tasks count their words before the shuffle, and every distinct word goes through the lattice once for each
round, not once for each occurrence.  What the model gathers is the table of distinct words, which grows with the corpus and stays
distributed; to the driver come the expected counts of the pieces, a vector of the vocabulary's fixed size, and the words that are more than one
in ``COMMON`` of all words, fewer than that by definition.  Those scores are known to the tasks, so that only the rarer words of a document are
shuffled to their scores, and no word has more than that share of the rows.

Defined results: null and empty texts are just the end; a null doc_id has no decimal form and is trained on, not held out; rows that repeat an
id are scored each by their own text; a very long word is one lattice, in time linear in its length, on its own; without training documents n_known is
0, the pieces keep their scores by rank, and words and ends are equally likely; an empty table has no rows; further columns and clashing names
are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.llm.common import table, text_of, written

HELD_OUT, ADDED = 10, 0.1
#: Rounds of expectation maximisation, and the expected count that every piece has besides.
ROUNDS, PIECE_COUNT = 2, 0.01
#: Words that are more than one in so many are known to all tasks.
COMMON = 200_000
#: Distinct words that a task holds before it passes its counts on.
HELD_WORDS = 400_000
BEGIN = "▁".encode()
#: The end of a text as a word; no word holds a space.
END = b" "
#: Longer words travel as their hash.
LONG = 48
#: Words of up to so many bytes, with the mark, are worked on side by side.
SIDE = 64
#: Base of the rolling hash by which pieces are found in many words at once, and the bits of the table that most other strings fail.
_BASE, _SPREAD, _BITS = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 22


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pieces_of(path: str) -> list[bytes]:
    """The pieces of a sentencepiece vocabulary in the order of their ranks, then the begin and the single bytes that are not among them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    normal.sort(key=lambda i: -model.get_score(i))
    out = dict.fromkeys(model.id_to_piece(i).encode() for i in normal)
    out.update(dict.fromkeys([BEGIN, *(bytes([b]) for b in range(256))]))
    return list(out)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


class Lattice:
    """All spellings of a word, weighted by log probabilities of pieces.

    ``scores`` hold, for every piece, the log probability among those that begin a word or among those inside; ``stop`` is the
    probability that a word ends after a piece.
    """

    def __init__(self, pieces: list[bytes], scores: np.ndarray, stop: float):
        self.number = {piece: i for i, piece in enumerate(pieces)}
        # A piece, and the word goes on.
        scores = (scores + math.log1p(-stop)).tolist()
        self.begin = {p: s for p, s in zip(pieces, scores, strict=True) if p.startswith(BEGIN)}
        self.inside = {p: s for p, s in zip(pieces, scores, strict=True) if not p.startswith(BEGIN)}
        self.longest = max(map(len, pieces))
        self.finish = math.log(stop) - math.log1p(-stop)
        # The last place stands for no piece.
        self.scores = np.append(scores, -np.inf)
        powers = [1]
        for _ in range(SIDE):
            powers.append(powers[-1] * _BASE % (1 << 64))
        self.powers = np.array(powers, np.uint64)
        self.tables = [self._table([p for p in pieces if p.startswith(BEGIN) == begins and len(p) <= SIDE]) for begins in (True, False)]

    def _table(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted hashes, numbers, table of bits) of the pieces."""
        hashes = []
        for piece in pieces:
            h = 0
            for b in piece:
                h = (h * _BASE + b + 1) % (1 << 64)
            hashes.append(h)
        hashed = np.array(hashes, np.uint64)
        order = np.argsort(hashed)
        bits = np.zeros(1 << _BITS, bool)
        bits[self._bit(hashed)] = True
        return hashed[order], np.array([self.number[p] for p in pieces], np.int64)[order], bits

    @staticmethod
    def _bit(hashed: np.ndarray) -> np.ndarray:
        return (hashed * np.uint64(_SPREAD)) >> np.uint64(64 - _BITS)

    def _pieces(self, hashed: np.ndarray, begins: bool) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 for none."""
        keys, numbers, bits = self.tables[0 if begins else 1]
        out = np.full(hashed.shape, -1, np.int64)
        maybe = np.nonzero(bits[self._bit(hashed)])
        some = hashed[maybe]
        at = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
        out[maybe] = np.where(keys[at] == some, numbers[at], -1)
        return out

    def _side_by_side(self, spelt: list[bytes]) -> tuple[np.ndarray, list]:
        """Log of the ways to each place of words of one length, and for every place (starts, pieces, log of the ways by each)."""
        n, size = len(spelt), len(spelt[0])
        data = np.frombuffer(b"".join(spelt), np.uint8).reshape(n, size)
        hashed = np.zeros((n, size + 1), np.uint64)
        for i in range(size):
            hashed[:, i + 1] = hashed[:, i] * np.uint64(_BASE) + data[:, i] + np.uint64(1)
        ways, arcs = np.full((n, size + 1), -np.inf), []
        ways[:, 0] = 0.0
        with np.errstate(divide="ignore"):
            for end in range(len(BEGIN), size + 1):
                # Nothing but a piece that begins the word ends within the mark.
                starts = np.arange(max(len(BEGIN), end - self.longest), end)
                found = [self._pieces(hashed[:, end : end + 1], True)] if end <= self.longest else []
                found.append(self._pieces(hashed[:, end : end + 1] - hashed[:, starts] * self.powers[end - starts], False))
                starts = np.append(0, starts) if end <= self.longest else starts
                pieces = np.concatenate(found, axis=1)
                by = ways[:, starts] + self.scores[pieces]
                most = by.max(axis=1)
                least = np.where(np.isfinite(most), most, 0.0)
                ways[:, end] = least + np.log(np.exp(by - least[:, None]).sum(axis=1))
                arcs.append((starts, pieces, by))
        return ways, arcs

    def _by_length(self, words: list[bytes]) -> Iterator[tuple[list[int], list[bytes] | None]]:
        """Places of words of one length and their spellings; None if they are long."""
        groups: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            groups.setdefault(min(len(word), SIDE), []).append(i)
        for size, places in groups.items():
            yield places, [BEGIN + words[i] for i in places] if size + len(BEGIN) <= SIDE else None

    def logs(self, words: list[bytes]) -> np.ndarray:
        """``log`` of many words."""
        out = np.empty(len(words))
        for places, spelt in self._by_length(words):
            out[places] = [self.log(words[i]) for i in places] if spelt is None else self._side_by_side(spelt)[0][:, -1] + self.finish
        return out

    def expect_all(self, words: list[bytes], counts: np.ndarray) -> None:
        """``expect`` of many words."""
        for places, spelt in self._by_length(words):
            if spelt is None:
                for i in places:
                    self.expect(words[i], counts)
                continue
            ways, arcs = self._side_by_side(spelt)
            share = np.zeros(ways.shape)
            share[:, -1] = 1.0
            for end in range(len(spelt[0]), len(BEGIN) - 1, -1):
                starts, pieces, by = arcs[end - len(BEGIN)]
                row, column = np.nonzero((pieces >= 0) & (share[:, end : end + 1] > 0))
                use = share[row, end] * np.exp(by[row, column] - ways[row, end])
                np.add.at(share, (row, starts[column]), use)
                counts += np.bincount(pieces[row, column], use, minlength=len(counts))

    def arcs(self, spelt: bytes) -> list[list[tuple[int, float]]]:
        """For every place the (start, log probability) of the pieces that end there."""
        begin, inside, longest = self.begin, self.inside, self.longest
        out = [[]]
        for end in range(1, len(spelt) + 1):
            here = []
            if end <= longest and (score := begin.get(spelt[:end])) is not None:
                here.append((0, score))
            for start in range(max(1, end - longest), end):
                if (score := inside.get(spelt[start:end])) is not None:
                    here.append((start, score))
            out.append(here)
        return out

    @staticmethod
    def forward(arcs: list[list[tuple[int, float]]]) -> list[float | None]:
        """Log of the summed probability of all ways to each place; None where there is none."""
        out, exp, log = [0.0], math.exp, math.log
        for here in arcs[1:]:
            terms = [out[start] + score for start, score in here if out[start] is not None]
            if len(terms) > 1:
                most = max(terms)
                out.append(most + log(sum([exp(t - most) for t in terms])))
            else:
                out.append(terms[0] if terms else None)
        return out

    def log(self, word: bytes) -> float:
        """Natural log of the probability of a word."""
        return self.forward(self.arcs(BEGIN + word))[-1] + self.finish

    def expect(self, word: bytes, counts: np.ndarray) -> None:
        """Add the expected uses of every piece in the word."""
        spelt = BEGIN + word
        arcs = self.arcs(spelt)
        ways, exp, number = self.forward(arcs), math.exp, self.number
        share = [0.0] * len(ways)
        share[-1] = 1.0
        for end in range(len(spelt), 0, -1):
            if part := share[end]:
                for start, score in arcs[end]:
                    if ways[start] is not None:
                        use = part * exp(ways[start] + score - ways[end])
                        share[start] += use
                        counts[number[spelt[start:end]]] += use


def _normal(pieces: list[bytes], weight: np.ndarray) -> np.ndarray:
    """Log probabilities, of those that begin a word and of those inside each."""
    begins = np.fromiter((p.startswith(BEGIN) for p in pieces), bool, len(pieces))
    return np.log(weight / np.where(begins, weight[begins].sum(), weight[~begins].sum()))


def first_scores(pieces: list[bytes]) -> tuple[np.ndarray, float]:
    """Log probabilities by rank, and the probability of a word's end after a piece."""
    return _normal(pieces, 1.0 / (np.arange(len(pieces)) + 2.7)), 0.5


def _key(word: bytes) -> bytes:
    """The word, or a digest that no word equals (words hold no space)."""
    return word if len(word) <= LONG else b" " + hashlib.blake2b(word, digest_size=20).digest()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def word_counts(rows: DataFrame) -> DataFrame:
    """(key, word, c) of all distinct words of rows (held_out, text), c counted in training rows only; the end is one of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for out, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = words(text.as_py())
                if out:
                    counts.update(dict.fromkeys(own, 0))
                else:
                    counts.update(own)
                    counts[END] += 1
                if len(counts) > HELD_WORDS:
                    yield _counted(counts)
                    counts = Counter()
        yield _counted(counts)

    found = rows.mapInArrow(work, "key binary, word binary, c long")
    return found.groupBy("key").agg(F.max("word").alias("word"), F.sum("c").alias("c"))


def _counted(counts: Counter) -> pa.RecordBatch:
    found = list(counts)
    columns = [pa.array(list(map(_key, found)), pa.binary()), pa.array(found, pa.binary()), pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["key", "word", "c"])


def fitted(distinct: DataFrame, pieces: list[bytes], *, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces and the probability of a word's end, fitted to the rows (word)."""
    scores, stop = first_scores(pieces)
    for _ in range(rounds):

        def work(batches: Iterator[pa.RecordBatch], scores=scores, stop=stop) -> Iterator[pa.RecordBatch]:
            # One place more counts the words.
            lattice, expected = Lattice(pieces, scores, stop), np.zeros(len(pieces) + 1)
            for batch in batches:
                lattice.expect_all(batch.column(0).to_pylist(), expected)
                expected[-1] += len(batch)
            used = np.flatnonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(expected[used])], ["piece", "n"])

        expected = np.zeros(len(pieces) + 1)
        for r in distinct.mapInArrow(work, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():
            expected[r.piece] = r.n
        if not expected[-1]:
            break
        scores, stop = _normal(pieces, expected[:-1] + PIECE_COUNT), min(0.999, expected[-1] / expected[:-1].sum())
    return scores, stop


class WordModel:
    """Log10 probabilities of words from their counts and their spellings."""

    def __init__(self, n: int, v: int, once: int, twice: int, lattice: Lattice | None):
        self.n, self.lattice = n, lattice
        self.discount = max(0.1, once / (once + 2 * twice)) if once else 0.5
        self.spelt = math.log(self.discount * v / n) if n else math.log(0.5)

    def counted(self, c: int) -> float:
        return (c - self.discount) / self.n if c else 0.0

    def words(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            counted = np.log(np.where(counts > 0, counts - self.discount, 0.0) / max(1, self.n))
        return np.logaddexp(counted, self.spelt + self.lattice.logs(words)) / math.log(10)

    def end(self, c: int) -> float:
        return math.log10(self.counted(c)) if c else math.log10(0.5)


def scored_words(spark: SparkSession, rows: DataFrame, pieces: list[bytes], *, rounds: int = ROUNDS) -> tuple[DataFrame, float, int, int, int]:
    """The model: (key, c, score) of all distinct words, the score of the end, N, V and the number of training ends."""
    counts = written(spark, word_counts(rows), "words")
    number = lambda condition, what: F.coalesce(F.sum(F.when(F.expr(condition), F.expr(what))), F.lit(0))
    is_end = "word = X'20'"
    total = counts.agg(
        number("c > 0", "c").alias("n"),
        number("c > 0", "1").alias("v"),
        number("c = 1", "1").alias("once"),
        number("c = 2", "1").alias("twice"),
        number(is_end, "c").alias("ends"),
    ).first()
    scores, stop = fitted(counts.where(f"c > 0 and not {is_end}").select("word"), pieces, rounds=rounds)
    figures = (total.n, total.v, total.once, total.twice)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = WordModel(*figures, Lattice(pieces, scores, stop))
        for batch in batches:
            found = model.words(batch.column(1).to_pylist(), batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found)], ["key", "c", "score"])

    model = counts.where(f"not {is_end}").mapInArrow(work, "key binary, c long, score double")
    return written(spark, model, "model"), WordModel(*figures, None).end(total.ends), total.n, total.v, total.ends


OUT = "rid long, doc_id long, held_out boolean, key binary, n long, n_tokens long, n_known long, base double, score double"
_TYPES = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split(" ")[0] for field in OUT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names)


def scored(spark: SparkSession, docs: DataFrame, *, vocabulary: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    pieces = pieces_of(vocabulary or vocabulary_path())
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), text_of(docs).alias("text"))
    model, end, n, v, ends = scored_words(spark, rows.select("held_out", "text"), pieces, rounds=rounds)
    # Fewer than COMMON words can be more than one in COMMON each.
    common = {bytes(r.key): (r.c, r.score) for r in model.where(F.col("c") * COMMON > n).collect()}
    base = math.log10(n + ADDED * (v + 1))
    first = 1, int(ends > 0), math.log10(ends + ADDED) - base, end

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {key: (math.log10(c + ADDED) - base, score) for key, (c, score) in common.items()}
        for batch in batches:
            out = []
            for rid, own_id, held, text in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                tokens, seen, base_sum, score = first
                for word, times in Counter(words(text.as_py())).items():
                    tokens += times
                    found = known.get(key := _key(word))
                    if found is None:
                        out.append((rid, None, None, key, times, 0, 0, 0.0, 0.0))
                    else:
                        seen += times
                        base_sum += times * found[0]
                        score += times * found[1]
                out.append((rid, own_id, held, None, 0, tokens, seen, base_sum, score))
                if len(out) > 50_000:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    found = rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", "text").mapInArrow(work, OUT)
    found = written(spark, found, "found")
    rare = found.where("key is not null").select("rid", F.col("key").alias("word_key"), "n")
    rare = rare.join(model.select("key", "c", F.col("score").alias("word_score")), F.col("word_key") == F.col("key"))
    rare = rare.groupBy("rid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * (F.log10(F.col("c") + F.lit(ADDED)) - F.lit(base))).alias("rare_base"),
        F.sum(F.col("n") * F.col("word_score")).alias("rare_score"),
    )
    whole = found.where("key is null").join(rare.withColumnRenamed("rid", "of"), F.col("rid") == F.col("of"), "left")
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0).cast("long"))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )


def op12_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return scored(spark, table(spark, folder, "documents"))
