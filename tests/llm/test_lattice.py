import math
import zlib
from collections import Counter

import numpy as np
import pytest

from peerwatch.llm import lattice
from peerwatch.llm.lattice import BEGIN, Lattice, WordModel, first_scores, fitted, pieces_of, scored, vocabulary_path

SCHEMA = "doc_id long, text string, key string, n int, score string, held_out string"


@pytest.fixture(scope="module")
def pieces():
    return pieces_of(vocabulary_path())


def spellings(spelt, pieces, at=0):
    """All ways to cut the bytes into pieces, written out."""
    if at == len(spelt):
        yield []
    for end in range(at + 1, len(spelt) + 1):
        piece = spelt[at:end]
        if piece in pieces and piece.startswith(BEGIN) == (at == 0):
            for rest in spellings(spelt, pieces, end):
                yield [piece, *rest]


@pytest.mark.parametrize("word", ["a", "the", "banana", "überall", "x1", "▁", "日本", "0007"])
def test_lattice_sums_all_spellings(pieces, word):
    scores, stop = first_scores(pieces)
    own, number = Lattice(pieces, scores, stop), {p: i for i, p in enumerate(pieces)}
    ways = list(spellings(BEGIN + word.encode(), set(pieces)))
    weights = [math.prod(math.exp(scores[number[p]]) for p in way) * (1 - stop) ** (len(way) - 1) * stop for way in ways]
    assert own.log(word.encode()) == pytest.approx(math.log(sum(weights)), abs=1e-9)
    counts, want = np.zeros(len(pieces)), np.zeros(len(pieces))
    own.expect(word.encode(), counts)
    for way, weight in zip(ways, weights, strict=True):
        for p in way:
            want[number[p]] += weight / sum(weights)
    assert np.allclose(counts, want, atol=1e-9)


def test_side_by_side_is_one_by_one(pieces):
    own = Lattice(pieces, *first_scores(pieces))
    found = [w.encode() for w in "a the banana überall x1 ▁ 日本 0007 straße ▁▁▁ \x00 http://www.example.org/index.html?a=1".split(" ")]
    found += [b"y" * n for n in range(55, 70)] + [b"long" * 40, b"banana", bytes(range(128, 140))]
    assert np.allclose(own.logs(found), [own.log(w) for w in found], atol=1e-9)
    both = np.zeros(len(pieces)), np.zeros(len(pieces))
    own.expect_all(found, both[0])
    for w in found:
        own.expect(w, both[1])
    assert np.allclose(*both, atol=1e-9)


def test_words_have_a_distribution():
    """All words of up to six of two letters, over a small vocabulary: their probabilities sum to almost one."""
    pieces = [BEGIN, BEGIN + b"a", BEGIN + b"ab", b"a", b"b", b"ba"]
    own = Lattice(pieces, np.log(np.array([0.2, 0.5, 0.3, 0.4, 0.4, 0.2])), 0.7)
    level, total = [b""], 0.0
    for _ in range(9):
        total += sum(math.exp(own.log(w)) for w in level)
        level = [w + c for w in level for c in (b"a", b"b")]
    assert 0.98 < total <= 1.0


def brute(rows, pieces):
    train, distinct = Counter(), {}
    for doc_id, text in rows:
        found = (text or "").encode().lower().split()
        out = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0
        distinct.update(dict.fromkeys(found))
        if not out:
            train.update([*found, b" "])
    scores, stop = first_scores(pieces)
    known = [w for w in train if w != b" "]
    for _ in range(lattice.ROUNDS if known else 0):
        expected, own = np.zeros(len(pieces)), Lattice(pieces, scores, stop)
        for w in known:
            own.expect(w, expected)
        weight = expected + lattice.PIECE_COUNT
        begins = np.array([p.startswith(BEGIN) for p in pieces])
        scores = np.where(begins, np.log(weight / weight[begins].sum()), np.log(weight / weight[~begins].sum()))
        stop = min(0.999, len(known) / expected.sum())
    own, n, v = Lattice(pieces, scores, stop), sum(train.values()), len(train)
    once, twice = sum(c == 1 for c in train.values()), sum(c == 2 for c in train.values())
    d = max(0.1, once / (once + 2 * twice)) if once else 0.5
    spelt = {w: math.exp(own.log(w)) * (d * v / n if n else 0.5) for w in distinct}
    score = lambda w: math.log10(spelt[w] + ((train[w] - d) / n if train[w] else 0.0))
    end = math.log10((train[b" "] - d) / n) if n else math.log10(0.5)
    base = lambda w: math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1)))
    out = []
    for doc_id, text in rows:
        found = (text or "").encode().lower().split()
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0
        tokens = [*found, b" "]
        out.append((doc_id, held, len(tokens), sum(train[w] > 0 for w in tokens), n, sum(map(base, tokens)), sum(map(score, found)) + end))
    return out


def rows_of():
    plain = [(i, f"the cat {'sat' * (i % 3)} on mat number {i % 7} THE end" + " deep" * (i % 4)) for i in range(60)]
    odd = [(100, None), (101, ""), (102, " \t\r\n "), (None, "no id word"), (7, "twin id"), (7, "twin id"), (103, "É Ö ß ▁ \x00 日本語"), (104, "x" * 900 + " " + "long" * 30)]
    held = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 10 == 0]
    return [*plain, *odd, *((i, f"unseen words the {i} cat") for i in held), (held[0], "")]


@pytest.mark.parametrize("common", [200_000, 20])
def test_against_brute_force(spark, pieces, monkeypatch, common):
    monkeypatch.setattr(lattice, "COMMON", common)
    rows = rows_of()
    got = scored(spark, spark.createDataFrame([(*r, "k", 1, "s", "h") for r in rows], SCHEMA).repartition(3)).collect()
    got, want = (sorted(map(tuple, x), key=lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))) for x in (got, brute(rows, pieces)))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], atol=1e-6)


def test_nothing_to_train_on(spark, pieces):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(held, "some words"), (held, None)]
    got = scored(spark, spark.createDataFrame([(*r, "k", 1, "s", "h") for r in rows], SCHEMA)).collect()
    want = brute(rows, pieces)
    assert sorted(r.n_known for r in got) == [0, 0] and {r.base_score for r in got} == {0.0}
    assert np.allclose(sorted(r.score for r in got), sorted(r[6] for r in want), atol=1e-9)


def test_empty(spark):
    got = scored(spark, spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_fitting_raises_the_likelihood(spark, pieces):
    found = sorted({w for i in range(400) for w in f"prefix{i % 20} undo{i}ing the{i % 9}ology {i}".encode().split()})
    rows = spark.createDataFrame([(w,) for w in found], "word binary")
    likelihood = []
    for rounds in range(4):
        own = Lattice(pieces, *fitted(rows, pieces, rounds=rounds))
        likelihood.append(sum(map(own.log, found)))
    assert likelihood == sorted(likelihood) and likelihood[1] > 0.8 * likelihood[0]


def test_counted_words_and_spellings_share_one(pieces):
    own = WordModel(10, 4, 2, 1, Lattice(pieces, *first_scores(pieces)))
    assert sum(own.counted(c) for c in (1, 1, 2, 6)) + math.exp(own.spelt) == pytest.approx(1.0)
