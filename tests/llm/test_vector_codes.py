import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from peerwatch.llm.vector_codes import Codebook, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int, cell long"


def nearest(part, book):
    return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), i) for i, entry in enumerate(book))


def brute(rows, rounds=4):
    kept = []
    for r in rows:
        if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]):
            kept.append((r[0], [math.floor(1024 * float(np.float32(x))) for x in r[1]], r[2]))
    dim = max(4, -(-max((len(v) for _, v, _ in kept), default=0) // 4) * 4)
    kept = [(i, v + [0] * (dim - len(v)), label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = dim // 4
    books = [[v[p * w : (p + 1) * w] for _, v, _ in kept[:256]] for p in range(4)]
    for _ in range(rounds):
        for p in range(4):
            groups = defaultdict(list)
            for _, v, _ in kept:
                part = v[p * w : (p + 1) * w]
                groups[nearest(part, books[p])[1]].append(part)
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for i, v, label in kept:
        found = [nearest(v[p * w : (p + 1) * w], books[p]) for p in range(4)]
        error = sum(d for d, _ in found)
        by_label[label] += error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    return [(i, code, min(error, 2**63 - 1), min(by_label[label], 2**63 - 1), sha) for i, code, error, label in out]


def tables():
    rnd = random.Random(5)
    centres = [[rnd.uniform(-1, 1) for _ in range(8)] for _ in range(12)]
    many = [(i * 3 % 1009, [c + rnd.gauss(0, 0.1) for c in centres[i % 12]], i % 5 or None) for i in range(700)]
    same = [(2000 + i, [0.25] * 8, 1) for i in range(300)]
    nan, inf = float("nan"), float("inf")
    odd = [
        (1, None, 1), (2, [0.5, None, 1.0, 1.0], 1), (3, [nan, 1.0, 1.0, 1.0], 1), (4, [inf, 0.0, 0.0, 0.0], 1), (5, [], None), (6, [0.1, -0.2, 0.3], None),
        (7, [0.1, -0.2, 0.3, 0.4, 0.5], 2), (None, [1.0, 2.0, 3.0, 4.0], 2), (8, [1.0, 2.0], 3), (8, [1.0, 2.0], 3), (8, [0.0, 2.0], 3), (9, [-inf], 3),
    ]
    large = [(i, [3e38 * (-1) ** i, 1e30 * i, 1.5, -2e9], 1) for i in range(9)]
    return {"many": many + same, "odd": odd, "large": large, "mixed": many + large, "one": [(4, [0.5, 0.25, 1.0, -1.0], 0)]}


@pytest.mark.parametrize("name", list(tables()))
def test_against_brute_force(spark, name):
    rows = tables()[name]
    got = vector_codes(spark, spark.createDataFrame([(*r, "c", 1, 2) for r in rows], SCHEMA).repartition(3))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows)))


def test_empty(spark):
    got = vector_codes(spark, spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("seed", range(6))
def test_search_is_exact_and_measures_less(seed, monkeypatch):
    """Small grids give many ties and equal entries; clustered parts need only a part of the distances."""
    rnd = np.random.default_rng(seed)
    size = [1, 7, 16, 40, 256, 256][seed]
    centres = rnd.integers(-900, 900, (30, 3)) if seed % 2 else rnd.integers(0, 3, (30, 3))
    spread = 20 if seed % 2 else 1
    entries = centres[rnd.integers(0, 30, size)] + rnd.integers(0, spread, (size, 3))
    parts = centres[rnd.integers(0, 30, 500)] + rnd.integers(0, spread, (500, 3))
    book, measured = Codebook(entries), []
    whole = Codebook.distances
    monkeypatch.setattr(Codebook, "distances", staticmethod(lambda x, y: (measured.append(len(x)), whole(x, y))[1]))
    at, away = book.nearest(parts)
    want = ((parts[:, None] - entries[None]) ** 2).sum(-1)
    assert (at == want.argmin(1)).all() and (away == want.min(1)).all()
    assert sum(measured) <= 500 * size
    if seed == 5:
        assert sum(measured) < 500 * size / 2
