import random

import numpy as np
import pytest

from peerwatch.llm.common import classes
from peerwatch.llm.ngram_join import Bands, _Hashes, gram_hashes, grams, may_link, ngram_classes, parity, sketch_keys


def brute(rows, n=4, percent=85):
    sets = [grams(t or "", n) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = []
    for i, row in enumerate(rows):
        ids = [r[0] for j, r in enumerate(rows) if find(j) == find(i) and r[0] is not None]
        out.append((row[0], len(sets[i]), min(ids) if ids and sets[i] else row[0]))
    return sorted(map(repr, out))


def family(rng, size, edits, copies, vocabulary=400):
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(size)]
    for _ in range(copies):
        copy = base.copy()
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(size)] = f"x{rng.randrange(9999)}"
        yield " ".join(copy)


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int")
    got = sorted(repr(tuple(r)) for r in ngram_classes(spark, docs, **options).collect())
    assert got == brute(rows, **options)


def test_near_copies_of_all_sizes(spark):
    rng = random.Random(5)
    texts = [t for size in (3, 5, 8, 12, 30, 70, 200, 600) for t in family(rng, size, max(1, size // 20), 12)]
    rng.shuffle(texts)
    check(spark, [(i * 3, t, 0) for i, t in enumerate(texts)])


def test_odd_rows(spark):
    rows = [(5, None, 0), (6, "", 0), (7, " \t", 0), (8, "One two", 0), (3, "ONE\ttwo ", 0), (9, "one two three", 0), (9, "a b c d e f", 0),
            (9, "a b c d e f", 0), (None, "A b c d e f", 1), (2, "é é é é é", 1), (1, "É é é é é", 1), (4, "x " * 30_000, 1), (None, "only here", 2)]
    check(spark, rows)
    assert ngram_classes(spark, spark.createDataFrame([], "doc_id long, text string, key int, low long")).count() == 0


@pytest.mark.parametrize("percent", [85, 80])
def test_linked_sets_share_a_key(percent):
    rng, hashes, bands = random.Random(percent), _Hashes(), Bands(percent)
    linked = 0
    for i in range(600):
        size = rng.choice((4, 5, 6, 7, 9, 12, 17, 25, 40, 60, 90, 150, 300, 700))
        a, b = family(rng, size, max(1, size // 20), 2, 60 if i % 2 else 4000)
        x, y = grams(a, 4), grams(b, 4)
        if 100 * len(x & y) >= percent * len(x | y):
            linked += 1
            p, q = gram_hashes(a, 4, hashes), gram_hashes(b, 4, hashes)
            assert may_link(parity(p), len(p), parity(q), len(q), percent)
            mine, theirs = sketch_keys(p, bands), sketch_keys(q, bands)
            shared = set(mine[0].tolist()) & set(theirs[0].tolist())
            # Both share as many keys as each needs, in a band of both.
            both = [[n for k, n in zip(keys.tolist(), needs.tolist(), strict=True) if k in shared] for keys, needs in (mine, theirs)]
            assert all(any(found.count(n) >= n // 2 >= 1 for n in set(found)) for found in both)
    assert linked > 50


def test_unrelated_sets_share_few_keys():
    """Parts of two or three n-grams say as much as these: one bit for each would leave them 2016 values, or some 40,000."""
    sets, bands = np.random.default_rng(3).integers(0, 1 << 63, (2000, 40), np.uint64), Bands(85)
    keys = np.concatenate([np.unique(sketch_keys(s, bands)[0]) for s in sets])
    # But for the empty parts of sets that need them all.
    assert len(keys) > 10_000 and len(keys) - len(np.unique(keys)) < len(keys) / 200


def test_texts_with_common_passages(spark):
    """Half of a text is a passage of many: no links, but for the near copies among them."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join(passage + [f"w{rng.randrange(9999)}" for _ in range(60)]) for _ in range(40)]
    texts += [t + " end" for t in texts[:10]] + [" ".join(passage)] * 3 + [" ".join(passage[:55])]
    check(spark, [(i, t, 0) for i, t in enumerate(texts)])
    check(spark, [(i, t, 0) for i, t in enumerate(texts)], n=5, percent=80)


def test_classes(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)] + [(900, 900), (7, 7)]
    want = {}
    for i in {x for p in links for x in p if p[0] != p[1]}:
        seen, todo = {i}, [i]
        while todo:
            k = todo.pop()
            for a, b in links:
                for x, y in ((a, b), (b, a)):
                    if x == k and y not in seen:
                        seen.add(y)
                        todo.append(y)
        want[i] = min(seen)
    got = classes(spark, spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == want and got.count() == len(want)
    assert classes(spark, spark.createDataFrame([], "a long, b long")).count() == 0
