import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from peerwatch.llm.quality import BUCKETS, REST, TARGET, Scorer, _Words, bands, evidence, features, fit, gumbel, kth_largest, model_of, resample, selected_documents, tilt

GOOD = [f"word{i}" for i in range(300)]


def corpus():
    rng, docs, labels = random.Random(2), [], []
    for i in range(300):
        words = [rng.choice(GOOD) for _ in range(60)]
        kind = rng.choice("ggggtj")
        if kind == "t":
            for _ in range(5):
                words[rng.randrange(60)] = rng.choice(("nasty", "vile"))
        if kind == "j":
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words), kind, 1))
        if i % 3:
            labels.append((i, int(kind != "j"), int(kind == "t"), "x"))
    docs += [(900, None, "n", 1), (901, " ", "n", 1), (None, "word1 word2", "g", 1), (902, docs[0][1], docs[0][2], 1), (902, docs[0][1], docs[0][2], 1)]
    labels += [(None, 1, 0, "x"), (77777, 1, 0, "x"), (1, None, 0, "x")]
    return docs, labels


def test_selects_the_good_ones(spark):
    rows, labelled = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, key int")
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int, text string")
    got = resample(spark, docs, labels).collect()
    model = fit(spark, docs, labels)
    scorer = Scorer(model)
    weights = sorted((r[0] is None, r[0] or 0, scorer.log_weight(r[1] or "")) for r in rows if (r[1] or "").split())
    assert weights == sorted((r.doc_id is None, r.doc_id or 0, r.log_weight) for r in got if r.log_weight is not None)
    # Brute force: as many as have a weight of at least zero, with the largest keys.
    k = sum(w[2] >= 0 for w in weights)
    order = sorted(((w[2] + 0.25 * gumbel(None if w[0] else w[1], 17), not w[0], -w[1]) for w in weights), reverse=True)
    want = sorted(((not o[1]), -o[2]) for o in order[:k])
    chosen = sorted((r.doc_id is None, r.doc_id or 0) for r in got if r.selected)
    assert chosen == want or set(chosen) == set(want)  # rows that repeat an id go together
    kinds = {r[0]: r[2] for r in rows}
    assert sum(kinds[r.doc_id] != "g" for r in got if r.selected) == 0
    assert sum(kinds[r.doc_id] == "g" for r in got if not r.selected) < 5
    kept = selected_documents(spark, docs, labels)
    assert kept.columns == docs.columns and sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == chosen


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in resample(spark, docs, labels).collect() if r.selected} == {1, 3}
    assert resample(spark, docs.limit(0), labels).count() == 0 and selected_documents(spark, docs.limit(0), labels).count() == 0


def test_kth_largest(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 20_000, 7.0).otherwise(F.col("id") / 3).alias("x"))
    values = sorted((r.x for r in df.collect()), reverse=True)
    for k in (1, 2, 5_000, 10_000, 10_001, 25_000, 30_000):
        value, among = kth_largest(df, "x", k)
        assert value == values[k - 1] and among == k - sum(v > value for v in values)


def test_fit_is_a_count_of_all_documents(spark):
    """The model from counts made text by text: all documents are in the raw model, near copies once in each."""
    rows, labelled = corpus()
    rows += [(1000 + i, rows[3][1] + f" own{i}", "g", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, key int")
    marks = {(r.doc_id, r.text): r.mark for r in docs.selectExpr("doc_id", "text", "xxhash64(doc_id, coalesce(text, '')) as mark").collect()}
    seen, grams = _Words(), {}
    for r in rows:
        if (r[1] or "").split():
            grams[r[0], r[1]] = features(r[1], seen)
    least = {}
    for d, found in grams.items():
        for place in enumerate(bands(found)):
            least[place] = min(least.get(place, marks[d]), marks[d])
    firsts = [d for d, found in grams.items() if all(least[p] == marks[d] for p in enumerate(bands(found)))]
    assert len(firsts) < len(grams) - 29
    kind = {i: TARGET if (q, t) == (1, 0) else f"raw{q}-{t}" for i, q, t, _ in labelled if None not in (i, q, t)}
    learned, known = defaultdict(list), set()
    of_label = sorted((d for d in grams if d[0] in kind), key=lambda d: d[0])
    for d in of_label:
        places = set(enumerate(bands(grams[d])))
        if not places & known:
            learned[kind[d[0]]].append(d)
        known |= places

    def counted(which):
        n, x = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
        for d in which:
            for b in grams[d]:
                n[b] += 1
                x[b] ^= marks[d]
            n[BUCKETS] += 1
        return n, x

    counts = {k: counted(v)[0] for k, v in learned.items()} | {REST: counted(firsts)[0]}
    want = model_of(counts, counted(firsts)[1], Counter(kind[d[0]] for d in of_label))
    got = fit(spark, docs, spark.createDataFrame(labelled, "doc_id long, quality int, toxic int, text string"))
    assert got["odds"] == want["odds"] and np.array_equal(got["shares"], want["shares"])
    assert np.array_equal(got["tilts"], want["tilts"])


def test_every_bucket_weighs_by_its_counts():
    n = np.arange(1, 40)
    got = tilt(np.zeros(39, int), 1000, n, 1000)
    assert (got > 0).all() and (np.diff(got) > 0).all()
    for t, r in ((3, 9), (9, 3), (40, 40), (0, 1)):
        g = 2 * sum(k * math.log(k / (100 * (t + r) / 400) / f) if k else 0 for k, f in ((t, 1), (r, 3)))
        log = math.log((r + 1) / (300 * (t + r) / 400 + 1)) - math.log((t + 1) / (100 * (t + r) / 400 + 1))
        assert abs(tilt(np.array([t]), 100, np.array([r]), 300)[0] - log * g**3 / (g**3 + 25.0**3)) < 1e-9


def test_ngrams_of_the_same_documents_are_one():
    n, marks = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    n[[5, 6, 7, 8]], marks[[5, 6, 7, 8]] = (2, 2, 2, 3), (11, 11, 12, 11)
    assert evidence(n, marks)[[5, 6, 7, 8, 9]].tolist() == [0.25, 0.25, 0.5, 0.5, 1.0]


def test_bands_tell_near_copies():
    rng, seen = random.Random(4), _Words()
    words = [f"w{i}" for i in range(2000)]
    text = [rng.choice(words) for _ in range(400)]
    near = [w if i % 100 else "other" for i, w in enumerate(text)]
    far = [rng.choice(words) for _ in range(400)]
    a, b, c = (set(enumerate(bands(features(" ".join(t), seen)))) for t in (text, near, far))
    assert a & b and not a & c and len(a) == 4


def test_labels_at_work(spark):
    """Toxic and junk texts go in every language, held-out ones too; good ones stay."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    learn = F.col("doc_id") % 2 == 0
    got = resample(spark, docs, labels.where(learn)).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    kept = defaultdict(lambda: [0, 0])
    for r in got.collect():
        what = "good" if (r.quality, r.toxic) == (1, 0) else "toxic" if r.toxic else "junk"
        for key in ((what, r.doc_id % 2), (what, r.doc_id % 2, r.lang)):
            kept[key][0] += r.selected
            kept[key][1] += 1
    share = {k: n / m for k, (n, m) in kept.items()}
    print({k: tuple(v) for k, v in sorted(kept.items(), key=str)})
    assert share["good", 0] > 0.95 and share["good", 1] > 0.95
    assert share["junk", 0] < 0.05 and share["junk", 1] < 0.05
    assert share["toxic", 0] < 0.05 and share["toxic", 1] < 0.06
    assert all(share["toxic", 1, lang] < 0.1 for lang in ("en", "de", "fr"))


def test_very_long_and_odd_texts(spark):
    long = " ".join(f"t{i}" for i in range(100_000))
    rows = [(1, long, 5, "x"), (2, "!!! ... ((", 5, "x"), (3, "a " * 50_000, 5, "x"), (4, "\ud7ff\u00df 9x", 5, "x"), (4, None, 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark int, c0 string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = resample(spark, docs, labels)
    assert got.count() == 5 and got.where("log_weight is null and not selected").count() == 1
    kept = selected_documents(spark, docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.where("selected").count()
    assert {(r.mark, r.c0) for r in kept.collect()} == {(5, "x")}


def test_first_of_copies_by_arrays():
    """The rows kept are those that share no band with a former one, kept or not, and no Python object is made per band."""
    import random
    import tracemalloc

    import pyarrow as pa

    from peerwatch.llm.quality import BANDS, first_of_copies

    def table(n, values, ids):
        draw = random.Random(5)
        rows = [(draw.randrange(ids), draw.randrange(1 << 40), kind, [draw.randrange(values) for _ in range(BANDS)]) for kind in ("raw0-0", "good") for _ in range(n)]
        rows = list({(r[0], r[2]): r for r in rows}.values())
        return rows, pa.table([pa.array(c) for c in zip(*rows)], ["doc_id", "mark", "kind", "bands"])

    for values in (1, 300, 1 << 40):
        rows, arrow = table(200, values, 150)
        known, kept = set(), []
        for doc_id, mark, kind, bands in sorted(rows, key=lambda r: (r[0], r[2])):
            places = set(enumerate(bands))
            if known.isdisjoint(places):
                kept.append((doc_id, mark, kind))
            known |= places
        assert [tuple(r.values()) for r in first_of_copies(arrow).to_pylist()] == kept
    assert first_of_copies(arrow.slice(0, 0)).num_rows == 0
    _, arrow = table(20_000, 1 << 40, 1 << 40)
    tracemalloc.start()
    first_of_copies(arrow)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40_000 * BANDS * 32
