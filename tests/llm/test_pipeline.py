"""The pipeline's stages against brute force on a small corpus."""

import random

import numpy as np
import pytest

import corpus_pipeline
from peerwatch.llm.bpe import Bpe, default_vocabulary
from peerwatch.llm.ngram_join import grams

WORDS = [f"wo{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(400)]
ITEM = "which of the seven plain answers is the right one for this question about the number 12"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(240):
        words = [rng.choice(WORDS) for _ in range(70)]
        kind = "good"
        if i % 12 == 1:
            kind, words[5], words[30], words[50] = "toxic", "nasty", "vile", "nasty"
        elif i % 12 == 2:
            kind, words = "junk", [w.upper() + "!!" for w in words]
        elif i % 40 == 3:
            kind = "leak"
            words[20:20] = ITEM.replace("12", str(i)).split()
        elif i % 40 == 5 and docs:
            kind, words = "near", docs[-5][1].split()
            words[40] = "changed"
        text = " ".join(words[:35]) + "\n" + " ".join(words[35:])
        if i % 40 == 7:
            kind, text = "copy", docs[0][1]
        docs.append((i, text, "en", "src", len(text), kind))
        if i % 4 != 3:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    docs += [(1000, None, None, None, None, "none"), (1001, "", "en", "src", 0, "none")]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, n_lines string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def similar(a, b):
    both = len(a & b)
    return both and 100 * both >= 80 * len(a | b)


def test_every_stage(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kinds = {r.doc_id: r.n_lines for r in docs.collect()}
    before = {r.doc_id: r for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "benchmark", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = corpus_pipeline.written(spark, stage(spark, docs, corpus), name)
        assert result.dtypes == docs.dtypes
        after = {r.doc_id: r for r in result.collect()}
        assert result.count() == len(after) and after.keys() <= before.keys()
        if name == "quality":
            gone = [kinds[i] for i in before.keys() - after.keys()]
            assert {"toxic", "junk", "none"} == {kinds[i] for i in kinds} - {kinds[i] for i in after}
            assert sum(k not in ("toxic", "junk", "none") for k in gone) <= 6
        elif name == "lines":
            seen, want = [], {}
            for i in sorted(before):
                left = []
                for line in before[i].text.split("\n"):
                    words = set(line.split())
                    if not any(100 * len(words & v) >= 80 * len(words | v) for v in seen):
                        left.append(line)
                    if words:
                        seen.append(words)
                if left:
                    want[i] = "\n".join(left)
            assert {i: r.text for i, r in after.items()} == want
        elif name == "near_duplicates":
            sets = {i: grams(r.text, 5) for i, r in before.items()}
            smaller = {i for i in sets if any(j < i and similar(sets[i], sets[j]) for j in sets)}
            assert before.keys() - after.keys() == smaller
        else:
            assert before.keys() - after.keys() == {i for i in before if kinds[i] == "leak"}
        docs, before = result, after
    bpe = Bpe(default_vocabulary())
    for r in corpus_pipeline.tokens(spark, docs, corpus).collect():
        assert r.ids == bpe.encode(before[r.doc_id].text) and r.n_tokens == len(r.ids) // 4 == len(np.frombuffer(r.ids, "<u4"))


def test_run_and_empty(spark, corpus, folder):
    assert corpus_pipeline.run(spark, corpus).count() > 100
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_near_duplicates_of_repeated_and_null_ids(spark):
    rng = random.Random(12)
    a, b, c, d = (" ".join(rng.choice(WORDS) for _ in range(60)) for _ in range(4))
    near = lambda text: text + " more"
    rows = [(1, a), (2, near(a)), (2, b), (3, c), (3, near(c)), (None, d), (None, near(b)), (None, near(a)), (4, ""), (4, ""), (5, d)]
    docs = spark.createDataFrame([(*r, "own", i) for i, r in enumerate(rows)], "doc_id long, text string, place_of_row string, kept int")
    result = corpus_pipeline.near_duplicates(spark, docs, "")
    assert result.dtypes == docs.dtypes and {r.place_of_row for r in result.collect()} == {"own"}
    kept = [(r.doc_id, r.text) for r in result.collect()]
    assert len(kept) == 5 and {(1, a), (2, b), (4, ""), (5, d)} <= set(kept)
    assert len({(3, c), (3, near(c))} & set(kept)) == 1


def test_a_very_long_text(spark):
    """Whole texts are compared: what differs comes after a hundred thousand words."""
    long = " ".join(f"t{i}" for i in range(100_000))
    rows = [(1, long + " end"), (2, long + " other"), (3, " ".join(f"u{i}" for i in range(100_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {1, 3}
    assert {r.doc_id for r in corpus_pipeline.lines(spark, docs, "").collect()} == {1, 3}
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.tokens(spark, docs, "").collect()}
    assert min(got.values()) > 100_000
