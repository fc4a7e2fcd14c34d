import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from peerwatch.llm.language import Classifier, dictionaries, identify, op4_language

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")
def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    found = op4_language(spark, FOLDER).where("held_out").join(docs, "doc_id")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 250 and right >= 0.98


def test_learns_only_from_labelled_rows_not_held_out(spark):
    rows = [(i, f"{'abc' if i % 2 else 'xyz'} text {i}", None if i == 4 else ("A" if i % 2 else "X"), "s") for i in range(40)]
    docs = spark.createDataFrame([*rows, (None, "secret", "A", "s"), (50, None, "A", "s")], "doc_id long, text string, lang string, score string")
    content = dictionaries(docs)
    seen = b"\n".join(content.values()).decode()
    for i, text, lang, _ in rows:
        assert (text in seen.split("\n")) == (lang is not None and zlib.crc32(str(i).encode()) % 3 != 1)
    assert "secret" not in seen


def test_defined_results(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "12 .", "en"), (3, "ab " * 90_000, None), (3, "ab", None), (None, "ab", "x")], "doc_id long, text string, lang_pred string")
    docs = docs.withColumnRenamed("lang_pred", "lang")
    model = {"en": b"ab ab the of and ", "de": b"der die das und "}
    got = sorted(tuple(r)[:4] for r in identify(docs, model).na.fill(-1, ["doc_id"]).collect())
    assert [(g[0], g[2]) for g in got] == [(-1, "en"), (1, "und"), (2, "und"), (3, "en"), (3, "en")]
    assert got[0][1] is True and all(0 <= g[3] <= 1 for g in got)
    assert {r.lang_pred for r in identify(docs, {}).collect()} == {"und"}
    assert dictionaries(docs.limit(0)) == {} and identify(docs.limit(0), model).count() == 0
    assert Classifier({"en": b"x"}).classify("abc")[0] == "en"
