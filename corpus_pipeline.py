"""A training corpus from raw documents, in five stages over tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the documents of the next
stage.  All but the last return the columns of the documents they were given.

1. quality: documents that the quality classifier does not select go.
2. lines: near-duplicate lines of any length go; documents that lose their last non-blank line go with them.
3. near_duplicates: of each class of near duplicates (five-word shingles, Jaccard 0.8 or more) the smallest id stays.
4. benchmark: documents that hold a benchmark item, word for word or with other parameters, go.
5. tokens: the remaining documents as token ids, with digests of the ids and of the text decoded from them.

Null and empty texts have no words and go in the first stage; an empty table gives an empty table.  Rows that repeat an id are judged by
their own text; of equal rows one stays.  Very long texts are judged and encoded whole.  Ties (documents of one similarity class, lines that are
alike) go to the smallest id, then the smallest text hash.  Further columns, whatever their names, pass through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.llm.bpe import encode_documents
from peerwatch.llm.common import table, written
from peerwatch.llm.decontaminate import without_contaminated
from peerwatch.llm.line_dedup import clean_documents
from peerwatch.llm.ngram_join import without_near_duplicates
from peerwatch.llm.quality import selected_documents

SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return selected_documents(spark, docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Columns that have the names of the counts come back under their own names.
    aside = {c: f"documents_{c}" for c in ("n_lines", "n_removed") if c in docs.columns}
    cleaned = clean_documents(spark, docs.withColumnsRenamed(aside).withColumn("text", F.col("text").cast("string")))
    left = (F.col("n_removed") == 0) | F.rlike("text", F.lit(r"\S"))
    return cleaned.where(left).select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(spark, docs, n=SHINGLE, percent=PERCENT)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

#: The quality model is no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return docs
