"""Operator 4: language identification by compression.

For each language a zstandard dictionary of raw content is made from a bounded sample of labelled text.  A text is
compressed, as a whole and in lower case, once with each dictionary, in small chunks, so that it is the dictionary that
is matched and not the text itself; the language whose dictionary gives the fewest bytes is its language.  ``score`` is how much smaller that is than the second best, and a
margin below ``narrow`` sets ``rejected``.

Scale: the sample is at most about ``SAMPLE`` pieces of ``PIECE`` characters for each language, picked by a hash of the
id (documented bound; the only thing that comes to the driver).  All rows are then classified without a shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any labelled row everything is
``und``; documents held out, or without id or language, are never learned from; a document without id counts as held
out; ties go to the language with more labelled rows, then to the
first in the alphabet; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.llm.common import table

SAMPLE, PIECE = 600, 400
DICTIONARY_BYTES = 112 * 1024
CHUNK_BYTES = 400
LEVEL = 5
NARROW = 0.01
UNKNOWN = "und"
SPACE = 1 << 20

_LETTER = regex.compile(r"\p{L}")


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def dictionaries(docs: DataFrame, *, sample: int = SAMPLE, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw content for each language, from labelled rows that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("t"), F.col("lang").cast("string").alias("l"))
    rows = rows.where(~is_held_out(F.col("id")) & F.col("l").isNotNull() & F.col("t").isNotNull())
    counts = {r.l: r["count"] for r in rows.groupBy("l").count().collect()}
    if not counts:
        return {}
    place = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(SPACE))
    share = F.element_at(F.create_map(*(F.lit(x) for l, n in counts.items() for x in (l, min(SPACE, SPACE * sample // n + 1)))), F.col("l"))
    # A piece from somewhere in the text, so that openings do not weigh more than the rest.
    start = 1 + F.pmod(F.xxhash64("id", F.lit("piece")), F.greatest(F.lit(1), F.length("t") - PIECE + 1))
    picked = rows.where(place < share).select("l", place.alias("p"), "id", F.substring("t", start.cast("int"), F.lit(PIECE)).alias("t"))
    pieces: dict[str, list] = {}
    for r in picked.collect():
        pieces.setdefault(r.l, []).append((r.p, r.id, r.t))
    usual_first = sorted(pieces, key=lambda l: (-counts[l], l))
    return {l: "\n".join(t.lower() for _, _, t in sorted(pieces[l])).encode()[:size] for l in usual_first}


class Classifier:
    def __init__(self, content: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.languages = list(content)
        self.compressors = []
        for language in self.languages:
            known = zstandard.ZstdCompressionDict(content[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=level)
            made = zstandard.ZstdCompressor(dict_data=known, level=level, write_checksum=False, write_content_size=False, write_dict_id=False)
            self.compressors.append(made)

    def classify(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        raw = text.lower().encode("utf-8", "replace")
        chunks = [raw[i : i + CHUNK_BYTES] for i in range(0, len(raw), CHUNK_BYTES)]
        sizes = [sum(len(c.compress(chunk)) for chunk in chunks) for c in self.compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min((s for i, s in enumerate(sizes) if i != best), default=len(raw) + sizes[best])
        return self.languages[best], max(0.0, 1.0 - sizes[best] / second)


def identify(docs: DataFrame, content: dict[str, bytes], *, narrow: float = NARROW) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(content)
        for batch in batches:
            found = [model.classify(value.as_py()) for value in batch.column(2)]
            columns = [
                batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()), pa.array([f[1] < narrow for f in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), is_held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return identify(docs, dictionaries(docs))
