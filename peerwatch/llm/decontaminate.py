"""Operator 7: benchmark decontamination by templates.

Texts are made into templates: numbers, units and names become typed placeholders, other words are lower-cased and lose their
punctuation.  In a second form every capitalised word is a name, also
where a sentence or line begins, and names in a row are one placeholder.  Windows of ``WINDOW`` template words of documents and items are joined by their hash, and equal ones are kept.
Along one alignment of a document with an item every value that a placeholder stands for in the item must have one value in the document
(the slots are consistent): then the item is in the document, word for word or with other parameters.  A pair counts when at
least ``SHARE`` of the item's windows are found so, in either form, or when ``QUOTED`` words in a row are the item's own, placeholders included.

Scale: documents are read once, without a shuffle; a task splits a text once, numbers its words, and hashes the windows of many texts at a time.  Windows that cannot be in
the benchmark are dropped in the task by a bit table with three places for a window, 64 bits for each window of the benchmark up to ``MOST_BITS`` (a larger benchmark makes it let more
pass, never fewer).  What is left is joined by hash; Spark splits the
windows of a passage that many documents share, and all further groups are one document and one item.

Defined results: a null or empty text has no windows; items of fewer than ``WINDOW`` words are one window of their own length, and
items of fewer than ``LITERALS`` plain words can never match; a very long text is like any other; rows that repeat an id are judged by their own text; items with one
id are one item; an empty table finds nothing; other columns, also with the names used here, are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerwatch.llm.common import removed, table, text_of, written
from peerwatch.llm.ngram_join import _mixed

WINDOW, LITERALS, SHARE, QUOTED = 8, 4, 0.5, 13
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
SEEN_WORDS = 500_000
#: Shifts of a hash to its places in the bit table.
PROBES = (0, 20, 37)
#: Words that are worked on at a time.
AT_ONCE = 100_000
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"

#: Fixed values.
UNITS = frozenset(
    "mm cm m km mg g kg t ml l s sec min h hr hrs hour hours minute minutes second seconds day days week weeks month months year years "
    "meter meters metre metres mile miles foot feet inch inches gram grams kilogram kilograms liter liters litre litres "
    "dollar dollars euro euros cent cents percent degree degrees watt watts volt volts kwh mph kmh".split()
)
_EDGES = ".,;:!?()[]{}\"'“”‘’«»…"
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
_MEASURE = re.compile(r"([+-]?\d[\d.,]*)([A-Za-z]+)")


def _kind(word: str) -> tuple:
    """(template words, slot values, capital, ends a sentence) of a word."""
    inner = word.strip(_EDGES)
    low = inner.lower()
    figures = not inner.isalpha()
    if figures and _NUMBER.fullmatch(inner):
        found = (NUMBER,), (inner,), False
    elif figures and (m := _MEASURE.fullmatch(inner)) and m[2].lower() in UNITS:
        found = (NUMBER, UNIT), (m[1], m[2].lower()), False
    elif low in UNITS:
        found = (UNIT,), (low,), False
    else:
        found = (low,) if low else (), (None,) if low else (), inner[:1].isupper() and inner[1:].islower()
    return *found, word.rstrip("\"')]”’»")[-1:] in tuple(".!?:")


class _Kinds(dict):
    """The kinds of the words met."""

    def __missing__(self, word):
        if len(self) >= SEEN_WORDS:
            self.clear()
        value = self[word] = _kind(word)
        return value


def template(text: str, kinds: _Kinds) -> tuple[list[str], list[str | None]]:
    """Template words and, where one is a placeholder, the value it stands for."""
    words, values, starts = [], [], True
    for line in text.splitlines():
        starts = True
        for word in line.split():
            template_words, slot, capital, ends = kinds[word]
            if capital and not starts:
                template_words, slot = (NAME,), (template_words[0],)
            words += template_words
            values += slot
            starts = ends or (starts and not template_words)
    return words, values


def name_template(text: str, kinds: _Kinds) -> tuple[list[str], list[str | None]]:
    """The same with every capitalised word as a name, wherever it stands; names in a row are one placeholder."""
    words, values = [], []
    for word in text.split():
        template_words, slot, _, _ = kinds[word]
        if not _any_name(word, slot):
            words += template_words
            values += slot
        elif words and words[-1] == NAME:
            values[-1] += " " + template_words[0]
        else:
            words.append(NAME)
            values.append(template_words[0])
    return words, values


def _any_name(word: str, slot: tuple) -> bool:
    return slot == (None,) and word.strip(_EDGES)[:1].isupper()


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))


SLOTS = np.array([_hash(w) for w in (NUMBER, UNIT, NAME)], np.uint64)


class _Numbers(dict):
    """A number for every word met, and what the number stands for: its template words (two at most), and its part in either form."""

    def __init__(self, kinds: _Kinds):
        super().__init__()
        self.kinds = kinds
        self.rows: list[tuple[int, int, int, bool, bool, bool]] = []
        self.table = np.zeros((0, 6), np.uint64)

    def __missing__(self, word):
        number = self[word] = len(self.rows)
        if word.isalpha() and word.islower() and word not in UNITS:
            self.rows.append((1, _hash(word), 0, 0, 0, 0))
        else:
            template_words, slot, capital, ends = _kind(word)
            hashes = [*map(_hash, template_words), 0, 0]
            self.rows.append((len(template_words), hashes[0], hashes[1], capital, ends, _any_name(word, slot)))
        return number

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words, table by number)."""
        if len(self) > SEEN_WORDS:
            self.clear()
            self.rows, self.table = [], self.table[:0]
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if len(self.rows) > len(self.table):
            self.table = np.concatenate([self.table, np.array(self.rows[len(self.table) :], np.uint64)])
        return numbers, self.table


def template_codes(texts: list[str], numbers: _Numbers) -> list[tuple[np.ndarray, np.ndarray]]:
    """For both forms the hashes of the template words of all texts, and the text that each belongs to."""
    words, lines, of_line = [], [], []
    for i, text in enumerate(texts):
        for line in text.splitlines():
            before = len(words)
            words += line.split()
            lines.append(len(words) - before)
            of_line.append(i)
    if not words:
        return [(np.empty(0, np.uint64), np.empty(0, np.int64))] * 2
    number, table = numbers.of(words)
    line = np.repeat(np.arange(len(lines)), lines)
    text = np.array(of_line, np.int64)[line]
    row = table[number]
    parts, capital, ends, any_name = row[:, 0].astype(np.int64), row[:, 3] != 0, row[:, 4] != 0, row[:, 5] != 0
    # A word begins a sentence if its line begins, or one ended since the last word that is more than punctuation.
    place = np.arange(len(words))
    last = np.maximum.accumulate(np.where(parts > 0, place, -1))
    last = np.concatenate(([-1], last[:-1]))
    ended = np.concatenate(([0], np.cumsum(ends)))
    starts = (last < 0) | (line[last] != line) | (ended[place] > ended[np.maximum(last, 0)])
    out = []
    for name in (capital & ~starts, any_name):
        count = np.where(name, 1, parts)
        codes = np.repeat(np.where(name, SLOTS[2], row[:, 1]), count)
        second = np.cumsum(count)[count == 2] - 1
        codes[second] = row[count == 2, 2]
        out.append((codes, np.repeat(text, count)))
    # In the second form names in a row are one.
    codes, text = out[1]
    name = codes == SLOTS[2]
    keep = ~(name & np.concatenate(([False], name[:-1])) & np.concatenate(([False], text[1:] == text[:-1])))
    out[1] = codes[keep], text[keep]
    return out


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate(([np.uint64(1)], np.cumprod(np.full(max(0, n - 1), base, np.uint64))))[:n]


def window_hashes(codes: np.ndarray, text: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For every size a hash of the window at each place; 0 where it leaves its text or has too few plain words."""
    n = len(codes)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(codes * _powers(_BASE, n))))
    back = _powers(_INVERSE, n)
    slots = np.concatenate(([0], np.cumsum(np.isin(codes, SLOTS))))
    for size in sizes:
        if n < size:
            yield size, np.zeros(n, np.uint64)
            continue
        m = n - size + 1
        whole = (text[size - 1 :] == text[:m]) & (size - (slots[size:] - slots[:-size]) >= LITERALS)
        hashed = _mixed((sums[size:] - sums[:-size]) * back[:m] + np.uint64(size)) | np.uint64(1)
        yield size, np.concatenate((np.where(whole, hashed, np.uint64(0)), np.zeros(size - 1, np.uint64)))


WINDOWS = "id long, twin long, form int, pos int, hash long, words string, slots array<string>"


def _windows(rows: DataFrame, sizes: list[int] | None, bits: np.ndarray | None) -> DataFrame:
    """Windows of rows (id, twin, text) in both forms of template: 0 for ``template``, 1 for ``name_template``.

    ``sizes`` None: of one size, the text's own if it is shorter.  With ``bits``, only those that the bit table lets pass.
    """

    def found(ids: list, twins: list, texts: list[str], numbers: _Numbers) -> list[tuple]:
        out = []
        for form, (codes, text) in enumerate(template_codes(texts, numbers)):
            first = np.searchsorted(text, np.arange(len(texts)))
            made: dict[int, tuple] = {}
            for size, hashed in window_hashes(codes, text, sizes or [min(WINDOW, max(1, len(codes)))]):
                keep = hashed != 0
                hashed = hashed ^ np.uint64(form << 40)
                places = np.flatnonzero(keep)
                for k in PROBES if bits is not None else ():
                    at = (hashed[places] >> np.uint64(k)) & np.uint64(64 * len(bits) - 1)
                    places = places[(bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
                for place in places.tolist():
                    i = int(text[place])
                    if i not in made:
                        made[i] = (template, name_template)[form](texts[i], numbers.kinds)
                    pos = place - int(first[i])
                    words, values = (x[pos : pos + size] for x in made[i])
                    number = int(hashed[place : place + 1].view(np.int64)[0])
                    out.append((ids[i], twins[i], form, pos, number, " ".join(words), [v for v in values if v is not None]))
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(_Kinds())
        for batch in batches:
            ids, twins, texts, size = [], [], [], 0
            for row_id, twin, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids.append(row_id)
                twins.append(twin)
                texts.append(value.as_py())
                size += len(texts[-1])
                # An item has a size of its own.
                if size > 6 * AT_ONCE or sizes is None:
                    yield _batch(found(ids, twins, texts, numbers))
                    ids, twins, texts, size = [], [], [], 0
            if texts:
                yield _batch(found(ids, twins, texts, numbers))

    return rows.mapInArrow(work, WINDOWS)


def _batch(rows) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string())]
    names = ["id", "twin", "form", "pos", "hash", "words", "slots"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def twin(docs: DataFrame):
    """What tells rows with one id apart: a hash of the text."""
    return F.xxhash64(text_of(docs))


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, share: float = SHARE) -> DataFrame:
    """(doc_id, twin, item_id, windows, found, exact) for every item in a document."""
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.lit(0).cast("long").alias("twin"), text_of(benchmark).alias("text")).where("id is not null")
    items = written(spark, _windows(items, None, None).distinct(), "items")
    n_bits = min(MOST_BITS, max(LEAST_BITS, 1 << (64 * items.count()).bit_length()))
    places = F.array(*(F.shiftrightunsigned("hash", k).bitwiseAND(F.lit(n_bits - 1).cast("long")) for k in PROBES))
    table_bits = items.select(F.explode(places).alias("place")).select(F.expr("place div 64").alias("at"), F.expr("shiftleft(1L, cast(place % 64 as int))").alias("bit"))
    set_bits = table_bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(n_bits // 64, np.uint64)
    bits[set_bits["at"].to_numpy()] = set_bits["bits"].to_numpy().view(np.uint64)
    sizes = sorted({r.n for r in items.select(F.size(F.split("words", " ")).alias("n")).distinct().collect()})
    totals = items.groupBy(F.col("id").alias("item_id"), "form").agg(F.count_distinct("pos").alias("windows"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), twin(docs).alias("twin"), text_of(docs).alias("text"))
    found = _windows(rows, sizes or [WINDOW], bits)
    mine = items.select(F.col("id").alias("item_id"), "form", F.col("pos").alias("item_pos"), "hash", F.col("words").alias("item_words"), F.col("slots").alias("item_slots"))
    met = found.join(mine, ["hash", "form"]).where("words = item_words")
    met = met.select("id", "twin", "item_id", "form", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), "item_slots", "slots")
    met = written(spark, met, "met")
    pair = ["id", "twin", "item_id", "form"]
    # An alignment is out if one value of the item stands for two in the document.
    slots = met.where(F.size("slots") > 0).select(*pair, "shift", F.explode(F.arrays_zip("item_slots", "slots")).alias("s"))
    # Of names in a row the last one is compared: the first may be any word that begins a sentence.
    last = lambda c: F.substring_index(c, " ", -1)
    torn = slots.groupBy(*pair, "shift", last("s.item_slots").alias("value"))
    torn = torn.agg((F.min(last("s.slots")) != F.max(last("s.slots"))).alias("torn"))
    torn = torn.where("torn").select(*pair, "shift").distinct()
    same = lambda a, b, keys: F.expr(" and ".join(f"{a}.{k} <=> {b}.{k}" for k in keys))
    whole = met.alias("m").join(torn.alias("t"), same("m", "t", [*pair, "shift"]), "left_anti")
    mine_too = F.col("item_slots") == F.col("slots")
    # Windows in a row that are the item's own in every value: a row for each alignment and run.
    rows_in = Window.partitionBy(*pair, "shift").orderBy("item_pos")
    runs = whole.where(mine_too).select(*pair, "shift", "item_pos").distinct()
    runs = runs.withColumn("run", F.col("item_pos") - F.row_number().over(rows_in)).groupBy(*pair, "shift", "run").agg(F.count("*").alias("n"))
    quoted = runs.groupBy(*pair).agg(F.max("n").alias("quoted"))
    whole = whole.groupBy(*pair).agg(F.count_distinct("item_pos").alias("found"), F.bool_and(mine_too).alias("exact"))
    whole = whole.alias("w").join(quoted.alias("q"), same("w", "q", pair), "left").select("w.*", "quoted")
    enough = (F.col("found") >= F.lit(share) * F.col("windows")) | (F.col("quoted") >= QUOTED - WINDOW + 1)
    out = whole.join(totals, ["item_id", "form"]).where(enough)
    # Where both forms tell, the stricter one counts.
    out = out.groupBy("id", "twin", "item_id").agg(F.min(F.struct("form", "windows", "found", "exact")).alias("o"))
    out = written(spark, out, "pairs")
    removed(spark, met, items)
    return out.select(F.col("id").alias("doc_id"), "twin", "item_id", "o.windows", "o.found", "o.exact")


def without_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    bad = written(spark, contaminated(spark, docs, benchmark).select("doc_id", "twin").distinct(), "contaminated")
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("twin").alias("bad_twin"))
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["bad_id"]) & (twin(docs) == bad["bad_twin"]), "left_anti")


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, item_id, windows, found, exact) for every item in a document."""
    return contaminated(spark, table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("twin")
