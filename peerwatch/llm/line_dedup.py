"""Operator 2: near-duplicate lines by an exact set-similarity join; DataFrame functions only.

The set of a line is its distinct words; lines of fewer than ``least`` distinct words are left alone (by default only blank ones).  A line is
removed if an earlier line (smaller doc_id, then smaller line number) has a Jaccard similarity of at least ``percent``.

Lines with equal sets are found by a 128-bit name made of their sorted words.  The first line of each set goes into the join: its words are
ordered by rarity (counts of all words of the corpus, in a table of fixed size: quarters of the binary logarithm, ties by hash), and only the
prefix that a similar line must touch is joined.  A pair that meets at a word has to pass the length filter, the positional filter (what can
still be common after this word) and a parity sketch (64 bits, of lines of more than 64 words 128, whose Hamming distance is at most the symmetric difference); what is left is
verified on the words themselves.

Scale: a prefix is about a fifth of a line, and its rows are shuffled once, by word.  There a line is compared with those of no larger sets that
have the word in the first half of their prefixes, at a word that is not rare only with those in its band of sizes, if at most ``NEAR`` stand in
it; in a fuller band lines are first compared with the earliest one alone, which removes the many variants of one line without their pairs, and
only lines that are left are compared with all others.  Of the lines that a line may be similar to the earliest is verified first, and the
others only if that fails.  Equal lines, however many, are one line in the join.  Documents without a
removed line are not shuffled again (a bit table of fixed size tells them).  Every step's table goes when the next ones are written, and
the shuffle files of a step with it.

Defined results: a null text counts as empty and has no lines; blank lines and those below ``least`` stay as they are; a very long line is a set
like any other; of rows that repeat an id, or have none, those with the smaller text hash come first, null ids last; rows equal in id and text
are one row in this order, and lose the same lines; an empty table gives an empty one; other columns, also with the names used here, are not
touched.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerwatch.llm.common import constant, in_bit_table, removed, table, text_of, written

LEAST_WORDS = 1
PERCENT = 80
#: Buckets of the counts of words, a power of two.
BUCKETS = 1 << 20
#: Words of 64 bits of a sketch; lines of up to ``SHORT`` words use the first alone.
WIDE, SHORT = 2, 64
SKETCH = tuple(f"q{k}" for k in range(WIDE))
#: The class of words that occur once in all.
ONCE = 4
#: Occurrences of a word up to which all lines at it are compared with each other, and lines that may meet in a band of sizes at another.
FEW, NEAR = 64, 512
NONE = (1 << 63) - 1


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, " ", -1), "")


def _plain(text: Column) -> Column:
    """White space other than line ends as spaces."""
    return F.when(F.rlike(text, F.lit(r"[\t\x0B-\r]")), F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)


def _classes(lines: DataFrame) -> np.ndarray:
    """A class for every hash bucket: four times the binary logarithm of how often its words occur, and one."""
    words = lines.select(F.explode(F.split("line", " ", -1)).alias("w")).where("w != ''")
    counts = words.groupBy(_bucket(F.xxhash64("w")).alias("b")).agg(F.count("*").alias("n")).toArrow()
    classes = np.zeros(BUCKETS, np.uint8)
    classes[counts["b"].to_numpy()] = np.minimum(126, 4 * np.log2(counts["n"].to_numpy() + 1))
    return classes


def _rarity(lines: DataFrame) -> Column:
    """The classes of all buckets as bytes, a fixed number."""
    return F.lit(_classes(lines).tobytes())


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")


def _least_common(n: str | int, percent: int) -> str:
    return f"cast(ceil({percent} * {n} / 100.0D - 1e-9D) as int)"


def _placed(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (d, h, p, t), one for each pair of d and h, and a number of bits: a line's place in the order is ``p`` shifted by them, plus its number."""
    keyed = with_keys(docs).select("d", "h", _plain(F.col("t")).alias("t"))
    # No text has more line ends than bytes.
    ids = keyed.groupBy("d").agg(F.max(F.octet_length("t")).alias("bytes"), F.count("*").alias("n"))
    low, high, longest, most = ids.agg(F.min("d"), F.max("d"), F.max("bytes"), F.max("n")).first()
    bits = max(1, (longest or 0).bit_length())
    if most is None or most == 1 and (high - low).bit_length() + bits < 63:
        return keyed.withColumn("p", F.col("d") - F.lit(low or 0)), bits
    # Ids that repeat, are missing or lie far apart: number the rows in order.
    order = keyed.select("d", "h").distinct().repartitionByRange("d", "h").sortWithinPartitions("d", "h")
    order = written(spark, order.select("d", "h", F.monotonically_increasing_id().alias("i")), "order")
    part, rest = F.expr("i >> 33"), F.expr(f"i & {(1 << 33) - 1}")
    sizes = sorted((r.part, r.n) for r in order.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for number, n in sizes:
        starts += [F.lit(number), F.lit(total).cast("long")]
        total += n
    order = order.select("d", "h", (F.element_at(F.create_map(*starts), part) + rest).alias("p"))
    once = keyed.groupBy("d", "h").agg(F.min("t").alias("t"))
    return written(spark, once.join(order, ["d", "h"]).select("d", "h", "t", "p"), "placed"), bits


def _lines(placed: DataFrame, bits: int) -> DataFrame:
    """(at, line): at orders the lines of the corpus; blank ones are left out."""
    lines = placed.select("p", F.posexplode(F.split("t", "\n", -1)).alias("line_no", "line"))
    return lines.where(F.length(F.trim("line")) > 0).select((F.shiftleft("p", bits) + F.col("line_no")).alias("at"), "line")


def _sketches(hashes: str) -> list[Column]:
    """(whole, even): parity bits of all hashes, and for a long line of those that go into the first word."""
    zero = F.lit(0).cast("long")
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    whole = F.aggregate(hashes, zero, lambda acc, h: acc.bitwiseXOR(bit(h)))
    first = F.filter(hashes, lambda h: h.bitwiseAND(F.lit(64).cast("long")) == 0)
    even = F.when(F.size(hashes) > SHORT, F.aggregate(first, zero, lambda acc, h: acc.bitwiseXOR(bit(h))))
    return [whole.alias("whole"), even.alias("even")]


def _sets(lines: DataFrame, percent: int) -> DataFrame:
    """(at, n, s1, s2, sketch, prefix) of every line: size and name of its set, words of its parity sketch, and the words it must share one of."""
    rarity = constant(lines.sparkSession, _classes(lines).astype(np.int8))
    # 7 bits of rarity, then 56 bits of the hash.
    ranked = lambda h: F.shiftleft(F.get("rarity", _bucket(h)).cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))
    hashed = F.transform(_words(F.col("line")), lambda w: F.xxhash64(w))
    sets = lines.select("at", F.sort_array(F.array_distinct(hashed)).alias("h"))
    sets = sets.select(
        "at",
        F.size("h").alias("n"),
        F.xxhash64("h").alias("s1"),
        F.xxhash64("h", F.lit(1)).alias("s2"),
        *_sketches("h"),
        "h",
        rarity.alias("rarity"),
    )
    # A step of its own: it takes each column once and is made one with the last, so that no row holds the table.
    sets = sets.select(*sets.columns[:-2], F.sort_array(F.transform("h", ranked)).alias("w"))
    first, second = F.coalesce("even", "whole"), F.coalesce(F.col("whole").bitwiseXOR(F.col("even")), F.lit(0).cast("long"))
    prefix = F.expr(f"slice(w, 1, n - {_least_common('n', percent)} + 1)")
    return sets.select("at", "n", "s1", "s2", first.alias(SKETCH[0]), second.alias(SKETCH[1]), prefix.alias("prefix"))


def near_lines(spark: SparkSession, docs: DataFrame, *, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """(d, h, line_no) of the lines to remove; d and h as of ``with_keys``."""
    placed, bits = _placed(spark, docs)
    every = written(spark, _sets(_lines(placed, bits), percent), "sets")
    sets = every.where(F.col("n") >= max(1, least))
    # Of lines with one set all but the first are removed.
    firsts = sets.groupBy("s1", "s2").agg(F.min("at").alias("first"), F.count("*").alias("many")).where("many > 1")
    again = sets.select("s1", "s2", "at").join(firsts, ["s1", "s2"]).where("at > first").select("at")
    again = written(spark, again, "again")
    one = sets.join(again, "at", "left_anti")
    rows = one.select(F.posexplode("prefix").alias("j", "w"), "at", "n", *SKETCH)
    # At a word that occurs once nothing is met.
    met = written(spark, _met(rows.where(F.shiftright("w", 56) != ONCE), percent), "met")
    removed(spark, every)
    # The earliest line that a line may be similar to, then the others.
    pairs = met.where("near").select("at", "by")
    found = _verified(spark, placed, bits, pairs.groupBy("at").agg(F.min("by").alias("by")), percent)
    many = met.where("many").select("x.*")
    left = many.join(found, "at", "left_anti")
    others = many.select("w", "band", *(F.col(c).alias(f"y_{c}") for c in ("at", "n", "j", "i", *SKETCH)))
    among = left.join(others, ["w", "band"]).where("y_at < at and (i or y_i)").where(_can_match("", "y_", percent))
    among = among.select("at", F.col("y_at").alias("by"))
    rest = pairs.join(found, "at", "left_anti").union(among).distinct()
    more = _verified(spark, placed, bits, rest, percent)
    gone = again.union(found).union(more).select((F.expr(f"at >> {bits}")).alias("p"), F.expr(f"cast(at & {(1 << bits) - 1} as int)").alias("line_no"))
    out = written(spark, gone.join(placed.select("d", "h", "p"), "p").select("d", "h", "line_no"), "gone_lines")
    removed(spark, met, again, found, more)
    return out


def _met(rows: DataFrame, percent: int) -> DataFrame:
    """(at, by, near, many, x) of lines that meet at a word: ``by`` is the earlier one, ``near`` if they pass the filters.  Where very many
    meet, ``many``, x has what is needed to compare a line with the others."""
    met = _looks(rows, percent).withColumn("y", F.explode("ys")).where("at != y.at")
    met = met.withColumn("near", F.expr(_can_match("", "y.", percent))).where("near or many")
    own = F.when(F.col("many"), F.struct("w", "band", "at", "n", "j", "i", *SKETCH))
    return met.select(F.greatest("at", "y.at").alias("at"), F.least("at", "y.at").alias("by"), "near", "many", own.alias("x"))


def _looks(rows: DataFrame, percent: int) -> DataFrame:
    """Lines at their words with ``ys``, the lines there that they are compared with.

    The smaller set of a similar pair (of equal ones the earlier line) has their rarest common word in a prefix of about half the length: only
    lines that have it there, ``i``, are looked at.  At a word that may occur more than ``FEW`` times lines stand in bands of their sizes, and look
    into those bands that a set not larger and similar can be in.  Where more than ``NEAR`` stand (many) they look at the earliest one only.
    """
    width = math.log(max(100 / percent, 1.05))
    band = lambda n: f"cast(floor(ln({n}) / {width}D + 1e-9D) as int)"
    inner = f"j <= n - cast(ceil({2 * percent} * n / {100.0 + percent}D - 1e-9D) as int)"
    largest = f"least(n, cast(floor((n - j) * {(100.0 + percent) / percent}D - n + 1e-9D) as int))"
    bands = f"sequence({band(_least_common('n', percent))}, {band(largest)})"
    rare = F.shiftright("w", 56) <= int(4 * math.log2(FEW + 1))
    at_word = rows.repartition("w").withColumn("band", F.explode(F.when(rare, F.array(F.lit(-1))).otherwise(F.expr(bands))))
    at_word = at_word.withColumn("i", F.expr(f"{inner} and (band = -1 or band = {band('n')})"))
    order = Window.partitionBy("w", "band").orderBy("n", "at")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = {"place": F.count_if("i").over(order.rowsBetween(Window.unboundedPreceding, 0)), "stand": F.count_if("i").over(whole)}
    line = F.struct("at", "n", "j", *SKETCH)
    first = F.collect_list(F.when(F.col("i") & (F.col("place") <= NEAR), line)).over(whole)
    at_word = at_word.withColumns(place).withColumns({"first": first, "earliest": F.min(F.when(F.col("i"), line)).over(whole)})
    many = F.col("stand") > NEAR
    # Those that stand before a line in the order of sizes.
    before = F.expr("slice(first, 1, cast(place as int) - if(i, 1, 0))")
    return at_word.select(*rows.columns, "band", "i", many.alias("many"), F.when(many, F.array("earliest")).otherwise(before).alias("ys"))


def _can_match(x: str, y: str, percent: int) -> str:
    """Length, positional and sketch filter for two lines (their columns begin with x and y) that meet at places j of their orders."""
    common = f"ceil({percent} * ({x}n + {y}n) / {100.0 + percent}D - 1e-9D)"
    return (
        f"100 * least({x}n, {y}n) >= {percent} * greatest({x}n, {y}n) and 1 + least({x}n - 1 - {x}j, {y}n - 1 - {y}j) >= {common} "
        f"and {_distance(x, y)} <= {x}n + {y}n - 2 * {common}"
    )


def _distance(x: str, y: str) -> str:
    """A number that the symmetric difference of two lines reaches at least; a short and a long line are compared by the folded words."""
    folded = f"bit_count({' ^ '.join(a + q for q in SKETCH for a in (x, y))})"
    each = " + ".join(f"bit_count({x}{q} ^ {y}{q})" for q in SKETCH)
    return f"if(({x}n > {SHORT}) = ({y}n > {SHORT}), {each}, {folded})"


def _verified(spark: SparkSession, placed: DataFrame, bits: int, pairs: DataFrame, percent: int) -> DataFrame:
    """The lines ``at`` of pairs (at, by) that are similar in their words."""
    pairs = written(spark, pairs, "pairs")
    both = pairs.select(F.explode(F.array("at", "by")).alias("at")).distinct()
    holders = placed.where(in_bit_table(both.select(F.expr(f"at >> {bits}").alias("p")), "p", F.col("p")))
    lines = _lines(holders, bits).join(both, "at").select("at", F.array_distinct(_words(F.col("line"))).alias("words"))
    texts = written(spark, lines, "texts")
    by = texts.select(F.col("at").alias("by"), F.col("words").alias("other"))
    found = pairs.join(by, "by").join(texts, "at")
    common = F.size(F.array_intersect("words", "other"))
    found = written(spark, found.where(100 * common >= percent * (F.size("words") + F.size("other") - common)).select("at").distinct(), "found")
    removed(spark, pairs, texts)
    return found


def with_keys(docs: DataFrame) -> DataFrame:
    """The documents with d (id for the order), h (text hash) and t (text)."""
    text = text_of(docs)
    return docs.withColumns({"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(NONE)), "h": F.xxhash64(text), "t": text})


def clean_documents(spark: SparkSession, docs: DataFrame, *, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """All documents and columns, the text without its removed lines, and ``n_lines``, ``n_removed`` (clashing columns are replaced)."""
    plain = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    named = {c: f"c{i}" for i, c in enumerate(plain)}
    keyed = with_keys(docs).select(*(F.col(f"`{c}`").alias(n) for c, n in named.items()), "d", "h", "t")
    lines = near_lines(spark, docs, percent=percent, least=least)
    gone = written(spark, lines.groupBy("d", "h").agg(F.collect_set("line_no").alias("gone")), "gone")
    removed(spark, lines)
    touched = in_bit_table(gone, "d", F.col("d"))
    lines = F.split("t", "\n", -1)
    number = F.when(F.length("t") > 0, F.size(lines)).otherwise(0)
    same = keyed.where(~touched).select(*named.values(), F.col("t").alias("new"), number.alias("n_lines"), F.lit(0).alias("n_removed"))
    other = keyed.where(touched).join(gone, ["d", "h"], "left")
    kept = F.filter(lines, lambda _, i: ~F.array_contains("gone", i))
    n_gone = F.coalesce(F.size("gone"), F.lit(0))
    new = F.when(F.col("gone").isNull(), F.col("t")).otherwise(F.array_join(kept, "\n"))
    other = other.select(*named.values(), new.alias("new"), number.alias("n_lines"), n_gone.alias("n_removed"))
    both = same.unionByName(other)
    # A text that loses nothing stays as it is, also if it is null.
    text = F.when(F.col("n_removed") > 0, F.col("new")).otherwise(F.col(named["text"]))
    return both.select(
        *((text if c == "text" else F.col(n)).alias(c) for c, n in named.items()),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.greatest("n_removed", F.lit(0)).cast("long").alias("n_removed"),
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: doc_id, text (without the removed lines), n_lines, n_removed."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return clean_documents(spark, docs)


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text <> ''),
w AS (SELECT doc_id, i, list_distinct(list_filter(string_split_regex(line, '[\x20\x09\x0B-\x0D]+'), lambda x: x <> '')) AS w FROM l),
s AS (SELECT doc_id, i, w, len(w) AS n, list_sort(w) AS k FROM w WHERE len(w) >= 1),
f AS (SELECT k, min((doc_id, i)) AS pos, any_value(n) AS n FROM s GROUP BY k),
t AS (SELECT pos, n, unnest(k) AS t FROM f),
p AS (SELECT a.pos AS pos, count(*) AS c, any_value(a.n) AS n, any_value(b.n) AS m FROM t a JOIN t b
  ON a.t = b.t AND b.pos < a.pos AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.pos, b.pos),
r AS (SELECT DISTINCT pos FROM p WHERE 100 * c >= 80 * (n + m - c)),
gone AS (SELECT s.doc_id, s.i FROM s JOIN f USING (k) WHERE (s.doc_id, s.i) <> f.pos OR f.pos IN (SELECT pos FROM r)),
c AS (SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
  coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text
  FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(c.text, d.text) AS text, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN c USING (doc_id)
"""
