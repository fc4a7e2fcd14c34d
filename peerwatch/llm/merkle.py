"""Operator 13: Merkle manifest of a data set, built as postorder append logs.

A row is a leaf, the SHA-256 of its fields; every run of up to 16 nodes has their SHA-256 as parent until one is left.  Each source is a tree,
and the roots of the sources are the leaves of the tree of the data set.

Builders work on aligned ranges of 256 nodes: as a node is written once its last child is, the nodes of a range are one piece of the
log, whoever else writes.  Before leaf i come i leaves and i // 16^k nodes of every level k, and a node comes right after its last leaf and
the lower nodes that end there: ``place`` is that closed form, and siblings are read from the log by it.  A page of the log holds what one
builder wrote; the last nodes of all pages are the leaves of the next round of builders, so a tree of n leaves takes log256(n) rounds.

Scale: documents are read once and hashed in the JVM; only ids and hashes go on.  They are sorted by range (source, doc_id), so that a source with a third
of all rows is spread over many tasks; a leaf's number is its place in its part plus the sizes of the parts before, and those are counted by
(source, part).  Every group is one aligned range.  Proofs come top-down: a page is joined with the path of its last node, then each of its leaves has
its siblings in the page and that path.  One number, the most leaves of a tree, comes to the driver per tree level of 256.

Defined results: null fields count as ``-``, so nulls differ from empty texts; a null source is a tree of its own, before all others; rows without id come first
in their source and are not tampered with; rows that repeat an id are ordered by their leaf; equal rows are leaves each, and their proofs may be told apart by
nothing but their place; very long texts are one hash like others; an empty table has no rows; further columns and clashing names are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerwatch.llm.common import table, written

ARITY_BITS = 4
ARITY = 1 << ARITY_BITS
#: Levels that a builder writes above the nodes it is given.
LEVELS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // ARITY), out + 1
    return out


def place(level: int, index: int, n: int) -> int:
    """Position of a node in the postorder log of n leaves."""
    last = at = min((index + 1) << (ARITY_BITS * level), n) - 1
    while last:
        last >>= ARITY_BITS
        at += last
    return at + level


def append_log(leaves: list[str], levels: int) -> list[str]:
    """The nodes of a range in the order in which they are complete, up to ``levels`` above the leaves."""
    log, open_ = [], [[] for _ in range(levels + 1)]

    def put(level: int, node: str) -> None:
        log.append(node)
        open_[level].append(node)
        if level < levels and len(open_[level]) == ARITY:
            close(level)

    def close(level: int) -> None:
        run, open_[level] = open_[level], []
        put(level + 1, digest(run))

    for leaf in leaves:
        put(0, leaf)
    for level in range(levels):
        if open_[level]:
            close(level)
    return log


def siblings(log: list[str], n: int, levels: int, index: int) -> list[tuple[int, str]]:
    """For each level from the leaf up: its place in its run and the others of the run, joined."""
    out = []
    for level in range(levels):
        count = (n + (1 << ARITY_BITS * level) - 1) >> (ARITY_BITS * level)
        first = index >> ARITY_BITS << ARITY_BITS
        others = (log[place(level, i, n)] for i in range(first, min(first + ARITY, count)) if i != index)
        out.append((index - first, "".join(others)))
        index >>= ARITY_BITS
    return out


def fold(node: str, path: Iterable[tuple[int, str]]) -> str:
    """The root that a node and its path lead to."""
    for at, others in path:
        node = digest((others[: 64 * at], node, others[64 * at :]))
    return node


def leaf(docs: DataFrame, changed: dict[str, Column] | None = None) -> Column:
    """Hash of a row: its fields with their lengths, in order."""
    changed = changed or {}
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def numbered(spark: SparkSession, rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with ``idx``, their number from 0 within ``tree`` (a string) in the given order, and ``n``, the leaves of the tree."""
    order_in_part = written(
        spark,
        rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn("number", F.monotonically_increasing_id()),
        "sorted",
    )
    part = F.call_function("shiftright", F.col("number"), F.lit(33))
    pieces = order_in_part.groupBy(F.col(tree).alias("piece_tree"), part.alias("piece_part")).agg(F.min("number").alias("start"), F.count("*").alias("size"))
    # As many rows for a tree as it has parts.
    trees = Window.partitionBy("piece_tree")
    before = F.sum("size").over(trees.orderBy("piece_part").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.withColumns({"before": F.coalesce(before, F.lit(0)), "n": F.sum("size").over(trees)})
    pieces = written(spark, pieces.drop("size"), "pieces")
    joined = order_in_part.join(pieces, (F.col(tree) == F.col("piece_tree")) & (part == F.col("piece_part")))
    return joined.select(*rows.columns, (F.col("number") - F.col("start") + F.col("before")).alias("idx"), "n")


PAGE = "tree string, n long, page long, nodes array<string>, log array<string>"


def _levels(n: int, level: int, most: int) -> int:
    """Levels, ``most`` at most, that a builder writes whose nodes are ``level`` above the n leaves."""
    return min(most, height(n) - level)


def _ends(i: int, levels: int) -> str:
    """Condition on n: the tree ends in round i, in a single page."""
    return f"n <= {1 << ARITY_BITS * levels * (i + 1)} and n > {0 if i == 0 else 1 << ARITY_BITS * levels * i}"


def pages(spark: SparkSession, leaves: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The log of every tree by pages, a table for every round, from rows (tree, n, idx, node): see ``PAGE``; ``nodes`` are the leaves of the page."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    rows, out, level = leaves.select("tree", "n", "idx", "node"), [], 0
    while True:

        def work(batches: Iterator[pa.RecordBatch], level=level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, nodes = batch.column(1).to_pylist(), batch.column(3)
                logs = [append_log(own.as_py(), _levels(n, level, levels)) for n, own in zip(sizes, nodes, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.list_(pa.string()))], ["tree", "n", "page", "nodes", "log"])

        # At most 16^levels rows in a group.
        by_page = rows.groupBy("tree", "n", _page(levels).alias("page"))
        grouped = by_page.agg(F.sort_array(F.collect_list(F.struct("idx", "node")))["node"].alias("nodes"))
        out.append(written(spark, grouped.select("tree", "n", "page", "nodes").mapInArrow(work, PAGE), "pages"))
        level += levels
        most = -(-most >> ARITY_BITS * levels)
        if most <= 1:
            return out
        last = out[-1].where(f"n > {1 << (ARITY_BITS * level)}")
        rows = last.select("tree", "n", F.col("page").alias("idx"), F.element_at("log", -1).alias("node"))


def _page(levels: int) -> Column:
    return F.call_function("shiftright", "idx", F.lit(ARITY_BITS * levels))


def roots(rounds: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """(tree, root): the last node of the only page of a tree's last round."""
    out = None
    for i, by_page in enumerate(rounds):
        some = by_page.where(_ends(i, levels)).select("tree", F.element_at("log", -1).alias("root"))
        out = some if out is None else out.union(some)
    return out


def log_rows(rounds: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """(tree, pos, node): the whole log of every tree, positions from 0 (tells what the pages mean; proofs do not need it)."""

    def work_at(level: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for row in batch.to_pylist():
                    count, n = len(row["nodes"]), row["n"]
                    first = row["page"] << ARITY_BITS * levels
                    # The leaves of later rounds are in the log already.
                    for own in range(0 if level == 0 else 1, _levels(n, level, levels) + 1):
                        for i in range((count + (1 << ARITY_BITS * own) - 1) >> ARITY_BITS * own):
                            node = row["log"][place(own, i, count)]
                            index = (first >> ARITY_BITS * own) + i
                            found.append((row["tree"], place(level + own, index, n), node))
                yield pa.RecordBatch.from_pylist([dict(zip(("tree", "pos", "node"), f, strict=True)) for f in found], pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("node", pa.string())]))

        return work

    out = None
    for i, by_page in enumerate(rounds):
        rows = by_page.mapInArrow(work_at(levels * i), "tree string, pos long, node string")
        out = rows if out is None else out.union(rows)
    return out


PATH = "array<struct<at: int, others: string>>"


def _paths_of(by_page: DataFrame, above: DataFrame, level: int, levels: int) -> DataFrame:
    """(tree, page, idx, path) of every leaf of the pages; above: (tree, page, path) of the pages' last nodes."""
    kind = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.string())]))
    schema = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("path", kind)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                count, own = len(row["nodes"]), _levels(row["n"], level, levels)
                found = []
                for i in range(count):
                    path = [{"at": at, "others": others} for at, others in siblings(row["log"], count, own, i)]
                    found.append({"tree": row["tree"], "idx": (row["page"] << ARITY_BITS * levels) + i, "path": path + (row["path"] or [])})
                yield pa.RecordBatch.from_pylist(found, schema)

    joined = by_page.join(above.withColumnsRenamed({"tree": "above_tree", "page": "above_page"}), F.expr("tree = above_tree and page = above_page"), "left")
    return joined.select("tree", "n", "page", "nodes", "log", "path").mapInArrow(work, f"tree string, idx long, path {PATH}")


def page_paths(spark: SparkSession, rounds: list[DataFrame], tops: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """(tree, page, path): the path of the last node of every page of the first round, to the root of its tree, then on by ``tops`` (tree, path)."""
    if tops is None:
        tops = spark.createDataFrame([], f"tree string, path {PATH}")
    above = None
    for i in reversed(range(len(rounds))):
        # Trees that end in this round: their page's last node is their root.
        ends = rounds[i].where(_ends(i, levels)).select("tree", "page")
        ends = ends.join(tops, "tree", "left").select("tree", "page", "path")
        above = ends if above is None else above.union(ends)
        if i:
            above = _paths_of(rounds[i], above, levels * i, levels).select("tree", F.col("idx").alias("page"), "path")
        above = written(spark, above, "paths")
    return above


def manifest(spark: SparkSession, docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    doc_id = F.col("doc_id").cast("long")
    shown = F.crc32(doc_id.cast("string").cast("binary"))
    other = F.when(F.coalesce(shown % 5 == 0, F.lit(False)), leaf(docs, {"text": F.translate(F.col("text").cast("string"), UPPER, LOWER)}))
    # Null sources first, the others in the order of their bytes.
    tree = F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit(""))
    leaves = written(spark, docs.select(tree.alias("tree"), doc_id.alias("doc_id"), leaf(docs).alias("node"), other.alias("other")), "leaves")
    leaves = written(spark, numbered(spark, leaves, "tree", ["doc_id", "node"]), "numbered")
    rounds = pages(spark, leaves, levels)
    subroots = written(spark, roots(rounds, levels), "subroots")
    tops = numbered(spark, subroots.select(F.lit("all").alias("whole"), F.col("tree").alias("name"), "root"), "whole", ["name"])
    tops = written(spark, tops, "tops")
    upper = pages(spark, tops.select(F.col("whole").alias("tree"), "n", "idx", F.col("root").alias("node")), levels)
    root = roots(upper, levels).first()
    paths = _paths_of(upper[0], page_paths(spark, upper, None, levels), 0, levels).select("idx", "path")
    ways = written(spark, tops.join(paths, "idx").select(F.col("name").alias("tree"), "path"), "ways")
    above = page_paths(spark, rounds, ways, levels)
    above = above.join(subroots, "tree")
    return _proofs(spark, rounds[0], leaves, above, root["root"] if root else "", levels)


OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(spark: SparkSession, by_page: DataFrame, leaves: DataFrame, above: DataFrame, root: str, most: int) -> DataFrame:
    """The result rows of each page: above has (tree, page, path, root) of its last node, leaves the ids and changed leaves in the order of the pages."""
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, log = row["nodes"], row["log"]
                levels = _levels(row["n"], 0, most)
                upper = [(p["at"], p["others"]) for p in row["path"] or []]
                rest = "".join(others for _, others in upper)
                out = []
                for i, (node, mine) in enumerate(zip(nodes, row["own"], strict=True)):
                    path = siblings(log, len(nodes), levels, i)
                    proof = digest((*(others for _, others in path), rest))
                    folded = fold(mine["other"] or node, path + upper)
                    out.append((mine["doc_id"], node, row["root"], root, proof, folded, folded == root))
                types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(types)], names)

    own = leaves.groupBy(F.col("tree").alias("own_tree"), _page(most).alias("own_page"))
    own = own.agg(F.sort_array(F.collect_list(F.struct("idx", "doc_id", "other"))).alias("own"))
    joined = by_page.join(own, F.expr("tree = own_tree and page = own_page"))
    above = above.select(F.col("tree").alias("above_tree"), F.col("page").alias("above_page"), "path", "root")
    joined = joined.join(above, F.expr("tree = above_tree and page = above_page"))
    return joined.select("n", "nodes", "log", "own", "path", "root").mapInArrow(work, OUT)


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return manifest(spark, table(spark, folder, "documents"))


_FIELD = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in FIELDS) + ")"
_TAMPERED = "sha256(" + " || ".join(_FIELD.format(c if c != "text" else f"translate(text, '{UPPER}', '{LOWER}')") for c in FIELDS) + ")"
#: CRC-32 of ASCII text: a step takes a byte in (0 or more) or shifts by a bit (-1).
CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''), "
    "lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) "
    "WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT)"
)
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, {_LEAF} AS leaf, {_TAMPERED} AS other, {CRC32.format("doc_id::varchar")} % 5 = 0 AS hit,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i FROM documents),
a(k, l, i, h) AS (SELECT source, 0, i, leaf FROM d UNION ALL
  SELECT k, l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY k) AS m FROM a) WHERE m > 1 GROUP BY k, l, i // 16),
top AS (SELECT k, max(l) AS l FROM a GROUP BY k),
sub AS (SELECT a.k, a.h, a.l AS levels, row_number() OVER (ORDER BY a.k NULLS FIRST) - 1 AS i FROM a JOIN top ON a.k IS NOT DISTINCT FROM top.k AND a.l = top.l),
b(l, i, h) AS (SELECT 0, i, h FROM sub UNION ALL
  SELECT l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS m FROM b) WHERE m > 1 GROUP BY l, i // 16),
whole AS (SELECT h AS root, l AS levels FROM b ORDER BY l DESC LIMIT 1),
runs AS (SELECT 0 AS stage, k, l, i // 16 AS run, list(h ORDER BY i) AS hs FROM a GROUP BY k, l, i // 16
  UNION ALL SELECT 1, NULL, l, i // 16, list(h ORDER BY i) FROM b GROUP BY l, i // 16),
way AS (SELECT d.doc_id, d.i AS own, s AS step, 0 AS stage, d.source AS k, s AS l, d.i AS at FROM d JOIN sub ON d.source IS NOT DISTINCT FROM sub.k, range(sub.levels) AS r(s)
  UNION ALL SELECT d.doc_id, d.i, sub.levels + s, 1, NULL, s, sub.i FROM d JOIN sub ON d.source IS NOT DISTINCT FROM sub.k, whole, range(whole.levels) AS r(s)),
steps AS (SELECT w.doc_id, w.step, (w.at >> (4 * w.l)::int) % 16 AS place, runs.hs FROM way w
  JOIN runs ON runs.stage = w.stage AND runs.k IS NOT DISTINCT FROM w.k AND runs.l = w.l AND runs.run = w.at >> (4 * w.l + 4)::int),
f(doc_id, step, h) AS (SELECT doc_id, 0, CASE WHEN hit THEN other ELSE leaf END FROM d UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(array_to_string(s.hs[:s.place] || [f.h] || s.hs[s.place + 2:], '')) FROM f JOIN steps s USING (doc_id, step)),
folded AS (SELECT doc_id, arg_max(h, step) AS h FROM f GROUP BY doc_id),
proof AS (SELECT doc_id, sha256(string_agg(array_to_string(hs[:place] || hs[place + 2:], ''), '' ORDER BY step)) AS h FROM steps GROUP BY doc_id)
SELECT d.doc_id, d.leaf, sub.h AS subroot, whole.root, coalesce(proof.h, sha256('')) AS proof_sha256, folded.h AS folded_root, folded.h = whole.root AS verified
FROM d JOIN sub ON d.source IS NOT DISTINCT FROM sub.k CROSS JOIN whole LEFT JOIN proof USING (doc_id) JOIN folded USING (doc_id)
"""
