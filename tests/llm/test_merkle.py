import hashlib
import zlib
from collections import defaultdict

import pytest

from peerwatch.llm.merkle import append_log, fold, height, log_rows, manifest, numbered, pages, place, siblings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, idx string, node int, tree long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        now = out[-1]
        out.append([sha("".join(now[i : i + 16])) for i in range(0, len(now), 16)])
    return out


def leaf_of(row, text):
    fields = (row[0], row[3], row[2], row[4], text)
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def lower(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[3]].append(row)
    names = sorted(trees, key=lambda s: b"" if s is None else b"+" + s.encode())
    for members in trees.values():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
    made = {s: levels_of([leaf_of(r, r[1]) for r in trees[s]]) for s in names}
    top = levels_of([made[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, r in enumerate(trees[s]):
            node = made[s][0][i]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            now, proof = leaf_of(r, lower(r[1]) if changed else r[1]), ""
            for levels, index in ((made[s], i), (top, at)):
                for level in levels[:-1]:
                    run = level[index // 16 * 16 : index // 16 * 16 + 16]
                    others = run[: index % 16] + run[index % 16 + 1 :]
                    proof += "".join(others)
                    now = sha("".join(run[: index % 16] + [now] + run[index % 16 + 1 :]))
                    index //= 16
            out.append((r[0], node, made[s][-1][0], top[-1][0], sha(proof), now, now == top[-1][0]))
    return out


def row(doc_id, text, source, lang="en", n_chars=1):
    return (doc_id, text, lang, source, n_chars, "x", 1, 2)


def tables():
    plain = [row(i, f"Text {i}", "web") for i in range(300)] + [row(1000 + i, f"b {i}", f"s{i}") for i in range(40)]
    odd = [
        row(5, None, None), row(6, "", None), row(None, "No Id", "web"), row(None, "No Id", "web"), row(7, "É" * 70_000 + "A", "lang", None, None),
        row(8, "Twin", "é"), row(8, "Twin", "é"), row(8, "other", "é"), row(9, "X", ""), row(-3, "Minus", "web"),
    ]
    return {"many": plain + odd, "odd": odd, "one": [row(1, "A", "b")], "run": [row(i, "t", "s") for i in range(16)], "edge": [row(i, "T", "s") for i in range(257)]}


@pytest.mark.parametrize("name", list(tables()))
def test_against_brute_force(spark, name):
    rows = tables()[name]
    got = manifest(spark, spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows)))


def test_several_rounds(spark):
    """Builders of one level: three rounds for 300 leaves."""
    rows = tables()["many"]
    got = manifest(spark, spark.createDataFrame(rows, SCHEMA), levels=1)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows)))


def test_empty(spark):
    got = manifest(spark, spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 1000])
def test_closed_form_places(n):
    """Every node lies where the closed form says, and proofs read by it lead to the root."""
    leaves = [sha(str(i)) for i in range(n)]
    log, levels = append_log(leaves, height(n)), levels_of(leaves)
    assert len(log) == sum(map(len, levels)) and height(n) == len(levels) - 1
    for level, nodes in enumerate(levels):
        assert [log[place(level, i, n)] for i in range(len(nodes))] == nodes
    for i in {0, n // 2, n - 1}:
        assert fold(leaves[i], siblings(log, n, height(n), i)) == log[-1]


@pytest.mark.parametrize(("n", "levels"), [(1, 2), (16, 2), (257, 2), (700, 1)])
def test_pages_are_the_append_log(spark, n, levels):
    """What the builders write apart is the log that one writer would append."""
    rows = spark.createDataFrame([("t", f"{i:05}", sha(str(i))) for i in range(n)], "name string, key string, node string").repartition(3)
    leaves = numbered(spark, rows, "name", ["key"]).withColumnRenamed("name", "tree")
    got = [r.node for r in log_rows(pages(spark, leaves, levels), levels).orderBy("pos").collect()]
    assert got == append_log([sha(str(i)) for i in range(n)], height(n))
