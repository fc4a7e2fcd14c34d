import random

from pyspark.sql import functions as F

from peerwatch.llm import line_dedup
from peerwatch.llm.line_dedup import clean_documents


def brute(rows, least=1, percent=80):
    """Lines in the order of id (null last), then text hash is irrelevant here as ids are unique or rows equal."""
    order = sorted({(d is None, d or 0, t or "") for d, t, *_ in rows})
    lines = [(k, i, set(x.split()), x) for k in order for i, x in enumerate(k[2].split("\n"))] if rows else []
    gone = set()
    for a, (k, i, w, _) in enumerate(lines):
        for m, j, v, _ in lines[:a]:
            both = len(w & v)
            if len(w) >= least and len(v) >= least and 100 * both >= percent * len(w | v):
                gone.add((k, i))
                break
    out = []
    for d, t, *_ in rows:
        k = (d is None, d or 0, t or "")
        left = [x for i, x in enumerate(k[2].split("\n")) if (k, i) not in gone]
        n = sum((k, i) in gone for i in range(len(k[2].split("\n"))))
        out.append((d, "\n".join(left) if n else t, len(k[2].split("\n")) if t else 0, n))
    return sorted(map(repr, out))


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    got = clean_documents(spark, docs, **options).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows, **options)


def line(rng, n, vocabulary):
    return [f"v{rng.randrange(vocabulary)}" for _ in range(n)]


def test_near_lines_against_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    bases = [line(rng, n, 80) for n in (5, 6, 9, 12, 20, 40, 90) for _ in range(3)]
    rows = []
    for d in range(40):
        lines = []
        for _ in range(6):
            words = list(rng.choice(bases)) if rng.random() < 0.8 else line(rng, 8, 200)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
            lines.append(rng.choice((" ", "\t", "  ")).join(words))
        rows.append((d * 7, "\n".join([*lines, "", "short line"]), "x"))
    check(spark, rows)
    check(spark, rows, least=5)
    check(spark, rows, percent=60)
    # Every word that more than two lines meet at goes the way of frequent words.
    monkeypatch.setattr(line_dedup, "NEAR", 2)
    check(spark, rows)


def test_the_rarity_table_is_small_in_the_plan(spark):
    """A megabyte of bytes: as text or an array it would be millions of characters or objects on the driver, in each plan."""
    docs = spark.createDataFrame([(1, "a b\n\na  b c"), (2, None)], "doc_id long, text string")
    plan = spark.range(1).select(line_dedup._rarity(line_dedup._lines(*line_dedup._placed(spark, docs))).alias("r"))
    assert plan.schema["r"].dataType.typeName() == "binary"
    counted = [c for c in plan.first().r if c]
    # Two words that occur twice, one that does once, blanks none.
    assert sorted(counted) == [4, 6, 6] and len(plan.first().r) == line_dedup.BUCKETS


def test_bands_of_sizes_against_brute_force(spark, monkeypatch):
    """Every word has bands, and all sets of one size and the next ones are there, similar or just not."""
    rng = random.Random(3)
    rows = []
    for d in range(60):
        words = [f"v{k}" for k in range(rng.randrange(1, 30))]
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(9)}"
        rows.append((rng.randrange(1000), "\n".join((" ".join(words), " ".join(words[: 1 + len(words) * 4 // 5]))), "x"))
    rows = list({r[0]: r for r in rows}.values())
    monkeypatch.setattr(line_dedup, "FEW", 1)
    check(spark, rows)
    check(spark, rows, percent=60)
    check(spark, rows, percent=100)
    monkeypatch.setattr(line_dedup, "NEAR", 2)
    check(spark, rows)


def test_few_of_the_lines_at_a_frequent_word_are_compared(spark):
    """400 lines at one word made 79,800 pairs."""
    frequent = 40 << 56
    early = [(frequent, d, 10 + d, 0, 0, 0) for d in range(400)]
    late = [(frequent + 1, d, 100, 20, 0, 0) for d in range(400)]
    rows = spark.createDataFrame(early + late, "w long, at long, n int, j int, q0 long, q1 long")
    looks = line_dedup._looks(rows, 80)
    pairs = {r.w: r.pairs for r in looks.groupBy("w").agg(F.sum(F.size("ys")).alias("pairs")).collect()}
    # No line is compared with those of sizes out of reach, and none that has the word late with another such.
    assert 400 < pairs[frequent] < 30_000 and pairs[frequent + 1] == 0


def test_the_tables_of_every_row_are_not_in_the_plans(spark):
    docs = spark.createDataFrame([(d, f"a b c {d}\na b") for d in range(3)], "doc_id long, text string")
    placed, bits = line_dedup._placed(spark, docs)
    for df in (line_dedup._sets(line_dedup._lines(placed, bits), 80), clean_documents(spark, docs)):
        assert len(df._jdf.queryExecution().toString()) < 200_000


def test_odd_rows(spark):
    long = " ".join(f"a{i}" for i in range(20_000))
    rows = [(1, None, ""), (2, "", ""), (3, "\n\n", ""), (4, "a b c d e\r\na b c d e", ""), (5, "e d c b a", ""), (9, long, ""), (12, long + " more", ""),
            (7, "é ü ö ä ß", ""), (8, "é ü ö ä ß", ""), (8, "é ü ö ä ß", "again"), (None, "a b c d e", ""), (1 << 60, "one two three four five", ""),
            (-(1 << 60), "five four three two one", "")]
    check(spark, rows)
    assert clean_documents(spark, spark.createDataFrame([], "doc_id long, text string, at int, d int, t string")).count() == 0


def test_an_id_with_two_texts(spark):
    rows = [(1, "a b c d e", ""), (1, "a b c d e\nf g h i j", ""), (2, "f g h i j", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = clean_documents(spark, docs)
    assert got.count() == 3 and got.where("doc_id = 2").first().n_removed == 1
    # One of the equal first lines stays.
    assert sum("a b c d e" in (r.text or "") for r in got.collect()) == 1


def test_short_lines(spark):
    rng = random.Random(5)
    rows = [(d, "\n".join(" ".join(line(rng, rng.randrange(7), 6)) for _ in range(6)), "x") for d in range(30)]
    rows += [(100, "All rights reserved.", "x"), (101, "news\nreserved. All rights", "x"), (102, "a b c d e", "x"), (103, "a b c d", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    got = clean_documents(spark, docs, least=1).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows, least=1)
    assert {r.doc_id: r.text for r in got if r.doc_id >= 100} == {100: "All rights reserved.", 101: "news", 102: "a b c d e", 103: ""}


def test_the_pipeline_takes_short_lines(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "Les.\nOne\n"), (2, "Les.\nTwo"), (3, "Les."), (4, "\n")], "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in corpus_pipeline.lines(spark, docs, "").collect()} == {(1, "Les.\nOne\n"), (2, "Two"), (4, "\n")}
