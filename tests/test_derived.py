import random

from conftest import rows_of

from peerwatch.operators import derived, profile, report, sample
from peerwatch.operators.filters import in_window, longer_than, outside_range, with_code
from peerwatch.schema import BATCH, SEEN
from peerwatch.sources.logs import literal_rows


def batch(spark, rows):
    return literal_rows(spark, rows, BATCH)


def test_latest_breaks_ties_in_a_fixed_order(spark):
    rows = [
        ("1", "a", "text x", 12, "2024-01-01-05", 2024010200, "0", "7"),
        ("1", "a", "text y", 15, "2024-01-01-05", 2024010200, "0", "7"),
        ("2", "a", "text y", 15, "2024-01-01-05", 2024010200, "0", "7"),
        ("1", "a", "text z", 99, "2024-01-01-04", 2024010300, "0", "7"),
        ("1", "b", "text z", 11, None, 2024010300, "0", "7"),
        ("1", "b", "text w", 11, "2023-01-01-04", 2024010100, "0", "7"),
    ]
    want = [("1", "a", "text y", 15, "2024-01-01-05", "0", "7"), ("1", "b", "text w", 11, "2023-01-01-04", "0", "7")]
    for _ in range(3):
        random.shuffle(rows)
        assert rows_of(derived.latest_per_sender(batch(spark, rows).repartition(3))) == want


def test_latest_prunes_before_the_shuffle(spark):
    from test_detect import plan_of

    rows = batch(spark, [("1", "a", "t", 12, "2024-01-01-05", ad, "0", "7") for ad in range(9)]).repartition(2)
    assert "WindowGroupLimit" in plan_of(derived.latest_per_sender(rows))


def test_first_last_and_merge(spark):
    old = batch(
        spark,
        [
            ("1", "a", "t", 12, "2024-01-01-05", 1, "0", "7"),
            ("1", "a", "t", 12, "2024-01-03-05", 1, "0", "7"),
            ("1", "b", "t", 12, None, 1, "0", "7"),
        ],
    )
    new = batch(
        spark,
        [
            ("1", "a", "u", 12, "2023-12-31-23", 1, "0", "7"),
            ("1", "a", "u", 12, "2024-01-02-00", 1, "1", "7"),
            ("1", "c", "u", 12, "2024-01-02-00", 1, "0", "7"),
        ],
    )
    seen_old, seen_new = derived.first_last(old), derived.first_last(new)
    assert seen_old.schema.simpleString() == SEEN.simpleString()
    want = [
        ("1", "a", "2023-12-31-23", "2024-01-03-05", "0", "7"),
        ("1", "a", "2024-01-02-00", "2024-01-02-00", "1", "7"),
        ("1", "b", None, None, "0", "7"),
        ("1", "c", "2024-01-02-00", "2024-01-02-00", "0", "7"),
    ]
    merged = derived.merge_first_last(seen_new, seen_old)
    assert rows_of(merged) == want
    assert rows_of(derived.merge_first_last(seen_new, merged)) == want  # again: no change
    assert rows_of(derived.first_last(old.unionByName(new))) == want
    assert rows_of(derived.first_last(old.unionByName(new), bucket_format=None)) == want
    from test_detect import plan_of

    assert "SortAggregate" not in plan_of(merged)


def test_predicates(spark):
    df = spark.createDataFrame([(i, f"x{'0' * i}") for i in range(8)], "n long, t string")
    assert rows_of(in_window(df, "n", 2, 4), "n") == [(2,), (3,)]
    assert rows_of(with_code(df, "n", 5), "n") == [(5,)]
    assert rows_of(outside_range(df, "n", 2, 5), "n") == [(0,), (1,), (6,), (7,)]
    assert longer_than(df, "t", 2).count() == 0
    assert longer_than(df, "t", 1).count() == 7


def test_large_sample_is_the_smallest_digests(spark):
    rows = spark.range(30_000).selectExpr("id", "concat('n', id) name")
    whole = rows.withColumn("d", sample.random_order(9, ["id", "name"])).orderBy("d", "id").select("id", "name")
    n = 10_777
    assert rows_of(sample.seeded_sample(rows, n, seed=9)) == rows_of(whole.limit(n))
    assert rows_of(sample.seeded_sample(rows, 50, seed=9)) == rows_of(whole.limit(50))
    assert sample.seeded_sample(rows, 40_000, seed=9).count() == 30_000
    assert rows_of(sample.seeded_sample(rows, 50, seed=8)) != rows_of(whole.limit(50))


def test_sample_takes_equal_rows_once(spark):
    rows = spark.range(25_000).selectExpr("id % 12000 AS id", "'n' AS name")
    for n, want in ((100, 100), (11_000, 11_000), (20_000, 12_000)):
        got = sample.seeded_sample(rows, n, seed=1)
        assert got.count() == want == got.distinct().count()


def test_report_and_peek(spark):
    rows = [("1", str(i), "t", i, f"2024-01-0{i}-00", 10 - i, "0", "7") for i in range(1, 6)]
    df = batch(spark, rows)
    assert [r["ad"] for r in report.ordered_result(df).collect()] == [5, 6, 7, 8, 9]
    assert [r["ad"] for r in report.peek(df, 2, order=("ad",)).collect()] == [5, 6]
    assert report.peek(df, 3).count() == 3


def test_profile(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (2, "abcd")], "n long, t string")
    got = {r["column"]: r for r in profile.column_profile(df).collect()}
    assert (got["n"]["rows"], got["n"]["nulls"], got["n"]["min"], got["n"]["max"], got["n"]["distinct"]) == (3, 0, "1", "2", 2)
    assert (got["t"]["nulls"], got["t"]["avg_len"], got["t"]["max_len"]) == (1, 3.0, 4)
    empty = profile.column_profile(df.where("n > 5")).collect()
    assert [(r["rows"], r["min"], r["avg_len"]) for r in empty] == [(0, None, None)] * 2


