"""Joins that do not shuffle the log, look-ups that read little of it, streams that lose none of it."""

import pytest
from pyspark.sql import functions as F

from peerwatch.operators.exclusion import listed_words, split_by_words, without_listed, without_listed_split
from peerwatch.plans import catalogue
from peerwatch.sources import catalog
from peerwatch.sources.logs import sender_history, write_log
from peerwatch.streaming.complete import CompleteHours

SCHEMA = "f02 string, f04 bigint, id bigint, _word string"


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def long_list(spark):
    return spark.range(1_000, 21_000).select(F.col("id"), F.lit("n").alias("name"))


def test_split_lets_most_rows_pass(spark, long_list):
    df = spark.range(200_000).select((F.col("id") * 7 + 500_000).alias("f02"))
    words = 20_000 // 5
    passed, open_rows = split_by_words(df, "f02", listed_words(long_list, words), words)
    assert passed.count() + open_rows.count() == 200_000 and open_rows.count() < 200_000 * 0.05
    assert listed_words(long_list, words).count() <= words


@pytest.mark.parametrize("words", [None, 1, 3, 1 << 16])
def test_split_is_exact(spark, long_list, words):
    rows = [(str(n), n % 5, n, None) for n in range(990, 1_100)] + [(None, 1, 1, "x"), ("", 1, 1, "x"), ("12x", 2, 2, None), ("1000", 9, 9, "again")] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    listed = long_list.union(spark.createDataFrame([(None, "null"), (1_000, "again")], "id bigint, name string"))
    got = without_listed_split(df, listed, "f02", words=words)
    want = without_listed(df, listed, "f02", broadcast=True)
    assert got.dtypes == df.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.count() == 10 + 9


def test_split_with_an_empty_side(spark, long_list):
    df = spark.createDataFrame([("1000", 1, 1, None), (None, 1, 1, None)], SCHEMA)
    assert without_listed_split(df, long_list.limit(0), "f02").count() == 2
    assert without_listed_split(df.limit(0), long_list, "f02").count() == 0


def test_only_open_rows_are_shuffled(spark, long_list):
    df = spark.range(100_000).select((F.col("id") * 7 + 900).alias("f02"))
    plan = plan_of(without_listed_split(df, long_list, "f02"))
    first, second = plan[: plan.index("Union")], plan[plan.index("Union") :]
    assert "Exchange hashpartitioning" not in first
    branch = second.split("LeftAnti")
    # The branch of rows that pass holds a broadcast join alone.
    assert "Exchange hashpartitioning" not in branch[1].split("BroadcastExchange")[0]


DATA = "/root/testdata/sf0.001"


def test_co_bucketed_join_shuffles_nothing(spark):
    for query in (catalogue.anti_join_bucketed, catalogue.latest_bucketed):
        assert "Exchange hashpartitioning" not in plan_of(query(spark, DATA))


def test_tables_not_bucketed_alike_are_an_error(spark):
    log, listed = catalogue._co_bucketed(spark, DATA, "other")
    with pytest.raises(ValueError, match="not bucketed by f04"):
        catalog.without_listed_by_bucket(spark, log, listed, key="f04")
    spark.sql(f"DROP TABLE {listed}")
    catalog.write_bucketed(spark.range(5).toDF("id"), listed, buckets=4, key="id", sort="id")
    with pytest.raises(ValueError, match="numbers of buckets"):
        catalog.without_listed_by_bucket(spark, log, listed)


def rows_scanned(df) -> int:
    """What the scan gave out, from its own metric."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_sender_history_reads_few_rows(spark, folder):
    rows = spark.range(200_000).select(
        F.pmod(F.xxhash64("id"), F.lit(5_000)).alias("f02"), F.col("id").alias("f04"), F.lit(2024010100).cast("bigint").alias("f31")
    )
    write_log(rows, f"{folder}/sorted", sort_by=("f02",), look_up=("f02",), files=1)
    write_log(rows, f"{folder}/plain", files=1)
    schema = "f02 bigint, f04 bigint, f31 bigint"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = {k: sender_history(spark.read.schema(schema).orc(f"{folder}/{k}"), [77, 10**9], (2024010100, 2024010101)) for k in ("sorted", "plain")}
        scanned = {k: rows_scanned(df) for k, df in found.items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(found["sorted"].collect()) == sorted(found["plain"].collect()) and found["sorted"].count() == rows.where("f02 = 77").count()
    assert scanned["plain"] == 200_000 and scanned["sorted"] <= 20_000


LOG_COLUMNS = "f02 bigint, f04 bigint, f06 bigint, f07 bigint, f14 bigint, f16 string, f22 bigint, f30 bigint, f31 bigint"


def messages(spark, rows):
    return spark.createDataFrame([(s, p, 0, 7, 49, "some long enough text", 3, h, h) for s, p, h in rows], LOG_COLUMNS)


def test_micro_batches_count_once_and_late_rows_count(spark, folder):
    found = CompleteHours(spark, f"{folder}/complete").create()
    publish = lambda until: found.publish(None, until, min_peers=2)
    counts = lambda: {(r.f02, r.ad): r.cnt for r in found.results.read().collect()}
    assert publish(2024010105) == [] and found.close(None) == []
    first = messages(spark, [(1, p, 2024010100) for p in range(3)] + [(2, 1, 2024010100), (3, 1, 2024010102)])
    found.keep(first, 0)
    found.keep(first, 0)  # a failed attempt's rows are replaced
    assert publish(2024010101) == [2024010101] and counts() == {("1", 2024010101): 3}
    # Two peers of sender 2 come late, one of sender 1 again.
    found.keep(messages(spark, [(2, 2, 2024010100), (2, 3, 2024010100), (1, 1, 2024010100)]), 1)
    assert [(r.ad, r.rows) for r in found.late().collect()] == [(2024010101, 3)]
    assert publish(2024010101) == [2024010101]
    assert counts() == {("1", 2024010101): 3, ("2", 2024010101): 3}
    assert publish(2024010101) == []
    found.keep(messages(spark, [(3, 2, 2024010102), (3, 3, 2024010102)]), 2)
    found.keep(messages(spark, []), 3)
    assert counts().keys() == {("1", 2024010101), ("2", 2024010101)}
    assert found.close(None, min_peers=2) == [2024010103] and counts()[("3", 2024010103)] == 3
    assert found.close(None, min_peers=2) == []


def test_a_failed_publish_is_mended_by_the_next(spark, folder, monkeypatch):
    found = CompleteHours(spark, f"{folder}/failing").create()
    found.keep(messages(spark, [(1, p, 2024010100) for p in range(3)]), 0)

    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as broken:
        broken.setattr(found.results, "overwrite_partitions", fail)
        with pytest.raises(OSError, match="no space"):
            found.publish(None, 2024010101, min_peers=2)
    assert found.results.read().count() == 0
    assert found.publish(None, 2024010101, min_peers=2) == [2024010101]
    assert found.results.read().count() == 1
