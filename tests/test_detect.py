import random
import re
from collections import defaultdict

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from test_functions import by_steps

from peerwatch.functions import hours
from peerwatch.operators.detect import HOURLY, count_peers, mass_senders
from peerwatch.operators.exclusion import without_listed
from peerwatch.plans.jobs import mass_senders_in_two_steps
from peerwatch.schema import BATCH, EXCLUSION
from peerwatch.sources.logs import literal_rows, read_log, write_log

DAY = (2023032300, 2023032400)


def test_threshold_and_null_peers(make_log):
    log = make_log(
        [{"f02": 5, "f04": p} for p in list(range(10)) + [1, 1, None]]  # ten peers: not enough
        + [{"f02": 6, "f04": p} for p in list(range(11)) + [3]]
    )
    got = mass_senders(log, None, DAY)
    assert got.schema.simpleString() == BATCH.simpleString()
    assert rows_of(got) == [("3", "6", "hello big world", 11, "2023-03-23-01", 2023032400, "0", "7")]


def test_window_code_and_length(make_log):
    def sender(n, **row):
        return [{"f02": n, "f04": p, **row} for p in range(12)]

    log = make_log(
        sender(1, f31=2023032300)  # lower bound: in
        + sender(2, f31=2023032400)  # upper bound: out
        + sender(3, f14=48)
        + sender(4, f14=50)
        + sender(5, f16="  1234567890  ")  # ten characters once clean
        + sender(6, f16="12345678901")
        + sender(7, f16="a00000000000000b")  # long only before cleaning
        + sender(8, f16=None)
        + sender(9, f30=2023139999, f31=2023032305)  # no hour: no bucket
        + sender(None)
    )
    got = rows_of(mass_senders(log, None, DAY), "f02", "f16", "bd")
    assert got == [
        ("1", "hello big world", "2023-03-23-00"),
        ("6", "12345678901", "2023-03-23-01"),
        ("9", "hello big world", None),
    ]


def test_texts_are_grouped_once_clean(make_log):
    log = make_log([{"f04": p, "f16": t} for p, t in enumerate(["  win 100?? now! ", "win 10? now!", "win 1000?\tnow!"] * 4)])
    got = rows_of(mass_senders(log, None, DAY), "f16", "cnt")
    assert got == [("win 10? now!", 12)]


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_exclusion_list_with_nulls_and_repeats(spark, make_log, broadcast):
    log = make_log([{"f02": n, "f04": p} for n in (1, 2, 3) for p in range(12)])
    listed = literal_rows(spark, [(2, "b"), (2, "b"), (None, "x"), (77, "y")], EXCLUSION)
    got = rows_of(mass_senders(log, listed, DAY, broadcast=broadcast), "f02")
    assert got == [("1",), ("3",)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_text_numbers(spark, broadcast):
    schema = StructType([StructField("f02", StringType()), StructField("n", LongType())])
    rows = literal_rows(spark, [("2", 1), (" 2", 2), ("x2", 3), ("", 4), (None, 5), ("3", 6)], schema)
    listed = literal_rows(spark, [(2, "b"), (None, "x")], EXCLUSION)
    assert rows_of(without_listed(rows, listed, "f02", broadcast=broadcast), "n") == [(3,), (4,), (5,), (6,)]


def test_older_logs_with_text_hours(make_log):
    log = make_log([{"f02": 1, "f04": p, "f31": 2023032300 + p} for p in range(14)])
    older = log.withColumn("f30", F.col("f30").cast("string")).withColumn("f31", F.col("f31").cast("string"))
    older = older.withColumn("f14", F.col("f14").cast("string"))
    for form in (hours.BUCKET_DAY, hours.BUCKET_HOUR, "yyyy"):
        want = rows_of(mass_senders(log, None, DAY, bucket_format=form, min_peers=0))
        assert rows_of(mass_senders(older, None, DAY, bucket_format=form, min_peers=0)) == want


def brute(rows, listed, window, ad, peers):
    groups = defaultdict(set)
    for r in rows:
        if r["f14"] != 49 or not window[0] <= r["f31"] < window[1] or r["f02"] is None or r["f02"] in listed:
            continue
        message = by_steps(r["f16"])
        if message is None or len(message) <= 10:
            continue
        groups[(r["f22"], r["f02"], message, r["f30"], ad(r["f31"]), r["f06"], r["f07"])].add(r["f04"])
    return {k: len(v - {None}) for k, v in groups.items() if len(v - {None}) > peers}


def random_rows(seed, n, days=("20230228", "20230301"), bad=0.02):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        hour = lambda: int(draw.choice(days) + f"{draw.randint(0, 99 if draw.random() < bad else 23):02d}")
        rows.append(
            {
                # one sender holds a third of all rows
                "f02": 1 if draw.random() < 0.34 else draw.choice([2, 3, 4, 5, None]),
                "f04": draw.choice([None, *range(40)]),
                "f06": draw.randint(0, 1),
                "f07": 7,
                "f14": draw.choice([48, 49, 49, 50]),
                "f16": draw.choice(["  aaa 000 bbb?? ", "aaa 0 bbb?", "aaa\t00 bbb? more", "short", None, "c" * 11]),
                "f22": draw.randint(1, 2),
                "f30": hour(),
                "f31": hour(),
            }
        )
    return rows


@pytest.mark.parametrize("broadcast", [True, False])
def test_against_brute_force(spark, make_log, broadcast):
    rows = random_rows(3, 6000, bad=0)
    window, listed = (2023022805, 2023030120), literal_rows(spark, [(3, "c")], EXCLUSION)
    got = mass_senders(make_log(rows), listed, window, min_peers=1, broadcast=broadcast)
    want = brute(rows, {3}, window, lambda _: window[1], 1)
    have = {
        (int(r["f22"]), int(r["f02"]), r["f16"], int(r["bd"].replace("-", "")), r["ad"], int(r["f06"]), int(r["f07"])): r["cnt"]
        for r in got.collect()
    }
    assert have == want and len(want) > 100


def test_one_pass_equals_single_hours(make_log):
    """Across a month's end, and with hours that do not exist."""
    log = make_log(random_rows(4, 6000, bad=0.1))
    log.persist()
    window = (2023022800, 2023030200)
    one_pass = rows_of(mass_senders(log, None, window, batch_ids=HOURLY, min_peers=0))
    single = []
    for start, end in zip(hours.hours_between(*window), hours.hourly_batch_ids(*window)):
        single += rows_of(mass_senders(log, None, (start, end), min_peers=0))
    log.unpersist()
    assert one_pass == sorted(single, key=repr) and len(one_pass) > 100


def test_two_steps_equal_one(spark, make_log):
    log = make_log(random_rows(6, 6000, bad=0.1)).persist()
    listed = literal_rows(spark, [(3, "c")], EXCLUSION)
    window = (2023022800, 2023030200)
    for peers, batch_ids in ((1, HOURLY), (3, None), (0, 5), (10_000, None)):
        options = {"min_peers": peers, "batch_ids": batch_ids, "bucket_format": hours.BUCKET_DAY}
        direct = rows_of(mass_senders(log, listed, window, **options))
        assert rows_of(mass_senders_in_two_steps(log, listed, window, **options)) == direct
        assert bool(direct) == (peers < 10_000)
    log.unpersist()


def test_sketch_is_close(spark):
    rows = spark.range(40_000).select((F.col("id") % 4).alias("g"), F.col("id").alias("f04"))
    for r in count_peers(rows, ["g"], approximate=0.02).collect():
        assert abs(r["cnt"] - 10_000) < 1_000


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_plan_of_a_long_list(spark, make_log, folder):
    """Stored log: filters reach the files, nine columns are read, the list
    meets the few groups left and nothing runs in Python."""
    write_log(make_log([{"f04": p} for p in range(20)]), folder, partition_by=("f31",))
    listed = literal_rows(spark, [(9, "z")], EXCLUSION)
    plan = plan_of(mass_senders(read_log(spark, folder), listed, DAY, broadcast=False))
    assert "PartitionFilters: [isnotnull(f31" in plan
    assert "EqualTo(f14,49)" in plan and "IsNotNull(f02)" in plan
    read = [line for line in plan.splitlines() if line.startswith("ReadSchema") and "f16" in line]
    assert len(read) == 1
    assert "f03" not in read[0] and "f25" not in read[0]
    tree = plan[: plan.index("\n\n\n")] if "\n\n\n" in plan else plan
    assert "LeftAnti" in tree and "Python" not in plan
    assert tree.index("LeftAnti") < tree.index("HashAggregate")


def test_plan_normalises_once_and_compiles(spark, make_log, folder):
    """One matcher per row, and no generated method that the JVM leaves to its interpreter (8,000 bytes)."""
    write_log(make_log([{}]), folder)
    log = read_log(spark, folder)
    for options in ({"batch_ids": HOURLY}, {}, {"bucket_format": hours.BUCKET_DAY}):
        found = mass_senders(log, literal_rows(spark, [(5, "n")], EXCLUSION), (2023032300, 2023032400), **options)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace") == 1
        found.createOrReplaceTempView("generated")
        adaptive = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            text = spark.sql("EXPLAIN CODEGEN SELECT * FROM generated").first()[0]
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 6500
