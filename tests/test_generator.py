from conftest import rows_of
from pyspark.sql import functions as F

from peerwatch.operators.detect import mass_senders
from peerwatch.operators.sample import build_exclusion
from peerwatch.plans.load import BaseTables, run_load
from peerwatch.schema import EXCLUSION, LOG
from peerwatch.sources.generator import (
    FIRST_NUMBER,
    NUMBERS,
    PLANTED_FIRST,
    PLANTED_TEXT,
    SHORT_TEXTS,
    LogPlan,
    generate_log,
    noise_log,
    planted_log,
    row_ids,
)

END = 1_679_616_000  # 2023-03-24 00:00 UTC
PLAN = LogPlan(start=END - 86_400, end=END, rounds=5, batch_rows=2000, seed=1)
KEEP = (19_218_983_880, 19_218_983_890)


def test_plan_sizes():
    plan = LogPlan.for_size(1, end=END)
    assert (plan.rounds, plan.noise_rows, plan.planted_rows) == (41, 4_100_000, 410_000)
    assert plan.end - plan.start == 7 * 86_400
    assert LogPlan.for_size(1, end=END, debug=True).rounds == 2
    assert LogPlan.for_size(100_000, end=END).rounds == 4_096_000
    assert LogPlan.for_size(1, end=END, batch_rows=15).planted_batch == 2


def test_noise(spark):
    rows = noise_log(spark.range(PLAN.noise_rows), PLAN)
    assert rows.schema.simpleString() == LOG.simpleString()
    facts = rows.agg(
        F.min("f01"), F.max("f01"), F.min("f02"), F.max("f04"), F.min("f14"), F.max("f14"), F.min("f22"), F.max("f22"),
        F.min("f06"), F.max("f19"), F.count_distinct("f06"), F.count_distinct("f22"), F.count_distinct("f14"),
        F.count_distinct("cp"),
    ).first()
    assert END - 86_400 <= facts[0] and facts[1] < END
    assert FIRST_NUMBER <= facts[2] and facts[3] < FIRST_NUMBER + NUMBERS
    assert tuple(facts[4:13]) == (48, 50, 1, 9, 0, 9, 10, 9, 3) and facts[13] == 24
    odd = [~F.col(c).rlike("^[a-zA-Z0-9]{10}$") for c in SHORT_TEXTS]
    for test in odd:
        assert rows.where(test).isEmpty()
    assert rows.where("cp <> ld OR f30 <> f31 OR f30 IS NULL").isEmpty()
    lengths = rows.groupBy(F.floor((F.col("f01") - PLAN.start) / (86_400 / 5))).agg(
        F.count_distinct(F.length("f16")).alias("n"), F.min(F.length("f16")).alias("lo"), F.max(F.length("f16")).alias("hi")
    )
    assert all(r["n"] == 1 and 2 <= r["lo"] <= r["hi"] <= 30 for r in lengths.collect())


def test_rows_do_not_depend_on_partitions(spark):
    one = noise_log(spark.range(0, 3000, 1, 1), PLAN)
    many = noise_log(spark.range(0, 3000, 1, 11), PLAN)
    assert one.exceptAll(many).isEmpty()
    other = LogPlan(PLAN.start, PLAN.end, PLAN.rounds, PLAN.batch_rows, seed=2)
    assert noise_log(spark.range(3000), other).join(one, ["f02", "f04", "f03"]).isEmpty()


def test_planted_rows_are_found(spark):
    log = generate_log(spark, PLAN)
    assert log.count() == 11_000
    planted = planted_log(spark.range(PLAN.planted_rows), PLAN)
    assert planted.where(f"f02 < {PLANTED_FIRST} OR f02 >= {PLANTED_FIRST + 10}").isEmpty()
    listed = build_exclusion(log, 5000, keep_out=KEEP, seed=1)
    assert listed.schema.simpleString() == EXCLUSION.simpleString() and listed.count() == 5000
    assert listed.where(f"id BETWEEN {KEEP[0]} AND {KEEP[1]}").isEmpty()
    found = mass_senders(log, listed, (2023032300, 2023032400), min_peers=2)
    assert rows_of(found.select("f16", "f06", "f07", "f22").distinct()) == [(PLANTED_TEXT, "0", "7", "3")]
    assert found.select("f02").distinct().count() == 10
    want = planted.groupBy("f02", "f30").agg(F.count_distinct("f04").alias("n")).where("n > 2").count()
    assert found.count() == want


def test_tasks_grow_with_the_rows(spark):
    plan = LogPlan.for_size(100 * 1024, end=END)
    assert 100_000 <= row_ids(spark, plan.noise_rows).rdd.getNumPartitions() <= 110_000
    assert row_ids(spark, 100).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_older_form(spark):
    """Text hours; one first and last hour for the noise of a round, hours and codes of their own for planted rows."""
    plan = LogPlan(start=END - 86_400, end=END, rounds=4, batch_rows=400, seed=1, older=True)
    noise = noise_log(spark.range(plan.noise_rows), plan)
    assert [noise.schema[c].dataType.simpleString() for c in ("f30", "f31", "cp", "ld", "f14")] == ["string"] * 4 + ["bigint"]
    assert rows_of(noise.select("f30", "f31").distinct()) == [
        ("2023032300", "2023032306"), ("2023032306", "2023032312"), ("2023032312", "2023032318"), ("2023032318", "2023032400"),
    ]
    assert noise.where("cp < f30 OR cp >= f31").isEmpty()
    planted = planted_log(spark.range(plan.planted_rows), plan)
    assert {r.f14 for r in planted.select("f14").distinct().collect()} == {48, 49, 50}
    assert planted.where("f30 <> f31").count() > 50
    newer = planted_log(spark.range(plan.planted_rows), LogPlan(plan.start, plan.end, 4, 400, seed=1))
    assert rows_of(newer.select("f01", "f02", "f04")) == rows_of(planted.select("f01", "f02", "f04"))
    found = mass_senders(planted, None, (2023032300, 2023032400), min_peers=1)
    assert {r.f16 for r in found.collect()} == {PLANTED_TEXT}


def test_load_job(spark):
    base = BaseTables(spark, "peerwatch_load_test")
    for times in (1, 2):
        described = run_load(base, PLAN, listed=500, drop=times == 1, file_rows=100)
        assert base.read_log().count() == 11_000 * times and base.read_exclusion().count() == 500
        line = described[base.log].where("col_name = 'Statistics'").first()["data_type"]
        assert f"{11_000 * times} rows" in line
    again = generate_log(spark, PLAN)
    assert base.read_log().select(*again.columns).distinct().exceptAll(again.distinct()).isEmpty()
    assert base.read_exclusion().where(F.col("id").between(*KEEP)).isEmpty()
    base.reset()
    assert not spark.catalog.tableExists(base.log)


def _sorts(spark, table, rows):
    """Whether an insert of rows into a table sorts them, as its plan says."""
    rows.createOrReplaceTempView("to_insert")
    return "Sort [" in spark.sql(f"EXPLAIN INSERT INTO {table} SELECT * FROM to_insert").first()[0]


def test_partitioned_writes_need_no_sort(spark, folder, monkeypatch):
    """A sort of all rows by hour would spill them; writers of few hours are kept open instead."""
    from pyspark.sql import DataFrameWriter

    from peerwatch.sources import catalog
    from peerwatch.sources.logs import read_log, write_log

    catalog.use_database(spark, "sort_tests")
    plan = LogPlan.for_size(0.002, end=1_679_616_000, days=1, batch_rows=400, seed=3)
    rows = generate_log(spark, plan)
    catalog.create_table(spark, "sort_tests.log", rows.schema, ("f31",))
    columns = spark.table("sort_tests.log").columns
    assert _sorts(spark, "sort_tests.log", rows.select(*columns))
    found = []

    def watched(name):
        kept = getattr(DataFrameWriter, name)

        def write(self, *given, **more):
            if "f31" in self._df.columns:
                found.append(_sorts(spark, "sort_tests.log", self._df.select(*columns)))
            return kept(self, *given, **more)

        monkeypatch.setattr(type(rows.write), name, write)

    watched("insertInto")
    watched("orc")
    base = BaseTables(spark, "sort_tests", "load_")
    run_load(base, plan, listed=5, drop=True)
    write_log(rows, folder)
    assert found == [False, False]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    expected = sorted(map(tuple, rows.select("f31", "f01", "f02", "f16").collect()))
    for read in (base.read_log(), read_log(spark, folder)):
        assert sorted(map(tuple, read.select("f31", "f01", "f02", "f16").collect())) == expected
    # More partitions than files kept open: the rest is sorted, nothing is lost.
    many = f"{folder}-many"
    write_log(rows.coalesce(1), many)
    assert read_log(spark, many).select("f31").distinct().count() == 24 > 16
    assert sorted(map(tuple, read_log(spark, many).select("f31", "f01", "f02", "f16").collect())) == expected
