"""Jobs and tables kept in a catalog."""

import uuid

import pytest
from conftest import rows_of

from peerwatch.plans.jobs import run_bulk, run_hours, run_next_day
from peerwatch.schema import RESULT
from peerwatch.sources.logs import literal_rows
from peerwatch.sources.named import NamedResults, NamedTables, partitions




def result(spark, *rows):
    return literal_rows(spark, [("3", str(n), "some text", c, "0", "7", ad, bd) for n, c, ad, bd in rows], RESULT)


@pytest.fixture
def store(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS named_tests")
    return NamedResults(spark, f"named_tests.results_{uuid.uuid4().hex[:8]}").create()


def held(store):
    return rows_of(store.read(), "f02", "cnt", "ad", "bd")


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_batches_are_replaced_as_a_whole(spark, store, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        store.append(result(spark, (1, 5, 10, "a"), (1, 6, 10, "b"), (2, 7, 11, "a"), (3, 8, 12, "x/y z%1")))
        assert store.replace_batches(result(spark, (4, 9, 10, "b"), (5, 9, 13, "it's")), [10, 12, 13]) == {10, 12}
        assert held(store) == rows_of(result(spark, (2, 7, 11, "a"), (4, 9, 10, "b"), (5, 9, 13, "it's")), "f02", "cnt", "ad", "bd")
        # The same batch again, then without rows.
        store.replace_batches(result(spark, (4, 9, 10, "b"), (5, 9, 13, "it's")), [10, 13])
        assert len(held(store)) == 3
        assert store.replace_batch(result(spark), 13) and not store.replace_batch(result(spark), 14)
        assert rows_of(store.read(), "ad") == [(10,), (11,)]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == mode
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_buckets_without_a_value(spark, store):
    store.append(result(spark, (1, 5, 10, None), (2, 5, 11, None)))
    store.replace_batches(result(spark, (3, 6, 10, None)), [10])
    assert held(store) == [("2", 5, 11, None), ("3", 6, 10, None)]
    store.clear_batches([10])
    assert held(store) == [("2", 5, 11, None)]


def test_a_failure_between_the_steps_leaves_rows(spark, store, monkeypatch):
    store.append(result(spark, (1, 5, 10, "a"), (1, 6, 10, "b"), (2, 7, 11, "a")))
    before = held(store)
    with pytest.raises(Exception, match="not replaced"):
        store.replace_batches(result(spark, (9, 9, 77, "a")), [10])
    assert held(store) == before

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(NamedResults, "_drop", fail)
        with pytest.raises(OSError, match="lost"):
            store.replace_batches(result(spark, (4, 9, 10, "b"), (5, 9, 11, "c")), [10, 11])
    assert {ad for *_, ad, _ in held(store)} == {10, 11}
    store.replace_batches(result(spark, (4, 9, 10, "b"), (5, 9, 11, "c")), [10, 11])
    assert held(store) == [("4", 9, 10, "b"), ("5", 9, 11, "c")]


def test_jobs_do_not_grow_with_the_batches(spark, store):
    def jobs(batches):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, group)
        store.replace_batches(result(spark, *((1, 5, b, "a") for b in batches)), batches)
        store.clear_batches(batches)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(range(100, 140)) <= jobs(range(2)) + 1
    assert partitions(spark, store.table).count() == 0


def test_jobs_by_name(spark, make_log):
    rows = [{"f02": 7, "f04": p, "f31": 2023032300 + h, "f30": 2023032300 + h} for h in range(3) for p in range(12)]
    log = make_log(rows)
    tables = NamedTables(spark, "named_tests", f"t{uuid.uuid4().hex[:8]}_").create()
    with pytest.raises(LookupError, match="no batch"):
        run_next_day(tables, log, None)
    assert run_bulk(tables, log, None, (2023032200, 2023032301)).count() == 1
    run_next_day(tables, log, None)
    assert rows_of(tables.results.read(), "ad", "cnt") == [(2023032301, 12), (2023032302, 12), (2023032303, 12)]
    assert tables.read_latest().count() == 1 and tables.seen.read().count() == 1
    assert tables.batch_log.read().count() == 25
    # Run again with a threshold that nothing reaches: the batches are empty, the log holds each once.
    run_hours(tables, log, None, (2023032301, 2023032303), min_peers=99)
    assert rows_of(tables.results.read(), "ad") == [(2023032301,)] and tables.batch_log.read().count() == 25
    assert rows_of(tables.seen.read(), "f_date", "l_date") == [("2023-03-23-00", "2023-03-23-00")]
    assert tables.read_metrics().where("job = 'hours'").count() == 26


def test_tables_of_another_session_are_not_in_the_way(spark):
    """Another session left, or keeps, a table's folder in the warehouse; this session's catalog does not know it."""
    from peerwatch.plans import catalogue

    spark.sql("DROP DATABASE IF EXISTS peerwatch_check CASCADE")
    other = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/peerwatch_check.db/restart_results"
    spark.range(3).write.mode("overwrite").parquet(other)
    made = catalogue._named(spark, "restart").create()
    assert made.results.read().count() == 0
    made.results.append(result(spark, (1, 5, 10, "a")))
    assert held(made.results) == [("1", 5, 10, "a")]
    assert spark.read.parquet(other).count() == 3
