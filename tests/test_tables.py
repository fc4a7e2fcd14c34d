import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from peerwatch.functions import hours
from peerwatch.operators.detect import HOURLY, mass_senders
from peerwatch.plans.jobs import Tables, run_bulk, run_hours, run_next_day
from peerwatch.schema import BATCH, BATCH_LOG, EXCLUSION, RESULT, SEEN
from peerwatch.sources import catalog
from peerwatch.sources.batch_log import BatchLog
from peerwatch.sources.logs import empty, literal_rows, read_log, write_log
from peerwatch.sources.results import ResultStore
from peerwatch.sources.snapshots import Snapshot
from peerwatch.streaming.hourly import run_stream, stream_log


def batch(spark, *rows):
    """Batch rows from (sender, bucket, batch id)."""
    return literal_rows(spark, [("3", f02, "some long text", 11, bd, ad, "0", "7") for f02, bd, ad in rows], BATCH)


def stored(store):
    return rows_of(store.read(), "f02", "bd", "ad")


def test_empty_store_has_its_schema(spark, folder):
    store = ResultStore(spark, folder).create()
    assert store.read().schema.simpleString() == RESULT.simpleString()
    assert store.read().count() == 0


def test_replace_batch(spark, folder):
    store = ResultStore(spark, folder).create()
    store.append(batch(spark, ("x", "2024-01-01-00", 5)))
    store.replace_batch(batch(spark, ("a", "2024-01-01-00", 6), ("b", "2024-01-01-01", 6), ("c", None, 6)), 6)
    assert stored(store) == [
        ("a", "2024-01-01-00", 6), ("b", "2024-01-01-01", 6), ("c", None, 6), ("x", "2024-01-01-00", 5)
    ]
    store.replace_batch(batch(spark, ("d", "2024-01-01-01", 6)), 6)  # fewer, other bucket stale
    assert stored(store) == [("d", "2024-01-01-01", 6), ("x", "2024-01-01-00", 5)]
    store.replace_batch(batch(spark), 6)
    assert stored(store) == [("x", "2024-01-01-00", 5)]
    assert store.read().schema["ad"].dataType.simpleString() == "bigint"


def test_replace_batches_in_one_write(spark, folder):
    store = ResultStore(spark, folder).create()
    first = [("a", "2024-01-01-00", 6), ("b", "2024-01-01-01", 7), ("c", None, 7), ("d", "2024-01-01-05", 9)]
    store.replace_batches(batch(spark, *first[:3]), [6, 7, 8])
    store.append(batch(spark, first[3]))
    assert stored(store) == sorted(first, key=repr)
    store.replace_batches(batch(spark, ("e", "2024-01-01-01", 7)), [6, 7, 8])
    assert stored(store) == [("d", "2024-01-01-05", 9), ("e", "2024-01-01-01", 7)]
    store.replace_batches(batch(spark), [6, 7, 8])
    assert stored(store) == [("d", "2024-01-01-05", 9)]
    store.replace_batches(batch(spark, *first[:3]), [6, 7, 8])
    assert stored(store) == sorted(first, key=repr)
    store.clear_batches([7, 8])
    assert stored(store) == [first[0], first[3]]
    store.truncate()
    assert stored(store) == []


def test_a_failed_replacement_leaves_rows(spark, folder, monkeypatch):
    """Whatever step fails, every batch has its former or its new rows, and the next run leaves exactly the new ones."""
    store = ResultStore(spark, folder).create()
    old = spark.createDataFrame([("3", "1", "t", 5, "0", "7", ad, f"2023-{m}") for ad in (1, 2) for m in ("01%2", "02")], RESULT)
    new = old.where("bd = '2023-02'").withColumn("cnt", F.lit(9).cast("bigint"))
    store.replace_batches(old, [1, 2])
    for step in ("overwrite_partitions", "_remove"):
        with monkeypatch.context() as patch:
            patch.setattr(ResultStore, step, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                store.replace_batches(new, [1, 2])
        assert {r.ad for r in store.read().collect()} == {1, 2}
    assert store.replace_batches(new, [1, 2]) == {1, 2}
    assert sorted((r.ad, r.bd, r.cnt) for r in store.read().collect()) == [(1, "2023-02", 9), (2, "2023-02", 9)]


def test_clearing_runs_no_job(spark, folder):
    store = ResultStore(spark, folder).create()
    store.replace_batches(spark.createDataFrame([("3", "1", "t", 5, "0", "7", ad, None) for ad in range(5)], RESULT), range(5))
    spark.sparkContext.setJobGroup("clearing", "")
    store.clear_batches([0, 1, 2, 77])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("clearing")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs and sorted(r.ad for r in store.read().collect()) == [3, 4]
    assert store.filled(range(5)) == {3, 4}


def test_rows_of_another_batch_are_refused(spark, folder):
    store = ResultStore(spark, folder).create()
    with pytest.raises(Exception, match="batch that is not replaced"):
        store.replace_batches(batch(spark, ("a", "2024-01-01-00", 99)), [6, 7])
    assert stored(store) == []


def test_batch_log(spark, folder):
    log = BatchLog(spark, folder).create()
    assert log.read().schema.simpleString() == BATCH_LOG.simpleString()
    with pytest.raises(LookupError):
        log.last()
    log.append([2023032323, 2023032400])
    log.append([2023032400])
    assert log.last() == 2023032400
    log.append([999999999])  # shorter text, greater as text only
    assert log.last() == 2023032400


def test_snapshot_swap_reads_its_former_version(spark, folder):
    snapshot = Snapshot(spark, folder, SEEN).create()
    assert snapshot.read().count() == 0
    one = literal_rows(spark, [("3", "a", "x", "y", "0", "7")], SEEN)
    assert snapshot.swap(one) == 1
    assert snapshot.swap(snapshot.read().unionByName(one)) == 2
    assert snapshot.read().count() == 2
    with pytest.raises(Exception, match="no such thing"):
        snapshot.swap(one.withColumn("f02", F.raise_error(F.lit("no such thing")).cast("string")))
    assert snapshot.read().count() == 2  # a failed build changes nothing
    assert snapshot.swap(one) == 3  # and is built over
    assert snapshot.read().count() == 1
    snapshot.truncate()
    assert snapshot.read().count() == 0


def test_catalog_tables(spark):
    catalog.reset(spark, "check_db", ("results", "made", "live", "staged", "missing"))
    name = "check_db.results"
    catalog.create_result_table(spark, name)
    catalog.insert_partitions(batch(spark, ("a", "2024-01-01-00", 6), ("b", "2024-01-01-01", 7)), name)
    catalog.overwrite_batch(batch(spark, ("c", "2024-01-01-02", 6)), name, 6)
    got = lambda: rows_of(spark.table(name), "f02", "bd", "ad")
    assert got() == [("b", "2024-01-01-01", 7), ("c", "2024-01-01-02", 6)]
    catalog.clear_batches(spark, name, [6, 8])
    assert got() == [("b", "2024-01-01-01", 7)]
    catalog.create_table_as(spark.table(name), "check_db.staged")
    catalog.create_table_as(empty(spark, RESULT), "check_db.live")
    catalog.swap(spark, "check_db.staged", "check_db.live")
    assert spark.table("check_db.live").count() == 1
    catalog.truncate(spark, name)
    assert got() == []
    described = {r["col_name"] for r in catalog.analyze(spark, "check_db.live").collect()}
    assert "Statistics" in described


def test_bucketed_table_groups_without_a_shuffle(spark):
    catalog.reset(spark, "check_db", ("bucketed",))
    rows = spark.range(1000).selectExpr("id % 7 AS f02", "id AS f01")
    catalog.write_bucketed(rows, "check_db.bucketed", buckets=4)
    grouped = spark.table("check_db.bucketed").groupBy("f02").count()
    assert grouped.count() == 7
    from test_detect import plan_of

    assert "Exchange" not in plan_of(grouped)


def test_log_files(spark, make_log, folder):
    log = make_log([{"f01": 1679529600 + i, "f31": 2023032300 + i % 3, "f04": i} for i in range(60)])
    log = log.withColumn("cp", F.col("f31")).withColumn("ld", F.col("f31"))
    write_log(log.repartition(6), f"{folder}/a", files=2)
    write_log(log.repartition(6), f"{folder}/a", files=2)
    back = read_log(spark, f"{folder}/a")
    assert sorted(back.dtypes) == sorted(log.dtypes) and back.count() == 120
    from test_detect import plan_of

    plan = plan_of(back.where("f31 >= 2023032301 and f31 < 2023032302"))
    assert "PartitionFilters: [isnotnull(f31" in plan
    assert back.select(F.col("_metadata.file_path")).distinct().count() <= 12
    write_log(log.repartition(6), f"{folder}/b", partition_by=("f31",), rebalance=True)
    even = read_log(spark, f"{folder}/b")
    assert even.select(F.col("_metadata.file_path")).distinct().count() == 3
    assert rows_of(even, "f04", "f31", "cp") == rows_of(log, "f04", "f31", "cp")


def hourly_log(make_log, peers=lambda hour: 12):
    return make_log(
        [
            {"f02": n, "f04": p, "f31": 2023032300 + h, "f30": 2023032300 + h}
            for h in range(24)
            for n in (1, 2)
            for p in range(peers(h))
        ]
    )


def test_jobs_and_reruns(spark, make_log, folder):
    tables = Tables(spark, folder).create()
    log = hourly_log(make_log)
    listed = literal_rows(spark, [(2, "b")], EXCLUSION)
    with pytest.raises(LookupError):
        run_next_day(tables, log, listed)

    early = (2023032300, 2023032306)
    assert run_bulk(tables, log, listed, early).count() == 6
    assert tables.batch_log.last() == 2023032306
    run_bulk(tables, log, listed, early)
    assert tables.results.read().count() == 6

    out = run_next_day(tables, log, listed)
    assert sorted(r["ad"] for r in out.collect()) == hours.hourly_batch_ids(2023032306, 2023032400)
    assert tables.batch_log.last() == 2023032406  # hours without rows are finished, too
    assert tables.results.read().count() == 24
    assert rows_of(tables.latest.read(), "f02", "bd") == [("1", "2023-03-23-23")]
    assert rows_of(tables.seen.read(), "f02", "f_date", "l_date") == [("1", "2023-03-23-00", "2023-03-23-23")]

    window = (2023032306, 2023032406)
    fewer = hourly_log(make_log, lambda h: 12 if h < 8 else 3)
    assert run_hours(tables, fewer, listed, window, advance=False).count() == 2
    assert tables.results.read().count() == 8
    assert run_hours(tables, fewer.where("f02 = 2"), listed, window).count() == 0
    assert tables.results.read().count() == 6

    metrics = tables.read_metrics()
    bulk = metrics.where("job = 'bulk'").collect()
    assert [(r["batchId"], r["rows_in"], r["rows_out"]) for r in bulk] == [(2023032306, 144, 6)] * 2
    assert metrics.where("job = 'hours'").count() == 24 * 3
    assert metrics.where("job = 'latest'").count() == metrics.where("job = 'seen'").count() == 5
    assert tables.batch_log.read().groupBy("batchId").count().where("count > 1").isEmpty()
    assert rows_of(tables.latest.read(), "f02", "bd") == [("1", "2023-03-23-05")]
    assert rows_of(tables.seen.read(), "f02", "f_date", "l_date") == [("1", "2023-03-23-00", "2023-03-23-05")]
    assert metrics.where("millis < 0 or rows_out > rows_in").count() == 0


def test_stream_equals_the_batches(spark, make_log, folder):
    """Stopped and resumed between parts of the log; closed hours only."""
    log = hourly_log(make_log, lambda h: 5 + h % 12)
    listed = literal_rows(spark, [(2, "b")], EXCLUSION)
    for part in ("f31 < 2023032309", "f31 >= 2023032309 AND f31 < 2023032315", "f31 >= 2023032315"):
        write_log(log.where(part).unionByName(log.where(part)), f"{folder}/log", partition_by=())
        stream = stream_log(spark, f"{folder}/log")
        run_stream(stream, listed, f"{folder}/out", f"{folder}/progress", files_per_hour=2).awaitTermination()
    want = mass_senders(log, listed, (2023032300, 2023032400), batch_ids=HOURLY).where("ad < 2023032400")
    got = ResultStore(spark, f"{folder}/out").read().select(*BATCH.names)
    assert rows_of(got) == rows_of(want) and got.count() > 5


def test_swap_by_name_keeps_the_live_table(spark):
    catalog.use_database(spark, "peerwatch_swap")
    catalog.reset(spark, "peerwatch_swap", ("live", "staged", "live_replaced"))
    live, staged = "peerwatch_swap.live", "peerwatch_swap.staged"
    catalog.create_table_as(spark.range(3), live)
    with pytest.raises(LookupError):
        catalog.swap(spark, staged, live)
    assert spark.table(live).count() == 3
    # A swap that ended between its two renames is put right by the next one.
    spark.sql(f"ALTER TABLE {live} RENAME TO {live}_replaced")
    catalog.create_table_as(spark.range(5), staged)
    catalog.swap(spark, staged, live)
    assert spark.table(live).count() == 5 and not spark.catalog.tableExists(f"{live}_replaced")


def test_histograms(spark):
    """Equal shares of the rows, also with a value that holds a third of them; the session's settings come back."""
    catalog.use_database(spark, "peerwatch_histograms")
    name = "peerwatch_histograms.h"
    catalog.create_table_as(spark.range(3000).selectExpr("if(id < 1000, 0, id) AS a", "id AS b"), name)
    before = spark.conf.get("spark.sql.statistics.histogram.numBins")
    got = {(r.column, r.bin): (r.lower, r.upper) for r in catalog.histograms(spark, name, ["a", "b"], 6).collect()}
    assert len(got) == 12 and got["a", 0] == (0.0, 0.0)
    for i in range(6):
        assert abs(got["b", i][1] - 500 * (i + 1)) <= 5
    assert spark.conf.get("spark.sql.statistics.histogram.numBins") == before
    catalog.reset(spark, "peerwatch_histograms", ["h"])


def test_escaped_buckets_store_no_row_per_group_with_texts(spark, folder, monkeypatch):
    """Where nearly every row is a group, groups are told by their sizes first, with the same result."""
    from peerwatch.operators import detect
    from peerwatch.plans import catalogue

    days = [f"1998-01-{d:02d}" for d in range(1, 10)]
    items = [(1, order, days[0]) for order in range(12)] + [(2, order, days[order % 9]) for order in range(18)] + [(None, 5, days[0])]
    spark.createDataFrame([(s, o, d) for s, o, d in items], "l_suppkey int, l_orderkey int, l_shipdate string").selectExpr(
        "l_suppkey", "l_orderkey", "cast(l_shipdate as date) l_shipdate"
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, "Supplier#001", 2000.0), (2, "Supplier#002", 2000.0)], "s_suppkey int, s_name string, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(1, "view", 7, "2024-01-02 03:00:00")], "event_id int, event_type string, user_id int, ts string").write.parquet(
        f"{folder}/events.parquet"
    )
    counted, plain = [], detect.count_peers

    def count_peers(rows, keys, **more):
        counted.append(rows.count())
        return plain(rows, keys, **more)

    stored, replace = [], ResultStore.replace_batches

    def replace_batches(self, rows, batch_ids):
        replaced = replace(self, rows, batch_ids)
        stored.append(rows_of(self.read_batches(batch_ids), "f02", "cnt", "bd"))
        return replaced

    monkeypatch.setattr(detect, "count_peers", count_peers)
    monkeypatch.setattr(ResultStore, "replace_batches", replace_batches)
    assert catalogue.replace_escaped_buckets(spark, folder).count() == 0
    assert stored == [[("1", 12, "1998/01/01 00:00")], []]
    # The daily batch counts its one event; of the line items only the rows of the one large group are counted.
    assert counted[1:] == [12, 0]
