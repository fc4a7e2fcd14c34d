"""Named queries over the driver's tables, one or more per operator.

Every query reads whole tables.  Those that show a table operation write
below the session's shared working folder and return what is read back.
"""

from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerwatch.functions import hours
from peerwatch.functions.text import (
    clean_text as cleaned,
    is_filled,
    squeeze_blanks,
    squeeze_question_marks,
    squeeze_zeros,
    trimmed,
)
from peerwatch.operators import derived, filters, profile, report, sample
from peerwatch.operators.detect import HOURLY, count_peers, mass_senders, merged_peers, peer_sketches, sketch_error
from peerwatch.operators.exclusion import without_listed, without_listed_split
from peerwatch.plans.jobs import Tables, mass_senders_in_two_steps, run_bulk, run_hours, run_next_day
from peerwatch.plans.load import BaseTables, run_load
from peerwatch.schema import BATCH, EXCLUSION, LATEST, RESULT
from peerwatch.session import remove_folder, work_folder
from peerwatch.sources import catalog
from peerwatch.sources.adapters import event_exclusion, event_log, order_exclusion, order_log, table
from peerwatch.sources.batch_log import BatchLog, last_batch
from peerwatch.sources.generator import PLANTED_FIRST, PLANTED_NUMBERS, PLANTED_TEXT, LogPlan, generate_log, noise_log, planted_log
from peerwatch.sources.logs import read_log, read_table, sender_history, write_log, write_table
from peerwatch.sources.named import NamedResults, NamedTables
from peerwatch.sources.partials import PeerPartials
from peerwatch.sources.results import ResultStore
from peerwatch.sources.snapshots import Snapshot
from peerwatch.streaming.complete import CompleteHours
from peerwatch.streaming.hourly import run_stream, stream_log

# The line items ship from 1995 to 2001, the events happen in January 2024.
ORDERS = (1995010100, 2002010100)
ORDERS_SPLIT = 1998070100
EVENTS = (2024010100, 2024013100)
EVENTS_SPLIT = 2024013000

# Six hours from 2023-03-23 00:00 UTC; one round per 500 ids and hour.
PLAN = LogPlan(start=1_679_529_600, end=1_679_551_200, rounds=6, batch_rows=500, seed=7)


# --- batches ------------------------------------------------------------------


def bulk_batch(spark, folder, window=ORDERS, **options) -> DataFrame:
    options.setdefault("bucket_format", hours.BUCKET_MONTH)
    return mass_senders(order_log(spark, folder), order_exclusion(spark, folder), window, **options)


def bulk_batch_long_list(spark, folder) -> DataFrame:
    """The same answer with the list joined by shuffle, after the threshold."""
    return bulk_batch(spark, folder, broadcast=False)


def bulk_batch_two_steps(spark, folder) -> DataFrame:
    """The same answer after a count of the rows of every group."""
    return mass_senders_in_two_steps(
        order_log(spark, folder), order_exclusion(spark, folder), ORDERS, bucket_format=hours.BUCKET_MONTH
    )


def bulk_batch_two_steps_shuffled(spark, folder) -> DataFrame:
    """The same with more candidates than may be broadcast."""
    return mass_senders_in_two_steps(
        order_log(spark, folder),
        order_exclusion(spark, folder),
        ORDERS,
        bucket_format=hours.BUCKET_MONTH,
        broadcast_limit=0,
    )


def daily_batch(spark, folder, window=EVENTS) -> DataFrame:
    log = event_log(spark, folder)
    return mass_senders(log, event_exclusion(spark, folder), window, bucket_format=hours.BUCKET_DAY)


def hourly_batches(spark, folder) -> DataFrame:
    return mass_senders(
        event_log(spark, folder),
        event_exclusion(spark, folder),
        EVENTS,
        batch_ids=HOURLY,
        min_peers=1,
    )


def bulk_from_hours(spark, folder) -> DataFrame:
    """The answer of ``bulk_batch`` from stored hours; the log is not read again."""
    log = order_log(spark, folder)
    stored = PeerPartials(spark, work_folder(spark), bucket_format=hours.BUCKET_MONTH, log_schema=log.schema).create()
    stored.add(log, ORDERS)
    return stored.mass_senders(order_exclusion(spark, folder), ORDERS)


def hourly_from_hours(spark, folder) -> DataFrame:
    """The hourly batches from stored hours, the last day of which is added twice."""
    log = event_log(spark, folder)
    stored = PeerPartials(spark, work_folder(spark), log_schema=log.schema).create()
    stored.add(log, EVENTS)
    stored.add(log, (EVENTS_SPLIT, EVENTS[1]))
    return stored.mass_senders(event_exclusion(spark, folder), EVENTS, batch_ids=HOURLY, min_peers=1)


def batch_view(spark, folder) -> DataFrame:
    """The batch as a temporary view, read with SQL."""
    bulk_batch(spark, folder).createOrReplaceTempView("batch_view")
    return spark.sql("SELECT * FROM batch_view")


def peer_count(spark, folder) -> DataFrame:
    log = order_log(spark, folder).withColumn("bd", hours.bucket_text("f31", hours.BUCKET_MONTH))
    return count_peers(log, ("f02", "bd"))


#: Relative error of the sketches.
SKETCH_ERROR = 0.02


def _near(exact, sketched) -> DataFrame:
    """Whether the sketched count of each group is within four standard errors of the exact one (and half a peer, as it is rounded)."""
    both = exact.join(sketched.withColumnRenamed("cnt", "sketch"), ["f02", "bd"])
    bound = 0.5 + 4 * sketch_error(SKETCH_ERROR) * F.col("cnt")
    return both.select("f02", "bd", (F.abs(F.col("sketch") - F.col("cnt")) <= bound).alias("near"))


def peer_count_sketch(spark, folder) -> DataFrame:
    log = order_log(spark, folder).withColumn("bd", hours.bucket_text("f31", hours.BUCKET_MONTH))
    return _near(count_peers(log, ("f02", "bd")), count_peers(log, ("f02", "bd"), approximate=SKETCH_ERROR))


def peer_count_merged(spark, folder) -> DataFrame:
    """Sketches of every hour, stored as a table, merged to months without reading the log again."""
    path = work_folder(spark)
    log = order_log(spark, folder)
    peer_sketches(log, ("f02", "f31"), error=SKETCH_ERROR).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("bd", hours.bucket_text("f31", hours.BUCKET_MONTH))
    exact = count_peers(log.withColumn("bd", hours.bucket_text("f31", hours.BUCKET_MONTH)), ("f02", "bd"))
    return _near(exact, merged_peers(stored, ("f02", "bd")))


# --- rows, predicates, functions ------------------------------------------------


def clean_text(spark, folder) -> DataFrame:
    padded = F.concat(F.lit("  ?? "), F.col("text"), F.lit(" 100  \t? "))
    return table(spark, folder, "documents").select("doc_id", cleaned(padded).alias("clean"))


def squeeze_runs(spark, folder) -> DataFrame:
    return order_log(spark, folder).select(
        "f02",
        "f04",
        trimmed("f02").alias("number"),
        trimmed("f16").alias("trimmed"),
        squeeze_question_marks("f16").alias("marks"),
        squeeze_zeros("f16").alias("zeros"),
        squeeze_blanks("f16").alias("blanks"),
    )


def is_null_flag(spark, folder) -> DataFrame:
    segment = F.col("c_mktsegment")
    gapped = F.when(segment == "BUILDING", F.lit("")).when(segment != "MACHINERY", segment)
    return table(spark, folder, "customer").select("c_custkey", is_filled(gapped).alias("filled"))


def hour_window(spark, folder) -> DataFrame:
    log = order_log(spark, folder)
    return filters.in_window(log, "f31", 1997010100, 1999010100).select("f02", "f04", "f31")


def text_hour_window(spark, folder) -> DataFrame:
    """Hours kept as text, as older logs have them."""
    log = order_log(spark, folder).withColumn("f31", F.col("f31").cast("string"))
    return filters.in_window(log, "f31", 1997010100, 1999010100).select("f02", "f04", "f31")


def typed_code_filter(spark, folder) -> DataFrame:
    items = table(spark, folder, "lineitem")
    coded = items.select("l_orderkey", "l_suppkey", (F.col("l_linenumber") + 47).cast("bigint").alias("f14"))
    return filters.with_code(coded, "f14", 49)


def length_filter(spark, folder) -> DataFrame:
    return filters.longer_than(table(spark, folder, "documents"), "text", 1000).select("doc_id")


def range_filter(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders")
    return filters.outside_range(orders, "o_custkey", 300, 600).select("o_orderkey", "o_custkey")


def hour_columns(spark, folder) -> DataFrame:
    epoch = F.unix_seconds(F.to_timestamp("ts"))
    return table(spark, folder, "events").select(
        "event_id", hours.hour_of_epoch(epoch).alias("cp"), hours.hour_of("ts").alias("ld")
    )


def bucket_texts(spark, folder) -> DataFrame:
    f31 = F.col("f31")
    return event_log(spark, folder).select(
        "f02",
        "f04",
        hours.bucket_text(f31).alias("hour"),
        hours.bucket_key_text(hours.bucket_key(f31, hours.BUCKET_DAY), hours.BUCKET_DAY).alias("day"),
        hours.bucket_key_text(hours.bucket_key(f31, hours.BUCKET_MONTH), hours.BUCKET_MONTH).alias("month"),
        hours.bucket_text(f31 + 75).alias("no_hour"),
    )


def hour_arithmetic(spark, folder) -> DataFrame:
    return event_log(spark, folder).select(
        "f31",
        hours.next_hour("f31").alias("next_hour"),
        hours.shift_hours("f31", 24).alias("next_day"),
        hours.shift_hours("f31", -24 * 7).alias("week_ago"),
    )


# --- joins, distinct, samples -----------------------------------------------------


def anti_join(spark, folder) -> DataFrame:
    rows = without_listed(order_log(spark, folder), order_exclusion(spark, folder), "f02")
    return rows.select("f02", "f04", "f31")


def anti_join_long_list(spark, folder) -> DataFrame:
    rows = without_listed(order_log(spark, folder), order_exclusion(spark, folder), "f02", broadcast=False)
    return rows.select("f02", "f04", "f31")


def anti_join_text_key(spark, folder, **options) -> DataFrame:
    """Numbers kept as text; what is no number is never excluded."""
    log = order_log(spark, folder)
    number = F.when(F.col("f04") % 2 == 0, F.col("f02").cast("string")).otherwise(F.concat(F.lit("x"), F.col("f02")))
    rows = without_listed(log.withColumn("f02", number), order_exclusion(spark, folder), "f02", **options)
    return rows.select("f02", "f04", "f31")


def anti_join_text_key_long_list(spark, folder) -> DataFrame:
    return anti_join_text_key(spark, folder, broadcast=False)


def anti_join_split(spark, folder) -> DataFrame:
    """A Bloom filter of the list lets most rows pass by the shuffled join."""
    rows = without_listed_split(order_log(spark, folder), order_exclusion(spark, folder), "f02")
    return rows.select("f02", "f04", "f31")


def anti_join_text_key_split(spark, folder) -> DataFrame:
    """The same for numbers kept as text, with a filter so small that many rows are open."""
    log = order_log(spark, folder)
    number = F.when(F.col("f04") % 2 == 0, F.col("f02").cast("string")).otherwise(F.concat(F.lit("x"), F.col("f02")))
    rows = without_listed_split(log.withColumn("f02", number), order_exclusion(spark, folder), "f02", words=2)
    return rows.select("f02", "f04", "f31")


def distinct_pairs(spark, folder) -> DataFrame:
    return sample.sender_names(order_log(spark, folder), (10, 20))


def exclusion_list(spark, folder) -> DataFrame:
    return sample.build_exclusion(order_log(spark, folder), 40, keep_out=(10, 20), seed=3)


def exclusion_list_merged(spark, folder) -> DataFrame:
    """The same list from those of three parts of the log, each made and stored on its own."""
    path, log = work_folder(spark), order_log(spark, folder)
    for window in ((0, 1997010100), (1997010100, ORDERS_SPLIT), (ORDERS_SPLIT, 9999123123)):
        part = sample.build_exclusion(filters.in_window(log, "f31", *window), 40, keep_out=(10, 20), seed=3)
        write_table(part, path, mode="append")
    return sample.merged_exclusion(read_table(spark, path, EXCLUSION), 40, seed=3)


def seeded_sample(spark, folder) -> DataFrame:
    pairs = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey").distinct()
    return sample.seeded_sample(pairs, 20_000, seed=3)


def random_sample(spark, folder) -> DataFrame:
    """How many rows are drawn at random, and how many of them are real and different."""
    orders = table(spark, folder, "orders").select("o_orderkey")
    drawn = sample.random_sample(orders, 500, seed=3)
    known = drawn.join(orders.distinct().withColumn("known", F.lit(1)), "o_orderkey", "left")
    return known.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("o_orderkey").alias("different"),
        F.count_distinct(F.when(F.col("known") == 1, F.col("o_orderkey"))).alias("real"),
    )


# --- derived tables -----------------------------------------------------------------


def latest_per_number(spark, folder) -> DataFrame:
    return derived.latest_per_sender(bulk_batch(spark, folder))


def latest_with_ties(spark, folder) -> DataFrame:
    """Many buckets and batches per sender, so ties are common."""
    both = daily_batch(spark, folder).unionByName(daily_batch(spark, folder, (EVENTS[0], EVENTS_SPLIT)))
    return derived.latest_per_sender(both)


def first_last(spark, folder) -> DataFrame:
    return derived.first_last(hourly_batches(spark, folder))


def first_last_merge(spark, folder) -> DataFrame:
    month = hours.BUCKET_MONTH
    known = derived.first_last(bulk_batch(spark, folder, (ORDERS[0], ORDERS_SPLIT)), bucket_format=month)
    new = derived.first_last(bulk_batch(spark, folder, (ORDERS_SPLIT, ORDERS[1])), bucket_format=month)
    return derived.merge_first_last(new, known, bucket_format=month)


def union_all(spark, folder) -> DataFrame:
    return bulk_batch(spark, folder, (ORDERS[0], ORDERS_SPLIT)).unionByName(
        bulk_batch(spark, folder, (ORDERS_SPLIT, ORDERS[1]))
    )


def result_report(spark, folder) -> DataFrame:
    return report.ordered_result(bulk_batch(spark, folder))


def peek_limit(spark, folder) -> DataFrame:
    return report.peek(bulk_batch(spark, folder), 10, order=("ad", "bd", "f02"))


def column_profile(spark, folder) -> DataFrame:
    return profile.column_profile(order_log(spark, folder), distinct=False)


def column_profile_distinct(spark, folder) -> DataFrame:
    """Whether the sketched number of values of each column is near the exact one."""
    log = order_log(spark, folder)
    sketched = profile.column_profile(log).select("column", "distinct")
    exact = log.agg(*[F.count_distinct(c).alias(c) for c in log.columns]).unpivot([], log.columns, "column", "exact")
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.2 * F.col("exact"))
    return sketched.join(exact, "column").select("column", "exact", near.alias("near"))


# --- tables by path -------------------------------------------------------------------


def _store(spark) -> ResultStore:
    return ResultStore(spark, work_folder(spark)).create()


def batch_replace(spark, folder) -> DataFrame:
    """A batch run twice: the second, smaller result is all that is left."""
    store = _store(spark)
    store.append(daily_batch(spark, folder))
    store.replace_batch(bulk_batch(spark, folder, min_peers=8), ORDERS[1])
    store.replace_batch(bulk_batch(spark, folder), ORDERS[1])
    return store.read()


def batch_replace_empty(spark, folder) -> DataFrame:
    """A batch run again without any row; other batches stay."""
    store = _store(spark)
    store.append(daily_batch(spark, folder))
    store.replace_batch(bulk_batch(spark, folder), ORDERS[1])
    store.replace_batch(bulk_batch(spark, folder, min_peers=1_000_000_000), ORDERS[1])
    return store.read()


def _in_dynamic_session(spark, query, folder) -> DataFrame:
    """A query whose writes run in a session that overwrites single partitions."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        return query(spark, folder)
    finally:
        spark.conf.set(mode, before)


def batch_replace_dynamic(spark, folder) -> DataFrame:
    return _in_dynamic_session(spark, batch_replace, folder)


def batch_replace_empty_dynamic(spark, folder) -> DataFrame:
    return _in_dynamic_session(spark, batch_replace_empty, folder)


def truncate_table_dynamic(spark, folder) -> DataFrame:
    return _in_dynamic_session(spark, truncate_table, folder)


def overwrite_batch_dynamic(spark, folder) -> DataFrame:
    return _in_dynamic_session(spark, partial(overwrite_batch, table_name="overwritten_dynamic"), folder)


def _rerun_without_rows(spark, folder, store) -> DataFrame:
    """The bulk batch by the minute, then again without rows.

    Nearly every line item is a group of its own there, so groups are told by
    the number of their rows first and few or none are shuffled with texts.
    """
    for peers in (10, 1_000_000_000):
        aside = work_folder(spark)
        rows = mass_senders_in_two_steps(
            order_log(spark, folder),
            order_exclusion(spark, folder),
            ORDERS,
            path=aside,
            bucket_format="yyyy/MM/dd HH:mm",
            min_peers=peers,
        )
        store.replace_batches(rows, [ORDERS[1]])
        remove_folder(spark, aside)
    return store.read()


def replace_escaped_buckets(spark, folder) -> DataFrame:
    """A rerun without rows where bucket names hold characters that paths escape."""
    store = _store(spark)
    store.append(daily_batch(spark, folder))
    return _rerun_without_rows(spark, folder, store)


def dynamic_partitions(spark, folder) -> DataFrame:
    """Rows find their partitions; a partition filter reads some of them."""
    store = _store(spark)
    store.append(bulk_batch(spark, folder))
    store.append(daily_batch(spark, folder))
    return store.read_batches([ORDERS[1]])


def preclear_day(spark, folder) -> DataFrame:
    """One bulk batch and a day of hourly ones, then that day is cleared."""
    tables = _events_loaded(spark, folder)
    tables.results.clear_batches(hours.hourly_batch_ids(EVENTS_SPLIT, EVENTS[1]))
    return tables.results.read()


def truncate_table(spark, folder) -> DataFrame:
    store = _store(spark)
    store.append(bulk_batch(spark, folder))
    before = store.read().agg(F.count(F.lit(1)).alias("before")).first()["before"]
    store.truncate()
    return store.read().agg(F.lit(before).cast("bigint").alias("before"), F.count(F.lit(1)).alias("after"))


def swap_table(spark, folder) -> DataFrame:
    """A snapshot built from its own former version."""
    snapshot = Snapshot(spark, work_folder(spark), RESULT).create()
    snapshot.swap(bulk_batch(spark, folder, (ORDERS[0], ORDERS_SPLIT)))
    snapshot.swap(snapshot.read().unionByName(bulk_batch(spark, folder, (ORDERS_SPLIT, ORDERS[1]))))
    return snapshot.read()


def _events_loaded(spark, folder, tables=None, **more) -> Tables | NamedTables:
    """All events: the first 29 days as one batch, the last day by the hour."""
    tables = (tables or Tables(spark, work_folder(spark))).create()
    log, listed = event_log(spark, folder), event_exclusion(spark, folder)
    options = {"bucket_format": hours.BUCKET_DAY, "min_peers": 1, **more}
    run_bulk(tables, log, listed, (EVENTS[0], EVENTS_SPLIT), **options)
    run_next_day(tables, log, listed, **options)
    return tables


def restart_day(spark, folder) -> DataFrame:
    return _events_loaded(spark, folder).results.read()


def restart_day_seen(spark, folder) -> DataFrame:
    return _events_loaded(spark, folder).seen.read()


def rerun_smaller(spark, folder, tables=None) -> DataFrame:
    """All tables after the last day was run again with a higher threshold."""
    tables = _events_loaded(spark, folder, tables)
    options = {"bucket_format": hours.BUCKET_DAY, "min_peers": 3}
    window = (EVENTS_SPLIT, EVENTS[1])
    run_hours(tables, event_log(spark, folder), event_exclusion(spark, folder), window, **options)
    what = {
        "results": tables.results.read().select("f02", "bd", F.col("cnt").cast("string").alias("value")),
        "latest": tables.read_latest().select("f02", "bd", F.col("cnt").cast("string").alias("value")),
        "seen": tables.seen.read().select("f02", F.col("f_date").alias("bd"), F.col("l_date").alias("value")),
        "log": tables.batch_log.read().select(F.lit("").alias("f02"), F.lit("").alias("bd"), F.col("batchId").alias("value")),
    }
    out = None
    for name, rows in what.items():
        rows = rows.select(F.lit(name).alias("what"), "f02", "bd", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


def stream_hours(spark, folder) -> DataFrame:
    """The hourly batches as a stream that is stopped and resumed while the
    log grows; the newest hour is still open at the end."""
    path, found, progress = work_folder(spark), work_folder(spark), work_folder(spark)
    log = event_log(spark, folder)
    middle = (EVENTS[0] + EVENTS[1]) // 2
    for window in ((EVENTS[0], middle), (middle, EVENTS[1])):
        write_log(filters.in_window(log, "f31", *window), path, partition_by=())
        query = run_stream(stream_log(spark, path), event_exclusion(spark, folder), found, progress, min_peers=4)
        query.awaitTermination()
    return ResultStore(spark, found).read()


def stream_all_hours(spark, folder) -> DataFrame:
    """The hourly batches as a stream that loses nothing: every seventh peer's first half comes after those hours were
    published, and the newest hour is closed at the end."""
    path, progress = work_folder(spark), work_folder(spark)
    log = event_log(spark, folder)
    middle = (EVENTS[0] + EVENTS[1]) // 2
    late = (F.col("f31") < middle) & (F.col("f04") % 7 == 0)
    found = CompleteHours(spark, work_folder(spark)).create()
    for part in (log.where(F.col("f31") < middle).where(~late), log.where(late | (F.col("f31") >= middle))):
        write_log(filters.in_window(part, "f31", *EVENTS), path, partition_by=())
        found.run(stream_log(spark, path), progress)
        found.publish(event_exclusion(spark, folder), middle, min_peers=4)
    found.close(event_exclusion(spark, folder), min_peers=4)
    return found.results.read()


def run_metrics(spark, folder) -> DataFrame:
    """Rows read and stored by every batch, with a short list and a long one."""
    out = None
    for name, broadcast in (("short", True), ("long", False)):
        metrics = _events_loaded(spark, folder, broadcast=broadcast).read_metrics().where("rows_out IS NOT NULL")
        rows = metrics.select(F.lit(name).alias("list"), "job", "batchId", "rows_in", "rows_out")
        out = rows if out is None else out.unionByName(rows)
    return out


def batch_log(spark, folder) -> DataFrame:
    return _events_loaded(spark, folder).batch_log.read()


def watermark(spark, folder) -> DataFrame:
    log = BatchLog(spark, work_folder(spark)).create()
    hourly_batches(spark, folder).select(F.col("ad").cast("string").alias("batchId")).distinct().write.mode(
        "append"
    ).parquet(log.path)
    return last_batch(log.read())


# --- generated logs ---------------------------------------------------------------------


def _ids(spark, folder, name, key) -> DataFrame:
    """Row ids from a table.  Making a row costs far more than moving its id,
    so the ids are spread evenly over all cores; neighbours stay together.
    (Without a number, adaptive execution would join such small partitions.)"""
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return table(spark, folder, name).select(F.col(key).alias("id")).repartitionByRange(tasks, "id")


def _noise(spark, folder) -> DataFrame:
    return noise_log(_ids(spark, folder, "orders", "o_orderkey"), PLAN)


def _planted(spark, folder) -> DataFrame:
    return planted_log(_ids(spark, folder, "customer", "c_custkey"), PLAN)


def gen_noise(spark, folder) -> DataFrame:
    """One noise row per order."""
    return _noise(spark, folder)


def gen_planted(spark, folder) -> DataFrame:
    """One planted row per customer."""
    return _planted(spark, folder)


def gen_older(spark, folder) -> DataFrame:
    """Noise and planted rows in the older form of the log."""
    plan = replace(PLAN, older=True)
    noise = noise_log(_ids(spark, folder, "orders", "o_orderkey"), plan)
    return noise.unionByName(planted_log(_ids(spark, folder, "customer", "c_custkey"), plan))


def gen_to_size(spark, folder) -> DataFrame:
    """A log as large as the line items, by the 4,000 rows per megabyte rule,
    counted by hour and sender kind."""
    rows = table(spark, folder, "lineitem").count()
    plan = LogPlan.for_size(rows / 4000 / 1024, end=PLAN.end, days=1, batch_rows=4000, seed=7)
    planted = F.col("f16") == F.lit("Great you found me !")
    return generate_log(spark, plan).groupBy("cp", planted.alias("planted")).agg(F.count(F.lit(1)).alias("rows"))


def partition_roundtrip(spark, folder) -> DataFrame:
    """Noise and planted rows appended to one partitioned log, read back."""
    path = work_folder(spark)
    write_log(_noise(spark, folder), path)
    write_log(_planted(spark, folder), path)
    return read_log(spark, path)


def sender_history_rows(spark, folder) -> DataFrame:
    """All rows of a few senders, from files sorted by sender with Bloom filters."""
    path = work_folder(spark)
    write_log(order_log(spark, folder), path, partition_by=(), sort_by=("f02",), look_up=("f02",))
    return sender_history(read_log(spark, path), (3, 8, 10**9), ORDERS).select("f02", "f04", "f31")


def file_control(spark, folder) -> DataFrame:
    """Rows written by two tasks, or spread by partition value: into how many files."""
    merged, spread = work_folder(spark), work_folder(spark)
    log = _noise(spark, folder).unionByName(_planted(spark, folder))
    write_log(log, merged, files=2)
    write_log(log, spread, partition_by=("f31",), rebalance=True)
    out = None
    # Two tasks make two files at most; small partitions that are rebalanced make one.
    for name, path, limit in (("merged", merged, 2), ("spread", spread, 1)):
        read = read_log(spark, path).select("cp", "f31", F.col("_metadata.file_name").alias("file"))
        counted = read.groupBy("f31").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files"))
        counted = counted.select(F.lit(name).alias("kind"), "f31", "rows", (F.col("files") <= limit).alias("few_files"))
        out = counted if out is None else out.unionByName(counted)
    return out


def planted_recovery(spark, folder) -> DataFrame:
    """The planted senders, and nobody else, are found among the noise."""
    path, listed = work_folder(spark), work_folder(spark)
    write_log(_noise(spark, folder), path)
    write_log(_planted(spark, folder), path)
    log = read_log(spark, path)
    write_table(sample.build_exclusion(log, 100, keep_out=(19_218_983_880, 19_218_983_890), seed=3), listed)
    return mass_senders(log, read_table(spark, listed, EXCLUSION), (2023032300, 2023032306), min_peers=2)


# --- tables by name -----------------------------------------------------------------------


def _database(spark) -> str:
    """The database of these queries, in a folder of its own: what another session left or keeps in the warehouse is not in the way."""
    name = "peerwatch_check"
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{work_folder(spark)}'")
    return name


def create_table_as(spark, folder) -> DataFrame:
    name = f"{_database(spark)}.latest"
    catalog.create_table_as(latest_per_number(spark, folder), name)
    return spark.table(name).select(*LATEST.names)


def insert_partitions(spark, folder) -> DataFrame:
    name = f"{_database(spark)}.inserted"
    catalog.create_result_table(spark, name)
    catalog.insert_partitions(bulk_batch(spark, folder), name)
    catalog.insert_partitions(daily_batch(spark, folder), name)
    return spark.table(name).select(*RESULT.names)


def overwrite_batch(spark, folder, table_name="overwritten") -> DataFrame:
    """Two batches; one is run again with fewer rows, one is cleared."""
    name = f"{_database(spark)}.{table_name}"
    catalog.create_result_table(spark, name)
    catalog.insert_partitions(daily_batch(spark, folder), name)
    catalog.overwrite_batch(bulk_batch(spark, folder, min_peers=8), name, ORDERS[1])
    catalog.overwrite_batch(bulk_batch(spark, folder), name, ORDERS[1])
    NamedResults(spark, name).clear_batches([EVENTS[1]])
    return spark.table(name).select(*RESULT.names)


def _named(spark, prefix) -> NamedTables:
    return NamedTables(spark, _database(spark), f"{prefix}_")


def restart_day_by_name(spark, folder, prefix="restart") -> DataFrame:
    """The jobs of ``restart_day`` on tables of the catalog."""
    return _events_loaded(spark, folder, _named(spark, prefix)).results.read()


def restart_day_by_name_dynamic(spark, folder) -> DataFrame:
    return _in_dynamic_session(spark, partial(restart_day_by_name, prefix="restart_dynamic"), folder)


def rerun_smaller_by_name(spark, folder) -> DataFrame:
    return rerun_smaller(spark, folder, _named(spark, "rerun"))


def preclear_day_by_name(spark, folder) -> DataFrame:
    """A day of hourly batches cleared in one statement."""
    tables = _events_loaded(spark, folder, _named(spark, "preclear"))
    tables.results.clear_batches(hours.hourly_batch_ids(EVENTS_SPLIT, EVENTS[1]))
    return tables.results.read()


def replace_escaped_buckets_by_name(spark, folder) -> DataFrame:
    """A rerun without rows where bucket names hold characters that partition names escape."""
    store = NamedResults(spark, f"{_database(spark)}.escaped").create()
    store.append(daily_batch(spark, folder))
    return _rerun_without_rows(spark, folder, store)


def swap_by_rename(spark, folder) -> DataFrame:
    db = _database(spark)
    catalog.reset(spark, db, ("live", "staged"))
    catalog.create_table_as(bulk_batch(spark, folder, (ORDERS[0], ORDERS_SPLIT)), f"{db}.live")
    catalog.create_table_as(
        spark.table(f"{db}.live").unionByName(bulk_batch(spark, folder, (ORDERS_SPLIT, ORDERS[1]))), f"{db}.staged"
    )
    catalog.swap(spark, f"{db}.staged", f"{db}.live")
    return spark.table(f"{db}.live").select(*BATCH.names)


def truncate_by_name(spark, folder) -> DataFrame:
    name = f"{_database(spark)}.truncated"
    catalog.create_result_table(spark, name)
    catalog.insert_partitions(bulk_batch(spark, folder), name)
    before = spark.table(name).count()
    catalog.truncate(spark, name)
    return spark.table(name).agg(F.lit(before).cast("bigint").alias("before"), F.count(F.lit(1)).alias("after"))


def reset_tables(spark, folder) -> DataFrame:
    """Tables made and dropped; how many are left."""
    db = _database(spark)
    catalog.create_table_as(distinct_pairs(spark, folder), f"{db}.dropped")
    before = spark.table(f"{db}.dropped").count()
    catalog.reset(spark, db, ("dropped", "never_there"))
    left = spark.sql(f"SHOW TABLES IN {db} LIKE 'dropped'")
    return left.agg(F.lit(before).cast("bigint").alias("before"), F.count(F.lit(1)).alias("tables_left"))


def bucketed_table(spark, folder) -> DataFrame:
    """Grouping by the bucket key reads the buckets without a shuffle."""
    name = f"{_database(spark)}.bucketed"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    catalog.write_bucketed(_noise(spark, folder).unionByName(_planted(spark, folder)), name)
    return spark.table(name).groupBy("f02").agg(F.count(F.lit(1)).alias("rows"))


def _co_bucketed(spark, folder, name: str) -> tuple[str, str]:
    """Names of the order log by sender and of its list by id, bucketed alike."""
    log, listed = f"{_database(spark)}.{name}_log", f"{_database(spark)}.{name}_list"
    for table_name, rows, key in ((log, order_log(spark, folder), "f02"), (listed, order_exclusion(spark, folder), "id")):
        spark.sql(f"DROP TABLE IF EXISTS {table_name}")
        catalog.write_bucketed(rows, table_name, buckets=8, key=key, sort=key)
    return log, listed


def anti_join_bucketed(spark, folder) -> DataFrame:
    """Log and list bucketed alike: no row is shuffled."""
    log, listed = _co_bucketed(spark, folder, "anti")
    return catalog.without_listed_by_bucket(spark, log, listed).select("f02", "f04", "f31")


def latest_bucketed(spark, folder) -> DataFrame:
    """Latest result per sender, from results bucketed by sender: no row is shuffled."""
    name = f"{_database(spark)}.bucketed_results"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    catalog.write_bucketed(daily_batch(spark, folder).unionByName(daily_batch(spark, folder, (EVENTS[0], EVENTS_SPLIT))), name, buckets=8, sort="bd")
    return derived.latest_per_sender(spark.table(name))


def load_job(spark, folder) -> DataFrame:
    """The load job with as many rows as there are line items: what ANALYZE counted, and what is in the tables."""
    rows = table(spark, folder, "lineitem").count()
    plan = LogPlan.for_size(rows / 4000 / 1024, end=PLAN.end, days=1, batch_rows=4000, seed=7)
    base = BaseTables(spark, _database(spark), "load_")
    described = run_load(base, plan, listed=1000, drop=True)
    parts = []
    for what, name in (("log", base.log), ("list", base.exclusion)):
        line = described[name].where(F.col("col_name") == "Statistics")
        counted = F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint")
        parts.append(line.select(F.lit(what).alias("what"), counted.alias("rows")))
    planted = F.col("f02").between(PLANTED_FIRST, PLANTED_FIRST + PLANTED_NUMBERS - 1) & (F.col("f16") == PLANTED_TEXT)
    count = F.count(F.lit(1)).alias("rows")
    parts.append(base.read_log().where(planted).agg(count).select(F.lit("planted").alias("what"), "rows"))
    hidden = base.read_exclusion().join(base.read_log().where(planted), F.col("id") == F.col("f02"), "left_semi")
    parts.append(hidden.agg(count).select(F.lit("planted and listed").alias("what"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def column_histograms(spark, folder) -> DataFrame:
    """Whether each bin of the histograms ends at its share of the rows, within a thousandth of them (and one row)."""
    name = f"{_database(spark)}.histograms"
    catalog.create_table_as(order_log(spark, folder), name)
    bins, columns = 20, ("f02", "f04", "f31")
    found = catalog.histograms(spark, name, columns, bins)
    log = spark.table(name)
    # One row for each value, with the rows up to it; the bins are few.
    values = log.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in columns])).alias("x"))
    counted = values.select("x.*").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    met = counted.join(F.broadcast(found), "column").groupBy("column", "bin", "upper")
    upto = met.agg(
        F.sum(F.when(F.col("v") < F.col("upper"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("upper"), F.col("n")).otherwise(0)).alias("upto"),
        F.sum("n").alias("total"),
    )
    share, slack = F.col("total") * (F.col("bin") + 1) / bins, 1 + F.col("total") / 1000
    return upto.select("column", "bin", ((F.col("below") <= share + slack) & (F.col("upto") >= share - slack)).alias("near"))


def table_statistics(spark, folder) -> DataFrame:
    name = f"{_database(spark)}.analyzed"
    catalog.create_table_as(order_log(spark, folder), name)
    described = catalog.analyze(spark, name)
    rows = F.regexp_extract("data_type", r"(\d+) rows", 1)
    counted = described.where(F.col("col_name") == "Statistics")
    counted = counted.select(F.lit("*").alias("column"), F.lit("rows").alias("statistic"), rows.alias("value"))
    found = catalog.column_statistics(spark, name, ("f02", "f04", "f31")).where("statistic <> 'distinct_count'")
    return counted.unionByName(found)


def table_roundtrip(spark, folder) -> DataFrame:
    path = work_folder(spark)
    batch = bulk_batch(spark, folder)
    write_table(batch, path)
    return read_table(spark, path, BATCH)


QUERIES = {
    f.__name__: f
    for f in (
        bulk_batch,
        bulk_batch_long_list,
        bulk_batch_two_steps,
        bulk_batch_two_steps_shuffled,
        daily_batch,
        hourly_batches,
        batch_view,
        peer_count,
        peer_count_sketch,
        peer_count_merged,
        clean_text,
        squeeze_runs,
        is_null_flag,
        hour_window,
        text_hour_window,
        typed_code_filter,
        length_filter,
        range_filter,
        hour_columns,
        bucket_texts,
        hour_arithmetic,
        anti_join,
        anti_join_long_list,
        anti_join_text_key,
        anti_join_split,
        anti_join_text_key_split,
        anti_join_bucketed,
        latest_bucketed,
        anti_join_text_key_long_list,
        distinct_pairs,
        exclusion_list,
        exclusion_list_merged,
        seeded_sample,
        random_sample,
        latest_per_number,
        latest_with_ties,
        first_last,
        first_last_merge,
        union_all,
        result_report,
        peek_limit,
        column_profile,
        column_profile_distinct,
        batch_replace,
        batch_replace_empty,
        batch_replace_dynamic,
        batch_replace_empty_dynamic,
        truncate_table_dynamic,
        overwrite_batch_dynamic,
        replace_escaped_buckets,
        dynamic_partitions,
        preclear_day,
        truncate_table,
        swap_table,
        restart_day,
        restart_day_seen,
        rerun_smaller,
        stream_hours,
        stream_all_hours,
        run_metrics,
        batch_log,
        watermark,
        gen_noise,
        gen_planted,
        gen_older,
        gen_to_size,
        load_job,
        bulk_from_hours,
        hourly_from_hours,
        partition_roundtrip,
        file_control,
        sender_history_rows,
        planted_recovery,
        create_table_as,
        insert_partitions,
        overwrite_batch,
        restart_day_by_name,
        restart_day_by_name_dynamic,
        rerun_smaller_by_name,
        preclear_day_by_name,
        replace_escaped_buckets_by_name,
        swap_by_rename,
        truncate_by_name,
        reset_tables,
        bucketed_table,
        table_statistics,
        column_histograms,
        table_roundtrip,
    )
}
