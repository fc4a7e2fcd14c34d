"""The batch jobs: bulk load, hourly batches in one pass, restart.

They run on tables by path (``Tables``) or in a catalog
(``peerwatch.sources.named.NamedTables``), which have the same methods.

Results are written once and read back for everything derived from them.  The
stored batch, not a cache, is what later steps depend on, so a lost executor
never sends them back to the log.
"""

from dataclasses import dataclass
from time import perf_counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from peerwatch.functions import hours
from peerwatch.operators.derived import first_last, latest_per_sender, merge_first_last
from peerwatch.operators.detect import HOURLY, candidate_groups, mass_senders
from peerwatch.operators.exclusion import BROADCAST_IDS
from peerwatch.schema import LATEST, RESULT, RUN_METRICS, SEEN
from peerwatch.session import remove_folder, work_folder
from peerwatch.sources.batch_log import BatchLog
from peerwatch.sources.logs import empty, literal_rows
from peerwatch.sources.results import ResultStore, observed
from peerwatch.sources.snapshots import Snapshot


@dataclass
class Tables:
    """All tables of one installation below one shared path."""

    spark: SparkSession
    path: str

    def __post_init__(self):
        self.results = ResultStore(self.spark, f"{self.path}/results")
        self.batch_log = BatchLog(self.spark, f"{self.path}/batch_log")
        # The stored form keeps the batch, which decides between equal buckets.
        self.latest = Snapshot(self.spark, f"{self.path}/latest", RESULT)
        self.seen = Snapshot(self.spark, f"{self.path}/seen", SEEN)
        self.metrics_path = f"{self.path}/metrics"

    def create(self) -> "Tables":
        """Start (again) with empty tables."""
        self.results.create()
        self.batch_log.create()
        self.latest.create()
        self.seen.create()
        empty(self.spark, RUN_METRICS).write.mode("overwrite").parquet(self.metrics_path)
        return self

    def read_latest(self) -> DataFrame:
        return self.latest.read().select(*LATEST.names)

    def read_metrics(self) -> DataFrame:
        return self.spark.read.schema(RUN_METRICS).parquet(self.metrics_path)

    def add_metrics(self, rows) -> None:
        literal_rows(self.spark, rows, RUN_METRICS).write.mode("append").parquet(self.metrics_path)


def mass_senders_in_two_steps(
    log: DataFrame,
    exclusion: DataFrame | None,
    window: tuple[int, int],
    *,
    path: str | None = None,
    broadcast_limit: int = BROADCAST_IDS,
    **options,
) -> DataFrame:
    """:func:`mass_senders`, told beforehand which groups have enough rows.

    The log is read twice, but only rows of the candidates are shuffled with
    their texts.  That pays where most texts are sent a few times only and
    the network is the bottleneck.  More candidates than can be broadcast are
    joined by an 8-byte hash.  The candidates are stored at ``path``, which
    is the caller's to remove once the result has been used.
    """
    shared = {k: v for k, v in options.items() if k in ("batch_ids", "code", "min_len", "min_peers", "bucket_format")}
    path = path or work_folder(log.sparkSession)
    candidate_groups(log, window, exclusion=exclusion, **shared).write.parquet(path)
    candidates = log.sparkSession.read.schema("group bigint").parquet(path)
    return mass_senders(log, exclusion, window, candidates=candidates, broadcast_limit=broadcast_limit, **options)


def refresh_latest(tables: Tables, batch_ids=None) -> None:
    """The newest row of every sender.

    New batches are merged with the former answer; without ``batch_ids`` it is
    rebuilt from all stored results, as it must be after a batch was replaced.
    """
    rows = tables.results.read()
    if batch_ids is not None:
        rows = tables.results.read_batches(batch_ids).unionByName(tables.latest.read())
    tables.latest.swap(latest_per_sender(rows, RESULT.names))


def refresh_seen(tables: Tables, batch_ids=None, bucket_format: str = hours.BUCKET_HOUR) -> None:
    """First and last bucket of every sender, merged or rebuilt like the latest.

    Minimum and maximum cannot take anything back, so a replaced batch needs
    the rebuild.
    """
    known = bucket_format if hours.has_bucket_key(bucket_format) else None
    if batch_ids is None:
        tables.seen.swap(first_last(tables.results.read(), bucket_format=known))
        return
    new = first_last(tables.results.read_batches(batch_ids), bucket_format=known)
    tables.seen.swap(merge_first_last(new, tables.seen.read(), bucket_format=known))


def _rows_in(observation: Observation) -> int | None:
    """Unknown if the pass gave no row at all: adaptive execution then drops
    the observed part of the plan."""
    return observed(observation).get("rows_in")


def _record(tables: Tables, job: str, batch_ids, rows_in: int | None, started: float) -> None:
    """One row per batch; rows read and time belong to the common pass."""
    millis = round((perf_counter() - started) * 1000)
    counted = tables.results.read_batches(batch_ids).groupBy("ad").agg(F.count(F.lit(1)).alias("n")).collect()
    rows_out = {r["ad"]: r["n"] for r in counted}
    tables.add_metrics([(job, b, rows_in, rows_out.get(b, 0), millis) for b in batch_ids])


def run_bulk(
    tables: Tables,
    log: DataFrame,
    exclusion: DataFrame | None,
    window: tuple[int, int],
    *,
    batch_id: int | None = None,
    two_steps: bool = False,
    **options,
) -> DataFrame:
    """One batch over a window of any length; its id is the window's end.

    Running it again replaces the batch.  Returns the stored rows.
    """
    batch_id = window[1] if batch_id is None else batch_id
    return _run(tables, "bulk", log, exclusion, window, [batch_id], batch_id, two_steps, True, options)


def run_hours(
    tables: Tables,
    log: DataFrame,
    exclusion: DataFrame | None,
    window: tuple[int, int],
    *,
    advance: bool = True,
    two_steps: bool = False,
    **options,
) -> DataFrame:
    """Every hourly batch of a window from one scan and one aggregation.

    The result equals one run per hour, with each hour's end as its batch id.
    Hours without rows come out empty, also if a former run filled them.
    ``advance`` logs the batches as finished, so that the next restart
    continues after them.
    """
    batch_ids = hours.hourly_batch_ids(*window)
    return _run(tables, "hours", log, exclusion, window, batch_ids, HOURLY, two_steps, advance, options)


def _run(tables, job, log, exclusion, window, batch_ids, given, two_steps, advance, options) -> DataFrame:
    started, seen_rows, aside = perf_counter(), Observation(), work_folder(tables.spark)
    detect = mass_senders
    if two_steps:
        detect, options = mass_senders_in_two_steps, {**options, "path": aside}
    rows = detect(log, exclusion, window, batch_ids=given, observation=seen_rows, **options)
    logged = tables.batch_log.read().where(F.col("batchId").isin([str(b) for b in batch_ids]))
    known = not logged.isEmpty()
    replaced = bool(tables.results.replace_batches(rows, batch_ids)) or known
    _record(tables, job, batch_ids, _rows_in(seen_rows), started)
    if two_steps:
        remove_folder(tables.spark, aside)
    _finish(tables, batch_ids, options, advance, replaced)
    return tables.results.read_batches(batch_ids)


def run_next_day(tables: Tables, log: DataFrame, exclusion: DataFrame | None, *, days: int = 1, **options) -> DataFrame:
    """Continue with the hours after the newest finished batch."""
    start = tables.batch_log.last()
    return run_hours(tables, log, exclusion, (start, hours.move_hour(start, days=days)), **options)


def _finish(tables: Tables, batch_ids, options: dict, advance: bool, replaced: bool) -> None:
    """Derived tables first, the log entry last: a run that fails in between
    is repeated by the next restart, which finds its batches filled and
    rebuilds.  Every step is timed in the metrics, by the last batch."""
    new = None if replaced else batch_ids
    bucket_format = options.get("bucket_format", hours.BUCKET_HOUR)
    steps = {"latest": lambda: refresh_latest(tables, new), "seen": lambda: refresh_seen(tables, new, bucket_format)}
    if advance:
        steps["log"] = lambda: tables.batch_log.append(batch_ids)
    timed = []
    for name, step in steps.items():
        started = perf_counter()
        step()
        timed.append((name, batch_ids[-1], None, None, round((perf_counter() - started) * 1000)))
    tables.add_metrics(timed)
