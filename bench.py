"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line.

Each query is run to completion without collecting its rows; the best of
``$BENCH_RUNS`` runs counts.  The ``log_*`` steps are the batch workload on a
generated log with as many rows as there are line items: write the log, insert
six days as one batch, insert the last day's 24 hourly batches, in one pass and
(for comparison) hour by hour.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from peerwatch.functions import hours  # noqa: E402
from peerwatch.operators.detect import HOURLY, mass_senders  # noqa: E402
from peerwatch.operators.sample import build_exclusion  # noqa: E402
from peerwatch.plans.catalogue import QUERIES  # noqa: E402
from peerwatch.plans.jobs import Tables  # noqa: E402
from peerwatch.schema import EXCLUSION  # noqa: E402
from peerwatch.session import local_session, work_folder  # noqa: E402
from peerwatch.sources.generator import PLANTED_FIRST, PLANTED_NUMBERS, LogPlan, generate_log  # noqa: E402
from peerwatch.sources.logs import read_log, read_table, write_log, write_table  # noqa: E402

HEADLINE = (
    "bulk_batch",
    "bulk_batch_long_list",
    "daily_batch",
    "hourly_batches",
    "peer_count",
    "clean_text",
    "anti_join",
    "seeded_sample",
    "latest_per_number",
    "first_last",
    "first_last_merge",
    "result_report",
    "column_profile",
    "gen_noise",
    "planted_recovery",
)

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
LOG_END = 1_700_006_400  # 2023-11-15 00:00 UTC


def seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def best(action) -> float:
    return round(min(seconds(action) for _ in range(RUNS)), 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def log_workload(spark) -> dict[str, float]:
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    batch_rows = max(1, rows // 42)
    plan = LogPlan(start=LOG_END - 7 * 86_400, end=LOG_END, rounds=42, batch_rows=batch_rows)
    first, split, last = 2023110800, 2023111400, 2023111500
    path, listed = work_folder(spark), work_folder(spark)
    out = {"log_generate": round(seconds(lambda: write_log(generate_log(spark, plan), path)), 3)}
    log = read_log(spark, path)
    keep = (PLANTED_FIRST, PLANTED_FIRST + PLANTED_NUMBERS)
    out["log_exclusion"] = round(
        seconds(lambda: write_table(build_exclusion(log, rows // 4, keep_out=keep), listed)), 3
    )
    exclusion = read_table(spark, listed, EXCLUSION)

    def stored() -> Tables:
        return Tables(spark, work_folder(spark)).create()

    bulk, day, rounds = stored(), stored(), stored()
    day_ids = hours.hourly_batch_ids(split, last)
    out["log_insert_bulk"] = best(
        lambda: bulk.results.replace_batch(mass_senders(log, exclusion, (first, split), min_peers=1), split)
    )
    out["log_insert_24_hours"] = best(
        lambda: day.results.replace_batches(
            mass_senders(log, exclusion, (split, last), batch_ids=HOURLY, min_peers=1), day_ids
        )
    )

    def hour_by_hour():
        for start, end in zip(hours.hours_between(split, last), day_ids):
            rounds.results.replace_batch(mass_senders(log, exclusion, (start, end), min_peers=1), end)

    out["log_insert_24_rounds"] = round(seconds(hour_by_hour), 3)
    same = day.results.read().exceptAll(rounds.results.read()).isEmpty()
    if not same:
        raise AssertionError("one pass and 24 rounds differ")
    return out


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS), memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: best(lambda q=QUERIES[name]: drain(q(spark, FOLDER))) for name in HEADLINE}
    times.update(log_workload(spark))
    # The hour-by-hour loop is only the yardstick of the one-pass insert.
    total = sum(t for name, t in times.items() if name != "log_insert_24_rounds")
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(total, 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
