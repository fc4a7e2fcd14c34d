"""Synthetic logs with planted mass senders, made on the executors.

A row is a function of (seed, row id), so the log is repeatable, lost tasks
are redone alike, and no row passes through the driver.  Row ids of one time
slice are neighbours: a task writes the few hours of its own slices and a
partitioned write needs no shuffle.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerwatch.functions.hours import hour_of_epoch
from peerwatch.functions.rand import digest, hex_number, letters
from peerwatch.schema import LOG, LOG_PARTITIONS, LONG_FIELDS

# Fixed values of the data contract.
FIRST_NUMBER = 19_200_000_000
NUMBERS = 20_000_000
PLANTED_FIRST = 19_218_983_880
PLANTED_NUMBERS = 10
PLANTED_TEXT = "Great you found me !"
EVENT_CODE = 49
TEXT_LENGTH = 10
ROWS_PER_MB = 4_000  # 100,000 rows are taken as 25 MB
PLANTED_SHARE = 10  # one planted row for every ten noise rows
ROWS_PER_TASK = ROWS_PER_MB * 1024  # a task makes a gigabyte, so 100 TB are some 100,000 tasks

SHORT_TEXTS = tuple(c for c in LOG.names if c not in LONG_FIELDS and c not in LOG_PARTITIONS and c != "f16")
_TEXT_BLOCKS = 7  # 224 characters: 18 texts of 10 and one message of up to 30


@dataclass(frozen=True)
class LogPlan:
    """How many rows to make and over which time span.

    ``older`` makes logs of the older form: hour columns are text, ``f30`` and
    ``f31`` of noise are the first and last hour of its round, and planted
    rows have hours ``f30`` and ``f31`` and codes ``f14`` of their own.
    """

    start: int  # epoch seconds, in
    end: int  # epoch seconds, out
    rounds: int
    batch_rows: int
    seed: int = 0
    older: bool = False

    @property
    def noise_rows(self) -> int:
        return self.rounds * self.batch_rows

    @property
    def planted_batch(self) -> int:
        return math.ceil(self.batch_rows / PLANTED_SHARE)

    @property
    def planted_rows(self) -> int:
        return self.rounds * self.planted_batch

    @classmethod
    def for_size(
        cls, size_gb: float, *, end: int, days: int = 7, batch_rows: int = 100_000, seed: int = 0, debug: bool = False, older: bool = False
    ) -> "LogPlan":
        """The plan for a target size; ``debug`` makes two rounds only."""
        unit_mb = math.ceil(batch_rows / ROWS_PER_MB)
        rounds = 2 if debug else math.ceil(size_gb * 1024 / unit_mb)
        return cls(end - days * 86_400, end, rounds, batch_rows, seed, older)


def _slice_bounds(plan: LogPlan, row_id: Column, batch_rows: int):
    """Start and length of the time slice of a row's round.

    The slices divide the span exactly; ids past the plan go round again.
    """
    span = plan.end - plan.start
    round_no = F.call_function("div", row_id, F.lit(batch_rows)) % plan.rounds
    start = F.call_function("div", round_no * span, F.lit(plan.rounds))
    end = F.call_function("div", (round_no + 1) * span, F.lit(plan.rounds))
    return round_no, start + plan.start, F.greatest(end - start, F.lit(1))


def _finish(rows: DataFrame, plan: LogPlan) -> DataFrame:
    """Turn epoch seconds into the hour columns and order the columns."""
    hour_type = "string" if plan.older else "bigint"
    return rows.select(
        *[
            hour_of_epoch("f01" if c in LOG_PARTITIONS else c).cast(hour_type).alias(c)
            if c in ("f30", "f31", *LOG_PARTITIONS)
            else F.col(c)
            for c in LOG.names
        ]
    )


def _draw(ids: DataFrame, plan: LogPlan, kind: str, batch_rows: int) -> DataFrame:
    """Uniform numbers and letters for every id."""
    row = F.col("id")
    round_no, slice_start, slice_length = _slice_bounds(plan, row, batch_rows)
    drawn = ids.select(
        F.col("id").cast("bigint").alias("id"),
        digest(plan.seed, row, f"{kind}-numbers").alias("_n"),
        digest(plan.seed, row, f"{kind}-times").alias("_t"),
        round_no.alias("_round"),
        slice_start.alias("_start"),
        slice_length.alias("_length"),
        letters(plan.seed, row, f"{kind}-texts", _TEXT_BLOCKS).alias("_texts"),
    )
    return drawn.select(
        "id",
        "_round",
        "_start",
        "_length",
        "_texts",
        hex_number(F.col("_n"), 1).alias("_a"),
        hex_number(F.col("_n"), 16).alias("_b"),
        (F.col("_start") + hex_number(F.col("_t"), 1) % F.col("_length")).alias("f01"),
        (F.col("_start") + hex_number(F.col("_t"), 16) % F.col("_length")).alias("f30"),
    )


def _peeled(column: str, step: int, size: int) -> Column:
    """One more independent uniform number out of a 60-bit one."""
    return F.call_function("div", F.col(column), F.lit(NUMBERS * step)) % size


def _texts() -> dict[str, Column]:
    return {c: F.substring("_texts", 1 + i * TEXT_LENGTH, TEXT_LENGTH) for i, c in enumerate(SHORT_TEXTS)}


def _noise_message(plan: LogPlan) -> Column:
    """Random text whose length, 2 to 30, is drawn once per round."""
    length = 2 + (hex_number(digest(plan.seed, F.col("_round"), "noise-length"), 1) % 29).cast("int")
    return F.substring(F.col("_texts"), F.lit(1 + len(SHORT_TEXTS) * TEXT_LENGTH), length)


def noise_log(ids: DataFrame, plan: LogPlan) -> DataFrame:
    """Uniform random log rows, one per ``id``."""
    rows = _draw(ids, plan, "noise", plan.batch_rows)
    digits = {c: _peeled("_a", 10**i, 10) for i, c in enumerate(("f06", "f07", "f10", "f15", "f19"))}
    return _finish(
        rows.withColumns(
            {
                "f02": FIRST_NUMBER + F.col("_a") % NUMBERS,
                "f04": FIRST_NUMBER + F.col("_b") % NUMBERS,
                **digits,
                "f14": 48 + _peeled("_b", 1, 3),
                "f22": 1 + _peeled("_b", 3, 9),
                "f30": F.col("_start") if plan.older else F.col("f30"),
                "f31": F.col("_start") + F.col("_length") if plan.older else F.col("f30"),
                "f16": _noise_message(plan),
                **_texts(),
            }
        ),
        plan,
    )


def planted_log(ids: DataFrame, plan: LogPlan) -> DataFrame:
    """Rows of the planted mass senders, one per ``id``."""
    rows = _draw(ids, plan, "planted", plan.planted_batch)
    digits = {c: _peeled("_a", 10**i, 10) for i, c in enumerate(("f10", "f15", "f19"))}
    fixed = {"f06": 0, "f07": 7, "f14": EVENT_CODE, "f22": 3}
    fixed = {c: F.lit(v).cast("bigint") for c, v in fixed.items()}
    last = F.col("f30")
    if plan.older:
        fixed["f14"] = 48 + _peeled("_b", 1, 3)
        last = F.col("_start") + hex_number(digest(plan.seed, F.col("id"), "planted-ends"), 1) % F.col("_length")
    return _finish(
        rows.withColumns(
            {
                "f02": PLANTED_FIRST + F.col("_a") % PLANTED_NUMBERS,
                "f04": FIRST_NUMBER + F.col("_b") % NUMBERS,
                **digits,
                **fixed,
                "f31": last,
                "f16": F.lit(PLANTED_TEXT),
                **_texts(),
            }
        ),
        plan,
    )


def row_ids(spark: SparkSession, rows: int) -> DataFrame:
    """Ids from 0, in tasks of equal size: as many as the rows need, and no fewer than the cluster has cores."""
    tasks = max(math.ceil(rows / ROWS_PER_TASK), spark.sparkContext.defaultParallelism)
    return spark.range(0, rows, 1, tasks)


def generate_log(spark: SparkSession, plan: LogPlan) -> DataFrame:
    """Noise and planted rows of a plan as one DataFrame."""
    noise = noise_log(row_ids(spark, plan.noise_rows), plan)
    return noise.unionByName(planted_log(row_ids(spark, plan.planted_rows), plan))
