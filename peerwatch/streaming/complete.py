"""Hourly batches from a stream that loses no row.

The streaming form in ``hourly`` drops rows that come after their hour is
closed, and never gives out the newest hour.  Here every micro-batch only
stores its distinct (group, peer) rows, which is all that counting needs, and
hours are counted from what is stored:

* ``keep`` writes a micro-batch below its number and replaces what a failed
  attempt left there, so each row counts once;
* rows of hours that were published before are noted in a side table;
* ``publish`` counts the hours that have closed since the last time, and again
  those of the side table; ``close`` does so for the open hours, too.

A distinct count is merged from distinct rows, so the result does not depend
on how rows are spread over micro-batches or in which order they come.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from peerwatch.operators.detect import HOURLY, prepare, senders_of
from peerwatch.schema import LOG
from peerwatch.session import child_names
from peerwatch.sources.logs import empty
from peerwatch.sources.results import ResultStore

EVER = (1000_01_01_00, 9999_12_31_23)
_LATE = "ad bigint, rows bigint, micro bigint"
_PUBLISHED = "until bigint, micro bigint"


def _day(hour: Column) -> Column:
    return F.floor(hour / 100).cast("bigint")


class CompleteHours:
    """Stored rows, late hours, what was published, and the results, below one path.

    ``keep`` may run beside ``publish``, which only reads micro-batches that
    were written to their end; ``publish`` itself is run once at a time.
    """

    def __init__(self, spark: SparkSession, path: str, *, code: int | None = 49, min_len: int = 10):
        self.spark, self.path = spark, path.rstrip("/")
        self.results = ResultStore(spark, f"{self.path}/results")
        self._conditions = {"code": code, "min_len": min_len}
        self.schema = self._rows(empty(spark, LOG)).schema

    def _rows(self, log: DataFrame) -> DataFrame:
        return prepare(log, EVER, batch_ids=HOURLY, **self._conditions)

    def create(self) -> "CompleteHours":
        """Start (again) without any row; give the stream a new checkpoint, too."""
        self.results.create()
        for name, schema in (("pairs", self.schema), ("late", _LATE), ("published", _PUBLISHED)):
            none = self.spark.createDataFrame([], schema)
            none.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/{name}")
        return self

    # --- the stream ---------------------------------------------------------

    def run(self, log: DataFrame, checkpoint: str) -> None:
        """Keep all that is there, then stop.  Start it again with the same checkpoint to go on."""
        writer = log.writeStream.foreachBatch(self.keep).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()

    def keep(self, batch: DataFrame, micro: int) -> None:
        """Store one micro-batch; the same number again replaces it."""
        folder = f"{self.path}/pairs/micro={int(micro)}"
        pairs = self._rows(batch).distinct()
        # A folder a day, sorted by hour: few files, and an hour's rows lie in few row groups.
        pairs = pairs.withColumn("day", _day(F.col("ad"))).hint("rebalance", "day").sortWithinPartitions("day", "ad")
        pairs.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(folder)
        until, _ = self._last()
        late = self._stored([micro]).where((F.col("day") <= _day(F.lit(until))) & (F.col("ad") <= until))
        counted = late.groupBy("ad").agg(F.count(F.lit(1)).alias("rows")).withColumn("micro", F.lit(int(micro)).cast("bigint"))
        counted.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/late/of={int(micro)}")

    # --- the results --------------------------------------------------------

    def publish(self, exclusion: DataFrame | None, until: int, *, min_peers: int = 10, broadcast: bool | None = None) -> list[int]:
        """Make the results of all hours up to ``until`` those of all rows kept so far; returns the hours counted.

        The results are replaced hour by hour, then it is noted that they are
        there: a failure in between is mended by the next call.
        """
        before, settled = self._last()
        micros = self._finished()
        if not micros:
            return []
        stored = self._stored(micros)
        after, upto = F.lit(before), F.lit(int(until))
        new = stored.where(F.col("day").between(_day(after), _day(upto)) & (F.col("ad") > after) & (F.col("ad") <= upto)).select("ad")
        again = self.late().where((F.col("micro") > settled) & F.col("micro").isin(micros) & (F.col("ad") <= before)).select("ad")
        # One value for each hour, never rows.
        hours = sorted(r.ad for r in new.union(again).distinct().collect())
        if hours:
            # The days prune folders, the hours row groups.
            wanted = F.col("day").isin(sorted({h // 100 for h in hours})) & F.col("ad").isin(hours)
            rows = stored.where(wanted).select(*self.schema.names)
            found = senders_of(rows, exclusion, EVER, batch_ids=HOURLY, min_peers=min_peers, broadcast=broadcast)
            self.results.replace_batches(found, hours)
        done = self.spark.createDataFrame([(max(before, int(until)), max(micros))], _PUBLISHED)
        done.write.mode("append").parquet(f"{self.path}/published")
        return hours

    def close(self, exclusion: DataFrame | None, **options) -> list[int]:
        """Publish all hours, also those that are still open."""
        micros = self._finished()
        newest = self._stored(micros).agg(F.max("ad")).first()[0] if micros else None
        return self.publish(exclusion, self._last()[0] if newest is None else newest, **options)

    def late(self) -> DataFrame:
        """(ad, rows, micro): distinct rows that came after their hour was published."""
        folders = [f"{self.path}/late/{n}" for n in child_names(self.spark, f"{self.path}/late") if n.startswith("of=")]
        return self.spark.read.schema(_LATE).parquet(*folders) if folders else self.spark.createDataFrame([], _LATE)

    def _finished(self) -> list[int]:
        """Micro-batches that are stored as a whole."""
        names = [n for n in child_names(self.spark, f"{self.path}/pairs") if n.startswith("micro=")]
        whole = [n for n in names if "_SUCCESS" in child_names(self.spark, f"{self.path}/pairs/{n}")]
        return sorted(int(n.removeprefix("micro=")) for n in whole)

    def _stored(self, micros) -> DataFrame:
        folders = [f"{self.path}/pairs/micro={int(m)}" for m in micros]
        schema = StructType([*self.schema.fields, StructField("day", LongType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/pairs").parquet(*folders)

    def _last(self) -> tuple[int, int]:
        """(newest published hour, newest micro-batch in it)."""
        row = self.spark.read.schema(_PUBLISHED).parquet(f"{self.path}/published").agg(F.max("until"), F.max("micro")).first()
        return (EVER[0], -1) if row[0] is None else (row[0], row[1])
