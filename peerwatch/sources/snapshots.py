"""Tables that are rebuilt as a whole and swapped in one step, without a
catalog.

Each build is written to a folder of its own, also if two are built at a time.
A row in a small pointer table makes it current, and is only added once the
build is complete: readers and failed runs keep the former version.  A build
may read the current version, which an in-place overwrite could not.  The
former version is kept for readers that have begun, older ones are removed.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from peerwatch.session import remove_folder
from peerwatch.sources.logs import empty, literal_rows

_POINTER = StructType([StructField("version", LongType()), StructField("folder", StringType())])


class Snapshot:
    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def create(self) -> "Snapshot":
        """Version 0 has no rows."""
        folder = self._write(empty(self.spark, self.schema), 0)
        self._point(0, folder, "overwrite")
        return self

    def _versions(self) -> list:
        """The newest first; of one number the last folder name counts."""
        rows = self.spark.read.schema(_POINTER).parquet(f"{self.path}/pointer")
        found = rows.orderBy(F.desc("version"), F.desc("folder")).limit(3).collect()
        if not found:
            raise LookupError(f"no version of {self.path}")
        return found

    def version(self) -> int:
        return self._versions()[0]["version"]

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{self._versions()[0]['folder']}")

    def swap(self, rows: DataFrame) -> int:
        """Write ``rows`` as the next version and make it the current one."""
        known = self._versions()
        version = known[0]["version"] + 1
        folder = self._write(rows.select(*self.schema.names), version)
        self._point(version, folder, "append")
        for old in known[1:]:
            remove_folder(self.spark, f"{self.path}/{old['folder']}")
        return version

    def truncate(self) -> int:
        return self.swap(empty(self.spark, self.schema))

    def _write(self, rows: DataFrame, version: int) -> str:
        folder = f"v{version}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def _point(self, version: int, folder: str, mode: str) -> None:
        row = literal_rows(self.spark, [(version, folder)], _POINTER)
        row.write.mode(mode).option("partitionOverwriteMode", "static").parquet(f"{self.path}/pointer")
