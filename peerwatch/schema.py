"""Table contracts.

Column names are part of the data contract: a message/call log of 31
fields ``f01``..``f31`` and the tables derived from it.  Every reader in
this package passes one of these schemas, so nothing is ever inferred:
an empty table still has its columns and partition values keep their type.
"""

from pyspark.sql.types import LongType, StringType, StructField, StructType

LONG_FIELDS = ("f01", "f02", "f04", "f06", "f07", "f10", "f14", "f15", "f19", "f22", "f30", "f31")

LOG_COLUMNS = tuple(f"f{i:02d}" for i in range(1, 32))

# Hour columns added from f01.
LOG_PARTITIONS = ("cp", "ld")


def _struct(columns, longs):
    return StructType([StructField(c, LongType() if c in longs else StringType()) for c in columns])


LOG = _struct(LOG_COLUMNS + LOG_PARTITIONS, LONG_FIELDS + LOG_PARTITIONS)

EXCLUSION = _struct(("id", "name"), ("id",))

# One row per (sender, text, bucket, batch): the detection result as computed.
BATCH = _struct(("f22", "f02", "f16", "cnt", "bd", "ad", "f06", "f07"), ("cnt", "ad"))

# The same result as stored: partition columns last, the batch id leading so
# that one batch is one directory.
RESULT = _struct(("f22", "f02", "f16", "cnt", "f06", "f07", "ad", "bd"), ("cnt", "ad"))
RESULT_PARTITIONS = ("ad", "bd")

BATCH_LOG = _struct(("batchId",), ())

LATEST = _struct(("f22", "f02", "f16", "cnt", "bd", "f06", "f07"), ("cnt",))

SEEN = _struct(("f22", "f02", "f_date", "l_date", "f06", "f07"), ())

RUN_METRICS = _struct(
    ("job", "batchId", "rows_in", "rows_out", "millis"), ("batchId", "rows_in", "rows_out", "millis")
)
