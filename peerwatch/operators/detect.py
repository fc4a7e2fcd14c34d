"""Mass senders: who sent one text to many different peers in one bucket?"""

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from peerwatch.functions import hours
from peerwatch.functions.text import clean_text, trimmed
from peerwatch.operators.exclusion import BROADCAST_IDS, fits_broadcast, without_listed
from peerwatch.operators.filters import in_window, with_code

#: Error of merged sketches with one register; it falls with the square root of their number.
_MERGED_ERROR = 1.04
PLAIN_KEYS = ("f22", "f02", "f06", "f07")
GROUP_KEYS = ("f22", "f02", "f16", "bk", "ad", "f06", "f07")


def _compact(df: DataFrame, column: str) -> Column:
    """A key to group by: text is trimmed, an integer stays 8 bytes.

    An integer and its decimal text name the same groups, so the cast to text
    can wait until a few result rows are left.
    """
    if isinstance(df.schema[column].dataType, StringType):
        return trimmed(column)
    return F.col(column)


HOURLY = "hourly"


def _integer(column: str) -> Column:
    return F.col(column).try_cast("bigint")


def _batch_column(window, batch_ids) -> Column:
    if batch_ids == HOURLY:
        return hours.next_hour(_integer("f31"), hours.parts_of("_f31"))
    return F.lit(int(window[1] if batch_ids is None else batch_ids)).cast("bigint")


def prepare(
    log: DataFrame,
    window: tuple[int, int],
    *,
    batch_ids=None,
    code: int | None = 49,
    min_len: int = 10,
    bucket_format: str = hours.BUCKET_HOUR,
) -> DataFrame:
    """The log rows of a window, reduced to what the grouping needs."""
    rows = in_window(log, "f31", *window)
    if code is not None:
        rows = with_code(rows, "f14", code)
    rows = rows.where(F.col("f02").isNotNull())

    # Raw length first: normalising never lengthens a text.
    rows = rows.where(F.length("f16") > min_len)
    parts = hours.hour_parts(_integer("f31"), "_f31") if batch_ids == HOURLY else {}
    if not isinstance(log.schema["f30"].dataType, StringType) and hours.has_bucket_key(bucket_format):
        parts |= hours.hour_parts("f30", "_f30")
        bucket = hours.bucket_key("f30", bucket_format, hours.parts_of("_f30"))
    else:
        bucket = hours.bucket_text("f30", bucket_format)

    rows = rows.withColumns(parts).select(
        *[_compact(log, c).alias(c) for c in PLAIN_KEYS],
        _compact(log, "f04").alias("f04"),
        "f16",
        bucket.alias("bk"),
        _batch_column(window, batch_ids).alias("ad"),
    )
    # A list of one text, taken apart: a condition on a plain column is moved
    # before the projection that makes it, and the text normalised for both.
    cleaned = rows.select(*[c for c in rows.columns if c != "f16"], F.explode(F.array(clean_text("f16"))).alias("f16"))
    return cleaned.where(F.length("f16") > min_len)


def count_peers(rows: DataFrame, keys, *, peer: str = "f04", approximate: float | None = None) -> DataFrame:
    """Distinct peers per group.

    Exact by default: rows are first made distinct on (keys, peer), map-side
    and then shuffled on that pair, so a group with a third of all rows is
    spread over every task; only partial counts meet on the group key.
    ``approximate`` gives the relative error of the sketch used instead, which
    needs one shuffle of at most one row per group and task.
    """
    if approximate is not None:
        return merged_peers(peer_sketches(rows, keys, peer=peer, error=approximate), keys)
    return rows.groupBy(*keys).agg(F.count_distinct(peer).alias("cnt"))


def _sketch_bits(error: float) -> int:
    """Size of a sketch, as a power of two, that has the error at most."""
    return min(21, max(4, math.ceil(2 * math.log2(_MERGED_ERROR / error))))


def sketch_error(error: float) -> float:
    """Relative standard error of the sketches made for an error, also when they are merged."""
    return _MERGED_ERROR / math.sqrt(1 << _sketch_bits(error))


def peer_sketches(rows: DataFrame, keys, *, peer: str = "f04", error: float = 0.02) -> DataFrame:
    """(keys, sketch) of the distinct peers of each group, to be stored.

    A sketch lists its values while they are few, so small groups are counted
    as good as exactly.  Sketches of hours are merged to those of days or
    months by :func:`merged_peers`, without the log.
    """
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(peer, F.lit(_sketch_bits(error))).alias("sketch"))


def merged_peers(sketches: DataFrame, keys) -> DataFrame:
    """(keys, cnt) from sketches of the same or smaller groups."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("cnt"))


def _group_hash() -> Column:
    return F.xxhash64(*GROUP_KEYS)


def candidate_groups(
    log: DataFrame, window: tuple[int, int], *, exclusion: DataFrame | None = None, min_peers: int = 10, **options
) -> DataFrame:
    """Hashes of the groups with more than ``min_peers`` rows.

    A group needs more rows than that to have more peers, so no other group
    can pass.  Hashes that coincide only add candidates.  This shuffles a
    hash and a count per group instead of whole texts and peers; see
    ``candidates`` of :func:`mass_senders`.  ``options`` are those of
    :func:`prepare`, with the values given to :func:`mass_senders`.
    """
    rows = prepare(log, window, **options)
    # Listed senders need no place among the candidates if that is cheap to tell.
    if exclusion is not None and fits_broadcast(exclusion):
        rows = without_listed(rows, exclusion, "f02", broadcast=True)
    counted = rows.groupBy(_group_hash().alias("group")).agg(F.count("f04").alias("n"))
    return counted.where(F.col("n") > min_peers).select("group")


def mass_senders(
    log: DataFrame,
    exclusion: DataFrame | None,
    window: tuple[int, int],
    *,
    batch_ids=None,
    code: int | None = 49,
    min_len: int = 10,
    min_peers: int = 10,
    bucket_format: str = hours.BUCKET_HOUR,
    broadcast: bool | None = None,
    approximate: float | None = None,
    observation: Observation | None = None,
    candidates: DataFrame | None = None,
    broadcast_limit: int = BROADCAST_IDS,
) -> DataFrame:
    """Groups (sender, text, bucket, batch, attributes) with more than
    ``min_peers`` distinct peers, without the senders on the list.

    ``window`` is the half-open range of the batch hour.  ``batch_ids`` is
    None (the window's end), one id, or ``HOURLY``: then every row finds its
    own batch, the end of its hour, and any number of hourly rounds is one
    scan and one aggregation.

    A list small enough to broadcast removes rows before the shuffle.  A long
    list is joined after the peer threshold: the sender is a group key, so
    the answer is the same, and only the few remaining groups are shuffled to
    the list instead of the whole log.

    ``candidates`` is a stored result of :func:`candidate_groups`: rows of all
    other groups are dropped before texts are shuffled.  Up to
    ``broadcast_limit`` candidates are broadcast, more are joined by their
    8-byte hash.

    ``observation`` receives ``rows_in``, the log rows of the window that meet
    the row conditions, before the list is applied, from the same pass.
    """
    rows = prepare(
        log, window, batch_ids=batch_ids, code=code, min_len=min_len, bucket_format=bucket_format
    )
    # Counted here, so that the figure is the same for lists of any length.
    if observation is not None:
        rows = rows.observe(observation, F.count(F.lit(1)).alias("rows_in"))

    # Told once for both places where the list may be applied.
    if exclusion is not None and broadcast is None:
        broadcast = fits_broadcast(exclusion)
    if candidates is not None:
        if exclusion is not None and broadcast:
            rows = without_listed(rows, exclusion, "f02", broadcast=True)
            exclusion = None
        few = fits_broadcast(candidates, broadcast_limit)
        groups = F.broadcast(candidates) if few else candidates
        rows = rows.join(groups, _group_hash() == F.col("group"), "left_semi")
    return senders_of(
        rows,
        exclusion,
        window,
        batch_ids=batch_ids,
        min_peers=min_peers,
        bucket_format=bucket_format,
        broadcast=broadcast,
        approximate=approximate,
    )


def senders_of(
    rows: DataFrame,
    exclusion: DataFrame | None,
    window: tuple[int, int],
    *,
    batch_ids=None,
    min_peers: int = 10,
    bucket_format: str = hours.BUCKET_HOUR,
    broadcast: bool | None = None,
    approximate: float | None = None,
) -> DataFrame:
    """:func:`mass_senders` from prepared rows, which may repeat or be distinct already."""
    if exclusion is not None and broadcast is None:
        broadcast = fits_broadcast(exclusion)
    if exclusion is not None and broadcast:
        rows = without_listed(rows, exclusion, "f02", broadcast=True)

    # One id for the whole window needs no place in the shuffled key.
    keys = [k for k in GROUP_KEYS if k != "ad" or batch_ids == HOURLY]
    groups = count_peers(rows, keys, approximate=approximate)
    groups = groups.where(F.col("cnt") > min_peers)
    if exclusion is not None and not broadcast:
        groups = without_listed(groups, exclusion, "f02", broadcast=False)

    if batch_ids != HOURLY:
        groups = groups.withColumn("ad", _batch_column(window, batch_ids))
    return finish(groups, bucket_format)


def finish(groups: DataFrame, bucket_format: str) -> DataFrame:
    """Grouped rows in the column order and types of the batch table."""
    bucket = F.col("bk")
    if not isinstance(groups.schema["bk"].dataType, StringType):
        bucket = hours.bucket_key_text("bk", bucket_format)
    return groups.select(
        F.col("f22").cast("string").alias("f22"),
        F.col("f02").cast("string").alias("f02"),
        "f16",
        "cnt",
        bucket.alias("bd"),
        "ad",
        F.col("f06").cast("string").alias("f06"),
        F.col("f07").cast("string").alias("f07"),
    )
