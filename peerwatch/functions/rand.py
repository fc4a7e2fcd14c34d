"""Repeatable pseudo-random columns.

Every value is a function of (seed, row id, stream name) through a digest, so a
row does not depend on the partition or the executor that makes it: lost
tasks are redone with equal values, and any engine with ``md5`` and
``sha256`` agrees.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _keyed(seed: int, row_id: Column, stream: str) -> Column:
    return F.concat(F.lit(f"{seed}|"), row_id.cast("string"), F.lit(f"|{stream}"))


def digest(seed: int, row_id: Column, stream: str) -> Column:
    """32 hexadecimal digits for this row and stream."""
    return F.md5(_keyed(seed, row_id, stream))


def hex_number(hex_text: Column, first: int, digits: int = 15) -> Column:
    """The integer of ``digits`` hexadecimal digits; 15 fit a bigint."""
    return F.conv(F.substring(hex_text, first, digits), 16, 10).cast("bigint")


def letters(seed: int, row_id: Column, stream: str, blocks: int) -> Column:
    """At least 32 characters per block, each uniform in [a-zA-Z0-9].

    Base64 characters are uniform in 64 symbols; dropping the two that are no
    letters or digits keeps the rest uniform.  A block is a 256-bit digest,
    42 symbols, of which one or two are dropped as a rule and never ten on
    the average of several blocks.  Many short texts are cut out of one such
    string: one conversion per row instead of one per column.
    """
    digests = [F.sha2(_keyed(seed, row_id, f"{stream}-{i}"), 256) for i in range(blocks)]
    symbols = F.base64(F.unhex(F.concat(*digests)))
    # Far cheaper than translate, which maps every character.  Spark breaks long
    # base64 texts into lines.
    for other in "+/=\r\n":
        symbols = F.replace(symbols, F.lit(other), F.lit(""))
    return symbols
