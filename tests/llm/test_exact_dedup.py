import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from peerwatch.llm.exact_dedup import exact_duplicates

ROWS = [
    (3, "a  b\tc", "x"), (1, "a b c", "y"), (2, "", None), (4, None, "z"), (None, "a b\u000bc", "n"),
    (5, "é" * 9000, ""), (6, "é" * 9000, ""), (7, "é" * 8999 + "e", ""), (8, "x" * 70_000 + "1", ""),
    (9, "x" * 70_000 + "2", ""), (10, "x" * 70_000 + "1", ""), (11, "a b c", ""), (1, "a b c", "again"), (1, "other", "same id"),
]


def brute(rows):
    groups = defaultdict(list)
    for i, (doc, text, _) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append((doc is None, doc or 0, i, doc))
    out = []
    for text, members in groups.items():
        first = min(members)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(m[3], first[3], len(members), m[2] == first[2], sha) for m in members]
    return sorted(map(repr, out))


@pytest.mark.parametrize("options", [{}, {"block_bytes": 7}, {"block_bytes": 64, "key": lambda b: (F.octet_length(b) % 3).cast("long")}])
def test_against_brute_force(spark, options):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, name string").coalesce(1)
    got = exact_duplicates(spark, docs, **options).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(ROWS)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, block string, key int")
    assert exact_duplicates(spark, docs).count() == 0
