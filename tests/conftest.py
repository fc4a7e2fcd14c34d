import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from peerwatch.schema import LOG  # noqa: E402
from peerwatch.session import local_session, work_folder  # noqa: E402
from peerwatch.sources.logs import literal_rows  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return work_folder(spark)


@pytest.fixture
def make_log(spark):
    """Log rows from dicts; what is not given is a plain value."""
    plain = {"f02": 1, "f04": 1, "f06": 0, "f07": 7, "f14": 49, "f16": "hello big world", "f22": 3}

    def make(rows):
        full = []
        for row in rows:
            values = {**plain, "f30": row.get("f31", 2023032301), "f31": row.get("f30", 2023032301), **row}
            full.append(tuple(values.get(c) for c in LOG.names))
        return literal_rows(spark, full, LOG)

    return make


def rows_of(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
