"""Compare every query with its oracle: columns, types of value, all rows."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def compare(name: str, df, con, sql: str):
    """None if equal, else a short account of the difference."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} and {sorted(relation.columns)}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(relation.columns, relation.fetchall())
    if got == want:
        return None
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} and {len(want)} rows; only here: {extra}; only there: {missing}"


def main(folder: str, names) -> int:
    import __spark_entry__ as contract
    from peerwatch.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in names or queries:
        started = time.perf_counter()
        try:
            df = queries[name](spark, folder)
            note = compare(name, df, con, oracles[name]) if name in oracles else f"no oracle, {df.count()} rows"
            bad = name in oracles and note is not None
        except Exception as error:  # noqa: BLE001 - report and go on
            note, bad = f"{type(error).__name__}: {str(error)[:600]}", True
        failed += bad
        print(f"{'FAIL' if bad else 'ok':5}{name:26}{time.perf_counter() - started:7.2f}s  {note or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
