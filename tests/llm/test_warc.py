import base64
import gzip
import hashlib
import io
from pathlib import Path

from peerwatch.llm.warc import WarcReader, op10_warc, read_archive, records, write_archive

ROWS = [
    (1, "http://a/ b\r\nX: y", "<p>é\r\n\r\nWARC/1.1\r\n", 0), (2, None, "", 1), (3, "u", None, 2), (4, "u", "<p>same", 3), (7, "u", "<p>same", 4),
    (7, "u", "<p>same", 5), (5, "u", "x" * 300_000, 6), (None, "u", "<p>same", 7), (None, None, "<p>alone", 8),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark, folder):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, size int")
    pages.write.parquet(f"{folder}/pages.parquet")
    got = sorted(repr(tuple(r)) for r in op10_warc(spark, folder).collect())
    holder = {}
    for p, _, h, _ in ROWS:
        if p is not None:
            holder[h or ""] = max(holder.get(h or "", p), p)
    want = []
    for p, _, h, _ in ROWS:
        top = holder.get(h or "")
        first = top is None or p == top
        want.append((p, len((h or "").encode()), digest(h), "response" if first else "revisit", None if first else top))
    assert got == sorted(map(repr, want))


def test_empty(spark, folder):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    assert op10_warc(spark, folder).count() == 0


def test_predicates_reach_the_source(spark, folder):
    write_archive(spark.createDataFrame(ROWS, "page_id long, url string, html string, x int"), folder)
    df = read_archive(spark, folder).where("record_type = 'response' and content_length > 100000")
    assert [r.payload_bytes for r in df.collect()] == [300_000]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("record_type") and "Filter" in plan and "isnotnull(record_type" not in plan.split("Filter")[1].split("\n")[0]
    none = read_archive(spark, folder, payload=False)
    assert none.where("payload is not null").count() == 0 and none.count() == len(ROWS)


def test_any_warc_file():
    record = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <%s>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    parts = [record % (b"warcinfo", b"i", 4, b"a: b"), record % (b"resource", b"r", 6, b"\xff\x00\r\n\r\n"), record % (b"request", b"q", 0, b"")]
    got = list(records(io.BufferedReader(io.BytesIO(b"".join(parts))), lambda row: row["record_type"] != "warcinfo", True))
    assert [(r["record_id"], r["payload"]) for r in got] == [("<r>", b"\xff\x00\r\n\r\n"), ("<q>", b"")]


def test_members_and_bins(tmp_path: Path):
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record))
    (tmp_path / "b.warc").write_bytes(record)
    (tmp_path / "_SUCCESS").write_bytes(b"")
    reader = WarcReader({"path": str(tmp_path)})
    (part,) = reader.partitions()
    assert sum(b.num_rows for b in reader.read(part)) == 3
