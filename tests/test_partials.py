from conftest import rows_of
from test_detect import random_rows

from peerwatch.functions import hours
from peerwatch.operators.detect import HOURLY, mass_senders
from peerwatch.operators.sample import build_exclusion, merged_exclusion
from peerwatch.schema import EXCLUSION
from peerwatch.sources.logs import literal_rows
from peerwatch.sources.partials import PeerPartials

WINDOW = (2023022800, 2023030200)


def test_any_window_from_stored_hours(spark, make_log, folder):
    """Hours that do not exist, NULL peers, a list and other windows than those that were added."""
    log = make_log(random_rows(4, 4000, bad=0.1)).persist()
    stored = PeerPartials(spark, folder, bucket_format=hours.BUCKET_DAY).create()
    middle = 2023022813
    stored.add(log, (WINDOW[0], middle))
    stored.add(log, (middle, WINDOW[1]))
    listed = literal_rows(spark, [(3, "c")], EXCLUSION)
    for window in (WINDOW, (2023022806, 2023030105)):
        for options in ({"min_peers": 1}, {"min_peers": 0, "batch_ids": HOURLY}, {"min_peers": -1, "broadcast": False}):
            want = rows_of(mass_senders(log, listed, window, bucket_format=hours.BUCKET_DAY, **options))
            got = stored.mass_senders(listed, window, **options)
            assert rows_of(got) == want and want
            assert "LocalTableScan" not in got._jdf.queryExecution().optimizedPlan().toString().split("LeftAnti")[0]
    log.unpersist()


def test_hours_are_replaced(spark, make_log, folder):
    """Hours of the window that have no rows any more go, those outside stay; an empty log is no error."""
    rows = [{"f31": h, "f30": h, "f04": p} for h in (2023032301, 2023032302, 2023032305) for p in range(3)]
    stored = PeerPartials(spark, folder).create()
    assert stored.stored_hours() == [] and stored.read((0, 9999123123)).count() == 0
    stored.add(make_log(rows), (2023032300, 2023032306))
    assert stored.stored_hours() == [2023032302, 2023032303, 2023032306]
    stored.add(make_log(rows[:1] * 2), (2023032300, 2023032304))
    assert stored.stored_hours() == [2023032302, 2023032306]
    assert stored.read((2023032300, 2023032306)).count() == 4
    stored.add(make_log([]), (2023032300, 2023032304))
    assert stored.stored_hours() == [2023032306]


def test_merged_list_is_that_of_the_whole_log(spark, make_log):
    log = make_log([{"f02": i % 300, "f03": f"n{i % 7}"} for i in range(2000)])
    whole = build_exclusion(log, 50, keep_out=(10, 20), seed=5)
    parts = [build_exclusion(log.where(f"f02 % 3 = {k}"), 50, keep_out=(10, 20), seed=5) for k in range(3)]
    merged = merged_exclusion(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[0]), 50, seed=5)
    assert rows_of(merged) == rows_of(whole) and len(rows_of(whole)) == 50
