"""The same questions in ANSI SQL, to be run by DuckDB on the same tables.

Written independently of the library: text functions, calendar and digests
are DuckDB's own.
"""

from peerwatch.plans.catalogue import EVENTS, EVENTS_SPLIT, ORDERS, ORDERS_SPLIT, PLAN
from peerwatch.sources.generator import SHORT_TEXTS

HOUR, DAY, MONTH = "%Y-%m-%d-%H", "%Y-%m-%d", "%Y-%m"

ORDER_LOG = """
SELECT l_suppkey AS f02, s_name AS f03, l_orderkey AS f04, 0::BIGINT AS f06, 7::BIGINT AS f07, 49::BIGINT AS f14,
       concat('  msg??? ', s_name, ' ', chr(9), ' 000 ') AS f16, 3::BIGINT AS f22,
       strftime(l_shipdate, '%Y%m%d%H')::BIGINT AS f30, strftime(l_shipdate, '%Y%m%d%H')::BIGINT AS f31
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
"""
ORDER_LIST = "SELECT s_suppkey AS id FROM supplier WHERE s_acctbal < 1000"

EVENT_LOG = """
SELECT number AS f02, event_type AS f03, user_id AS f04, 0::BIGINT AS f06, 7::BIGINT AS f07, 49::BIGINT AS f14,
       concat('  event??? ', event_type, ' ', chr(9), ' 000 ') AS f16, 3::BIGINT AS f22,
       strftime(ts, '%Y%m%d%H')::BIGINT AS f30, strftime(ts, '%Y%m%d%H')::BIGINT AS f31
FROM events
JOIN (VALUES ('click', 1::BIGINT), ('error', 2), ('purchase', 3), ('signup', 4), ('view', 5)) AS t(kind, number)
  ON kind = event_type
"""
EVENT_LIST = "SELECT 2 AS id"


def squeezed(text: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"


def normal(text: str) -> str:
    marks = squeezed(f"trim({text})", r"\?+", "?")
    return squeezed(squeezed(marks, "0+", "0"), "[ \\t]+", " ")


def hour_text(hour: str, form: str) -> str:
    return f"strftime(try_strptime({hour}::VARCHAR, '%Y%m%d%H'), '{form}')"


NEXT_HOUR = "strftime(strptime(f31::VARCHAR, '%Y%m%d%H') + INTERVAL 1 HOUR, '%Y%m%d%H')::BIGINT"


def batch(log, listed, window, form, peers=10, ad=None) -> str:
    """Detection over a window; ``ad`` is the batch id expression."""
    start, end = window
    return f"""
    SELECT f22::VARCHAR AS f22, f02::VARCHAR AS f02, message AS f16, count(DISTINCT f04) AS cnt, bd, ad,
           f06::VARCHAR AS f06, f07::VARCHAR AS f07
    FROM (
      SELECT l.*, {normal('l.f16')} AS message, {hour_text('l.f30', form)} AS bd, {ad or f'{end}::BIGINT'} AS ad
      FROM ({log}) AS l
      WHERE f14 = 49 AND f31 >= {start} AND f31 < {end}
        AND f02 IS NOT NULL AND f02 NOT IN (SELECT id FROM ({listed}) AS x)
    ) AS r
    WHERE length(message) > 10
    GROUP BY f22, f02, message, bd, ad, f06, f07
    HAVING count(DISTINCT f04) > {peers}
    """


BULK = batch(ORDER_LOG, ORDER_LIST, ORDERS, MONTH)
BULK_OLD = batch(ORDER_LOG, ORDER_LIST, (ORDERS[0], ORDERS_SPLIT), MONTH)
BULK_NEW = batch(ORDER_LOG, ORDER_LIST, (ORDERS_SPLIT, ORDERS[1]), MONTH)
DAILY = batch(EVENT_LOG, EVENT_LIST, EVENTS, DAY)
DAILY_OLD = batch(EVENT_LOG, EVENT_LIST, (EVENTS[0], EVENTS_SPLIT), DAY)
HOURLY = batch(EVENT_LOG, EVENT_LIST, EVENTS, HOUR, 1, NEXT_HOUR)
STREAMED = batch(EVENT_LOG, EVENT_LIST, EVENTS, HOUR, 4, NEXT_HOUR)

# The stored event results: 29 days at once, then 24 hourly batches.
LOADED_BULK = batch(EVENT_LOG, EVENT_LIST, (EVENTS[0], EVENTS_SPLIT), DAY, 1)
LOADED_DAY = batch(EVENT_LOG, EVENT_LIST, (EVENTS_SPLIT, EVENTS[1]), DAY, 1, NEXT_HOUR)
LOADED = f"SELECT * FROM ({LOADED_BULK}) AS a UNION ALL SELECT * FROM ({LOADED_DAY}) AS b"
LAST_DAY_IDS = f"""
SELECT strftime(h, '%Y%m%d%H')::BIGINT AS id
FROM generate_series(strptime('{EVENTS_SPLIT}', '%Y%m%d%H') + INTERVAL 1 HOUR,
                     strptime('{EVENTS[1]}', '%Y%m%d%H'), INTERVAL 1 HOUR) AS g(h)
"""


def latest(result: str) -> str:
    return f"""
    SELECT f22, f02, f16, cnt, bd, f06, f07 FROM (
      SELECT *, row_number() OVER (
        PARTITION BY f02
        ORDER BY bd DESC NULLS LAST, ad DESC NULLS LAST, cnt DESC NULLS LAST,
                 f22 NULLS LAST, f16 NULLS LAST, f06 NULLS LAST, f07 NULLS LAST) AS place
      FROM ({result}) AS r) AS p
    WHERE place = 1
    """


def seen(result: str) -> str:
    return (
        f"SELECT f22, f02, min(bd) AS f_date, max(bd) AS l_date, f06, f07 FROM ({result}) AS r "
        "GROUP BY f22, f02, f06, f07"
    )


def sampled(rows: str, columns, n: int, seed: int) -> str:
    values = ", '|', ".join(f"coalesce({c}::VARCHAR, '')" for c in columns)
    names = ", ".join(columns)
    return f"SELECT {names} FROM ({rows}) AS r ORDER BY md5(concat('{seed}|', {values})), {names} LIMIT {n}"


# --- generated rows -------------------------------------------------------------


def _digest(kind: str, stream: str, row: str = "id") -> str:
    return f"md5(concat('{PLAN.seed}|', {row}, '|{kind}-{stream}'))"


def _number(digest: str, first: int) -> str:
    return f"('0x' || substr({digest}, {first}, 15))::BIGINT"


def _letters(kind: str) -> str:
    blocks = ", ".join(f"sha256(concat('{PLAN.seed}|', id, '|{kind}-texts-{i}'))" for i in range(7))
    return f"translate(to_base64(unhex(concat({blocks}))), '+/=', '')"


def generated(kind: str, ids: str, batch_rows: int, fields: dict, message: str, older: tuple[str, str] | None = None) -> str:
    span = PLAN.end - PLAN.start
    texts = {c: f"substr(letters, {1 + 10 * i}, 10)" for i, c in enumerate(SHORT_TEXTS)}
    hour = "strftime(make_timestamp(({})::BIGINT * 1000000), '%Y%m%d%H')" + ("" if older else "::BIGINT")
    columns = {
        "f01": "f01",
        **fields,
        **texts,
        "f16": message,
        "f30": hour.format(older[0] if older else "f30"),
        "f31": hour.format(older[1] if older else "f30"),
        "cp": hour.format("f01"),
        "ld": hour.format("f01"),
    }
    select = ", ".join(f"{v} AS {k}" for k, v in sorted(columns.items()))
    return f"""
    WITH drawn AS MATERIALIZED (
      SELECT id, (id // {batch_rows}) % {PLAN.rounds} AS turn, {_letters(kind)} AS letters,
             {_number(_digest(kind, 'numbers'), 1)} AS a, {_number(_digest(kind, 'numbers'), 16)} AS b,
             {_number(_digest(kind, 'times'), 1)} AS t1, {_number(_digest(kind, 'times'), 16)} AS t2
      FROM ({ids}) AS i),
    placed AS (
      SELECT id, turn, a, b, letters, base, length, base + t1 % length AS f01, base + t2 % length AS f30
      FROM (SELECT *, {PLAN.start} + turn * {span} // {PLAN.rounds} AS base,
                   greatest((turn + 1) * {span} // {PLAN.rounds} - turn * {span} // {PLAN.rounds}, 1) AS length
            FROM drawn) AS s)
    SELECT {select} FROM placed
    """


_DIGIT = "((a // {}) % 10)"
_NOISE_PARTS = (
    "noise",
    "SELECT o_orderkey AS id FROM orders",
    PLAN.batch_rows,
    {
        "f02": "(19200000000 + a % 20000000)",
        "f04": "(19200000000 + b % 20000000)",
        **{c: _DIGIT.format(20_000_000 * 10**i) for i, c in enumerate(("f06", "f07", "f10", "f15", "f19"))},
        "f14": "(48 + (b // 20000000) % 3)",
        "f22": "(1 + (b // 60000000) % 9)",
    },
    f"substr(letters, 181, 2 + {_number(_digest('noise', 'length', 'turn'), 1)} % 29)",
)
NOISE = generated(*_NOISE_PARTS)
_PLANTED_FIELDS = {
    "f02": "(19218983880 + a % 10)",
    "f04": "(19200000000 + b % 20000000)",
    **{c: _DIGIT.format(20_000_000 * 10**i) for i, c in enumerate(("f10", "f15", "f19"))},
    "f06": "0::BIGINT",
    "f07": "7::BIGINT",
    "f14": "49::BIGINT",
    "f22": "3::BIGINT",
}
PLANTED = generated(
    "planted", "SELECT c_custkey AS id FROM customer", PLAN.planted_batch, _PLANTED_FIELDS, "'Great you found me !'"
)
# The older form: hours of the round for noise, hours and codes of their own for planted rows, all hours as text.
_ENDS = _number(_digest("planted", "ends"), 1)
OLDER_NOISE = generated(*_NOISE_PARTS, older=("base", "base + length"))
OLDER_PLANTED = generated(
    "planted",
    "SELECT c_custkey AS id FROM customer",
    PLAN.planted_batch,
    {**_PLANTED_FIELDS, "f14": "(48 + (b // 20000000) % 3)"},
    "'Great you found me !'",
    older=("f30", f"base + {_ENDS} % length"),
)
GENERATED = f"SELECT * FROM ({NOISE}) AS n UNION ALL SELECT * FROM ({PLANTED}) AS p"
GENERATED_LIST = sampled(
    f"SELECT DISTINCT f02 AS id, f03 AS name FROM ({GENERATED}) AS g WHERE f02 < 19218983880 OR f02 > 19218983890",
    ("id", "name"),
    100,
    3,
)

# Rows per hour and kind of a 24-hour plan sized by the line items.
_DAY_START = PLAN.end - 86_400


def _sized(kind: str, batch_rows: int, planted: str) -> str:
    t = _number(f"md5(concat('{PLAN.seed}|', id, '|{kind}-times'))", 1)
    return f"""
    SELECT strftime(make_timestamp((base + {t} % length) * 1000000), '%Y%m%d%H')::BIGINT AS cp, {planted} AS planted
    FROM (
      SELECT id, {_DAY_START} + turn * 86400 // rounds AS base,
             greatest((turn + 1) * 86400 // rounds - turn * 86400 // rounds, 1) AS length
      FROM (SELECT id, (id // {batch_rows}) % rounds AS turn, rounds
            FROM (SELECT unnest(range(rounds * {batch_rows})) AS id, rounds FROM plan) AS i) AS s) AS d
    """


SIZED = f"""
WITH plan AS (SELECT ceil(count(*) / 4000 / 1024 * 1024)::BIGINT AS rounds FROM lineitem)
SELECT cp, planted, count(*) AS "rows"
FROM ({_sized('noise', 4000, 'false')} UNION ALL {_sized('planted', 400, 'true')}) AS g
GROUP BY cp, planted
"""


def profiled(rows: str, columns) -> str:
    parts = []
    for name, textual in columns:
        length = f"length({name})" if textual else "NULL::BIGINT"
        parts.append(
            f"SELECT '{name}' AS \"column\", count(*) AS \"rows\", count(*) - count({name}) AS nulls, "
            f"min({name})::VARCHAR AS min, max({name})::VARCHAR AS max, "
            f"(sum({length}) / count({name}))::DOUBLE AS avg_len, max({length})::BIGINT AS max_len FROM log"
        )
    return f"WITH log AS ({rows}) " + " UNION ALL ".join(parts)


ORDERED_COLUMNS = [
    ("f02", False),
    ("f03", True),
    ("f04", False),
    ("f06", False),
    ("f07", False),
    ("f14", False),
    ("f16", True),
    ("f22", False),
    ("f30", False),
    ("f31", False),
]



def exact_values(rows: str, columns) -> str:
    parts = [f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS exact, true AS near FROM log" for c, _ in columns]
    return f"WITH log AS ({rows}) " + " UNION ALL ".join(parts)


def rows_between(start: int, end: int) -> str:
    return f"(SELECT count(*) FROM ({EVENT_LOG}) AS e WHERE f31 >= {start} AND f31 < {end})"


# The last day run again with a threshold of three peers.
RELOADED_DAY = batch(EVENT_LOG, EVENT_LIST, (EVENTS_SPLIT, EVENTS[1]), DAY, 3, NEXT_HOUR)
RELOADED = f"SELECT * FROM ({LOADED_BULK}) AS a UNION ALL SELECT * FROM ({RELOADED_DAY}) AS b"

_WINDOWED = f"SELECT f02, f04, f31 FROM ({ORDER_LOG}) AS l WHERE f31 >= 1997010100 AND f31 < 1999010100"
_KEPT = f"SELECT f02, f04, f31 FROM ({ORDER_LOG}) AS l WHERE f02 NOT IN (SELECT id FROM ({ORDER_LIST}) AS x)"
_PADDED = "concat('  ?? ', text, ' 100  ', chr(9), '? ')"
_SEGMENT = "CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END"
_EVENT_HOUR = "strftime(ts, '%Y%m%d%H')::BIGINT"

TEXT_KEY = f"""
    SELECT CASE WHEN f04 % 2 = 0 THEN f02::VARCHAR ELSE 'x' || f02 END AS f02, f04, f31 FROM ({ORDER_LOG}) AS l
    WHERE f04 % 2 <> 0 OR f02 NOT IN (SELECT id FROM ({ORDER_LIST}) AS x)"""

ORACLES = {
    "bulk_batch": BULK,
    "bulk_batch_long_list": BULK,
    "bulk_batch_two_steps": BULK,
    "bulk_batch_two_steps_shuffled": BULK,
    "peer_count_sketch": f"SELECT f02, {hour_text('f31', MONTH)} AS bd, true AS near FROM ({ORDER_LOG}) AS l GROUP BY 1, 2",
    "peer_count_merged": f"SELECT f02, {hour_text('f31', MONTH)} AS bd, true AS near FROM ({ORDER_LOG}) AS l GROUP BY 1, 2",
    "column_profile_distinct": exact_values(ORDER_LOG, ORDERED_COLUMNS),
    "batch_replace_dynamic": f"SELECT * FROM ({BULK}) AS a UNION ALL SELECT * FROM ({DAILY}) AS b",
    "batch_replace_empty_dynamic": DAILY,
    "truncate_table_dynamic": f'SELECT count(*) AS "before", 0::BIGINT AS "after" FROM ({BULK}) AS r',
    "overwrite_batch_dynamic": BULK,
    "replace_escaped_buckets": DAILY,
    "replace_escaped_buckets_by_name": DAILY,
    "rerun_smaller": f"""
        SELECT 'results' AS what, f02, bd, cnt::VARCHAR AS value FROM ({RELOADED}) AS a
        UNION ALL SELECT 'latest', f02, bd, cnt::VARCHAR FROM ({latest(RELOADED)}) AS b
        UNION ALL SELECT 'seen', f02, f_date, l_date FROM ({seen(RELOADED)}) AS c
        UNION ALL SELECT 'log', '', '', id::VARCHAR FROM (SELECT {EVENTS_SPLIT} AS id UNION ALL {LAST_DAY_IDS}) AS d""",
    "daily_batch": DAILY,
    "hourly_batches": HOURLY,
    "batch_view": BULK,
    "peer_count": f"SELECT f02, {hour_text('f31', MONTH)} AS bd, count(DISTINCT f04) AS cnt "
    f"FROM ({ORDER_LOG}) AS l GROUP BY 1, 2",
    "clean_text": f"SELECT doc_id, {normal(_PADDED)} AS clean FROM documents",
    "squeeze_runs": f"""
        SELECT f02, f04, f02::VARCHAR AS number, trim(f16) AS trimmed, {squeezed('f16', chr(92) + '?+', '?')} AS marks,
               {squeezed('f16', '0+', '0')} AS zeros, {squeezed('f16', '[ ' + chr(92) + 't]+', ' ')} AS blanks
        FROM ({ORDER_LOG}) AS l""",
    "is_null_flag": f"SELECT c_custkey, CASE WHEN coalesce({_SEGMENT}, '') = '' THEN 0 ELSE 1 END AS filled "
    "FROM customer",
    "hour_window": _WINDOWED,
    "text_hour_window": f"SELECT f02, f04, f31::VARCHAR AS f31 FROM ({_WINDOWED}) AS w",
    "typed_code_filter": "SELECT l_orderkey, l_suppkey, (l_linenumber + 47)::BIGINT AS f14 FROM lineitem "
    "WHERE l_linenumber = 2",
    "length_filter": f"SELECT doc_id FROM documents WHERE length({normal('text')}) > 1000",
    "range_filter": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT BETWEEN 300 AND 600",
    "hour_columns": f"SELECT event_id, {_EVENT_HOUR} AS cp, {_EVENT_HOUR} AS ld FROM events",
    "bucket_texts": f"""
        SELECT f02, f04, {hour_text('f31', HOUR)} AS hour, {hour_text('f31', DAY)} AS day,
               {hour_text('f31', MONTH)} AS month, {hour_text('(f31 + 75)', HOUR)} AS no_hour
        FROM ({EVENT_LOG}) AS l""",
    "hour_arithmetic": f"""
        SELECT f31, {NEXT_HOUR} AS next_hour, {NEXT_HOUR.replace('1 HOUR', '1 DAY')} AS next_day,
               {NEXT_HOUR.replace('+ INTERVAL 1 HOUR', '- INTERVAL 7 DAY')} AS week_ago
        FROM ({EVENT_LOG}) AS l""",
    "anti_join": _KEPT,
    "anti_join_long_list": _KEPT,
    "anti_join_text_key_long_list": TEXT_KEY,
    "anti_join_text_key": TEXT_KEY,
    "distinct_pairs": f"SELECT DISTINCT f02 AS id, f03 AS name FROM ({ORDER_LOG}) AS l WHERE f02 < 10 OR f02 > 20",
    "exclusion_list": sampled(
        f"SELECT DISTINCT f02 AS id, f03 AS name FROM ({ORDER_LOG}) AS l WHERE f02 < 10 OR f02 > 20",
        ("id", "name"),
        40,
        3,
    ),
    "seeded_sample": sampled(
        "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem", ("l_orderkey", "l_partkey"), 20_000, 3
    ),
    "random_sample": """
        SELECT least(count(*), 500) AS "rows", least(count(*), 500) AS different, least(count(*), 500) AS real FROM orders""",
    "latest_per_number": latest(BULK),
    "latest_with_ties": latest(f"SELECT * FROM ({DAILY}) AS a UNION ALL SELECT * FROM ({DAILY_OLD}) AS b"),
    "first_last": seen(HOURLY),
    # Merging two parts of the history equals the range over all of it.
    "first_last_merge": seen(f"SELECT * FROM ({BULK_OLD}) AS a UNION ALL SELECT * FROM ({BULK_NEW}) AS b"),
    "union_all": f"SELECT * FROM ({BULK_OLD}) AS a UNION ALL SELECT * FROM ({BULK_NEW}) AS b",
    "result_report": BULK,
    "peek_limit": f"SELECT * FROM ({BULK}) AS r ORDER BY ad, bd, f02 LIMIT 10",
    "column_profile": profiled(ORDER_LOG, ORDERED_COLUMNS),
    "batch_replace": f"SELECT * FROM ({BULK}) AS a UNION ALL SELECT * FROM ({DAILY}) AS b",
    "batch_replace_empty": DAILY,
    "dynamic_partitions": BULK,
    "preclear_day": LOADED_BULK,
    "preclear_day_by_name": LOADED_BULK,
    "truncate_table": f'SELECT count(*) AS "before", 0::BIGINT AS "after" FROM ({BULK}) AS r',
    "swap_table": f"SELECT * FROM ({BULK_OLD}) AS a UNION ALL SELECT * FROM ({BULK_NEW}) AS b",
    "restart_day": LOADED,
    "restart_day_by_name": LOADED,
    "restart_day_by_name_dynamic": LOADED,
    "restart_day_seen": seen(LOADED),
    "stream_hours": f"SELECT * FROM ({STREAMED}) AS r WHERE ad < (SELECT max({NEXT_HOUR}) FROM ({EVENT_LOG}) AS l)",
    "run_metrics": f"""
        SELECT list, job, batchId, rows_in, rows_out FROM (VALUES ('short'), ('long')) AS k(list) CROSS JOIN (
        SELECT 'bulk' AS job, {EVENTS_SPLIT}::BIGINT AS batchId, {rows_between(EVENTS[0], EVENTS_SPLIT)} AS rows_in,
               count(*) AS rows_out FROM ({LOADED_BULK}) AS b
        UNION ALL
        SELECT 'hours', id, {rows_between(EVENTS_SPLIT, EVENTS[1])}, count(ad)
        FROM ({LAST_DAY_IDS}) AS i LEFT JOIN ({LOADED_DAY}) AS d ON ad = id GROUP BY id) AS m
        """,
    "batch_log": f"SELECT '{EVENTS_SPLIT}' AS \"batchId\" UNION ALL SELECT id::VARCHAR FROM ({LAST_DAY_IDS}) AS i",
    "watermark": f"SELECT max(ad) AS lastdate FROM ({HOURLY}) AS r",
    "gen_noise": NOISE,
    "gen_planted": PLANTED,
    "gen_older": f"SELECT * FROM ({OLDER_NOISE}) AS n UNION ALL SELECT * FROM ({OLDER_PLANTED}) AS p",
    "gen_to_size": SIZED,
    "load_job": """
        WITH plan AS (SELECT ceil(count(*) / 4000 / 1024 * 1024)::BIGINT AS rounds FROM lineitem)
        SELECT 'log' AS what, rounds * 4400 AS "rows" FROM plan
        UNION ALL SELECT 'list', 1000 FROM plan
        UNION ALL SELECT 'planted', rounds * 400 FROM plan
        UNION ALL SELECT 'planted and listed', 0 FROM plan""",
    "partition_roundtrip": GENERATED,
    "file_control": f"""
        SELECT kind, f31, count(*) AS "rows", true AS few_files
        FROM ({GENERATED}) AS g CROSS JOIN (VALUES ('merged'), ('spread')) AS k(kind) GROUP BY kind, f31""",
    "planted_recovery": batch(GENERATED, f"SELECT id FROM ({GENERATED_LIST}) AS y", (2023032300, 2023032306), HOUR, 2),
    "create_table_as": latest(BULK),
    "insert_partitions": f"SELECT * FROM ({BULK}) AS a UNION ALL SELECT * FROM ({DAILY}) AS b",
    "overwrite_batch": BULK,
    "swap_by_rename": f"SELECT * FROM ({BULK_OLD}) AS a UNION ALL SELECT * FROM ({BULK_NEW}) AS b",
    "truncate_by_name": f'SELECT count(*) AS "before", 0::BIGINT AS "after" FROM ({BULK}) AS r',
    "reset_tables": f"""
        SELECT count(*) AS "before", 0::BIGINT AS tables_left
        FROM (SELECT DISTINCT f02, f03 FROM ({ORDER_LOG}) AS l WHERE f02 < 10 OR f02 > 20) AS p""",
    "bucketed_table": f'SELECT f02, count(*) AS "rows" FROM ({GENERATED}) AS g GROUP BY f02',
    "table_statistics": f"""
        WITH log AS ({ORDER_LOG})
        SELECT '*' AS "column", 'rows' AS statistic, count(*)::VARCHAR AS value FROM log
        UNION ALL SELECT c, s, v FROM (
        SELECT unnest(['f02', 'f02', 'f02', 'f04', 'f04', 'f04', 'f31', 'f31', 'f31']) AS c,
               unnest(['min', 'max', 'num_nulls', 'min', 'max', 'num_nulls', 'min', 'max', 'num_nulls']) AS s,
               unnest([min(f02)::VARCHAR, max(f02)::VARCHAR, '0', min(f04)::VARCHAR, max(f04)::VARCHAR, '0',
                       min(f31)::VARCHAR, max(f31)::VARCHAR, '0']) AS v FROM log) AS x""",
    "column_histograms": """
        SELECT c AS "column", b::INTEGER AS bin, true AS near
        FROM (VALUES ('f02'), ('f04'), ('f31')) AS v(c) CROSS JOIN range(20) AS r(b)""",
    "table_roundtrip": BULK,
}

# The same jobs on tables by name give the same rows.
ORACLES["rerun_smaller_by_name"] = ORACLES["rerun_smaller"]
ORACLES["exclusion_list_merged"] = ORACLES["exclusion_list"]
ORACLES["bulk_from_hours"] = ORACLES["bulk_batch"]
ORACLES["hourly_from_hours"] = ORACLES["hourly_batches"]
ORACLES["anti_join_split"] = ORACLES["anti_join_bucketed"] = ORACLES["anti_join"]
ORACLES["anti_join_text_key_split"] = ORACLES["anti_join_text_key"]
ORACLES["latest_bucketed"] = ORACLES["latest_with_ties"]
ORACLES["stream_all_hours"] = STREAMED
ORACLES["sender_history_rows"] = f"SELECT f02, f04, f31 FROM ({ORDER_LOG}) AS l WHERE f02 IN (3, 8, 1000000000)"
