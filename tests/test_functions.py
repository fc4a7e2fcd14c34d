import calendar
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from peerwatch.functions import hours, rand, text
from peerwatch.sources.logs import literal_rows

TEXTS = StructType([StructField("t", StringType())])

CASES = [
    ("  a???b?000c  \t d100  ", "a?b?0c d10"),
    ("\tlead", " lead"),
    ("plain", "plain"),
    ("a\tb", "a b"),
    ("10 00 ??", "10 0 ?"),
    ("数据  数据？？", "数据 数据？？"),
    ("   ", ""),
    ("", ""),
    (None, None),
    ("line\nbreak  x", "line\nbreak x"),
    ("1112233", "1112233"),
    ("0?0?00??", "0?0?0?"),
]


def by_steps(value):
    """The contract, one run at a time."""
    if value is None:
        return None
    value = re.sub(r"\?+", "?", value.strip(" "))
    return re.sub("[ \t]+", " ", re.sub("0+", "0", value))


def test_clean_text_cases(spark):
    df = literal_rows(spark, [(t,) for t, _ in CASES], TEXTS)
    assert [r[0] for r in df.select(text.clean_text("t")).collect()] == [want for _, want in CASES]


def test_clean_text_equals_the_single_steps(spark):
    draw = random.Random(5)
    values = ["".join(draw.choices("?0 \ta1$\\", k=draw.randint(0, 14))) for _ in range(3000)]
    df = literal_rows(spark, [(v,) for v in values], TEXTS)
    stepwise = text.squeeze_blanks(text.squeeze_zeros(text.squeeze_question_marks(text.trimmed("t"))))
    got = df.select(text.clean_text("t"), stepwise).collect()
    assert [r[0] for r in got] == [by_steps(v) for v in values]
    assert [r[1] for r in got] == [by_steps(v) for v in values]


def test_is_filled(spark):
    df = literal_rows(spark, [(None,), ("",), (" ",), ("x",)], TEXTS)
    assert [r[0] for r in df.select(text.is_filled("t")).collect()] == [0, 0, 1, 1]


def _next_hour(x):
    """Brute force: walk real hours until one is greater."""
    moment = datetime(int(str(x)[:4]), 1, 1) - timedelta(hours=1)
    low, high = 0, 24 * 367 + 2
    while low < high:
        mid = (low + high) // 2
        if hours.format_hour(moment + timedelta(hours=mid)) > x:
            high = mid
        else:
            low = mid + 1
    return hours.format_hour(moment + timedelta(hours=low))


def test_next_hour_for_real_and_unreal_hours(spark):
    draw = random.Random(1)
    edges = [2023022823, 2024022823, 2024022923, 2023123123, 2023063023, 2023000000, 2023009999, 2023999999]
    edges += [2023030000, 2023033199, 2023033223, 2023043199, 2023130101, 2023010024, 2023123199, 2023123200]
    values = edges + [draw.randint(2019_00_00_00, 2025_99_99_99) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    got = [r[0] for r in df.select(hours.next_hour("x")).collect()]
    assert got == [_next_hour(v) for v in values]


def test_is_hour_and_buckets(spark):
    draw = random.Random(2)
    values = [2023022900, 2024022900, 2023139999, 0, -5, 12, 20230323011, 999010100, 1000010100, 9999123123]
    values += [draw.randint(1990_00_00_00, 2030_99_99_99) for _ in range(4000)]
    values += [hours.format_hour(datetime(1999, 1, 1) + timedelta(hours=draw.randint(0, 300000))) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    for form in (hours.BUCKET_HOUR, hours.BUCKET_DAY, hours.BUCKET_MONTH):
        key = hours.bucket_key("x", form)
        made = df.select("x", hours.bucket_key_text(key, form).alias("a"), hours.bucket_text("x", form).alias("b"))
        assert made.where(~F.col("a").eqNullSafe(F.col("b"))).collect() == []
    got = {r[0]: r[1] for r in df.select("x", hours.is_hour("x")).collect()}
    for value, flag in got.items():
        y, m, d, h = value // 10**6, value // 10**4 % 100, value // 100 % 100, value % 100
        real = 1000 <= y <= 9999 and 1 <= m <= 12 and h < 24 and 1 <= d <= calendar.monthrange(2000 + y % 400, m)[1]
        assert flag == real, value


def test_bucket_text_key_refuses_other_forms(spark):
    df = literal_rows(spark, [("2024-01",)], TEXTS)
    with pytest.raises(Exception, match="not a bucket"):
        df.select(hours.bucket_text_key("t")).collect()


def test_hour_lists():
    assert hours.hourly_batch_ids(2023123122, 2024010101) == [2023123123, 2024010100, 2024010101]
    assert hours.move_hour(2024022823, hours=1) == 2024022900
    assert hours.move_hour(2024030100, days=-1) == 2024022900


def test_shift_and_epoch(spark):
    df = spark.createDataFrame([(1679529599, 2024022823)], "s long, h long")
    got = df.select(hours.hour_of_epoch("s"), hours.shift_hours("h", 1), hours.shift_hours("h", -24)).first()
    assert tuple(got) == (2023032223, 2024022900, 2024022723)


def test_letters_are_letters(spark):
    made = spark.range(2000).select(rand.letters(3, F.col("id"), "t", 7).alias("t"))
    low, odd = made.select(F.min(F.length("t")), F.max((~F.col("t").rlike("^[a-zA-Z0-9]+$")).cast("int"))).first()
    assert low >= 210 and odd == 0
    assert made.distinct().count() == 2000
