from __future__ import annotations

import math
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salestream.functions import micros
from salestream.operators.aggregate import events_in_window, windowed_sales
from tests.conftest import SALES, at, plan_text, rows

EPOCH = datetime(1970, 1, 1)


def brute_force(sales, width_s: int, slide_s: int):
    """Windows by walking over every event and every window that covers it."""
    sums, counts = defaultdict(list), defaultdict(int)
    for sale_id, category, amount, time in sales:
        if time is None:
            continue
        second = (time - EPOCH) / timedelta(seconds=1)
        start = math.floor(second / slide_s) * slide_s
        while start > second - width_s:
            key = (EPOCH + timedelta(seconds=start), category)
            counts[key] += sale_id is not None
            sums[key].append(amount)
            start -= slide_s
    out = {}
    for key, amounts in sums.items():
        known = [a for a in amounts if a is not None]
        out[key] = (round(sum(known), 6) if known else None, counts[key])
    return out


def as_dict(df):
    return {
        (s, c): (None if r is None else round(r, 6), n)
        for s, c, r, n in rows(df, "window_start", "category", "revenue", "sales_count")
    }


SAMPLE = [
    ("1", "Casa", 10.0, at("10:30:00")),
    ("2", "Casa", 5.5, at("10:30:59")),
    ("3", "Casa", 1.0, at("10:31:00")),
    ("4", "Livros", 2.0, at("10:30:30")),
    (None, "Livros", 3.0, at("10:30:31")),
    ("6", None, 4.0, at("10:30:31")),
    ("7", "Gamer", None, at("10:40:00")),
    ("8", "Gamer", 9.0, None),
    ("9", "Casa", 2.5, datetime(1969, 12, 31, 23, 59, 30)),
]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(SAMPLE, SALES)


@pytest.mark.parametrize(
    "width, slide, seconds",
    [
        ("1 minute", None, (60, 60)),
        ("1 minute", "1 minute", (60, 60)),
        ("1 hour", "30 minutes", (3600, 1800)),
        ("10 minutes", "1 minute", (600, 60)),
        ("10 minutes", "4 minutes", (600, 240)),
        ("1 minute 30 seconds", "45 seconds", (90, 45)),
    ],
)
@pytest.mark.parametrize("zone", ["timestamp", "timestamp_ntz"])
def test_against_brute_force(sample, width, slide, seconds, zone):
    events = sample.withColumn("event_time", F.col("event_time").cast(zone))
    got = windowed_sales(events, width, slide)
    assert as_dict(got) == brute_force(SAMPLE, *seconds)
    assert got.schema["window_start"].dataType == got.schema["window_end"].dataType
    length = timedelta(seconds=seconds[0])
    assert all(e - s == length for s, e in rows(got, "window_start", "window_end"))


def test_without_panes(sample):
    got = windowed_sales(sample, "10 minutes", "1 minute", panes=False)
    assert as_dict(got) == brute_force(SAMPLE, 600, 60)


def test_bounds_are_start_inclusive_end_exclusive(sample):
    got = as_dict(windowed_sales(sample))
    assert got[at("10:30:00"), "Casa"] == (15.5, 2)
    assert got[at("10:31:00"), "Casa"] == (1.0, 1)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.text("ab", max_size=2)),
            st.sampled_from(["x", "y", None]),
            st.one_of(st.none(), st.integers(0, 10_000).map(lambda n: n / 100)),
            st.one_of(
                st.none(),
                st.integers(0, 7200).map(lambda s: at("09:00:00") + timedelta(seconds=s)),
            ),
        ),
        max_size=30,
    ),
    st.sampled_from([("20 minutes", "5 minutes", 1200, 300), ("7 minutes", "3 minutes", 420, 180)]),
)
def test_sliding_property(spark, sales, shape):
    width, slide, width_s, slide_s = shape
    df = spark.createDataFrame(sales, SALES)
    assert as_dict(windowed_sales(df, width, slide)) == brute_force(sales, width_s, slide_s)


def test_day_long_windows_ignore_the_clock_change(spark):
    """A window is 24 hours of elapsed time also where a local day has 25."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        time = datetime(2024, 11, 3, 12, tzinfo=timezone.utc)
        df = spark.createDataFrame([("1", "x", 1.0, time)], SALES)
        got = windowed_sales(df, "1 day").select(
            F.unix_micros("window_end") - F.unix_micros("window_start")
        )
        assert rows(got) == [(86_400_000_000,)]
        plain = df.select(F.window("event_time", "1 day")["end"])
        assert rows(windowed_sales(df, "1 day"), "window_end") == rows(plain)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_counting_another_column(sample, spark, tmp_path):
    with_ids = sample.filter("sale_id is not null")
    assert as_dict(windowed_sales(with_ids, counted="event_time")) == as_dict(
        windowed_sales(with_ids)
    )
    with_ids.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert "sale_id" not in plan_text(windowed_sales(stored, counted="event_time"))


def test_events_in_window_is_the_window(sample):
    one = events_in_window(sample, "Casa", F.lit(at("10:30:00")))
    assert sorted(rows(one, "sale_id")) == [("1",), ("2",)]


@pytest.mark.parametrize(
    "text, length",
    [
        ("1 minute", 60_000_000), ("interval 2 hours", 7_200_000_000), ("90 seconds ", 90_000_000),
        ("1 hour 30 minutes", 5_400_000_000), ("2 weeks", 1_209_600_000_000),
        ("250 milliseconds", 250_000), ("1 Day", 86_400_000_000),
    ],
)
def test_durations(text, length):
    assert micros(text) == length


@pytest.mark.parametrize(
    "bad", ["", "1 month", "soon", "minute", "1.5 hours", "1 hour and more", "-1 hour"]
)
def test_durations_that_are_none(bad):
    with pytest.raises(ValueError):
        micros(bad)


def test_a_hot_category_and_window(spark):
    """Half of all events in one group: it is combined before the shuffle."""
    sales = spark.range(0, 200_000, 1, 16).select(
        F.col("id").cast("string").alias("sale_id"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(
            F.concat(F.lit("c"), F.col("id") % 50)
        ).alias("category"),
        F.lit(1.0).alias("amount"),
        F.lit(at("10:30:00")).alias("event_time"),
    )
    got = windowed_sales(sales)
    assert as_dict(got)[at("10:30:00"), "hot"] == (100_000.0, 100_000)
    exchanged = got._jdf.queryExecution().executedPlan().toString()
    assert exchanged.count("Exchange hashpartitioning") == 1 and "partial_sum" in exchanged
