from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salestream.operators.aggregate import windowed_sales
from salestream.operators.reconcile import check_window, diff
from tests.conftest import SALES, at, plan_text, rows


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [
            ("1", "Casa", 10.0, at("10:30:00")),
            ("2", "Casa", 0.1, at("10:30:01")),
            ("3", "Casa", 0.2, at("10:30:02")),
            ("4", "Livros", 2.0, at("10:30:30")),
            ("5", None, 4.0, at("10:31:31")),
            ("6", "Gamer", None, at("10:32:00")),
            (None, "Gamer", 1.0, at("10:33:00")),
        ],
        SALES,
    )


def statuses(df):
    return sorted(rows(df, "category", "status"), key=str)


def test_own_output_agrees(events):
    assert rows(diff(windowed_sales(events), events)) == []
    assert rows(diff(windowed_sales(events, "2 minutes", "1 minute"), events, "2 minutes",
                     "1 minute")) == []


def test_order_of_summation_is_no_difference(events):
    served = windowed_sales(events).withColumn("revenue", F.col("revenue") + 1e-12)
    assert rows(diff(served, events)) == []


def test_served_with_zone_against_events_without(events):
    naive = events.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    assert rows(diff(windowed_sales(events), naive)) == []
    assert statuses(diff(windowed_sales(events).limit(0), naive))[0] == ("Casa", "missing")


def test_each_kind_of_fault(events):
    good = windowed_sales(events)
    casa, null = F.col("category") == "Casa", F.col("category").isNull()
    assert statuses(diff(good.filter(~casa | null), events)) == [("Casa", "missing")]
    assert statuses(diff(good.union(good.filter(casa)), events)) == [("Casa", "duplicate")]
    assert statuses(diff(good.union(good.filter(null)), events)) == [(None, "duplicate")]
    more = good.withColumn("sales_count", F.col("sales_count") + F.when(null, 1).otherwise(0))
    assert statuses(diff(more, events)) == [(None, "different")]
    richer = good.withColumn("revenue", F.when(casa, 11).otherwise(F.col("revenue")))
    (found,) = rows(diff(richer, events))
    assert found[:3] == (at("10:30:00"), "Casa", 11.0)
    assert found[3] == pytest.approx(10.3) and found[4:] == (3, 3, "different")
    ghost = good.withColumn("category", F.when(casa, "ghost").otherwise(F.col("category")))
    assert statuses(diff(ghost, events)) == [("Casa", "missing"), ("ghost", "unexpected")]


def test_null_revenue_against_a_number(events):
    served = windowed_sales(events).withColumn(
        "revenue", F.when(F.col("window_start") == at("10:32:00"), 0.0).otherwise(F.col("revenue"))
    )
    assert statuses(diff(served, events)) == [("Gamer", "different")]


def test_nothing_served(events):
    assert {s for _, s in statuses(diff(windowed_sales(events).limit(0), events))} == {"missing"}


def test_one_window(events):
    start = F.lit(at("10:30:00"))
    good = windowed_sales(events)
    assert rows(check_window(good, events, "Casa", start)) == []
    bad = good.withColumn("revenue", F.col("revenue") * 2)
    assert statuses(check_window(bad, events, "Casa", start)) == [("Casa", "different")]


def test_one_window_reads_its_time_range(events, spark, tmp_path):
    events.write.parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    served = windowed_sales(events).limit(0)
    plan = plan_text(check_window(served, stored, "Casa", F.lit(at("10:30:00"))))
    assert "GreaterThanOrEqual(event_time" in plan and "LessThan(event_time" in plan


def test_no_join(events):
    assert "Join" not in plan_text(diff(windowed_sales(events), events))


def test_the_order_of_adding_is_no_difference_at_half_a_cent(spark):
    amounts = (0.335, 0.1, 0.2, 0.37)
    events = spark.createDataFrame(
        [(str(i), "a", x, at("10:30:00")) for i, x in enumerate(amounts)], SALES)
    served = windowed_sales(events)
    for total in (1.005, 1.0050000000000001):
        assert rows(diff(served.withColumn("revenue", F.lit(total)), events)) == []
    assert statuses(diff(served.withColumn("revenue", F.lit(1.02)), events)) == [("a", "different")]


def test_the_end_of_a_window_counts(events):
    late = windowed_sales(events).withColumn(
        "window_end", F.col("window_end") + F.when(
            F.col("category") == "Livros", F.expr("INTERVAL 1 HOUR")).otherwise(
            F.expr("INTERVAL 0 HOUR")))
    assert statuses(diff(late, events)) == [("Livros", "different")]


def test_one_window_of_overlapping_ones(events):
    served = windowed_sales(events, "2 minutes", "1 minute")
    start = F.lit(at("10:29:00"))
    assert rows(check_window(served, events, "Casa", start, "2 minutes", "1 minute")) == []
    bad = served.withColumn("revenue", F.col("revenue") * 2)
    assert statuses(check_window(bad, events, "Casa", start, "2 minutes", "1 minute")) == [
        ("Casa", "different")]
    between = F.lit(at("10:29:30"))
    assert rows(check_window(served, events, "Casa", between, "2 minutes", "1 minute")) == []
