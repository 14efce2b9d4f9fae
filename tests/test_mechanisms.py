"""Compaction and streams together, late rows, deltas, digests, rollups, baselines, offset gaps."""

from __future__ import annotations

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from salestream import sinks, sources, streaming
from salestream.jobs import compact_job, report_job, stream_job
from salestream.operators import baseline, digests, manifest, reconcile, reports, rollup, serving
from salestream.operators.aggregate import chained_windows, windowed_sales
from salestream.operators.parse import parse_events
from salestream.schema import ENVELOPE_SCHEMA, WINDOW_SCHEMA
from tests.conftest import SALES, at, message, plan_text, rows, rows_scanned, write_file

DRAIN = {"availableNow": True}


@pytest.fixture
def feed(spark, tmp_path):
    """Append sales (id, category, amount, clock) as a file, and read all files as a stream."""
    folder, n = tmp_path / "feed", [0]
    folder.mkdir()

    def append(*sales):
        n[0] += 1
        write_file(str(folder), n[0], [message(*s) for s in sales])

    def stream():
        return parse_events(sources.read_stream(spark, "text", {"maxFilesPerTrigger": "1"}, path=str(folder)))

    return append, stream, str(folder)


def test_a_folded_log_refuses_another_stream(spark, feed, tmp_path):
    append, stream, _ = feed
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    run = lambda ck: streaming.start_update_log(windowed_sales(stream()), log, str(tmp_path / ck), DRAIN).awaitTermination()
    append(("1", "a", 7.0, "10:00:00"))
    run("one")
    serving.compact(spark, log, table)
    serving.drop_folded(spark, log)
    assert not list((tmp_path / "log").glob("batch_id=*"))
    with pytest.raises(ValueError, match="is new"):
        run("two")
    append(("2", "b", 9.0, "10:00:10"))
    run("one")
    assert sorted(rows(serving.latest(serving.read_current(spark, log)), "category", "revenue")) == [("a", 7.0), ("b", 9.0)]


def test_a_stream_whose_log_was_emptied_fails(spark, windows_of, tmp_path):
    log = str(tmp_path / "log")
    manifest.own(spark, log, "one")
    sinks.write_batch(windows_of(("10:30:00", "a", 1.0, 1)), 0, log, stream="one")
    serving.truncate(spark, log)
    manifest.own(spark, log, "two")
    with pytest.raises(manifest.ForeignLog):
        sinks.write_batch(windows_of(("10:30:00", "a", 1.0, 1)), 1, log, stream="one")


def test_rejects_are_guarded(spark, feed, tmp_path):
    append, stream, _ = feed
    append((None, "a", 7.0, "10:00:00"))
    run = lambda ck: streaming.start_rejects(stream(), str(tmp_path / "bad"), str(tmp_path / ck), trigger=DRAIN).awaitTermination()
    run("one")
    append((None, "b", 7.0, "10:00:00"))
    with pytest.raises(ValueError, match="is new"):
        run("two")
    run("one")
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_reports_of_a_compacted_log_are_whole(spark, windows_of, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    sinks.write_batch(windows_of(("10:30:00", "a", 1.0, 1), ("10:30:00", "b", 2.0, 1)), 0, log)
    args = compact_job.parser().parse_args(["--log-path", log, "--table-path", table, "--drop"])
    assert compact_job.run(spark, args) == 0
    sinks.write_batch(windows_of(("10:30:00", "b", 5.0, 2)), 1, log)
    args = report_job.parser().parse_args(["--log-path", log])
    assert sorted(rows(report_job.current_windows(spark, args), "category", "revenue")) == [("a", 1.0), ("b", 5.0)]
    with pytest.raises(SystemExit, match="compacted"):
        report_job.current_windows(spark, report_job.parser().parse_args(["--log-path", log, "--every-emission"]))


def test_reports_make_sliding_windows_of_panes(spark, windows_of, tmp_path):
    log = str(tmp_path / "log")
    sinks.write_batch(windows_of(("10:30:00", "a", 1.0, 1), ("10:31:00", "a", 2.0, 1)), 0, log)
    args = report_job.parser().parse_args(["--log-path", log, "--width", "2 minutes", "--slide", "1 minute"])
    got = sorted(rows(report_job.current_windows(spark, args), "window_start", "revenue"))
    assert got == [(at("10:29:00"), 1.0), (at("10:30:00"), 3.0), (at("10:31:00"), 2.0)]


def test_chained_windows_copy_panes_and_not_events(spark, feed, tmp_path):
    append, stream, _ = feed
    append(("1", "a", 1.0, "10:00:30"), ("2", "a", 2.0, "10:01:30"), ("3", "b", 4.0, "10:01:40"))
    append(("4", "a", 8.0, "10:20:00"))
    query = streaming.start_final_windows(
        chained_windows(stream(), "2 minutes", "1 minute"), str(tmp_path / "out"), str(tmp_path / "ck"), DRAIN)
    query.awaitTermination()
    got = sorted(rows(serving.read_windows(spark, str(tmp_path / "out")), "window_start", "category", "revenue", "sales_count"))
    assert got == [
        (at("09:59:00"), "a", 1.0, 1), (at("10:00:00"), "a", 3.0, 2), (at("10:00:00"), "b", 4.0, 1),
        (at("10:01:00"), "a", 2.0, 1), (at("10:01:00"), "b", 4.0, 1)]
    plan = query._jsq.explainInternal(False) if hasattr(query._jsq, "explainInternal") else ""
    if "Expand" in plan:
        assert plan.rindex("Expand") < plan.index("StateStoreSave", plan.index("StateStoreSave") + 1)


def test_late_rows_and_served_rows_are_all_rows(spark, feed, tmp_path):
    append, stream, _ = feed
    log, late = str(tmp_path / "log"), str(tmp_path / "late")

    def run():
        streaming.start_update_log_with_late(stream(), log, late, str(tmp_path / "ck"), trigger=DRAIN).awaitTermination()

    append(("1", "a", 1.0, "10:00:30"))
    append(("2", "a", 2.0, "10:10:00"))
    append(("3", "a", 4.0, "10:00:40"))  # taken: the batch before still had the earlier watermark
    append(("6", "a", 32.0, "10:00:40"), ("4", "b", 8.0, "10:09:00"), (None, "c", None, "10:01:00"))
    run()
    assert rows(streaming.read_late(spark, str(tmp_path / "none"))) == []
    append(("5", "a", 16.0, "10:07:59"))
    run()
    found = sorted(rows(streaming.read_late(spark, late), "sale_id", "category", "amount", "window_start", "late_by_ms"), key=str)
    # the watermark is 10:08:00 after the batch of sale 2
    assert found == sorted([
        ("6", "a", 32.0, at("10:00:00"), 440_000), (None, "c", None, at("10:01:00"), 420_000),
        ("5", "a", 16.0, at("10:07:00"), 1_000)], key=str)
    served = sorted(rows(serving.latest(serving.read_current(spark, log)), "category", "revenue"))
    assert served == [("a", 2.0), ("a", 5.0), ("b", 8.0)]
    with pytest.raises(ValueError, match="is new"):
        streaming.start_update_log_with_late(stream(), log, late, str(tmp_path / "ck2"), trigger=DRAIN)


def test_deltas_sum_to_the_newest_figures(spark, windows_of, tmp_path):
    options = {"path": str(tmp_path / "docs")}
    assert sinks.append_deltas(windows_of(("10:30:00", "a", 1.0, 1)).limit(0), "parquet", options) == 0
    one = windows_of(("10:30:00", "a", 1.0, 1), ("10:31:00", None, None, 1))
    two = windows_of(("10:30:00", "a", 4.5, 3), ("10:32:00", "b", 2.0, 1))
    assert sinks.append_deltas(one, "parquet", options) == 2
    assert sinks.append_deltas(two, "parquet", options) == 2
    assert sinks.append_deltas(two, "parquet", options) == 0  # runs again
    sinks.append_documents(windows_of(("10:33:00", "c", 1.0, 1)), 9, "parquet", options)  # half of a batch
    assert sinks.append_deltas(windows_of(("10:33:00", "c", 1.0, 1), ("10:33:00", "d", 3.0, 1)), "parquet", options) == 1
    held = spark.read.parquet(options["path"]).groupBy("janela_inicio", "categoria").agg(
        F.sum("faturamento_total").alias("r"), F.sum("volume_vendas").alias("n"))
    assert sorted(rows(held, "categoria", "r", "n"), key=str) == sorted(
        [("a", 4.5, 3), (None, 0.0, 1), ("b", 2.0, 1), ("c", 1.0, 1), ("d", 3.0, 1)], key=str)


def test_a_stream_counts_what_passes(spark, feed, tmp_path):
    append, stream, _ = feed
    append(("1", "a", 1.0, "10:00:30"), (None, "a", 1.0, "10:00:30"), ("2", None, 1.0, "10:00:30"))
    append(("3", "a", None, "10:00:30"), ("4", "a", 1.0, "10:01:30"))
    with pytest.raises(RuntimeError, match="body"), streaming.record_progress(spark, "counted", str(tmp_path / "progress")):
        streaming.start_update_log(windowed_sales(streaming.observed(stream())), str(tmp_path / "log"), str(tmp_path / "ck"),
                                   DRAIN, "counted").awaitTermination()
        raise RuntimeError("body")  # what was reported is kept all the same
    log = streaming.progress_log(spark, str(tmp_path / "progress"))
    assert dict(rows(streaming.observed_totals(log))) == {
        "events": 5, "valid": 2, "rejected_sale_id": 1, "rejected_category": 1, "rejected_amount": 1,
        "rejected_event_time": 0, "null_ids": 1}
    assert len(list((tmp_path / "progress").glob("[0-9]*.json"))) == 1


def hours_of(spark, days, categories=("a", "b", None), seed=1):
    pick = random.Random(seed)
    made = []
    for day in range(days):
        for hour in (8, 9, 20):
            for category in categories:
                start = datetime.datetime(2024, 3, 1, hour) + datetime.timedelta(days=day)
                made.append((start, start + datetime.timedelta(hours=1), category, round(pick.uniform(1, 90), 2), pick.randrange(1, 9)))
    return spark.createDataFrame(made, WINDOW_SCHEMA)


def test_only_days_that_differ_are_read_again(spark, tmp_path):
    pick = random.Random(3)
    events = [(str(i), pick.choice("abc"), round(pick.uniform(1, 9), 2),
               datetime.datetime(2024, 3, 1) + datetime.timedelta(minutes=pick.randrange(10 * 1440))) for i in range(3000)]
    path = str(tmp_path / "events")
    spark.createDataFrame(events, SALES).withColumn("day", F.to_date("event_time")).repartition("day").write.partitionBy(
        "day").parquet(path)
    stored = spark.read.parquet(path)
    windowed_sales(stored, "1 hour").write.parquet(str(tmp_path / "windows"))
    windows = serving.read_windows(spark, str(tmp_path / "windows"))
    digests.write_digests(windows, str(tmp_path / "digests"))
    expected = digests.read_digests(spark, str(tmp_path / "digests"))
    assert rows(digests.pruned_diff(windows, stored, expected, "1 hour")) == []
    start, category = rows(windows.where("window_start >= '2024-03-04' AND category = 'a'").orderBy("window_start").limit(1),
                           "window_start", "category")[0]
    broken = windows.withColumn("revenue", F.col("revenue") + F.when(
        (F.col("window_start") == F.lit(start)) & (F.col("category") == category), 1.0).otherwise(0.0))
    days, found = digests.differing_windows(broken, expected)
    assert days == [str(start.date())] and found.count() == 1
    got = digests.pruned_diff(broken, stored, expected, "1 hour")
    want = reconcile.diff(broken, stored, "1 hour")
    assert sorted(rows(got)) == sorted(rows(want)) and got.count() == 1
    of_day = stored.where(F.col("day") == F.lit(start.date())).where(digests._within(F.col("event_time"), days, stored.schema["event_time"].dataType))
    assert rows_scanned(of_day) < 3000 / 5
    assert "GreaterThanOrEqual(event_time" in plan_text(got)


def test_digests_do_not_depend_on_order_and_replace_days(spark, tmp_path):
    windows = hours_of(spark, 3)
    one = sorted(rows(digests.digests(windows)), key=str)
    assert one == sorted(rows(digests.digests(windows.repartition(5))), key=str)
    assert {r[4] for r in one} == {"day", "hour", "window"} and len([r for r in one if r[4] == "day"]) == 3
    twice = windows.union(windows.limit(1))
    assert len(digests.differing_windows(twice, digests.digests(windows))[0]) == 1
    path = str(tmp_path / "d")
    digests.write_digests(windows, path)
    digests.write_digests(windows.where("window_start < '2024-03-02'"), path)
    assert sorted(rows(digests.read_digests(spark, path)), key=str) == one


def test_rollups_follow_corrections(spark, tmp_path):
    windows, path = hours_of(spark, 4), str(tmp_path / "rollup")
    rollup.write_rollup(windows, path)
    fixed = windows.where("to_date(window_start) <> '2024-03-03'").withColumn(
        "revenue", F.when(F.to_date("window_start") == "2024-03-02", F.col("revenue") * 2).otherwise(F.col("revenue")))
    rollup.refresh(fixed, path, ["2024-03-02", "2024-03-03"])
    states = rollup.read_rollup(spark, path)
    assert rows(rollup.revenue_by_category(states)) == rows(reports.revenue_by_category(fixed))
    for mine, theirs in ((rollup.general_stats, reports.general_stats), (rollup.category_totals, reports.category_totals),
                         (rollup.category_distribution, reports.category_distribution), (rollup.top_categories, reports.top_categories)):
        a, b = sorted(rows(mine(states)), key=str), sorted(rows(theirs(fixed)), key=str)
        assert len(a) == len(b)
        for x, y in zip(a, b, strict=True):
            assert x == pytest.approx(y)
    rollup.refresh(fixed.limit(0), path, [f"2024-03-0{n}" for n in range(1, 5)])
    assert rows(rollup.general_stats(rollup.read_rollup(spark, path))) == []


def test_baselines_of_parts_are_the_baseline_of_the_whole(spark):
    windows = hours_of(spark, 60)
    windows = windows.union(windows.withColumn("revenue", F.col("revenue") + 5))
    whole = baseline.states(windows)
    cut = F.pmod(F.hash("revenue"), F.lit(4))
    parts = [baseline.states(windows.where(cut == n)) for n in range(4)]
    merged = baseline.merge(parts[0].union(parts[1]).union(parts[2]).union(parts[3]))
    one, four = ({r[:3]: r[3:] for r in rows(x)} for x in (whole, merged))
    assert one.keys() == four.keys()
    assert all(one[k] == pytest.approx(four[k]) for k in one)
    found = {(r[0], r[1]): r[2] for r in rows(baseline.anomalies(windows, merged, 0.5), "window_start", "category", "deviation")}
    history: dict = {}
    for start, category, revenue in rows(windows, "window_start", "category", "revenue"):
        history.setdefault((start.weekday(), start.hour, category), []).append((start, revenue))
    checked = 0
    for (start, category), deviation in found.items():
        before = [r for s, r in history[start.weekday(), start.hour, category] if s.date() < start.date()]
        now = [r for s, r in history[start.weekday(), start.hour, category] if s == start]
        judged = [(r - statistics.mean(before)) / statistics.stdev(before) for r in now]
        assert any(deviation == pytest.approx(j) for j in judged)
        checked += 1
    assert checked > 20


def test_gaps_and_repeats_across_ranges(spark):
    offsets = [0, 1, 2, 5, 6, 7, 7, 8, 8, 8, 9, 9, 10, 10, 11, 31, 32]
    sent = [(None, b"", "t", 0, o, None, 0) for o in offsets] + [(None, b"", "t", 1, 4, None, 0), (None, b"", None, 1, 4, None, 0)]
    for size in (1, 3, 5, 10, 1000):
        got = sorted(rows(sources.offset_gaps(spark.createDataFrame(sent, ENVELOPE_SCHEMA), size)))
        assert got == [("t", 0, "gap", 3, 4, 2), ("t", 0, "gap", 12, 30, 19), ("t", 0, "repeat", 7, 10, 5)], size


def test_the_live_job_with_everything(spark, feed, tmp_path):
    append, _, folder = feed
    append(("1", "a", 1.0, "10:00:30"), (None, "a", 1.0, "10:00:30"))
    append(("2", "a", 2.0, "10:10:00"))
    append(("3", "a", 4.0, "10:00:40"))
    append(("4", "a", 8.0, "10:00:45"))
    path = lambda name: str(tmp_path / name)
    args = stream_job.arguments([
        "--source", "text", "--source-path", folder, "--source-option", "maxFilesPerTrigger=1", "--sink-path", path("log"),
        "--checkpoint", path("ck"), "--available-now", "--late-path", path("late"), "--progress-path", path("progress"),
        "--rejects-path", path("bad"), "--rejects-checkpoint", path("bad-ck"), "--width", "2 minutes", "--slide", "1 minute"])
    with streaming.record_progress(spark, args.name, args.progress_path):
        stream_job.run_until_ended(spark, [stream_job.start(spark, args), stream_job.start_rejects(spark, args)], 120)
    panes = serving.latest(serving.read_current(spark, path("log")))
    assert sorted(rows(panes, "window_start", "revenue")) == [(at("10:00:00"), 6.0), (at("10:10:00"), 2.0)]
    assert rows(streaming.read_late(spark, path("late")), "sale_id") == [("4",)]
    assert spark.read.parquet(path("bad")).count() == 1
    assert dict(rows(streaming.observed_totals(streaming.progress_log(spark, path("progress")))))["null_ids"] >= 1


def test_one_failing_query_ends_the_job(spark, feed, tmp_path):
    append, stream, _ = feed
    append(("1", "a", 1.0, "10:00:30"))

    def fail(batch, batch_id):
        raise RuntimeError("sink is gone")

    bad = stream().writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "bad")).start()
    good = streaming.start_update_log(windowed_sales(stream()), str(tmp_path / "log"), str(tmp_path / "good"))
    with pytest.raises(Exception, match="sink is gone"):
        stream_job.run_until_ended(spark, [good, bad], 120)
    assert not good.isActive and not bad.isActive
    again = streaming.start_update_log(windowed_sales(stream()), str(tmp_path / "log"), str(tmp_path / "good"))
    stream_job.run_until_ended(spark, [again], 3)
    assert not again.isActive
