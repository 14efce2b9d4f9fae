from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from salestream import sinks
from salestream.operators import manifest, reports, serving
from salestream.schema import LOG_SCHEMA, WINDOW_SCHEMA
from tests.conftest import at, plan_text, rows


@pytest.fixture
def log(spark):
    """Three emissions of one window, one of another, and a NULL category."""
    def row(clock, category, revenue, count, batch):
        start = at(clock)
        return start, start.replace(second=59), category, revenue, count, batch

    return spark.createDataFrame(
        [
            row("10:30:00", "Casa", 10.0, 1, 0),
            row("10:30:00", "Casa", 130.0, 3, 10),
            row("10:30:00", "Casa", 30.0, 2, 9),
            row("10:30:00", "Livros", 5.0, 1, 0),
            row("10:31:00", None, 7.0, 1, 1),
            row("10:31:00", None, None, 2, 2),
        ],
        LOG_SCHEMA,
    )


def test_latest_is_the_newest_emission(log):
    got = sorted(rows(serving.latest(log), "window_start", "category", "revenue", "sales_count"),
                 key=str)
    assert got == [
        (at("10:30:00"), "Casa", 130.0, 3),
        (at("10:30:00"), "Livros", 5.0, 1),
        (at("10:31:00"), None, None, 2),
    ]


def test_latest_combines_before_its_one_shuffle(log):
    plan = plan_text(serving.latest(log)).split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in plan and "SortAggregate" not in plan


def test_looking_up_a_current_window_filters_the_log_at_the_scan(spark, log, tmp_path):
    log.write.parquet(str(tmp_path / "log"))
    stored = spark.read.schema(LOG_SCHEMA).parquet(str(tmp_path / "log"))
    found = reports.find_window(serving.latest(stored), "Casa", at("10:30:00"))
    assert rows(found, "revenue") == [(130.0,)]
    plan = plan_text(found)
    assert "EqualTo(window_start,2024-11-25 10:30:00.0)" in plan
    assert "EqualTo(category,Casa)" in plan


def test_summing_the_raw_log_counts_emissions(log):
    assert rows(reports.category_totals(log).filter("category = 'Casa'")) == [("Casa", 170.0)]
    current = serving.latest(log)
    assert rows(reports.category_totals(current).filter("category = 'Casa'")) == [("Casa", 130.0)]


def test_a_window_emitted_in_very_many_batches(spark):
    log = spark.range(0, 100_000, 1, 8).select(
        F.lit(at("10:30:00")).alias("window_start"),
        F.lit(at("10:31:00")).alias("window_end"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("category"),
        F.col("id").cast("double").alias("revenue"),
        F.col("id").alias("sales_count"),
        F.col("id").alias("batch_id"),
    )
    current = serving.latest(log)
    assert current.count() == 66_667
    assert rows(current.filter("category = 'hot'"), "sales_count") == [(99_999,)]


def test_replay_leaves_the_log_unchanged(spark, log, tmp_path):
    path = str(tmp_path / "log")
    for batch_id in (0, 9, 10, 10, 9, 0):
        batch = log.filter(F.col("batch_id") == batch_id).drop("batch_id")
        sinks.write_batch(batch, batch_id, path)
    stored = serving.read_log(spark, path)
    assert stored.schema == LOG_SCHEMA
    want = rows(log.filter("category is not null"))
    assert sorted(rows(stored)) == sorted(want)


def test_replay_replaces_rows_of_its_batch_only(spark, windows_of, tmp_path):
    path = str(tmp_path / "log")
    sinks.write_batch(windows_of(("10:30:00", "a", 1.0, 1), ("10:30:00", "b", 1.0, 1)), 0, path)
    sinks.write_batch(windows_of(("10:30:00", "a", 2.0, 2)), 1, path)
    sinks.write_batch(windows_of(("10:30:00", "a", 3.0, 3)), 1, path)
    got = sorted(rows(serving.read_log(spark, path), "batch_id", "category", "revenue"))
    assert got == [(0, "a", 1.0), (0, "b", 1.0), (1, "a", 3.0)]


def test_empty_batch_writes_nothing(windows_of, tmp_path):
    empty = windows_of(("10:30:00", "a", 1.0, 1)).limit(0)
    assert sinks.write_batch(empty, 0, str(tmp_path / "log")) == 0
    assert glob.glob(str(tmp_path / "log*")) == []
    assert sinks.append_documents(empty, 0, "json", {"path": str(tmp_path / "docs")}) == 0
    assert glob.glob(str(tmp_path / "docs*")) == []


def test_files_follow_the_number_of_rows(spark, windows_of, tmp_path):
    batch = windows_of(*[("10:30:00", f"c{i}", 1.0, 1) for i in range(100)]).repartition(16)
    for rows_per_file, n_files in ((1000, 1), (30, 4)):
        path = str(tmp_path / f"log{n_files}")
        assert sinks.write_batch(batch, 0, path, rows_per_file=rows_per_file) == 100
        assert len(glob.glob(f"{path}/batch_id=0/*.parquet")) == n_files
        assert serving.read_log(spark, path).count() == 100


def test_batches_leave_nothing_cached(spark, windows_of, tmp_path):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    sinks.write_batch(windows_of(("10:30:00", "a", 1.0, 1)), 0, str(tmp_path / "log"))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_documents_are_appended_again_on_replay(spark, windows_of, tmp_path):
    options = {"path": str(tmp_path / "docs")}
    for _ in range(2):
        sinks.append_documents(windows_of(("10:30:00", "a", 1.0, 1)), 0, "json", options)
    docs = spark.read.json(options["path"])
    assert docs.count() == 2 and "faturamento_total" in docs.columns


def test_truncate(spark, windows_of, tmp_path):
    path = str(tmp_path / "log")
    for batch_id in range(3):
        sinks.write_batch(windows_of(("10:30:00", "a", 1.0, 1)), batch_id, path)
    serving.truncate(spark, path)
    assert rows(serving.read_log(spark, path)) == []
    sinks.write_batch(windows_of(("10:30:00", "b", 2.0, 1)), 0, path)
    assert rows(serving.read_log(spark, path), "category") == [("b",)]


def test_nothing_written_yet(spark, tmp_path):
    missing = str(tmp_path / "missing")
    log = serving.read_log(spark, missing, missing_ok=True)
    assert rows(serving.latest(log)) == []
    windows = serving.read_windows(spark, missing, missing_ok=True)
    assert rows(reports.general_stats(windows)) == []


def test_a_wrong_path_is_an_error(spark, tmp_path):
    for read in (serving.read_log, serving.read_windows):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read(spark, str(tmp_path / "mising"))


def test_compaction_changes_nothing_that_is_read(spark, windows_of, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    assert serving.compact(spark, log, table) is None

    def batch(n, *given):
        sinks.write_batch(windows_of(*given), n, log)

    def current():
        return sorted(rows(serving.latest(serving.read_current(spark, log, table)),
                           "category", "revenue"))

    batch(0, ("10:30:00", "a", 1.0, 1), ("10:30:00", "b", 1.0, 1))
    batch(1, ("10:30:00", "a", 2.0, 2))
    before = current()
    assert before == [("a", 2.0), ("b", 1.0)]
    assert serving.compact(spark, log, table) == 1 and current() == before
    batch(2, ("10:30:00", "b", 5.0, 2))
    assert current() == [("a", 2.0), ("b", 5.0)]
    assert serving.compact(spark, log, table) == 2
    serving.drop_folded(spark, log, table)
    assert current() == [("a", 2.0), ("b", 5.0)]
    assert serving.compact(spark, log, table) == 2
    assert [p.name for p in (tmp_path / "log").glob("batch_id=*")] == []
    assert len(list((tmp_path / "table").glob("generation-*"))) == 1
    (tmp_path / "table" / "generation-000000000009-00000000" / "day=2024-11-25").mkdir(parents=True)  # interrupted
    assert current() == [("a", 2.0), ("b", 5.0)]
    serving.drop_folded(spark, log)
    assert len(list((tmp_path / "table").glob("generation-*"))) == 1
    batch(1, ("10:30:00", "a", 99.0, 9))  # a batch that is folded already, written again
    assert current() == [("a", 2.0), ("b", 5.0)]


def day_batch(spark, day, category, revenue):
    start = at("10:30:00", day)
    return spark.createDataFrame([(start, start.replace(second=59), category, revenue, 1)], WINDOW_SCHEMA)


def test_compaction_rewrites_only_days_that_were_touched(spark, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    for n, day in enumerate(("2024-11-25", "2024-11-26", "2024-11-27")):
        sinks.write_batch(day_batch(spark, day, "a", float(n)), n, log)
    serving.compact(spark, log, table)
    files_of = lambda: {p.relative_to(table).as_posix() for p in (tmp_path / "table").rglob("*.parquet")}
    first = files_of()
    sinks.write_batch(day_batch(spark, "2024-11-26", "a", 10.0), 3, log)
    sinks.write_batch(day_batch(spark, "2024-11-28", "b", 20.0), 4, log)
    serving.compact(spark, log, table)
    serving.drop_folded(spark, log, table)
    kept = {f for f in first if "2024-11-26" not in f}
    assert files_of() & first == kept and len(kept) == 2 and len(files_of()) == 4
    got = sorted(rows(serving.read_current(spark, log), "category", "revenue"))
    assert got == [("a", 0.0), ("a", 2.0), ("a", 10.0), ("b", 20.0)]


def test_a_reader_during_a_compaction_sees_one_state(spark, windows_of, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    sinks.write_batch(windows_of(("10:30:00", "a", 1.0, 1)), 0, log)
    serving.compact(spark, log, table)
    sinks.write_batch(windows_of(("10:30:00", "a", 2.0, 2)), 1, log)
    reader = serving.read_current(spark, log, table)  # planned before, read after
    serving.compact(spark, log, table)
    sinks.write_batch(windows_of(("10:30:00", "a", 3.0, 3)), 2, log)
    assert rows(reader, "revenue") == [(2.0,)]
    assert rows(serving.read_current(spark, log, table), "revenue") == [(3.0,)]
    with pytest.raises(ValueError, match="is compacted to"):
        serving.read_current(spark, log, table + "-other")


def test_of_two_compactions_the_second_fails(spark, windows_of, tmp_path, monkeypatch):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    sinks.write_batch(windows_of(("10:30:00", "a", 1.0, 1)), 0, log)
    real, busy = manifest.change, []

    def change(*given, **more):
        if not busy:
            busy.append(1)
            serving.compact(spark, log, table)
        return real(*given, **more)

    monkeypatch.setattr(manifest, "change", change)
    with pytest.raises(RuntimeError, match="another run"):
        serving.compact(spark, log, table)
    assert rows(serving.read_current(spark, log, table), "revenue") == [(1.0,)]


def test_manifest_versions(spark, tmp_path):
    log = str(tmp_path / "log")
    manifest.own(spark, log, "one")
    for batch in (0, 1, 2, 5, 4, 1):
        manifest.add_batch(spark, log, batch, "one")
    found = manifest.read(spark, log)
    assert found.batches == ((0, 2), (4, 5)) and found.stream == "one" and found.version == 5
    with pytest.raises(manifest.ForeignLog):
        manifest.own(spark, log, "two")
    with pytest.raises(manifest.ForeignLog):
        manifest.add_batch(spark, log, 6, "two")
    lost = []

    def step(before):
        if not lost:  # another writer is faster once
            lost.append(1)
            manifest.add_batch(spark, log, 7, "one")
        return before.with_batch(8)

    assert manifest.change(spark, log, step).batches == ((0, 2), (4, 5), (7, 8))
    for batch in range(9, 30):
        manifest.add_batch(spark, log, batch, "one")
    assert len(list((tmp_path / "log" / "_manifest").glob("[0-9]*.json"))) == manifest.KEPT_VERSIONS
    assert manifest.read(spark, log).batches == ((0, 2), (4, 5), (7, 29))


def test_truncating_a_compacted_log(spark, windows_of, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    sinks.write_batch(windows_of(("10:30:00", "a", 1.0, 1)), 5, log)
    serving.compact(spark, log, table)
    serving.truncate(spark, log)
    assert rows(serving.read_current(spark, log)) == []
    sinks.write_batch(windows_of(("10:30:00", "b", 2.0, 1)), 0, log)
    assert rows(serving.read_current(spark, log), "category", "batch_id") == [("b", 0)]
    serving.compact(spark, log, table)
    serving.drop_folded(spark, log, table)
    assert rows(serving.read_current(spark, log), "category", "batch_id") == [("b", 0)]


def test_another_read_error_is_not_hidden(spark, tmp_path):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        serving.read_log(spark, str(tmp_path), "nosuchformat")


def test_truncate_has_no_default_target(spark):
    with pytest.raises(ValueError):
        serving.truncate(spark, "")
