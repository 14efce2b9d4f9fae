from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salestream import streaming
from salestream.operators import reports, serving
from salestream.operators.aggregate import windowed_sales
from salestream.operators.parse import parse_events
from salestream.sources import read_batch, read_stream
from salestream.schema import in_session_time
from salestream.streaming import STATE_STORE_CONF, progress_log, progress_table, record_progress
from tests.conftest import at, message, rows, write_file

DRAIN = {"availableNow": True}
TWO_USES = "spark.sql.streaming.statefulOperator.allowMultiple"

GOLDEN = [
    [(1, "Casa", 10, "10:30:05"), (2, "Livros", 5, "10:30:50")],
    [(3, "Casa", 20, "10:30:59"), (4, "Gamer", 7, "10:34:00")],
    [(5, "Casa", 100, "10:30:30"), (6, "Gamer", 1, "10:32:10")],
    [(7, "Casa", 2, "10:31:59"), (8, "Livros", 9, "10:40:00")],
    [(9, "Livros", 1, "10:40:01"), (10, "Gamer", 50, "10:36:30")],
    [(11, "Gamer", 3, "10:37:59"), (12, "Casa", 4, "10:38:00")],
]

UPDATES = [
    (0, "10:30:00", "Casa", 10.0, 1), (0, "10:30:00", "Livros", 5.0, 1),
    (1, "10:30:00", "Casa", 30.0, 2), (1, "10:34:00", "Gamer", 7.0, 1),
    (2, "10:30:00", "Casa", 130.0, 3), (2, "10:32:00", "Gamer", 1.0, 1),
    (3, "10:40:00", "Livros", 9.0, 1),
    (4, "10:36:00", "Gamer", 50.0, 1), (4, "10:40:00", "Livros", 10.0, 2),
    (5, "10:38:00", "Casa", 4.0, 1),
]


class Stream:
    """A folder of message files, one micro-batch each, and its outputs."""

    def __init__(self, spark, folder):
        self.spark, self.n = spark, 0
        self.input = folder / "in"
        self.input.mkdir()
        self.log, self.checkpoint = str(folder / "log"), str(folder / "checkpoint")
        self.final = str(folder / "final")

    def feed(self, *files):
        for file in files:
            write_file(self.input, self.n, [message(str(i), *rest) for i, *rest in file])
            self.n += 1

    def events(self):
        return parse_events(
            read_stream(
                self.spark, "text", {"maxFilesPerTrigger": "1"}, "value string", str(self.input)
            )
        )

    def batch_events(self):
        return parse_events(read_batch(self.spark, "text", path=str(self.input)))

    def run_updates(self, **kwargs):
        query = streaming.start_update_log(
            windowed_sales(self.events(), **kwargs), self.log, self.checkpoint, DRAIN
        )
        query.awaitTermination()
        return query

    def emitted(self):
        log = serving.read_log(self.spark, self.log)
        return sorted(rows(log, "batch_id", "window_start", "category", "revenue", "sales_count"))

    def current(self):
        return serving.latest(serving.read_log(self.spark, self.log))


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


def clocked(expected):
    return sorted((b, at(clock), *rest) for b, clock, *rest in expected)


def test_golden_updates(stream):
    stream.feed(*GOLDEN)
    stream.run_updates()
    assert stream.emitted() == clocked(UPDATES)


def test_golden_current_table_and_naive_sum(stream):
    stream.feed(*GOLDEN)
    stream.run_updates()
    assert stream.current().count() == 7
    assert rows(reports.general_stats(stream.current()), "revenue") == [(207.0,)]
    raw = serving.read_log(stream.spark, stream.log)
    assert rows(reports.general_stats(raw), "revenue", "n_rows") == [(256.0, 10)]


def run_final(stream):
    windows = windowed_sales(stream.events())
    streaming.start_final_windows(
        windows, stream.final, stream.checkpoint, DRAIN
    ).awaitTermination()
    final = stream.spark.read.schema(windows.schema).parquet(stream.final)
    return sorted(rows(final, "window_start", "category", "revenue", "sales_count"))


def test_golden_final_windows(stream):
    stream.feed(*GOLDEN)
    assert run_final(stream) == [
        (at("10:30:00"), "Casa", 130.0, 3), (at("10:30:00"), "Livros", 5.0, 1),
        (at("10:32:00"), "Gamer", 1.0, 1), (at("10:34:00"), "Gamer", 7.0, 1),
        (at("10:36:00"), "Gamer", 50.0, 1),
    ]


def test_golden_with_one_watermark_for_both_uses(stream):
    stream.spark.conf.set(TWO_USES, "false")
    try:
        stream.feed(*GOLDEN)
        stream.run_updates()
    finally:
        stream.spark.conf.unset(TWO_USES)
    kept = [r for r in UPDATES if r[:3] not in (
        (2, "10:30:00", "Casa"), (4, "10:36:00", "Gamer"))]
    assert stream.emitted() == clocked(kept)


def test_restart_goes_on_where_it_stopped(stream):
    stream.feed(*GOLDEN[:3])
    stream.run_updates()
    stream.feed(*GOLDEN[3:])
    stream.run_updates()
    got = {r[1:] for r in stream.emitted()}
    assert got == {r[1:] for r in clocked(UPDATES)}
    assert rows(reports.general_stats(stream.current()), "revenue") == [(207.0,)]


def test_restart_after_a_batch_failed_between_write_and_commit(stream, monkeypatch):
    from salestream.streaming import queries

    real = queries.write_batch

    def write_then_fail(batch, batch_id, *rest):
        real(batch, batch_id, *rest)
        if batch_id == 2:
            raise RuntimeError("lost after the write")

    stream.feed(*GOLDEN)
    monkeypatch.setattr(queries, "write_batch", write_then_fail)
    with pytest.raises(Exception, match="lost after the write"):
        stream.run_updates()
    monkeypatch.setattr(queries, "write_batch", real)
    stream.run_updates()
    assert stream.emitted() == clocked(UPDATES)


def test_sliding_stream(stream):
    stream.feed([(1, "a", 1, "10:00:10"), (2, "a", 2, "10:00:40")], [(3, "a", 4, "10:01:10")])
    stream.run_updates(width="1 minute", slide="30 seconds")
    want = windowed_sales(stream.batch_events(), "1 minute", "30 seconds")
    assert sorted(rows(stream.current())) == sorted(rows(want))


def test_state_in_rocksdb(stream):
    saved = {k: stream.spark.conf.get(k, None) for k in STATE_STORE_CONF}
    for key, value in STATE_STORE_CONF.items():
        stream.spark.conf.set(key, value)
    try:
        stream.feed(*GOLDEN)
        stream.run_updates()
    finally:
        for key, value in saved.items():
            stream.spark.conf.unset(key) if value is None else stream.spark.conf.set(key, value)
    assert stream.emitted() == clocked(UPDATES)


def test_document_append_sums_every_emission(stream, tmp_path):
    stream.feed(*GOLDEN)
    docs = str(tmp_path / "docs")
    streaming.start_document_append(
        windowed_sales(stream.events()), "json", {"path": docs}, stream.checkpoint, DRAIN
    ).awaitTermination()
    stored = stream.spark.read.json(docs)
    assert stored.count() == 10
    assert rows(stored.agg(F.sum("faturamento_total"))) == [(256.0,)]


def test_bad_messages_do_not_stop_the_stream(stream):
    write_file(stream.input, 0, ["not json", "", message("1", "a", 1, "10:00:00")])
    write_file(stream.input, 1, ['{"timestamp":"never"}', message("2", "a", 2, "10:00:01")])
    stream.run_updates()
    assert rows(stream.current(), "revenue", "sales_count") == [(3.0, 2)]


def test_rejects_go_to_their_own_table(stream, tmp_path):
    write_file(stream.input, 0, ["not json", message("1", "a", 1, "10:00:00")])
    write_file(stream.input, 1, ['{"id_pedido":"2"}', message("3", None, 2, "10:00:01")])
    messages = read_stream(stream.spark, "text", None, "value string", str(stream.input))
    out = str(tmp_path / "rejects")
    streaming.start_rejects(
        parse_events(messages, keep_raw=True), out, stream.checkpoint, trigger=DRAIN
    ).awaitTermination()
    got = rows(stream.spark.read.parquet(out), "reject_reason", "raw")
    assert set(got) == {
        ("category", '{"id_pedido":"2"}'), ("category", message("3", None, 2, "10:00:01")),
        ("sale_id", "not json"),
    }
    assert len(got) == 3


def test_progress(stream):
    stream.feed(*GOLDEN)
    query = stream.run_updates()
    got = progress_table(stream.spark, query)
    assert rows(got.agg(F.sum("input_rows"))) == [(12,)]
    # counted once although each batch is counted, written and possibly empty
    assert rows(got.agg(F.sum("state_rows_updated"), F.sum("late_rows_dropped"))) == [(10, 2)]
    by_batch = {r["batch_id"]: r for r in got.collect() if r["input_rows"]}
    assert by_batch[2]["watermark"] == at("10:32:00")
    assert by_batch[3]["max_event_time"] == at("10:40:00")
    assert by_batch[3]["watermark_delay_ms"] == 480_000
    assert by_batch[3]["max_offsets_behind"] is None and by_batch[3]["duration_ms"] > 0


def test_progress_of_a_query_without_batches(stream):
    stream.feed([])
    query = stream.run_updates()
    assert "watermark_delay_ms" in progress_table(stream.spark, query).columns


@settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.integers(0, 600), st.sampled_from("abc"), st.integers(1, 999)),
        min_size=1, max_size=25,
    ),
    st.integers(1, 4),
)
def test_stream_equals_batch_for_ordered_input(spark, tmp_path_factory, sales, n_files):
    stream = Stream(spark, tmp_path_factory.mktemp("ordered"))
    ordered = [
        (i, c, v / 100, f"10:{s // 60:02}:{s % 60:02}") for i, (s, c, v) in enumerate(sorted(sales))
    ]
    size = -(-len(ordered) // n_files)
    stream.feed(*[ordered[i:i + size] for i in range(0, len(ordered), size)])
    stream.run_updates()
    cents = F.bround("revenue", 2)
    columns = ("window_start", "window_end", "category", cents, "sales_count")
    want = windowed_sales(stream.batch_events())
    assert sorted(rows(stream.current(), *columns)) == sorted(rows(want, *columns))


def test_a_new_checkpoint_on_an_old_output_is_refused(stream, tmp_path):
    stream.feed(*GOLDEN[:2])
    windows = lambda: windowed_sales(stream.events())
    for start, output in (
        (streaming.start_update_log, stream.log), (streaming.start_final_windows, stream.final),
    ):
        first = str(tmp_path / f"{start.__name__}-first")
        start(windows(), output, first, DRAIN).awaitTermination()
        before = sorted(rows(stream.spark.read.parquet(output)), key=str)
        with pytest.raises(ValueError, match="is new"):
            start(windows(), output, str(tmp_path / f"{start.__name__}-other"), DRAIN)
        assert sorted(rows(stream.spark.read.parquet(output)), key=str) == before
        with pytest.raises(ValueError, match="is not its output"):
            start(windows(), str(tmp_path / f"{start.__name__}-else"), first, DRAIN)
        start(windows(), output, first, DRAIN).awaitTermination()  # a restart is fine


def test_truncated_logs_need_a_new_checkpoint(stream, tmp_path):
    stream.feed(*GOLDEN[:1])
    run = lambda ck: streaming.start_update_log(
        windowed_sales(stream.events()), stream.log, str(tmp_path / ck), DRAIN).awaitTermination()
    run("one")
    serving.truncate(stream.spark, stream.log)
    with pytest.raises(ValueError, match="is not its output"):
        run("one")
    run("two")
    assert serving.read_log(stream.spark, stream.log).count() == 2


def test_every_batch_is_recorded(stream, tmp_path):
    spark, key = stream.spark, "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")
    try:
        stream.feed(*GOLDEN)
        with record_progress(spark, "recorded", str(tmp_path / "progress")):
            query = streaming.start_update_log(
                windowed_sales(stream.events()), stream.log, stream.checkpoint, DRAIN, "recorded")
            query.awaitTermination()
        (total,) = rows(progress_log(spark, str(tmp_path / "progress")).agg(F.sum("input_rows")))
        (recent,) = rows(progress_table(spark, query).agg(F.sum("input_rows")))
    finally:
        spark.conf.unset(key)
    assert total == (sum(map(len, GOLDEN)),) and recent < total


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Kolkata"])
def test_stream_and_table_have_the_same_windows_in_any_zone(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        clocks = ["2024-03-01 00:10:00", "2024-03-01 21:30:00", "2024-03-02 02:00:00"]
        sales = spark.createDataFrame([(c,) for c in clocks], "t string").selectExpr(
            "t AS sale_id", "'a' AS category", "1.0D AS amount", "CAST(t AS timestamp_ntz) AS event_time")
        sales.write.parquet(str(tmp_path / "in"))
        table = in_session_time(windowed_sales(sales, "1 day"))
        source = read_stream(spark, "parquet", schema=sales.schema, path=str(tmp_path / "in"))
        streaming.start_update_log(
            windowed_sales(source, "1 day", watermark="30 days"), str(tmp_path / "log"), str(tmp_path / "ck"),
            DRAIN).awaitTermination()
        served = serving.latest(serving.read_log(spark, str(tmp_path / "log")))
        assert sorted(rows(served)) == sorted(rows(table))
        assert sorted(rows(served.selectExpr("CAST(window_start AS string)", "sales_count"))) == [
            ("2024-03-01 00:00:00", 2), ("2024-03-02 00:00:00", 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
