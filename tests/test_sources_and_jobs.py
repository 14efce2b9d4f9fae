from __future__ import annotations

import pytest

from salestream import sinks, sources
from salestream.jobs import batch_job, report_job, stream_job
from salestream.jobs.common import TABLE_CONF
from salestream.operators.reports import find_window
from salestream.schema import ENVELOPE_SCHEMA, WINDOW_SCHEMA
from salestream.workspace import new_path, shared_folder
from tests.conftest import SALES, at, message, rows, rows_scanned, write_file


class Recorder:
    """Stands in for a reader or writer whose connector is not installed."""

    def __init__(self):
        self.seen = {}

    def __getattr__(self, name):
        def record(*args, **kwargs):
            self.seen.setdefault(name, []).append(kwargs or args)
            return self

        return record


class FakeSession:
    def __init__(self):
        self.readStream, self.read = Recorder(), Recorder()


def test_kafka_stream_starts_at_the_end():
    fake = FakeSession()
    sources.read_stream(fake, "kafka", {"subscribe": "t", "kafka.bootstrap.servers": "h:1"})
    assert fake.readStream.seen["format"] == [("kafka",)]
    assert fake.readStream.seen["options"] == [{
        "startingOffsets": "latest",
        "subscribe": "t", "kafka.bootstrap.servers": "h:1",
    }]


def test_caller_options_win():
    fake = FakeSession()
    sources.read_stream(fake, "kafka", {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "5"})
    (options,) = fake.readStream.seen["options"]
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "5"


def test_kafka_replay_is_bounded():
    fake = FakeSession()
    sources.read_batch(fake, "kafka", {"subscribe": "t"})
    (options,) = fake.read.seen["options"]
    assert options == {
        "startingOffsets": "earliest", "endingOffsets": "latest", "subscribe": "t",
    }


def test_publish_settings():
    class FakeFrame:
        isStreaming = False
        write = Recorder()

    sinks.publish(FakeFrame, "kafka", {"topic": "t"})
    (options,) = FakeFrame.write.seen["options"]
    assert options["kafka.acks"] == "all" and options["kafka.compression.type"] == "gzip"
    assert options["kafka.retries"] == "3" and options["topic"] == "t"


def test_publish_table_and_stream_through_files(spark, tmp_path):
    sales = spark.createDataFrame([("1", "a", 1.5, at("10:00:00"))], SALES)
    messages = sinks.to_envelope(sales)
    assert sinks.publish(messages, "parquet", {"path": str(tmp_path / "topic")}) is None
    stream = sources.read_stream(
        spark, "parquet", schema="value binary", path=str(tmp_path / "topic")
    )
    with pytest.raises(ValueError):
        sinks.publish(stream, "parquet", {"path": str(tmp_path / "copy")})
    query = sinks.publish(
        stream, "parquet", {"path": str(tmp_path / "copy")}, str(tmp_path / "ck"),
        {"availableNow": True},
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "copy"))) == rows(messages)


@pytest.fixture
def topic(spark):
    def row(partition, offset):
        return None, b"x", "t", partition, offset, at("10:00:00"), 0

    return spark.createDataFrame(
        [row(0, o) for o in (5, 6, 9)] + [row(1, 0)], ENVELOPE_SCHEMA
    )


def test_partition_profile(topic):
    assert sorted(rows(sources.partition_profile(topic))) == [
        ("t", 0, 5, 9, 3, 2), ("t", 1, 0, 0, 1, 0),
    ]


def test_peek(topic):
    assert sources.peek(topic, 2).count() == 2 and sources.peek(topic).count() == 4
    first = sources.peek(topic.repartition(3), 2, ("partition", "offset"))
    assert rows(first, "partition", "offset") == [(0, 5), (0, 6)]


# Workspace


def test_shared_folder_is_read_from_the_session(spark):
    assert new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)


# Jobs


STREAM = ["--source", "text", "--checkpoint", "/c", "--sink-path", "/s"]


def test_stream_arguments():
    args = stream_job.arguments([
        *STREAM, "--source-option", "maxFilesPerTrigger=1", "--source-option", "a=b=c",
        "--trigger-interval", "30 seconds",
    ])
    assert dict(args.source_option) == {"maxFilesPerTrigger": "1", "a": "b=c"}
    assert (args.width, args.slide, args.watermark) == ("1 minute", None, "2 minutes")
    assert args.sink == "log" and args.timeout is None


@pytest.mark.parametrize(
    "argv",
    [
        ["--source", "text", "--sink-path", "/s"],
        ["--source", "text", "--checkpoint", "/c"],
        [*STREAM, "--available-now", "--trigger-interval", "1 second"],
        [*STREAM, "--source-option", "novalue"],
        [*STREAM, "--sink", "elsewhere"],
        [*STREAM, "--rejects-path", "/r"],
    ],
)
def test_bad_stream_arguments(argv, capsys):
    with pytest.raises(SystemExit):
        stream_job.arguments(argv)


@pytest.fixture
def messages(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_file(folder, 0, [message("1", "Casa", 10, "10:00:01"), "not json"])
    write_file(
        folder, 1, [message("2", "Casa", 5, "10:00:02"), message("3", "Gamer", 5, "10:05:00")]
    )
    return str(folder)


@pytest.mark.parametrize("sink, n_rows", [("log", 3), ("final", 1), ("documents", 3)])
def test_stream_job(spark, messages, tmp_path, sink, n_rows):
    out = str(tmp_path / "out")
    target = ["--sink-path", out] if sink != "documents" else ["--sink-option", f"path={out}"]
    args = stream_job.arguments([
        "--source", "text", "--source-path", messages, "--source-schema", "value string",
        "--source-option", "maxFilesPerTrigger=1", "--sink", sink, *target,
        "--checkpoint", str(tmp_path / "ck"), "--available-now",
    ])
    stream_job.start(spark, args).awaitTermination()
    assert spark.read.parquet(out).count() == n_rows


def test_stream_job_rejects(spark, messages, tmp_path):
    args = stream_job.arguments([
        *STREAM, "--source-path", messages, "--source-schema", "value string",
        "--rejects-path", str(tmp_path / "rejects"),
        "--rejects-checkpoint", str(tmp_path / "ck"), "--available-now",
    ])
    stream_job.start_rejects(spark, args).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "rejects")), "raw") == [("not json",)]


def test_batch_job_and_reports(spark, messages, tmp_path):
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    batch_job.run(spark, batch_job.parser().parse_args([
        "--source", "text", "--source-path", messages, "--sink-path", out,
        "--rejects-path", rejects,
    ]))
    assert rows(spark.read.parquet(rejects)) == [("not json", "sale_id")]
    args = report_job.parser().parse_args(["--windows-path", out])
    text = "\n".join(report_job.lines(report_job.current_windows(spark, args), args.lines))
    assert "Faturamento Total: R$ 20.00" in text
    assert "Casa            | " + "█" * 38 + " 75.00%" in text
    assert text.count("─" * 61) == 2 + 2 + 2


def test_looking_up_a_window_skips_the_others(spark, tmp_path):
    folder, out = tmp_path / "many", str(tmp_path / "out")
    folder.mkdir()
    write_file(folder, 0, [
        message(str(i), f"c{i % 3}", 1, f"{i // 60:02}:{i % 60:02}:00") for i in range(1440)
    ])
    # several files, as a table of useful size has
    conf = {**TABLE_CONF, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        batch_job.run(spark, batch_job.parser().parse_args([
            "--source", "text", "--source-path", str(folder), "--sink-path", out,
        ]))
    finally:
        for key in conf:
            spark.conf.unset(key)
    windows = spark.read.schema(WINDOW_SCHEMA).parquet(out)
    found = find_window(windows, "c0", at("12:00:00"))
    assert rows(found, "sales_count") == [(1,)]
    assert windows.count() == 1440 and rows_scanned(found) < 500


def test_reports_over_a_log(spark, messages, tmp_path):
    log = str(tmp_path / "log")
    args = stream_job.arguments([
        "--source", "text", "--source-path", messages, "--source-schema", "value string",
        "--source-option", "maxFilesPerTrigger=1", "--sink-path", log,
        "--checkpoint", str(tmp_path / "ck"), "--available-now",
    ])
    stream_job.start(spark, args).awaitTermination()

    def total(*extra):
        args = report_job.parser().parse_args(["--log-path", log, *extra])
        text = list(report_job.lines(report_job.current_windows(spark, args), args.lines))
        return next(t for t in "\n".join(text).split("\n") if t.startswith("Faturamento Total"))

    assert total() == "Faturamento Total: R$ 20.00"
    assert total("--every-emission") == "Faturamento Total: R$ 30.00"


def test_reports_as_files_and_cut_on_the_screen(spark, windows_of, tmp_path):
    windows = windows_of(*[("10:30:00", f"c{i}", float(i), 1) for i in range(30)])
    report_job.write(windows, str(tmp_path / "out"))
    written = spark.read.text(str(tmp_path / "out" / "report=6")).count()
    assert written == 30
    text = list(report_job.lines(windows, 7))
    assert sum(t.startswith("... (only the first 7 lines") for t in text) == 3


def test_report_job_fails_on_a_wrong_path(tmp_path, spark):
    args = report_job.parser().parse_args(["--log-path", str(tmp_path / "nothing")])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        report_job.current_windows(spark, args)


def test_rejects_of_a_topic_need_a_fixed_start():
    given = [
        "--source", "kafka", "--sink-path", "s", "--checkpoint", "c",
        "--rejects-path", "r", "--rejects-checkpoint", "rc",
    ]
    with pytest.raises(SystemExit):
        stream_job.arguments(given)
    stream_job.arguments([*given, "--source-option", "startingOffsets=earliest"])


def test_losing_offsets_is_a_choice_of_the_job():
    fake, given = FakeSession(), ["--source", "kafka", "--sink-path", "s", "--checkpoint", "c"]
    stream_job.messages(fake, stream_job.arguments(given))
    stream_job.messages(fake, stream_job.arguments([*given, "--ignore-data-loss"]))
    seen = [o.get("failOnDataLoss") for o in fake.readStream.seen["options"]]
    assert seen == [None, "false"]
