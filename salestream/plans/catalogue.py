"""The operators applied to the ``events`` table, one entry per question.

Events play the part of sales: the event type is the category and the value is
the amount. Reports use one-hour windows. Figures that sum doubles are rounded at
the very end, because the order of summation shows in the last bits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salestream import sinks, sources, streaming
from salestream.functions import to_cents
from salestream.operators import (
    baseline,
    digests,
    manifest,
    parse,
    reconcile,
    reports,
    rollup,
    serving,
    text_report,
)
from salestream.operators.aggregate import (
    WATERMARK,
    chained_windows,
    events_in_window,
    pane_width,
    sliding_windows,
    windowed_sales,
)
from salestream.schema import (
    SALE_COLUMNS,
    WINDOW_SCHEMA,
    as_sales,
    from_documents,
    in_session_time,
    to_documents,
    without_zone,
)
from salestream.workspace import new_path

HOUR = "1 hour"
HALF = "30 minutes"
QUARTER = "15 minutes"
CATEGORY = "purchase"
WINDOW_START = "2024-01-15 12:00:00"
LATER_DAYS = "2024-01-20"
CORRECTED_DAY = "2024-01-10"
EMPTIED_DAY = "2024-01-12"
DRAIN = {"availableNow": True}
SLICES = 4
FILES_PER_SLICE = 4

# Stated, so that no job has to look into the files before a query is planned.
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, event_type string, value double"

Query = Callable[[SparkSession, str], DataFrame]


def _sales(table: DataFrame) -> DataFrame:
    return as_sales(table, "event_id", "event_type", "value", "ts")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    return _sales(sources.read_batch(spark, "parquet", schema=EVENTS_SCHEMA, path=path))


def sales_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Braces make the path a pattern, which serves a single file and a folder alike.
    path = f"{sf_dir}/{{events.parquet}}"
    return _sales(sources.read_stream(spark, "parquet", schema=EVENTS_SCHEMA, path=path))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_sales(sales(spark, sf_dir), HOUR)


def cents(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: to_cents(F.col(c)) for c in columns or ("revenue",)})


# Windowed aggregation


def windowed_sales_1m(spark, sf_dir):
    return cents(windowed_sales(sales(spark, sf_dir), "1 minute"))


def windowed_sales_1h(spark, sf_dir):
    return cents(hourly(spark, sf_dir))


def windowed_sales_sliding(spark, sf_dir):
    return cents(windowed_sales(sales(spark, sf_dir), HOUR, HALF))


def windowed_sales_sliding_uneven(spark, sf_dir):
    """A slide that does not divide the width; panes are their common divisor."""
    return cents(windowed_sales(sales(spark, sf_dir), HOUR, "40 minutes"))


def window_from_events(spark, sf_dir):
    one = events_in_window(sales(spark, sf_dir), CATEGORY, WINDOW_START, HOUR)
    return cents(windowed_sales(one, HOUR))


# Messages


def envelope_round_trip(spark, sf_dir):
    envelope = sinks.to_envelope(sales(spark, sf_dir))
    return cents(without_zone(windowed_sales(parse.parse_events(envelope), HOUR)))


def dirty_envelope(events: DataFrame) -> DataFrame:
    """Messages spoiled in a way that depends on the category."""
    events = events.withColumn(
        "sale_id", F.when(F.col("category") != "view", F.col("sale_id"))
    )
    message = F.col("value").cast("string")
    spoiled = (
        F.when(F.col("category") == "error", F.lit("not json"))
        .when(
            F.col("category") == "signup",
            F.regexp_replace(message, '"timestamp":"[^"]*"', '"timestamp":"soon"'),
        )
        .when(
            F.col("category") == "purchase",
            F.regexp_replace(message, '"valor":([^,]*),', '"valor":"$1",'),
        )
        .otherwise(message)
    )
    return sinks.to_envelope(events, keep=("category",)).select(
        spoiled.cast("binary").alias("value")
    )


def dirty_windowed_sales(spark, sf_dir):
    events = parse.parse_events(dirty_envelope(sales(spark, sf_dir)))
    return cents(without_zone(windowed_sales(events, HOUR)))


def dirty_revenue_by_category(spark, sf_dir):
    """Windows without a counted sale or without revenue in a report."""
    events = parse.parse_events(dirty_envelope(sales(spark, sf_dir)))
    return reports.revenue_by_category(windowed_sales(events, HOUR))


def event_quality(spark, sf_dir):
    """Messages by their first missing field, in one pass."""
    events = parse.parse_events(dirty_envelope(sales(spark, sf_dir)))
    verdict = F.coalesce(parse.missing_field(), F.lit("valid")).alias("verdict")
    return events.groupBy(verdict).agg(F.count(F.lit(1)).alias("n_events"))


def split_rejects(spark, sf_dir):
    events = parse.parse_events(dirty_envelope(sales(spark, sf_dir)), keep_raw=True)
    _, rejected = parse.split_valid_invalid(events, SALE_COLUMNS)
    return rejected.groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("raw") == "not json").alias("n_not_json"),
    )


def placed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the place they would have in a topic of three partitions."""
    return sales(spark, sf_dir).withColumns({
        "topic": F.lit("sales"),
        "partition": F.pmod("sale_id", F.lit(3)).cast("int"),
        "offset": F.expr("sale_id div 3"),
    })


def partition_profile(spark, sf_dir):
    envelope = sinks.to_envelope(
        placed_sales(spark, sf_dir), keep=("topic", "partition", "offset")
    )
    return sources.partition_profile(envelope)


def offset_gaps(spark, sf_dir):
    """A topic that lost some offsets and has others twice, also across the borders of the ranges."""
    placed, offset = placed_sales(spark, sf_dir), F.col("offset")
    lost = offset.between(95, 104) | (offset % 97).isin(13, 14)
    twice = offset.between(195, 205) | (offset % 101 == 7)
    kept = placed.filter(~lost).withColumn("copies", F.when(twice, F.lit(2)).otherwise(F.lit(1)))
    sent = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    envelope = sinks.to_envelope(sent, keep=("topic", "partition", "offset"))
    return sources.offset_gaps(envelope, offsets_per_range=100)


def peek_messages(spark, sf_dir):
    """The first messages of the topic; only those are encoded."""
    place = ("partition", "offset")
    first = sources.peek(placed_sales(spark, sf_dir), 10, place)
    message = F.col("value").cast("string").alias("message")
    return sinks.to_envelope(first, keep=place).select(*place, message)


# Reports


def latest_windows(spark, sf_dir):
    return cents(reports.latest_windows(hourly(spark, sf_dir)))


def top_windows(spark, sf_dir):
    return cents(reports.top_windows(hourly(spark, sf_dir)))


def revenue_by_category(spark, sf_dir):
    return reports.revenue_by_category(hourly(spark, sf_dir))


def time_evolution(spark, sf_dir):
    return reports.time_evolution(hourly(spark, sf_dir))


def general_stats(spark, sf_dir):
    return cents(
        reports.general_stats(hourly(spark, sf_dir)),
        "revenue", "avg_revenue", "avg_sales_count", "max_revenue", "min_revenue",
    )


def category_distribution(spark, sf_dir):
    return cents(reports.category_distribution(hourly(spark, sf_dir)), "revenue", "percent")


def category_totals(spark, sf_dir):
    return cents(reports.category_totals(hourly(spark, sf_dir)))


def top_categories(spark, sf_dir):
    return cents(reports.top_categories(hourly(spark, sf_dir)))


def count_rows(spark, sf_dir):
    return reports.count_rows(hourly(spark, sf_dir))


def stored_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table as the batch job stores it: in time order, with statistics."""
    path = new_path(spark, "hours")
    sinks.write_windows(hourly(spark, sf_dir), path)
    return serving.read_windows(spark, path)


def find_window(spark, sf_dir):
    found = reports.find_window(stored_hours(spark, sf_dir), CATEGORY, WINDOW_START)
    return cents(without_zone(found))


def anomalous_windows(spark, sf_dir):
    found = reports.anomalous_windows(hourly(spark, sf_dir), 2.0)
    return cents(found, "revenue", "deviation")


def anomalies_by_baseline(spark, sf_dir):
    """Quarter hours far from earlier ones of their hour of the week; the baseline is merged from four parts."""
    windows = windowed_sales(sales(spark, sf_dir), QUARTER)
    part = F.minute("window_start")
    parts = [baseline.states(windows.filter(part == n)) for n in (0, 15, 30, 45)]
    merged = baseline.merge(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]))
    # means of cents fall on half cents, so they are rounded further out
    return cents(baseline.anomalies(windows, merged, 2.0), "revenue", "deviation").withColumn(
        "expected", F.bround("expected", 6))


def serving_documents(spark, sf_dir):
    return to_documents(cents(hourly(spark, sf_dir)))


def latest_windows_lines(spark, sf_dir):
    return text_report.latest_windows(hourly(spark, sf_dir))


def revenue_by_category_lines(spark, sf_dir):
    return text_report.revenue_by_category(hourly(spark, sf_dir))


def top_windows_lines(spark, sf_dir):
    return text_report.top_windows(hourly(spark, sf_dir))


def time_evolution_lines(spark, sf_dir):
    return text_report.time_evolution(hourly(spark, sf_dir))


def general_stats_lines(spark, sf_dir):
    return text_report.general_stats(hourly(spark, sf_dir))


def category_distribution_lines(spark, sf_dir):
    return text_report.category_distribution(hourly(spark, sf_dir))


# Emission log


def drain_slices(
    spark: SparkSession, sf_dir: str, path: str, slices: Sequence[int] = range(SLICES),
    start: Callable[[DataFrame], StreamingQuery] | None = None,
) -> None:
    """Feed the events to a stream of hourly windows, a slice at a time.

    Each slice is appended to the feed and read by a stream that goes on from the checkpoint,
    so a window is emitted as often as a slice changes it. Rate control takes a whole slice
    in one micro-batch. The watermark is longer than the data: nothing is late.
    """
    events = sales(spark, sf_dir)
    for n in slices:
        part = events.filter(F.pmod("sale_id", F.lit(SLICES)) == n)
        part.coalesce(FILES_PER_SLICE).write.mode("append").parquet(f"{path}/feed")
        source = sources.read_stream(
            spark, "parquet", {"maxFilesPerTrigger": str(FILES_PER_SLICE)},
            schema=events.schema, path=f"{path}/feed")
        if start:
            start(source).awaitTermination()
        else:
            _drain_to_log(source, path, watermark="3650 days")


def emission_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a stream that emitted every hour up to once for each slice of the events."""
    path = new_path(spark, "sliced-log")
    drain_slices(spark, sf_dir, path)
    return without_zone(serving.read_log(spark, f"{path}/log"))


def emission_log_latest(spark, sf_dir):
    return cents(serving.latest(emission_log(spark, sf_dir)))


def emission_log_as_appended(spark, sf_dir):
    """The category report over every emission, as an append-only store shows it."""
    return reports.revenue_by_category(emission_log(spark, sf_dir))


def stream_reemitted_latest(spark, sf_dir):
    """The newest emissions as documents: the running sums of the last slice are the totals."""
    return to_documents(cents(serving.latest(emission_log(spark, sf_dir))))


def stream_reemitted_as_appended(spark, sf_dir):
    """Every emission: the running sums of each hour and category after each slice."""
    return cents(emission_log(spark, sf_dir)).drop("batch_id")


def stream_restarted_log(spark, sf_dir):
    """What a stream is told that has a new checkpoint and the log of another, and the log then."""
    path = new_path(spark, "restarted-log")
    _drain_to_log(sales_stream(spark, sf_dir), path)
    try:
        streaming.start_update_log(
            windowed_sales(sales_stream(spark, sf_dir), HOUR), f"{path}/log", f"{path}/other", DRAIN)
        refused = False
    except ValueError:
        refused = True
    return _current(spark, path).withColumn("refused", F.lit(refused))


def compacted_log_latest(spark, sf_dir):
    """The current table from two compactions, with batches after each and folded ones deleted."""
    path = new_path(spark, "compacted-log")
    log, table = f"{path}/log", f"{path}/current"
    for slices in ((0, 1), (2,)):
        drain_slices(spark, sf_dir, path, slices)
        serving.compact(spark, log, table)
        serving.drop_folded(spark, log, table)
    drain_slices(spark, sf_dir, path, (3,))
    return cents(without_zone(serving.latest(serving.read_current(spark, log, table))))


def stream_after_compaction(spark, sf_dir):
    """A log whose batches are all folded and deleted refuses a new checkpoint; its own stream goes on."""
    path = new_path(spark, "folded-log")
    log, table = f"{path}/log", f"{path}/current"
    drain_slices(spark, sf_dir, path, (0, 1))
    serving.compact(spark, log, table)
    serving.drop_folded(spark, log)
    other = windowed_sales(sources.read_stream(
        spark, "parquet", schema=sales(spark, sf_dir).schema, path=f"{path}/feed"), HOUR)
    try:
        streaming.start_update_log(other, log, f"{path}/other", DRAIN)
        refused = False
    except ValueError:
        refused = True
    drain_slices(spark, sf_dir, path, (2, 3))
    current = serving.latest(serving.read_current(spark, log))
    return cents(without_zone(current)).withColumn("refused", F.lit(refused))


def compacted_partitions(spark, sf_dir):
    """The days of a compacted table, and which of two compactions wrote each; the second batch has later days only."""
    path = new_path(spark, "compacted-days")
    log, table = f"{path}/log", f"{path}/current"
    windows, generations = in_session_time(hourly(spark, sf_dir)), []
    later = F.col("window_start") >= F.lit(LATER_DAYS)
    for batch_id, part in enumerate((windows.filter(~later), windows.filter(later))):
        sinks.write_batch(part, batch_id, log)
        serving.compact(spark, log, table)
        serving.drop_folded(spark, log)
        days = manifest.read(spark, log).days
        generations += sorted(set(days.values()) - set(generations))
    number = {day: generations.index(of) + 1 for day, of in days.items()}
    named = spark.createDataFrame(sorted(number.items()), "day string, compaction int")
    current = serving.latest(serving.read_current(spark, log)).withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
    by_day = current.groupBy("day").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("revenue").alias("revenue"), F.sum("sales_count").alias("sales_count"))
    return cents(by_day.join(named, "day"))


def rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored states of all days, after one day was corrected and another lost its windows."""
    path = new_path(spark, "rollup")
    windows = hourly(spark, sf_dir)
    rollup.write_rollup(windows, path)
    day = F.date_format("window_start", "yyyy-MM-dd")
    corrected = windows.filter(day != EMPTIED_DAY).withColumn(
        "revenue", F.col("revenue") + F.when((day == CORRECTED_DAY) & (F.col("category") == CATEGORY), 100.0).otherwise(0.0))
    rollup.refresh(corrected, path, [CORRECTED_DAY, EMPTIED_DAY])
    return rollup.read_rollup(spark, path)


def rollup_reports(spark, sf_dir):
    """Revenue, tickets and share of each category from the states by day."""
    states = rolled_up(spark, sf_dir)
    shares = cents(rollup.category_distribution(states), "percent").select(F.col("category").alias("of"), "percent")
    return rollup.revenue_by_category(states).join(shares, F.col("category").eqNullSafe(F.col("of"))).drop("of")


def rollup_stats(spark, sf_dir):
    """The overall figures from the states by day."""
    return cents(rollup.general_stats(rolled_up(spark, sf_dir)),
                 "revenue", "avg_revenue", "avg_sales_count", "max_revenue", "min_revenue")


def appended_deltas(spark, sf_dir):
    """The sums of all documents of a plain append-only collection, after four runs and a repeated batch."""
    path = new_path(spark, "delta-documents")
    options = {"path": f"{path}/documents"}
    streaming.use_state_store(spark)

    def start(source: DataFrame) -> StreamingQuery:
        windows = windowed_sales(source, HOUR, watermark="3650 days")
        return streaming.start_delta_append(windows, "parquet", options, f"{path}/checkpoint", DRAIN)

    drain_slices(spark, sf_dir, path, start=start)
    sinks.append_deltas(in_session_time(hourly(spark, sf_dir)), "parquet", options)  # the whole table once more
    documents = spark.read.schema(to_documents(spark.createDataFrame([], WINDOW_SCHEMA)).schema).parquet(options["path"])
    held = from_documents(documents)
    summed = held.groupBy("category").agg(
        F.sum("revenue").alias("revenue"), F.sum("sales_count").alias("sales_count"),
        F.count_distinct("window_start").alias("n_windows"))
    return cents(summed)


def replayed_batch(spark, sf_dir):
    """A batch written to the log twice, as after a failure, then read back."""
    path = new_path(spark, "replayed-batch")
    batch = in_session_time(hourly(spark, sf_dir))
    for _ in range(2):
        sinks.write_batch(batch, 7, path)
    return cents(without_zone(serving.read_log(spark, path)))


def appended_documents(spark, sf_dir):
    """The same batch appended twice to a document store, which keeps both copies."""
    path = new_path(spark, "documents")
    batch = in_session_time(hourly(spark, sf_dir))
    for _ in range(2):
        sinks.append_documents(batch, 7, "parquet", {"path": path})
    documents = spark.read.schema(to_documents(batch).schema).parquet(path)
    return cents(without_zone(from_documents(documents)))


def truncated_log(spark, sf_dir):
    """Row counts of a log before and after it is emptied."""
    path = new_path(spark, "truncated-log")
    written = sinks.write_batch(in_session_time(hourly(spark, sf_dir)), 0, path)
    serving.truncate(spark, path)
    return reports.count_rows(serving.read_log(spark, path)).select(
        F.lit(written).cast("long").alias("n_before"), F.col("n_rows").alias("n_after")
    )


def published_messages(spark, sf_dir):
    """Messages sent to a topic (here files) and read back as windows."""
    path = new_path(spark, "topic")
    sinks.publish(sinks.to_envelope(sales(spark, sf_dir)), "parquet", {"path": path})
    messages = sources.read_batch(spark, "parquet", schema="value binary", path=path)
    return cents(without_zone(windowed_sales(parse.parse_events(messages), HOUR)))


def windows_and_rejects(spark, sf_dir):
    """Valid and rejected events in one pass, with the hours they fall into."""
    events = parse.classified(parse.parse_events(dirty_envelope(sales(spark, sf_dir))))
    return events.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct(F.date_trunc("hour", "event_time")).alias("n_hours"),
        to_cents(F.sum("amount")).alias("revenue"),
    )


# Reconciliation


def served_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table with one kind of fault on each of four days."""
    windows = hourly(spark, sf_dir)

    def on(day: str, category: str) -> Column:
        return (F.to_date("window_start") == F.lit(day)) & (F.col("category") == category)

    kept = windows.filter(~on("2024-01-05", "click"))
    altered = kept.withColumns({
        "revenue": F.col("revenue") + F.when(on("2024-01-06", "view"), 1).otherwise(0),
        "category": F.when(on("2024-01-08", "signup"), "ghost").otherwise(F.col("category")),
        "copies": F.when(on("2024-01-07", "error"), 2).otherwise(1),
    })
    return altered.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    ).drop("copies", "copy")


def reconcile_injected(spark, sf_dir):
    found = reconcile.diff(served_with_faults(spark, sf_dir), sales(spark, sf_dir), HOUR)
    return cents(found, "served_revenue", "expected_revenue")


def reconcile_pruned(spark, sf_dir):
    """The same faults, found by digests: events are summed again only for windows that differ."""
    path = new_path(spark, "digests")
    digests.write_digests(hourly(spark, sf_dir), path)
    found = digests.pruned_diff(
        served_with_faults(spark, sf_dir), sales(spark, sf_dir), digests.read_digests(spark, path), HOUR)
    return cents(found, "served_revenue", "expected_revenue")


def reconcile_one_window(spark, sf_dir):
    """The served row of a window, doubled, against its raw events."""
    served = stored_hours(spark, sf_dir).withColumn("revenue", F.col("revenue") * 2)
    found = reconcile.check_window(
        without_zone(served), sales(spark, sf_dir), CATEGORY, WINDOW_START, HOUR)
    return cents(found, "served_revenue", "expected_revenue")


def reconcile_sliding_window(spark, sf_dir):
    """A window between two full hours, served with a sale too many."""
    served = windowed_sales(sales(spark, sf_dir), HOUR, HALF).withColumn(
        "sales_count", F.col("sales_count") + 1)
    found = reconcile.check_window(
        served, sales(spark, sf_dir), CATEGORY, "2024-01-15 12:30:00", HOUR, HALF)
    return cents(found, "served_revenue", "expected_revenue")


# Streams; each one runs until it has read the table and then returns its result


def _drain_to_log(
    events: DataFrame, path: str, width: str = HOUR, watermark: str = WATERMARK
) -> StreamingQuery:
    streaming.use_state_store(events.sparkSession)
    query = streaming.start_update_log(
        windowed_sales(events, width, watermark=watermark),
        f"{path}/log", f"{path}/checkpoint", DRAIN, name=path.rsplit("/", 1)[-1],
    )
    query.awaitTermination()
    return query


def _current(spark: SparkSession, path: str) -> DataFrame:
    return cents(without_zone(serving.latest(serving.read_log(spark, f"{path}/log"))))


def stream_update_latest(spark, sf_dir):
    path = new_path(spark, "update-log")
    _drain_to_log(sales_stream(spark, sf_dir), path)
    return _current(spark, path)


def stream_sliding_latest(spark, sf_dir):
    """Only panes are streamed; the overlapping windows are made when the log is read."""
    path = new_path(spark, "sliding-log")
    _drain_to_log(sales_stream(spark, sf_dir), path, pane_width(HOUR, HALF))
    panes = without_zone(serving.latest(serving.read_log(spark, f"{path}/log")))
    return cents(sliding_windows(panes, HOUR, HALF))


def stream_envelope_latest(spark, sf_dir):
    """The live job from JSON messages to the current table."""
    path = new_path(spark, "message-log")
    messages = sinks.to_envelope(sales_stream(spark, sf_dir))
    _drain_to_log(parse.parse_events(messages), path)
    return _current(spark, path)


def stream_late_rows(spark, sf_dir):
    """Hourly totals fed to a stream of daily windows, the first half of the month last.

    The stream is stopped in between and goes on from its checkpoint; by then all
    days before the middle are closed, so what comes for them is dropped.
    """
    path = new_path(spark, "late-log")
    hours = in_session_time(hourly(spark, sf_dir))
    feed = as_sales(hours, "category", "category", "revenue", "window_start")
    in_time = F.col("event_time") >= F.lit("2024-01-15")
    for part in (feed.filter(in_time), feed.filter(~in_time)):
        part.write.mode("append").parquet(f"{path}/feed")
        source = sources.read_stream(
            spark, "parquet", schema=feed.schema, path=f"{path}/feed"
        )
        _drain_to_log(source, path, "1 day")
    return _current(spark, path)


def stream_final_windows(spark, sf_dir):
    path = new_path(spark, "final-windows")
    streaming.use_state_store(spark)
    windows = windowed_sales(sales_stream(spark, sf_dir), HOUR)
    streaming.start_final_windows(
        windows, f"{path}/windows", f"{path}/checkpoint", DRAIN
    ).awaitTermination()
    return cents(without_zone(serving.read_windows(spark, f"{path}/windows")))


def stream_sliding_final(spark, sf_dir):
    """Overlapping windows summed from panes within one stream, each written once when it is final."""
    path = new_path(spark, "sliding-final")
    streaming.use_state_store(spark)
    windows = chained_windows(sales_stream(spark, sf_dir), HOUR, HALF)
    streaming.start_final_windows(windows, f"{path}/windows", f"{path}/checkpoint", DRAIN).awaitTermination()
    return cents(without_zone(serving.read_windows(spark, f"{path}/windows")))


def stream_late_side(spark, sf_dir):
    """Served and late hourly totals by day, with those before the middle of the month sent last: none is lost."""
    path = new_path(spark, "late-side")
    streaming.use_state_store(spark)
    hours = in_session_time(hourly(spark, sf_dir))
    feed = as_sales(hours.withColumn("id", F.col("category")), "id", "category", "revenue", "window_start")
    in_time = F.col("event_time") >= F.lit("2024-01-15")
    for part in (feed.filter(in_time), feed.filter(~in_time)):
        part.write.mode("append").parquet(f"{path}/feed")
        source = sources.read_stream(spark, "parquet", schema=feed.schema, path=f"{path}/feed")
        streaming.start_update_log_with_late(
            source, f"{path}/log", f"{path}/late", f"{path}/checkpoint", "1 day", trigger=DRAIN).awaitTermination()
    served = serving.latest(serving.read_current(spark, f"{path}/log")).select(
        "window_start", "category", "revenue", "sales_count", F.lit(0).cast("bigint").alias("late_count"))
    late = streaming.read_late(spark, f"{path}/late").select(
        "window_start", "category", F.col("amount").alias("revenue"), F.lit(0).cast("bigint").alias("sales_count"),
        (F.col("late_by_ms") > 0).cast("bigint").alias("late_count"))
    both = served.unionByName(late).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    return cents(both.groupBy("window_start", "category").agg(
        *(F.sum(c).alias(c) for c in ("revenue", "sales_count", "late_count"))))


def stream_observed(spark, sf_dir):
    """What a stream counted of its messages in passing, summed over its micro-batches."""
    path = new_path(spark, "observed-log")
    name = path.rsplit("/", 1)[-1]
    events = streaming.observed(parse.parse_events(dirty_envelope(sales_stream(spark, sf_dir))))
    with streaming.record_progress(spark, name, f"{path}/progress"):
        _drain_to_log(events, path)
    return streaming.observed_totals(streaming.progress_log(spark, f"{path}/progress"))


def stream_rejects(spark, sf_dir):
    path = new_path(spark, "rejects")
    events = parse.parse_events(dirty_envelope(sales_stream(spark, sf_dir)))
    streaming.start_rejects(
        events, f"{path}/rejects", f"{path}/checkpoint", trigger=DRAIN
    ).awaitTermination()
    rejected = spark.read.schema("reject_reason string").parquet(f"{path}/rejects")
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_events"))


def stream_progress(spark, sf_dir):
    """The sums over all micro-batches of a stream that was stopped and went on three times."""
    path = new_path(spark, "progress-log")
    with streaming.record_progress(spark, path.rsplit("/", 1)[-1], f"{path}/progress"):
        drain_slices(spark, sf_dir, path)
    return streaming.progress_log(spark, f"{path}/progress").agg(
        F.sum("input_rows").alias("input_rows"),
        F.sum("state_rows_updated").alias("windows_updated"),
        F.sum("late_rows_dropped").alias("late_rows"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        windowed_sales_1m,
        windowed_sales_1h,
        windowed_sales_sliding,
        windowed_sales_sliding_uneven,
        window_from_events,
        envelope_round_trip,
        dirty_windowed_sales,
        dirty_revenue_by_category,
        event_quality,
        split_rejects,
        partition_profile,
        offset_gaps,
        peek_messages,
        latest_windows,
        top_windows,
        revenue_by_category,
        time_evolution,
        general_stats,
        category_distribution,
        category_totals,
        top_categories,
        count_rows,
        find_window,
        anomalous_windows,
        anomalies_by_baseline,
        rollup_reports,
        rollup_stats,
        serving_documents,
        latest_windows_lines,
        revenue_by_category_lines,
        top_windows_lines,
        time_evolution_lines,
        general_stats_lines,
        category_distribution_lines,
        emission_log_latest,
        emission_log_as_appended,
        replayed_batch,
        appended_documents,
        truncated_log,
        reconcile_injected,
        reconcile_pruned,
        reconcile_one_window,
        reconcile_sliding_window,
        windows_and_rejects,
        published_messages,
        compacted_log_latest,
        compacted_partitions,
        stream_after_compaction,
        appended_deltas,
        stream_update_latest,
        stream_reemitted_latest,
        stream_reemitted_as_appended,
        stream_restarted_log,
        stream_sliding_latest,
        stream_envelope_latest,
        stream_late_rows,
        stream_final_windows,
        stream_sliding_final,
        stream_late_side,
        stream_rejects,
        stream_observed,
        stream_progress,
    )
}
