from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def partition_profile(envelope: DataFrame) -> DataFrame:
    """Offset range, message count and share per topic partition.

    ``gaps`` is the number of offsets in the range without a message (retention,
    compaction, transactions); an even ``n_messages`` means a balanced topic.
    """
    return (
        envelope.groupBy("topic", "partition")
        .agg(
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.count(F.lit(1)).alias("n_messages"),
        )
        .withColumn(
            "gaps", F.col("last_offset") - F.col("first_offset") + 1 - F.col("n_messages")
        )
    )


def offset_gaps(envelope: DataFrame, offsets_per_range: int = 1_000_000) -> DataFrame:
    """What is lost and what is there twice: topic, partition, kind, first_offset, last_offset, n_messages.

    ``kind`` is ``gap`` (offsets between the least and the greatest that no message has) or ``repeat`` (offsets that more
    than one message has); neighbouring offsets are one row. ``n_messages`` is how many messages lack, or are there beyond the
    first. Messages without a place are left out.

    Offsets are cut into ranges, so a partition of any size is spread over tasks; only what touches the border of a
    range is put together by partition, at most two rows for each range.
    """
    place = ["topic", "partition"]
    size = F.lit(offsets_per_range)
    counted = (
        envelope.where("topic IS NOT NULL AND partition IS NOT NULL AND offset IS NOT NULL")
        .groupBy(*place, "offset").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("range", F.floor(F.col("offset") / size))
    )
    inside = Window.partitionBy(*place, "range").orderBy("offset")
    before = F.lag("offset").over(inside)
    followed = counted.select(*place, "range", "offset", "n", before.alias("before"))
    found = lambda first, last: [
        F.lit("gap").alias("kind"), first.alias("first_offset"), last.alias("last_offset"), (last - first + 1).alias("n_messages")]
    here, there = F.col("before") + 1, F.col("offset") - 1
    gaps = followed.where(there >= here).select(*place, *found(here, there))
    ends = counted.groupBy(*place, "range").agg(F.min("offset").alias("offset"), F.max("offset").alias("last"))
    by_range = ends.withColumn("before", F.lag("last").over(Window.partitionBy(*place).orderBy("range")))
    between = by_range.where(there >= here).select(*place, *found(here, there))
    # gaps that meet at a border cannot be: a range with a row ends its gap there
    many = counted.where("n > 1").withColumn("island", F.col("offset") - F.row_number().over(inside))
    islands = many.groupBy(*place, "range", "island").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.sum(F.col("n") - 1).alias("n_messages"))
    at_border = (F.col("first_offset") % size == 0) | (F.col("last_offset") % size == size - 1)
    in_order = Window.partitionBy(*place).orderBy("first_offset")
    begins = (F.col("first_offset") != F.coalesce(F.lag("last_offset").over(in_order) + 1, F.lit(-1))).cast("int")
    stitched = (
        islands.where(at_border).withColumn("begins", begins)
        .withColumn("island", F.sum("begins").over(in_order)).groupBy(*place, "island").agg(
            F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"),
            F.sum("n_messages").alias("n_messages"))
    )
    repeats = islands.where(~at_border).drop("range").unionByName(stitched)
    return gaps.unionByName(between).unionByName(repeats.select(
        *place, F.lit("repeat").alias("kind"), "first_offset", "last_offset", "n_messages"))
