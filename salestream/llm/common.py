"""What the operators of this package share: input tables, stored intermediate tables, text rules."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salestream.workspace import new_path

#: The white space of all contracts: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """``df`` written once below the shared folder and read back: a lineage cut that survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_path(df: DataFrame, name: str) -> str:
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that nothing reads any more, on whatever file system holds them."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def strip_space(text: Column) -> Column:
    """Both ends, in linear time (an anchored pattern is quadratic on long runs of white space)."""
    return F.trim(text, F.lit(SPACE_CHARS))


def own_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def blocks_for(n_rows: int, rows_per_block: int) -> int:
    return max(1, math.ceil(n_rows / rows_per_block))


def fits_broadcast(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows; looks at one row more than that at most."""
    return df.limit(limit + 1).count() <= limit


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches a few rows at a time, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
