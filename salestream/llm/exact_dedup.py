"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

1. One scan hashes every whole text (white space removed) and stores a slim table: id, length, digest.
2. A Misra-Gries sketch (``approx_top_k``; one per digest slice, so that sketches are merged by many
   tasks) names up to ``NAMED`` digests of each slice, the most frequent first. With these figures a digest with more
   than one in 20 rows of its slice is among them, the sketch's error allowed for.
3. Exact sizes and winners of the named digests are counted with map-side partial sums: the verified
   winners. At most ``SLICES * NAMED`` rows, whatever the input, so they are broadcast and their rows are
   settled without a shuffle.
4. The remaining digests, none with a larger share than that, take the ordinary way: one shuffle by digest.

Defined results: a null text counts as empty; all empty texts are equal. A null id loses every tie. Of
rows that repeat both id and text exactly one stays. An empty table gives no rows. Columns other than id
and text are never read, and clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salestream.llm.common import SPACE, own_name, stored, table

SLICES = 64
COUNTERS = 256
NAMED = 32
#: Below so many copies (as the sketch estimates) a digest takes the ordinary way.
LEAST_COPIES = 64

DECISIONS = "doc_id, keep_id, group_size, kept, text_sha256"


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, points (length of the original text), sha (32 bytes) for every row of ``df``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.length(text).cast("long").alias("points"),
        F.unhex(F.sha2(F.regexp_replace(text, f"{SPACE}+", ""), 256)).alias("sha"),
    )


def _best_first() -> list[Column]:
    return [F.desc("points"), F.asc_nulls_last("doc_id"), F.asc("row")]


def _winner() -> Column:
    """The row that stays, as the least of a struct; partial minima combine before the shuffle."""
    return F.min(F.struct(
        (-F.col("points")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))


def heavy_digests(slim: DataFrame) -> DataFrame:
    """Verified winners of frequent digests: sha, keep_id, keep_row, group_size; at most SLICES * NAMED rows."""
    key = F.xxhash64("sha")
    named = (
        slim.select(F.pmod(key, F.lit(SLICES)).alias("slice"), key.alias("key"))
        .groupBy("slice")
        .agg(F.expr(f"approx_top_k(key, {NAMED}, {COUNTERS})").alias("top"))
        .select(F.explode("top").alias("top"))
        .where(F.col("top.count") >= LEAST_COPIES)
        .select(F.col("top.item").alias("key"))
    )
    return (
        slim.withColumn("key", key)
        .join(F.broadcast(named), "key", "left_semi")
        .groupBy("sha")
        .agg(_winner().alias("best"), F.count("*").alias("group_size"))
        .select("sha", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")
    )


def decisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = stored(digests(df, id_col, text_col), "exact-digests")
    # two digests with one 64-bit key could add rows beyond the named ones; the cap keeps the bound proven,
    # and what it leaves out takes the ordinary way
    heavy = stored(heavy_digests(slim).orderBy(F.desc("group_size"), "sha").limit(SLICES * NAMED), "exact-heavy")
    settled = slim.join(F.broadcast(heavy), "sha").withColumn("kept", F.col("row") == F.col("keep_row"))
    group = W.partitionBy("sha")
    ranked = group.orderBy(*_best_first())
    ordinary = slim.join(F.broadcast(heavy.select("sha")), "sha", "left_anti").select(
        "doc_id", "sha",
        F.first("doc_id").over(ranked).alias("keep_id"),
        F.count("*").over(group).alias("group_size"),
        (F.row_number().over(ranked) == 1).alias("kept"),
    )
    columns = ["doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")]
    return settled.select(*columns).unionByName(ordinary.select(*columns))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns. Ids must be unique here (else see ``decisions``)."""
    mark = own_name(df, "kept_id")
    kept = decisions(df, id_col, text_col).where("kept").select(F.col("doc_id").alias(mark))
    return df.join(kept, F.col(id_col).eqNullSafe(F.col(mark)), "left_semi")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept,
       text_sha256
FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id ASC NULLS LAST)
"""
