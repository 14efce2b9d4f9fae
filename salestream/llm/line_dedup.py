"""Line deduplication on levelled sorted runs of line hashes (DataFrame functions only).

``LineRuns`` holds every line key seen so far, once, with the largest document id that holds it. Keys are
in runs, each sorted by key. Batches come in descending order of document ids: a new batch's keys are
merge-anti-joined with the runs, and what is left is new, so its holder is final. The batch adds these as a
run of level 0; ``FANOUT`` runs of one level are merged into one of the next level.

A line whose key's holder is another document is a repeat. Keys with two distinct repeating documents,
hence three documents in all, lose their repeats. Only repeats are counted and joined further; lines that
occur once end at the join with the runs. Hot lines: counting is on distinct (key, document) pairs with
partial sums, and the joins of lines with keys are sort-merge joins whose hot partitions adaptive
execution splits.

Defined results: a null or empty text is one empty line. Rows that repeat an id are one document when
documents are counted, and each loses its own repeated lines; a null id is one document too, below all
others. Lines shorter than the limit always stay. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestream.llm.common import lower_ascii, own_name, remove, stored, strip_space, table, write_path

LEAST_POINTS = 20
LEAST_DOCS = 3
BATCHES = 3
FANOUT = 2
#: Stands for a null id where ids are compared.
NO_ID = -(2**63)


class LineRuns:
    """Levels of sorted runs (key, holder) in the shared folder; no key is in two runs."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark = spark
        self.fanout = fanout
        self.levels: list[list[str]] = []

    def keys(self) -> DataFrame:
        paths = [path for level in self.levels for path in level]
        reader = self.spark.read.schema("key binary, holder long")
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], "key binary, holder long")

    def add(self, lines: DataFrame) -> None:
        """Record the lines (key, id) of a batch whose ids are all below those of earlier batches."""
        own = lines.groupBy("key").agg(F.max("id").alias("holder"))
        fresh = own.join(self.keys().select("key"), "key", "left_anti") if self.levels else own
        self._put(0, write_path(fresh.sortWithinPartitions("key"), "line-run"))

    def _put(self, level: int, path: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            merged = self.spark.read.parquet(*old).repartition("key").sortWithinPartitions("key")
            path = write_path(merged, "line-run")
            self.levels[level] = []
            remove(self.spark, *old)
            self._put(level + 1, path)

    def drop(self) -> None:
        remove(self.spark, *(path for level in self.levels for path in level))
        self.levels = []


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def long_lines(df: DataFrame, id_col: str, text_col: str, least_points: int) -> DataFrame:
    """id, text_key (digest of the whole text), n (line number), key (digest) of every line that may go."""
    key = lower_ascii(strip_space(F.col("line")))
    return (
        df.select(
            F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("id"),
            F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("text_key"),
            F.posexplode(_lines(F.col(text_col))).alias("n", "line"))
        .select("id", "text_key", "n", key.alias("key"))
        .where(F.length("key") >= least_points)
        .select("id", "text_key", "n", F.unhex(F.sha2("key", 256)).alias("key"))
    )


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_points: int = LEAST_POINTS,
                   least_docs: int = LEAST_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """The lines that go: id, text_key, n."""
    lines = stored(long_lines(df, id_col, text_col, least_points), "lines")
    shares = [1 - i / batches for i in range(1, batches)]
    cuts = lines.agg(F.percentile_approx("id", shares, 1000)).first()[0] if shares else []
    runs, above = LineRuns(df.sparkSession, fanout), None
    for cut in [*sorted(set(cuts or []), reverse=True), None]:
        batch = lines if above is None else lines.where(F.col("id") < above)
        runs.add(batch if cut is None else batch.where(F.col("id") >= cut))
        above = cut
    repeats = stored(
        lines.join(runs.keys(), "key").where(F.col("id") != F.col("holder")).select("id", "text_key", "n", "key"),
        "repeated-lines")
    gone = stored(  # stored, so that the join below has plain shuffles on both sides, which Spark can split
        repeats.select("key", "id").distinct()
        .groupBy("key").agg(F.count("*").alias("docs"))
        .where(F.col("docs") >= least_docs - 1).select("key"),
        "gone-keys")
    out = stored(repeats.join(gone, "key", "left_semi").drop("key"), "dropped-lines")
    runs.drop()
    return out


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_points: int = LEAST_POINTS,
                least_docs: int = LEAST_DOCS) -> DataFrame:
    """``df`` with repeated lines taken out of its texts, and n_lines, n_dropped (both long).

    A text that loses nothing stays as it is, null included. The two counts get another name (with ``_``
    added) where ``df`` has such columns.
    """
    dropped = repeated_lines(df, id_col, text_col, least_points, least_docs)
    rid, rkey, flags, gone = (own_name(df, x) for x in ("gone_id", "gone_key", "gone_flags", "gone_lines"))
    # one flag for every line up to the last that goes: a line is then looked up in constant time
    by_text = (
        dropped.distinct().groupBy("id", "text_key").agg(F.sort_array(F.collect_list("n")).alias("at"))
        .select(
            F.col("id").alias(rid), F.col("text_key").alias(rkey), F.size("at").alias(gone),
            F.split(F.array_join(F.expr(
                "zip_with(at, concat(array(-1), at), (v, before) -> concat(repeat('-', v - before - 1), 'x'))"
            ), ""), "").alias(flags))
    )
    same = (F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long") == F.col(rid)) & (
        F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))) == F.col(rkey))
    n_lines, n_dropped = own_name(df, "n_lines"), own_name(df, "n_dropped")
    kept = F.filter(_lines(F.col(text_col)), lambda _, i: F.coalesce(F.get(F.col(flags), i), F.lit("-")) != "x")
    return df.join(by_text, same, "left").select(
        *[F.when(F.col(flags).isNull(), F.col(c)).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col
          else F.col(c) for c in df.columns],
        F.size(_lines(F.col(text_col))).cast("long").alias(n_lines),
        F.coalesce(F.col(gone), F.lit(0)).cast("long").alias(n_dropped),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(documents).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
    SELECT r, doc_id, n, line,
           translate(trim(line, E' \t\n\x0B\x0C\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM d)),
k AS (
    SELECT key, max(doc_id) AS holder FROM l WHERE length(key) >= 20 GROUP BY key
    HAVING count(DISTINCT doc_id) >= 3)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (l.doc_id <> holder) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (holder IS NULL OR l.doc_id = holder), ''))
           AS kept_sha256
FROM l LEFT JOIN k ON l.key = k.key GROUP BY l.r, l.doc_id
"""
