"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), works on all documents that the one before kept, and returns a DataFrame
that is written and read again as the next one's documents. All but the last return the columns of ``documents``.

1. toxicity: documents that score as toxic go.
2. line_dedup: lines that repeat across documents go, save in one of them.
3. near_dedup: one document of each group of near copies (SimHash of four-word shingles, at most 4 of 64 bits) stays.
4. mixing: sources get tempered weights whose entropy is the share ``mixing.TARGET_ENTROPY`` of the largest possible, where
   that can be reached. Every document is used at least once, those of small sources up to ``mixing.MOST_REPEATS``
   times (as repeated rows), each source held there by itself; no clean document is lost here.
5. packing: documents become sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestream.llm import line_dedup, mixing, packing, simhash, toxicity
from salestream.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the same labels as the scoring query; rows that repeat id and text go together."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts change, so n_chars is counted anew where it does."""
    changed = line_dedup.dedup_lines(docs).withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mixture(docs, budget=None, cap_each=True)
    return mixed.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.default_tokenizer()).select(*packing.DIGEST)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Nearest neighbours, fingerprints and tokens are beyond SQL. tests/llm holds line dedup, near copies and mixed weights against
#: brute force, toxicity's search too, packing by its layout and ids, and the stages by what planted rows come to.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every earlier stage's documents are stored below the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
