"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits link at ``MOST_BITS`` = 4 or fewer differing bits. Cut into three segments, two
linked fingerprints have a segment that differs in at most one bit (4 // 3 = 1). So each segment is indexed
under its one-wildcard variants: position ``i`` named and its bit cleared, one variant for each bit of the
segment, 64 for a fingerprint. Two segments share a variant exactly if they differ in at most one bit, so an
equality join on variants finds every link; the join condition verifies the distance.

Links are between distinct fingerprints, so exact copies cost nothing. Pairs within a group of near copies
are not listed: first, fingerprints next to each other in a signature bucket are linked where they verify
(a linear number of links), which joins most of a dense group; then only fingerprints that still
are in different components are compared, those of a bucket's largest component with the others only.
Both rounds end in connected components by alternating least-neighbour steps, cut by stored tables.

Fingerprints are computed in Arrow batches (Spark has no loop over shingles that compiles); the rest are
DataFrame functions. Defined results: a null text counts as empty, its fingerprint is zero and links like any
other. Null ids keep their rows and are never the least. Rows that repeat an id have their own fingerprints
and one component. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salestream.llm.common import in_parts, own_name, stored, table

SHINGLE = 4
SEED = 42
MOST_BITS = 4
#: Low end and width of each segment.
SEGMENTS = ((0, 21), (21, 21), (42, 22))

_TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    words = text.translate(_TO_LOWER).split()
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = memoryview(b" ".join(words))
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[start:end], SEED) for start, end in zip(starts, ends[shingle - 1:], strict=False)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    hashes = np.array(shingle_hashes(text, shingle), dtype=">u8")
    if not len(hashes):
        return 0
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):  # bounded memory for very long texts
        part = hashes[at:at + 65536]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes)).tobytes(), "big")


def _add_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        prints = [fingerprint(text.as_py() or b"") for text in batch.column(2)]
        signed = np.array(prints, dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(signed)], names=["doc_id", "text_key", "fp"])


def _text_key(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (a hash that tells rows with one id apart), fp (the 64 bits as a signed long)."""
    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(text_col).alias("text_key"),
                     F.col(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(_add_fingerprints, "doc_id long, text_key long, fp long")


def _variants(prints: DataFrame) -> DataFrame:
    """Every column of ``prints`` and one row for each signature: at (bit cleared), sig (what is left of the segment)."""
    entries = []
    for low, width in SEGMENTS:
        mask = ((1 << width) - 1) << low
        for bit in range(low, low + width):
            keep = mask & ~(1 << bit)
            keep -= (1 << 64) if keep >= 1 << 63 else 0
            entries.append(F.struct(F.lit(bit).cast("byte").alias("at"), F.col("fp").bitwiseAND(F.lit(keep)).alias("sig")))
    return prints.select("*", F.explode(F.array(*entries)).alias("v")).select(*prints.columns, "v.at", "v.sig")


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MOST_BITS


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for every node (long) of ``nodes``; edges: a, b.

    Alternates: every node and its neighbours are attached to the least of them. Each round writes its
    edges and ends the lineage there; it stops when nothing changes.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(ordered.where("a <> b").distinct(), "links")
    before = _state(links)
    while True:
        # large step: neighbours above a node go to the least neighbour of the node
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = (
            both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
        )
        # small step: neighbours below a node and the node go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            large.join(low, "a").select(F.explode(F.array(
                F.struct(F.col("a").alias("a"), F.col("least").alias("b")),
                F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct()
        )
        after = stored(small, "links")
        now = _state(after)
        if now == before:
            break
        links, before = after, now
    # a node above several is attached to the least; at the end every node has one edge, to its root
    roots = links.groupBy("a").agg(F.min("b").alias("root"))
    return nodes.join(roots, nodes.node == roots.a, "left").select("node", F.coalesce("root", "node").alias("root"))


def _neighbour_links(signed: DataFrame) -> DataFrame:
    after = W.partitionBy("at", "sig").orderBy("fp")
    return (
        signed.withColumn("next", F.lead("fp").over(after))
        .where(F.col("next").isNotNull() & _near("fp", "next"))
        .select(F.col("fp").alias("a"), F.col("next").alias("b")).distinct()
    )


def _cross_links(labelled: DataFrame) -> DataFrame:
    """Links between fingerprints (fp, root) that have different roots, found by the equality join."""
    bucket, same_root = W.partitionBy("at", "sig"), W.partitionBy("at", "sig", "root")
    members = stored(
        _variants(labelled)
        .withColumn("n", F.count("*").over(same_root))
        .withColumn("top", F.max(F.struct("n", "root")).over(bucket))
        .withColumn("other", F.min("root").over(bucket) != F.max("root").over(bucket))
        .where("other").select("at", "sig", "fp", "root", F.col("top.root").alias("top")),
        "mixed-buckets")
    left = members.where("root <> top").select("at", "sig", F.col("fp").alias("a"), F.col("root").alias("ra"), "top")
    right = members.select("at", "sig", F.col("fp").alias("b"), F.col("root").alias("rb"))
    # two rows outside the largest component meet twice, once is enough
    once = (F.col("rb") == F.col("top")) | (F.col("a") < F.col("b"))
    near = left.join(right.alias("r"), (left["at"] == F.col("r.at")) & (left["sig"] == F.col("r.sig"))
                     & (F.col("ra") != F.col("rb")) & once & _near("a", "b"))
    return near.select("a", "b").distinct()


def clusters(prints: DataFrame) -> DataFrame:
    """fp, root for the distinct fingerprints of ``prints`` (fp long)."""
    nodes = stored(prints.select("fp").distinct(), "fingerprints")
    named = nodes.select(F.col("fp").alias("node"))
    first = stored(components(_neighbour_links(_variants(nodes)), named), "components")
    labelled = first.select(F.col("node").alias("fp"), "root")
    cross = _cross_links(labelled)
    root_of = lambda name: labelled.select(F.col("fp").alias(name), F.col("root").alias(f"root_{name}"))
    merged = cross.join(root_of("a"), "a").join(root_of("b"), "b").select(
        F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    heads = first.select(F.col("root").alias("node")).distinct()
    second = stored(components(merged, heads), "components")
    return labelled.join(second, labelled.root == second.node).select("fp", second.root.alias("root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, fp (signed long), component_id (least doc_id reachable)."""
    prints = stored(fingerprints(df, id_col, text_col), "doc-fingerprints")
    roots = stored(clusters(prints), "fingerprint-clusters")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    ids = least.join(roots, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = roots.join(ids, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``df`` for each component: least id (null last), then least hash of the text.

    Rows that repeat id and text are one row here.
    """
    prints = stored(fingerprints(df, id_col, text_col), "doc-fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key"))
    by_print = prints.groupBy("fp").agg(best.alias("best"))
    kept = by_print.join(clusters(prints), "fp").groupBy("root").agg(F.min("best").alias("best"))
    key = own_name(df, "row_key")
    named = lambda doc_id, text_key: F.concat_ws(":", doc_id.cast("string"), text_key.cast("string"))
    kept = kept.select(named(F.col("best.doc_id"), F.col("best.text_key")).alias(key))
    keyed = df.withColumn(key, named(F.col(id_col).cast("long"), _text_key(text_col)))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(*df.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
