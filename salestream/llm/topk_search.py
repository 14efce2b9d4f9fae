"""Exact top-k search by distributed histogram selection.

1. Vectors become whole numbers and are stored once. Queries and candidates are dealt into blocks of bounded
   size; a task scores one block of queries with one block of candidates, so no side is ever whole in one place.
2. Every pass scores everything. A block counts, for each query, its scores in the bins of the query's
   current interval; from the highest bin down only as long as fewer than k are above, as lower bins cannot hold
   the k-th best. Counts are added up over all blocks, and the interval becomes the bin that holds the k-th
   value. With whole scores a few passes end at the exact k-th value.
3. The last pass keeps the scores above that value, and of those equal to it the least ids as far as
   they can be needed. One ranking of these few rows breaks ties.

Scores are exact at any size. The histograms count keys that never fall as scores rise: a score below ``WIDE`` is its own
key, a larger one has its sign, bit length and leading bits. Scores of one key are then compared in full.

Defined results: vectors that are null, or hold a component that is null or whose multiple by the scale is no finite
double, take no part. Only vectors of one length are compared. Every row is a vector of its own: a row that repeats an id is
compared with its likes, and null ids come last among ties and ask nothing. Ranks go by exact scores; the score
column alone is held within the longs. Fewer than k candidates give fewer rows. An empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salestream.llm.common import blocks_for, stored, table

K = 20
SCALE = 64
EVERY = 20
#: A pass cuts an interval of scores, whose size is a power of two, into this power of two of bins at most.
BIN_BITS = 8
BINS = 1 << BIN_BITS
QUERY_BLOCK = 1_000
CANDIDATE_BLOCK = 8_000
#: Scores held at once in a task.
SCORES_AT_ONCE = 1_000_000
#: Scores held at once where they are beyond ``WIDE``.
WIDE_SCORES_AT_ONCE = 100_000
#: From this size on, a score's key is made of its bit length and leading bits.
WIDE = 2**60
LEADING_BITS = 47
#: Above all keys; differences of two are longs.
MOST_KEY = 2**61
LONG = 2**63
#: Up to this size sums of doubles are exact whole numbers.
EXACT_DOUBLE = 2**53


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """row, vec_id, dim, vec (whole numbers, as doubles) of the rows that take part, stored."""
    x = lambda c: F.lit(float(scale)) * c.cast("double")
    usable = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) != float("inf")))
    # a double of EXACT_DOUBLE or more is a whole number, and may be no long
    whole = lambda y: F.when(F.abs(y) < EXACT_DOUBLE, F.floor(y).cast("double")).otherwise(y)
    rows = df.where(F.col(vec_col).isNotNull() & usable).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vec_col, lambda c: whole(x(c))).alias("vec"))
    return stored(rows.withColumn("dim", F.size("vec")), "vectors")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), -1)


def _largest(queries: np.ndarray, candidates: np.ndarray) -> int:
    """No score is larger, either way."""
    most = lambda a: int(np.abs(a).max(initial=0))
    return most(queries) * most(candidates) * queries.shape[1]


def _key(score: int) -> int:
    size = abs(score)
    if size < WIDE:
        return score
    bits = size.bit_length()
    key = WIDE + (bits << LEADING_BITS) + ((size >> (bits - 1 - LEADING_BITS)) & ((1 << LEADING_BITS) - 1))
    return key if score > 0 else -key


def _detail(score: int) -> bytes | None:
    """Orders the scores of one key, which have one sign and bit length; None where the key is the score."""
    size = abs(score)
    if size < WIDE:
        return None
    n = (size.bit_length() + 7) // 8
    return (size if score > 0 else (1 << (8 * n)) - 1 - size).to_bytes(n, "big")


def scores(queries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Keys of the inner products, and these themselves (as Python numbers) where some may be ``WIDE``."""
    bound = _largest(queries, candidates)
    if bound < EXACT_DOUBLE:
        return (queries @ candidates.T).astype(np.int64), None
    if bound < WIDE:
        return queries.astype(np.int64) @ candidates.astype(np.int64).T, None
    whole = lambda a: np.array([[int(x) for x in row] for row in a], dtype=object).reshape(a.shape)
    exact = whole(queries) @ whole(candidates).T
    return np.array([_key(x) for x in exact.ravel()], dtype=np.int64).reshape(exact.shape), exact


def _parts(queries: pd.DataFrame, candidates: pd.DataFrame):
    """Queries, as many as memory allows; keys and exact scores; and which of these are of other rows."""
    if not len(queries) or not len(candidates):
        return
    them, rows = _matrix(candidates["vec"]), candidates["row"].to_numpy()
    wide = _largest(_matrix(queries["vec"]), them) >= WIDE
    step = max(1, (WIDE_SCORES_AT_ONCE if wide else SCORES_AT_ONCE) // len(candidates))
    for at in range(0, len(queries), step):
        part = queries.iloc[at:at + step]
        yield part, *scores(_matrix(part["vec"]), them), rows[None, :] != part["row"].to_numpy()[:, None]


def _histogram(k: int):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"row": np.zeros(0, np.int64), "bin": np.zeros(0, np.int32), "n": np.zeros(0, np.int64)})]
        for part, found, _, others in _parts(queries, candidates):
            low, bits = part["low"].to_numpy()[:, None], part["bits"].to_numpy()[:, None]
            # a bin beyond the interval's end is the same for all that are above, one before its start for all below
            bins = np.clip((found - low) >> np.maximum(bits - BIN_BITS, 0), -1, 1 << np.minimum(bits, BIN_BITS)) + 1
            bins[~others] = 0
            size = BINS + 2
            flat = np.bincount((np.arange(len(part))[:, None] * size + bins).ravel(), minlength=len(part) * size)
            counts = flat.reshape(len(part), size)
            higher = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
            counts[:, 0] = 0
            counts[np.arange(len(part)), (1 << np.minimum(bits[:, 0], BIN_BITS)) + 1] = 0
            at, b = np.nonzero((counts > 0) & (higher < k))
            out.append(pd.DataFrame({"row": part["row"].to_numpy()[at], "bin": (b - 1).astype(np.int32), "n": counts[at, b]}))
        return pd.concat(out)

    return run


BEST = "query_row long, query_id long, row long, vec_id long, key long, detail binary, score long"


def _best(k: int):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        # equal scores are taken in the order of the ranking: least id first, null last, then row
        order = np.lexsort((candidates["row"], candidates["vec_id"].fillna(0), candidates["vec_id"].isna()))
        candidates = candidates.iloc[order].reset_index(drop=True)
        for part, found, exact, others in _parts(queries, candidates):
            kth = part["low"].to_numpy()[:, None]
            above, equal = others & (found > kth), others & (found == kth)
            room = k - above.sum(axis=1)
            for q in np.flatnonzero(np.abs(kth[:, 0]) >= WIDE) if exact is not None else ():
                best = sorted(np.flatnonzero(equal[q]), key=lambda c, q=q: -exact[q, c])  # stable: ties by id
                equal[q] = False
                equal[q, best[:room[q]]] = True
            equal &= equal.cumsum(axis=1) <= room[:, None]
            at, c = np.nonzero(above | equal)
            full = found[at, c].tolist() if exact is None else exact[at, c].tolist()
            out.append(pd.DataFrame({
                "query_row": part["row"].to_numpy()[at], "query_id": part["vec_id"].to_numpy()[at],
                "row": candidates["row"].to_numpy()[c], "vec_id": candidates["vec_id"].iloc[c].to_numpy(),
                "key": found[at, c], "detail": pd.Series([_detail(x) for x in full], dtype=object),
                "score": pd.Series([max(-LONG, min(LONG - 1, x)) for x in full], dtype="int64")}))
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in BEST.split(", ")})

    return run


def _tiles(queries: DataFrame, candidates: DataFrame, n_query_blocks: int, n_candidate_blocks: int):
    """Both sides copied to the tiles (length, query block, candidate block) they meet in."""
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("qb", block(n_query_blocks)).withColumn("cb", every(n_candidate_blocks))
    right = candidates.withColumn("cb", block(n_candidate_blocks)).withColumn("qb", every(n_query_blocks))
    return left.groupBy("dim", "qb", "cb").cogroup(right.groupBy("dim", "qb", "cb"))


def _refined(queries: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The intervals after a pass: the bin in which the number of better scores reaches k, else the lowest one."""
    down = W.partitionBy("row").orderBy(F.desc("bin"))
    so_far = counts.join(queries.select("row", "above"), "row").withColumn("so_far", F.col("above") + F.sum("n").over(down))
    reached = so_far.groupBy("row").agg(
        F.coalesce(F.max(F.when(F.col("so_far") >= k, F.col("bin"))), F.min("bin")).alias("bin"),
        F.collect_list(F.struct("bin", "n")).alias("bins"))  # BINS entries at most
    better = F.aggregate(
        F.filter("bins", lambda b: b["bin"] > F.col("bin")), F.lit(0).cast("long"), lambda a, b: a + b["n"])
    chosen = reached.select("row", "bin", better.alias("better"))
    step = F.greatest(F.col("bits") - BIN_BITS, F.lit(0))
    return queries.join(chosen, "row").select(
        "row", "vec_id", "vec", "dim",
        (F.col("low") + F.expr(f"shiftleft(cast(bin as bigint), greatest(bits - {BIN_BITS}, 0))")).alias("low"),
        step.alias("bits"), (F.col("above") + F.col("better")).alias("above"))


def search(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for every row where ``is_query`` (over vec_id) holds."""
    candidates = whole_vectors(df, id_col, vec_col, scale)
    # no score of a query is beyond the sum of its absolute components times the largest of any vector
    largest = candidates.select("dim", F.array_max(F.transform("vec", lambda c: F.abs(c.cast("double")))).alias("m"))
    most = largest.groupBy("dim").agg(F.max("m").alias("m"))
    total = F.aggregate("vec", F.lit(0.0), lambda a, c: a + F.abs(c.cast("double")))
    reach = total * F.coalesce("m", F.lit(0.0)) * (1 + 1e-9) + 2
    reach = F.when(reach < float(WIDE), reach).otherwise(F.lit(float(MOST_KEY)))
    bits = (F.ceil(F.log2(reach)) + 1).cast("int")
    asked = candidates.where(is_query).join(most, "dim").withColumn("bits", bits)
    queries = stored(asked.select(
        "row", "vec_id", "vec", "dim", F.expr("-shiftleft(1L, bits - 1)").alias("low"), "bits",
        F.lit(0).cast("long").alias("above")), "queries")
    n_q, n_c = blocks_for(queries.count(), QUERY_BLOCK), blocks_for(candidates.count(), CANDIDATE_BLOCK)
    passes = math.ceil((queries.agg(F.max("bits")).first()[0] or 0) / BIN_BITS)
    for _ in range(passes):
        tiles = _tiles(queries, candidates.drop("vec_id"), n_q, n_c)
        counts = tiles.applyInPandas(_histogram(k), "row long, bin int, n long").groupBy("row", "bin").agg(
            F.sum("n").alias("n"))
        queries = stored(_refined(queries, counts, k), "queries")
    best = _tiles(queries, candidates, n_q, n_c).applyInPandas(_best(k), BEST)
    ranked = W.partitionBy("query_row").orderBy(
        F.desc("key"), F.desc("detail"), F.asc_nulls_last("vec_id"), "row")
    return best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


SQL = """
WITH v AS (
    SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vec FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.vec, c.vec)]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 20 = 0),
r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""
