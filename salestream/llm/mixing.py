"""Mixing sources to target weights by temperature (DataFrame functions only).

1. Tokens (words) are counted by source and block; a block is a slice of the ids' hashes, so a hot source has
   as many blocks as any and its rows combine before the shuffle.
2. A source's weight is its token share to the power of an exponent, normalised. The exponent is bisected until the
   weights' entropy meets the target, or the most repeated source meets the limit on repetition; of two
   exponents the larger holds (the limit is hard). Each job measures all midpoints of ``LEVELS`` levels of
   the bisection, over the table of sources, and returns a few numbers. With ``cap_each`` (without a budget) sources beyond the
   limit on repetition are held at it one by one, so that a tiny one does not set the exponent of all.
3. Weights become whole token budgets. A source is used in full passes, and in one partial pass that takes
   blocks in the order of that pass's permutation, and documents of the block where the budget ends
   in the order of its permutation. Only that block's documents are ranked; every other document
   is decided by comparing its hashes with its source's, without moving texts. The block where a budget ends is found
   on two levels, first among ranges of the permutation and then within one, so no task orders all blocks of a source.

The result sorted by (block_key, doc_key) is the mixture's order: blocks of all sources and passes permuted,
and documents permuted within them. No budget is exceeded; one falls short by less than a document.

Defined results: a null source is a source of its own. A null text has no tokens; a source without tokens is
used once. Rows that repeat an id have one place and are taken together. An empty table gives no rows.
Other columns are kept by ``mixture`` and clashing names do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salestream.llm.common import fits_broadcast, own_name, stored, table

SEED = "mix"
BLOCK_ROWS = 2_000
TARGET_ENTROPY = 0.95
MOST_REPEATS = 4.0
#: Exponents are sought from 0 (equal weights) to this.
MOST_EXPONENT = 8.0
LEVELS = 5
ROUNDS = 7
#: Exponents and weights are rounded, so that the order in which doubles were added does not matter.
EXPONENT_DIGITS = 6
WEIGHT_DIGITS = 9
#: Hex digits of a block's place that name its range of the permutation.
RANGE_DIGITS = 3
#: Up to so many sources their plan is broadcast; beyond, rows are joined with it by shuffle.
BROADCAST_SOURCES = 10_000


def tokens_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _source_key(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("-"))


def _hash(*parts) -> Column:
    """Hex digest of the parts joined by ``:``; a null part is ``-``."""
    texts = [F.coalesce((F.lit(p) if isinstance(p, str) else p).cast("string"), F.lit("-")) for p in parts]
    return F.md5(F.concat_ws(":", *texts).cast("binary"))


def block_digits(n_rows: int, block_rows: int = BLOCK_ROWS) -> int:
    """Hex digits of the hash that name a block."""
    digits = 0
    while 16**digits * block_rows < n_rows:
        digits += 1
    return digits


def capped_uses(a: float, largest: float, cap: float) -> Column:
    """Uses of a source where the largest one is used once and none more than ``cap`` times; ``a`` is 1 at most."""
    return F.least(F.exp(F.lit(a - 1) * F.log(F.col("share") / F.lit(largest))), F.lit(cap))


def measure(sources: DataFrame, exponents: list[float], budget: float | None,
            capped: tuple[float, float] | None = None) -> list[tuple[float, float]]:
    """Entropy of the weights, and uses of the most repeated source, for each exponent.

    Without a budget, the least used source is used once. ``capped``: largest share, and most uses of each source.
    """
    columns = []
    for i, a in enumerate(exponents):
        power = F.exp(F.lit(a) * F.log("share"))
        log_power = a * F.log("share")
        if capped:
            power = capped_uses(a, *capped) * F.col("share")
            log_power = F.log(power)
        columns += [F.sum(power).alias(f"z{i}"), F.sum(power * log_power).alias(f"e{i}"),
                    F.max(power / F.col("tokens")).alias(f"most{i}"), F.min(power / F.col("tokens")).alias(f"least{i}")]
    row = sources.where("tokens > 0").agg(*columns).first()
    out = []
    for i in range(len(exponents)):
        z = row[f"z{i}"]
        uses = row[f"most{i}"] / row[f"least{i}"] if budget is None else budget * row[f"most{i}"] / z
        out.append((math.log(z) - row[f"e{i}"] / z, uses))
    return out


def bisect(sources: DataFrame, budget: float | None, low: float, high: float,
           enough: Callable[[float, float], bool], capped: tuple[float, float] | None = None) -> float:
    """The exponent at which ``enough`` (of entropy, uses) turns true, if it does between low and high."""
    parts = 1 << LEVELS
    for _ in range(ROUNDS):
        points = [low + (high - low) * i / parts for i in range(1, parts)]
        at, step = 0, parts // 2
        found = measure(sources, points, budget, capped)
        while step:  # the levels of the bisection, on measured midpoints
            if not enough(*found[at + step - 1]):
                at += step
            step //= 2
        low, high = low + (high - low) * at / parts, low + (high - low) * (at + 1) / parts
    return (low + high) / 2


def exponent(sources: DataFrame, budget: float | None, target_entropy: float | None, most_repeats: float | None) -> float:
    """``target_entropy`` is a share of the largest possible; see the module."""
    n = sources.where("tokens > 0").count()
    found = [0.0] if target_entropy is None and most_repeats is not None else []
    if n and target_entropy is not None:
        target = target_entropy * math.log(n)
        found.append(bisect(sources, budget, 0.0, MOST_EXPONENT, lambda entropy, _: entropy <= target) if n > 1 else 1.0)
    if n and most_repeats is not None:
        (_, equal), (_, natural) = measure(sources, [0.0, 1.0], budget)
        if natural > most_repeats * (1 + 1e-9):
            raise ValueError(f"the budget uses every token {natural:.3g} times, the limit is {most_repeats}")
        found.append(0.0 if equal <= most_repeats else bisect(
            sources, budget, 0.0, 1.0, lambda _, uses: uses <= most_repeats))
    return round(max(found, default=1.0), EXPONENT_DIGITS)


def capped_exponent(sources: DataFrame, target_entropy: float, capped: tuple[float, float]) -> float:
    """The largest exponent up to 1 whose capped weights meet the target, or 0 if none does."""
    target = target_entropy * math.log(max(1, sources.where("tokens > 0").count()))
    (natural, _), = measure(sources, [1.0], None, capped)
    if natural >= target - 1e-9:
        return 1.0
    return round(bisect(sources, None, 0.0, 1.0, lambda entropy, _: entropy <= target, capped), EXPONENT_DIGITS)


def weighted(sources: DataFrame, a: float, budget: float | None, capped: tuple[float, float] | None = None) -> DataFrame:
    """source_key, tokens, weight, target, passes, rest (tokens of the partial pass)."""
    power = F.exp(F.lit(a) * F.log("share"))
    total, least = sources.where("tokens > 0").agg(F.sum(power), F.min(power / F.col("tokens"))).first()
    weight = F.when(F.col("tokens") > 0, F.round(power / F.lit(total or 1.0), WEIGHT_DIGITS)).otherwise(0.0)
    if budget is None:
        uses = capped_uses(a, *capped) if capped else power / F.col("tokens") / F.lit(least or 1.0)
        uses = F.round(uses, WEIGHT_DIGITS)
        if capped:
            reached = sources.where("tokens > 0").agg(F.sum(uses * F.col("tokens"))).first()[0]
            weight = F.when(F.col("tokens") > 0, F.round(uses * F.col("tokens") / F.lit(reached or 1.0), WEIGHT_DIGITS)).otherwise(0.0)
        target = F.floor(F.col("tokens") * F.greatest(uses, F.lit(1.0)))
    else:
        target = F.floor(F.lit(float(budget)) * F.col("weight"))
    some = F.col("tokens") > 0
    return (
        sources.withColumn("weight", weight)
        .withColumn("target", F.when(some, target).otherwise(0).cast("long"))
        .withColumn("passes", F.when(some, F.expr("target div tokens")).otherwise(1).cast("long"))
        .withColumn("rest", F.when(some, F.expr("target % tokens")).otherwise(0).cast("long"))
    )


def _placed(df: DataFrame, id_col: str, source_col: str, digits: int, seed: str) -> DataFrame:
    """``df`` with source_key and block, under names that it does not have."""
    skey, block = own_name(df, "source_key"), own_name(df, "block")
    return df.withColumn(skey, _source_key(source_col)).withColumn(
        block, F.substring(_hash(seed, F.col(id_col)), 1, digits) if digits else F.lit(""))


def plan(df: DataFrame, id_col: str, source_col: str, text_col: str, budget: float | None, target_entropy: float | None,
         most_repeats: float | None, block_rows: int, seed: str, cap_each: bool = False) -> tuple[DataFrame, int]:
    """The plan by source (weights, and where the partial pass ends), and the digits of block names."""
    slim = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    digits = block_digits(slim.count(), block_rows)
    rows = _placed(slim, "doc_id", "source", digits, seed)
    blocks = stored(
        rows.groupBy("source_key", "block").agg(F.sum(tokens_of(F.col("text"))).alias("tokens")), "mix-blocks")
    sources = blocks.groupBy("source_key").agg(F.sum("tokens").alias("tokens"))
    total = blocks.agg(F.sum("tokens")).first()[0] or 0
    sources = stored(sources.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1)))), "mix-sources")
    used = total if budget == "all" else budget
    if cap_each:
        if used is not None or target_entropy is None or most_repeats is None:
            raise ValueError("cap_each takes a target entropy and a limit on repetition, and no budget")
        largest = sources.where("tokens > 0").agg(F.max("share")).first()[0]
        capped = None if largest is None else (largest, float(most_repeats))
        a = capped_exponent(sources, target_entropy, capped) if capped else 1.0
    else:
        capped, a = None, exponent(sources, used, target_entropy, most_repeats)
    weights = stored(weighted(sources, a, used, capped), "mix-weights")
    border = _hash(seed, F.col("passes"), F.col("source_key"), F.col("block"))
    placed = (
        blocks.join(weights.where("rest > 0").drop("tokens", "share", "weight", "target"), "source_key")
        .withColumn("border", border)
        .withColumn("range", F.substring("border", 1, RANGE_DIGITS)))
    range_ends = (
        placed.groupBy("source_key", "range").agg(F.sum("tokens").alias("held"), F.first("rest").alias("rest"))
        .withColumn("before", F.sum("held").over(W.partitionBy("source_key").orderBy("range")) - F.col("held"))
        .where("before <= rest AND rest < before + held")
        .select("source_key", "range", "before"))
    within = W.partitionBy("source_key").orderBy("border")
    ends = stored(
        placed.join(range_ends, ["source_key", "range"])
        .withColumn("upto", F.col("before") + F.sum("tokens").over(within))
        .where("upto - tokens <= rest AND rest < upto")
        .select("source_key", "block", "passes", "border", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("room")),
        "mix-ends")
    few = F.broadcast(ends) if fits_broadcast(ends, BROADCAST_SOURCES) else ends
    ordered = W.partitionBy("source_key").orderBy("doc_key")
    cuts = (
        rows.join(few, ["source_key", "block"])
        .groupBy("source_key", _hash(seed, F.col("passes"), F.col("doc_id")).alias("doc_key"))
        .agg(F.sum(tokens_of(F.col("text"))).alias("tokens"), F.first("room").alias("room"))
        .withColumn("upto", F.sum("tokens").over(ordered))
        .groupBy("source_key").agg(F.max(F.when(F.col("upto") <= F.col("room"), F.col("doc_key"))).alias("last_key"))
    )
    whole = ends.select("source_key", F.col("border").alias("end_border")).join(cuts, "source_key", "left")
    return stored(weights.join(whole, "source_key", "left"), "mix-plan"), digits


def mixture(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
            budget: float | str | None = "all", target_entropy: float | None = TARGET_ENTROPY,
            most_repeats: float | None = MOST_REPEATS, block_rows: int = BLOCK_ROWS, seed: str = SEED,
            cap_each: bool = False) -> DataFrame:
    """The rows of ``df``, each as often as the mixture uses it, with pass (from 0), block, block_key, doc_key.

    ``budget``: tokens of the mixture; "all": as many as there are; None: as few as use every source in full.
    ``cap_each``: without a budget, hold each source at ``most_repeats`` uses by itself; see the module.
    The added columns get another name (with ``_`` added) where ``df`` has such columns.
    """
    spread, digits = plan(
        df, id_col, source_col, text_col, budget, target_entropy, most_repeats, block_rows, seed, cap_each)
    rows = _placed(df, id_col, source_col, digits, seed)
    skey, block = rows.columns[-2:]
    names = {c: own_name(rows, f"mix_{c}") for c in ("source_key", "passes", "end_border", "last_key")}
    spread = spread.select(*[F.col(c).alias(n) for c, n in names.items()])
    few = F.broadcast(spread) if fits_broadcast(spread, BROADCAST_SOURCES) else spread
    passes, end, last = (F.col(names[c]) for c in ("passes", "end_border", "last_key"))
    border = _hash(seed, passes, F.col(skey), F.col(block))
    partial = (border < end) | ((border == end) & (_hash(seed, passes, F.col(id_col)) <= last))
    copies = passes + F.coalesce(partial.cast("int"), F.lit(0))
    out_pass, out_block, block_key, doc_key = (own_name(df, c) for c in ("pass", "block", "block_key", "doc_key"))
    every = F.explode(F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1)))
    used = rows.join(few, F.col(skey) == F.col(names["source_key"])).withColumn(own_name(rows, "mix_pass"), every)
    at = F.col(used.columns[-1])
    return used.select(
        *df.columns, at.alias(out_pass), F.col(block).alias(out_block),
        _hash(seed, at, F.col(skey), F.col(block)).alias(block_key), _hash(seed, at, F.col(id_col)).alias(doc_key))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixture(documents).select("doc_id", "source", "pass", "block", "block_key", "doc_key")


SQL = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, coalesce('=' || source, '-') AS k, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS h,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents),
z AS (SELECT CAST(ceil(greatest(0, ln(count(*) / {BLOCK_ROWS}.0) / ln(16))) AS INTEGER) AS digits FROM d),
b AS (SELECT *, substr(h, 1, (SELECT digits FROM z)) AS block FROM d),
s AS (SELECT k, sum(tokens) AS tokens FROM d GROUP BY k),
p AS (SELECT k, tokens, tokens / sum(tokens) OVER () AS share, sum(tokens) OVER () AS budget FROM s),
ps AS (SELECT list(share) AS shares, list(tokens) AS ts, count(*) AS n, max(budget) AS budget FROM p WHERE tokens > 0),
e(i, lo, hi) AS (
    SELECT 0, 0.0::DOUBLE, {MOST_EXPONENT}::DOUBLE
    UNION ALL
    SELECT i + 1, CASE WHEN entropy <= {TARGET_ENTROPY} * ln(n) THEN lo ELSE mid END,
           CASE WHEN entropy <= {TARGET_ENTROPY} * ln(n) THEN mid ELSE hi END
    FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, n,
                 list_sum([exp((lo + hi) / 2 * ln(x)) FOR x IN shares]) AS zz,
                 list_sum([exp((lo + hi) / 2 * ln(x)) * (lo + hi) / 2 * ln(x) FOR x IN shares]) AS ee,
                 ln(zz) - ee / zz AS entropy
          FROM e, ps WHERE i < {LEVELS * ROUNDS})),
r(i, lo, hi) AS (
    SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
    UNION ALL
    SELECT i + 1, CASE WHEN uses <= {MOST_REPEATS} THEN lo ELSE mid END, CASE WHEN uses <= {MOST_REPEATS} THEN mid ELSE hi END
    FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid,
                 budget * list_max([exp((lo + hi) / 2 * ln(x[1])) / x[2] FOR x IN list_zip(shares, ts)])
                 / list_sum([exp((lo + hi) / 2 * ln(x)) FOR x IN shares]) AS uses
          FROM r, ps WHERE i < {LEVELS * ROUNDS})),
a AS (SELECT round(greatest(
        (SELECT (lo + hi) / 2 FROM e WHERE i = {LEVELS * ROUNDS}),
        CASE WHEN (SELECT budget * list_max([1.0 / x FOR x IN ts]) / n FROM ps) <= {MOST_REPEATS} THEN 0
             ELSE (SELECT (lo + hi) / 2 FROM r WHERE i = {LEVELS * ROUNDS}) END), {EXPONENT_DIGITS}) AS a),
w AS (
    SELECT k, tokens, CAST(floor(CAST(budget AS DOUBLE) * round(exp(a * ln(share)) / sum(exp(a * ln(share))) OVER (), {WEIGHT_DIGITS}))
        AS BIGINT) AS target
    FROM p, a WHERE tokens > 0),
t AS (SELECT k, target // tokens AS passes, target % tokens AS rest FROM w
      UNION ALL SELECT k, 1, 0 FROM s WHERE tokens = 0),
bt AS (SELECT k, block, sum(tokens) AS tokens FROM b GROUP BY k, block),
bo AS (
    SELECT k, block, tokens, rest, sum(tokens) OVER (PARTITION BY k ORDER BY md5(concat_ws(':', 'mix', passes, k, block))) AS upto
    FROM bt JOIN t USING (k)),
x AS (
    SELECT b.doc_id, b.source, b.k, b.block, passes,
           CASE WHEN upto <= t.rest THEN 1
                WHEN upto - bo.tokens <= t.rest THEN CAST(sum(b.tokens) OVER (
                    PARTITION BY b.k, b.block ORDER BY md5('mix:' || passes || ':' || coalesce(CAST(doc_id AS VARCHAR), '-')))
                    <= t.rest - (upto - bo.tokens) AS INTEGER)
                ELSE 0 END * CAST(t.rest > 0 AS INTEGER) AS more
    FROM b JOIN t USING (k) JOIN bo ON b.k = bo.k AND b.block = bo.block),
y AS (SELECT *, unnest(range(CAST(passes + more AS BIGINT))) AS pass FROM x)
SELECT doc_id, source, pass, block, md5('mix:' || pass || ':' || k || ':' || block) AS block_key,
       md5('mix:' || pass || ':' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS doc_key
FROM y
"""
