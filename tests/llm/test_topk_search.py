from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from salestream.llm import topk_search
from tests.llm.conftest import rows_of

SCHEMA = "vec_id long, embedding array<double>, label int, row int, score int"


def brute(rows, k, every=20):
    usable = [(n, i, [math.floor(64 * x) for x in v]) for n, (i, v) in enumerate(rows)
              if v is not None and all(x is not None and math.isfinite(64 * x) for x in v)]
    out = []
    for n, i, v in usable:
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j or 0, m)
                  for m, j, w in usable if m != n and len(w) == len(v)]
        out += [(i, rank, None if none else j, max(-2**63, min(2**63 - 1, -s))) for rank, (s, none, j, _) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def check(spark, rows, k=20):
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)
    found = topk_search.search(df, F.col("vec_id") % 20 == 0, k=k)
    assert rows_of(found, "query_id", "rank", "vec_id", "score") == brute(rows, k)


def test_ties_nulls_odd_vectors_and_repeated_rows(spark):
    pick = random.Random(1)
    rows = [(i, [pick.choice([0.0, 1.0, -1.0]) for _ in range(3)]) for i in range(90)]
    rows += [(20, [1.0, 1.0, 1.0])] * 2 + [
        (None, [1.0, 1.0, 1.0]), (40, None), (40, [None, 1.0, 1.0]), (40, [math.nan, 1.0, 1.0]), (60, [math.inf]),
        (60, [1.0]), (80, []), (100, [1e30, 1e30, 1e30]), (101, [1e30, -1e30, 0.5])]
    check(spark, rows, 7)


@pytest.mark.parametrize("k", [1, 30])
def test_blocks_and_few_candidates(spark, monkeypatch, k):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", 9)
    pick = random.Random(2)
    check(spark, [(i, [pick.gauss(0, 1) for _ in range(8)]) for i in range(25)], k)
    check(spark, [(20, [1.0]), (21, [2.0])], k)


def test_one_common_vector(spark):
    check(spark, [(i, [0.5, 0.25]) for i in range(100)], 5)


def test_empty_table(spark):
    check(spark, [])


@pytest.mark.parametrize("size", [2.0**24, 2.0**26, 1e30, 1e300])
def test_scores_beyond_a_long_are_ranked_exactly(spark, monkeypatch, size):
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", 15)
    pick = random.Random(3)
    # many scores agree in all their leading bits and differ in the last ones, on both sides of zero
    rows = [(i, [pick.choice([size, -size]), pick.choice([size, 0.0]), pick.randrange(3) / 64, pick.choice([1.0, -1.0])])
            for i in range(60)]
    rows += [(20, rows[20][1]), (70, [1.7e308, 0.0, 0.0, 0.0]), (71, [1e-3, 0.5, 3.0, 1.0])]
    check(spark, rows, 9)
