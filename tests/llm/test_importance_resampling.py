from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from salestream.llm import importance_resampling as ir
from tests.llm.conftest import prose, rows_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets_of(text):
    words = WORD.findall((text or "").translate(UPPER))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % 10_000 for r in runs)


def brute(docs, target, percent=5, least_words=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets_of(text)[1])
    for text in target:
        t.update(buckets_of(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        n_words, found = buckets_of(text)
        weight = sum(n * math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
                     for b, n in found.items())
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, sum(found.values()), weight, score, n_words >= least_words))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {r[:4]: i + 1 for i, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r[:4], rank.get(r[:4]) if r[4] else None) for r in out), key=repr)


def test_composed_checksums():
    pick = random.Random(3)
    for n in (0, 1, 5, 64, 65, 200, 5000):
        a, b = pick.randbytes(7), pick.randbytes(n)
        both = ir.advanced(np.array([zlib.crc32(a)], dtype=np.uint32), np.array([n]))[0] ^ zlib.crc32(b)
        assert int(both) == zlib.crc32(a + b)


def texts():
    pick = random.Random(5)
    rows = [(i, prose(i, pick.randrange(5, 90))) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(20)]
    rows += [(2000, None), (2001, ""), (2002, " .,; \n"), (None, prose(7, 30)), (2003, "Ünïcode wÖrds, ÀÉ " * 12)]
    rows += [(2004, " ".join("a" * 200 for _ in range(40))), (2005, prose(9, 30)), (2005, prose(9, 30)), (2006, prose(1, 9000))]
    return rows


@pytest.mark.parametrize("part", [1 << 20, 300])
def test_same_as_brute_force(spark, docs_of, monkeypatch, part):
    monkeypatch.setattr(ir, "PART_BYTES", part)  # the small one cuts texts into pieces
    target = [prose(10_000 + i, 50, 60) for i in range(12)] + [None, ""]
    counted = np.zeros(10_000, dtype=int)
    for _, _, at in ir.features([None if t is None else t.encode() for _, t in texts()]):
        counted += np.bincount(at, minlength=10_000)
    want = sum((buckets_of(t)[1] for _, t in texts()), Counter())
    assert {i: int(n) for i, n in enumerate(counted) if n} == dict(want)
    found = ir.resample(docs_of(*texts()), spark.createDataFrame([(t,) for t in target], "text string"))
    assert rows_of(found, "doc_id", "n_features", "weight", "score", "rank") == brute(texts(), target)


def test_many_ranges(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ir, "RANGE_ROWS", 7)
    rows = [(i, prose(i % 50, 25)) for i in range(600)]
    target = spark.createDataFrame([(prose(3, 40),)], "text string")
    found = ir.resample(docs_of(*rows), target, percent=50)
    assert rows_of(found, "doc_id", "n_features", "weight", "score", "rank") == brute(rows, [prose(3, 40)], 50)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "text string")
    assert rows_of(ir.resample(docs_of((1, "a")).limit(0), none)) == []
    found = ir.resample(docs_of((1, "a b"), (2, None)), none)
    assert rows_of(found, "doc_id", "n_features", "rank") == [(1, 3, None), (2, 0, None)]


def test_texts_like_the_target_are_drawn(spark, docs_of):
    rows = [(i, prose(i, 60) if i % 10 else f"{prose(5000 + i, 60, 40)} code python code") for i in range(400)]
    target = spark.createDataFrame([(prose(9000 + i, 60, 40),) for i in range(30)], "text string")
    drawn = ir.resample(docs_of(*rows), target).where("rank is not null")
    assert [r for r in rows_of(drawn, "doc_id") if r[0] % 10] == [] and drawn.count() == 20
