from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from salestream.llm import simhash
from tests.llm.conftest import prose, rows_of


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """The least member of each one's component, linked at 4 bits or fewer."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    a = np.array(prints, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def test_fingerprints():
    texts = ["", None, " \n\t", "One two", "one TWO three four five", "É é x y z", prose(1, 3000), "a a a a a a", "\x1c b"]
    for text in texts:
        assert simhash.fingerprint((text or "").encode()) == brute_print(text)


def test_near_copies_of_documents(docs_of):
    pick = random.Random(3)
    rows = []
    for n in range(12):
        words = prose(n, 300).split()
        for _ in range(6):
            copy = list(words)
            copy[pick.randrange(len(copy))] = "changed"
            rows.append((len(rows) + 10, " ".join(copy)))
    rows += [(1, None), (2, ""), (3, "\n"), (None, ""), (4, "short"), (5, "short"), (5, "short")]
    prints = [brute_print(t) for _, t in rows]
    parts = brute_components(prints)
    least = {}
    for (doc_id, _), p in zip(rows, parts, strict=True):
        if doc_id is not None:
            least[p] = min(doc_id, least.get(p, doc_id))
    want = sorted(((d, least.get(p)) for (d, _), p in zip(rows, parts, strict=True)), key=repr)
    assert rows_of(simhash.near_duplicates(docs_of(*rows)), "doc_id", "component_id") == want
    one = simhash.one_of_each(docs_of(*rows))
    assert rows_of(one, "doc_id") == sorted(((v,) for v in least.values()), key=repr)
    assert one.columns == docs_of((1, "a")).columns


def test_chains_and_dense_groups_of_fingerprints(spark):
    pick = random.Random(5)
    prints = [pick.getrandbits(64) for _ in range(300)]
    for start in prints[:5]:  # chains of four bits each, and clouds around one print
        at = start
        for _ in range(8):
            at ^= sum(1 << b for b in pick.sample(range(64), 4))
            prints.append(at)
        prints += [start ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(1, 5))) for _ in range(40)]
    prints += [start ^ sum(1 << b for b in pick.sample(range(64), 5)) for start in prints[5:40]]  # just too far
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.clusters(spark.createDataFrame([(p,) for p in signed], "fp long"))
    got = {r["fp"]: r["root"] for r in found.collect()}
    parts = brute_components(prints)
    groups = lambda labels: sorted(
        sorted(s for s, x in zip(signed, labels, strict=True) if x == label) for label in set(labels))
    assert groups([got[s] for s in signed]) == groups(parts)


def test_linked_prints_share_a_variant(spark):
    pick = random.Random(7)
    pairs = [(p := pick.getrandbits(64), p ^ sum(1 << b for b in pick.sample(range(64), 4))) for _ in range(200)]
    sign = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(n, sign(p)) for n, pair in enumerate(pairs) for p in pair], "n int, fp long")
    shared = simhash._variants(df).groupBy("n", "at", "sig").count().where("count = 2")
    assert shared.select("n").distinct().count() == 200
    assert simhash._variants(df.limit(3)).count() == 3 * 64


def test_empty_table(docs_of):
    docs = docs_of((1, "a")).where(F.lit(False))
    assert rows_of(simhash.near_duplicates(docs)) == [] and rows_of(simhash.one_of_each(docs)) == []
