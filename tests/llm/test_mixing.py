from __future__ import annotations

import math
from collections import Counter

import pytest

from salestream.llm import mixing
from tests.llm.conftest import prose, rows_of


def corpus():
    rows = [(i, prose(i, 5 + i % 40), "big") for i in range(240)]
    rows += [(1000 + i, prose(i, 5 + i % 30), "mid") for i in range(80)]
    rows += [(2000 + i, prose(i, 10 + i % 20), None) for i in range(30)]
    rows += [(3000 + i, "" if i % 2 else None, "void") for i in range(4)]
    return rows


def tokens(rows):
    out = Counter()
    for _, text, source in rows:
        out[source] += len((text or "").split())
    return out


def weights(rows, a):
    n = {s: t for s, t in tokens(rows).items() if t}
    power = {s: (t / sum(n.values())) ** a for s, t in n.items()}
    return {s: p / sum(power.values()) for s, p in power.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values())


def solve(rows, enough):
    low, high = 0.0, 8.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if enough(weights(rows, mid)) else (mid, high)
    return high


def used(found):
    return Counter((r["doc_id"], r["source"]) for r in found.collect())


@pytest.mark.parametrize("block_rows", [16, 10_000])
def test_budgets_are_met_by_source(docs_of, block_rows):
    rows = corpus()
    total = sum(tokens(rows).values())
    found = mixing.mixture(docs_of(*rows), budget="all", target_entropy=0.9, most_repeats=6.0, block_rows=block_rows)
    a = solve(rows, lambda w: entropy(w) <= 0.9 * math.log(3))
    copies, got = used(found), Counter()
    size = {(i, s): len((t or "").split()) for i, t, s in rows}
    for doc, n in copies.items():
        got[doc[1]] += n * size[doc]
    for source, w in weights(rows, a).items():
        assert got[source] <= total * w + 1 and got[source] > total * w - max(size.values()) - 1
        each = [copies[doc] for doc in size if doc[1] == source]
        assert max(each) - min(each) <= 1  # full passes, and one partial pass
    assert [copies[(i, "void")] for i in range(3000, 3004)] == [1] * 4


def test_the_repetition_limit_is_hard(docs_of):
    rows = corpus()
    docs = docs_of(*rows)
    copies = used(mixing.mixture(docs, budget="all", target_entropy=1.0, most_repeats=2.0, block_rows=16))
    n = tokens(rows)
    a = solve(rows, lambda w: max(sum(n.values()) * w[s] / n[s] for s in w) <= 2.0)
    assert a > 0 and max(copies.values()) == 2
    with pytest.raises(ValueError, match="limit"):
        mixing.mixture(docs, budget=10.0 * sum(n.values()), most_repeats=2.0)


def test_every_document_is_used_without_a_budget(docs_of):
    rows = corpus()
    docs = docs_of(*rows)
    found = mixing.mixture(docs, budget=None, target_entropy=None, most_repeats=1.25, block_rows=16)
    copies = used(found)
    assert set(copies) == {(i, s) for i, _, s in rows} and max(copies.values()) == 2
    assert all(n == 1 for (_, s), n in copies.items() if s == "big")
    assert found.columns == [*docs.columns, "pass", "block", "block_key", "doc_key"]


def test_a_tiny_source_is_capped_alone(docs_of):
    rows = corpus() + [(4000, "only five words are here", "tiny")]
    n = {s: t for s, t in tokens(rows).items() if t}
    total = sum(n.values())

    def capped(a):
        most = max(n.values())
        return {s: min(4.0, (t / most) ** (a - 1)) for s, t in n.items()}

    def reached(a):
        w = {s: u * n[s] for s, u in capped(a).items()}
        return entropy({s: x / sum(w.values()) for s, x in w.items()})

    target = 0.7 * math.log(len(n))
    low, high = 0.0, 1.0
    assert reached(1.0) < target < reached(0.0)
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if reached(mid) <= target else (mid, high)
    copies = used(mixing.mixture(docs_of(*rows), budget=None, target_entropy=0.7, most_repeats=4.0, block_rows=16, cap_each=True))
    assert set(copies) == {(i, s) for i, _, s in rows} and copies[(4000, "tiny")] == 4
    got, size = Counter(), {(i, s): len((t or "").split()) for i, t, s in rows}
    for doc, times in copies.items():
        got[doc[1]] += times * size[doc]
    for source, uses in capped(high).items():
        assert abs(got[source] - uses * n[source]) <= max(size.values()) + 1e-4 * total
    # the middle sources are not held back by the tiny one, as they are by one ratio for all
    assert got["mid"] > 1.3 * n["mid"]
    even = mixing.mixture(docs_of(*rows), budget=None, target_entropy=0.3, most_repeats=4.0, cap_each=True)
    assert max(used(even).values()) == 1
    none = docs_of(*rows).limit(0)
    assert rows_of(mixing.mixture(none, budget=None, cap_each=True)) == []


def test_one_range_of_blocks(docs_of, monkeypatch):
    rows = corpus()
    want = rows_of(mixing.mixture(docs_of(*rows), block_rows=4), "doc_id", "pass", "block_key")
    for digits in (0, 1):
        monkeypatch.setattr(mixing, "RANGE_DIGITS", digits)
        assert rows_of(mixing.mixture(docs_of(*rows), block_rows=4), "doc_id", "pass", "block_key") == want


def test_passes_have_permutations_of_their_own(docs_of):
    rows = [(i, "one two three", "a") for i in range(60)] + [(100 + i, "one two three", "b") for i in range(6)]
    found = mixing.mixture(docs_of(*rows), budget="all", target_entropy=1.0, most_repeats=None, block_rows=8)
    order = {p: [r["doc_id"] for r in sorted(found.where(f"pass = {p} AND source = 'b'").collect(),
                                            key=lambda r: (r["block_key"], r["doc_key"]))] for p in (0, 1)}
    assert sorted(order[0]) == sorted(order[1]) == list(range(100, 106)) and order[0] != order[1]
    assert used(found) == used(mixing.mixture(
        docs_of(*rows), budget="all", target_entropy=1.0, most_repeats=None, block_rows=8))


def test_sources_beyond_the_broadcast_limit(docs_of, monkeypatch):
    rows = corpus()
    want = rows_of(mixing.mixture(docs_of(*rows), block_rows=16), "doc_id", "pass", "block_key")
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert rows_of(mixing.mixture(docs_of(*rows), block_rows=16), "doc_id", "pass", "block_key") == want


def test_edges(docs_of):
    docs = docs_of((1, None), (1, ""), (None, "a b", None), (None, "a b", None))
    assert len(rows_of(mixing.mixture(docs, most_repeats=None))) >= 2
    assert rows_of(mixing.mixture(docs.limit(0))) == []
    clash = docs.withColumnRenamed("key", "pass").withColumnRenamed("row", "block")
    assert mixing.mixture(clash).columns[-4:] == ["pass_", "block_", "block_key", "doc_key"]
