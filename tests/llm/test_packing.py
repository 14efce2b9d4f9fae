from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from salestream.llm import packing
from tests.llm.conftest import prose, rows_of

TOKENIZER = packing.default_tokenizer()
ODD = [
    "", " \n\t", "Hello, World's end! don't we'll 'tis", "É ß ẞ İ ſ ΑΣ Σ", "é é ẛ̣", "a​b\x1cc\x85d\xa0e",
    "x<|endoftext|>y <|startoftext|>", "12 3.14 a1b2 <|x |", "日本語 テキスト", "🙂 👩‍👩‍👧", "a" * 3000, "--- *** ((nested))", "'", "<|", "A'B",
    "Ünï-cödé…word", "tab\there\r\nnew", "ALL CAPS, Mixed Case;",
]


def reference(text):
    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids


def test_encoder_gives_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_KEPT", 50)  # memory starts anew again and again
    encoder = packing.WordEncoder(TOKENIZER)
    pick = random.Random(1)
    texts = ODD + ["".join(chr(pick.choice([*range(32, 127), *range(0xC0, 0x180), 10, 0x301, 0x3a3])) for _ in range(200))
                   for _ in range(60)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == reference(text)


def test_plans_hold_exactly_what_is_there():
    pick = np.random.default_rng(1)
    for units in (8, 64):
        for counts in (np.zeros(units, int), pick.integers(0, 4, units), pick.integers(0, 1000, units), np.eye(1, units, units - 1, dtype=int)[0]):
            chosen = packing.plan(counts, units)
            assert sum((p * n for p, n in chosen), np.zeros(units, int)).tolist() == counts.tolist()
            assert all((p * (np.arange(units) + 1)).sum() <= units for p, _ in chosen)
            optimum = sum(amount for _, amount in packing.solve(counts, units)) if counts.any() else 0
            assert sum(n for _, n in chosen) <= optimum * 1.001 + units / 2 + 1


def test_the_linear_program_finds_the_optimum():
    counts = np.zeros(10, dtype=int)
    counts[[5, 3]] = 100  # lengths 6 and 4 of 10: pairs
    assert sum(a for _, a in packing.solve(counts, 10)) == pytest.approx(100)


@pytest.mark.parametrize("blocks", [20_000, 7])
def test_pieces_and_sequences(docs_of, monkeypatch, blocks):
    monkeypatch.setattr(packing, "ROWS_PER_BLOCK", blocks)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, prose(i, 1 + 37 * i)) for i in range(60)]
    rows += [(500, "same"), (500, "same"), (None, None), (501, prose(9, 9000)), *((600 + i, "hot") for i in range(80))]
    found = packing.pack(docs_of(*rows), TOKENIZER, capacity=1024, width=8).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert r["length"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        pieces[r["doc_row"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    got = []
    for parts in pieces.values():
        parts.sort(key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in parts), "<u4").tolist()
        assert [r["start"] for r in parts] == np.cumsum([0, *(r["length"] for r in parts[:-1])]).tolist()
        assert {r["doc_tokens"] for r in parts} == {len(ids)}
        got.append((parts[0]["doc_id"], ids))
    assert sorted(got, key=repr) == sorted(((i, [*reference(t), 2]) for i, t in rows), key=repr)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(len(ids) for _, ids in got)
    assert len(sequences) <= total / 1024 * 1.1 + 8


def test_empty_table(docs_of):
    assert rows_of(packing.pack(docs_of((1, "a")).limit(0), TOKENIZER).select(*packing.DIGEST)) == []
