from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text[, source]) rows, with columns whose names operators might use."""
    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 7, True) for r in rows]
        return spark.createDataFrame(full, DOCS + ", row string, key int, kept boolean")

    return make


def prose(seed: int, n: int, words: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(words)}" for _ in range(n))


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
