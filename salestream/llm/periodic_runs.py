"""Runs of words that repeat with a period, found by seeds and extension along diagonals.

A run is a longest stretch of words with smallest period q (words q apart are equal) of at least ``max(6, 4 q)`` words. It
matches itself, moved by q, over at least 3 q words (5 if q is 1).

1. Lags are taken in classes: 1; 2 and 3; 4 to 7; and so on, each twice as far. The minimum overlap that a class
   guarantees, k, is 5 for lag 1 and 3 times the least lag otherwise; all k-grams of a document are indexed by exact
   names, a gram of twice the length by the names of its halves.
2. A pair of neighbouring occurrences of a k-gram in one document is a seed if its lag is in the class. Neighbours are enough: k is
   at least the period, so an occurrence nearer than the period would give the run a smaller one. That also makes
   the lag of every seed in a run its smallest period, and keeps the number of pairs linear.
3. A seed is extended along its diagonal, both ways, until words differ. A table of the furthest place covered at each lag
   suppresses further seeds of the same stretch.

Only grams that occur again go on to the next class, so texts without repeats end after the first. A batch of documents
is searched at once; names hold the document, so that no gram or pair leaves it.

Defined results: null and empty texts have no words and no runs. Texts of any length are searched whole. Rows that repeat an
id have a result each; null ids are kept. Other columns are not used. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestream.llm.common import SPACE, table

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
#: Words searched at once, unless one text alone has more.
BATCH_WORDS = 200_000

Run = tuple[int, int, int]


def _named(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Names of the grams at places ``at``; -1 where a gram occurs once or there is none."""
    out = np.full(n, -1, dtype=np.int64)
    _, names, counts = np.unique(codes, return_inverse=True, return_counts=True)
    again = counts[names] > 1
    out[at[again]] = names[again]
    return out


def _joined(left: np.ndarray, right: np.ndarray, gap: int) -> np.ndarray:
    """Names of the grams that are ``left`` at a place and ``right`` ``gap`` words further."""
    n = len(left)
    at = np.flatnonzero(left[:max(0, n - gap)] >= 0)
    at = at[right[at + gap] >= 0]
    return _named(left[at] * np.int64(n + 1) + right[at + gap], at, n)


def _seeds(names: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of neighbouring occurrences, by lag and place; the first of each unbroken row of places."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    lag = at[1:] - at[:-1]
    hit = (names[at[1:]] == names[at[:-1]]) & (lag >= least) & (lag <= most)
    place, lag = at[:-1][hit], lag[hit]
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    fresh = np.ones(len(place), dtype=bool)
    fresh[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
    return place[fresh], lag[fresh]


def _matches(words: np.ndarray, i: int, j: int, most: int, step: int) -> int:
    """How many words from i and j on, in direction ``step``, are equal, up to ``most``."""
    done, size = 0, 16
    while done < most:
        size = min(size, most - done)
        a, b = i + step * done, j + step * done
        one, two = (words[a:a + size], words[b:b + size]) if step > 0 else (
            words[a - size + 1:a + 1][::-1], words[b - size + 1:b + 1][::-1])
        unequal = np.flatnonzero(one != two)
        if len(unequal):
            return done + int(unequal[0])
        done, size = done + size, size * 2
    return done


def find_runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """For each list of words its runs (start, length, period), by start and period."""
    number: dict[bytes, int] = {}
    words = np.array([number.setdefault(w, len(number)) for ws in texts for w in ws], dtype=np.int64)
    lengths = np.array([len(ws) for ws in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(texts)), lengths)
    n = len(words)
    found: list[list[Run]] = [[] for _ in texts]

    def extend(names: np.ndarray, k: int, least: int, most: int) -> None:
        covered: dict[int, int] = {}
        for place, lag in zip(*(x.tolist() for x in _seeds(names, least, most)), strict=True):
            if place < covered.get(lag, -1):
                continue
            d = int(doc[place])
            low, high = int(ends[d] - lengths[d]), int(ends[d])
            start = place - _matches(words, place - 1, place - 1 + lag, place - low, -1)
            stop = place + k + _matches(words, place + k, place + k + lag, high - lag - place - k, 1)
            covered[lag] = stop
            length = stop - start + lag
            if length >= max(LEAST_LENGTH, LEAST_EXPONENT * lag):
                found[d].append((start - low, length, lag))

    single = _named(doc * np.int64(len(number) + 1) + words, np.arange(n), n)
    two = _joined(single, single, 1)
    four = _joined(two, two, 2)
    names, k = _joined(four, single, 4), LEAST_LENGTH - 1
    extend(names, k, 1, 1)
    names, k, least = _joined(names, single, k), LEAST_LENGTH, 2
    while (names >= 0).any():
        extend(names, k, least, 2 * least - 1)
        names, k, least = _joined(names, names, k), 2 * k, 2 * least
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def greatest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period, exactly; ties to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that are in no run after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


_RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
           "collapsed_sha256 string, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2 + [_RUN, pa.string()]
_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs",
          "collapsed"]


def _row(doc_id: int | None, words: list[bytes], runs: list[Run]) -> tuple:
    best = greatest(runs) or (None, None, None)
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    collapsed = b" ".join(kept_words(words, runs))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest(),
            [dict(zip(("start", "length", "period"), run, strict=True)) for run in runs],
            collapsed.decode("utf-8", "replace"))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        rows = [_row(*x) for x in zip(ids, texts, find_runs(texts), strict=True)]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)

    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(doc_id)
            texts.append((text.as_py() or b"").split())
            size += len(texts[-1])
            if size >= BATCH_WORDS:
                yield done(ids, texts)
                ids, texts, size = [], [], 0
        if ids:
            yield done(ids, texts)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the greatest run, digests, all runs, and the collapsed text.

    The collapsed text has the first period of each run and all words outside of runs, joined by one space.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(_search, _RESULT)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; in about a tenth of the documents the words from some place on repeat, as fixed by the id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = F.expr(rf"""
        CASE WHEN h % 10 = 0 AND size(words) > 0 THEN
          array_join(transform(sequence(0, size(words) - 1), i -> words[cast(CASE WHEN i < a THEN i ELSE a + (i - a) % p END AS int)]), ' ')
        ELSE text END""")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), f"{SPACE}+"), lambda w: w != "")
    return (
        docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
        .withColumn("g", F.expr("h div 10"))
        .withColumn("a", F.expr("g % nullif(size(words), 0)"))
        .withColumn("p", F.expr("1 + (size(words) - a) div (3 + g % 8)"))
        .select("doc_id", planted.alias("text"))
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_repeats(table(spark, sf_dir, "documents")))
    return found.select(*_NAMES[:8])
