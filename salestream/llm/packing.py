"""Packing documents into training sequences: cutting stock by column generation.

1. One pass tokenizes every whole text, appends the end id, and cuts what is longer than a sequence into
   full sequences and a remainder. Pieces, with their ids, are stored once; all later steps read lengths only.
2. Lengths are rounded up to multiples of ``WIDTH`` for the plan; their histogram has at most
   ``CAPACITY / WIDTH`` entries, whatever the input, and is all that the driver gets.
3. A linear program over patterns (how many pieces of each length class fill one sequence) is solved by
   column generation: a knapsack dynamic program prices new patterns with the dual values.
4. Pattern counts are rounded down; the few pieces left over are planned first-fit decreasing.
5. Pieces are ranked within their class (ranks of blocks plus ranks in a block, so a hot class is not one
   task) and patterns take ranges of ranks: a broadcast of the plan, whose size is bounded by the classes.
   True lengths then give gapless offsets.

Sequences are padded to the capacity, except those whose length is a power of two.

Defined results: a null or empty text is one piece with the end id alone. Every row is a document of its
own, so rows that repeat an id are packed each. An empty table gives no rows. Texts equal to special tokens'
strings get those tokens' ids, as the tokenizer does by itself. Other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salestream.llm.common import blocks_for, in_parts, stored, table

CAPACITY = 4096
WIDTH = 8
END_ID = 2
#: Distinct words, and parts of words, kept encoded in a worker; beyond that the memory starts anew.
WORDS_KEPT = 150_000
ROWS_PER_BLOCK = 20_000
#: The linear program stops within this share of its optimum.
GAP = 0.0003

PIECES = "doc_id long, doc_row long, start long, length long, doc_tokens long, ids binary"


#: Letters whose lower case and composed form are one letter each.
_LETTERS = r"A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF"
#: What the tokenizer splits by these rules alone: no apostrophes (contractions), no special tokens.
_PLAIN = re.compile(rf"(?!.*<\|)[{_LETTERS}!-&(-@\[-`{{-~]+")
_PARTS = re.compile(rf"[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")


class _Parts(dict):
    """Ids of a run of letters, a digit or a run of marks."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        # the printable stand-ins of bytes in a byte-level vocabulary
        self.symbols = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in printable)}

    def __missing__(self, part: str) -> bytes:
        symbols = part if part.isascii() else part.encode().decode("latin-1").translate(self.symbols)
        ids = self[part] = array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()
        return ids


class _Words(dict):
    """Ids of what stands between white space."""

    def __init__(self, tokenizer, parts: _Parts):
        super().__init__()
        self.tokenizer = tokenizer
        self.parts = parts

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isascii() and text.isalpha():
            ids = self.parts[text.lower()]
        elif text[-1] in ".,;:!?" and text.isascii() and text[:-1].isalpha():
            ids = self.parts[text[:-1].lower()] + self.parts[text[-1]]
        elif _PLAIN.fullmatch(text):
            ids = b"".join(map(self.parts.__getitem__, _PARTS.findall(text.lower())))
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, exactly as the tokenizer gives them.

    The tokenizer drops white space and never merges across it, so what stands between ASCII white space is
    encoded by itself and remembered. Of plain words, the parts that the tokenizer splits and lower-cases are
    remembered too; anything else goes through the tokenizer whole.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        self.parts = _Parts(tokenizer.model)
        self.words = _Words(tokenizer, self.parts)

    def encode(self, text: bytes) -> bytes:
        for memory in (self.words, self.parts):
            if len(memory) > WORDS_KEPT:
                memory.clear()
        words = text.split()
        if len(words) <= WORDS_KEPT:
            return b"".join(map(self.words.__getitem__, words))
        parts = [words[at:at + WORDS_KEPT] for at in range(0, len(words), WORDS_KEPT)]
        return b"".join(self.encode(b" ".join(part)) for part in parts)


_encoders: dict[str, WordEncoder] = {}


def _encoder(tokenizer_path: str) -> WordEncoder:
    """One for each worker process: tasks that follow each other share what it remembers."""
    if tokenizer_path not in _encoders:
        _encoders[tokenizer_path] = WordEncoder(tokenizer_path)
    return _encoders[tokenizer_path]


def _cut(tokenizer_path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        end, step = np.array([end_id], dtype="<u4").tobytes(), 4 * capacity
        for batch in in_parts(batches):
            rows, size = [], 0
            for doc_id, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encoder.encode(text or b"") + end
                for at in range(0, len(ids), step):
                    piece = ids[at:at + step]
                    rows.append((doc_id, row, at // 4, len(piece) // 4, len(ids) // 4, piece))
                size += len(ids)
                if size > 4_000_000:
                    yield _batch(rows)
                    rows, size = [], 0
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("doc_id", pa.int64()), ("doc_row", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
             ("doc_tokens", pa.int64()), ("ids", pa.binary())]
    columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


def pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The cut documents, stored: doc_id, doc_row, start, length, doc_tokens, ids, ids_crc32."""
    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("doc_row"),
                     F.col(text_col).cast("binary").alias("text"))
    cut = slim.mapInArrow(_cut(tokenizer_path, capacity, end_id), PIECES)
    return stored(cut.withColumn("ids_crc32", F.crc32("ids")), "pieces")


def _best_pattern(values: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable classes (class k takes k + 1 units) that fit into ``units``."""
    best, choice = np.zeros(units + 1), np.zeros(units + 1, dtype=np.int64)
    for room in range(1, units + 1):
        # class k leaves room - k - 1
        gains = values[:room] + best[room - 1::-1][:room]
        k = int(gains.argmax())
        if gains[k] > best[room - 1]:
            best[room], choice[room] = gains[k], k + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(units, dtype=np.int64), units
    while room:
        if choice[room]:
            pattern[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return float(best[units]), pattern


def solve(counts: np.ndarray, units: int, most_rounds: int = 3000) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often to use each, covering ``counts`` (of class k, k + 1 units long) with the least sequences.

    Revised simplex on the classes that occur. Stops at the optimum or, with a feasible plan, after ``most_rounds``.
    """
    live = np.flatnonzero(counts)
    need = counts[live].astype(float)
    m = len(live)
    sizes = live + 1
    columns = np.zeros((m, m))
    np.fill_diagonal(columns, units // sizes)
    inverse = np.diag(1.0 / np.diag(columns))
    basis = columns.copy()
    amount = inverse @ need
    for _ in range(most_rounds):
        dual = inverse.sum(axis=0)
        values = np.zeros(units)
        values[live] = dual
        worth, pattern = _best_pattern(np.maximum(values, 0), units)
        if worth <= 1 + GAP:  # no plan is better than this one by more than that share
            break
        entering = pattern[live].astype(float)
        direction = inverse @ entering
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(direction > 1e-9, amount / direction, np.inf)
        leave = int(ratio.argmin())
        step = ratio[leave]
        amount = np.maximum(amount - step * direction, 0)
        amount[leave] = step
        basis[:, leave] = entering
        pivot = inverse[leave] / direction[leave]
        inverse = inverse - np.outer(direction, pivot)
        inverse[leave] = pivot
    out = []
    for j in range(m):
        full = np.zeros(units, dtype=np.int64)
        full[live] = np.rint(basis[:, j]).astype(np.int64)
        out.append((full, float(amount[j])))
    return out


def plan(counts: np.ndarray, units: int) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of patterns that hold exactly ``counts`` pieces of each class."""
    left = counts.copy()
    chosen: list[tuple[np.ndarray, int]] = []
    if left.any():
        for pattern, amount in sorted(solve(left, units), key=lambda x: -x[1]):
            used = np.flatnonzero(pattern)
            if len(used):
                times = min(int(amount + 1e-6), int((left[used] // pattern[used]).min()))
                if times:
                    chosen.append((pattern, times))
                    left = left - times * pattern
    # what rounding left over: the largest class that still fits, again and again
    while left.any():
        pattern, room = np.zeros(units, dtype=np.int64), units
        for k in range(units - 1, -1, -1):
            n = min(int(left[k]), room // (k + 1))
            pattern[k] += n
            room -= n * (k + 1)
        used = np.flatnonzero(pattern)
        times = int((left[used] // pattern[used]).min())
        chosen.append((pattern, times))
        left = left - times * pattern
    return chosen


def rank_ranges(chosen: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """class, first rank, end rank, first sequence, place in the sequence."""
    rows, base, taken = [], 0, {}
    for pattern, times in chosen:
        place = 0
        for k in np.flatnonzero(pattern)[::-1]:
            for _ in range(int(pattern[k])):
                start = taken.get(int(k), 0)
                rows.append((int(k), start, start + times, base, place))
                taken[int(k)] = start + times
                place += 1
        base += times
    return rows


def assign(cut: DataFrame, capacity: int = CAPACITY, width: int = WIDTH) -> DataFrame:
    """doc_row, start, sequence_id, offset for every piece."""
    spark, units = cut.sparkSession, capacity // width
    slim = cut.select("doc_row", "start", "length", F.ceil((F.col("length") / width)).cast("int").alias("units"))
    slim = slim.withColumn("class", F.col("units") - 1).drop("units")
    histogram = slim.groupBy("class").agg(F.count("*").alias("n")).collect()  # one row for each class, units at most
    counts = np.zeros(units, dtype=np.int64)
    for row in histogram:
        counts[row["class"]] = row["n"]
    blocks = blocks_for(int(counts.sum()), ROWS_PER_BLOCK)
    blocked = slim.withColumn("block", F.pmod(F.xxhash64("doc_row", "start"), F.lit(blocks)).cast("int"))
    before = W.partitionBy("class").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    first = blocked.groupBy("class", "block").agg(F.count("*").alias("n")).select(
        "class", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = W.partitionBy("class", "block").orderBy("doc_row", "start")
    ranked = blocked.withColumn("nth", F.row_number().over(inside) - 1).join(first, ["class", "block"]).withColumn(
        "rank", F.col("first") + F.col("nth"))
    ranges = spark.createDataFrame(
        rank_ranges(plan(counts, units)), "class int, low long, high long, base long, place int")
    placed = ranked.join(
        F.broadcast(ranges),  # at most a few patterns for each class
        (ranked["class"] == ranges["class"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    order = W.partitionBy("sequence_id").orderBy("place")
    return placed.select(
        "doc_row", "start", "length", (F.col("base") + F.col("rank") - F.col("low")).alias("sequence_id"), "place",
    ).select(
        "doc_row", "start", "sequence_id",
        (F.sum("length").over(order) - F.col("length")).alias("offset"))


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, width: int = WIDTH) -> DataFrame:
    """One row per piece: doc_id, doc_row, start, length, doc_tokens, ids, ids_crc32, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit numbers; a reader that drops the column never moves them.
    """
    cut = pieces(df, tokenizer_path, id_col, text_col, capacity, end_id)
    return cut.join(assign(cut, capacity, width), ["doc_row", "start"])


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, tokens, padded (lengths that are powers of two are not padded)."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    exact = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.agg(
        F.count("*").alias("sequences"), F.sum("used").alias("tokens"),
        F.sum(F.when(exact, 0).otherwise(capacity - F.col("used"))).alias("padded"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


DIGEST = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer()).select(*DIGEST)
