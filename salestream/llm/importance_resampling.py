"""Documents drawn so that their word runs resemble a target: importance resampling over hashed features.

Features of a text are all runs of one to ``LONGEST_RUN`` words; a feature's bucket is its CRC-32 modulo ``BUCKETS``.

1. A part of the texts (about ``PART_BYTES``) is brought to words with single delimiters. Its distinct words, with the
   delimiter on both sides, form an Aho-Corasick dictionary whose payloads are each word's CRC, the CRC of delimiter and
   word, and their length. One scan of the part emits a payload for each word.
2. Payloads next to each other are composed: the CRC of two strings put together follows from both CRCs and the length of
   the second, so the buckets of longer runs come from the payloads alone, and no run is ever built as a string.
3. Tasks add up their buckets; the sums over all documents and over the target (``BUCKETS`` numbers each) give every bucket a
   gain, ``floor(1000 ln(target share / corpus share))`` with one count added to each.
4. A second scan sums the gains of a document. With a Gumbel term from the hash of its id, the documents of highest
   score are a sample without replacement, in proportion to the exponential of their weights.
5. The drawn share is ranked in ranges of the score that are counted first, so no task sorts all documents.

A dictionary never holds more than one part, so its size does not grow with the corpus, and every word is in it.

Defined results: null and empty texts have no features and weight 0. Texts longer than a part are scanned in pieces that
overlap by ``LONGEST_RUN - 1`` words. Rows that repeat an id have the same Gumbel term; ties go to the smaller
id (null ids last, hashed as an empty id), then to the hash of the text. Fewer than ``100 / percent`` documents of enough
words draw none. An empty target gives gains that differ by corpus counts only. Other columns are not used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salestream.llm.common import blocks_for, stored, table

BUCKETS = 10_000
LONGEST_RUN = 3
PERCENT = 5
LEAST_WORDS = 20
SEED = 42
PART_BYTES = 1 << 20
#: Ranked rows in a range of the score, and the most ranges.
RANGE_ROWS, MOST_RANGES = 500, 4096

_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: A-Z to lower case, everything that is no part of a word to a space.
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """What so many zero bytes do to a CRC, as four tables by its bytes: for 0 to 64 bytes, and for powers of two."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> 1) ^ np.where(step & 1, np.uint32(0xEDB88320), np.uint32(0))
    few = np.zeros((65, 4, 256), dtype=np.uint32)
    few[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, 65):
        few[n] = (few[n - 1] >> 8) ^ step[few[n - 1] & 255]
    powers = [few[1]]
    for _ in range(40):
        powers.append(_apply(powers[-1], powers[-1]))
    return few, np.array(powers)


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


_FEW, _POWERS = _byte_tables()


def advanced(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """The CRCs after as many zero bytes; with the CRC of what really follows, xor gives that of both together."""
    short = np.minimum(n_bytes, 64)
    out = (_FEW[short, 0, crc & 255] ^ _FEW[short, 1, crc >> 8 & 255]
           ^ _FEW[short, 2, crc >> 16 & 255] ^ _FEW[short, 3, crc >> 24])
    left = n_bytes - short
    for bit in range(int(left.max(initial=0)).bit_length()):
        at = np.flatnonzero(left >> bit & 1)
        out[at] = _apply(_POWERS[bit], out[at])
    return out


class Dictionary:
    """The distinct words of a part, found by scanning, with payloads."""

    def __init__(self, words: set[bytes]):
        known = list(words)
        self.crc = np.array([zlib.crc32(w) for w in known], dtype=np.uint32)
        space = zlib.crc32(b" ")
        self.crc_after = np.array([zlib.crc32(w, space) for w in known], dtype=np.uint32)
        self.length = np.array([len(w) + 1 for w in known], dtype=np.int64)
        self.automaton = ahocorasick.Automaton()
        for number, word in enumerate(known):
            self.automaton.add_word(f" {word.decode('latin-1')} ", number)
        if known:
            self.automaton.make_automaton()

    def scan(self, text: bytes, n_words: int) -> np.ndarray:
        """The numbers of the words of ``text``, in their order."""
        if not n_words:
            return np.zeros(0, dtype=np.int64)
        found = self.automaton.iter(text.decode("latin-1"))
        return np.fromiter((number for _, number in found), dtype=np.int64, count=n_words)


def _pieces(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes], int]]:
    """(row, words, how many of them were in the piece before) for pieces of at most about ``PART_BYTES``."""
    for row, text in enumerate(texts):
        text = (text or b"").translate(_NORMAL)
        before: list[bytes] = []
        at = 0
        while at < len(text):
            end = len(text) if len(text) - at <= PART_BYTES else text.find(b" ", at + PART_BYTES)
            end = len(text) if end < 0 else end
            words = text[at:end].split()
            yield row, before + words, len(before)
            before = (before + words)[-(LONGEST_RUN - 1):] if LONGEST_RUN > 1 else []
            at = end


def _parts(texts: list[bytes | None]) -> Iterator[list[tuple[int, list[bytes], int]]]:
    held, size = [], 0
    for piece in _pieces(texts):
        held.append(piece)
        size += sum(map(len, piece[1])) + len(piece[1])
        if size >= PART_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def features(texts: list[bytes | None], buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words in a run, rows, buckets) of all features, part by part; rows count from 0 in ``texts``."""
    for part in _parts(texts):
        words = Dictionary({w for _, ws, _ in part for w in ws})
        counts = np.array([len(ws) for _, ws, _ in part])
        # an empty word between two pieces: no run crosses it, as places are counted anew
        joined = b" " + b"  ".join(b" ".join(ws) for _, ws, _ in part if ws) + b" "
        found = words.scan(joined, int(counts.sum()))
        rows = np.repeat([row for row, _, _ in part], counts)
        place = np.arange(len(found)) - np.repeat(np.cumsum(counts) - counts, counts)
        new = place >= np.repeat([n for _, _, n in part], counts)
        length, after = words.length[found], words.crc_after[found]
        crc = words.crc[found]
        for n in range(1, LONGEST_RUN + 1):
            if n > 1:
                longer = np.zeros_like(crc)
                longer[1:] = advanced(crc[:-1], length[1:]) ^ after[1:]
                crc = longer
            at = np.flatnonzero(new & (place >= n - 1))
            yield n, rows[at], (crc[at] % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the column text are in each bucket; every task adds up its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, at in features(batch.column(0).to_pylist(), buckets):
                total += np.bincount(at, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    found = texts.select(F.col("text").cast("binary")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # as many rows as buckets
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t, n = corpus.astype(float), target.astype(float), len(corpus)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighed(slim: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, text_key, n_words, n_features, weight for every row of ``slim`` (doc_id, text_key, text binary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_rows = batch.num_rows
            n_words, n_features, weight = (np.zeros(n_rows, dtype=np.int64) for _ in range(3))
            for n, rows, at in features(batch.column(2).to_pylist(), len(gain)):
                count = np.bincount(rows, minlength=n_rows)
                n_features += count
                n_words += count if n == 1 else 0
                np.add.at(weight, rows, gain[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                names=["doc_id", "text_key", "n_words", "n_features", "weight"])

    return slim.mapInArrow(run, "doc_id long, text_key long, n_words long, n_features long, weight long")


def gumbel(seed: int = SEED):
    """Floor of 1000 times a Gumbel value that is fixed by doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` (stored) with rank; null for rows that are not drawn."""
    able = F.col("n_words") >= least_words
    n_able = scored.where(able).count()
    n_drawn = percent * n_able // 100
    none = F.lit(None).cast("long").alias("rank")
    if not n_drawn:
        return scored.select("*", none)
    # a cut below the last drawn score; it only saves sorting, so an estimate does, checked by a count
    share = min(1.0, 1.1 * n_drawn / n_able + 0.001)
    cut = scored.where(able).agg(F.percentile_approx("score", 1 - share, 100_000)).first()[0]
    upper = able & (F.col("score") >= cut)
    if scored.where(upper).count() < n_drawn:
        upper = able
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("text_key")]
    n_ranges = min(MOST_RANGES, blocks_for(n_drawn, RANGE_ROWS))
    dealt = stored(scored.where(upper).repartitionByRange(n_ranges, *order)
                   .withColumn("range", F.spark_partition_id()), "resample-ranges")
    sizes = dealt.groupBy("range").agg(F.count("*").alias("n"))  # as many rows as ranges
    first = sizes.select("range", (F.sum("n").over(W.orderBy("range")) - F.col("n")).alias("before"))
    place = F.col("before") + F.row_number().over(W.partitionBy("range").orderBy(*order))
    drawn = dealt.join(F.broadcast(first), "range").withColumn("rank", place)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    return drawn.select(*scored.columns, "rank").unionByName(scored.where(~upper).select("*", none))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key (hash of the text), n_words, n_features, weight, score, rank.

    ``percent`` of the documents with ``least_words`` words are drawn (rounded down); rank numbers them by descending
    score and is null for the others.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                       F.col(text_col).cast("binary").alias("text"))
    gain = gains(bucket_counts(slim.select("text"), buckets),
                 bucket_counts(target.select(F.col(target_col).alias("text")), buckets))
    scored = weighed(slim, gain).withColumn("score", F.col("weight") + gumbel(seed))
    return ranked(stored(scored, "resample-scores"), percent, least_words)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 byte by byte with a table made by its rule; distinct features only.
SQL = """
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, x:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), text FROM benchmark),
numbered AS (SELECT row_number() OVER () AS row_id, * FROM texts),
split AS (
  SELECT row_id, side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM numbered),
runs AS (
  SELECT row_id, side, unnest(w) AS f FROM split
  UNION ALL SELECT row_id, side, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split
  UNION ALL SELECT row_id, side,
    unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM split),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(f)) + 1),
           lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i - 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM runs), crc_table),
found AS (SELECT row_id, side, bucket FROM runs JOIN hashed USING (f)),
counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM found GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE
           / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE))) AS BIGINT) AS g FROM counts),
weights AS (
  SELECT row_id, count(*) AS n_features, CAST(sum(g) AS BIGINT) AS weight
  FROM found JOIN gain USING (bucket) WHERE side = 'd' GROUP BY row_id),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || id), 1, 8) AS BIGINT)
           + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM split LEFT JOIN weights USING (row_id) WHERE side = 'd'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
         5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS n_drawn FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= n_drawn THEN place END AS rank
FROM placed
"""
