"""Toxicity by the nearest labelled examples.

1. Examples are a bounded sample of the labelled rows: per label the ``MOST_TOXIC`` or ``MOST_CLEAN`` rows
   of least text hash. Weights undo the different sampling rates.
2. Terms are words and word beginnings of 4 to 6 letters that are in ``LEAST_EXAMPLES`` examples. Tasks read the texts of
   the examples; the driver gets the terms, and by example their numbers and counts. Document
   frequencies are counted over all documents: every task adds up its own, and the sums are added in two steps.
3. The vocabulary is those terms whose share among the examples differs between labels by a number of standard errors.
   Which of ``CUTS`` it is, cross-validation over the examples decides: terms are chosen without a fold, and the cut is taken
   whose out-of-fold votes have the least log loss, each fold calibrated by the others. The least cut takes every term. Each
   fold is voted on in a task of its own.
4. A document's nearest ``K`` examples by cosine of TF-IDF vectors over the vocabulary are found exactly with
   a block-max inverted index: examples in blocks of like ones, postings by term and block with the largest weight of
   each; blocks are searched in descending order of their bound until no bound exceeds the k-th best.
5. Votes weighted by similarity and sampling weight (1 on average), with ``PRIOR_VOTES`` votes of the base rate, give a
   share; the neighbours are the evidence. All examples that tie for the last place share what is left of the ``K`` votes.
   A document without terms of the vocabulary has the rate that such documents have among the examples.
6. The score is the toxic rate at that share: a monotone map fitted to the out-of-fold shares of the examples
   (pooled adjacent violators, then linear between the pools).

Index and vocabulary are bounded by the sample of examples, so they are handed to the tasks; everything else runs
over all rows, and every term of a document counts. Labels, language, source and id are no inputs of a score: the sample, the
folds and all ties go by texts, so numbering the documents anew changes no score.

Defined results: null and empty texts have no terms; texts of any length are read whole, words longer than ``LONGEST_TERM``
stand as a hash of the whole word. Rows that repeat an id are scored each; the label of an id is the largest of its labels, and
null labels are ignored. Examples of equal texts are in one fold. A fold that leaves nothing to learn from has the
base rate. Without examples of both labels all scores are the base rate (0 without any). Other columns are not
used, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salestream.llm.common import in_parts, own_name, stored, table

#: Bounds of the sample that is learned from; the only bounds there are.
MOST_TOXIC = 2048
MOST_CLEAN = 4096
#: Standard errors that a term's share must differ by, one of these.
CUTS = (0.0, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0)
FOLDS = 5
#: A term must be in so many examples.
LEAST_EXAMPLES = 3
K = 15
PRIOR_VOTES = 0.5
BLOCK = 64
THRESHOLD = 0.7
#: Longer words stand as a hash of the whole word, so that the vocabulary is bounded in bytes too.
LONGEST_TERM = 40
WORDS_KEPT = 400_000
#: Characters of examples whose terms are counted at once.
CHARS_AT_ONCE = 500_000
#: Terms that a task counts before it passes the sums on.
TERMS_AT_ONCE = 200_000
#: Tasks that add up the sums of all others.
ADDERS = 32

_WORD = re.compile(r"[^\W_]+")


def beginnings(word: str) -> list[str]:
    """The terms of a word: itself and its beginnings, marked by ``*``."""
    whole = word if len(word) <= LONGEST_TERM else "#" + hashlib.sha256(word.encode()).hexdigest()[:32]
    return [whole, *(word[:n] + "*" for n in (4, 5, 6) if len(word) > n)]


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def labelled(labels: DataFrame, learnable: Column | None = None) -> DataFrame:
    """doc_id, toxic (0 or 1), one row per id."""
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    rows = rows if learnable is None else rows.where(learnable)
    return rows.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))


def choose_examples(slim: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """The sampled rows (doc_id, text_key, toxic), and how many labelled rows a sampled one stands for."""
    keys = slim.select("doc_id", "text_key").distinct()
    rows = stored(keys.join(labels, "doc_id"), "toxicity-labels")
    total = {row["toxic"]: row["n"] for row in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    most = {1: MOST_TOXIC, 0: MOST_CLEAN}
    parts = [rows.where(F.col("toxic") == y).orderBy("text_key", "doc_id").limit(most[y]) for y in (0, 1)]
    weights = {y: total.get(y, 0) / max(1, min(most[y], total.get(y, 0))) for y in (0, 1)}
    return stored(parts[0].unionByName(parts[1]), "toxicity-sample"), weights


def _held_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    sums = lambda: pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "n"])
    for batch in batches:
        for text in batch.column(0):
            counts.update({t for w in set(words(text.as_py())) for t in beginnings(w)})
            if len(counts) > TERMS_AT_ONCE:
                yield sums()
                counts.clear()
    yield sums()


def candidate_terms(examples: DataFrame) -> list[str]:
    """The terms in ``LEAST_EXAMPLES`` of the texts, or all if none is, the most frequent first."""
    held = examples.select("text").mapInArrow(_held_terms, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    held = stored(held, "toxicity-terms")
    for least in (LEAST_EXAMPLES, 1):
        chosen = held.where(F.col("n") >= least).toArrow()  # bounded by the examples
        if chosen.num_rows:
            break
    return chosen.sort_by([("n", "descending"), ("term", "ascending")])["term"].to_pylist()


def differences(a: np.ndarray, b: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """By how many standard errors a / n0 and b / n1 differ."""
    n0, n1 = max(1, n0), max(1, n1)
    share = np.minimum((a + b) / (n0 + n1), 1)
    error = np.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    return np.divide(np.abs(b / n1 - a / n0), error, out=np.zeros(len(a)), where=error > 0)


def pools(shares: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Pooled adjacent violators: rows (mean share, toxic rate, weight), both means ascending."""
    at, group = np.unique(shares, return_inverse=True)  # equal shares first
    total = np.bincount(group, weights, minlength=len(at))
    rates = np.bincount(group, weights * toxic, minlength=len(at)) / total
    out: list[list[float]] = []
    for pool in zip(at.tolist(), rates.tolist(), total.tolist(), strict=True):
        out.append(list(pool))
        while len(out) > 1 and out[-2][1] >= out[-1][1]:
            x2, y2, w2 = out.pop()
            x1, y1, w1 = out[-1]
            out[-1] = [(x1 * w1 + x2 * w2) / (w1 + w2), (y1 * w1 + y2 * w2) / (w1 + w2), w1 + w2]
    return np.array(out).reshape(-1, 3)


def calibration(shares: np.ndarray, toxic: np.ndarray, weights: np.ndarray, base: float) -> tuple[np.ndarray, np.ndarray]:
    """Shares and the rates there, ascending; each pool has ``PRIOR_VOTES`` votes of the base rate."""
    found = pools(shares, toxic, weights)
    rates = (found[:, 1] * found[:, 2] + PRIOR_VOTES * base) / (found[:, 2] + PRIOR_VOTES)
    return found[:, 0], np.maximum.accumulate(rates)


def cross_loss(shares: np.ndarray, toxic: np.ndarray, weights: np.ndarray, fold: np.ndarray, base: float) -> float:
    """Log loss of the shares, those of a fold calibrated by the other folds."""
    rate = np.full(len(shares), base)
    for f in range(FOLDS):
        own = fold == f
        if own.any() and not own.all():
            rate[own] = np.interp(shares[own], *calibration(shares[~own], toxic[~own], weights[~own], base))
    rate = rate.clip(1e-9, 1 - 1e-9)
    return float(-(weights * np.where(toxic, np.log(rate), np.log(1 - rate))).sum() / weights.sum())


def voted(sims: np.ndarray, toxic: np.ndarray, stands_for: np.ndarray, base: float) -> float:
    """The toxic share of the votes of the nearest ``K``; those that tie for the last place share what is left."""
    sims = sims.round(12)
    kth = np.partition(sims, -K)[-K] if len(sims) > K else sims.min(initial=0.0)
    near, last = sims > kth, sims == kth
    votes = sims * stands_for * (near + last * ((min(K, len(sims)) - near.sum()) / max(1, last.sum())))
    # summed by value, so that the order of the examples shows nowhere
    hits = np.sort(votes[toxic]).sum()
    return float((hits + PRIOR_VOTES * base) / (hits + np.sort(votes[~toxic]).sum() + PRIOR_VOTES))


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers from each ``low`` to before its ``high``, one range after the other."""
    size = high - low
    return np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size)


@dataclass
class Examples:
    """What is known of the sampled rows, by number."""

    ids: np.ndarray
    text_keys: np.ndarray
    toxic: np.ndarray
    stands_for: np.ndarray
    terms: list[np.ndarray]
    counts: list[np.ndarray]

    def __len__(self) -> int:
        return len(self.ids)

    def holders(self, n_terms: int, toxic: bool | None = None) -> np.ndarray:
        """How many examples, or how many of that label, hold each term."""
        out = np.zeros(n_terms, dtype=np.int64)
        for terms, own in zip(self.terms, self.toxic, strict=True):
            if toxic is None or own == toxic:
                out[terms] += 1
        return out

    def folds(self) -> np.ndarray:
        """Equal texts are in one fold; those of each label are dealt out by text hash."""
        fold = np.zeros(len(self), dtype=int)
        for label in (False, True):
            at = np.flatnonzero(self.toxic == label)
            fold[at] = np.unique(self.text_keys[at], return_inverse=True)[1] % FOLDS
        of_toxic = dict(zip(self.text_keys[self.toxic].tolist(), fold[self.toxic].tolist(), strict=True))
        return np.array([of_toxic.get(k, f) for k, f in zip(self.text_keys.tolist(), fold.tolist(), strict=True)], dtype=int)


@dataclass
class Postings:
    """The terms of all examples: for each term, ascending, the numbers of its examples and how often it stands there."""

    sizes: np.ndarray
    row: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, known: Examples, n_terms: int) -> Postings:
        sizes = known.holders(n_terms)
        row = np.empty(sizes.sum(), dtype=np.min_scalar_type(len(known)))
        count = np.empty(len(row), dtype=np.int32)
        at = np.cumsum(sizes) - sizes
        for i, (terms, counts) in enumerate(zip(known.terms, known.counts, strict=True)):  # no sort, to spare memory
            row[at[terms]], count[at[terms]] = i, counts
            at[terms] += 1
        return cls(sizes, row, count)


def shares_of_fold(posts: Postings, y: np.ndarray, stands: np.ndarray, idf: np.ndarray, fold: np.ndarray, base: float,
                   f: int) -> np.ndarray:
    """A row for each cut: the shares of the examples of fold ``f`` by the examples outside it."""
    n, inside, members = len(y), fold != f, np.flatnonzero(fold == f)
    out = np.full((len(CUTS), len(members)), base)
    ends = np.concatenate([[0], np.cumsum(posts.sizes)])
    held = lambda which: np.diff(np.concatenate([[0], np.cumsum(which[posts.row])])[ends])
    a, b = held(inside & ~y), held(inside & y)
    z = np.where(a + b > 0, differences(a, b, int((inside & ~y).sum()), int((inside & y).sum())), -1.0)
    for shares, cut in zip(out, CUTS, strict=True):
        taken = z >= cut
        if not taken.any() or not inside.any():
            continue  # nothing to learn from: the base rate
        size = posts.sizes[taken]
        kept = np.repeat(taken, posts.sizes)
        row, x = posts.row[kept], posts.count[kept].astype(float)
        np.log(x, out=x)
        x += 1
        x *= np.repeat(idf[taken], size)
        length = np.zeros(n)
        for at in range(0, len(x), 1 << 18):  # a little at once, to spare memory
            part = x[at:at + (1 << 18)]
            np.add.at(length, row[at:at + (1 << 18)].astype(np.int64), part * part)
        length = np.sqrt(length)
        x /= length[row]
        # postings of the examples outside the fold, by term; the terms of those inside, by example
        learn = inside[row]
        start = np.concatenate([[0], np.cumsum(np.where(taken, a + b, 0))])
        post_row, post_x = row[learn], x[learn]
        own_row, own_x = row[~learn], x[~learn]
        own_term = np.repeat(np.flatnonzero(taken).astype(np.int32), size)[~learn]
        del kept, row, x, learn
        order = np.argsort(own_row, kind="stable")
        own_x, own_term = own_x[order], own_term[order]
        low = np.searchsorted(own_row[order], members, "left")
        high = np.searchsorted(own_row[order], members, "right")
        bare = inside & (length == 0)
        no_terms = ((stands * y)[bare].sum() + PRIOR_VOTES * base) / (stands[bare].sum() + PRIOR_VOTES)
        for i in range(len(members)):
            terms = own_term[low[i]:high[i]]
            if not len(terms):
                shares[i] = no_terms
                continue
            post = _ranges(start[terms], start[terms + 1])
            part = np.repeat(own_x[low[i]:high[i]], start[terms + 1] - start[terms]) * post_x[post]
            sims = np.bincount(post_row[post], part, minlength=n)
            near = np.flatnonzero(sims > 0)
            shares[i] = voted(sims[near], y[near], stands[near], base)
    return out


def fold_shares(spark: SparkSession, known: Examples, idf: np.ndarray, fold: np.ndarray, base: float) -> dict[float, np.ndarray]:
    """For each cut the share of every example by the examples outside its fold; a task for each fold."""
    shared = spark.sparkContext.broadcast(  # bounded by the examples
        (Postings.of(known, len(idf)), known.toxic, known.stands_for, idf, fold, base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.column(0).to_pylist():
                shares = shares_of_fold(*shared.value, f)
                yield pa.RecordBatch.from_arrays([pa.array([f]), pa.array([shares.tobytes()])], names=["fold", "shares"])

    out = np.full((len(CUTS), len(known)), base)
    for one in spark.range(0, FOLDS, 1, FOLDS).mapInArrow(run, "fold long, shares binary").collect():  # FOLDS rows
        out[:, fold == one["fold"]] = np.frombuffer(one["shares"]).reshape(len(CUTS), -1)
    shared.destroy()
    return dict(zip(CUTS, out, strict=True))


def fit(spark: SparkSession, known: Examples, idf: np.ndarray, base: float) -> tuple[np.ndarray, tuple | None]:
    """The numbers of the terms that are taken, and the map from shares to rates."""
    y, n_terms = known.toxic, len(idf)
    if not n_terms or y.all() or not y.any():
        return np.zeros(0, dtype=int), None
    fold = known.folds()
    shares = fold_shares(spark, known, idf, fold, base)
    z = differences(known.holders(n_terms, False), known.holders(n_terms, True), int((~y).sum()), int(y.sum()))
    loss = lambda c: round(cross_loss(shares[c], y, known.stands_for, fold, base), 6)
    cut = min((c for c in CUTS if (z >= c).any()), key=lambda c: (loss(c), -c))
    return np.flatnonzero(z >= cut), calibration(shares[cut], y, known.stands_for, base)


class _WordNumbers(dict):
    """Numbers of words by their terms of the vocabulary, as words come up; 0 for words without any."""

    def __init__(self, number: dict[str, int]):
        super().__init__()
        self.number = number
        self.terms: list[int] = []
        self.ends = [0]

    def __missing__(self, word: str) -> int:
        terms = [self.number[t] for t in beginnings(word) if t in self.number]
        if terms:
            self.terms += terms
            self.ends.append(len(self.terms))
        self[word] = len(self.ends) - 1 if terms else 0
        return self[word]


class TermCounter:
    """Terms of the vocabulary in texts, by number; many texts at once."""

    def __init__(self, vocabulary: list[str]):
        self.number = {t: i for i, t in enumerate(vocabulary)}
        self.known = _WordNumbers(self.number)

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, terms and how often each stands there, by row and term."""
        if len(self.known) > WORDS_KEPT:
            self.known = _WordNumbers(self.number)
        found, sizes = [], []
        for text in texts:
            numbers = list(map(self.known.__getitem__, words(text)))
            found += numbers
            sizes.append(len(numbers))
        word = np.array(found, dtype=np.int64) - 1
        row = np.repeat(np.arange(len(texts)), sizes)[word >= 0]
        word = word[word >= 0]
        ends = np.array(self.known.ends, dtype=np.int64)
        term = np.array(self.known.terms, dtype=np.int64)[_ranges(ends[word], ends[word + 1])]
        n_terms = max(1, len(self.number))
        pair, n = np.unique(np.repeat(row, ends[word + 1] - ends[word]) * n_terms + term, return_counts=True)
        return pair // n_terms, pair % n_terms, n


def counted_apart(examples: DataFrame, vocabulary: list[str]) -> pa.Table:
    """doc_id, text_key, toxic, terms and how often they stand there, of each example by text; counted in tasks."""
    shared = examples.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the examples

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter(shared.value)
        for batch in batches:
            chars, at = np.array(pc.utf8_length(batch.column(3))), 0
            while at < batch.num_rows:  # CHARS_AT_ONCE or one text at once, to spare memory
                upto = at + max(1, int(np.searchsorted(np.cumsum(chars[at:]), CHARS_AT_ONCE, "right")))
                part = batch.slice(at, upto - at)
                row, term, n = counter.counts(part.column(3).to_pylist())
                ends = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (term, n)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *lists], names=["doc_id", "text_key", "toxic", "terms", "counts"])
                at = upto

    found = examples.select("doc_id", "text_key", "toxic", "text").mapInArrow(
        count, "doc_id long, text_key long, toxic int, terms array<int>, counts array<int>").toArrow()
    shared.destroy()
    return found.sort_by([("text_key", "ascending"), ("toxic", "ascending"), ("doc_id", "ascending")])


def _by_row(lists: pa.ChunkedArray) -> list[np.ndarray]:
    flat = lists.combine_chunks()
    return np.split(flat.flatten().to_numpy(), np.cumsum(flat.value_lengths().to_numpy())[:-1])[:len(flat)]


def document_frequencies(slim: DataFrame, vocabulary: list[str]) -> tuple[np.ndarray, int]:
    """In how many texts each term is, and how many texts there are."""
    n = len(vocabulary) + 1  # the last counts the texts
    shared = slim.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the examples

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, total = TermCounter(shared.value), np.zeros(n, dtype=np.int64)
        for batch in batches:
            for part in in_parts([batch]):
                total += np.bincount(counter.counts(part.column(0).to_pylist())[1], minlength=n)
                total[-1] += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, dtype=np.int64)
        for batch in batches:
            for one in batch.column(0):
                total += np.frombuffer(one.as_py(), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["counts"])

    sums = slim.select("text").mapInArrow(count, "counts binary").repartition(ADDERS).mapInArrow(add, "counts binary")
    total = np.zeros(n, dtype=np.int64)
    for row in sums.collect():  # ADDERS rows
        total += np.frombuffer(row["counts"], dtype=np.int64)
    return total[:-1], int(total[-1])


class Index:
    """Block-max inverted index of the examples, and what their votes need."""

    def __init__(self, known: Examples, chosen: np.ndarray, idf: np.ndarray, base: float,
                 rate_at: tuple[np.ndarray, np.ndarray] | None = None):
        """``chosen``: the numbers of the terms that count, ascending; a term's number is its place there from here on."""
        self.idf, self.base, self.rate_at = idf[chosen], base, rate_at
        number = np.full(len(idf), -1)
        number[chosen] = np.arange(len(chosen))
        rows, without = [], np.ones(len(known), dtype=bool)
        for i, (terms, counts) in enumerate(zip(known.terms, known.counts, strict=True)):
            held = number[terms] >= 0
            if held.any():
                terms = number[terms][held]
                x = self.vector(terms, counts[held])
                # like ones side by side, so that a block's largest weights are close to those of its members
                rows.append((bool(known.toxic[i]), int(terms[x.argmax()]), int(known.text_keys[i]), i, terms, x))
                without[i] = False
        rows.sort(key=lambda r: r[:4])
        of = np.array([r[3] for r in rows], dtype=np.int64)
        self.ids, self.toxic, self.stands_for = known.ids[of], known.toxic[of], known.stands_for[of]
        stands, toxic = known.stands_for[without], known.toxic[without]
        self.no_terms = (stands[toxic].sum() + PRIOR_VOTES * base) / (stands.sum() + PRIOR_VOTES)
        # postings by term and block, with one entry for each of these pairs that occurs
        self.n_blocks = -(-len(rows) // BLOCK)
        at = np.repeat(np.arange(len(rows)), [len(r[4]) for r in rows])
        term = np.concatenate([r[4] for r in rows]) if rows else np.zeros(0, dtype=np.int64)
        x = np.concatenate([r[5] for r in rows]) if rows else np.zeros(0)
        order = np.lexsort((at, term))
        self.post_at, self.post_x, term = at[order], x[order], term[order]
        pair = term * max(1, self.n_blocks) + self.post_at // BLOCK
        _, self.entry_from = np.unique(pair, return_index=True)
        self.entry_block = (self.post_at // BLOCK)[self.entry_from]
        self.entry_most = np.maximum.reduceat(self.post_x, self.entry_from) if len(pair) else np.zeros(0)
        self.term_from = np.searchsorted(term[self.entry_from], np.arange(len(chosen) + 1))
        self.entry_from = np.append(self.entry_from, len(pair))

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts.astype(float))) * self.idf[terms]
        return x / np.sqrt((x * x).sum())

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and similarities of the k nearest examples and of all that tie with the last of them."""
        x = self.vector(terms, counts)
        low, high = self.term_from[terms], self.term_from[terms + 1]
        entry = _ranges(low, high)
        x = np.repeat(x, high - low)
        block = self.entry_block[entry]
        bound = np.bincount(block, x * self.entry_most[entry], minlength=self.n_blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        examples, sims, kth, done, size = np.zeros(0, dtype=np.int64), np.zeros(0), 0.0, 0, 8
        rank = np.full(self.n_blocks, self.n_blocks)
        rank[order] = np.arange(len(order))
        place = rank[block]
        while done < len(order) and (len(sims) < k or bound[order[done]] >= kth - 1e-9):
            taken = (place >= done) & (place < done + size)
            own = entry[taken]
            post = _ranges(self.entry_from[own], self.entry_from[own + 1])
            part = np.repeat(x[taken], self.entry_from[own + 1] - self.entry_from[own]) * self.post_x[post]
            found = np.bincount(self.post_at[post], part)
            hit = np.flatnonzero(found)
            examples = np.concatenate([examples, hit])
            sims = np.concatenate([sims, found[hit].round(12)])
            if len(sims) > k:
                kth = np.partition(sims, -k)[-k]
                near = sims >= kth
                examples, sims = examples[near], sims[near]
            done, size = done + size, size * 2
        return examples, sims

    def score(self, examples: np.ndarray, sims: np.ndarray) -> float:
        return self.calibrated(voted(sims, self.toxic[examples], self.stands_for[examples], self.base))

    def calibrated(self, share: float) -> float:
        return float(share if self.rate_at is None else np.interp(share, *self.rate_at))


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))


def search(slim: DataFrame, vocabulary: list[str], index: Index) -> DataFrame:
    """doc_id, text_key, score and evidence (the ``K`` nearest examples: doc_id, similarity, toxic) of each row of ``slim``."""
    shared = slim.sparkSession.sparkContext.broadcast((vocabulary, index))  # bounded by the examples

    def evidence(own: Index, examples: np.ndarray, sims: np.ndarray) -> list[dict]:
        first = np.lexsort((own.ids[examples], -sims))[:K]
        return [{"doc_id": int(own.ids[i]), "similarity": float(s), "toxic": int(own.toxic[i])}
                for i, s in zip(examples[first], sims[first], strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of, own = shared.value
        counter = TermCounter(terms_of)
        seen: dict[int, tuple[float, list]] = {}
        for batch in in_parts(batches):
            found, keys = [], batch.column(1).to_pylist()
            rows, terms, counts = counter.counts(batch.column(2).to_pylist())
            starts = np.searchsorted(rows, np.arange(len(keys) + 1)).tolist()
            for key, low, high in zip(keys, starts, starts[1:], strict=False):
                if key not in seen:
                    if len(seen) > 2_000:
                        seen.clear()
                    if high > low:
                        near = own.nearest(terms[low:high], counts[low:high])
                        seen[key] = own.score(*near), evidence(own, *near)
                    else:
                        seen[key] = own.calibrated(own.no_terms), []
                found.append(seen[key])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s for s, _ in found], pa.float64()),
                 pa.array([e for _, e in found], _EVIDENCE)], names=["doc_id", "text_key", "score", "evidence"])

    return slim.select("doc_id", "text_key", "text").mapInArrow(
        run, "doc_id long, text_key long, score double, evidence array<struct<doc_id:bigint,similarity:double,toxic:int>>")


def learned(slim: DataFrame, labels: DataFrame) -> tuple[list[str], Index]:
    """The vocabulary and the index; slim: doc_id, text_key, text."""
    sample, rates = choose_examples(slim, labels)
    # at most MOST_TOXIC + MOST_CLEAN rows; rows that repeat id and text count once
    texts = slim.join(F.broadcast(sample), ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    examples = stored(texts.select("doc_id", "text_key", "toxic", "text"), "toxicity-examples")
    terms = candidate_terms(examples) if rates[0] and rates[1] else []  # of both labels
    rows = counted_apart(examples, terms)  # bounded as above
    toxic = rows["toxic"].to_numpy() == 1
    stands = np.where(toxic, rates[1], rates[0])
    base = float(stands[toxic].sum() / stands.sum()) if len(toxic) else 0.0
    # 1 on average, so that the prior counts alike however many rows an example stands for
    stands = stands / stands.mean() if len(toxic) else stands
    known = Examples(rows["doc_id"].to_numpy(), rows["text_key"].to_numpy(), toxic, stands, _by_row(rows["terms"]), _by_row(rows["counts"]))
    del rows
    idf = np.zeros(0)
    if terms:
        found, n_docs = document_frequencies(slim, terms)
        idf = np.log((1 + n_docs) / (1 + found)) + 1
    chosen, rate_at = fit(slim.sparkSession, known, idf, base)
    return [terms[i] for i in chosen], Index(known, chosen, idf, base, rate_at)


def score_documents(docs: DataFrame, labels: DataFrame, learnable: Column | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key (hash of the text), score, evidence.

    ``labels`` has doc_id and toxic; ``learnable``, over its columns, says which rows may be learned from.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    slim = slim.withColumn("text_key", F.xxhash64("text"))
    return search(slim, *learned(slim, labelled(labels, learnable)))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out())
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame, learnable: Column | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    toxic = score_documents(docs, labels, learnable, id_col, text_col).where(F.col("score") >= THRESHOLD)
    name, key = own_name(docs, "toxic_id"), own_name(docs, "toxic_key")
    toxic = stored(toxic.select(F.col("doc_id").alias(name), F.col("text_key").alias(key)).distinct(), "toxic-rows")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(name)) & (
        F.xxhash64(F.coalesce(text_col, F.lit(""))) == F.col(key))
    return docs.join(toxic, same, "left_anti")
