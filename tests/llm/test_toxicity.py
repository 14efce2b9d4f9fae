from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salestream.llm import toxicity
from salestream.llm.common import table
from tests.conftest import SF_DIR
from tests.llm.conftest import prose, rows_of

LABELS = "doc_id long, quality int, toxic int"


def known(n=300, n_terms=40, seed=1):
    pick = random.Random(seed)
    terms = [np.array(sorted(pick.sample(range(n_terms), pick.randrange(0, 9))), dtype=np.int64) for _ in range(n)]
    counts = [np.array([pick.randrange(1, 5) for _ in t], dtype=np.int64) for t in terms]
    terms += terms[:50]  # ties
    counts += counts[:50]
    toxic = np.array([i % 3 == 0 for i in range(n + 50)])
    keys = np.array([pick.randrange(-10**9, 10**9) for _ in range(n + 50)])
    found = toxicity.Examples(np.arange(n + 50), keys, toxic, np.where(toxic, 1.0, 2.0), terms, counts)
    return found, np.array([1 + pick.random() * 3 for _ in range(n_terms)])


def unit(terms, counts, idf):
    x = np.zeros(len(idf))
    x[terms] = (1 + np.log(counts)) * idf[terms]
    length = np.sqrt((x * x).sum())
    return x / length if length else x


def test_block_max_search_is_exact():
    given, idf = known()
    index = toxicity.Index(given, np.arange(len(idf)), idf, 0.2)
    all_of = np.array([unit(t, n, idf) for t, n in zip(given.terms, given.counts, strict=True)])
    for terms, counts in zip(*(known(60, seed=2)[0].__dict__[x] for x in ("terms", "counts")), strict=True):
        if not len(terms):
            continue
        sims = (all_of @ unit(terms, counts, idf)).round(12)
        kth = np.sort(sims[sims > 0])[::-1][:toxicity.K][-1]
        at, near = index.nearest(terms, counts)
        assert sorted(index.ids[at].tolist()) == np.flatnonzero((sims >= kth) & (sims > 0)).tolist()
        assert np.sort(near) == pytest.approx(np.sort(sims[index.ids[at]]), abs=1e-11)


def brute_scores(docs, labels):
    """Scores of (doc_id, text) rows from {doc_id: toxic}, with dense vectors; samples take every labelled row."""
    texts = [t or "" for _, t in docs]
    rows = {(i, t): labels[i] for i, t in zip((i for i, _ in docs), texts, strict=True) if i in labels}
    at = list(rows)
    y = np.array([rows[r] == 1 for r in at])
    base = y.mean()
    terms_of = lambda t: [x for w in toxicity.words(t) for x in toxicity.beginnings(w)]
    df = Counter(x for _, t in at for x in set(terms_of(t)))
    names = sorted(x for x, n in df.items() if n >= toxicity.LEAST_EXAMPLES)
    number = {x: i for i, x in enumerate(names)}
    n_with = Counter(x for t in texts for x in set(terms_of(t)) if x in number)
    idf = np.array([np.log((1 + len(texts)) / (1 + n_with[x])) + 1 for x in names])

    def raw(text):
        x = np.zeros(len(names))
        for term, n in Counter(t for t in terms_of(text) if t in number).items():
            x[number[term]] = 1 + np.log(n)
        return x * idf

    full = np.array([raw(t) for _, t in at])

    def z_of(rows):
        a, b = ((full[rows & (y == label)] > 0).sum(axis=0) for label in (False, True))
        return np.where(a + b > 0, toxicity.differences(a, b, (rows & ~y).sum(), (rows & y).sum()), -1)

    def share(x, among, chosen):
        unit = lambda m: m / np.maximum(np.sqrt((m * m).sum(axis=-1, keepdims=True)), 1e-300)
        held = full * chosen
        if not (x * chosen).any():
            bare = among & ~held.any(axis=1)
            return (y[bare].sum() + 0.5 * base) / (bare.sum() + 0.5)
        sims = (unit(held) @ unit(x * chosen)).round(12)
        order = [i for i in np.argsort(-sims) if among[i] and sims[i] > 0]
        if not order:
            return base
        kth = sims[order[:toxicity.K][-1]]
        above = [i for i in order if sims[i] > kth]
        ties = [i for i in order if sims[i] == kth]
        vote = {**dict.fromkeys(above, 1.0), **dict.fromkeys(ties, (min(toxicity.K, len(order)) - len(above)) / len(ties))}
        hit = sum(sims[i] * v for i, v in vote.items() if y[i])
        return (hit + 0.5 * base) / (sum(sims[i] * v for i, v in vote.items()) + 0.5)

    keys = {t: k for t, k in brute_scores.keys}
    fold = np.zeros(len(at), dtype=int)
    for label in (False, True):
        distinct = sorted({keys[t] for (_, t), of in zip(at, y, strict=True) if of == label})
        for i, (_, t) in enumerate(at):
            if y[i] == label:
                fold[i] = distinct.index(keys[t]) % toxicity.FOLDS
    toxic_fold = {t: f for (_, t), f, of in zip(at, fold, y, strict=True) if of}
    fold = np.array([toxic_fold.get(t, f) for (_, t), f in zip(at, fold, strict=True)])
    shares = {}
    for cut in toxicity.CUTS:
        out = np.full(len(at), base)
        for f in range(toxicity.FOLDS):
            inside = fold != f
            chosen = z_of(inside) >= cut
            if chosen.any():
                for i in np.flatnonzero(~inside):
                    out[i] = share(full[i], inside, chosen)
        shares[cut] = out
    one = np.ones(len(at))
    z = z_of(np.ones(len(at), dtype=bool))
    cut = min((c for c in toxicity.CUTS if (z >= c).any()),
              key=lambda c: (round(toxicity.cross_loss(shares[c], y, one, fold, base), 6), -c))
    curve = toxicity.calibration(shares[cut], y, one, base)
    every = np.ones(len(at), dtype=bool)
    return [float(np.interp(share(raw(t), every, z >= cut), *curve)) for t in texts]


def test_scores_of_the_given_table_by_brute_force(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    learnable = ~toxicity.held_out()
    of = {r["doc_id"]: r["toxic"] for r in toxicity.labelled(labels, learnable).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    brute_scores.keys = [(r["text"], r["k"]) for r in docs.select(
        F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("k")).collect()]
    want = dict(zip((i for i, _ in rows), brute_scores(rows, of), strict=True))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, labels, learnable).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in want) < 1e-9


def corpus():
    pick = random.Random(4)
    rows, labels = [], []
    for i in range(500):
        toxic = i % 5 == 0
        words = prose(i, 60).split()
        if toxic:
            for word in pick.sample(["vileword", "nastyword", "hatefulness", "hatefully"], 3):
                words.insert(pick.randrange(60), word)
        rows.append((i, " ".join(words)))
        if i < 450:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_scores_separate_held_out_documents(spark, docs_of):
    rows, labels = corpus()
    labelled = spark.createDataFrame(labels, LABELS)
    docs = docs_of(*rows).withColumns({c: F.lit(1) for c in ("toxic_id", "toxic_key", "text_key", "toxic", "score", "terms")})
    scored = toxicity.score_documents(docs, labelled, ~toxicity.held_out()).collect()
    assert len(scored) == 500 and all(0 <= r["score"] <= 1 for r in scored)
    for r in scored:
        assert (r["score"] >= toxicity.THRESHOLD) == (r["doc_id"] % 5 == 0)
        assert r["score"] < 0.7 or (0 < len(r["evidence"]) <= toxicity.K and r["evidence"][0]["toxic"] == 1)
    kept = toxicity.drop_toxic(docs, labelled, ~toxicity.held_out())
    assert rows_of(kept, "doc_id") == sorted(((i,) for i in range(500) if i % 5), key=repr)
    assert kept.columns == docs.columns


def test_labels_of_held_out_rows_change_nothing(spark, docs_of):
    rows, labels = corpus()
    plain = spark.createDataFrame(labels, LABELS)
    turned = plain.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda t: rows_of(toxicity.score_documents(docs_of(*rows[:80]), t, ~toxicity.held_out()), "doc_id", "score")
    assert score(plain) == score(turned)


@pytest.mark.parametrize("most", [2048, 40])
def test_numbering_documents_anew_changes_no_score(spark, docs_of, monkeypatch, most):
    monkeypatch.setattr(toxicity, "MOST_TOXIC", most)
    monkeypatch.setattr(toxicity, "MOST_CLEAN", most)
    rows, labels = corpus()
    # equal texts of both labels tie for the last place
    rows = rows[:200] + [(1000 + i, "quite the same words in all of these texts") for i in range(40)]
    labels = [x for x in labels if x[0] < 200] + [(1000 + i, 1, i % 2) for i in range(40)]
    scores = []
    for number in (lambda i: i, lambda i: 5000 - i):
        docs, of = docs_of(*[(number(i), t) for i, t in rows]), [(number(i), q, y) for i, q, y in labels]
        found = toxicity.score_documents(docs, spark.createDataFrame(of, LABELS)).collect()
        scores.append({number(r["doc_id"]): r["score"] for r in found})
    assert scores[0] == scores[1]
    assert len({scores[0][1000 + i] for i in range(40)}) == 1


def test_edges(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "x" * 100_000), (3, "y"), (3, "y"), (None, "z")]
    few = spark.createDataFrame([(1, 0, 1), (2, 0, None), (3, 0, 0), (3, 0, 1)], LABELS)
    found = toxicity.score_documents(docs_of(*rows), few).collect()
    assert len(found) == 6 and all(r["score"] == 1.0 and r["evidence"] == [] for r in found)  # both ids are toxic
    for docs, labels in ((docs_of(*rows), few.limit(0)), (docs_of(*rows).limit(0), few)):
        assert all(r["score"] == 0.0 for r in toxicity.score_documents(docs, labels).collect())
    assert toxicity.drop_toxic(docs_of(*rows), few.limit(0)).count() == 6


@pytest.mark.parametrize("texts", [("vile words", "kind words"), ("same", "same"), ("", None), ("vile", "")])
def test_one_example_of_each_label(spark, docs_of, texts):
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, 0)], LABELS)
    found = toxicity.score_documents(docs_of((1, texts[0]), (2, texts[1]), (3, "vile"), (4, "other")), labels).collect()
    assert len(found) == 4 and all(0 <= r["score"] <= 1 for r in found)


def test_very_long_texts(spark, docs_of):
    rows, labels = corpus()
    rows = [*rows[:100], (900, f"{prose(900, 30_000)} vileword nastyword"), (901, prose(901, 30_000))]
    found = {r["doc_id"]: r["score"] for r in toxicity.score_documents(
        docs_of(*rows), spark.createDataFrame(labels[:100], LABELS)).collect()}
    assert len(found) == 102 and found[900] >= found[901]


def test_terms():
    assert toxicity.beginnings("abcdefgh") == ["abcdefgh", "abcd*", "abcde*", "abcdef*"]
    long = ["w" * 60, "w" * 60 + "x", "w" * 40]
    assert len({toxicity.beginnings(w)[0] for w in long}) == 3 and all(len(toxicity.beginnings(w)[0]) <= 40 for w in long)
    assert toxicity.words("It's A_B 12 É") == ["it", "s", "a", "b", "12", "é"]


def few_toxic():
    """Six learnable toxic rows, in which each of four words stands three times."""
    vile = ["vileword", "nastyword", "hatefulness", "ugliness"]
    rows, labels = [], []
    for i in range(52):
        more = list(itertools.combinations(vile, 2))[i] if i < 6 else []
        rows.append((i, " ".join([*prose(i, 40).split(), *more])))
        labels.append((i, 1, int(i < 6)))
    rows += [(100 + i, f"{prose(100 + i, 40)} {a} {b}") for i, (a, b) in enumerate(itertools.combinations(vile, 2))]
    rows += [(200 + i, prose(200 + i, 40)) for i in range(20)]
    return rows, labels


def test_terms_of_few_toxic_examples(spark, docs_of):
    rows, labels = few_toxic()
    scores = {r["doc_id"]: r for r in toxicity.score_documents(docs_of(*rows), spark.createDataFrame(labels, LABELS)).collect()}
    toxic = [scores[i]["score"] for i in range(100, 106)]
    assert min(toxic) > max(scores[i]["score"] for i in range(200, 220))
    assert all(scores[i]["evidence"][0]["toxic"] == 1 for i in range(100, 106))


def test_prior_counts_alike_however_many_rows_an_example_stands_for(spark, docs_of, monkeypatch):
    rows, labels = few_toxic()
    labelled = spark.createDataFrame(labels, LABELS)
    score = lambda: {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs_of(*rows), labelled).collect()}
    want, real = score(), toxicity.choose_examples

    def many(slim, found):
        sample, rates = real(slim, found)
        return sample, {y: rate * 100 for y, rate in rates.items()}

    monkeypatch.setattr(toxicity, "choose_examples", many)
    assert score() == pytest.approx(want)


def test_calibration():
    shares = np.array([0.1] * 80 + [0.3] * 20 + [0.65] * 17 + [0.9] * 30)
    toxic = np.array([False] * 80 + [False] * 14 + [True] * 6 + [True] * 15 + [False] * 2 + [True] * 30)
    at, rate = toxicity.calibration(shares, toxic, np.ones(len(shares)), 0.3)
    assert (np.diff(at) > 0).all() and (np.diff(rate) >= 0).all()
    assert np.interp(0.65, at, rate) == pytest.approx(15 / 17, abs=0.03)
    falling = toxicity.pools(np.array([0.1, 0.2, 0.2, 0.4]), np.array([1, 0, 1, 0]), np.ones(4))
    assert falling.tolist() == [[pytest.approx(0.225), 0.5, 4]]


def test_the_driver_does_not_vote(spark, monkeypatch):
    """Cross-validation, the larger part of the driver's memory before, runs in tasks; shares are those of each example alone."""
    rows = [(i, prose(i, 60, 300 + 40 * (i % 3))) for i in range(90)]
    slim = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_key", F.xxhash64("text"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")

    def refuse(*args):
        raise AssertionError("votes on the driver")

    monkeypatch.setattr(toxicity, "voted", refuse)
    vocabulary, index = toxicity.learned(slim, labels)
    assert vocabulary and index.rate_at is not None


def test_the_driver_reads_no_texts_of_examples(spark, monkeypatch):
    """Words are found and counted in tasks; what the driver learns is what it learned from the texts themselves."""
    rows = [(i, prose(i % 80, 60, 300 + 40 * (i % 3))) for i in range(90)] + [(90, ""), (91, "x" * 700_000)]
    slim = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_key", F.xxhash64("text"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(92)], "doc_id long, toxic int")
    held = Counter(t for _, text in rows for t in {t for w in toxicity.words(text) for t in toxicity.beginnings(w)})
    want = [t for t, n in sorted(held.items(), key=lambda x: (-x[1], x[0])) if n >= toxicity.LEAST_EXAMPLES]
    counted = {i: Counter(t for w in toxicity.words(text) for t in toxicity.beginnings(w)) for i, text in rows}
    seen, real = [], toxicity.fit

    def fit(spark, known, *more):
        seen.append(known)
        return real(spark, known, *more)

    def refuse(*args):
        raise AssertionError("reads texts on the driver")

    monkeypatch.setattr(toxicity, "fit", fit)
    monkeypatch.setattr(toxicity, "words", refuse)
    toxicity.learned(slim, labels)
    known, = seen
    assert sorted(known.ids.tolist()) == list(range(92)) and (np.diff(known.text_keys) >= 0).all()
    for i, terms, counts in zip(known.ids.tolist(), known.terms, known.counts, strict=True):
        found = {want[t]: n for t, n in zip(terms.tolist(), counts.tolist(), strict=True)}
        assert found == {t: n for t, n in counted[i].items() if t in want}
    monkeypatch.undo()
    assert toxicity.candidate_terms(slim) == want
    assert toxicity.candidate_terms(slim.where("doc_id = 3")) == sorted(counted[3])
    posts, term = toxicity.Postings.of(known, len(want)), np.concatenate(known.terms)
    order = np.argsort(term, kind="stable")
    of = np.repeat(np.arange(92), [len(t) for t in known.terms])
    assert (posts.sizes == np.bincount(term, minlength=len(want))).all()
    assert (posts.row == of[order]).all() and (posts.count == np.concatenate(known.counts)[order]).all()
