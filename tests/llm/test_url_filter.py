from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from salestream.llm import url_filter
from tests.llm.conftest import rows_of


def brute_rule(url):
    before, mark, after = (url or "").partition("://")
    end = min([after.find(c) for c in "/?#" if c in after] or [len(after)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in after[:end]) if mark else ""
    rest = after[end:] if mark else ""
    path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = []
    for verdict, rule in url_filter.RULES:
        at, _, start = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


ODD = [None, "", "x", "://", "http://", "http://NET/", "http://net", "http://a.net/x?y#z", "http://example.net/en", "http://example.net/en/1",
       "HTTP://WWW.Example.NET/en/?q", "http://badexample.net/en/1", "http://example.com/de/", "http://example.com/de", "ftp://a.org/fr/x",
       "http://org/fr/", "http://xorg/fr/", "http://a.org?x/fr/", "http://a.org#/fr/", "http://a://b.net/c", "http://É.net/ß", "http://a.net:80/",
       "http://u@b.net/", "a\nb://c.net/d\ne", "http://a.net/en/://b.org/fr/"]


def check_rules(spark, urls):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    found = {r["page_id"]: r for r in url_filter.judge(df).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, verdict = brute_rule(url)
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule), url
        assert found[i]["verdict"] == (verdict or found[i]["verdict"])
        assert found[i]["verdict"] in ("allow", "block")
    return found


def test_rules_of_odd_urls(spark):
    check_rules(spark, ODD + ODD)


def corpus():
    pick = random.Random(1)
    word = lambda letters: "".join(pick.choice(letters) for _ in range(8))
    good = [f"http://{word('abcd')}.org/fr/{word('abcd')}" for _ in range(300)]
    bad = [f"http://{word('wxyz')}.net/{word('wxyz')}" for _ in range(300)]
    return good + bad, [f"http://{word('abcd')}.com/{word('abcd')}" for _ in range(40)], [
        f"http://{word('wxyz')}.com/{word('wxyz')}" for _ in range(40)]


def test_the_model_tells_urls_apart(spark):
    training, good, bad = corpus()
    urls = training + good + bad
    found = check_rules(spark, urls)
    n = len(training)
    assert sum(found[n + i]["verdict"] == "allow" for i in range(40)) >= 38
    assert sum(found[n + 40 + i]["verdict"] == "block" for i in range(40)) >= 38


def brute_scores(urls, counts):
    """Mean log-likelihood difference with counts from (text, class) pairs."""
    order, smooth, letters = url_filter.ORDER, url_filter.SMOOTH, len(url_filter.ALPHABET)
    seen = {c: Counter() for c in (True, False)}
    for text, c in counts:
        padded = "^" * order + text
        for at in range(len(text)):
            gram = padded[at:at + order + 1]
            for k in range(order + 1):
                seen[c][gram[order - k:]] += 1
                seen[c]["|", k, gram[order - k:order]] += 1

    def p(c, gram):
        prob = 1 / letters
        for k in range(order + 1):
            prob = (seen[c][gram[order - k:]] + smooth * prob) / (seen[c]["|", k, gram[order - k:order]] + smooth)
        return prob

    out = []
    for text in urls:
        padded = "^" * order + text
        logs = [math.log(p(True, padded[i:i + order + 1]) / p(False, padded[i:i + order + 1])) for i in range(len(text))]
        out.append(sum(logs) / len(logs) if logs else 0.0)
    return out


def test_scores_against_brute_force(spark, monkeypatch):
    training = [("http://ab.org/fr/0", "allow"), ("http://ba.org/fr/00", "allow"), ("http://zz.net/", "block"), ("http://ab.net/q", "block")]
    texts = ["http://ab.com/", "zz", "q*q", ""]
    counts = url_filter.train(spark.createDataFrame(training, "folded string, ruled string"))
    df = spark.createDataFrame([(t,) for t in texts], "folded string").withColumn("name", url_filter.F.col("folded"))
    each = url_filter.grams(df)
    scored = url_filter.score_grams(each.select("gram").distinct(), counts)
    got = dict(rows_of(each.join(scored, "gram").groupBy("name").agg(url_filter.F.avg("score"))))
    want = brute_scores(texts, [(t, v == "allow") for t, v in training])
    for text, score in zip(texts, want, strict=True):
        assert got.get(text, 0.0) == pytest.approx(score, abs=1e-9)


def test_large_models_are_joined_by_shuffle(spark, monkeypatch):
    training, good, bad = corpus()
    df = spark.createDataFrame(list(enumerate(training + good)), "page_id long, url string")
    want = rows_of(url_filter.judge(df), "page_id", "verdict", "score")
    monkeypatch.setattr(url_filter, "BROADCAST_GRAMS", 0)
    assert rows_of(url_filter.judge(df), "page_id", "verdict", "score") == want


def test_folding(spark):
    df = spark.createDataFrame([("HTTP://A1.é/b_C~[x]^\n",)], "url string")
    assert df.select(url_filter.folded(url_filter.F.col("url"))).first()[0] == "http://a0.*/b_c~*x***"


def test_one_class_only_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (2, "http://b.com/")], "page_id long, url string")
    assert rows_of(url_filter.judge(df), "page_id", "verdict") == [(1, "block"), (2, "allow")]
    assert rows_of(url_filter.judge(df.limit(0))) == []
