"""URL filter: host rules, and a character language-model ratio for the rest (DataFrame functions only).

Urls that a rule allows or blocks train two smoothed variable-order Markov models over characters, one of
accepted and one of rejected urls. Characters are folded to a small alphabet, so a model has at most
``len(ALPHABET) ** (ORDER + 1)`` entries whatever the input. The probability of a character mixes all
context lengths from none to ``ORDER``: each longer context that was seen n times has weight n / (n + SMOOTH).

A url's score is the mean over its characters of log P(accepted) - log P(rejected). It is computed once
for each distinct gram, and urls look their grams up. The threshold is calibrated on a third of the training
urls that train no counts: the middle of the first of ``BINS`` score bins that gives the best balance of kept accepted
and stopped rejected urls.

Defined results: a null url, or one without ``://``, has empty host and path; its text is still scored,
and an empty one scores 0. If either class has no training url, the method allows all. Rows that repeat an
id are judged each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salestream.llm.common import fits_broadcast, lower_ascii, stored, table

#: Verdict and rule (host and start of the path); the longest that fits wins.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Letters, one digit for all, marks that urls are made of, and ``*`` for anything else; ``^`` is the start.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0:/.?=&#-_%+~,*^"
ORDER = 3
SMOOTH = 5.0
BINS = 200
#: Scored grams up to this many rows are broadcast; more are joined by shuffle.
BROADCAST_GRAMS = 200_000


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_rules(pages: DataFrame, id_col: str, url_col: str, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruled (verdict of the rule, or null)."""
    found = pages.select(
        F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule = ruled = F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda x: len(x[1])):  # the longest last, so that it is asked first
        host, slash, start = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        ruled = F.when(fits, F.lit(verdict)).otherwise(ruled)
    return found.select("*", rule.alias("rule"), ruled.alias("ruled"))


def folded(url: Column) -> Column:
    """The url in the model's alphabet."""
    digits = F.regexp_replace(lower_ascii(url), "[1-9]", "0")
    kept = "".join("\\" + c if c in "-^.?+*" else c for c in ALPHABET if c not in "*^")
    return F.regexp_replace(digits, f"(?s)[^{kept}]", "*")


def grams(df: DataFrame, text: str = "folded") -> DataFrame:
    """One row for each character of ``text``: the character after its ORDER predecessors (``^`` before the start)."""
    padded = F.concat(F.lit("^" * ORDER), F.col(text))
    at = F.explode(F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))))
    return df.withColumn("padded", padded).withColumn("at", at).withColumn(
        "gram", F.expr(f"substring(padded, at, {ORDER + 1})")).drop("padded", "at", text)


def train(training: DataFrame) -> DataFrame:
    """gram, accepted, rejected: how often each gram of full length occurs in either class of (folded, ruled)."""
    allow = F.col("ruled") == "allow"
    # partial sums combine before the shuffle, so a hot host is no hot task
    return grams(training).groupBy("gram").agg(
        F.sum(allow.cast("long")).alias("accepted"), F.sum((~allow).cast("long")).alias("rejected"))


def score_grams(wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """gram, score for the distinct grams ``wanted``: log-likelihood difference of the last character."""
    out = wanted
    classes = ("accepted", "rejected")
    for c in classes:
        out = out.withColumn(f"p_{c}", F.lit(1.0 / len(ALPHABET)))
    for order in range(ORDER + 1):
        tail = f"right(gram, {order + 1})"
        joint = counts.groupBy(F.expr(tail).alias("tail")).agg(*[F.sum(c).alias(f"n_{c}") for c in classes])
        context = F.expr(f"substring(tail, 1, {order})")
        total = joint.groupBy(context.alias("context")).agg(*[F.sum(f"n_{c}").alias(f"t_{c}") for c in classes])
        out = (
            out.withColumn("tail", F.expr(tail)).withColumn("context", context)
            .join(joint, "tail", "left").join(total, "context", "left")
            .select("gram", *[
                ((F.coalesce(f"n_{c}", F.lit(0)) + SMOOTH * F.col(f"p_{c}"))
                 / (F.coalesce(f"t_{c}", F.lit(0)) + SMOOTH)).alias(f"p_{c}") for c in classes])
        )
    return out.select("gram", (F.log("p_accepted") - F.log("p_rejected")).alias("score"))


def threshold(scored: DataFrame) -> float:
    """The score from which urls are allowed, from rows (score, ruled) that trained no counts."""
    bounds = scored.agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    if bounds["low"] is None or bounds["low"] == bounds["high"]:
        return 0.0
    low, width = bounds["low"], (bounds["high"] - bounds["low"]) / BINS
    rows = (
        scored.groupBy(F.least(F.floor((F.col("score") - low) / width), F.lit(BINS - 1)).alias("bin"))
        .agg(F.sum((F.col("ruled") == "allow").cast("long")).alias("accepted"),
             F.sum((F.col("ruled") == "block").cast("long")).alias("rejected"))
        .collect()  # BINS rows at most
    )
    accepted, rejected = [0] * BINS, [0] * BINS
    for row in rows:
        accepted[row["bin"]], rejected[row["bin"]] = row["accepted"], row["rejected"]
    if not sum(accepted) or not sum(rejected):
        return 0.0
    balance = [sum(accepted[b:]) / sum(accepted) + sum(rejected[:b]) / sum(rejected) for b in range(BINS + 1)]
    best = max(balance)
    good = [b for b in range(BINS + 1) if balance[b] >= best - 1e-12]
    return low + width * (good[0] + good[-1]) / 2


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, url, host, path, rule, verdict, score (mean log-likelihood difference)."""
    # distinct urls: a url that holds a third of all rows is scored once
    ruled = with_rules(pages, id_col, url_col, rules)
    urls = stored(
        ruled.groupBy("url").agg(F.first("ruled").alias("ruled"))
        .withColumn("folded", folded(F.col("url")))
        .withColumn("held", F.pmod(F.xxhash64("url"), F.lit(3)) == 0),
        "urls")
    counts = stored(train(urls.where("ruled IS NOT NULL AND NOT held").select("folded", "ruled")), "gram-counts")
    url_grams = grams(urls.select("url", "folded"))
    seen = stored(score_grams(url_grams.select("gram").distinct(), counts), "gram-scores")
    model = F.broadcast(seen) if fits_broadcast(seen, BROADCAST_GRAMS) else seen
    scores = url_grams.join(model, "gram").groupBy("url").agg(F.round(F.avg("score"), 9).alias("score"))
    scored = stored(
        urls.join(scores, "url", "left").select("url", "ruled", "held", F.coalesce("score", F.lit(0.0)).alias("score")),
        "url-scores")
    have = scored.where("ruled IS NOT NULL").agg(F.count_distinct("ruled")).first()[0]
    cut = threshold(scored.where("ruled IS NOT NULL AND held")) if have == 2 else float("-inf")
    verdict = F.coalesce("ruled", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return ruled.drop("ruled").join(
        scored.select("url", "score", verdict.alias("verdict")), "url")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")
