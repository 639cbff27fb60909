"""URL filter: host and path rules, and a ratio of character language models where no rule fits.

Urls that a rule allows or blocks train two Markov models of variable order: the probability of a character after up
to ``ORDER`` others, each order smoothed by the one below (Witten-Bell), the lowest by equal chances.  A url's
score is the difference of its log-likelihoods under both models, divided by its length.  A part of the
ruled urls takes no part in the training; the score that separates their two kinds best is the threshold.

All of it is DataFrame operations.  Models are tables of n-grams; only n-grams that occur in some url are in them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import staged

ORDER = 5
SCORE_UNIT = 1_000_000_000
BINS = 100
WIDEST = 2_000
PAD, STOP = "^", "$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """Fits ``host`` and its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.endswith(F.col("host"), F.lit("." + self.host))
        return host & F.startswith(F.col("path"), F.lit(self.path))


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    url = url.cast("string")
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule (the longest that fits, else null), ruling (its verdict), calibrates, key.

    About a fifth of the ruled urls, by a hash of the url, calibrate instead of training.
    """
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), host.alias("host"), path.alias("path"))
    longest = sorted(rules, key=lambda r: -len(r.name))

    def first(value) -> Column:
        return F.coalesce(F.lit(None).cast("string"), *[F.when(r.fits(), F.lit(value(r))) for r in longest])

    calibrates = F.substring(F.md5(F.col("url").cast("binary")), 1, 1).isin("0", "1", "2")
    return rows.select(
        "page_id", "host", "path", first(lambda r: r.name).alias("rule"), first(lambda r: r.verdict).alias("ruling"),
        F.coalesce(calibrates, F.lit(False)).alias("calibrates"),
    )


def _grams(rows: DataFrame, order: int) -> DataFrame:
    """Every character of host and path, and the end, with the ``order`` characters before it."""
    text = F.concat(F.lit(PAD * order), "host", "path", F.lit(STOP))
    rows = rows.withColumn("text", text)
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(1), F.length("text") - order)))
    return rows.withColumn("gram", F.substring("text", F.col("i"), F.lit(order + 1))).drop("text", "i", "host", "path")


def models(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, ratio: the difference of log-probabilities, in units of 1 / ``SCORE_UNIT``, of all n-grams of any url."""
    trains = ~F.col("calibrates")
    grams = _grams(rows, order).groupBy("gram").agg(
        *[
            F.sum(F.when(trains & (F.col("ruling") == verdict), 1).otherwise(0)).alias(n)
            for n, verdict in (("a", "allow"), ("b", "block"))
        ]
    )
    counts = [staged(grams, "grams")]
    for k in range(order - 1, -1, -1):
        shorter = F.substring("gram", 2, k + 1).alias("gram")
        counts.insert(0, counts[0].select(shorter, "a", "b").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    smoothed = None
    for k, level in enumerate(counts):
        # The followers of a context are as many as there are characters.
        followers = F.collect_list(F.struct("gram", "a", "b")).alias("g")
        sums = [F.sum(n).alias(f"n{n}") for n in "ab"] + [F.sum(F.signum(n)).alias(f"t{n}") for n in "ab"]
        level = level.groupBy(F.substring("gram", 1, k).alias("context")).agg(F.count("*").alias("v"), followers, *sums)
        level = level.select("v", "na", "nb", "ta", "tb", F.explode("g").alias("g")).select("*", "g.*")
        if smoothed is None:
            level = level.withColumns({"qa": 1.0 / F.col("v"), "qb": 1.0 / F.col("v")})
        else:
            level = level.withColumn("below", F.substring("gram", 2, k)).join(smoothed, "below")

        def blended(x: str) -> Column:
            n, t, q = F.col(f"n{x}"), F.col(f"t{x}"), F.col(f"q{x}")
            return F.when(n > 0, (F.col(x) + t * q) / (n + t)).otherwise(q)

        smoothed = level.select(F.col("gram").alias("below"), blended("a").alias("qa"), blended("b").alias("qb"))
    ratio = F.round((F.log("qa") - F.log("qb")) * SCORE_UNIT).cast("long")
    return smoothed.select(F.col("below").alias("gram"), ratio.alias("ratio"))


def scored(rows: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """host, path, score: the sum of the ratios of a distinct host and path, divided by their number."""
    texts = rows.select("host", "path").distinct()
    grams = _grams(texts.select("*", F.col("host").alias("of_host"), F.col("path").alias("of_path")), order)
    sums = grams.join(model, "gram").groupBy("of_host", "of_path").agg(F.sum("ratio").alias("s"), F.count("*").alias("n"))
    return sums.select(F.col("of_host").alias("host"), F.col("of_path").alias("path"), (F.col("s") / F.col("n") / SCORE_UNIT).alias("score"))


def threshold(rows: DataFrame) -> DataFrame:
    """One row, cut: the score, in steps of 1 / ``BINS``, that tells calibrating urls of both verdicts apart best.

    Best is the largest sum of the shares on the right side; then the smallest distance from 0, then the smaller
    score.  Without calibrating urls of both verdicts it is 0.
    """
    step = F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), F.floor(F.col("score") * BINS).cast("int")))
    known = rows.where("calibrates AND ruling IS NOT NULL").select(step.alias("step"), "ruling")
    per_step = known.groupBy("step").agg(
        F.count_if(F.col("ruling") == "allow").alias("a"), F.count_if(F.col("ruling") == "block").alias("b")
    )
    # One row per step, of which there are 2 * WIDEST + 1 at most.
    whole = Window.partitionBy(F.lit(1))
    below = Window.partitionBy(F.lit(1)).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)

    def share_below(n: str) -> Column:
        return F.coalesce(F.sum(n).over(below), F.lit(0)) / F.nullif(F.sum(n).over(whole), F.lit(0))

    shares = per_step.select("step", (1 - share_below("a") + share_below("b")).alias("right"))
    best = F.max_by("step", F.struct(F.round("right", 9), -F.abs(F.col("step")), -F.col("step")))
    return shares.where("right IS NOT NULL").agg(F.coalesce(best / BINS, F.lit(0.0)).alias("cut"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, order: int = ORDER) -> DataFrame:
    """page_id, host, path, rule, verdict, score, cut of every row.

    The verdict is the rule's; without a rule it is allow if score >= cut, else block.  A null url, or one without
    ``://``, has an empty host and path and is judged by the models like any other.  Without a ruled url all
    scores and the cut are 0, which allows.  Repeated rows get equal verdicts.
    """
    rows = ruled(pages, rules)
    scores = staged(scored(rows, models(rows, order), order), "url-scores")
    judged = rows.join(scores, ["host", "path"])
    cut = threshold(judged).collect()[0]["cut"]  # one number
    verdict = F.coalesce("ruling", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score", F.lit(cut).alias("cut"))
