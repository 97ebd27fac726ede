"""URL filter: listed rules first, else two character models that were trained on accepted and
rejected addresses. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import kept, lowered, with_row_id

#: The rules that the registered query is asked to apply.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
ORDER = 4  # longest context of the models, in characters
PAD = "\x02"


def host_of(url: Column) -> Column:
    return F.coalesce(lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null if none fits; among equals the first listed.
    A rule is host, then path from its first slash on."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(reversed(rules), key=lambda r: len(r[1])):  # the longest is tested first
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _grams(urls: DataFrame) -> DataFrame:
    """Each character with the ``ORDER`` characters before it, as one string per place."""
    padded = F.concat(F.lit(PAD * ORDER), "url", F.lit(PAD))
    at = F.explode(F.sequence(F.lit(1), F.char_length("url") + 1)).alias("at")
    return urls.select(*[c for c in urls.columns if c != "url"], padded.alias("p"), at).select(
        *[c for c in urls.columns if c != "url"], F.substr("p", F.col("at"), F.lit(ORDER + 1)).alias("gram"))


def log_ratios(grams: DataFrame) -> DataFrame:
    """(gram, ratio): log probability of a gram's last character given those before it, in the
    accepted model less that in the rejected one.

    ``grams`` has (gram, good, bad): counts in either training set, 0 for grams that are only to be
    scored. Witten-Bell smoothing: an order's estimate is mixed with that of the next shorter
    context in proportion to how many different characters followed the context; a context never
    seen leaves the shorter one's estimate as it is. The shortest falls back to 1 in 256.
    """
    level = None
    for k in range(ORDER + 1):
        mine = grams.groupBy(F.right("gram", F.lit(k + 1)).alias("g")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        mine = mine.withColumn("c", F.left("g", F.lit(k)))
        context = mine.groupBy("c").agg(
            F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
            F.count_if(F.col("good") > 0).alias("t_good"), F.count_if(F.col("bad") > 0).alias("t_bad"))
        mine = mine.join(context, "c")
        if level is None:
            mine = mine.withColumns({"low_good": F.lit(1 / 256), "low_bad": F.lit(1 / 256)})
        else:
            mine = mine.withColumn("s", F.right("g", F.lit(k))).join(level, "s")
        mix = lambda x: F.when(F.col(f"n_{x}") == 0, F.col(f"low_{x}")).otherwise(
            (F.col(x) + F.col(f"t_{x}") * F.col(f"low_{x}")) / (F.col(f"n_{x}") + F.col(f"t_{x}")))
        level = mine.select(F.col("g").alias("s"), mix("good").alias("low_good"), mix("bad").alias("low_bad"))
    return level.select(F.col("s").alias("gram"), (F.log("low_good") - F.log("low_bad")).alias("ratio"))


def url_scores(urls: DataFrame) -> DataFrame:
    """(uid, score, fold, label) of ``urls`` (uid, url, label): mean log ratio per character.

    ``label`` is allow, block or null. A fifth of the labelled addresses, by hash, is kept out of
    training and carries fold 0. Null urls count as empty.
    """
    urls = urls.withColumn("url", F.coalesce("url", F.lit(""))).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(5)))
    train = F.col("fold") != 0
    grams = kept(
        _grams(urls.select("url", "fold", "label")).groupBy("gram").agg(
            F.count_if((F.col("label") == "allow") & train).alias("good"), F.count_if((F.col("label") == "block") & train).alias("bad")),
        "url-grams")
    ratios = kept(log_ratios(grams), "url-ratios")
    # a url's equal grams are one row; the rest is one equi join, which Spark splits where a gram is hot
    places = _grams(urls.select("uid", "url")).groupBy("uid", "gram").agg(F.count("*").alias("n"))
    mean = places.join(ratios, "gram").groupBy("uid").agg((F.sum(F.col("n") * F.col("ratio")) / F.sum("n")).alias("score"))
    return urls.select("uid", "fold", "label").join(mean, "uid", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def calibrate(scores: DataFrame, places: int = 2) -> float:
    """The cut with the largest mean of both classes' hit rates on the held-out labelled addresses.

    Scores are counted in bins of 10 ** -places within [-20, 20], so the driver gets 4,001 rows at
    most. Without held-out addresses of both labels the cut is 0.
    """
    bins = scores.where((F.col("fold") == 0) & F.col("label").isNotNull()).groupBy(
        F.round(F.greatest(F.least("score", F.lit(20.0)), F.lit(-20.0)), places).alias("bin")).agg(
        F.count_if(F.col("label") == "allow").alias("good"), F.count_if(F.col("label") == "block").alias("bad"))
    rows = sorted((r.bin, r.good, r.bad) for r in bins.collect())
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return 0.0
    best, cut, left, lost, before = -1.0, 0.0, 0, 0, rows[0][0] - 10**-places
    for at, g, b in rows:  # accepting what scores at least ``at``; the cut is half way to the bin before
        if (rate := (good - lost) / good + left / bad) > best:
            best, cut = rate, (at + before) / 2
        left, lost, before = left + b, lost + g, at
    return cut


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row.

    Addresses that a rule decides are the training sets; the others get the models' verdict: allow
    from the calibrated cut on. With no accepted or no rejected address the models say nothing:
    allow. Null urls and urls without ``://`` have empty host and path. Repeated rows are judged
    alike, each for itself.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = kept(with_row_id(rows.withColumns({"rule": rule, "label": says})), "url-rows")
    scores = kept(url_scores(rows.select("uid", "url", "label")), "url-scores")
    have = {r.label for r in scores.select("label").distinct().collect()}
    cut = calibrate(scores) if {"allow", "block"} <= have else float("-inf")
    judged = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return rows.join(scores.select("uid", "score"), "uid").select(
        "page_id", "host", "path", "rule", F.coalesce("label", judged).alias("verdict"), "score")
