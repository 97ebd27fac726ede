import math
from collections import Counter, defaultdict

import pandas as pd
from odd import FOLDER
from pyspark.sql import functions as F

from massloom.llm.url_filter import ORDER, PAD, RULES, calibrate, filter_urls, log_ratios, rule_of


def plain(url):
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    cut = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), path[:cut]


def plain_rule(host, path):
    fits = [(len(r), r, v) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.org", "https://a.example.org/es/1?x=/de/", "https://xexample.org/es/1", "https://example.org/en/12#a",
        "https://b.com/fr/://c.org/", "http://a.com?q=/fr/", "http://a.com/de/", "http://org/", "http://m.net/en/1", "http://É.com/fr/"]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", 5) for i, u in enumerate(URLS)], "page_id long, url string, host string, uid int")
    for r in filter_urls(pages).collect():
        host, path = plain(URLS[r.page_id])
        rule, says = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == says if rule else r.verdict in ("allow", "block")


def test_whole_table(spark):
    got = {r.page_id: r for r in filter_urls(spark.read.parquet(f"{FOLDER}/pages.parquet")).collect()}
    for i, u in pd.read_parquet(f"{FOLDER}/pages.parquet")[["page_id", "url"]].itertuples(index=False):
        assert (got[i].host, got[i].path) == plain(u) and got[i].rule == plain_rule(*plain(u))[0]


def test_models_equal_the_formula(spark):
    good, bad, ask = ["abcab", "abd"], ["xbx", "bbb"], "abx"
    grams = lambda u: [(PAD * ORDER + u + PAD)[i : i + ORDER + 1] for i in range(len(u) + 1)]
    counts = defaultdict(lambda: [0, 0])
    for k, urls in enumerate((good, bad)):
        for u in urls:
            for g in grams(u):
                counts[g][k] += 1
    for g in grams(ask):
        counts[g]
    got = {r.gram: r.ratio for r in log_ratios(spark.createDataFrame([(g, *c) for g, c in counts.items()], "gram string, good long, bad long")).collect()}

    def p(k, gram, order):
        if order < 0:
            return 1 / 256
        context = gram[ORDER - order : ORDER]
        follow = Counter()
        for g, c in counts.items():
            if g[ORDER - order : ORDER] == context and c[k]:
                follow[g[-1]] += c[k]
        low = p(k, gram, order - 1)
        return low if not follow else (follow[gram[-1]] + len(follow) * low) / (sum(follow.values()) + len(follow))

    assert set(got) == set(counts)
    for g in counts:
        assert math.isclose(got[g], math.log(p(0, g, ORDER)) - math.log(p(1, g, ORDER)), abs_tol=1e-12)


def test_the_cut_separates_held_out_addresses(spark):
    rows = [(0, "allow", 1.0), (0, "allow", 0.8), (0, "block", -0.5), (0, "block", 0.2), (1, "block", 9.0), (0, None, 5.0)]
    assert 0.2 < calibrate(spark.createDataFrame(rows, "fold long, label string, score double")) <= 0.8


def test_models_judge_what_no_rule_decides(spark):
    rows = [(i, f"http://good{i % 7}.com/fr/news{i}") for i in range(60)] + [(100 + i, f"http://pills{i % 7}.com/de/buy{i}") for i in range(60)]
    rows += [(1000, "http://good3.net/news8"), (1001, "http://pills3.net/buy8"), (1001, "http://pills3.net/buy8")]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string")).where(F.col("page_id") >= 1000).collect()
    assert sorted((r.page_id, r.verdict) for r in got) == [(1000, "allow"), (1001, "block"), (1001, "block")]


def test_no_rows_and_no_training(spark):
    assert filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    got = filter_urls(spark.createDataFrame([(None, "http://x.net/"), (1, None)], "page_id long, url string")).collect()
    assert {r.verdict for r in got} == {"allow"}


def test_first_listed_rule_wins_a_tie(spark):
    row = spark.range(1).select(F.lit("a.com").alias("h"), F.lit("/x").alias("p"))
    rules = (("block", "a.com/"), ("allow", "a.com/"))
    name, verdict = rule_of(F.col("h"), F.col("p"), rules)
    assert row.select(verdict).first()[0] == "block"
