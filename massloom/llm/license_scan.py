"""License scan: TF-IDF cosine of notices and licence files to templates, then inheritance from the
nearest ancestor directory. DataFrame functions only."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import kept, lowered, release, with_row_id
from massloom.llm.license_texts import TEMPLATES

#: Least cosine of a match.
LEAST = 0.75
LICENSE_FILE = r"(?i)^(un)?licen[cs]e([.-].*)?$|^copying([.-].*)?$|^notice([.-].*)?$"
_SPLIT, _SENTENCE = "[^a-z0-9]+", r"\n+|(?<=[.!?])\s+"
#: Paragraphs are parted by lines without a letter or digit, such as the bare markers of a comment.
_PARAGRAPH = r"\n(?:[^A-Za-z0-9\n]*\n)+"


def _words(text: Column) -> Column:
    return F.filter(F.split(lowered(text), _SPLIT), lambda w: w != "")


def _plain(text: str) -> list[str]:
    return [w for w in re.split(_SPLIT, text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]


def word_documents(bodies: DataFrame) -> DataFrame:
    """(word, texts): how many texts have each word."""
    seen = bodies.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
    return kept(seen.groupBy("word").agg(F.count("*").alias("texts")), "word-documents")


def idf_of(texts: DataFrame, n: int, terms: Sequence[str]) -> dict[str, float]:
    """Inverse document frequency of the templates' terms over all ``n`` texts."""
    # broadcast: the terms of the given templates, a few hundred
    listed = F.broadcast(texts.sparkSession.createDataFrame([(t,) for t in terms], "word string"))
    counts = {r["word"]: r["texts"] for r in texts.join(listed, "word").collect()}
    return {t: math.log((n + 1) / (counts.get(t, 0) + 1)) + 1 for t in terms}


def template_vectors(templates: Mapping[str, Sequence[str]], idf: Mapping[str, float]) -> list[tuple[str, int, str, float]]:
    """(license, template, term, weight) of unit length."""
    out, number = [], 0
    for name, texts in sorted(templates.items()):
        for text in texts:
            raw = {w: n * idf[w] for w, n in Counter(_plain(text)).items()}
            length = math.sqrt(sum(x * x for x in raw.values()))
            out += [(name, number, w, x / length) for w, x in sorted(raw.items())]
            number += 1
    return out


def leading_terms(vectors: Sequence[tuple[str, int, str, float]], least: float) -> list[str]:
    """Terms of which a text with cosine ``least`` to some template has at least one: the template's
    remaining terms are too light to reach it, whatever the text."""
    found = set()
    for number in {v[1] for v in vectors}:
        mine = sorted(((x, w) for _, k, w, x in vectors if k == number))
        mass = 0.0
        for x, w in mine:
            mass += x * x
            if mass >= least * least * (1 - 1e-9):
                found.add(w)
    return sorted(found)


def notices(bodies: DataFrame, whole: Column, templates: Mapping[str, Sequence[str]], least: float) -> DataFrame:
    """(uid, license, score, opening): best matching template of every text of ``bodies``(uid, text)
    that has one.

    Every sentence, line and paragraph of the text is compared, and the text as one where ``whole``
    holds: a header's lines are one paragraph, however they are broken and marked. ``opening``: the
    first sentence or paragraph has a match. Ties go to the smaller license name.
    """
    terms = sorted({w for texts in templates.values() for t in texts for w in _plain(t)})
    texts, n = word_documents(bodies), bodies.count()
    idf = idf_of(texts, n, terms)
    vectors = template_vectors(templates, idf)
    leads = F.array(*[F.lit(t) for t in leading_terms(vectors, least)])
    spark = bodies.sparkSession
    sentences = F.filter(F.split("text", _SENTENCE), lambda s: F.trim(s) != "")
    numbered = lambda parts: F.transform(parts, lambda s, i: F.struct((i == 0).alias("opens"), s.alias("said")))
    # a paragraph of one sentence and line is among the sentences
    longer = F.filter(numbered(F.split("text", _PARAGRAPH)), lambda p: p["said"].rlike(_SENTENCE))
    file = F.when(whole, F.array(F.struct(F.lit(False).alias("opens"), F.col("text").alias("said")))).otherwise(F.array())
    parts = bodies.select("uid", F.posexplode(F.concat(numbered(sentences), longer, file)).alias("part", "p"))
    words = parts.select("uid", "part", "p.opens", _words(F.col("p.said")).alias("words")).where(F.arrays_overlap("words", leads))
    # the largest share that each term held has of any template bounds the mass held of every template
    share: dict[str, float] = {}
    for _, _, w, x in vectors:
        share[w] = max(share.get(w, 0.0), x * x)
    listed = F.create_map(*[F.lit(v) for pair in share.items() for v in pair])
    held = F.array_intersect("words", F.array(*[F.lit(t) for t in terms]))
    words = words.where(F.aggregate(held, F.lit(0.0), lambda acc, w: acc + F.try_element_at(listed, w)) >= least * least * (1 - 1e-9))
    words = words.select("uid", "part", "opens", F.explode("words").alias("word"))
    counts = kept(words.groupBy("uid", "part", "opens", "word").agg(F.count("*").alias("n")), "notice-words")
    # every word weighs as it does over all texts; the words of candidate sentences are looked up
    wanted = kept(texts.join(counts.select("word").distinct(), "word", "left_semi"), "wanted-words")
    release(texts)
    idf_column = F.log(F.lit(float(n + 1)) / (F.col("texts") + 1)) + 1
    weighed = counts.join(wanted, "word").withColumn("x", F.col("n") * idf_column)
    length = weighed.groupBy("uid", "part").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    vector = spark.createDataFrame(vectors, "license string, template int, word string, weight double")
    dots = weighed.join(vector, "word").groupBy("uid", "part", "opens", "license", "template").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    scored = dots.join(length, ["uid", "part"]).withColumn("score", F.round(F.col("dot") / F.col("length"), 9)).where(F.col("score") >= least)
    best = F.min_by("license", F.struct(-F.col("score"), F.col("license")))
    return scored.groupBy("uid").agg(best.alias("license"), F.max("score").alias("score"), F.bool_or("opens").alias("opening"))


def license_scan(
    files: DataFrame, path: Column, text: str = "text", doc_id: str = "doc_id", templates: Mapping[str, Sequence[str]] | None = None,
    least: float = LEAST, opening_counts: bool = False,
) -> DataFrame:
    """(doc_id, path, license, basis, score, from_dir) of every row.

    A file's own notice decides (basis ``notice``); else the licence file in its directory or the
    nearest ancestor that has one (``inherited``, with that directory and match); else nothing
    (``none``). Licence files are those named so, and with ``opening_counts`` those whose first
    sentence or paragraph is a notice; the best match of a directory's licence files is the
    directory's licence. The BSD texts differ only as a whole, so in a header both are BSD-3-Clause.

    Null text is empty; a file with null path inherits nothing; the directory of a path without a
    slash is empty and is the ancestor of all. Repeated rows are files of their own.
    """
    rows = files.select(F.col(doc_id).alias("doc_id"), path.cast("string").alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # written first: both readings below must number the rows alike
    rows = kept(with_row_id(rows.withColumns({
        "dir": F.when(F.col("path").contains("/"), F.regexp_replace("path", r"(?s)/[^/]*\z", "")).when(F.col("path").isNotNull(), ""),
        "named": F.coalesce(F.regexp_extract("path", r"(?s)([^/]*)\z", 1).rlike(LICENSE_FILE), F.lit(False))})), "license-files")
    found = kept(notices(rows.select("uid", "text", "named"), F.col("named"), templates or TEMPLATES, least), "notices")
    own = kept(rows.select("uid", "doc_id", "path", "dir", "named").join(found, "uid", "left"), "license-rows")
    gives = F.col("named") | (F.col("opening") if opening_counts else F.lit(False))
    granted = own.where(gives & F.col("license").isNotNull() & F.col("dir").isNotNull()).groupBy(F.col("dir").alias("up")).agg(
        F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), F.col("license"))).alias("grant"))
    # one row per directory and ancestor; a directory with a third of all files is one of them
    steps = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))
    dirs = own.where("dir is not null").select("dir").distinct().withColumn("up", F.explode(F.array_distinct(up)))
    near = dirs.join(granted, "up").groupBy("dir").agg(F.max_by(F.struct("grant", "up"), F.length("up")).alias("near"))
    taken = own.join(near.withColumnRenamed("dir", "d"), F.col("dir") == F.col("d"), "left")
    mine = F.col("license").isNotNull()
    return taken.select(
        "doc_id", "path", F.coalesce("license", "near.grant.license").alias("license"),
        F.when(mine, "notice").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("basis"),
        F.coalesce("score", "near.grant.score").alias("score"), F.when(~mine, F.col("near.up")).alias("from_dir"))
