"""Quality classifier: Bradley-Terry scores from preference pairs, cut at a quantile."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import in_fold
from massloom.llm.words import Tokens, chunks

CUT = 0.7
#: Rows that may be fitted on, by the smallest hashes of their ids; the bound of what the driver gets.
MOST_ROWS = 20_000
RIVALS = 8  # pairs per row


def text_features(texts: list[str]) -> np.ndarray:
    """One row of numbers per whole text; what counts is form, not language or length alone."""
    return np.concatenate([_features(texts[at]) for at in chunks(texts)]) if texts else np.zeros((0, 14))


def _features(texts: list[str]) -> np.ndarray:
    t = Tokens(texts)
    size = np.maximum(t.bytes_per_text, 1)
    words = np.maximum(t.words_per_text, 1)
    share = lambda mask: t.count(mask) / size
    b = t.raw
    upper, lower = (b >= 65) & (b <= 90), (b >= 97) & (b <= 122)
    marks = np.isin(b, np.frombuffer(b"#$%&*|!~^=<>{}[]@\\_", np.uint8))
    letters = t.count(upper) + t.count(lower)
    distinct, pairs = t.distinct_share()
    length = (t.ends - t.starts).astype(np.float64)
    mean = np.bincount(t.text_of_word, length, len(texts)) / words
    long_words = np.bincount(t.text_of_word, length > 25, len(texts)) / words
    rows = [
        np.log1p(t.words_per_text), (t.words_per_text < 5).astype(float), mean, long_words,
        t.count(upper) / np.maximum(letters, 1), np.sqrt(share(marks)), np.sqrt(share(b == 33)), np.sqrt(share(b == 124)),
        np.sqrt(share((b >= 48) & (b <= 57))), np.sqrt(share((b == 46) | (b == 44))), distinct, pairs,
        t.count(b == 10) / words, (size <= 1).astype(float),
    ]
    return np.nan_to_num(np.stack(rows, axis=1))


def _pairs(good: int, bad: int, rivals: int) -> tuple[np.ndarray, np.ndarray]:
    """Every row of either side meets ``rivals`` rows of the other, spread evenly over them."""
    i = np.repeat(np.arange(max(good, bad)), rivals)
    j = (i * 2654435761 + np.tile(np.arange(rivals), max(good, bad)) * 40503) >> 7
    return (i % good, j % bad) if good >= bad else (j % good, i % bad)


def fit(features: np.ndarray, labels: np.ndarray, rivals: int = RIVALS, ridge: float = 1e-3) -> dict | None:
    """Bradley-Terry weights: P(a is preferred to b) = sigmoid(w . (a - b)), by Newton steps on the
    logistic loss of the pairs' differences.

    ``cut`` is the quantile of the raw scores at the share of label 0, half way to the next score;
    ``scale`` turns distances from it into log odds. None if only one label occurs.
    """
    good, bad = features[labels == 1], features[labels == 0]
    if not len(good) or not len(bad):
        return None
    mid, wide = features.mean(0), np.maximum(features.std(0), 1e-6)
    i, j = _pairs(len(good), len(bad), rivals)
    x = (good[i] - bad[j]) / wide
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))  # chance of the wrong order
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(len(w)), x.T @ p / len(x) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    raw = (features - mid) / wide @ w
    order = np.sort(raw)
    at = min(max(len(bad), 1), len(order) - 1)
    return {"w": w / wide, "mid": mid, "cut": float(order[at - 1] + order[at]) / 2, "scale": 1.0}


def score_texts(model: dict | None, texts: list[str], cut: float = CUT) -> np.ndarray:
    """Scores in (0, 1); the model's cut lies at ``cut``. Without a model every text gets ``cut``."""
    if model is None:
        return np.full(len(texts), cut)
    raw = (text_features(texts) - model["mid"]) @ model["w"] - model["cut"]
    return 1 / (1 + np.exp(-np.clip(raw * model["scale"] + np.log(cut / (1 - cut)), -30, 30)))


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    held_out: tuple[int, int] = (4, 2), most_rows: int = MOST_ROWS,
) -> dict | None:
    """Fit on at most ``most_rows`` labelled documents outside the held-out fold.

    The sample is bounded, so its ids are small enough to broadcast and its features to gather.
    Labels other than 0 and 1 and null ids take no part; an id with several labels counts with each.
    """
    ids = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).where(
        F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & ~in_fold(F.col("_id"), *held_out))
    ids = ids.orderBy(F.xxhash64("_id"), "_id", "_label").limit(most_rows)
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    found = rows.join(F.broadcast(ids), "_id").select("_text", "_label", F.xxhash64("_id", "_text").alias("_hash"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"x": list(text_features(b["_text"].tolist())), "y": b["_label"], "h": b["_hash"]})

    # repeated documents may outnumber the ids, so the rows are limited as well, by a hash of id and text
    got = found.mapInPandas(features, "x array<double>, y int, h long").orderBy("h", "y", "x").limit(most_rows).toPandas()
    if got.empty:
        return None
    got = got.assign(x=[tuple(x) for x in got["x"]]).sort_values(["x", "y"])  # the fit must not depend on the order
    return fit(np.array(got["x"].tolist()), got["y"].to_numpy())


def quality_score(model: dict | None, text: Column) -> Column:
    """Score in (0, 1) of a text, null being empty; 0.7 for every text without a model."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts(model, texts.tolist()), dtype="float64")

    return score(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: tuple[int, int] = (4, 2)) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, from its whole text; null text is empty.

    Repeated rows get the same score each. With no labels, or labels of one kind, every score is
    0.7: nothing is rejected.
    """
    model = train(docs, labels, doc_id, text, held_out=held_out)
    rows = docs.select(F.col(doc_id).alias("doc_id"), quality_score(model, F.col(text)).alias("score"))
    return rows.select(
        "doc_id", in_fold(F.col("doc_id"), *held_out).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
