"""Messages to binary variables that are known only by how many of them are present."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from massloom.functions.text import let

#: Longer arrays than this go through the tree.
SHORT = 8
#: Products of arrays longer than this are made by Fourier transforms.
LONG = 1024
#: Variables of rows of one length that go through the tree together.
TOGETHER = 1 << 17


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distribution of a sum from those of its two parts (last axis)."""
    n = a.shape[-1] + b.shape[-1] - 1
    if b.shape[-1] > LONG:
        out = np.fft.irfft(np.fft.rfft(a, n) * np.fft.rfft(b, n), n)
        return np.maximum(out, 0.0)
    out = np.zeros((*a.shape[:-1], n))
    for j in range(b.shape[-1]):
        out[..., j : j + a.shape[-1]] += a * b[..., j : j + 1]
    return out


def _expected(given: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Entry k: the mean of ``given`` at k plus a count drawn from ``counts``."""
    n = given.shape[-1] - counts.shape[-1] + 1
    if counts.shape[-1] > LONG:
        return _product(given, counts[..., ::-1])[..., counts.shape[-1] - 1 : given.shape[-1]]
    out = np.zeros((*np.broadcast_shapes(given.shape[:-1], counts.shape[:-1]), n))
    for j in range(counts.shape[-1]):
        out += given[..., j : j + n] * counts[..., j : j + 1]
    return out


def tree_messages(present: np.ndarray, likelihood: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(absent, present) message to each of n variables, for many rows at once.

    ``present`` (rows, n) holds P(variable = 1), ``likelihood`` (rows, n + 1) the weight of each count.
    A binary tree over the variables: counts of two halves are multiplied up to the root; on the
    way down a half gets the likelihood averaged over the other half's counts, which at a leaf is
    its message. Work is n log^2 n for long arrays. Variables that fill up the last level are never present.
    """
    rows, n = present.shape
    size = 1 << max(n - 1, 0).bit_length()
    p = np.pad(present, ((0, 0), (0, size - n)))
    levels = [np.stack([1 - p, p], axis=-1)]
    while levels[-1].shape[1] > 1:
        levels.append(_product(levels[-1][:, 0::2], levels[-1][:, 1::2]))
    given = np.pad(likelihood, ((0, 0), (0, size - n)), mode="edge")[:, None, :]
    for counts in levels[-2::-1]:
        halves = counts.reshape(rows, -1, 2, counts.shape[-1])
        given = _expected(given[:, :, None, :], halves[:, :, ::-1]).reshape(rows, -1, counts.shape[-1])
        given = given / np.maximum(given.max(axis=-1, keepdims=True), 1e-300)
    absent, there = given[:, :n, 0], given[:, :n, 1]
    return absent / (absent + there), there / (absent + there)


_PAIR = StructType().add("absent", ArrayType(DoubleType())).add("present", ArrayType(DoubleType()))


@F.pandas_udf(_PAIR)
def _tree(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for present, likelihood in batches:
        absent, there = np.full(len(present), None, object), np.full(len(present), None, object)
        some = np.flatnonzero(present.notna())
        sizes = np.array([(len(present.iloc[i]), len(likelihood.iloc[i])) for i in some], int).reshape(-1, 2)
        for n, m in np.unique(sizes, axis=0).tolist():
            alike, most = some[(sizes == (n, m)).all(axis=1)], max(1, TOGETHER // n)
            for at in (alike[i : i + most] for i in range(0, len(alike), most)):
                p, given = (np.array([np.asarray(c.iloc[i], float) for i in at]) for c in (present, likelihood))
                for i, a, b in zip(at, *tree_messages(p, given[:, : n + 1]), strict=True):
                    absent[i], there[i] = a, b
        yield pd.DataFrame({"absent": absent, "present": there})


def _chain(present: Column, likelihood: Column) -> Column:
    """Counts of the variables before each one, and the likelihood averaged over those after it: both
    grow by one step a variable, so all messages together are quadratic."""
    n = F.size(present)

    def with_one(counts: Column, p: Column) -> Column:
        stay = F.transform(F.concat(counts, F.array(F.lit(0.0))), lambda x: x * (1 - p))
        move = F.transform(F.concat(F.array(F.lit(0.0)), counts), lambda x: x * p)
        return F.zip_with(stay, move, lambda a, b: a + b)

    def averaged(given: Column, p: Column) -> Column:
        m = F.size(given) - 1
        return F.zip_with(F.slice(given, F.lit(1), m), F.slice(given, F.lit(2), m), lambda a, b: a * (1 - p) + b * p)

    before = F.aggregate(present, F.array(F.array(F.lit(1.0))), lambda acc, p: F.concat(acc, F.array(with_one(F.element_at(acc, -1), p))))
    after = F.aggregate(
        F.reverse(present), F.array(F.slice(likelihood, F.lit(1), n + 1)), lambda acc, p: F.concat(acc, F.array(averaged(F.element_at(acc, -1), p))))

    def message(counts: Column, given: Column) -> Column:
        def dot(shift: int) -> Column:
            return F.aggregate(
                F.zip_with(counts, F.slice(given, F.lit(1 + shift), F.size(counts)), lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)

        return let(F.struct(dot(0).alias("a"), dot(1).alias("p")), lambda m: F.struct(
            (m["a"] / (m["a"] + m["p"])).alias("absent"), (m["p"] / (m["a"] + m["p"])).alias("present")))

    return F.zip_with(F.slice(before, F.lit(1), n), F.slice(F.reverse(after), F.lit(2), n), message)


def leave_one_out(present: Column, likelihood: Column, short: int = SHORT) -> Column:
    """Messages to each of n binary variables from a likelihood over how many are present.

    ``present`` holds P(variable = 1); ``likelihood`` has n + 1 entries. Entry i of the result is
    ``struct(absent, present)``, scaled to sum to one. Arrays of at most ``short`` variables stay in
    the JVM; longer ones are made by :func:`tree_messages`, those of one length together. A null array gives null.
    """
    is_short = F.size(present) <= short
    long = _tree(F.when(~is_short, present), F.when(~is_short, likelihood))
    return F.when(is_short, _chain(present, likelihood)).when(
        F.size(present) > short, F.arrays_zip(long["absent"].alias("absent"), long["present"].alias("present")))
