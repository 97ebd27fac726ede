"""Words of many texts at once, as numpy arrays over their joined UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Texts are worked on in pieces of about so many bytes; a longer text is a piece of its own.
CHUNK = 1 << 20
#: An odd number, which has an inverse modulo 2**64.
ODD = 0x9E3779B97F4A7C15
_ODD = np.uint64(ODD)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function, so that equal low bits do not stay equal."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def chunks(texts: list[str], most: int = CHUNK) -> Iterator[slice]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(first, i)
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield slice(first, len(texts))


@lru_cache(2)
def _some_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1 modulo 2**64; those for an ordinary piece are kept."""
    if n > 2 * CHUNK:
        return _some_powers.__wrapped__(base, n)
    return _some_powers(base, 2 * CHUNK)[:n]


class Tokens:
    """Words are runs of bytes other than space and 9 to 13; hashes are of the words with A-Z
    lower-cased. Texts are joined with a newline between them, which no word crosses."""

    def __init__(self, texts: list[str]):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.n = len(parts)
        self.bytes_per_text = np.array([len(p) for p in parts], np.int64)
        self.raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        self.text_starts = np.concatenate([[0], np.cumsum(self.bytes_per_text + 1)])[: self.n].astype(np.int64)
        self.bounds = np.append(self.text_starts, len(self.raw))
        space = (self.raw == 32) | ((self.raw >= 9) & (self.raw <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.text_of_word = np.searchsorted(self.text_starts, self.starts, side="right") - 1 if self.n else np.zeros(0, np.int64)
        self.words_per_text = np.bincount(self.text_of_word, minlength=self.n) if self.n else np.zeros(0, np.int64)
        self._hashes: np.ndarray | None = None

    def count(self, mask: np.ndarray) -> np.ndarray:
        """Bytes of each text for which ``mask`` holds."""
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[self.bounds[1:] - 1] - sums[self.bounds[:-1]] if self.n else np.zeros(0, np.int64)

    @property
    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each lower-cased word: sums of byte values times powers of an odd number
        (modulo 2**64 it has an inverse, which moves each word to its own start), then mixed."""
        if self._hashes is None:
            upper = (self.raw >= 65) & (self.raw <= 90)
            values = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1))[self.raw + upper.astype(np.uint8) * np.uint8(32)]
            with np.errstate(over="ignore"):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(ODD, len(self.raw)), dtype=np.uint64)])
                back = powers(pow(ODD, -1, 1 << 64), len(self.raw) + 1)
                word = (sums[self.ends] - sums[self.starts]) * back[self.starts]
                self._hashes = mixed(word + (self.ends - self.starts).astype(np.uint64))
        return self._hashes

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of each run of ``k`` words; a text with fewer has its whole sequence as one."""
        n = len(self.starts)
        counts = self.words_per_text
        first = np.concatenate([[0], np.cumsum(counts)])[:-1].astype(np.int64)
        place = np.arange(n) - first[self.text_of_word]
        size = np.minimum(counts, k)[self.text_of_word]
        at = np.flatnonzero(place + size <= counts[self.text_of_word])
        out = np.zeros(len(at), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                on = j < size[at]
                out[on] = mixed(out[on] * _ODD + self.hashes[at[on] + j] + np.uint64(j))
        return self.text_of_word[at], out

    def distinct_share(self) -> tuple[np.ndarray, np.ndarray]:
        """Share of distinct words, and of distinct pairs of neighbours, in each text; 1 if it has none."""
        shares = []
        for text, value in ((self.text_of_word, self.hashes), self.shingles(2)):
            order = np.lexsort((value, text))
            t, v = text[order], value[order]
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1])
            total = np.bincount(t, minlength=self.n) if self.n else np.zeros(0)
            shares.append(np.where(total > 0, np.bincount(t, new, self.n) / np.maximum(total, 1), 1.0) if self.n else np.zeros(0))
        return shares[0], shares[1]

    def sets(self, k: int) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text; empty for a text without words."""
        text, value = self.shingles(k)  # in the order of texts
        cuts = np.searchsorted(text, np.arange(self.n + 1)).tolist()
        out = []
        for i, j in zip(cuts, cuts[1:], strict=False):
            part = np.sort(value[i:j])
            out.append(part[np.append(True, part[1:] != part[:-1])] if j - i > 1 else part)
        return out
