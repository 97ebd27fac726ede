"""Near-duplicate join of word n-gram sets by PartEnum signatures, exact in what it links.

A set's shingles are dealt into partitions of the hash domain. Sets of one size band that are
similar enough differ in few shingles, hence agree on some partitions whole; the signatures are the
contents of partitions (or, for small sets, of pairs of them). Signatures only propose: a pair must
pass an exact bound on its difference, and every link rests on the sizes of intersection and union
of the two whole sets. Documents with equal sets form a class, and only one of a class is compared.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import components, free_shuffles, kept, release
from massloom.llm.words import Tokens, chunks, mixed

#: Upper end of a size band over its lower end.
BAND = 1.5
#: Up to so many differences, partitions are taken by pairs.
PAIRED = 4
#: Signatures that one task of the matching step handles.
BUCKET = 1_500_000
BLOOM_BITS = 1 << 25
#: Bits of a set's parities, and of their short form; see :func:`parities`.
PARITY_BITS, SHORT_BITS = 1024, 256
#: Holders of a signature that are all compared at once.
FEW = 64
#: Turns in which a class is compared with one other only, before pairs are listed.
SEEDS = 2
#: Shingles that signatures are made of at once.
PIECE = 1 << 19
_U = np.uint64


def bands(largest: int, num: int, den: int) -> list[tuple[int, int, int]]:
    """(low, high, differences): sizes of each band, and how many shingles two linked sets of at
    most ``high`` can differ in: (den - num) / (den + num) of the sum of their sizes."""
    out, low = [], 1
    while not out or out[-1][1] < largest * den // num + 1:
        high = max(low, int(low * max(BAND, 1.001 * den / num)))
        out.append((low, high, 2 * high * (den - num) // (den + num)))
        low = high + 1
    return out


def _spare(differences: np.ndarray) -> np.ndarray:
    """Partitions beyond what the differences can touch, for those that stay empty."""
    return 2 + differences // 10


def set_signatures(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, signature) of non-empty sets, such that two sets that link share a signature.

    A set carries the tag of its band, and that of the next if a partner may lie there. With d
    possible differences and d + 1 + m partitions, linked sets agree on m + 1 partitions at least;
    with at most m empty ones, one of these has shingles in it. A set with more empty partitions
    adds signatures of its smallest shingles, as many as any partner must share one of. Up to
    ``PAIRED`` differences there are d + 2 partitions, and every pair of them makes a signature.
    """
    ends = np.cumsum([len(s) for s in sets]) // PIECE
    cuts = np.flatnonzero(np.diff(ends)) + 1
    owners, found = [np.zeros(0, np.int64)], [np.zeros(0, _U)]
    for i, j in zip([0, *cuts], [*cuts, len(sets)], strict=True):
        if j > i:
            at, sig = _signatures(sets[i:j], num, den)
            owners.append(at + i)
            found.append(sig)
    return np.concatenate(owners), np.concatenate(found)


def _signatures(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in sets])
    table = bands(int(sizes.max()), num, den)
    lows = np.array([b[0] for b in table])
    own = np.searchsorted(lows, sizes, side="right") - 1
    next_low = np.append(lows, 1 << 50)[own + 1]
    second = np.flatnonzero(sizes * den >= num * next_low)
    owners, found = [], []
    for ids, tags in ((np.arange(len(sets)), own), (second, own[second] + 1)):
        if not len(ids):
            continue
        values = np.concatenate([sets[i] for i in ids])
        row = np.repeat(np.arange(len(ids)), sizes[ids])
        differ = np.array([b[2] for b in table])[tags]
        parts = np.where(differ <= PAIRED, differ + 2, differ + 1 + _spare(differ))
        with np.errstate(over="ignore"):
            salt = mixed(tags.astype(_U) + _U(77))
            spread = mixed(values ^ salt[row]) >> _U(32)
            part = ((spread * parts[row].astype(_U)) >> _U(32)).astype(np.int64)
            key = (row.astype(np.int64) << 32) | part
            order = np.argsort(key, kind="stable")
            key, content = key[order], mixed(values[order] + _U(0x5851F42D4C957F2D))
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            total, cell = np.add.reduceat(content, start), key[start]
            cell_row, cell_part = cell >> 32, cell & 0xFFFFFFFF
            full = np.bincount(cell_row, minlength=len(ids))
            paired = differ <= PAIRED
            single = ~paired[cell_row]
            owners.append(ids[cell_row[single]])
            found.append(mixed(total[single] + mixed(salt[cell_row[single]] + cell_part[single].astype(_U))))
            sums = np.zeros((len(ids), PAIRED + 2), _U)
            sums[cell_row[~single], cell_part[~single]] = total[~single]
            has = np.zeros(sums.shape, bool)
            has[cell_row[~single], cell_part[~single]] = True
            for a, b in combinations(range(PAIRED + 2), 2):
                on = np.flatnonzero(paired & (b < parts) & (has[:, a] | has[:, b]))
                owners.append(ids[on])
                found.append(mixed(sums[on, a] + sums[on, b] + mixed(salt[on] + _U(1000 + 16 * a + b))))
            for r in np.flatnonzero(parts - full > np.where(paired, 1, _spare(differ))).tolist():
                mine = np.sort(mixed(sets[ids[r]]))
                first = mine[: len(mine) - -(-num * len(mine) // den) + 1]
                owners.append(np.full(len(first), ids[r]))
                found.append(mixed(first + mixed(salt[r] + _U(5000))))
    return np.concatenate(owners), np.concatenate(found)


def _key(values: np.ndarray) -> int:
    """What tells one class from another: a 64-bit hash of the whole set, never null's stand-in."""
    with np.errstate(over="ignore"):
        h = mixed(np.array([mixed(values + _U(11)).sum(dtype=_U) + _U(len(values))]))
    return int(h.view(np.int64)[0])


def _long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """(set, word): for each of ``PARITY_BITS`` parts of the hash domain, whether the set has an odd
    number of shingles there. Where two sets' parities differ, so do the sets: the number of
    differing bits is never more than that of differing shingles."""
    values = mixed(np.concatenate(sets) + _U(29)) if sets else np.zeros(0, _U)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cell = row * PARITY_BITS + (values % _U(PARITY_BITS)).astype(np.int64)
    odd = np.bincount(cell, minlength=len(sets) * PARITY_BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(sets), PARITY_BITS), axis=1).view(np.int64)


def _firsts(texts: list[str], words: int) -> tuple[list[np.ndarray], list[int | None], dict[int, int]]:
    """Sets and classes of some texts, and where each class comes first."""
    sets = [s for at in chunks(texts) for s in Tokens(texts[at]).sets(words)]
    keys = [_key(s) if len(s) else None for s in sets]
    first: dict[int, int] = {}
    for i, c in enumerate(keys):
        if c is not None:
            first.setdefault(c, i)
    return sets, keys, first


def _scan(docs: DataFrame, words: int) -> DataFrame:
    """One row per document: (doc_id, n, cls, parity); the first of a class in a batch has its parities."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets, keys, first = _firsts(batch["text"].tolist(), words)
            parity: list = [None] * len(sets)
            for i, bits in zip(first.values(), parities([sets[i] for i in first.values()]), strict=True):
                parity[i] = bits
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n": [len(s) for s in sets], "cls": pd.array(keys, dtype="Int64"),
                "parity": pd.Series(parity, dtype=object)})

    rows = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    return rows.mapInPandas(scan, "doc_id string, n long, cls long, parity array<long>")


def _packed(sig: np.ndarray, at: np.ndarray, cls: np.ndarray) -> bytes:
    """Signatures, and the class of each as a place in a list of classes."""
    used, place = np.unique(at, return_inverse=True)
    small = np.uint16 if len(used) <= 1 << 16 else np.uint32
    head = np.array([len(used), len(sig), small().itemsize], np.int64)
    return head.tobytes() + cls[used].tobytes() + sig.tobytes() + place.astype(small).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    """(signature, class) rows."""
    classes, n, width = np.frombuffer(data, np.int64, 3).tolist()
    cls = np.frombuffer(data, np.int64, classes, 24)
    sig = np.frombuffer(data, np.int64, n, 24 + 8 * classes)
    place = np.frombuffer(data, np.uint16 if width == 2 else np.uint32, n, 24 + 8 * (classes + n))
    return np.stack([sig, cls[place]], axis=1)


def _shared(docs: DataFrame, rows: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(sig, cls): the holders of every signature that different classes hold.

    A batch of texts sends each of its signatures once, to the task of the signature's bucket, and
    names all holders of those that it holds more than once: so a signature that a third of all
    documents have comes in once per batch, and its holders are told without meeting in one task.
    """
    total = rows.where("parity is not null").agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // (2 * BUCKET)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets, _, first = _firsts(batch["text"].tolist(), words)
            cls = np.array(list(first), np.int64)
            at, sig = set_signatures([sets[i] for i in first.values()], num, den)
            order = np.lexsort((at, sig))
            at, sig = at[order], sig[order]
            new = np.append(True, (sig[1:] != sig[:-1]) | (at[1:] != at[:-1]))[: len(sig)]
            at, sig = at[new], sig[new]
            lead = np.append(True, sig[1:] != sig[:-1])[: len(sig)]
            met = ~(lead & np.append(lead[1:], True)[: len(sig)])
            out = []
            for chosen, near in ((lead, False), (met, True)):
                a, s = at[chosen], sig[chosen]
                bucket = (mixed(s) % _U(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for b, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    if j > i:
                        out.append((b, near, _packed(s[order[i:j]].view(np.int64), a[order[i:j]], cls)))
            yield pd.DataFrame(out, columns=["bucket", "near", "data"])

    def match(group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(d) for d in group["data"]]
        near = [p for p, n in zip(parts, group["near"], strict=True) if n]
        sent = [p for p, n in zip(parts, group["near"], strict=True) if not n]
        both = np.concatenate(sent) if sent else np.zeros((0, 2), np.int64)
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        both = both[np.append(True, (both[1:] != both[:-1]).any(axis=1))[: len(both)]]
        same = both[1:, 0] == both[:-1, 0]
        far = both[(np.append(same, False) | np.append(False, same))[: len(both)]]
        return pd.DataFrame(np.concatenate([far, *near]), columns=["sig", "cls"])

    sent = docs.select("text").mapInPandas(deal, "bucket int, near boolean, data binary")
    held = sent.groupBy("bucket").applyInPandas(match, "sig long, cls long")
    held = kept(held.distinct(), "held")
    free_shuffles(docs.sparkSession)
    # signatures with the same holders say the same: one of them is kept
    who = held.groupBy("sig").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y")).where("n > 1")
    one = who.groupBy("n", "x", "y").agg(F.min("sig").alias("sig"))
    out = kept(held.join(one.select("sig"), "sig", "left_semi"), "shared")
    release(held)
    return out


def _classes(rows: DataFrame) -> DataFrame:
    """(cls, n, parity, p0, ..): size, parities and their short form of each class. The parities of
    a coarser division are those of the finer one, added up."""
    short = []
    for i in range(SHORT_BITS // 64):
        part = F.col("parity")[i]
        for j in range(i + SHORT_BITS // 64, PARITY_BITS // 64, SHORT_BITS // 64):
            part = part.bitwiseXOR(F.col("parity")[j])
        short.append(part.alias(f"p{i}"))
    found = rows.where("parity is not null").groupBy("cls").agg(F.max("n").alias("n"), F.min("parity").alias("parity"))
    return found.select("cls", "n", "parity", *short)


def _texts_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cls, text) of the ``wanted`` classes, from a second pass over the texts, each text deflated. A Bloom filter of
    fixed size, the only thing broadcast, keeps most others from the shuffle; the join decides."""
    spot = F.pmod(F.col("cls"), F.lit(BLOOM_BITS))
    word = (spot / 32).cast("int").alias("word")
    found = wanted.groupBy(word).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 32).cast("int"))).alias("bits")).toPandas()
    bits = np.zeros(BLOOM_BITS // 32, np.uint32)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    bloom = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags = np.frombuffer(bloom.value, np.uint32)
        for batch in batches:
            texts = batch["text"].tolist()
            found: dict[int, str] = {}
            for at in chunks(texts):
                for text, s in zip(texts[at], Tokens(texts[at]).sets(words), strict=True):
                    if len(s):
                        c = _key(s)
                        b = c % BLOOM_BITS
                        if flags[b // 32] >> (b % 32) & 1:
                            if c not in found:
                                found[c] = zlib.compress(text.encode())
            yield pd.DataFrame({"cls": np.array(list(found), np.int64), "text": pd.Series(list(found.values()), dtype=object)})

    texts = docs.select("text").mapInPandas(scan, "cls long, text binary")
    texts = texts.join(wanted, "cls", "left_semi")
    out = kept(texts.groupBy("cls").agg(F.min("text").alias("text")), "texts")
    free_shuffles(docs.sparkSession)
    return out


def _verified(pairs: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(a, b) of those pairs that link: den * |intersection| >= num * |union|."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets: dict[int, np.ndarray] = {}
            given = dict(zip([*batch["a"], *batch["b"]], [*batch["text_a"], *batch["text_b"]], strict=True))
            names, bodies = list(given), [zlib.decompress(t).decode() for t in given.values()]
            for at in chunks(bodies):
                sets |= zip(names[at], Tokens(bodies[at]).sets(words), strict=True)
            both = [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(batch["a"], batch["b"], strict=True)]
            size = [len(sets[a]) + len(sets[b]) for a, b in zip(batch["a"], batch["b"], strict=True)]
            yield batch.loc[[den * i >= num * (n - i) for i, n in zip(both, size, strict=True)], ["a", "b"]]

    full = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    return full.select("a", "b", "text_a", "text_b").mapInPandas(check, "a long, b long")


def _room(differ: Column, n: Column, k: Column, num: int, den: int) -> Column:
    """Whether two sets of these sizes that differ in at least so many shingles may link. Linked sets
    differ in (den - num) / (den + num) of the sum of their sizes at most."""
    return (F.least(n, k) * den >= F.greatest(n, k) * num) & (differ * (den + num) <= (n + k) * (den - num))


def _able(num: int, den: int, words: int) -> Column:
    """Whether sizes and parities, p0, .. of ``words`` words, of rows h and m leave room for a link."""
    differ = F.lit(0)
    for i in range(words):
        differ = differ + F.bit_count(F.col(f"h.p{i}").bitwiseXOR(F.col(f"m.p{i}")))
    return _room(differ, F.col("h.n"), F.col("m.n"), num, den)


def _near(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of those pairs whose sizes and full parities leave room for a link."""
    for c in "ba":
        pairs = pairs.join(classes.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("parity").alias(f"p_{c}")), c)
    bits = F.zip_with("p_a", "p_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda s, x: s + x)
    return pairs.where(_room(differ, F.col("n_a"), F.col("n_b"), num, den)).select("a", "b")


def _ends(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """``pairs`` with the components of both."""
    for c in "ab":
        pairs = pairs.join(comps.select(F.col("cls").alias(c), F.col("comp").alias(f"c_{c}")), c)
    return pairs


def class_links(shared: DataFrame, classes: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(cls, comp) of the classes in ``shared``: components over all links, without all pairs.

    First, in ``SEEDS`` turns, every class is compared with one other only: the first, in the order
    of a hash, of the heads of its signatures, each signature's head being its first holder.
    Copies of one text meet there, so a family is in few components before pairs are listed.
    Then in each round every signature whose holders are in several components compares some of
    them, its heads, with those outside their component: all of them if they are at most ``FEW``, else
    the smallest in each of 256, 65,536, .. parts. A signature is done when its holders are in one
    component or were all heads in one round, so no pair that could join two components is left
    out. A pair is listed only if its sizes and full parities leave room for a link, which hardly
    any but links do.
    """
    spark = shared.sparkSession
    comps = kept(shared.select("cls", F.col("cls").alias("comp")).distinct(), "comps")
    short = classes.drop("parity")
    full = classes.select("cls", "n", *[F.col("parity")[i].alias(f"p{i}") for i in range(PARITY_BITS // 64)])

    def still_open(done: DataFrame | None) -> DataFrame:
        every = (shared if done is None else shared.join(done, "sig", "left_anti")).join(comps, "cls")
        several = every.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("held")).where("lo <> hi")
        return kept(every.join(several.select("sig", "held"), "sig"), "open")

    def headed(holders: DataFrame, order: Column, part: Column) -> DataFrame:
        """The first holder of each signature and part; holders are dealt by signature already, so they
        are not shuffled again."""
        row = F.struct(order.alias("order"), *[c for c in holders.columns if c != "sig"])
        return holders.groupBy("sig", part.alias("part")).agg(F.min(row).alias("h")).select("sig", "h.*").drop("order", "held")

    def met(holders: DataFrame, heads: DataFrame, bits: int) -> DataFrame:
        apart = (F.col("m.sig") == F.col("h.sig")) & (F.col("m.comp") != F.col("h.comp"))
        return holders.alias("m").join(heads.alias("h"), apart & _able(num, den, bits // 64)).select(F.col("h.cls").alias("a"), F.col("m.cls").alias("b"))

    def merged(pairs: DataFrame) -> DataFrame:
        """Components after the links among ``pairs``."""
        found = kept(_verified(pairs, texts, words, num, den), "links")
        free_shuffles(spark)
        after = comps
        if not found.isEmpty():
            moved = components(_ends(found, comps).select(F.col("c_a").alias("a"), F.col("c_b").alias("b")))
            joined = comps.join(moved.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left")
            after = kept(joined.select("cls", F.coalesce("to", "comp").alias("comp")), "comps")
            release(comps)
            release(moved)
        release(found)
        release(pairs)
        return after

    for turn in range(SEEDS):
        open_ = still_open(None) if turn else shared.withColumn("comp", F.col("cls"))
        holders = open_.join(short, "cls").repartition("sig")
        found = met(holders, headed(holders, F.xxhash64("cls", F.lit(turn)), F.lit(0)), SHORT_BITS)
        one = found.groupBy("b").agg(F.min_by("a", F.struct(F.xxhash64("a", F.lit(turn)), "a")).alias("a"))
        pairs = kept(_near(one, classes, num, den), "pairs")
        free_shuffles(spark)
        comps = merged(pairs)
        if turn:
            release(open_)
    done, parts = None, 256
    while True:
        open_ = still_open(done)
        if open_.isEmpty():
            release(open_)
            if done is not None:
                release(done)
            return comps
        holders = open_.join(full, "cls").repartition("sig")
        spot = F.xxhash64("cls")
        part = F.when(F.col("held") <= FEW, spot).otherwise(F.pmod(spot, F.lit(parts)))
        found = met(holders, headed(holders, F.col("cls"), part), PARITY_BITS)
        pairs = kept(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        every = F.count_distinct(part) == F.count("*")  # all were heads
        now = open_.groupBy("sig").agg(every.alias("all")).where("all").select("sig")
        before, done = done, kept(now if done is None else now.union(done), "done")
        if before is not None:
            release(before)
        free_shuffles(spark)
        comps = merged(pairs)
        release(open_)
        parts *= 256


def near_duplicates(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    A document's set is its distinct ``words``-word shingles, lower-cased in A-Z; one with fewer
    words has its whole sequence as one shingle, one without words or text has none and links with
    nothing. Two link if den * |intersection| >= num * |union|. component_id is the smallest id
    reachable by links, the document's own included; null ids count as larger than any. Repeated
    rows are rows of their own, linked as equals. Shingles and classes are told apart by 64-bit
    hashes. Other columns are not looked at.
    """
    kind = docs.schema[doc_id].dataType
    given = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    scanned = kept(_scan(given, words), "scanned")
    slim = kept(scanned.select(F.col("doc_id").cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"), "cls"), "slim")
    shared = _shared(given, scanned, words, num, den)
    wanted = kept(shared.select("cls").distinct(), "wanted")
    classes = kept(_classes(scanned).join(wanted, "cls", "left_semi"), "classes")
    release(scanned)
    texts = _texts_of(given, wanted, words)
    release(wanted)
    comps = class_links(shared, classes, texts, words, num, den)
    # nothing but the two tables that the result is made of stays on disk
    for used in (shared, classes, texts):
        release(used)
    free_shuffles(docs.sparkSession)
    classes = slim.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
    known = classes.join(comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    least = known.groupBy("comp").agg(F.min("least").alias("component_id"))
    known = known.select("cls", "comp").join(least, "comp").select("cls", "component_id")
    return slim.join(known, "cls", "left").select(
        "doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
