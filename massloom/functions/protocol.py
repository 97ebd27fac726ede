"""Facts read from protocol text, by its words and numbers.

Names are looked up in :mod:`vocabulary`. For amounts a text is split at a keyword, and what follows
each place is cut into tokens: words, numbers and single marks. An amount is a number and its unit
within a stated number of tokens after the keyword.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from massloom.functions.text import let
from massloom.functions.vocabulary import AT_PLACE, PROTOCOL_MODS, first_named, has, names_in, words_of

#: Tokens that an amount may stand from its keyword.
NEAR, FAR = 16, 40
CLOSE = 64


def _from(text: Column, word: str) -> Column:
    """A text from a little before the first place of some letters, in either case; NULL without them."""
    return let(F.split(text, f"(?i){word}", 2), lambda p: F.when(
        F.size(p) > 1, F.concat(F.right(F.get(p, F.lit(0)), F.lit(CLOSE)), F.lit(word), F.get(p, F.lit(1)))))


def _pieces(text: Column, keyword: str) -> Column:
    """What stands before the first place of ``keyword``, a run of whole words, and what follows each
    place up to the next."""
    return F.split(F.translate(text, "­–", "--"), rf"(?i)(?<![A-Za-z]){keyword}(?![A-Za-z])", -1)


_TOKEN = r"\d+(?:\.\d+)?|[A-Za-z]+|[^\sA-Za-z0-9]"


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def _after(pieces: Column, reach: int) -> Column:
    """The first ``reach`` tokens after each place of the keyword; no more of the text is cut."""
    follow = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(follow, lambda p: _tokens(F.regexp_extract(p, rf"^(?:\s*+(?:{_TOKEN})){{0,{reach}}}+", 0)))


def _first(items: Column) -> Column:
    return F.get(F.filter(items, lambda x: x.isNotNull()), F.lit(0))


def _is(token: Column, *words: str) -> Column:
    return F.coalesce(F.lower(token).isin(*words), F.lit(False))


def _digits(token: Column, low: int, high: int) -> Column:
    return F.coalesce(F.length(token).between(low, high) & token.try_cast("long").isNotNull(), F.lit(False))


def _amount(text: Column, keyword: str, reach: int, stop: str, units: Sequence[str]) -> Column:
    """(number, unit) of the first keyword that has one before ``stop`` and within ``reach`` tokens."""

    def until(window: Column) -> Column:
        end = F.array_position(window, stop).cast("int")
        return F.when(end > 0, F.slice(window, F.lit(1), F.greatest(end - 1, F.lit(0)))).otherwise(window)

    def pick(window: Column) -> Column:
        return _first(F.transform(window, lambda t, k: F.when(
            t.rlike("^[0-9]") & _is(F.get(window, k + 1), *units), F.struct(t.alias("number"), F.get(window, k + 1).alias("unit")))))

    return _first(F.transform(_after(_pieces(text, keyword), reach), lambda w: let(until(w), pick)))


def mass_tolerance(text: Column, which: str) -> Column:
    """``which`` is ``precursor`` or ``fragment``: the first number with a mass unit after a word that
    begins so, in the same sentence."""
    found = let(_from(text, which), lambda t: _amount(t, f"{which}[A-Za-z]*", NEAR, ".", ("ppm", "da", "mmu")))
    return let(found, lambda a: F.concat(a["number"], F.lit(" "), a["unit"]))


def scan_range(text: Column) -> Column:
    """MS1 range: two numbers of three or four digits right before or after ``m/z`` (within ``CLOSE``
    characters before it), also as the digits of both without what stood between them."""
    text_of = lambda a, b: F.concat(a, F.lit("m/z-"), b, F.lit("m/z"))

    def pair(tokens: Column, i: Column) -> Column:
        a, mark, b = (F.get(tokens, i + k) for k in range(3))
        return F.when((i >= 0) & _digits(a, 3, 4) & _is(mark, "-", "to") & _digits(b, 3, 4), text_of(a, b))

    def start(tokens: Column) -> Column:
        return F.when(_is(F.get(tokens, F.lit(0)), "range") & _is(F.get(tokens, F.lit(1)), "of"), 2).otherwise(0)

    def run_on(tokens: Column) -> Column:
        digits = F.get(tokens, start(tokens))
        return F.when(_digits(digits, 7, 8), text_of(F.substr(digits, F.lit(1), F.length(digits) - 4), F.substr(digits, F.length(digits) - 3)))

    def read(pieces: Column) -> Column:
        heads = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: _tokens(F.right(p, F.lit(CLOSE))))
        before = _first(F.transform(heads, lambda w: pair(w, F.size(w) - 3)))
        after = let(_after(pieces, 5), lambda follow: F.coalesce(
            _first(F.transform(follow, lambda w: pair(w, start(w)))), _first(F.transform(follow, run_on))))
        return F.coalesce(before, after)

    return let(_from(F.regexp_replace(text, "(?i)m/z", " mz "), "mz"), lambda t: let(_pieces(t, "mz"), read))


def collision_energy(text: Column) -> Column:
    """The number at ``NCE``, else the percentage after a normalized collision energy, else the
    electron volts after a collision energy."""

    def number(window: Column) -> Column:
        skip = _is(F.get(window, F.lit(0)), ")").cast("int")
        token = F.get(window, skip + _is(F.get(window, skip), "of").cast("int"))
        return F.when(token.rlike("^[0-9]"), token)

    def energy(t: Column) -> Column:
        share = _amount(t, r"normalized\s+collision\s+energy", FAR, ")", ("%",))["number"]
        volts = _amount(t, r"collision\s+energy", FAR, ")", ("ev",))["number"]
        return F.coalesce(F.concat(share, F.lit(" NCE")), F.concat(volts, F.lit(" eV")))

    nce = let(_from(text, "nce"), lambda t: _first(F.transform(_after(_pieces(t, "nce"), 3), number)))
    return F.coalesce(F.concat(nce, F.lit(" NCE")), let(_from(text, "collision"), energy))


def cleavage_agent(text: Column) -> Column:
    return F.coalesce(let(names_in(words_of(text), "cleavage"), lambda found: first_named(found, "cleavage")), F.lit("not available"))


def named_facts(sample: Column, data: Column) -> Column:
    """Struct of (cleavage_agent, reduction_reagent, alkylation_reagent, protocol_mods): enzymes and
    modifications named in either text, reagents in the sample protocol. Modifications are (unimod_id,
    name, residues, kind); one bound to a place counts where both names stand in one line."""
    both = F.concat(data, F.lit(" "), sample)

    def kind_of(found: Column, name: str) -> Column:
        uid, residues, kind = PROTOCOL_MODS[name]
        here = has(found, "modification", name)
        if name in AT_PLACE:
            in_line = lambda line: let(
                names_in(words_of(line), "modification", "place"), lambda f: has(f, "modification", name) & has(f, "place", AT_PLACE[name]))
            here = here & has(found, "place", AT_PLACE[name]) & F.exists(F.split(both, "\n"), in_line)
        return F.when(here, F.struct(
            F.lit(uid).alias("unimod_id"), F.lit(name).alias("name"), F.lit(residues).alias("residues"), F.lit(kind).alias("kind")))

    def read(found: Column) -> Column:
        return F.struct(
            F.coalesce(first_named(found["all"], "cleavage"), F.lit("not available")).alias("cleavage_agent"),
            first_named(found["own"], "reduction").alias("reduction_reagent"),
            first_named(found["own"], "alkylation").alias("alkylation_reagent"),
            F.array_compact(F.array(*[kind_of(found["all"], name) for name in PROTOCOL_MODS])).alias("protocol_mods"))

    def look(words: Column) -> Column:
        found = F.struct(
            names_in(F.concat(words["data"], words["sample"]), "cleavage", "modification", "place").alias("all"),
            names_in(words["sample"], "reduction", "alkylation").alias("own"))
        return let(found, read)

    return let(F.struct(words_of(sample).alias("sample"), words_of(data).alias("data")), look)
