"""Modified sequences: events, terminal tags and notation changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from massloom.functions.text import blank_to_null

_BRACKET = r"\[([^\]]*)\]"
_ID = r"\(UniMod:(\d+)\)"
_LEAD = r"^(?:\[[^\]]*\]|\(UniMod:\d+\))"
_TOKEN = r"[A-Z](?:\[[^\]]*\]|\(UniMod:\d+\))?"


def _mass(text: Column) -> Column:
    """A bracket's text as a number; names, exponents and special values are not masses."""
    return F.when(~text.rlike("[A-Za-z]"), F.trim(text).try_cast("double"))


def _event(pos: Column, residue: Column, term: Column, text: Column, anchor: str = "") -> Column:
    return F.struct(
        pos.cast("int").alias("pos"),
        residue.cast("string").alias("residue"),
        term.cast("string").alias("term"),
        _mass(F.regexp_extract(text, anchor + _BRACKET, 1)).alias("mass"),
        blank_to_null(F.regexp_extract(text, anchor + _ID, 1)).try_cast("int").alias("unimod_id"),
    )


def mod_events(col: Column, compat: bool = False) -> Column:
    """Events of a modified sequence, as an array of (pos, residue, term, mass, unimod_id).

    Residue positions count from 0 in the bare sequence, the N-terminus is -1. With ``compat``
    a tag on the last residue is reported a second time as a C-terminal event.
    """
    text = F.trim(col)
    null = F.lit(None)
    tokens = F.regexp_extract_all(F.regexp_replace(text, _LEAD, ""), F.lit(_TOKEN), F.lit(0))
    events = F.concat(
        F.array(_event(F.lit(-1), null, F.lit("N-term"), text, "^")),
        F.transform(
            F.filter(
                F.transform(tokens, lambda t, i: F.struct(i.alias("i"), t.alias("t"))),
                lambda x: F.length(x["t"]) > 1,
            ),
            lambda x: _event(x["i"], F.substring(x["t"], 1, 1), null, x["t"]),
        ),
    )
    if compat:
        tail = F.regexp_extract(text, r"(?<=.)(\[[^\]]*\]|\(UniMod:\d+\))$", 1)
        events = F.concat(events, F.array(_event(F.size(tokens), null, F.lit("C-term"), tail)))
    return F.filter(events, lambda e: e["mass"].isNotNull() | e["unimod_id"].isNotNull())


def unimod_ids(col: Column) -> Column:
    """The distinct ids that a sequence names, as integers."""
    ids = F.regexp_extract_all(col, F.lit(_ID), F.lit(1))
    return F.array_distinct(F.array_compact(F.transform(ids, lambda i: i.try_cast("int"))))


def unimod_to_mass(col: Column, masses: Column) -> Column:
    """Write ``(UniMod:n)`` as ``[+m.mmmmmm]``; ``masses`` maps ids to masses."""
    ids = F.array_distinct(F.regexp_extract_all(col, F.lit(_ID), F.lit(1)))

    def rewrite(acc: Column, key: Column) -> Column:
        mass = F.try_element_at(masses, key.cast("int"))
        tag = F.concat(F.lit("(UniMod:"), key, F.lit(")"))
        return F.replace(acc, tag, F.when(mass.isNotNull(), F.format_string("[%+.6f]", mass)).otherwise(tag))

    return F.when(F.size(ids) > 0, F.aggregate(ids, col, rewrite)).otherwise(col)


def sdrf_mod(name: Column, unimod_id: Column, kind: Column, residues: Column) -> Column:
    """``NT=..;AC=UNIMOD:..;MT=..;TA=..``"""
    return F.format_string("NT=%s;AC=UNIMOD:%d;MT=%s;TA=%s", name, unimod_id, kind, residues)
