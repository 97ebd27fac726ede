"""Names of instruments, enzymes, reagents and modifications, and one rule that finds them in text.

A name is found where its words stand in a row, whatever separates them or nothing: ``Lys-C``, ``LysC``
and ``lys c`` are one. Words are runs of letters and digits in either case, and are matched whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of the longest name.
LONGEST = 4

# fixed values: for each kind the terms reported and the names that stand for them, with the spellings in
# use in instrument lists, enzyme and reagent catalogues and the modification register. Of several
# terms in a text the first listed is reported: models before the part they are built on
NAMES = {
    "analyzer": {
        "orbitrap": [
            "Orbitrap", "Exactive Plus", "Q Exactive", "Q Exactive Plus", "Q Exactive HF", "Q Exactive HF-X", "Exploris", "Exploris 120",
            "Exploris 240", "Exploris 480", "Fusion", "Fusion Lumos", "Eclipse", "Astral", "Tribrid"],
        "TOF": ["timsTOF", "timsTOF Pro", "timsTOF SCP", "timsTOF HT", "QTOF", "TripleTOF", "Synapt", "Xevo", "impact II", "impact", "maXis"],
        "ion trap": ["LTQ", "LTQ XL", "LTQ FT", "Velos", "Elite", "ion trap"],
        "quadrupole": ["TSQ", "TSQ Altis", "TSQ Quantiva", "TSQ Vantage", "triple quadrupole"],
    },
    "cleavage": {
        "NT=Chymotrypsin;AC=MS:1001306": ["chymotrypsin", "alpha-chymotrypsin"],
        "NT=Lys-C;AC=MS:1001309": ["Lys-C", "rLys-C", "endoproteinase Lys-C"],
        "NT=Asp-N;AC=MS:1001303": ["Asp-N", "rAsp-N", "endoproteinase Asp-N"],
        "NT=Glu-C;AC=MS:1001917": ["Glu-C", "endoproteinase Glu-C"],
        "NT=Trypsin;AC=MS:1001251": ["trypsin", "trypsin/P", "trypsinized", "trypsinised", "trypsinization", "trypsinisation"],
    },
    "reduction": {
        "dithiothreitol": ["dithiothreitol", "1,4-dithiothreitol", "DTT"],
        "tris(2-carboxyethyl)phosphine": ["tris(2-carboxyethyl)phosphine", "TCEP", "TCEP-HCl"],
        "beta-mercaptoethanol": ["beta-mercaptoethanol", "2-mercaptoethanol", "2-ME", "BME"],
    },
    "alkylation": {
        "iodoacetamide": ["iodoacetamide", "2-iodoacetamide", "IAA"],
        "chloroacetamide": ["chloroacetamide", "2-chloroacetamide", "CAA"],
        "N-ethylmaleimide": ["N-ethylmaleimide", "NEM"],
    },
    "modification": {
        "Carbamidomethyl": ["carbamidomethyl", "carbamidomethylation", "carbamidomethylated"],
        "TMT6plex": ["TMT", "TMTpro"],
        "iTRAQ4plex": ["iTRAQ"],
        "Oxidation": ["oxidation", "oxidations"],
        "Acetyl": ["acetyl"],
        "Phospho": [
            "phospho", "phosphorylation", "phosphorylations", "phosphorylated", "phosphopeptide", "phosphopeptides", "phosphoproteome",
            "phosphoproteomic", "phosphoproteomics", "phosphosite", "phosphosites"],
        "Deamidation": ["deamidation", "deamidations", "deamidated"],
        "Methyl": ["methylation", "methylations", "methylated", "dimethylation", "dimethylated", "trimethylation", "trimethylated"],
    },
    "place": {"N-term": ["N-term", "N-terminal", "N-terminus", "N-termini"]},
}

# fixed values: UniMod id, residues and kind of the modifications that a protocol is read for
PROTOCOL_MODS = {
    "Carbamidomethyl": (4, "C", "Fixed"),
    "TMT6plex": (730, "K", "Fixed"),
    "iTRAQ4plex": (214, "K", "Fixed"),
    "Oxidation": (35, "M", "Variable"),
    "Acetyl": (1, "K", "Variable"),
    "Phospho": (21, "STY", "Variable"),
    "Deamidation": (7, "NQ", "Variable"),
    "Methyl": (34, "KR", "Variable"),
}
# fixed values: modifications that count only where another name stands in the same line
AT_PLACE = {"Acetyl": "N-term"}


def _words(name: str) -> list[str]:
    return re.findall("[a-z0-9]+", name.lower())


def _listed(names: Iterable[str]) -> Column:
    return F.array(*[F.lit(n) for n in dict.fromkeys("".join(_words(n)) for n in names)])


def words_of(text: Column) -> Column:
    return F.split(F.lower(text), "[^a-z0-9]+", -1)


def names_in(words: Column, *kinds: str) -> Column:
    """The names of these kinds that occur among :func:`words_of` a text, without separators: runs of
    one to four words that begin as a name does are looked up in the list."""
    names = [n for kind in kinds for listed in NAMES[kind].values() for n in listed]
    heads = {"".join(_words(n)[:k]) for n in names for k in range(1, LONGEST + 1)}

    def runs(words: Column) -> Column:
        def at(w: Column, i: Column) -> Column:
            out = [w]
            for k in range(1, LONGEST):
                out.append(F.concat(out[-1], F.get(words, i + k)))
            return F.when(w.isin(sorted(heads)), F.array(*out))

        return F.array_intersect(F.flatten(F.filter(F.transform(words, at), lambda r: r.isNotNull())), _listed(names))

    return F.get(F.transform(F.array(words), runs), F.lit(0))


def has(found: Column, kind: str, term: str) -> Column:
    return F.arrays_overlap(found, _listed(NAMES[kind][term]))


def first_named(found: Column, kind: str) -> Column:
    """The first term of a kind with a name among ``found``, else NULL."""
    out = F.lit(None).cast("string")
    for term in reversed(NAMES[kind]):
        out = F.when(has(found, kind, term), F.lit(term)).otherwise(out)
    return out
