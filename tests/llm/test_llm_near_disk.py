"""What a near-duplicate join leaves on disk: only the tables that its result is read from."""

import os
import random

from odd import docs, prose

from massloom.llm import ngram_join
from massloom.llm.ngram_join import near_duplicates


def copies(spark):
    rows = []
    for i in range(30):
        text = prose(random.Random(i), 60)
        rows += [(3 * i, text), (3 * i + 1, text.replace(text.split()[7], "other", 1)), (3 * i + 2, f"{text} more")]
    return docs(spark, rows)


def test_only_tables_of_the_result_stay(spark, monkeypatch):
    made, kept = [], ngram_join.kept
    monkeypatch.setattr(ngram_join, "kept", lambda df, name: made.append(out := kept(df, name)) or out)
    out = near_duplicates(copies(spark))
    left = {os.path.basename(t.kept_path).rsplit("-", 1)[0] for t in made if os.path.exists(t.kept_path)}
    assert left == {"slim", "comps"}
    groups = {}
    for row in out.collect():
        groups.setdefault(row.component_id, set()).add(row.doc_id)
    assert groups == {3 * i: {3 * i, 3 * i + 1, 3 * i + 2} for i in range(30)}


def test_texts_travel_deflated(spark):
    given = copies(spark)
    scanned = ngram_join.kept(ngram_join._scan(given, 5), "scanned")
    texts = ngram_join._texts_of(given, scanned.select("cls").distinct(), 5)
    assert texts.schema["text"].dataType.simpleString() == "binary" and texts.count() == 90
