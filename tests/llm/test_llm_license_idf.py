import math
from collections import Counter

import pytest
from odd import docs
from pyspark.sql import functions as F

from massloom.llm.license_scan import license_scan


def test_common_words_of_a_notice_are_light_however_many_texts_there_are(spark):
    said = "This file is released under the MIT License."
    rows = [(i, "nothing of this file is here") for i in range(1500)] + [(5000, said)]
    [got] = license_scan(docs(spark, rows), F.col("source")).where("doc_id = 5000").collect()
    df = Counter(w for _, t in rows for w in set(t.lower().rstrip(".").split()))
    idf = lambda w: math.log((len(rows) + 1) / (df[w] + 1)) + 1
    words, template = said.lower().rstrip(".").split(), "released under the mit license".split()
    length = lambda ws: math.sqrt(sum(idf(w) ** 2 for w in ws))
    want = sum(idf(w) ** 2 for w in template) / length(words) / length(template)
    assert (got.license, got.basis) == ("MIT", "notice") and got.score == pytest.approx(want, abs=1e-8)
