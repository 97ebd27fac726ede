import numpy as np
import pytest
from pyspark.sql import functions as F

from massloom.llm.block_search import nearest

SCHEMA = "vec_id long, embedding array<float>, score int, dims int"


@pytest.mark.parametrize("blocks", [(2048, 4096), (3, 17)])
def test_many_vectors_under_one_id(spark, blocks):
    rng = np.random.default_rng(4)
    ask = rng.normal(size=8)
    near = [(7, ask + rng.normal(size=8) * 0.01) for _ in range(60)]
    rows = [(0, ask), *near, *[(10 + i % 40, rng.normal(size=8)) for i in range(120)]]
    rows = [(i, np.float32(v)) for i, v in rows]
    got = nearest(spark.createDataFrame([(i, v.tolist(), 1, 1) for i, v in rows], SCHEMA), F.col("vec_id") == 0, query_block=blocks[0], row_block=blocks[1])
    q, best = rows[0][1].astype(float), {}
    for i, v in rows[1:]:
        v = v.astype(float)
        best[i] = max(best.get(i, -2.0), float(v @ q / np.sqrt((v @ v) * (q @ q))))
    want = sorted(((-s, i) for i, s in best.items()))[:5]
    assert [(r["rank"], r.vec_id, round(r.score, 10)) for r in got.orderBy("rank").collect()] == [(k + 1, i, round(-s, 10)) for k, (s, i) in enumerate(want)]
