"""Top-k search against every inner product."""

import math
import random

import pytest
from pyspark.sql import functions as F

from metacurate.llm.topk import quantised, top_k


def brute(rows, queries, k):
    out = []
    for q, a in queries:
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), v) for v, b in rows if v != q)
        out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize(("seed", "scale", "blocks"), [(1, 30, 40), (2, 2, 64), (3, 100_000, 1000), (4, 3 * 10**7, 30)])
def test_matches_brute_force(spark, seed, scale, blocks):
    rnd = random.Random(seed)
    rows = [(i, [rnd.randint(-scale, scale) for _ in range(12)]) for i in range(300)]
    rows += [(1000 + i, list(rows[7][1])) for i in range(60)]  # copies tie
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id bigint, vec array<bigint>, score string, rank string")
    asked = df.where("vec_id % 20 = 0")
    got = sorted(tuple(r) for r in top_k(df, asked, 20, block=blocks, query_block=7).collect())
    assert got == brute(rows, [r for r in rows if r[0] % 20 == 0], 20)


def test_edges(spark):
    schema = "vec_id bigint, embedding array<float>, q string"
    rows = [
        (0, [1.0, 0.5], "a"), (1, [0.5], "b"), (2, None, "c"), (3, [1.0, None], "d"), (4, [math.nan, 1.0], "e"),
        (5, [math.inf, 0.0], "f"), (None, [1.0, 1.0], "g"), (6, [], "h"), (0, [1.0, 0.5], "a"),
    ]
    df = spark.createDataFrame(rows, schema).select("vec_id", quantised(F.col("embedding")).alias("vec"))
    got = sorted(tuple(r) for r in top_k(df, df.where("vec_id = 0"), 20).collect())
    assert got == [(0, 1, 1, 64 * 32), (0, 2, 6, 0)]
    none = spark.createDataFrame([], schema).select("vec_id", quantised(F.col("embedding")).alias("vec"))
    assert top_k(none, none, 20).count() == 0
    negative = spark.createDataFrame([(1, [-0.01, 0.01])], "vec_id bigint, embedding array<float>")
    assert negative.select(quantised(F.col("embedding")).alias("v")).first()["v"] == [-1, 0]
