"""Product codes against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from metacurate.llm.codes import codebook_text, compress, dictionary, nearest
from metacurate.llm.topk import quantised

SCHEMA = "vec_id bigint, vec array<bigint>, label int, code string, error string"


def brute(rows, parts, entries, rounds):
    """``rows`` are (id, vector, label)."""
    width = -(-max(len(v) for _, v, _ in rows) // parts)
    rows = [(i, list(v) + [0] * (parts * width - len(v)), g) for i, v, g in rows]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    start = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in start] for p in range(parts)]

    def assign(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in rows:
                members.setdefault(assign(v, p)[0], []).append(cut(v, p))
            books[p] = [
                [sum(c) // len(members[e]) for c in zip(*members[e], strict=True)] if e in members else old for e, old in enumerate(books[p])
            ]
    out = []
    for i, v, g in rows:
        found = [assign(v, p) for p in range(parts)]
        out.append((i, g, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found)))
    totals = {}
    for r in out:
        totals[r[1]] = totals.get(r[1], 0) + r[3]
    return sorted([(*r, totals[r[1]]) for r in out], key=repr), ",".join(str(x) for p in books for e in p for x in e)


def check(spark, rows, parts, entries, rounds):
    df = spark.createDataFrame([(i, v, g, "c", "e") for i, v, g in rows], SCHEMA).repartition(3)
    got, books = compress(df, parts, entries, rounds)
    expected, text = brute([r for r in rows if r[1] is not None], parts, entries, rounds)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected
    assert codebook_text(books) == text


@pytest.mark.parametrize(("seed", "scale", "parts", "entries", "rounds"), [
    (1, 3, 4, 8, 2), (2, 200, 16, 64, 2), (3, 100_000, 4, 16, 1), (4, 2**40, 2, 4, 2), (5, 1, 8, 1, 3),
])
def test_matches_plain_loops(spark, seed, scale, parts, entries, rounds):
    rnd = random.Random(seed)
    # large values close together: their sums of squares have to fit a long
    centre, scale = (scale, 1000) if scale > 2**30 else (0, scale)
    rows = [(i, [rnd.randint(centre - scale, centre + scale) for _ in range(16)], rnd.choice([None, 1, 1, 2])) for i in range(200)]
    rows += [(300 + i, list(rows[3][1]), 7) for i in range(50)]
    check(spark, rows, parts, entries, rounds)


def test_edges(spark):
    rows = [(1, [1, 2, 3, 4], None), (1, [1, 2, 3, 4], 5), (1, [0, 9, 9, 9], 5), (None, [4, 4, 4, 4], 5), (2, None, 5), (3, [], 6), (4, [7], -1)]
    check(spark, rows, 2, 3, 2)
    check(spark, rows, 2, 200, 2)
    check(spark, [(None, [], None)], 16, 64, 2)
    none, books = compress(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and codebook_text(books) == ""


def test_dictionary():
    for column in ([5], [3, -2, 3, 9], [0, 1 << 40, 0, -7]):
        values, places = dictionary(np.array(column))
        assert list(values) == sorted(set(column))
        assert list(values[places]) == column
    codes, errors = nearest(np.array([[1, 1]]), np.array([[[0, 1], [1, 0], [2, 1]]]))
    assert codes.tolist() == [[0]] and errors.tolist() == [1]  # the first of equally near entries


def test_vectors_without_finite_components_are_left_out(spark):
    rows = [(1, [0.1, -0.1], 1), (2, [math.nan, 0.0], 1), (3, [math.inf, 0.0], 1), (4, [None, 0.0], 1), (5, None, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got, _ = compress(df.select("vec_id", "label", quantised(F.col("embedding"), 256).alias("vec")), 2, 4, 2)
    assert [r["vec_id"] for r in got.collect()] == [1]
