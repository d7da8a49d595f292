"""Near-duplicate classes against all pairs."""

import os
import random
import subprocess
import sys
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from metacurate.llm import graphs, jaccard
from metacurate.llm.graphs import components
from metacurate.llm.jaccard import near_duplicates
from test_ngrams import words

SCHEMA = "doc_id bigint, text string, lang string, size string, key int, class string"


def shingles(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, percent):
    sets = [(d, shingles(t, n)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if a is not None and b is not None and both and 100 * both >= percent * (len(x) + len(y) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted(((d, len(s), d if d is None else root(d)) for d, s in sets), key=repr)


def check(spark, rows, n, percent, rare=64):
    df = spark.createDataFrame([(d, t, None, "s", 1, "c") for d, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in near_duplicates(df, n, percent, rare=rare).collect()), key=repr)
    assert got == brute(rows, n, percent)


def family(rnd, vocabulary, length, copies, edits):
    base = [rnd.choice(vocabulary) for _ in range(length)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("seed", "n", "percent", "rare"), [(1, 3, 90, 64), (2, 5, 80, 64), (3, 3, 90, 3), (4, 3, 80, 2), (5, 1, 70, 2)])
def test_matches_all_pairs(spark, seed, n, percent, rare):
    rnd = random.Random(seed)
    small, large = [f"w{i}" for i in range(12)], [f"v{i}" for i in range(3000)]
    texts = []
    for _ in range(4):
        texts += family(rnd, large, rnd.randint(20, 150), 25, 4)
    texts += family(rnd, small, 30, 25, 2) + family(rnd, small, 6, 25, 1)
    passage = " ".join(rnd.choice(large) for _ in range(40))
    texts += [passage + " " + " ".join(rnd.choice(large) for _ in range(rnd.randint(0, 25))) for _ in range(40)]
    texts += [" ".join(rnd.choice(small) for _ in range(rnd.randint(0, 5))) for _ in range(40)]
    texts += [texts[0]] * 20 + [texts[0].upper()] * 3
    rnd.shuffle(texts)
    check(spark, list(enumerate(texts)), n, percent, rare)


def test_chain(spark):
    w = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(w[2 * i : 2 * i + 100])) for i in range(40)]  # each links only with its neighbours
    rows.reverse()
    check(spark, rows, 3, 90)


def test_long_documents(spark):
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = []
    for length in (1990, 2060, 3900, 4200, 9000):  # on both sides of the widths of the signatures
        for edits in (length // 120, length // 60, length // 52):
            texts += family(rnd, vocabulary, length, 3, edits)
        base = texts[-1].split()
        texts += [" ".join(base[: len(base) * part // 100]) for part in (89, 90, 91, 95)]
    rnd.shuffle(texts)
    check(spark, list(enumerate(texts)), 3, 90)
    check(spark, list(enumerate(texts)), 5, 80, rare=3)


def test_small_labels_are_written_by_one_task(spark, monkeypatch):
    files, real = [], graphs.stored

    def counted(df, label="stored"):
        table = real(df, label)
        files.append(len(table.inputFiles()))
        return table

    monkeypatch.setattr(graphs, "stored", counted)
    held = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(held, "false")
    try:
        got = components(spark.createDataFrame([(0, i) for i in range(1, 100)], "a bigint, b bigint")).collect()
    finally:
        spark.conf.unset(held)
    assert {tuple(r) for r in got} == {(i, 0) for i in range(100)}
    assert max(files) == 1


def test_repeated_shingles_take_little_memory():
    rnd = np.random.default_rng(3)
    for sets in ([], [[]], [[5]], [[1, 2], [2, 3], [3], [3, 9], [9]], list(rnd.integers(0, 2**63, (100, 1000)) >> 48)):
        arrays = [np.unique(np.array(s, np.uint64)) for s in sets]
        if arrays:
            keys, counts = np.unique(np.concatenate(arrays), return_counts=True)
            got = jaccard.repeated(arrays).to_pydict()
            assert got == {"key": keys[counts > 1].tolist(), "n": counts[counts > 1].tolist()}
    sets = [rnd.integers(0, 2**63, 10_000).astype(np.uint64) for _ in range(100)]  # 8 MB
    tracemalloc.start()
    jaccard.repeated(sets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14e6  # 42 MB with numpy's unique


def test_runs_of_sets_take_one_array():
    rnd = np.random.default_rng(4)
    sets = [np.unique(rnd.integers(0, 500, size).astype(np.uint64)) for size in [*range(0, 300, 7), 5000, 3, 0, 40]]
    for run in (1, 50, 300, 10_000):
        runs, size = [[]], 0
        for s in sets:
            runs[-1].append(s)
            size += len(s)
            if size >= run:
                runs.append([])
                size = 0
        expected = [jaccard.repeated([s.copy() for s in r]).to_pydict() for r in runs if sum(map(len, r))]
        assert [b.to_pydict() for b in jaccard.repeated_in_runs(iter(sets), run)] == expected
    code = """if True:
        import resource
        import numpy as np
        from metacurate.llm import jaccard
        peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
        rnd = np.random.default_rng(5)
        sets = (np.unique(rnd.integers(0, 2**62, rnd.integers(900, 1100)).astype(np.uint64)) for _ in range(4500))
        before = peak()
        for run in jaccard.repeated_in_runs(sets):
            pass
        print(peak() - before)
    """
    env = os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env=env)
    assert float(done.stdout) < 59  # MB, 33 of them the run; with a list of the sets 67


def test_documents_of_a_key_are_dealt_to_few_blocks(spark):
    keyed = spark.range(0, 8000).selectExpr(
        "cast(id >= 2000 as bigint) AS key", "CASE WHEN id < 2000 THEN 2000L ELSE 6000L END AS n", "id AS doc_id", "9L AS size", "id AS class", "array(id) AS bits"
    )
    got = {r["key"]: r["rows"] for r in jaccard._dealt(keyed).groupBy("key").agg(F.count("*").alias("rows")).collect()}
    assert got == {0: 2000, 1: 3 * 6000}  # in blocks of 512, 8,000 and 72,000


@pytest.mark.parametrize("block", [1, 3, 2048])
def test_pairs_of_blocks_are_all_pairs_that_can_link(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    nodes = spark.createDataFrame([(i, [7 if i < 6 else -1 << 40] * 16) for i in range(12)], "doc_id bigint, bits array<bigint>")
    keyed = nodes.selectExpr("5L AS key", "12L AS n", "doc_id", "20L AS size", "doc_id % 4 AS class")
    got = [tuple(r) for r in jaccard._block_pairs(keyed, nodes, 80).collect()]
    assert sorted(got) == [(a, b) for a in range(12) for b in range(a + 1, 12) if a % 4 != b % 4 and (a < 6) == (b < 6)]


def test_edges(spark):
    balanced = "a"
    while len(balanced) < 1024:  # words that a polynomial hash modulo 2**64 takes for one
        balanced += balanced.translate(str.maketrans("ab", "ba"))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one two"), (7, "one two"), (8, "two one"),
        (9, "é one two"), (10, "É one two"), (10, "É one two"), (11, "x " * 5000), (11, "one"), (12, "x x x"), (None, None),
        (13, balanced), (14, balanced.translate(str.maketrans("ab", "ba"))),
    ]
    check(spark, rows, 3, 90)
    check(spark, [], 3, 90)
    check(spark, [(1, None)], 5, 80)


def test_components(spark):
    rnd = random.Random(9)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 300)] + [(500, 500), (None, 7), (9, None)]
    rnd.shuffle(pairs)
    got = dict(tuple(r) for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 300)}}
