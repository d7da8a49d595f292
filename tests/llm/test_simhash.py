"""SimHash classes against all pairs."""

import random
from itertools import product

import numpy as np
import pytest
from test_ngrams import words
from xxhash import xxh64_intdigest

from metacurate.llm import simhash
from metacurate.llm.simhash import (
    BITS, allocate, bit_groups, bucket_links, choose_groups, expected_candidates, fingerprint, links, near_duplicates,
)


def expected_fingerprint(text, n=3):
    w = words(text)
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def classes(fps, distance=3):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = list(parent)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[root(a)] = root(b)
    out = {}
    for f in known:
        out.setdefault(root(f), set()).add(f)
    return sorted(map(sorted, out.values()))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def linked_classes(fps, pairs):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        assert (a ^ b).bit_count() <= 3
        parent[root(a)] = root(b)
    out = {}
    for f in parent:
        out.setdefault(root(f), set()).add(f)
    return sorted(map(sorted, out.values()))


def crowd(rnd, centres, members, flips, fixed=0):
    """Fingerprints around centres; ``fixed`` low bits are the same in all."""
    out = set()
    for _ in range(centres):
        c = rnd.getrandbits(64 - fixed) << fixed
        for _ in range(members):
            x = c
            for _ in range(rnd.randint(0, flips)):
                x ^= 1 << rnd.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("text", ["", " \n", "One", "one  Two", "a b c", "A b\tC\x0bd É É\xa0x", "x y z " * 50 + "tail", "w" * 100_000])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == expected_fingerprint(text)
    assert fingerprint(text.encode(), step=3) == expected_fingerprint(text)
    assert fingerprint(None) == 0


@pytest.mark.parametrize("seed", range(3))
def test_allocation_is_the_best(seed):
    costs = np.random.default_rng(seed).random((50, 4, 5))
    costs[:, :, 0] = 0
    got = allocate(costs, 4)
    plans = [p for p in product(range(5), repeat=4) if sum(p) == 4]
    for row, units in zip(costs, got, strict=True):
        assert sum(units) == 4
        price = lambda p, row=row: sum(row[i, u] for i, u in enumerate(p))
        assert price(units) == pytest.approx(min(map(price, plans)))


def test_expected_candidates_are_counts():
    rnd = random.Random(3)
    counts = np.array([rnd.randint(0, 9) for _ in range(1 << 8)])
    prices = expected_candidates(counts, list(range(8)), np.full(64, 0.5), 3)
    for v, t in [(0, 0), (77, 1), (255, 2), (13, 3)]:
        assert prices[t][v] == sum(c for u, c in enumerate(counts) if (u ^ v).bit_count() <= t)


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(1)
    lead = rng.random((4000, 4)) < 0.5
    bits = np.concatenate([np.where(rng.random((4000, 16)) < 0.95, lead[:, [g]], rng.random((4000, 16)) < 0.5) for g in range(4)], axis=1)
    order = rng.permutation(BITS)
    bits = bits[:, order].astype(float)
    groups = bit_groups(4000, bits.T @ bits, 4)
    assert all(len({order[b] // 16 for b in g}) == 1 for g in groups)
    assert sorted(b for g in groups for b in g) == list(range(64))


def test_more_fingerprints_get_fewer_partitions():
    both = lambda n: np.full((64, 64), n / 4) + np.eye(64) * n / 4
    sizes = [len(choose_groups(n, both(n), 3)) for n in (10**3, 10**8, 10**12)]
    assert sizes[0] == 4
    assert sizes == sorted(sizes, reverse=True)
    assert sizes[-1] < 3


@pytest.mark.parametrize(("seed", "centres", "members", "flips", "fixed", "bucket"), [
    (1, 300, 4, 4, 0, 1 << 15), (2, 3, 300, 3, 0, 1 << 15), (3, 2, 200, 4, 0, 16), (4, 150, 4, 5, 40, 16), (5, 200, 3, 3, 30, 1 << 15),
])
def test_links_against_all_pairs(spark, seed, centres, members, flips, fixed, bucket):
    fps = crowd(random.Random(seed), centres, members, flips, fixed)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint").repartition(3)
    got = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links(df, 3, bucket).collect()]
    assert linked_classes(fps, got) == classes(fps)


def test_unequal_thresholds_are_used(spark, monkeypatch):
    seen = []
    original = simhash.index_rows

    def spy(distinct, *args):
        rows = original(distinct, *args)
        seen.append(rows.selectExpr("flag").groupBy("flag").count().collect())
        return rows

    monkeypatch.setattr(simhash, "index_rows", spy)
    monkeypatch.setattr(simhash, "ROW_COST", 0.01)
    fps = crowd(random.Random(6), 300, 3, 3, 18)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    got = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links(df, 3).collect()]
    assert linked_classes(fps, got) == classes(fps)
    assert {1, 2, 3} == {r["flag"] for r in seen[0]}  # indexed only, asked only, both


def test_bucket_links_of_large_buckets():
    fps = np.array(crowd(random.Random(8), 3, 150, 3), np.uint64)
    pairs = bucket_links(np.zeros(len(fps), np.uint64), fps, np.full(len(fps), 3, np.int8), 3)
    assert linked_classes(fps.tolist(), pairs.tolist()) == classes(fps.tolist())
    assert len(pairs) < len(fps)
    apart = bucket_links(np.zeros(2, np.uint64), np.array([0, 1], np.uint64), np.array([1, 1], np.int8), 3)
    assert len(apart) == 0  # nobody asks


def test_documents(spark):
    rnd = random.Random(11)
    texts = []
    for _ in range(25):
        base = [f"w{rnd.randint(0, 500)}" for _ in range(rnd.randint(3, 300))]
        for _ in range(5):
            w = list(base)
            w[rnd.randrange(len(w))] = "edit"
            texts.append(" ".join(w))
    texts += ["", None, " \t", "one", "ONE", "one two", "a b c"] * 2 + ["one " * 30_000]
    rows = [(i * 3 % 1000, t, "x", 1, "k") for i, t in enumerate(texts)] + [(None, texts[0], "x", 1, "k"), (None, "alone here now", "x", 1, "k"), (0, texts[0], "", 1, "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp string, id int, fingerprint string").repartition(4)
    fps = [expected_fingerprint(t or "") for _, t, *_ in rows]
    first = {}
    for group in classes(set(fps)):
        ids = [r[0] for r, f in zip(rows, fps, strict=True) if f in group and r[0] is not None]
        first.update(dict.fromkeys(group, min(ids, default=None)))
    expected = sorted([(r[0], f"{f:016x}", first[f]) for r, f in zip(rows, fps, strict=True)], key=repr)
    assert sorted((tuple(r) for r in near_duplicates(df).collect()), key=repr) == expected


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates(df).collect() == []
    assert near_duplicates(df).columns == ["doc_id", "fingerprint", "component_id"]
