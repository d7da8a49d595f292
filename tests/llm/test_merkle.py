"""Manifest, proofs and verification against a tree built in memory."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from metacurate.llm import merkle
from metacurate.llm.merkle import COLUMNS, leaf_digest, manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, tree string, rank int, nodes int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc):
    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return h(*[one(doc[c]) for c in COLUMNS])


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    out = []
    for level in tree[:-1]:
        run = level[i // 3 * 3 : i // 3 * 3 + 3]
        out.append((run[: i % 3], run[i % 3 + 1 :]))
        i //= 3
    return out


def brute(docs, received):
    groups = {}
    for d in docs:
        groups.setdefault(d["source"], []).append(d)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf(d)))
        trees[s] = levels([leaf(d) for d in groups[s]])
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, d in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, at)
            fold = received(d)
            for before, after in path:
                fold = h(*before, fold, *after)
            proof = h(*[x for before, after in path for x in before + after])
            out.append((d["doc_id"], leaf(d), trees[s][-1][0], top[-1][0], proof, fold, fold == top[-1][0]))
    return sorted(out, key=repr)


def tampered(d):
    if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 2 == 0:
        return leaf({**d, "text": d["text"] and d["text"].replace("\n", "")})
    return leaf(d)


def check(spark, docs):
    rows = [tuple(d.get(c) for c in ("doc_id", "text", "lang", "source", "n_chars")) + ("x", "y", 1, 2) for d in docs]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    copy = leaf_digest([F.translate(c, "\n", "") if c == "text" else F.col(c) for c in COLUMNS])
    received = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, copy)
    got = sorted((tuple(r) for r in manifest(df, received=received).collect()), key=repr)
    assert got == brute(docs, tampered)
    return got


def document(i, source, text="a\nb"):
    return {"doc_id": i, "text": text, "lang": "en" if i and i % 3 else None, "source": source, "n_chars": len(text or "")}


@pytest.mark.parametrize("levels_at_once", [1, 2, 5])
def test_many_sources(spark, monkeypatch, levels_at_once):
    monkeypatch.setattr(merkle, "LEVELS", levels_at_once)
    rnd = random.Random(levels_at_once)
    docs = [document(i, "hot", "line\n" * rnd.randint(0, 3)) for i in range(100)]
    docs += [document(100 + i, f"s{rnd.randint(0, 12)}") for i in range(60)]
    docs += [document(200 + i, s) for i, s in enumerate(["", None, None, "é", "z", "\U0001f600", "￿"])]
    got = check(spark, docs)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_one_source(spark, n):
    check(spark, [document(i, "one", None if i == 1 else "x") for i in range(n)])


def test_nulls_repeats_long_and_empty(spark):
    docs = [document(i, "a", t) for i, t in [(7, ""), (7, None), (7, None), (None, "x\n"), (None, None), (8, "long \n" * 200_000)]]
    docs += [dict.fromkeys(COLUMNS), dict.fromkeys(COLUMNS)]
    got = check(spark, docs)
    assert len(got) == 8
    assert len({r[1] for r in got}) == 6  # null and empty text differ
    assert manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_swapped_copy_does_not_verify(spark):
    docs = [document(i, "s", str(i)) for i in range(20)]
    df = spark.createDataFrame([tuple(d[c] for c in COLUMNS) for d in docs], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert all(r["verified"] for r in manifest(df).collect())
    wrong = manifest(df, received=F.when(F.col("doc_id") == 5, F.lit(leaf(docs[6]))))
    assert [r["doc_id"] for r in wrong.where("NOT verified").collect()] == [5]
