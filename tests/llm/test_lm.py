"""Language-model scores against plain counting."""

import math
import random
from collections import Counter

import pytest

from metacurate.llm.lm import lm_scores
from metacurate.llm.packing import encoder, public_vocabulary

SCHEMA = "doc_id bigint, text string, block string, tokens string, n int, key string"


def brute(texts, alpha):
    import numpy as np

    docs = [np.frombuffer(encoder(*public_vocabulary()).ids(t or ""), "<u4").tolist() for t in texts]
    out = []
    for i, d in enumerate(docs):
        rest = [x for j, x in enumerate(docs) if j != i]
        seen, context = Counter(t for x in rest for t in x), Counter(t for x in rest for t in x[:-1])
        pairs = Counter(p for x in rest for p in zip(x, x[1:], strict=False))
        score, back, unseen = 0.0, 0, 0
        for k, t in enumerate(d):
            if k and pairs[d[k - 1], t]:
                score += math.log(pairs[d[k - 1], t] / context[d[k - 1]])
                continue
            back += k > 0
            if seen[t]:
                score += math.log(seen[t] / sum(seen.values())) + (math.log(alpha) if k else 0)
            else:
                unseen += 1
                score += 2 * math.log(alpha) - math.log(sum(map(len, docs)))
        out.append((i, len(d), back, unseen, score))
    return out


@pytest.mark.parametrize("block_tokens", [1, 200, 1 << 20])
def test_matches_plain_counts(spark, block_tokens):
    rnd = random.Random(1)
    words = ["the", "cat", "sat", "on", "a", "mat", "erle", "tion", "日本", "\n", "xq"]
    texts = [None, "", "only", "the cat sat", "the cat sat", "👍🏽 unique zebra", "a " * 3000]
    texts += [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60))) for _ in range(40)]
    df = spark.createDataFrame([(i, t, "x", "y", 1, "z") for i, t in enumerate(texts)], SCHEMA)
    got = sorted(tuple(r) for r in lm_scores(df, *public_vocabulary(), block_tokens=block_tokens).collect())
    expected = brute(texts, 0.4)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[4] == pytest.approx(e[4], rel=1e-9, abs=1e-9)
        assert g[5] == (pytest.approx(e[4] / e[1]) if e[1] else None)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lm_scores(empty, *public_vocabulary()).count() == 0
    odd = spark.createDataFrame([(None, "a b", "x", "y", 1, "z"), (1, "", None, None, None, None), (1, None, None, None, None, None)], SCHEMA)
    got = lm_scores(odd, *public_vocabulary()).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_unseen"]) for r in got) == [(0, 2, 2), (1, 0, 0), (1, 0, 0)]
