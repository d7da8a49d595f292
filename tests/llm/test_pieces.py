"""Piece encoding against the sentencepiece library, its dropout, and the round trip."""

import random

import numpy as np
import sentencepiece

from metacurate.llm import pieces as P

SCHEMA = "doc_id bigint, text string, ids string, decoded string"


def texts():
    rnd = random.Random(11)
    out = ["", " ", "a", "  a  b\n c\td", "héé 日本 👍🏽", "ﬁ Å x  ", "​ a", "a　b", "<s> </s> <unk> <0x41>", "x\x00y", " " * 70 + "x", "\n" * 40,
           "unbelievable internationalization", "a" * 900, "the " * 500, "мама мыла раму"]
    vocabulary = ["the", "tion", "Über", "schön", " ", "  ", "\n", "é", "日", "a1", "'", ".", "erle", "xq", "-"]
    return out + ["".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 60))) for _ in range(150)]


def test_without_dropout_it_is_the_library():
    model, library = P.Pieces(P.public_model()), sentencepiece.SentencePieceProcessor(model_file=P.public_model())
    for t, ids in zip(texts(), model.encode(texts(), [0] * len(texts()), 1, 0.0), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t), t


def test_heap_and_rounds_agree():
    model = P.Pieces(P.public_model())
    words = [" " + t.replace(" ", "") for t in texts() if t.strip(" ")]
    keys = [P.keyed(5, 0, w) for w in words]
    for dropout in (0.0, 0.1, 0.5):
        bar = int(dropout * 2**64)
        assert model.encode_words(words, keys, bar) == [model.encode_long(w, k, bar) for w, k in zip(words, keys, strict=True)]


def test_dropout_varies_and_decodes():
    model = P.Pieces(P.public_model())
    odd = texts() + ["a▁b ▁", "▁"]
    plain = model.encode(odd, [0] * len(odd), 1, 0.0)
    seen = [model.encode(odd, [v] * len(odd), 1, 0.2) for v in range(3)]
    for cut in (plain, *seen):
        assert [model.decode(i) for i in cut] == odd
    assert seen[0] != seen[1] != seen[2]
    assert sum(map(len, seen[0])) > sum(map(len, plain))
    assert P.Pieces(P.public_model()).encode(odd, [1] * len(odd), 1, 0.2) == seen[1]
    assert model.encode(odd, [1] * len(odd), 2, 0.2) != seen[1]
    nothing = model.encode(["the tion"], [0], 1, 1.0)[0]
    assert len(nothing) == 4 * len(" the tion")


def test_documents(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts())] + [(None, "no id", "x", "y"), (1, None, None, None), (2, "a", "", "")]
    got = P.decode_documents(P.encode_documents(spark.createDataFrame(rows, SCHEMA), P.public_model(), dropout=0.3), P.public_model()).collect()
    assert len(got) == len(rows)
    assert all(r["decoded"] == (r["text"] or "") for r in got)
    again = {r["text"]: bytes(r["ids"]) for r in got if r["doc_id"] == 2}
    assert len(again) == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert P.decode_documents(P.encode_documents(empty, P.public_model()), P.public_model()).count() == 0


def test_occurrences_are_cut_on_their_own(spark):
    model = P.Pieces(P.public_model())
    word, n = "internationalization", 200
    alone = model.encode([word] * n, list(range(n)), 1, 0.3)
    assert len(set(alone)) > 20
    one = [len(model.encode([" ".join([word] * k)], [7], 1, 0.3)[0]) for k in range(1, n)]
    assert len({b - a for a, b in zip([0, *one], one, strict=False)}) > 4
    rows = [(i, word, "x", "y") for i in range(n)]
    got = P.encode_documents(spark.createDataFrame(rows, SCHEMA), P.public_model(), dropout=0.3).collect()
    assert len({bytes(r["ids"]) for r in got}) > 20
    long = "a" * 300
    assert len(set(model.encode([long] * 50, list(range(50)), 1, 0.3))) > 20


def test_dropout_rate_and_groups():
    model = P.Pieces(P.public_model())
    cut = model.encode(["ab"] * 4000, list(range(4000)), 3, 0.1)  # the pieces of " ab" at most
    dropped = sum(c != model.encode(["ab"], [0], 3, 0.0)[0] for c in cut) / 4000
    assert 0.05 < dropped < 0.35
    many = texts() * 30
    names = list(range(len(many)))
    assert model.encode(many, names, 1, 0.2) == [model.encode([t], [i], 1, 0.2)[0] for t, i in zip(many, names, strict=True)]


def test_pairs_are_found_by_their_hash():
    model = P.Pieces(P.public_model())
    pairs = np.array(list(model.merges), np.int64)
    rnd = np.random.default_rng(1)
    other = np.array([x for x in ((rnd.integers(0, 32000, 5000) << 32) | rnd.integers(0, 32000, 5000)).tolist() if x not in model.merges] + [-1, -2, (5 << 32) | -2])
    found, slots = model._lookup(np.concatenate([other, pairs]))
    assert found.tolist() == list(range(len(other), len(other) + len(pairs)))
    assert model.pair_merged[slots].tolist() == list(model.merges.values())
    assert model.pair_rank[slots].tolist() == model.rank[list(model.merges.values())].tolist()


def test_words_of_all_lengths_are_cut_as_by_the_heap():
    model = P.Pieces(P.public_model())
    rnd = random.Random(12)
    pool = "".join(texts()).replace(" ", "")
    words = [" " * (k % 3) + "".join(rnd.choice(pool) for _ in range(n)) for n in range(1, 198) for k in range(3)]
    words += [w for t in texts() for w in P._UNIT.findall(" " + t) if len(w) <= 200]
    for dropout in (0.0, 0.1, 0.5, 1.0):
        bar = min(int(dropout * 2**64), 2**64 - 1)
        keys = [P.keyed(dropout, i) for i in range(len(words))]
        assert model.encode_words(words, keys, bar) == [model.encode_long(w, k, bar) for w, k in zip(words, keys, strict=True)]
