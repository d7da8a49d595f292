"""Packing against the tokenizers library and against best-fit decreasing one piece after the other."""

import random
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metacurate.llm.packing import best_fit_plan, op1_pack_documents, pack_documents, pack_pieces, public_vocabulary, token_pieces

SCHEMA = "doc_id bigint, text string, lang string, sequence_id string, length string, _row int"
TEXTS = [
    "", None, " ", "  two  spaces ", "one\n\ntwo \n three", "\tTab a", "a b c d", "naïve café, 12 34.5!! it's we'll", "x " * 300,
    "日本語 テキスト 👍🏽 é", "<|endoftext|> in a text", "a" * 4000, "word, " * 2000, "▁under▁ low", "end ",
]


def reference_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def best_fit_decreasing(sizes, limit):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= s]
        if fits:
            _, i = min(fits)
            rooms[i] -= s
        else:
            rooms.append(limit - s)
    return Counter(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    limit = rnd.choice([1, 2, 7, 20, 64, 100])
    sizes = [rnd.choice([rnd.randint(1, limit), 1 + limit // 3]) for _ in range(rnd.randint(0, 300))]
    runs, n = best_fit_plan(dict(Counter(sizes)), limit)
    used, placed = Counter(), Counter()
    ends = {}
    counts = Counter(sizes)
    by_size = {}
    for run in sorted(runs):
        by_size.setdefault(run[0], []).append(run)
    for size, parts in by_size.items():
        for rank in range(counts[size]):
            run = max((r for r in parts if r[1] <= rank), key=lambda r: r[1])
            j = rank - run[1]
            bin_, offset = run[2] + j // run[3], run[4] + j % run[3] * size
            ends.setdefault(bin_, []).append((offset, size))
            used[bin_] += size
            placed[size] += 1
    assert placed == counts
    for pieces in ends.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= limit
    assert set(used) == set(range(n))
    assert Counter(limit - u for u in used.values()) == best_fit_decreasing(sizes, limit)


def test_documents(spark):
    docs = [(i, t, None, "x", "y", i) for i, t in enumerate(TEXTS)] + [(None, "no id", None, None, None, None), (3, TEXTS[3], "", "", "", 0)]
    got = pack_documents(spark.createDataFrame(docs, SCHEMA), *public_vocabulary(), limit=64).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, text in enumerate(TEXTS):
        if i == 3:
            continue
        ids, at = reference_ids(text), 0
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            part = ids[at : at + r["length"]]
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, at, zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
            assert r["length"] == 64 or n == 0
            at += r["length"]
        assert at == len(ids)
    assert len(pieces[3]) == 2 * len([*range(0, len(reference_ids(TEXTS[3])), 64)]) and len(pieces[None]) == 1
    rooms = Counter()
    for r in got:
        rooms[r["sequence_id"]] += r["length"]
    assert max(rooms.values()) <= 64
    assert Counter(64 - v for v in rooms.values()) == best_fit_decreasing([r["length"] for r in got], 64)


def test_hot_length_and_many_partitions(spark):
    pieces = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") % 3 > 0, 700).otherwise(F.col("id") % 2048 + 1).cast("bigint").alias("length")
    )
    got = pack_pieces(pieces).collect()
    assert len(got) == 5000
    seen = {}
    for r in got:
        seen.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seen.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert Counter(2048 - sum(n for _, n in p) for p in seen.values()) == best_fit_decreasing([r["length"] for r in got], 2048)


def test_empty_table_and_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pack_documents(empty, *public_vocabulary()).count() == 0
    row = token_pieces(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), *public_vocabulary(), with_ids=True).first()
    assert list(struct.unpack("<3I", bytes(row["ids"]))) == reference_ids("a b")


def test_ids_with_the_added_token(spark, tmp_path):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = ["a <|endoftext|> b", end, end * 3, f"x  {end}  \n y", f"word{end}word", f" {end}", f"{end} ", "<|endoftext|", f"a b{end}\n\nc d", f"it{end}'s", "no literal here"]
    rnd = random.Random(4)
    texts += ["".join(rnd.choice([end, " ", "\n", "a", "'s", "12", "é", "<|", "word "]) for _ in range(12)) for _ in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in op1_pack_documents(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert got[i] == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))), text
