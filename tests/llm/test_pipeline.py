"""The corpus pipeline on a small table, each stage against a brute-force version of it."""

import random
import re
import struct
import zlib
from collections import Counter

import corpus_pipeline
import test_jaccard
import test_packing
import test_pii
import test_quality

WORDS = [f"{a}{b}" for a in "klmnoprst" for b in ("at", "en", "ing", "or", "us")]
SCHEMA = "doc_id bigint, text string, n_chars bigint, kept string, component string, _row int"
PERSONAL = ["a.b@mail.example.com", "10.20.30.40", "4539 5787 6362 1486", "+1 555 010 9999"]


def fixture(rnd):
    texts, good = [], []
    for i in range(150):
        w = [rnd.choice(WORDS) for _ in range(rnd.randint(60, 160))]
        good.append(i % 4 > 0)
        if not good[-1]:
            w = [x + rnd.choice(["%%%", "###", "|"]) for x in w]
        elif i % 5 == 0:
            w.insert(rnd.randrange(len(w)), PERSONAL[i // 5 % 4])
        texts.append(w)
    for i in range(0, 150, 3):  # near and exact copies, on both sides of the threshold
        if good[i]:
            w = list(texts[i])
            for _ in range(rnd.randint(0, 5)):
                w[rnd.randrange(len(w))] = rnd.choice(WORDS)
            texts.append(w)
            good.append(True)
    texts.append([rnd.choice(WORDS) for _ in range(5000)])  # longer than a sequence
    good.append(True)
    rows = [(i, " ".join(w), None) for i, w in enumerate(texts)]
    rows += [(1, rows[1][1], None), (None, rows[2][1], None), (900, None, None), (901, "", 0), (902, "too short", 9)]
    rows = [(*r, "x", "y", 1) for r in rows]
    rnd.shuffle(rows)
    return rows, [(i, int(g), 0, None) for i, g in enumerate(good)]


def no_personal_data(text):
    found = [
        (m.start(), m.end(), k) for k, (p, ok) in enumerate(test_pii.PLAIN) for m in re.finditer(p, text) if ok(m)
    ]
    for start, end, k in sorted(found, reverse=True):
        text = text[:start] + f"[{test_pii.KINDS[k].upper()}]" + text[end:]
    return text


def test_stages(spark, tmp_path, monkeypatch):
    docs, labels = fixture(random.Random(4))
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, test_quality.LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    seen = []

    def stored(df, label):
        seen.append(keep(df, label))
        return seen[-1]

    keep = corpus_pipeline.stored
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, label: stored(df, label) if label != "kept_ids" else keep(df, label))
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert len(seen) == len(corpus_pipeline.STAGES) == 4
    assert all(s.schema.simpleString() == seen[0].schema.simpleString() and s.columns == [c.split()[0] for c in SCHEMA.split(", ")] for s in seen[:3])
    good, single, clean = (sorted((tuple(r) for r in s.collect()), key=repr) for s in seen[:3])

    # quality rules: none that fails the fixed ones stays, every good one does, and few of the others
    truth = {d: bool(q) for d, q, _, _ in labels}
    passed = []
    for row in docs:
        n, _, _, _, repeated = test_quality.brute(row[1])
        if n >= 50 and 100 * repeated <= 50 * n:
            passed.append(row)
    assert not Counter(good) - Counter(passed)
    assert all(truth[r[0]] is False for r in (Counter(passed) - Counter(good)).elements())
    assert sum(truth.get(r[0]) is False for r in good) <= 0.03 * len(passed)

    # one document of each group, the one with the smallest id
    found = test_jaccard.brute([r[:2] for r in good], 5, 80)
    first = {d for d, _, component in found if d is not None and d == component}
    assert 0 < len(first) < len({r[0] for r in good}) - 5
    assert single == sorted({r for r in good if r[0] in first} | {r for r in good if r[0] is None}, key=repr)

    # personal data
    assert clean == sorted(((d, t := no_personal_data(text), len(t), *rest) for d, text, _, *rest in single), key=repr)
    assert sum("[" in r[1] for r in clean) > 5

    # packing
    pieces = {}
    for r in result.collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == {r[0] for r in clean}
    rooms, lengths = {}, []
    for d, text, *_ in clean:
        ids, at = test_packing.reference_ids(text), 0
        for n, r in enumerate(sorted(pieces[d], key=lambda r: r["piece"])):
            part = ids[at : at + r["length"]]
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, at, zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
            at += r["length"]
            lengths.append(r["length"])
            rooms.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert at == len(ids)
    for parts in rooms.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert Counter(2048 - sum(n for _, n in p) for p in rooms.values()) == test_packing.best_fit_decreasing(lengths, 2048)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], test_quality.LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_kept_ids_move_no_texts(spark, monkeypatch):
    texts = [*[(i, f"{i} a{i} b{i} c{i} d{i} e{i}") for i in range(50)], (7, "x"), (None, "y")]
    docs = spark.createDataFrame([(i, text, len(text), None, None, 0) for i, text in texts], SCHEMA)
    wanted, threshold = None, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, joins in ((1 << 20, 0), (10, 2)):
            monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", most)
            kept = corpus_pipeline.keep_one_of_each(spark, docs, "")
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == joins
            got = sorted((r["doc_id"] for r in kept.collect()), key=repr)
            wanted = wanted or got
            assert got == wanted == sorted([*range(50), None], key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
