"""Licence scan against a scan of the words, place by place."""

import random
import re
import time

from metacurate.llm.licences import BASE, NOTICES, scan_licences

SCHEMA = "doc_id bigint, text string, words string, hits int, places string, n_words string"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    places = [
        (i, t.label) for t in BASE for i in range(len(words)) if words[i : i + len(t.words)] == t.words
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def scan(spark, texts):
    df = spark.createDataFrame([(i, t, "a", 1, "b", "c") for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r for r in scan_licences(df).collect()}


def test_base_places(spark):
    rnd = random.Random(4)
    vocabulary = "under the mit license apache version 2 cc by nc MIT İ K é x".split()
    texts = [
        None, "", " .,; ", "Under the MIT License.", "cc-by-nc cc by nc, CC BY\nNC", "cc by nc by nc cc by", "under the mit licence",
        "apache license, version 2.0 apache license version 2", "under the\x00mit\x7flicense", "undér the mit license", "x " * 30_000 + "cc by nc",
        "under the mit license " * 3000,
    ]
    texts += [" ".join(rnd.choice(vocabulary) + rnd.choice(["", ".", "-", "\n"]) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    got = scan(spark, texts)
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text), text
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(","))))


def test_notices(spark):
    texts = [t.text for t in NOTICES] + [
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the gnu general licence", "rights reserved all", "All rights reserved.",
        "permission is hereby granted free of charge to any person buying a copy of this software", "permission is hereby granted",
    ]
    got = scan(spark, texts)
    for i, t in enumerate(NOTICES):
        assert t.label in got[i]["labels"].split(","), t
    n = len(NOTICES)
    assert [got[n + i]["labels"] for i in range(6)] == ["gpl-3", "", "", "proprietary", "mit", ""]


def test_empty_table(spark):
    assert scan(spark, []) == {}


def test_long_texts_take_linear_work(spark):
    phrase = "under the mit license apache license version 2 permission is hereby granted free of charge "
    scan(spark, [phrase])
    seconds = []
    for n in (6000, 12_000):
        begun = time.monotonic()
        got = scan(spark, [phrase * n])[0]
        seconds.append(time.monotonic() - begun)
        assert (got["n_words"], got["n_base"], got["labels"]) == (15 * n, 2 * n, "apache-2,mit")
    assert seconds[1] < 2.5 * seconds[0] + 3 and seconds[1] < 60
