"""Secret scan against the plain patterns, and the randomness tests on tokens of known origin."""

import base64
import hashlib
import os
import random
import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pandas
import pyarrow as pa
import pyspark
import pytest

from metacurate.llm.secrets import (
    ENCODINGS,
    HEX,
    KINDS,
    LENGTHS,
    RATE,
    base_spans,
    candidates,
    chosen,
    find_secrets,
    inferred_encoding,
    randomness,
    report_bars,
)

SCHEMA = "doc_id bigint, text string, spans string, base int, candidates string"
PLAIN = (
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def brute(text):
    found = sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(PLAIN) for m in p.finditer(text or "") if ok(m))
    spans = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)
    return tuple(sum(k == i for _, k, _ in found) for i in range(3)), hashlib.sha256(spans.encode()).hexdigest(), spans


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r for r in find_secrets(df).collect()}


def test_fixed_patterns(spark):
    rnd = random.Random(8)
    bits = ["password", "PASSWD", "Secret", "toKen", "api_key", "apikey", "ſecret", "apiKey", "=", ":", " ", '"', "'", "abc", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", ".", "\n"]
    texts = [None, "", "token=", "password: short", "token = token=abcdef", "AKIA" * 12, "f" * 23 + "G" + "f" * 24, "x" * 100_000, "a0" * 50_000, "é password='abc.def+/'"]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    got = run(spark, texts)
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i]
        counts, digest, spans = brute(text)
        assert ((r["n_assign"], r["n_access"], r["n_hex"]), r["base_sha256"]) == (counts, digest), text
        assert set(filter(None, spans.split(","))) <= set(r["spans"].split(","))


def test_random_tokens_are_told_from_names(spark):
    rnd = random.Random(2)
    secret = [base64.b64encode(rnd.randbytes(n)).decode() for n in (24, 30, 45, 60) for _ in range(40)]
    secret = [s for s in secret if any(c.isdigit() for c in s)]
    names = [f"{a}-{b}-release-{n}-final" for a in ("customer", "quarterly", "internal") for b in ("migration", "configuration") for n in range(10, 35)]
    names += ["aaaaaaaaaaaaaaaaaaaaaaaa1", "1234567890123456789012345a", "abababababababababab12"]
    texts = [f"word {t} other words" for t in secret + names]
    got = run(spark, texts)
    flagged = ["random:" in got[i]["spans"] for i in range(len(texts))]
    assert sum(flagged[: len(secret)]) > 0.9 * len(secret)
    assert sum(flagged[len(secret) :]) < 0.1 * len(names)
    assert all(got[i]["spans"].startswith(f"random:5:{5 + len(t)}") for i, t in enumerate(secret) if flagged[i])


def test_p_values_are_near_uniform():
    rnd = random.Random(3)
    for n, alphabet in ((24, "0123456789abcdef"), (40, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")):
        tokens = ["".join(rnd.choice(alphabet) for _ in range(n)) for _ in range(1500)]
        ps = [randomness(t, e) for t in tokens if (e := inferred_encoding(t)) is not None and set(alphabet) <= set(alphabet)]
        for q in (0.05, 0.25, 0.5):
            assert abs(sum(p <= q for p in ps) / len(ps) - q) < 0.1


def test_bars():
    even = {b: 10 for b in range(100)}
    assert report_bars({}) == {}
    assert report_bars({1: even, 2: {70: 1}, 3: {5: 1}}) == {1: 0.01, 2: 0.01, 3: 0.01}
    assert report_bars({1: {**even, 1: 400, 2: 400}})[1] == 0.03
    assert report_bars({1: {**even, **{b: 400 for b in range(50)}}})[1] == 0.5
    assert report_bars({1: {**even, 1: 60}}, rate=0.5)[1] == 0.01


def identifiers():
    """Names with a digit of 20 and more characters in the Python sources of this machine."""
    names = set()
    for module in (pyspark, pandas, pa, np, os):
        for file in Path(module.__file__).parent.rglob("*.py"):
            names.update(re.findall(r"\b[A-Za-z_][A-Za-z0-9_]{19,79}\b", file.read_text(errors="ignore")))
    return sorted(n for n in names if any(c.isdigit() for c in n))


def test_false_share_and_recall_among_real_names(spark):
    """Keys of each alphabet and length among four names a key, most of them real: false share by length, and recall."""
    rnd = random.Random(13)
    names = [n for n in identifiers() if not HEX.search(n)]
    assert len(names) >= 400
    made = [f"get{a}{b}By{c}{i}{d}" for a in ("User", "Order", "Invoice") for b in ("Profile", "History", "Summary") for c in ("Id", "Name", "Account")
            for d in ("HandlerFactory", "ServiceImpl", "RepositoryTest") for i in range(10, 50)]
    keys = ["".join(rnd.choices(a, k=n)) for _, a in ENCODINGS[1:] for n in (22, 28, 40, 56, 72) for _ in range(12)]
    keys = [k for k in keys if any(c.isdigit() for c in k) and any(c.isalpha() for c in k) and k[0].isalnum() and k[-1].isalnum()]
    junk = rnd.sample(names, min(len(names), 3 * len(keys))) + rnd.sample(made, len(keys))
    got = run(spark, [f"a {t} b" for t in keys + junk])
    flagged = [f"random:2:{2 + len(t)}" in got[i]["spans"].split(",") for i, t in enumerate(keys + junk)]
    assert sum(flagged[: len(keys)]) >= 0.9 * len(keys)
    false, true, real = Counter(), Counter(), set(keys)
    for t, f in zip(keys + junk, flagged, strict=True):
        if f:
            (true if t in real else false)[sum(len(t) >= b for b in LENGTHS)] += 1
    assert false.total() <= RATE * (false + true).total(), (false, true)
    for length in range(len(LENGTHS) + 1):  # the rate bounds an expected share: two standard deviations of chance
        n = false[length] + true[length]
        assert false[length] <= RATE * n + 2 * (RATE * (1 - RATE) * n) ** 0.5, (length, false, true)
    alone = [rnd.choice(names) for _ in range(99)] + ["q7Xw2LkTz9VbN4mR8sYc1PdHf6GjE"]
    assert "random:" in run(spark, alone)[99]["spans"]


def test_long_texts_take_linear_work():
    rnd = random.Random(14)
    seconds = []
    for n in (8000, 16_000):
        text = " ".join(f"{rnd.getrandbits(128):032x} some_name_{i}_of_customers" for i in range(n))
        spans = base_spans(text)
        begun = time.monotonic()
        found = candidates(text, spans)
        chosen([x[:4] for x in found], {})
        seconds.append(time.monotonic() - begun)
        assert len(spans) >= n * 0.99
    assert seconds[1] < 2.5 * seconds[0] + 0.5 and seconds[1] < 20


@pytest.mark.parametrize("text", ["tiny", None])
def test_small_tables(spark, text):
    assert run(spark, []) == {}
    r = run(spark, [text])[0]
    assert r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_junk_elsewhere_does_not_lose_keys(spark):
    rnd = random.Random(6)
    keys = ["".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=40)) for _ in range(500)]
    slugs = [f"CustomerMigrationRelease{rnd.randint(1000, 9999)}InternalCopy" for _ in range(99 * len(keys))]
    junk = [" ".join(slugs[i : i + 100]) for i in range(0, len(slugs), 100)]
    alone, mixed = run(spark, keys), run(spark, keys + junk)
    assert [alone[i]["spans"] for i in range(len(keys))] == [mixed[i]["spans"] for i in range(len(keys))]
    assert sum("random:" in mixed[i]["spans"] for i in range(len(keys))) >= 0.95 * len(keys)


def test_values_and_path_segments(spark):
    key, url_key, mixed = "wJa1rXUtnFEMK7MDENGbPxRf", "Zk3v9Q-x7Lm2_PqR8sTuWyB4nC", "q7Xw/2Lk+Tz9VbN4mR8sYc1/PdHf6GjE"
    texts = [
        f"AWS_ACCESS_KEY_2={key}", f"export A=1 B={key}== x", f"see https://h.example/a?x=1&sig={url_key}&y=2", f"https://h.example/some-long-name/{url_key}/index-page",
        f"https://h.example/articles/customers/{key}/configuration/quarterly", f"integrity=sha256-{mixed}=", f"NAME={key}=tail",
    ]
    got = run(spark, texts)
    for i, (text, found) in enumerate(zip(texts, (key, f"{key}==", url_key, url_key, key, f"{mixed}=", key), strict=True)):
        start = text.index(found)
        assert f"random:{start}:{start + len(found)}" in got[i]["spans"].split(","), (text, got[i]["spans"])
