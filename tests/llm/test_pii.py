"""Personal data against the plain patterns, and identifiers found through contexts."""

import hashlib
import random
import re
import time

import pyarrow as pa

from metacurate.llm import pii
from metacurate.llm.pii import KINDS, base_spans, contexts, find_pii, redacted, span_digests

SCHEMA = "doc_id bigint, text string, pii string, _base int, _row string"


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


PLAIN = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m[0])) <= 19 and luhn(re.sub("[^0-9]", "", m[0]))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15),
)


def brute(text):
    found = [(k, m.start(), m.end()) for k, (p, ok) in enumerate(PLAIN) for m in re.finditer(p, text or "") if ok(m)]
    spans = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in found)
    return tuple(sum(f[0] == k for f in found) for k in range(4)), hashlib.sha256(spans.encode()).hexdigest()


def run(spark, texts, **options):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r for r in span_digests(find_pii(df, **options)).collect()}


def test_fixed_patterns(spark):
    rnd = random.Random(6)
    bits = ["a", "b.c", "@", ".", "-", "1", "25", "256", "0", "4539578763621486", "+", "(", ")", " ", "é", "\n", "x@y.zz", "10.0.0.1", "_", "٣"]
    texts = [
        None, "", "@", "a@b", "a@b.c@d.e", "a@@b.c", "x@y..z", "4539 5787 6362 1486", "4539-5787-6362-1487", "+1 (555) 010-9999", "1.2.3.4.5.6.7.8",
        "0001.2.3.04", "1" * 100_000, "a" * 100_000 + "@", "+1" + " " * 50_000 + "2", "@." * 20_000, "1 " * 20_000, "+" * 1000, "a.b@c.d-e.f.",
    ]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(600)]
    got = run(spark, texts)
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert ((r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]), r["base_sha256"]) == brute(text), text and text[:99]


def test_contexts_find_unseen_identifiers(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    texts = [f"{word()} {word()} please contact user{i}@mail.example.com about {word()}" for i in range(30)]
    texts += [f"{word()} please contact KX-{1000 + i} about {word()}" for i in range(5)]  # no fixed pattern has these
    texts += [f"{word()} in the year 20{10 + i} about {word()}" for i in range(20)] + [f"in the year of a{i}@b.example.com" for i in range(3)]
    got = run(spark, texts)
    for i, text in enumerate(texts):
        found = [s for s in got[i]["spans"].split(",") if s.startswith("id:")]
        if "KX-" in text:
            at = text.index("KX-")
            assert found == [f"id:{at}:{at + 7}"]
        else:
            assert not found, text


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é mail a@b.cc or +1 555 010 9999!", "x", 1, "y"), (2, None, None, None, None), (3, "none", "", 1, "")], SCHEMA)
    got = {r["doc_id"]: r["text"] for r in redacted(find_pii(df, ["doc_id", "text"])).collect()}
    assert got == {1: "é mail [EMAIL] or [PHONE]!", 2: None, 3: "none"}
    overlap = spark.createDataFrame([(1, "+1 10.0.0.1 2345678", "x", 1, "y")], SCHEMA)
    assert redacted(find_pii(overlap, ["text"])).first()["text"] == "[PHONE]"


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_long_texts_take_linear_work():
    seconds = []
    for n in (10_000, 20_000):
        text = "".join(f"host{i} 10.0.{i % 256}.1 user{i}@a.example code-{i}x took {i} ms\n" for i in range(n))
        begun = time.monotonic()
        found = contexts(text, base_spans(text))
        seconds.append(time.monotonic() - begun)
        assert sum(seed for *_, seed in found) == 2 * n and sum(not seed for *_, seed in found) >= 2 * n
    assert seconds[1] < 2.5 * seconds[0] + 0.5 and seconds[1] < 10


def test_tokens_inside_fixed_spans_are_no_instances():
    rnd = random.Random(9)
    for _ in range(300):
        text = " ".join(rnd.choice(["1.2.3.4", "a1@b.cd", "+1 555 010 9999", "key-77x", "4539 5787 6362 1486", "word", "x9999"]) for _ in range(12))
        spans = base_spans(text)
        found = {(s, e) for s, e, *_, seed in contexts(text, spans) if not seed}
        assert all(e <= a or b <= s for s, e in found for _, a, b in spans)
        starts = [m.start() for m in re.finditer("key-77x|x9999", text)]
        free = {s for s in starts if not any(a < s + 5 and s < b for _, a, b in spans)}
        assert free <= {s for s, _ in found} or len(text.split()) < 3


def test_rows_are_scanned_in_small_batches():
    batch = pa.RecordBatch.from_pydict({"n": list(range(1000))})
    cut = list(pii.small_batches(iter([batch, batch.slice(0, 0), batch.slice(0, 300)])))
    assert max(b.num_rows for b in cut) <= 256
    assert [x for b in cut for x in b.column("n").to_pylist()] == [*range(1000), *range(300)]
