"""Personal data: fixed patterns as seeds, and identifiers that their contexts give away.

The entities that the fixed patterns find are seeds. The words around an entity
are lexical patterns; the words around any other token with a digit in it are
too. Patterns and instances form a graph whose edges are counted over all
documents. In rounds, a pattern scores as the mean score of its distinct
instances, shrunk by a prior, and an unseen instance as the noisy-or of its
patterns. Tokens next to a pattern that ends up with high confidence are found.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.llm.ngrams import small_batches
from metacurate.llm.registry import query, table
from metacurate.operators.checkpoints import stored
from metacurate.operators.joins import join_unique

# The patterns of the scan. A match that fails its check is used up and dropped.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "id")

_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"\S+")
_LONG = 64
ROUNDS = 3
MIN_SUPPORT = 3.0
MIN_SCORE = 0.8
PRIOR = 1.0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of a local part, ``@`` and a dotted domain, in linear time."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        at += 1
        if domain:
            yield start, domain.end()
            done = at = domain.end()
        else:
            done = max(done, at)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``kind, start, end`` of the fixed patterns, by kind and start."""
    found = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.groups()):
                found.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def _short(word: str) -> str:
    """A word as part of a key; a long one by its digest."""
    return word if len(word) <= _LONG else hashlib.blake2b(word.encode(), digest_size=12).hexdigest()


def contexts(text: str, spans: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, str, list[str], bool]]:
    """``start, end, instance, patterns, seed`` of the fixed spans and of other tokens with a digit."""
    if not spans and not _DIGIT.search(text):
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    starts, ends = [s for s, _ in words], [e for _, e in words]
    covered = sorted((s, e) for _, s, e in spans)
    places = [(s, e, True) for s, e in covered]
    begins = [s for s, _ in covered]
    reach = list(accumulate((e for _, e in covered), max))  # the furthest end up to each span
    last = -1
    for m in _DIGIT.finditer(text):
        i = bisect_right(starts, m.start()) - 1
        if i != last:
            last = i
            s, e = words[i]
            while s < e and not text[s].isalnum():
                s += 1
            while e > s and not text[e - 1].isalnum():
                e -= 1
            before = bisect_left(begins, e)
            if e - s >= 4 and (before == 0 or reach[before - 1] <= s):
                places.append((s, e, False))
    out = []
    for s, e, seed in places:
        before = words[max(0, bisect_right(ends, s) - 2) : bisect_right(ends, s)]
        after = words[bisect_left(starts, e) : bisect_left(starts, e) + 2]
        patterns = []
        for side, near in (("<", before), (">", after)):
            if len(near) == 2:
                patterns.append(" ".join([side, *(_short(text[a:b].lower()) for a, b in near)]))
        if patterns:
            out.append((s, e, _short(text[s:e].lower()), patterns, seed))
    return out


def scan(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns, fixed spans and contexts of each row, and a ``_row`` id."""
    kept = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    span = "array<struct<kind:int,start:bigint,stop:bigint>>"
    context = "array<struct<start:bigint,stop:bigint,instance:string,patterns:array<string>,seed:boolean>>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "_text"), f"_base {span}, _contexts {context}"])
    span_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))
    context_type = pa.list_(
        pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("instance", pa.string()), ("patterns", pa.list_(pa.string())), ("seed", pa.bool_())])
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            base, around = [], []
            for text in batch.column("_text"):
                text = text.as_py()
                spans = base_spans(text)
                base.append([{"kind": k, "start": s, "stop": e} for k, s, e in spans])
                around.append([{"start": s, "stop": e, "instance": i, "patterns": p, "seed": x} for s, e, i, p, x in contexts(text, spans)])
            columns = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(base, span_type), pa.array(around, context_type)],
                names=[*columns, "_base", "_contexts"],
            )

    return kept.mapInArrow(find, schema).withColumn("_row", F.monotonically_increasing_id())


def confident_patterns(
    edges: DataFrame, rounds: int = ROUNDS, min_support: float = MIN_SUPPORT, min_score: float = MIN_SCORE, prior: float = PRIOR
) -> DataFrame:
    """Patterns of ``edges(pattern, instance, seed)`` that score at least ``min_score``, as ``pattern, score``.

    A pattern's score is the sum of its distinct instances' scores over their
    number plus ``prior``; it counts from a sum of ``min_support`` on. Seeds
    score 1, other instances 0 at first and then the noisy-or of their patterns.
    """
    edges = stored(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    scored = edges.select("pattern", "instance", "seed", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("score"))
    for i in range(rounds):
        total = scored.groupBy("pattern").agg(F.sum("score").alias("total"), F.count("*").alias("n"))
        patterns = stored(
            total.where(F.col("total") >= min_support).select("pattern", (F.col("total") / (F.col("n") + prior)).alias("belief")), "patterns"
        )
        if i + 1 < rounds:
            doubt = F.exp(F.sum(F.log1p(-F.least("belief", F.lit(0.999)))))
            instances = join_unique(edges.where("NOT seed"), patterns, "pattern").groupBy("instance").agg((1 - doubt).alias("found"))
            scored = stored(
                join_unique(edges, instances, "instance", "left").select(
                    "pattern", "instance", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("found", F.lit(0.0))).alias("score")
                ),
                "scored",
            )
    return patterns.where(F.col("belief") >= min_score).select("pattern", F.col("belief").alias("score"))


def find_pii(docs: DataFrame, keep: Sequence[str] = ("doc_id",), **options) -> DataFrame:
    """Personal data in ``docs(text)``: ``keep`` columns and ``pii``, one row for each row.

    ``pii`` lists ``kind, start, stop`` by kind and start: the fixed kinds, then
    ``id`` (kind 4) for tokens beside a confident pattern. Positions are code points.
    A null text is empty; equal rows are found alike. The rows are scanned
    once and stored, with ``keep`` (list ``text`` there if you need it next to the
    spans); only contexts are joined, through joins that split hot patterns.
    """
    found = stored(scan(docs, keep), "pii_scan")
    near = found.select("_row", F.explode("_contexts").alias("c")).select("_row", "c.*")
    edges = near.select(F.explode("patterns").alias("pattern"), "instance", "seed")
    good = confident_patterns(edges, **options)
    open_ = near.where("NOT seed").select("_row", "start", "stop", F.explode("patterns").alias("pattern"))
    extra = (
        join_unique(open_, good, "pattern", "left_semi").select("_row", F.struct(F.lit(4).alias("kind"), "start", "stop").alias("s"))
        .groupBy("_row").agg(F.array_distinct(F.collect_list("s")).alias("more"))
    )  # a row's spans are bounded by its text
    more = stored(extra, "pii_found")
    joined = join_unique(found, more, "_row", "left")
    spans = F.sort_array(F.concat("_base", F.coalesce("more", F.array().cast("array<struct<kind:int,start:bigint,stop:bigint>>"))))
    return joined.select(*keep, spans.alias("pii"))


def span_digests(found: DataFrame) -> DataFrame:
    """Counts per fixed kind, the SHA-256 of the fixed spans, and all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["stop"])), ",")
    of = lambda k: F.size(F.filter("pii", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    return found.select(
        "doc_id", *[of(k) for k in range(4)],
        F.sha2(text(F.filter("pii", lambda x: x["kind"] < 4)), 256).alias("base_sha256"), text(F.col("pii")).alias("spans"),
    )


def redacted(found: DataFrame, text: str = "text") -> DataFrame:
    """Replace each span of ``pii`` in ``text`` by its kind in brackets; spans that overlap become one, named by the first."""

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for value, spans in zip(batch.column(text).to_pylist(), batch.column("pii").to_pylist(), strict=True):
                if spans:
                    parts, at = [], 0
                    for s in sorted(spans, key=lambda s: (s["start"], -s["stop"])):
                        if s["start"] >= at:
                            parts += [value[at : s["start"]], f"[{KINDS[s['kind']].upper()}]"]
                        at = max(at, s["stop"])
                    value = "".join(parts) + value[at:]
                out.append(value)
            names = [c for c in batch.schema.names if c != "pii"]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == text else batch.column(c) for c in names], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name != "pii")
    return found.mapInArrow(redact, schema)


@query("op7_personal_data")
def op7_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return span_digests(find_pii(table(spark, sf, "documents")))
