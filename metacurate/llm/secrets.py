"""Secret scan: fixed patterns, and tokens that a battery of randomness tests does not tell from random ones."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.llm.registry import query, table
from metacurate.operators.checkpoints import stored

# The patterns of the scan. A match that is too short is used up and dropped.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters with the prefix; a run is taken whole
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
_SPANS = "array<struct<start:bigint,kind:int,stop:bigint>>"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", _DIGITS + "abcdef"), ("hex upper", _DIGITS + "ABCDEF"), ("base32", _UPPER + "234567"), ("base36", _DIGITS + _LOWER),
    ("base62", _UPPER + _LOWER + _DIGITS), ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("base64 url", _UPPER + _LOWER + _DIGITS + "-_"),
)
MIN_LENGTH = 20
# "=" stands only as trailing padding. The classes overlap: segments between "/" and parts beside "-" are candidates of their own.
TOKENS = tuple(re.compile(f"[{c}]{{{MIN_LENGTH},}}(?:=++(?![A-Za-z0-9+/_-]))?") for c in ("A-Za-z0-9+/", "A-Za-z0-9_-", "A-Za-z0-9+"))
RATE = 0.1  # estimated share of false tokens among the reported ones of a stratum, at most
FLOOR = 0.01  # no token of a smaller p-value is reported
LENGTHS = (24, 32, 48, 64)  # a stratum is an encoding and the number of these bounds that a token reaches
_BINS = 100  # bins of p-values
_VALUES = [{c: i for i, c in enumerate(a)} for _, a in ENCODINGS]
_SETS = [set(a) for _, a in ENCODINGS]
_COMMON = frozenset("AEILNORSTaeilnorst")  # letters that make up two thirds of English words, and a third of the alphabet


def _shares(parts: Sequence[object]) -> tuple[list[int], list[float]]:
    """The part of each symbol, numbered, and the share of each part."""
    names = sorted(set(parts), key=str)
    return [names.index(x) for x in parts], [parts.count(x) / len(parts) for x in names]


def _class(c: str) -> str:
    return "digit" if c.isdigit() else "upper" if c.isupper() else "lower" if c.islower() else "other"


_CLASSES = [_shares([_class(c) for c in a]) for _, a in ENCODINGS]
_GROUPS = [_shares([(_class(c), c in _COMMON) for c in a]) for _, a in ENCODINGS]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the fixed patterns, leftmost and without overlap within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def inferred_encoding(token: str) -> int | None:
    """The first alphabet that has all characters of the token, padding aside."""
    seen = set(token.rstrip("="))
    return next((i for i, s in enumerate(_SETS) if seen <= s), None)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared(values: list[int], shares: list[float]) -> float:
    """Upper tail of chi-squared against the given shares, with the exact mean and variance for short texts."""
    n, k = len(values), len(shares)
    counts = [0] * k
    for v in values:
        counts[v] += 1
    x = sum(c * c / p for c, p in zip(counts, shares, strict=True)) / n - n
    variance = 2 * (k - 1) + (sum(1 / p for p in shares) - k * k - 2 * k + 2) / n
    freedom = 2 * (k - 1) ** 2 / variance
    ratio = x / (k - 1)  # chi-squared over its degrees of freedom, by matched moments
    z = (ratio ** (1 / 3) - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom))
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity(values: list[int], encoding: int) -> float:
    """Equal use of the symbols, and of the groups that words use unequally; the smaller p-value counts, as of two tests."""
    groups, shares = _GROUPS[encoding]
    k = len(_VALUES[encoding])
    return 1 - (1 - min(chi_squared(values, [1 / k] * k), chi_squared([groups[v] for v in values], shares))) ** 2


def runs(values: list[int], encoding: int) -> float:
    """Lower tail of the number of runs of capitals, small letters, digits and signs; names have few."""
    classes, shares = _CLASSES[encoding]
    n, seen = len(values), [classes[v] for v in values]
    change = 1 - sum(p * p for p in shares)
    both = sum(p * (1 - p) ** 2 for p in shares)  # a change on either side of a symbol
    variance = (n - 1) * change * (1 - change) + 2 * (n - 2) * (both - change * change)
    found = sum(a != b for a, b in zip(seen, seen[1:], strict=False))
    return 0.5 * math.erfc(((n - 1) * change - found) / math.sqrt(2 * variance))


def serial_correlation(values: list[int], k: int) -> float:
    """Two-sided test of the correlation of neighbours."""
    mean, variance = (k - 1) / 2, (k * k - 1) / 12
    product = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:], strict=False))
    return _two_sided(product / (variance * math.sqrt(len(values) - 1)))


def randomness(token: str, encoding: int) -> float:
    """Combined p-value of the three tests for a token that is random in its encoding (Fisher's method)."""
    table_ = _VALUES[encoding]
    values = [table_[c] for c in token.rstrip("=")]
    k = len(table_)
    half = -sum(math.log(max(p, 1e-30)) for p in (uniformity(values, encoding), runs(values, encoding), serial_correlation(values, k)))
    return math.exp(-half) * (1 + half + half * half / 2)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float, int]]:
    """``start, end, stratum, p, digest`` of tokens with letters and digits outside the fixed spans that may be random."""
    begins = [s for s, _, _ in spans]
    reach = list(accumulate((e for _, _, e in spans), max))  # the furthest end up to each span
    out = []
    for start, end in sorted({m.span() for pattern in TOKENS for m in pattern.finditer(text)}):
        token = text[start:end]
        if token.isalpha() or not any(c.isdigit() for c in token) or not any(c.isalpha() for c in token):
            continue
        i = bisect_left(begins, end)
        if i and reach[i - 1] > start:
            continue
        encoding = inferred_encoding(token)
        p = min(randomness(token, encoding), 1.0)
        if p > FLOOR / 10:
            stratum = encoding * (len(LENGTHS) + 1) + bisect_right(LENGTHS, len(token))
            out.append((start, end, stratum, p, int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "little", signed=True)))
    return out


def chosen(found: Sequence[tuple[int, int, int, float]], bars: dict[int, float]) -> list[tuple[int, int]]:
    """Spans of the tokens ``start, end, stratum, p`` over the bar of their stratum.

    Of tokens that overlap the longest is taken. A token that fails by little has
    its whole span reported if a part of it passes, or a key would lose its ends.
    """
    passed = sorted((s, e) for s, e, stratum, p in found if p > bars.get(stratum, FLOOR))
    for start, end in [(s, e) for s, e, stratum, p in found if p <= bars.get(stratum, FLOOR)]:
        i = bisect_left(passed, (start, start))
        if i < len(passed) and passed[i][1] <= end:
            passed.insert(i, (start, end))
    out: list[tuple[int, int]] = []
    for start, end in sorted(passed, key=lambda x: (x[0] - x[1], x)):
        i = bisect_left(out, (start, end))
        if (i == 0 or out[i - 1][1] <= start) and (i == len(out) or end <= out[i][0]):
            out.insert(i, (start, end))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """Fixed spans, counts and possibly random tokens of each row; null texts are empty."""
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())])
    token = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("stratum", pa.int32()), ("p", pa.float64()), ("token", pa.int64())])
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
        ("base_sha256", pa.string()), ("spans", pa.list_(span)), ("tokens", pa.list_(token)),
    ])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                spans = base_spans(text)
                n = [sum(k == i for _, k, _ in spans) for i in range(3)]
                digest = hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
                base = [{"start": s, "kind": k, "stop": e} for s, k, e in spans]
                tokens = [{"start": s, "stop": e, "stratum": x, "p": p, "token": h} for s, e, x, p, h in candidates(text, spans)]
                out.append({"doc_id": doc, "n_assign": n[0], "n_access": n[1], "n_hex": n[2], "base_sha256": digest, "spans": base, "tokens": tokens})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        find,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
        f"spans {_SPANS}, tokens array<struct<start:bigint,stop:bigint,stratum:int,p:double,token:bigint>>",
    )


def report_bars(histogram: dict[int, dict[int, int]], rate: float = RATE, floor: float = FLOOR) -> dict[int, float]:
    """For each stratum the p-value that a token has to exceed, from its counts per bin of p-values.

    The p-values of random tokens are uniform, so their number follows from the
    upper half of the bins, where other tokens are few. What stands above a bar in
    excess of that number is false. The bar is the lowest from ``floor`` on whose
    excess is at most ``rate`` of what is reported, and one half if there is none.
    Each length has bars of its own, so the many short tokens, on which the tests
    have little power, do not move the bar of long ones.
    """
    bars = {}
    for stratum, bins in histogram.items():
        density = (sum(n for b, n in bins.items() if 2 * b >= _BINS) + 1) * 2 / _BINS
        bars[stratum] = 0.5
        for bar in range(round(floor * _BINS), _BINS // 2):
            reported = sum(n for b, n in bins.items() if b >= bar)
            if reported - density * (_BINS - bar) <= rate * reported:
                bars[stratum] = bar / _BINS
                break
    return bars


def stratum_bars(found: DataFrame, rate: float = RATE, floor: float = FLOOR) -> dict[int, float]:
    """Bars over all rows. A token counts once however often it stands, so that no hot source moves a bar."""
    tokens = found.select(F.explode("tokens").alias("t")).select(
        F.col("t.stratum").alias("stratum"), F.least(F.floor(F.col("t.p") * _BINS), F.lit(_BINS - 1)).alias("bin"), F.col("t.token").alias("token")
    ).distinct()
    histogram: dict[int, dict[int, int]] = {}
    for r in tokens.groupBy("stratum", "bin").count().collect():  # at most strata times bins
        histogram.setdefault(r["stratum"], {})[r["bin"]] = r["count"]
    return report_bars(histogram, rate, floor)


def with_random_spans(found: DataFrame, bars: dict[int, float]) -> DataFrame:
    """``spans`` with those of the tokens over their bars behind the fixed ones."""
    columns = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for base, tokens in zip(batch.column("spans").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                more = chosen([(t["start"], t["stop"], t["stratum"], t["p"]) for t in tokens], bars) if tokens else []
                spans.append(base + [{"start": s, "kind": 3, "stop": e} for s, e in more])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(spans, batch.schema.field("spans").type)], names=[*columns, "spans"])

    return found.mapInArrow(choose, f"doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans {_SPANS}")


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Secrets of ``docs(doc_id, text)``, one row for each row.

    Counts of the fixed kinds, the SHA-256 of their ``kind:start:end``, and
    ``spans``, which adds ``random`` spans: tokens of at least 20 characters with
    letters and digits, among them the values after "=" and the segments between
    "/", whose combined p-value as random strings of their inferred encoding (see
    ``randomness``) is over the bar of their encoding and length (``report_bars``):
    at least ``FLOOR``, and such that of a stratum's reported tokens an estimated
    share of at most ``rate`` is false. The estimate takes p-values over one half
    for those of random tokens, so it does not see the few names that reach them;
    where names are far more than keys, the true share can be higher. Positions are code points. A null text is empty, a
    null id stays; repeated rows are scanned alike and their tokens count once. The
    work grows linearly with a text. Rows are scanned once and stored without texts.
    """
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(F.sort_array("spans"), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["stop"]))
    found = stored(scan(docs), "secret_tokens")
    chosen_ = with_random_spans(found, stratum_bars(found, rate))
    return chosen_.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(text, ",").alias("spans"))


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return find_secrets(table(spark, sf, "documents"))
