"""SimHash near-duplicates by the generalised pigeonhole principle.

If two fingerprints differ in at most ``d`` bits and their bits are cut into
partitions with thresholds ``t_i`` that add up to ``d - m + 1``, they differ in
at most ``t_i`` bits of some partition. Bits that go together share a
partition, so that the others stay selective. Each fingerprint gets thresholds
of its own: a dynamic programme over the partitions minimises the candidates
that counts over all fingerprints let expect, and a partition in which its value
is common may get -1, which means not asked at all. It then looks up all values
within the threshold, and candidates are verified on the whole fingerprint.

Equal fingerprints are one node. Of the links only those are kept that join
something not joined yet, since classes are what is wanted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from xxhash import xxh64_intdigest

from metacurate.llm.graphs import components
from metacurate.llm.ngrams import mix
from metacurate.llm.registry import query, table
from metacurate.operators.checkpoints import stored
from metacurate.operators.joins import join_unique

BITS = 64
SEED = 42
MOST_PARTITIONS = 4
TABLE_BITS = 16  # bits of a partition whose values are counted one by one; 2 ** TABLE_BITS counts a partition
ROW_COST = 100.0  # a row of the index or of a look-up, in comparisons
BUCKET = 1 << 15  # rows of an index key that one task compares
CHUNK = 1 << 17
_SHORT = 64
_STEP = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_FLAG_INDEX, _FLAG_ASKS = 1, 2


def _word_runs(data: bytes, n: int, step: int = _STEP) -> Iterator[list[bytes]]:
    """The words of a text in runs, each of which starts with the last ``n - 1`` words of the one before."""
    at, kept = 0, []
    while at < len(data):
        cut = _SPACE.search(data, at + step)
        end = cut.start() if cut else len(data)
        words = kept + data[at:end].lower().split()  # bytes: A-Z and ASCII white space only
        yield words
        at, kept = end, words[max(0, len(words) - n + 1) :]


def fingerprint(data: bytes | None, n: int = 3, step: int = _STEP) -> int:
    """SimHash of a text's word shingles, repeats included; 0 without words."""
    ones, total, last = np.zeros(BITS, np.int64), 0, []
    for words in _word_runs(data or b"", n, step):
        hashes = [xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))]
        last = words
        if hashes:
            ones += _bits(np.array(hashes, np.uint64)).sum(axis=0, dtype=np.int64)
            total += len(hashes)
    if not total and last:
        ones, total = _bits(np.array([xxh64_intdigest(b" ".join(last), SEED)], np.uint64))[0].astype(np.int64), 1
    return sum(1 << i for i in range(BITS) if 2 * ones[i] > total)


def _bits(values: np.ndarray) -> np.ndarray:
    """A row of 64 bits for each value, bit 0 first."""
    return np.unpackbits(np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(docs: DataFrame, n: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column, fingerprint`` (its 64 bits as a bigint) of every row; a null text is empty."""
    rows = docs.select(F.col(f"`{id_column}`"), F.col(f"`{text_column}`").cast("binary").alias("_simhash_text"))
    schema = StructType([rows.schema[0], StructField("fingerprint", LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), n) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], [id_column, "fingerprint"])

    return rows.mapInArrow(hashed, schema)


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and how many have both bits of each pair set, counted over all of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy().view(np.uint64)).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        if n:
            yield pa.RecordBatch.from_pydict(
                {"bit": list(range(BITS)), "n": [n] * BITS, "both": [list(map(int, r)) for r in both]}
            )

    counted = distinct.select("fp").mapInArrow(count, "bit bigint, n bigint, both array<bigint>")
    sums = [F.sum(F.col("both")[j]) for j in range(BITS)]
    rows = counted.groupBy("bit").agg(F.sum("n").alias("n"), F.array(*sums).alias("both")).orderBy("bit").collect()
    return (rows[0]["n"], np.array([r["both"] for r in rows], float)) if rows else (0, np.zeros((BITS, BITS)))


def bit_groups(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` partitions of the bits, nearly equal in size, that group correlated bits."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(p * (1 - p))
    with np.errstate(divide="ignore", invalid="ignore"):
        tied = np.nan_to_num(np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tied, 0)
    left, groups = list(range(BITS)), []
    for i in range(m):
        size = -(-len(left) // (m - i))
        group = [max(left, key=lambda b: (tied[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: (tied[b, group].sum(), -b)))
            left.remove(group[-1])
        groups.append(group)
    return groups


def _ball(width: int, t: int) -> int:
    """Number of values within ``t`` bits of a value."""
    return sum(comb(width, i) for i in range(t + 1))


def _distances(p: np.ndarray, most: int) -> np.ndarray:
    """Chance that two values differ in 0, 1, … ``most`` of the bits that are set with chances ``p``, taken as independent."""
    out = np.zeros(most + 1)
    out[0] = 1
    for q in 2 * p * (1 - p):
        out[1:] = out[1:] * (1 - q) + out[:-1] * q
        out[0] *= 1 - q
    return out


def allocate(costs: np.ndarray, budget: int) -> np.ndarray:
    """Units for each partition, ``budget`` in all, at the least total cost, by dynamic programming.

    ``costs[row, partition, units]`` is the price of giving a partition so many
    units, that is a threshold of one less.
    """
    rows, m, _ = costs.shape
    best = np.full((rows, budget + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((m, rows, budget + 1), np.int8)
    for i in range(m):
        new = np.full_like(best, np.inf)
        for units in range(budget + 1):
            for total in range(units, budget + 1):
                price = best[:, total - units] + costs[:, i, units]
                better = price < new[:, total]
                new[better, total] = price[better]
                choice[i, better, total] = units
        best = new
    out, left, at = np.zeros((rows, m), np.int8), np.full(rows, budget), np.arange(rows)
    for i in reversed(range(m)):
        out[:, i] = choice[i, at, left]
        left = left - out[:, i]
    return out


def choose_groups(n: int, both: np.ndarray, distance: int) -> list[list[int]]:
    """The partitions whose best thresholds promise the least work for ``n`` fingerprints."""
    p = np.diag(both) / max(n, 1)
    plans = []
    for m in range(1, min(MOST_PARTITIONS, distance + 1) + 1):
        groups = bit_groups(n, both, m)
        costs = np.zeros((1, m, distance + 2))
        for i, g in enumerate(groups):
            within = np.cumsum(_distances(p[g], distance))
            for t in range(distance + 1):
                costs[0, i, t + 1] = n * within[t] + ROW_COST * _ball(len(g), t)
        units = allocate(costs, distance + 1)[0]
        plans.append((sum(costs[0, i, u] for i, u in enumerate(units)) + ROW_COST * m, m, groups))
    return min(plans)[2]


def _values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The first ``TABLE_BITS`` bits of a partition as a number."""
    out = np.zeros(len(fps), np.int64)
    for j, b in enumerate(bits[:TABLE_BITS]):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << j
    return out


def value_counts(distinct: DataFrame, groups: list[list[int]]) -> np.ndarray:
    """How many fingerprints have each value of each partition's first ``TABLE_BITS`` bits.

    At most ``2 ** TABLE_BITS`` counts a partition, whatever the number of fingerprints.
    """
    size = 1 << min(TABLE_BITS, max(len(g) for g in groups))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(groups), size), np.int64)
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for i, g in enumerate(groups):
                seen[i] += np.bincount(_values(fps, g), minlength=size)
        part, value = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(value.astype(np.int32)), pa.array(seen[part, value])], ["part", "value", "n"]
        )

    rows = distinct.select("fp").mapInArrow(count, "part int, value int, n bigint").groupBy("part", "value").agg(F.sum("n").alias("n"))
    got = rows.toPandas()
    out = np.zeros((len(groups), size), np.int64)
    out[got["part"], got["value"]] = got["n"]
    return out


def expected_candidates(counts: np.ndarray, bits: list[int], p: np.ndarray, distance: int) -> np.ndarray:
    """For each value of a partition's counted bits and each threshold, how many fingerprints a look-up finds.

    Exact for a partition of counted bits alone; the further bits enter by their chance to differ.
    """
    width = min(len(bits), TABLE_BITS)
    at = np.arange(1 << width)
    # exactly[d][v]: fingerprints at distance d of v in the counted bits, bit by bit
    exactly = np.zeros((distance + 1, 1 << width))
    exactly[0] = counts[: 1 << width]
    for j in range(width):
        exactly[1:] += exactly[:, at ^ (1 << j)][:-1]
    rest = _distances(p[bits[width:]], distance)
    return np.array([sum(exactly[d] * rest[: t - d + 1].sum() for d in range(t + 1)) for t in range(distance + 1)])


def _flips(bits: list[int], t: int) -> np.ndarray:
    """Masks that flip up to ``t`` of the bits; the first flips none."""
    return np.array([sum(1 << b for b in c) for k in range(t + 1) for c in combinations(bits, k)], np.uint64)


def _key(values: np.ndarray, salt: int) -> np.ndarray:
    """Key of a partition's bits. Unlike values that share a key by chance are compared as well, no more."""
    return mix(values ^ mix(np.array([salt + 1], np.uint64)))


def _mask(bits: list[int]) -> np.uint64:
    return np.uint64(sum(1 << b for b in bits))


def _index_batch(keys: list, fps: list, flags: list, rests: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(fps).view(np.int64)),
            pa.array(np.concatenate(flags)), pa.array(np.concatenate(rests).view(np.int64)),
        ],
        ["key", "fp", "flag", "rest"],
    )


_INDEX = "key bigint, fp bigint, flag byte, rest bigint"


def index_rows(distinct: DataFrame, groups: list[list[int]], prices: list[np.ndarray], distance: int) -> DataFrame:
    """``key, fp, flag, rest``: where each fingerprint stands in the index and what it looks up.

    ``prices[i][t]`` holds the expected candidates of each value of partition
    ``i``. ``rest`` are the bits that the key does not fix.
    """
    masks = [_mask(g) for g in groups]
    flips = {}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            costs = np.zeros((len(fps), len(groups), distance + 2))
            for i, g in enumerate(groups):
                value = _values(fps, g)
                for t in range(distance + 1):
                    costs[:, i, t + 1] = prices[i][t][value] + (ROW_COST * (_ball(len(g), t) - 1))
            thresholds = allocate(costs, distance + 1) - 1
            for i, g in enumerate(groups):
                flag = np.where(thresholds[:, i] >= 0, _FLAG_INDEX | _FLAG_ASKS, _FLAG_INDEX).astype(np.int8)
                rest = np.full(len(fps), ~masks[i])
                yield _index_batch([_key(fps & masks[i], i)], [fps], [flag], [rest])
                for t in range(1, distance + 1):
                    asking = fps[thresholds[:, i] == t]
                    if not len(asking):
                        continue
                    turned = flips.setdefault((i, t), _flips(g, t)[1:])
                    step = max(1, CHUNK // len(turned))
                    for at in range(0, len(asking), step):
                        some = asking[at : at + step]
                        keys = _key(((some[:, None] ^ turned) & masks[i]).ravel(), i)
                        yield _index_batch(
                            [keys], [np.repeat(some, len(turned))], [np.full(len(keys), _FLAG_ASKS, np.int8)], [np.full(len(keys), ~masks[i])]
                        )

    return distinct.select("fp").mapInArrow(emit, _INDEX)


def _extended(rows: DataFrame) -> DataFrame:
    """Keys of too many rows, each extended in turn by a quarter of the bits that it does not fix.

    What differs in at most three bits agrees in one of the quarters.
    """

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fps, flag, rest = (c.to_numpy() for c in batch.columns)
            key, fps, rest = key.view(np.uint64), fps.view(np.uint64), rest.view(np.uint64)
            for free in np.unique(rest):
                at = rest == free
                bits = [b for b in range(BITS) if int(free) >> b & 1]
                for i in range(MOST_PARTITIONS):
                    mask = _mask(bits[i::MOST_PARTITIONS])
                    longer = mix(key[at] + _key(fps[at] & mask, i))
                    yield _index_batch([longer], [fps[at]], [flag[at]], [np.full(at.sum(), free & ~mask)])

    return rows.select("key", "fp", "flag", "rest").mapInArrow(extend, _INDEX)


def _spanning(fps: np.ndarray, flags: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect all rows of a bucket that its links connect. Each row is looked at once."""
    left, out = np.arange(len(fps)), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            meets = (flags[left] & _FLAG_INDEX if flags[at] & _FLAG_ASKS else 0) | (
                flags[left] & _FLAG_ASKS if flags[at] & _FLAG_INDEX else 0
            )
            near = (np.bitwise_count(fps[left] ^ fps[at]) <= distance) & (meets != 0)
            found = left[near]
            if len(found):
                out += [(at, b) for b in found]
                queue += list(found)
                left = left[~near]
    return out


def bucket_links(key: np.ndarray, fps: np.ndarray, flags: np.ndarray, distance: int) -> np.ndarray:
    """Pairs of fingerprints that connect what the verified links of all buckets connect."""
    order = np.argsort(key, kind="stable")
    key, fps, flags = key[order], fps[order], flags[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    sizes = np.diff(np.r_[starts, len(key)])
    size = np.repeat(sizes, sizes)
    pairs = []
    for d in range(1, min(_SHORT, sizes.max(initial=0))):
        at = np.flatnonzero((key[d:] == key[:-d]) & (size[d:] <= _SHORT))
        to = at + d
        meets = ((flags[at] & _FLAG_ASKS != 0) & (flags[to] & _FLAG_INDEX != 0)) | (
            (flags[to] & _FLAG_ASKS != 0) & (flags[at] & _FLAG_INDEX != 0)
        )
        near = meets & (np.bitwise_count(fps[at] ^ fps[to]) <= distance) & (fps[at] != fps[to])
        pairs.append(np.stack([fps[at[near]], fps[to[near]]], axis=1))
    for start, count in zip(starts[sizes > _SHORT], sizes[sizes > _SHORT], strict=True):
        found = _spanning(fps[start : start + count], flags[start : start + count], distance)
        if found:
            pairs.append(fps[start + np.array(found)])
    unique = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.uint64)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for i, (a, b) in enumerate(unique.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            kept.append(i)
    return unique[kept]


def links(distinct: DataFrame, distance: int, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: verified links that connect every two fingerprints ``fp`` that differ in at most ``distance`` bits or a chain of such.

    Keys of more than ``bucket`` rows are extended by further bits until their
    rows are fewer or so few bits are left that there cannot be more.
    """
    if distance >= MOST_PARTITIONS:
        raise ValueError(f"at most {MOST_PARTITIONS - 1} differing bits")
    n, both = bit_statistics(distinct)
    groups = choose_groups(n, both, distance)
    counts, p = value_counts(distinct, groups), np.diag(both) / max(n, 1)
    prices = [expected_candidates(c, g, p, distance).astype(np.float32) for c, g in zip(counts, groups, strict=True)]
    rows = stored(index_rows(distinct, groups, prices, distance), "simhash_index")
    few = bucket.bit_length() - 1
    found: DataFrame | None = None
    while True:
        large = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("key"), "large_keys")
        last = large.isEmpty()
        if not last:
            hot = join_unique(rows, large, "key", "left_semi")
            fits = join_unique(rows, large, "key", "left_anti").unionByName(hot.where(F.bit_count("rest") <= few))
        chunks = -(-rows.count() // CHUNK) or 1
        made = _compared(rows if last else fits, chunks, distance)
        found = made if found is None else found.unionByName(made)
        if last:
            return found
        rows = stored(_extended(hot.where(F.bit_count("rest") > few)), "simhash_index")


def _compared(rows: DataFrame, chunks: int, distance: int) -> DataFrame:
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        pairs = bucket_links(rows["key"].to_numpy(), rows["fp"].to_numpy().view(np.uint64), rows["flag"].to_numpy(), distance)
        return pd.DataFrame({"a": pairs[:, 0].view(np.int64), "b": pairs[:, 1].view(np.int64)})

    chunk = F.pmod("key", F.lit(chunks)).alias("chunk")
    return rows.select(chunk, "key", "fp", "flag").groupBy("chunk").applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, n: int = 3, distance: int = 3, id_column: str = "doc_id", text_column: str = "text", bucket: int = BUCKET
) -> DataFrame:
    """Fingerprint and class of every row: ``id_column, fingerprint, component_id``.

    The class is the smallest id that links lead to, the row's own included. A
    text without words, an empty or null one has fingerprint 0 and links like any
    other; texts of fewer than ``n`` words are one shingle; a text of any length
    is read in runs of words. Rows without an id take part and get their class's
    smallest id, null if it has none; repeated rows and ids come back as often as
    they are given. Other columns and their names do not matter.
    """
    rows = fingerprints(docs, n, id_column, text_column).select(F.col(f"`{id_column}`").alias("id"), F.col("fingerprint").alias("fp"))
    rows = stored(rows, "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct_fingerprints")
    classes = components(links(distinct, distance, bucket)).select(F.col("node").alias("fp"), F.col("component").alias("class"))
    members = stored(join_unique(distinct, classes, "fp"), "linked")
    smallest = members.groupBy("class").agg(F.min("first").alias("component_id"))
    linked = join_unique(members, smallest, "class").select("fp", "component_id")
    alone = join_unique(distinct, classes, "fp", "left_anti").select("fp", F.col("first").alias("component_id"))
    out = join_unique(rows, linked.unionByName(alone), "fp")
    return out.select(F.col("id").alias(id_column), _hex(F.col("fp")).alias("fingerprint"), "component_id")


def _hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@query("op12_simhash_classes")
def op12_simhash_classes(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))
