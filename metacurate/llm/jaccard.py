"""Near-duplicate join on word shingles by token-combination prefixes.

Two documents link when the Jaccard similarity of their sets of word shingles
reaches a threshold. All shingles have one global order: those known to be
frequent last, else by hash. The first ``n - need + 2`` shingles of a set of
``n``, of which a partner must share ``need``, are its prefix, extended so that
two sets that link share at least two shingles of their prefixes. Single shingles
are indexed if few prefixes or few classes have them. Two linked sets either
share one of those, or all they share in their prefixes are frequent, and the
index of pairs of frequent shingles finds them. Candidates pass a bound from bit
signatures and are verified on the whole texts.

What is wanted are the classes that links form, so documents that are in one
class already are never compared: equal sets are one node from the start, a few
rounds link the members of a family, or the documents of a frequent key, to leaders, and keys all of whose documents
are in one class are dropped. The documents of a key that many have are compared
by their bit signatures, block by block, and only pairs that can link become rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.llm.graphs import components
from metacurate.llm.ngrams import shingle_sets, small_batches
from metacurate.llm.registry import query, table
from metacurate.operators.checkpoints import stored
from metacurate.operators.joins import join_unique

RARE = 64  # documents or classes of a key that are compared pair by pair
ROUNDS = 2
KEY_ROUNDS = 3
MOST_FREQUENT = 1 << 18  # shingles whose frequency the order knows of, 2 MB
BLOCK = 2048
BROADCAST_ROWS = 1 << 20
BROADCAST_BYTES = 1 << 24
TEXTS_PER_TASK = 256
ROWS_PER_TASK = 1 << 16
_K = 2
_COUNTED = 1 << 22
_WORDS = 16  # 64-bit words of a bit signature


def _need(n: int, percent: int) -> int:
    """How many shingles any partner of a set of ``n`` shares with it."""
    return -(-percent * n // 100)


def repeated(sets: list[np.ndarray]) -> pa.RecordBatch:
    """``key, n`` of the hashes that occur more than once in ``sets``, which is emptied.

    Sorted in place and cut by flags, so that it takes the hashes twice at most, and a single array only once.
    """
    keys = sets[0] if len(sets) == 1 else np.concatenate(sets)
    sets.clear()
    keys.sort()
    again = keys[1:] == keys[:-1]
    first, last = again.copy(), again.copy()
    first[1:] &= ~again[:-1]
    last[:-1] &= ~again[1:]
    starts = np.flatnonzero(first)
    counts = np.flatnonzero(last) - starts + 2
    return pa.RecordBatch.from_arrays([pa.array(keys[starts].view(np.int64)), pa.array(counts)], names=["key", "n"])


def repeated_in_runs(sets: Iterable[np.ndarray], run: int = _COUNTED) -> Iterator[pa.RecordBatch]:
    """``repeated`` of each run of sets, which ends with the set that brings it to ``run`` hashes.

    One array holds a run, and its pages are taken as they fill; thousands of small ones would leave the heap of the process in pieces.
    """
    held, size = np.empty(2 * run, np.uint64), 0
    for found in sets:
        if size + len(found) > len(held):
            held = np.concatenate([held[:size], found])
        else:
            held[size : size + len(found)] = found
        size += len(found)
        if size >= run:
            yield repeated([held[:size]])
            if len(held) > 2 * run:
                held = np.empty(2 * run, np.uint64)
            size = 0
    if size:
        yield repeated([held[:size]])


def frequent_shingles(docs: DataFrame, n: int, rare: int = RARE, most: int = MOST_FREQUENT) -> np.ndarray:
    """Hashes of frequent shingles, at most ``most``, sorted.

    Each run of documents with some four million shingles counts all of them and
    hands on those that two documents have. Those of ``rare`` documents or more are taken; if
    they are over ``most``, those over the least power of two that no more than ``most`` reach.
    Any set gives right results; a good one keeps common passages out of the prefixes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return repeated_in_runs(found for batch in batches for _, found in shingle_sets(batch.column("text"), n))

    counted = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(count, "key bigint, n bigint")
    counted = stored(counted.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= rare), "shingle_counts")
    power = F.floor(F.log2("n")).alias("power")
    bar, total = rare, 0
    for level, keys in sorted(counted.groupBy(power).agg(F.count("*")).collect(), reverse=True):
        total += keys
        if total > most:
            bar = 2 ** (level + 1)
            break
    found = counted.where(F.col("n") >= max(rare, bar)).select("key").toArrow()
    return np.sort(found.column("key").to_numpy().view(np.uint64))


def _parity(places: np.ndarray, width: int) -> np.ndarray:
    """For each of ``width`` places the parity of its count, in 64-bit words."""
    return np.packbits((np.bincount(places, minlength=width) & 1).astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Signature of each row's shingle set.

    ``doc_id, text_hash, size, fingerprint`` of the set, its ``prefix`` in the
    global order, its ``least`` three hashes, and ``bits``: the parity of how
    many shingles fall on each of 1024 bits, so that the bits in which two sets
    differ are at most the shingles in which they do. ``wide`` is the same with a
    bit for each shingle or more, a power of two, for sets of over 2048 shingles.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes, prints, prefixes, bounds, least, bits, wide = [], [], [], [0], [], [], []
            for _, found in shingle_sets(batch.column("text"), n):
                sizes.append(len(found))
                prints.append(blake2b(found.tobytes(), digest_size=16).digest())
                common = np.zeros(len(found), bool)
                if len(frequent):
                    common = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found
                length = len(found) - _need(len(found), percent) + _K
                prefixes.append(np.concatenate([found[~common], found[common]])[:length])
                bounds.append(bounds[-1] + len(prefixes[-1]))
                least.append(np.pad(found[:3], (0, 3 - len(found[:3]))))
                bits.append(_parity((found >> np.uint64(54)).astype(np.int64), 64 * _WORDS))
                width = 1 << len(found).bit_length()
                wide.append(_parity((found & np.uint64(width - 1)).astype(np.int64), width) if len(found) > 128 * _WORDS else None)
            if sizes:
                flat = lambda parts: pa.array(np.concatenate(parts).view(np.int64))
                even = lambda width: pa.array(np.arange(len(sizes) + 1) * width, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat(prefixes)),
                     pa.ListArray.from_arrays(even(3), flat(least)), pa.ListArray.from_arrays(even(_WORDS), flat(bits)),
                     pa.array(wide, pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "size", "fingerprint", "prefix", "least", "bits", "wide"],
                )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(
        sign,
        "doc_id bigint, text_hash bigint, size bigint, fingerprint binary, prefix array<bigint>, least array<bigint>, bits array<bigint>, "
        "wide array<bigint>",
    )


def _spread(total: Column, percent: int) -> Column:
    """In how many shingles two linked sets of ``total`` shingles together can differ."""
    return total - 2 * F.ceil(F.lit(percent) * total / F.lit(100 + percent))


def _close(percent: int) -> Column:
    """Whether sets of ``a_size`` and ``b_size`` shingles can link."""
    return (F.lit(100) * F.least("a_size", "b_size")) >= (F.lit(percent) * F.greatest("a_size", "b_size"))


def _differ(a: Column, b: Column) -> Column:
    """In how many bits two signatures of one width differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _narrowed(a: Column, b: Column) -> Column:
    """Wide signature ``a``, folded to the width of ``b`` if that has half of its own. Sets that can link have no other widths."""
    words = F.array_size(b)
    halves = F.zip_with(F.slice(a, 1, words), F.slice(a, words + 1, words), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.array_size(a) > words, halves).otherwise(a)


def _picked(df: DataFrame, ids: DataFrame, on: list[str], n: int) -> DataFrame:
    """Rows of ``df`` whose ``on`` are among the ``n`` rows of ``ids``, which are broadcast if they are at most 2**20."""
    if n <= BROADCAST_ROWS:
        return df.join(F.broadcast(ids), on, "left_semi")
    return join_unique(df, ids.distinct(), on, "left_semi")


def _attached(df: DataFrame, side: DataFrame, on: str | list[str], size: int) -> DataFrame:
    """``df`` joined to ``side``, unique by ``on``, which is broadcast if its ``size`` is at most 16 MB."""
    if size <= BROADCAST_BYTES:
        return df.join(F.broadcast(side), on)
    return join_unique(df, side, on)


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The distinct, stored ``pairs`` ``(a, b)`` of nodes that link. Bit signatures rule most out; the others' whole texts are read."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    known = stored(_picked(nodes.select("doc_id", "text_hash", "size", "bits", "wide"), ids, ["doc_id"], 2 * pairs.count()), "pair_nodes")
    size = known.agg(F.coalesce(F.sum(8 * (3 + F.size("bits") + F.greatest(F.size("wide"), F.lit(0)))), F.lit(0))).first()[0]
    marks = lambda c: known.select(F.col("doc_id").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in ("text_hash", "size", "bits", "wide")])
    signed = _attached(_attached(pairs.select("a", "b"), marks("a"), "a", size), marks("b"), "b", size)
    spread = _spread(F.col("a_size") + F.col("b_size"), percent)
    able = signed.where(_close(percent) & (_differ(F.col("a_bits"), F.col("b_bits")) <= spread))
    a, b = F.col("a_wide"), F.col("b_wide")
    able = able.where(F.coalesce(_differ(_narrowed(a, b), _narrowed(b, a)), F.lit(0)) <= spread)
    pairs = stored(able.select("a", "a_text_hash", "b", "b_text_hash"), "candidates")
    n_used = 2 * pairs.count()
    if not n_used:
        return pairs.select("a", "b")
    used = pairs.select(F.col("a").alias("doc_id"), F.col("a_text_hash").alias("text_hash")).union(pairs.select("b", "b_text_hash"))
    texts = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    chosen = _picked(texts, used, ["doc_id", "text_hash"], n_used)
    # repeated rows have one text
    chosen = chosen.groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    chosen = stored(chosen.coalesce(-(-n_used // TEXTS_PER_TASK)), "texts")
    size = chosen.agg(F.sum(F.octet_length("text") + 24)).first()[0]
    side = lambda c: chosen.select(F.col("doc_id").alias(c), F.col("text_hash").alias(f"{c}_text_hash"), F.col("text").alias(f"{c}_text"))
    both = _attached(_attached(pairs, side("a"), ["a", "a_text_hash"], size), side("b"), ["b", "b_text_hash"], size)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = shingle_sets(batch.column("a_text"), n), shingle_sets(batch.column("b_text"), n)
            keep = []
            for (_, x), (_, y) in zip(left, right, strict=True):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "a_text", "b_text").mapInArrow(check, "a bigint, b bigint")


def _spanning(entries: DataFrame) -> DataFrame:
    """``key, n`` of the keys whose documents are in more than one class."""
    counted = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    return counted.where("low <> high").select("key", "n")


def _document_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of different classes with a key in common, in id order; one row per key."""
    left = entries.select("key", *[F.col(c).alias(f"a_{c}") for c in ("doc_id", "size", "class")])
    right = entries.select("key", *[F.col(c).alias(f"b_{c}") for c in ("doc_id", "size", "class")])
    other = (F.col("a_doc_id") < F.col("b_doc_id")) & (F.col("a_class") != F.col("b_class"))
    return left.join(right, "key").where(other & _close(percent))


def _dealt(signed: DataFrame) -> DataFrame:
    """Each document of a key once for each pair of blocks, ``low`` and ``high``, that its ``own`` is one of: as often as there are blocks."""
    blocks = F.ceil(F.col("n") / BLOCK)
    placed = signed.select("key", "doc_id", "size", "class", "bits", F.pmod(F.xxhash64("doc_id"), blocks).alias("own"), blocks.alias("blocks"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "doc_id", "size", "class", "bits"
    )


def _block_pairs(keyed: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of different classes with a key in common, as far as their bit signatures let them link.

    ``keyed`` is ``key, n, doc_id, size, class`` with the number of documents of the key. They meet in
    blocks of some 2048, which bounds a task whatever the number is; pairs that cannot link never become rows.
    """
    dealt = _dealt(join_unique(keyed, nodes.select("doc_id", "bits"), "doc_id"))

    def close(one: tuple, many: tuple) -> np.ndarray:
        doc, size, bits = many
        total = size + one[1]
        differ = np.bitwise_count((bits ^ one[2]).view(np.uint64)).sum(axis=1)
        fits = differ <= total - 2 * -(-percent * total // (100 + percent))
        return doc[fits & (100 * np.minimum(size, one[1]) >= percent * np.maximum(size, one[1]))]

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, low, high = key
        rows = rows.sort_values("class", kind="stable")
        columns = rows["doc_id"].to_numpy(), rows["size"].to_numpy(), np.stack(rows["bits"].to_numpy())
        own, classes = rows["own"].to_numpy(), rows["class"].to_numpy()
        left, right = (tuple(c[own == block] for c in (*columns, classes)) for block in (low, high))
        starts = np.flatnonzero(np.r_[True, left[3][1:] != left[3][:-1]]) if len(left[3]) else np.zeros(0, np.int64)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, end in zip(starts, np.r_[starts[1:], len(left[3])], strict=False):
            mine = tuple(c[start:end] for c in left[:3])
            # the other classes; within one block the later ones, so that each pair is met once
            cuts = np.searchsorted(right[3], left[3][start], "left"), np.searchsorted(right[3], left[3][start], "right")
            for span in (slice(cuts[1], None), *([slice(0, cuts[0])] if low != high else [])):
                theirs = tuple(c[span] for c in right[:3])
                few, many = (mine, theirs) if len(mine[0]) <= len(theirs[0]) else (theirs, mine)
                for one in zip(*few, strict=True):
                    found = close(one, many)
                    a.append(np.minimum(found, one[0]))
                    b.append(np.maximum(found, one[0]))
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return dealt.groupBy("key", "low", "high").applyInPandas(compare, "a bigint, b bigint")


def _rare_pairs(hits: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of different classes that share keys, with the number ``n`` of these."""
    return _document_pairs(hits, percent).groupBy(
        F.col("a_doc_id").alias("a"), F.col("b_doc_id").alias("b"), "a_size", "b_size"
    ).agg(F.count("*").alias("n"))


def _able_pairs(shared: DataFrame, many: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``_rare_pairs`` that can link, given that ``many`` has each document's other keys.

    What two sets share is at most the light and the other keys of both prefixes, and the longer rest of the sets.
    """
    tasks = max(1, -(-many.count() // ROWS_PER_TASK))
    others = stored(many.groupBy("doc_id").agg(F.count("*").alias("f")).coalesce(tasks), "other_keys")
    for side in ("a", "b"):
        shared = join_unique(shared, others.select(F.col("doc_id").alias(side), F.col("f").alias(f"{side}_f")), side, "left")
    rest_of = lambda c: F.greatest(F.ceil(F.col(c) * percent / 100) - _K, F.lit(0))
    most = F.col("n") + F.coalesce(F.least("a_f", "b_f"), F.lit(0)) + F.greatest(rest_of("a_size"), rest_of("b_size"))
    return shared.where(most * (100 + percent) >= percent * (F.col("a_size") + F.col("b_size"))).select("a", "b")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, rare: int = RARE) -> DataFrame:
    """Classes of ``docs(doc_id, text)`` under links of ``n``-word shingles, ``100 * shared >= percent * union``.

    Returns ``doc_id, n_shingles, component_id`` for every row; the component is
    the smallest ``doc_id`` of its class. Words are runs without white space with
    A-Z folded. A text of fewer than ``n`` words has its whole sequence as one
    shingle. Null or wordless texts have none and link with nothing. Rows that
    share a ``doc_id`` are one node; rows without one link with nothing and have
    no component. ``percent`` must be over 66, so that two different sets that
    link share at least two shingles.
    """
    if not 67 <= percent <= 100:
        raise ValueError("percent must be from 67 to 100")
    rows = stored(signatures(docs, n, percent, frequent_shingles(docs, n, rare)), "signatures")
    sets = rows.where("doc_id IS NOT NULL AND size > 0")
    # equal sets are one node, named by their smallest document
    whole = F.struct("doc_id", "text_hash", "size", "prefix", "least", "bits", "wide")
    nodes = stored(sets.groupBy("fingerprint").agg(F.min(whole).alias("r")).select("fingerprint", "r.*"), "nodes")
    again = sets.groupBy("doc_id").agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high")).where("low <> high").select("doc_id")
    repeated = join_unique(join_unique(sets.select("doc_id", "fingerprint"), again, "doc_id", "left_semi"),
                           nodes.select("fingerprint", F.col("doc_id").alias("b")), "fingerprint")
    links = stored(repeated.select(F.col("doc_id").alias("a"), "b").distinct(), "links")

    def classed(df: DataFrame) -> DataFrame:
        """Nodes with their class by the links so far, of which one link from each node to its class is kept."""
        nonlocal links
        found = components(links).select(F.col("node").alias("doc_id"), "component")
        links = found.where("doc_id <> component").select(F.col("doc_id").alias("a"), F.col("component").alias("b"))
        small = found.count() <= BROADCAST_ROWS
        joined = df.join(F.broadcast(found), "doc_id", "left") if small else join_unique(df, found, "doc_id", "left")
        return joined.withColumn("class", F.coalesce("component", "doc_id")).drop("component")

    def add(pairs: DataFrame) -> DataFrame:
        return stored(links.union(verified(pairs, nodes, docs, n, percent)), "links")

    def distinct_pairs(pairs: DataFrame) -> DataFrame:
        return stored(pairs.select("a", "b").distinct(), "pairs")

    def star_rounds(keyed: DataFrame, rounds: int) -> None:
        """Documents of a key try a leader of another class, another leader each round. ``keyed`` is ``key, doc_id, size``."""
        nonlocal links
        for turn in range(rounds):
            current = stored(classed(keyed), "star_classes")
            tasks = max(1, -(-current.count() // ROWS_PER_TASK))
            order = F.struct(F.xxhash64(F.lit(turn), "doc_id") if turn else F.lit(0).cast("bigint"), "doc_id", "class", "size")
            groups = current.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.min(order).alias("lead"))
            leaders = groups.where("low <> high").select("key", *[F.col(f"lead.{c}").alias(f"a_{c}") for c in ("doc_id", "size", "class")])
            leaders = stored(leaders.coalesce(tasks), "leaders")
            met = _attached(current.withColumnRenamed("size", "b_size"), leaders, "key", 32 * leaders.count())
            stars = met.where((F.col("class") != F.col("a_class")) & _close(percent)).select(F.col("a_doc_id").alias("a"), F.col("doc_id").alias("b"))
            stars = stored(stars.distinct().coalesce(tasks), "stars")
            if stars.isEmpty():
                break
            links = add(stars)

    # families: nodes that agree on two of their three least shingles
    keys = F.array(*[F.xxhash64(F.lit(10 * i + j), F.get("least", F.lit(i)), F.get("least", F.lit(j))) for i, j in ((0, 1), (0, 2), (1, 2))])
    star_rounds(stored(nodes.select("doc_id", "size", F.explode(keys).alias("key")), "family_keys"), ROUNDS)

    # single shingles of the prefixes, first those of many documents with leaders
    current = classed(nodes.select("doc_id", "size", "prefix"))
    entries = current.select("doc_id", "size", "class", F.explode("prefix").alias("key"))
    hits = stored(join_unique(entries, _spanning(entries), "key"), "index")
    often = stored(hits.where(F.col("n") > rare).select("key", "doc_id", "size"), "often")
    star_rounds(often, KEY_ROUNDS)
    often = stored(classed(often), "often_classes")
    many = stored(join_unique(often, _spanning(often), "key"), "spanning")
    tasks = max(1, -(-many.count() // ROWS_PER_TASK))
    classes = many.select("key", "class").distinct().groupBy("key").agg(F.count("*").alias("classes"))
    classes = stored(classes.coalesce(tasks), "key_classes")
    few = join_unique(many, classes.where(F.col("classes") <= rare), "key", "left_semi")
    rest = join_unique(many, classes.where(F.col("classes") > rare), "key", "left_semi")
    # a pair that is in one class by now loses nothing if it is left out
    light = _able_pairs(_rare_pairs(hits.where(F.col("n") <= rare), percent), many, percent)
    links = add(distinct_pairs(light.union(_block_pairs(few, nodes, percent))))

    # pairs of frequent shingles
    heavy = rest.groupBy("doc_id", "size").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    heavy = stored(heavy.coalesce(tasks), "frequent")
    if not heavy.isEmpty():
        later = F.transform("keys", lambda x, i: F.transform(F.slice("keys", i + 2, F.size("keys")), lambda y: F.xxhash64(x, y)))
        combined = classed(heavy).select("doc_id", "size", "class", F.explode(F.flatten(later)).alias("key"))
        hits = stored(join_unique(combined, _spanning(combined), "key"), "pair_index")
        often = stored(hits.where(F.col("n") > rare).select("key", "doc_id", "size"), "often")
        star_rounds(often, ROUNDS)
        often = stored(classed(often), "often_classes")
        shared = _rare_pairs(hits.where(F.col("n") <= rare), percent).select("a", "b")
        links = add(distinct_pairs(shared.union(_block_pairs(join_unique(often, _spanning(often), "key"), nodes, percent))))

    found = components(links).select(F.col("node").alias("doc_id"), "component")
    named = join_unique(nodes.select("fingerprint", "doc_id"), found, "doc_id", "left").select(
        "fingerprint", F.coalesce("component", "doc_id").alias("component")
    )
    return join_unique(rows.select("doc_id", "size", "fingerprint"), stored(named, "named"), "fingerprint", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id")).alias("component_id"),
    )


_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op9_near_duplicates",
    f"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents
    ), s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS shingle
      FROM w WHERE words IS NOT NULL
    ), n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
    links AS (
      SELECT a.doc_id AS a, b.doc_id AS b
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY 1, 2
      HAVING 100 * count(*) >= 90 * ((SELECT n_shingles FROM n WHERE doc_id = a.doc_id) + (SELECT n_shingles FROM n WHERE doc_id = b.doc_id) - count(*))
    ), reach AS (
      SELECT doc_id, doc_id AS other FROM n
      UNION
      SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
    ), c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n.n_shingles, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
    FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
    """,
)
def op9_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), n=3, percent=90)
