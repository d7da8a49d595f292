"""Best-fit-decreasing packing of token sequences into sequences of a fixed length.

Every document is cut into pieces of at most ``limit`` tokens. The packing is
that of best-fit decreasing over all pieces: longest first, each into the open
sequence with the least room that still fits. Pieces of one length are
interchangeable, so what the packer decides depends on the counts per length
alone, of which there are at most ``limit`` whatever the size of the corpus. The
plan is made from those counts with a segment tree over remaining capacities,
and Spark assigns every piece its place from its rank among those of its length.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.llm.registry import query, table
from metacurate.operators.checkpoints import stored

LIMIT = 2048
END_ID = 0
NO_SPECIAL: Mapping[str, int] = {}
PUBLIC_SPECIAL = {"<|endoftext|>": 50256}  # added token of byte_bpe_50k.json, not in its rank file
_CACHE = 300_000
_UNSAFE = re.compile(r" \s|\s ")

_encoders: dict[tuple, "_Encoder"] = {}


class _Encoder(dict):
    """Token ids of space-led words, as bytes; other texts go to the tokenizer whole.

    A space between two characters that are no white space is always a token
    boundary of the pattern, so the words on both sides can be encoded alone.
    ``special`` texts are one token each wherever they stand.
    """

    def __init__(self, ranks: str, pattern: str, special: Mapping[str, int]):
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens=dict(special))
        self.special, self.ordinary, self.encode = tuple(special), encoding.encode_ordinary, encoding.encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _CACHE:
            self.clear()
        found = self[word] = self.whole(" " + word)
        return found

    def whole(self, text: str) -> bytes:
        return np.array(self.ordinary(text), "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.encode(text, allowed_special="all"), "<u4").tobytes()
        if _UNSAFE.search(text):
            return self.whole(text)
        head, *words = text.split(" ")
        return self.whole(head) + b"".join(map(self.__getitem__, words))


def encoder(ranks: str, pattern: str, special: Mapping[str, int] = NO_SPECIAL) -> _Encoder:
    """The encoder of this worker process."""
    key = ranks, pattern, tuple(sorted(special.items()))
    if key not in _encoders:
        _encoders[key] = _Encoder(ranks, pattern, special)
    return _encoders[key]


def token_pieces(
    docs: DataFrame, ranks: str, pattern: str, limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = False, special: Mapping[str, int] = NO_SPECIAL
) -> DataFrame:
    """Tokenise ``docs(doc_id, text)`` and cut what is longer than ``limit`` into pieces of it.

    Each document is its ids followed by ``end_id``; a null text is empty, so it
    is the end id alone. Of a document of several pieces the first takes the
    remainder, all others are full. ``ranks`` is the file of token ranks and
    ``pattern`` the pre-tokenisation pattern; ``special`` texts become their one
    id wherever they stand. ``with_ids`` adds the ids. A null
    ``doc_id`` stays null and repeated rows are documents of their own.
    """
    fields = [pa.field("doc_id", pa.int64()), pa.field("piece", pa.int32()), pa.field("start", pa.int64()),
              pa.field("length", pa.int64()), pa.field("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(pa.field("ids", pa.binary()))
    schema = pa.schema(fields)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, pattern, special)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = memoryview(encode.ids(text.as_py() or "") + end)
                total, start, piece = len(ids) // 4, 0, 0
                while start < total:
                    to = start + ((total - start) % limit or limit)
                    part = ids[4 * start : 4 * to]
                    out.append((doc, piece, start, to - start, zlib.crc32(part), *([bytes(part)] if with_ids else [])))
                    start, piece = to, piece + 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)], schema=schema
                )

    spark_schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    picked = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return picked.mapInArrow(cut, spark_schema + (", ids binary" if with_ids else ""))


class OpenBins:
    """Segment tree over remaining capacities: the least capacity of at least a given size that some bin has."""

    def __init__(self, limit: int):
        self.half = 1 << limit.bit_length()
        self.filled = [False] * (2 * self.half)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]

    def _mark(self, capacity: int) -> None:
        at = self.half + capacity
        self.filled[at] = bool(self.groups[capacity])
        while at > 1:
            at //= 2
            self.filled[at] = self.filled[2 * at] or self.filled[2 * at + 1]

    def add(self, capacity: int, first: int, count: int) -> None:
        """``count`` bins numbered from ``first`` that have ``capacity`` left."""
        if count and capacity:
            self.groups[capacity].append((first, count))
            self._mark(capacity)

    def take(self, capacity: int) -> tuple[int, int]:
        group = self.groups[capacity].pop()
        self._mark(capacity)
        return group

    def tightest(self, size: int) -> int | None:
        """Least capacity of at least ``size`` with an open bin, in logarithmic time."""
        if size >= self.half:
            return None
        at = self.half + size
        if self.filled[at]:
            return size
        while at > 1:
            if at % 2 == 0 and self.filled[at + 1]:
                at += 1
                while at < self.half:
                    at = 2 * at if self.filled[2 * at] else 2 * at + 1
                return at - self.half
            at //= 2
        return None


def best_fit_plan(counts: dict[int, int], limit: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over ``counts`` of pieces per length.

    Returns the number of bins and runs ``(length, rank, first bin, per bin,
    offset)``: the piece of that length with rank ``rank + j`` is in bin ``first
    bin + j // per bin`` at ``offset + (j % per bin) * length``. A piece that
    went into the tightest bin leaves an even tighter one, so the next piece of
    the same length follows it while it fits: whole runs move at once and give
    what one piece after the other would.
    """
    bins, runs, next_bin = OpenBins(limit), [], 0
    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            room = bins.tightest(size)
            if room is None:
                room, first = limit, next_bin
                open_bins = -(-left // (limit // size))
                next_bin += open_bins
            else:
                first, open_bins = bins.take(room)
            each = room // size
            full = min(open_bins, left // each)
            if full:
                runs.append((size, rank, first, each, limit - room))
                bins.add(room - each * size, first, full)
                left, rank = left - full * each, rank + full * each
            if left and open_bins > full:
                runs.append((size, rank, first + full, left, limit - room))
                bins.add(room - left * size, first + full, 1)
                full, rank, left = full + 1, rank + left, 0
            bins.add(room, first + full, open_bins - full)
    return runs, next_bin


def pack_pieces(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces ``(doc_id, piece, length, ...)`` of 1 to ``limit`` tokens.

    Pieces are stored once, sorted by range of length, which splits a hot length
    over many tasks. The driver gets one row for each pair of range partition
    and length that occurs, at most ``limit`` more than there are partitions.
    """
    columns = pieces.columns
    ordered = (
        stored(pieces, "pieces")
        .repartitionByRange(F.col("length").desc(), "doc_id", "piece")
        .sortWithinPartitions(F.col("length").desc(), "doc_id", "piece")
        .select(*columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"))
    )
    ordered = stored(ordered, "ordered_pieces")
    groups = ordered.groupBy("_part", "length").agg(F.count("*").alias("n"), F.min("_row").alias("first")).collect()
    counts: dict[int, int] = {}
    before, firsts, keys = [], [], []
    for g in sorted(groups, key=lambda g: (g["_part"], -g["length"])):
        keys.append(g["_part"] * (limit + 1) + g["length"])
        before.append(counts.get(g["length"], 0))
        firsts.append(g["first"])
        counts[g["length"]] = before[-1] + g["n"]
    runs, _ = best_fit_plan(counts, limit)
    runs.sort()
    by_key = np.argsort(np.array(keys, np.int64), kind="stable")
    key_of, shift = np.array(keys, np.int64)[by_key], (np.array(before, np.int64) - np.array(firsts, np.int64))[by_key]
    span = max(counts.values(), default=0) + 1
    length, rank, first, each, offset = (np.array(c, np.int64) for c in zip(*runs, strict=True)) if runs else [np.zeros(0, np.int64)] * 5
    run_of = length * span + rank
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id bigint, offset bigint"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy()
            group = np.searchsorted(key_of, batch.column("_part").to_numpy().astype(np.int64) * (limit + 1) + size)
            mine = batch.column("_row").to_numpy() + shift[group]
            run = np.searchsorted(run_of, size * span + mine, "right") - 1
            j = mine - rank[run]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(first[run] + j // each[run]), pa.array(offset[run] + j % each[run] * size)],
                names=[*columns, "sequence_id", "offset"],
            )

    return ordered.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, ranks: str, pattern: str, limit: int = LIMIT, special: Mapping[str, int] = NO_SPECIAL) -> DataFrame:
    """Tokenise, cut and pack documents; see ``token_pieces`` and ``pack_pieces``."""
    return pack_pieces(token_pieces(docs, ranks, pattern, limit, special=special), limit)


def public_vocabulary() -> tuple[str, str]:
    """Ranks and pattern of the public byte-level vocabulary; with ``PUBLIC_SPECIAL`` its ids are those of ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query("op1_pack_documents")
def op1_pack_documents(spark: SparkSession, sf: str) -> DataFrame:
    packed = pack_documents(table(spark, sf, "documents"), *public_vocabulary(), special=PUBLIC_SPECIAL)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
