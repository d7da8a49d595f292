"""Stupid-backoff language-model scores of documents, from counts over the corpus itself.

Tokens are those of a fixed public vocabulary. Documents are coded once into
blocks of bounded size. Each block's distinct bigrams go, counted, into a table
partitioned by hash; its totals are joined back to the bigrams of every block and
each document's terms are summed where its tokens are. A document is scored
against all others: its own occurrences do not count, so what only it contains
backs off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.llm.packing import encoder, public_vocabulary
from metacurate.llm.registry import query, table
from metacurate.operators.checkpoints import stored
from metacurate.operators.joins import join_unique

ALPHA = 0.4
BLOCK_TOKENS = 1 << 20
_BITS = 32


def coded_blocks(docs: DataFrame, ranks: str, pattern: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of documents, ``block, doc_ids, ends, tokens``: ids as compressed little-endian 32-bit integers.

    A block ends with the document that brings it to ``block_tokens``.
    """
    schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("tokens", pa.binary())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encode, pack = encoder(ranks, pattern), zstandard.ZstdCompressor(level=1)
        doc_ids, ends, parts, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            # low and high halves apart: the high ones are mostly zero
            halves = np.frombuffer(b"".join(parts), "<u2").reshape(-1, 2).T.tobytes()
            return pa.RecordBatch.from_pylist([{"doc_ids": doc_ids, "ends": ends, "tokens": pack.compress(halves)}], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode.ids(text.as_py() or "")
                size += len(ids) // 4
                doc_ids.append(doc)
                ends.append(size)
                parts.append(ids)
                if size >= block_tokens:
                    yield block()
                    doc_ids, ends, parts, size = [], [], [], 0
        if doc_ids:
            yield block()

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(code, "doc_ids array<bigint>, ends array<bigint>, tokens binary").withColumn("block", F.monotonically_increasing_id())


def _tokens(packed: bytes) -> np.ndarray:
    import zstandard

    halves = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<u2").reshape(2, -1)
    return halves[0].astype(np.int64) | (halves[1].astype(np.int64) << 16)


def _bigrams(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all neighbouring tokens, and whether both are of one document."""
    within = np.ones(max(len(tokens) - 1, 0), bool)
    cut = ends[(ends > 0) & (ends < len(tokens))] - 1
    within[cut] = False
    return (tokens[:-1] << _BITS) | tokens[1:], within


def block_counts(blocks: DataFrame) -> DataFrame:
    """``block, kind, key, n``: distinct tokens (kind 1), tokens that have a successor (0) and bigrams (2) of each block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tokens, ends = _tokens(batch.column("tokens")[i].as_py()), np.array(batch.column("ends")[i].as_py(), np.int64)
                keys, within = _bigrams(tokens, ends)
                for kind, values in ((1, tokens), (0, tokens[:-1][within]), (2, keys[within])):
                    found, n = np.unique(values, return_counts=True)
                    if len(found):
                        yield pa.RecordBatch.from_arrays(
                            [pa.repeat(batch.column("block")[i], len(found)), pa.array(np.full(len(found), kind, np.int32)), pa.array(found), pa.array(n)],
                            names=["block", "kind", "key", "n"],
                        )

    return blocks.select("block", "ends", "tokens").mapInArrow(count, "block bigint, kind int, key bigint, n bigint")


def lm_scores(docs: DataFrame, ranks: str, pattern: str, alpha: float = ALPHA, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Scores of ``docs(doc_id, text)``, one row for each row.

    ``n_tokens``; ``n_backoff`` tokens whose bigram no other document has;
    ``n_unseen`` of those that no other document has at all; ``score``, the sum of
    natural logarithms of: the bigram's count over its first token's count as a
    context, else ``alpha`` times the token's share of all tokens, else ``alpha
    ** 2`` over the number of all tokens. A first token starts at the second
    step, without ``alpha``. ``mean_score`` is per token, null without tokens.
    Counts leave out the document that is scored; copies of it count. Null and
    empty texts have no tokens and a score of 0. The token counts sent to the
    driver are at most two rows for each entry of the vocabulary.
    """
    blocks = stored(coded_blocks(docs, ranks, pattern, block_tokens), "coded")
    counts = stored(block_counts(blocks), "block_counts")
    single = counts.where("kind < 2").groupBy("kind", "key").agg(F.sum("n").alias("n")).toArrow()
    kind, key, n = (single.column(c).to_numpy() for c in ("kind", "key", "n"))
    width = int(key.max()) + 1 if len(key) else 1
    context, seen = np.zeros(width, np.int64), np.zeros(width, np.int64)
    context[key[kind == 0]], seen[key[kind == 1]] = n[kind == 0], n[kind == 1]
    total = int(seen.sum())

    pairs = counts.where("kind = 2").select("block", "key")
    totals = counts.where("kind = 2").groupBy("key").agg(F.sum("n").alias("total"))
    # a block's keys are bounded by its tokens
    known = join_unique(pairs, totals, "key").groupBy("block").agg(F.collect_list(F.struct("key", "total")).alias("known"))
    joined = join_unique(blocks, known.select("block", F.col("known.key").alias("keys"), F.col("known.total").alias("totals")), "block", "left")
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_backoff", pa.int64()), ("n_unseen", pa.int64()), ("score", pa.float64())])

    def score_one(tokens: np.ndarray, keys: np.ndarray, totals: np.ndarray) -> tuple[int, int, float]:
        used, place, own = np.unique(tokens, return_inverse=True, return_counts=True)
        others = total - len(tokens)
        elsewhere = (seen[used] - own)[place]
        out = 0.0
        backoff = np.ones(len(tokens), bool)
        if len(tokens) > 1:
            grams, where, n_own = np.unique((tokens[:-1] << _BITS) | tokens[1:], return_inverse=True, return_counts=True)
            hits = (totals[np.searchsorted(keys, grams)] - n_own)[where]
            as_context = context[tokens[:-1]] - np.bincount(place[:-1], minlength=len(used))[place[:-1]]
            backoff[1:] = hits == 0
            hit = hits > 0
            out += float(np.log(hits[hit] / as_context[hit]).sum())
        unseen = backoff & (elsewhere == 0)
        plain = backoff & ~unseen
        if plain.any():
            out += float(np.log(elsewhere[plain] / others).sum()) + math.log(alpha) * int(plain[1:].sum())
        if unseen.any():
            out += int(unseen.sum()) * (2 * math.log(alpha) - math.log(max(total, 1)))
        return int(backoff[1:].sum()), int(unseen.sum()), out

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                tokens = _tokens(row.column("tokens")[0].as_py())
                keys = row.column("keys")[0].values
                keys = np.zeros(0, np.int64) if keys is None else keys.to_numpy()
                totals = row.column("totals")[0].values
                totals = np.zeros(0, np.int64) if totals is None else totals.to_numpy()
                order = np.argsort(keys)
                keys, totals = keys[order], totals[order]
                out, at = [], 0
                for doc, end in zip(row.column("doc_ids")[0].as_py(), row.column("ends")[0].as_py(), strict=True):
                    mine = tokens[at:end]
                    out.append((doc, len(mine), *(score_one(mine, keys, totals) if len(mine) else (0, 0, 0.0))))
                    at = end
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    scored = joined.select("doc_ids", "ends", "tokens", "keys", "totals").mapInArrow(
        score, "doc_id bigint, n_tokens bigint, n_backoff bigint, n_unseen bigint, score double"
    )
    return scored.withColumn("mean_score", F.when(F.col("n_tokens") > 0, F.col("score") / F.col("n_tokens")))


@query("op2_lm_scores")
def op2_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scores(table(spark, sf, "documents"), *public_vocabulary())
