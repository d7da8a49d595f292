"""Compression of integer vectors to product codes by per-dimension value dictionaries.

A vector is cut into parts, and each part is stored as the number of the nearest
entry of its codebook. Within a block of vectors each dimension has a dictionary
of the integers that occur in it; the squared differences of these to the entries
are tabulated once, and the distances of all parts are rows of these tables,
gathered by dictionary code and added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from metacurate.llm.registry import query, table
from metacurate.llm.topk import quantised
from metacurate.operators.checkpoints import stored
from metacurate.operators.joins import join_unique

PARTS, ENTRIES, ROUNDS = 16, 64, 2
_DENSE = 1 << 16
_SAFE = 1 << 27  # magnitudes whose sums of squared differences fit a long

_SUM = "decimal(38,0)"


def dictionary(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct integers of a dimension in order, and each row's place among them."""
    low, high = column.min(), column.max()
    if column.dtype == object or high - low >= _DENSE:
        return np.unique(column, return_inverse=True)
    present = np.zeros(int(high - low) + 1, bool)
    present[column - low] = True
    return np.flatnonzero(present) + low, (np.cumsum(present) - 1)[column - low]


def nearest(block: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each part of each row (the smallest of equally near ones) and the squared distances, added up.

    ``books[part, entry, position]`` are the codebooks.
    """
    parts, _, width = books.shape
    codes, errors = np.zeros((len(block), parts), np.int64), np.zeros(len(block), block.dtype)
    for p in range(parts):
        distances = np.zeros((len(block), books.shape[1]), block.dtype)
        for j in range(width):
            values, places = dictionary(block[:, p * width + j])
            distances += ((values[:, None] - books[p, :, j]) ** 2)[places]
        codes[:, p] = distances.argmin(axis=1)
        errors += distances[np.arange(len(block)), codes[:, p]]
    return codes, errors


def _blocks(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` integers; a shorter vector ends in zeros. Large values come as Python integers, so nothing overflows."""
    ends = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    sizes = np.diff(ends)
    if (sizes == width).all():
        out = values.reshape(len(column), width)
    else:
        out = np.zeros((len(column), width), np.int64)
        out[np.arange(width) < sizes[:, None]] = values
    large = out.size and (out.max() >= _SAFE or out.min() <= -_SAFE)
    return out.astype(object) if large else out


def _updated(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floors of their parts' means; an unused entry stays.

    Each task adds up its own parts, so at most one row for each entry leaves it.
    """
    parts, entries, width = books.shape

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((parts, entries, width), object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            block = _blocks(batch.column(0), parts * width)
            codes, _ = nearest(block, books)
            for p in range(parts):
                added = np.zeros((entries, width), block.dtype)
                np.add.at(added, codes[:, p], block[:, p * width : (p + 1) * width])
                sums[p] += added
                n[p] += np.bincount(codes[:, p], minlength=entries)
        at, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at), pa.array(entry), pa.array(n[at, entry]),
                pa.array([[Decimal(x) for x in s] for s in sums[at, entry]], pa.list_(pa.decimal128(38, 0))),
            ],
            ["part", "entry", "n", "sums"],
        )

    made = vectors.select("vec").mapInArrow(count, f"part bigint, entry bigint, n bigint, sums array<{_SUM}>")
    totals = [F.sum(F.col("sums")[j]) for j in range(width)]
    out = books.copy()
    for row in made.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*totals).alias("sums")).collect():
        out[row["part"], row["entry"]] = [int(s) // row["n"] for s in row["sums"]]
    return out


def learn(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks ``[part, entry, position]`` of ``vectors(vec_id, vec array<bigint>)``.

    They start as the parts of the rows with the ``entries`` smallest ids (null
    ids last, equal ids by vector); fewer rows give fewer entries. The length of
    the longest vector, rounded up to a multiple of ``parts``, is the width of
    all. Only codebooks come to the driver.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits")
    longest = vectors.agg(F.max(F.size("vec"))).first()[0] or 0
    width = -(-longest // parts)
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    books = np.zeros((parts, len(first), width), np.int64)
    for i, row in enumerate(first):
        books[:, i] = np.array([*row["vec"], *[0] * (parts * width - len(row["vec"]))], np.int64).reshape(parts, width)
    if books.size and max(abs(int(books.max())), abs(int(books.min()))) >= _SAFE:
        books = books.astype(object)
    for _ in range(rounds if len(first) else 0):
        books = _updated(vectors, books)
    return books


def encoded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of each vector: two hexadecimal digits a part, and the squared distance to the entries."""
    parts, entries, width = books.shape
    schema = StructType(
        [vectors.schema["vec_id"], vectors.schema["label"], StructField("code", StringType()), StructField("error", LongType())]
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = nearest(_blocks(batch.column(2), parts * width), books)
            hexes = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hexes, pa.string()), pa.array(errors.tolist(), pa.int64())], schema.names
            )

    return vectors.select("vec_id", "label", "vec").mapInArrow(code, schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes of ``vectors(vec_id, label, vec array<bigint>)`` and the codebooks they refer to.

    Returns ``vec_id, label, code, error, label_error``, the last one added up
    over equal labels, null being one. Rows without a vector are left out;
    rows without an id or label and repeated rows take part like any other. An
    empty vector counts as zeros. Sums of squares have to fit a long.
    """
    kept = vectors.where("vec IS NOT NULL").select("vec_id", "label", "vec")
    books = learn(kept, parts, entries, rounds)
    rows = stored(encoded(kept, books), "codes")
    keyed = rows.withColumns({"unlabelled": F.col("label").isNull(), "key": F.coalesce(F.col("label").cast("string"), F.lit(""))})
    totals = keyed.groupBy("unlabelled", "key").agg(F.sum("error").alias("label_error"))
    out = join_unique(keyed, totals, ["unlabelled", "key"])
    return out.select("vec_id", "label", "code", "error", "label_error"), books


def codebook_text(books: np.ndarray) -> str:
    """Components of all entries by part, entry and position, joined by commas."""
    return ",".join(str(int(x)) for x in books.ravel())


_ASSIGN = """
    c{0} AS (
      SELECT vec_id, row, part, entry, d FROM (
        SELECT p.vec_id, p.row, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d,
               row_number() OVER (PARTITION BY p.row, p.part ORDER BY sum((p.x - b.x) * (p.x - b.x)), b.entry) AS best
        FROM pieces p JOIN b{0} b ON b.part = p.part AND b.pos = p.pos GROUP BY p.vec_id, p.row, p.part, b.entry
      ) t WHERE best = 1
    )"""
_UPDATE = """,
    b{1} AS (
      SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x
      FROM b{0} b LEFT JOIN (
        SELECT c.part, c.entry, p.pos, (sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
        FROM c{0} c JOIN pieces p ON p.row = c.row AND p.part = c.part GROUP BY c.part, c.entry, p.pos
      ) m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos
    ),"""


@query(
    "op13_vector_codes",
    """
    WITH kept AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec,
             row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), cells AS (
      SELECT vec_id, row, unnest(vec) AS x, unnest(range(len(vec))) AS place, len(vec) // 16 AS width FROM kept
    ), pieces AS (
      SELECT vec_id, row, x, place // width AS part, place % width AS pos FROM cells
    ), b0 AS (
      SELECT part, row AS entry, pos, x FROM pieces WHERE row < 64
    ),"""
    + "".join(_ASSIGN.format(i) + (_UPDATE.format(i, i + 1) if i < ROUNDS else "") for i in range(ROUNDS + 1))
    + """, book AS (
      SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b2
    ), coded AS (
      SELECT row, string_agg(lower(printf('%02x', CAST(entry AS BIGINT))), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM c2 GROUP BY row
    )
    SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, b.codebooks_sha256
    FROM kept k JOIN coded c ON c.row = k.row, book b
    """,
)
def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "label", quantised(F.col("embedding"), 256).alias("vec"))
    codes, books = compress(vectors)
    digest = F.sha2(F.lit(codebook_text(books)), 256)
    return codes.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
