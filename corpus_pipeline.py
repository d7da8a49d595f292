"""Corpus pipeline over ``documents``: quality rules, near duplicates, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder and reads it again as the
documents of the next stage; what a stage stored on its way is deleted then. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metacurate.llm.jaccard import BROADCAST_ROWS, near_duplicates  # noqa: E402
from metacurate.llm.packing import PUBLIC_SPECIAL, pack_documents, public_vocabulary  # noqa: E402
from metacurate.llm.pii import find_pii, redacted  # noqa: E402
from metacurate.llm.quality import quality_verdicts  # noqa: E402
from metacurate.llm.registry import query, table  # noqa: E402
from metacurate.operators.checkpoints import stored, temporary_tables  # noqa: E402
from metacurate.operators.joins import join_unique  # noqa: E402

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def boxed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and ``_other`` with all other columns, whose names then clash with no operator's own."""
    others = [docs[f"`{c}`"] for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_none"), *others).alias("_other"))


def unboxed(df: DataFrame, columns: list[str]) -> DataFrame:
    """The ``columns`` that ``boxed`` put away."""
    return df.select(*[F.col(c) if c in ("doc_id", "text") else F.col("_other").getField(c).alias(c) for c in columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the fixed rules nor the learned ones reject."""
    verdicts = quality_verdicts(boxed(docs), table(spark, sf_dir, "labels"), keep=["doc_id", "text", "_other"])
    return unboxed(verdicts.where("kept"), docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class.

    Rows without an id are in no class and stay; of rows that repeat an id one stays.
    Up to 2**20 kept ids are broadcast, so that no text is shuffled for them; beyond that, each is once.
    """
    classes = near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    first = stored(classes.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")), "kept_ids")
    small = first.count() <= BROADCAST_ROWS

    def having(ids: DataFrame) -> DataFrame:
        ids = ids.select("doc_id")
        return docs.join(F.broadcast(ids), "doc_id", "left_semi") if small else join_unique(docs, ids, "doc_id", "left_semi")

    single, repeated = having(first.where("n = 1")), having(first.where("n > 1")).dropDuplicates(["doc_id"])
    return single.unionByName(repeated).unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each span of personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = unboxed(redacted(find_pii(boxed(docs), ["doc_id", "text", "_other"])), docs.columns)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in training sequences."""
    return pack_documents(docs, *public_vocabulary(), special=PUBLIC_SPECIAL)


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("personal data", remove_personal_data),
    ("best-fit packing", pack),
]

#: The learned rules cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with temporary_tables(spark) as made:
            docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            made.pop()  # the result stays
    return docs
