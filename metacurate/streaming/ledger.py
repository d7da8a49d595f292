"""Pending-only processing: what was delivered before is not delivered again.

``deliver`` compares a table of seeds with a ledger table. ``deliver_stream``
reads only the files that are new since the last run and keeps the delivered
keys as state of a streaming query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from metacurate.operators.joins import drop_matching
from metacurate.sources.schemas import LEDGER


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Delivered seeds; an absent ledger is empty."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as failed:
        if failed.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def pending_only(seeds: DataFrame, ledger: DataFrame, key: str, ledger_key: str = "seed_id") -> DataFrame:
    """Seeds that the ledger does not hold."""
    return drop_matching(seeds, ledger.select(F.col(ledger_key).alias(key)), key)


def deliver(
    spark: SparkSession,
    seeds: DataFrame,
    key: str,
    ledger_path: str,
    write: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Write the pending seeds, then mark them complete.

    ``write`` stores the pending rows and returns them as read back from there;
    the ledger takes its keys from that, so it lists what was really delivered
    even if the inputs change meanwhile. A failure before the ledger entry means
    the next run delivers the same seeds again, so ``write`` has to replace what
    an interrupted run left behind.
    """
    written = write(pending_only(seeds, read_ledger(spark, ledger_path), key))
    done = written.select(F.col(key).cast("string").alias("seed_id")).distinct()
    done.withColumn("completed_at", F.current_timestamp()).write.mode("append").parquet(ledger_path)
    return written


def read_seed_stream(spark: SparkSession, path: str, schema: str, file_format: str = "parquet", **options) -> DataFrame:
    """Seeds of a growing folder, as a stream that gives each file once."""
    return spark.readStream.schema(schema).format(file_format).options(**options).load(path)


def deliver_stream(
    seeds: DataFrame, key: str, path: str, checkpoint: str, file_format: str = "parquet", **options
) -> StreamingQuery:
    """Deliver the seeds that arrived since the last run with this checkpoint, each key once; returns the finished query.

    The ledger is the query's state, the keys delivered so far, partitioned by
    key and updated with each batch, so a run reads its new seeds and not what
    was delivered. Of rows that share a key in one run any one is delivered;
    seeds without a key are left out. The files of a batch are published under
    its number: a run that stopped after writing them, but before the
    checkpoint noted so, repeats the batch without delivering anything twice.
    Read the result with Spark from ``path``, which ignores unpublished files.

    ``path`` and ``checkpoint`` belong together and have to be on shared
    storage. The number of partitions of the state is that of the first run.
    """
    pending = seeds.where(F.col(key).isNotNull()).dropDuplicates([key])
    query = (
        pending.writeStream.format(file_format)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def delivered_rows(query: StreamingQuery) -> int:
    """Number of keys that a finished run delivered."""
    return sum(op["numRowsUpdated"] for p in query.recentProgress for op in p["stateOperators"])
