"""Work that goes on from run to run: ledgers of delivered seeds and profiles of growing sets of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.audits import _COVERAGE, _organisms, _rules, _specimens
from bindings.registry import query, table
from metacurate.operators.checkpoints import new_folder
from metacurate.plans.coverage import add_to_profile, coverage_audit, merged_profile
from metacurate.streaming.ledger import deliver, deliver_stream, delivered_rows, read_ledger, read_seed_stream

_SEED = "seed string, arrival int, status string"
_EARLY = "o_orderpriority <> '1-URGENT'"
_LATE = "o_orderstatus <> 'F'"


def _arrivals(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Seeds of two days; those that come on both days are to be delivered on the first."""
    orders = table(spark, sf, "orders")
    seed = F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("seed")

    def day(condition: str, number: int) -> DataFrame:
        return orders.where(condition).select(seed, F.lit(number).alias("arrival"), F.col("o_orderstatus").alias("status"))

    return day(_EARLY, 1), day(_LATE, 2)


_DELIVERED = f"""
    first AS (SELECT 'R' || o_orderkey AS seed, 1 AS arrival, o_orderstatus AS status FROM orders WHERE {_EARLY}),
    second AS (SELECT 'R' || o_orderkey AS seed, 2 AS arrival, o_orderstatus AS status FROM orders WHERE {_LATE}),
    delivered AS (SELECT * FROM first UNION ALL SELECT * FROM second WHERE seed NOT IN (SELECT seed FROM first))
"""


@query(
    "ledger_stream",
    f"""
    WITH {_DELIVERED}
    SELECT seed, arrival, status, CAST(1 AS BIGINT) AS n FROM delivered
    UNION ALL SELECT 'run 1', NULL, NULL, count(*) FROM first
    UNION ALL SELECT 'run 2', NULL, NULL, 0
    UNION ALL SELECT 'run 3', NULL, NULL, count(*) FILTER (arrival = 2) FROM delivered
    """,
)
def stream_of_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Delivered seeds and the number that each of three runs delivered; nothing arrived before the second."""
    seeds, out, state = (new_folder(spark, n) for n in ("seeds", "delivered", "delivered-state"))

    def run() -> int:
        return delivered_rows(deliver_stream(read_seed_stream(spark, seeds, _SEED), "seed", out, state, "json"))

    first, second = _arrivals(spark, sf)
    first.write.parquet(seeds)
    counts = [run(), run()]
    second.write.mode("append").parquet(seeds)
    counts.append(run())
    delivered = spark.read.schema(_SEED).json(out).groupBy("seed", "arrival", "status").agg(F.count("*").alias("n"))
    runs = [(f"run {i + 1}", None, None, n) for i, n in enumerate(counts)]
    return delivered.unionByName(spark.createDataFrame(runs, f"{_SEED}, n bigint"))


@query(
    "ledger_delivery",
    f"""
    WITH {_DELIVERED},
    runs AS (SELECT seed, 1 AS run, 'written' AS place FROM first
             UNION ALL SELECT seed, 3, 'written' FROM delivered WHERE arrival = 2)
    SELECT * FROM runs UNION ALL SELECT seed, NULL, 'ledger' FROM runs
    """,
)
def delivered_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """What three runs wrote and what the ledger holds; the second run finds nothing pending."""
    ledger, out = new_folder(spark, "ledger"), new_folder(spark, "delivered")

    def run(seeds: DataFrame, number: int) -> DataFrame:
        def write(pending: DataFrame) -> DataFrame:
            pending.write.mode("overwrite").parquet(f"{out}/{number}")
            return spark.read.schema(_SEED).parquet(f"{out}/{number}")

        return deliver(spark, seeds, "seed", ledger, write).select("seed", F.lit(number).alias("run"), F.lit("written").alias("place"))

    first, second = _arrivals(spark, sf)
    runs = run(first, 1).unionByName(run(first, 2)).unionByName(run(second, 3))
    held = read_ledger(spark, ledger).select(
        F.col("seed_id").alias("seed"), F.lit(None).cast("int").alias("run"), F.lit("ledger").alias("place")
    )
    return runs.unionByName(held)


@query(
    "incremental_coverage",
    f"""
    WITH {_COVERAGE}
    SELECT section, status, field, CAST(total AS BIGINT) AS total, CAST(n AS BIGINT) AS "count", CAST(p AS BIGINT) AS present
    FROM c
    """,
)
def coverage_of_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage from the counters of two batches of documents, the second of which replaces a wrong one."""
    organisms, specimens = _organisms(spark, sf), _specimens(spark, sf)
    path, even = new_folder(spark, "profile"), F.xxhash64("_id") % 2 == 0
    for batch, part in (("1", even), ("2", even), ("2", ~even)):
        add_to_profile(path, batch, organisms.where(part), specimens.where(part))
    detail = coverage_audit(merged_profile(spark, path), _rules(spark)).detail
    return detail.select("section", "status", "field", "total", "count", "present")
