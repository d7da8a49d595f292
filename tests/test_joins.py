import pytest
from pyspark.sql import functions as F

from conftest import rows
from metacurate.operators import joins as j
from metacurate.operators.lookups import lookup_with_fallback
from metacurate.plans.reports import group_error_report, not_imported_errors


def test_semi_and_anti_joins(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(2,)] * 50 + [(None,)], "k int")
    assert rows(j.keep_matching(left, keys, "k")) == [(2,), (2,)]
    # a row without a key matches nothing
    assert rows(j.drop_matching(left, keys, "k")) == sorted([(1,), (None,)], key=repr)


def test_join_unique(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "a", "z")], "i int, k string, l string")
    right = spark.createDataFrame([("a", "x", 10), (None, "y", 20)], "k string, l string, v int")
    assert rows(j.join_unique(left, right, ["k", "l"], "left")) == sorted(
        [(1, "a", "x", 10), (2, None, "y", None), (3, "a", "z", None)], key=repr
    )
    assert rows(j.join_unique(left, right.drop("l"), "k"), "i", "v") == [(1, 10), (3, 10)]


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",  # the rows are few
}


@pytest.fixture
def skewed(spark, tmp_path):
    """A third of the rows share one key; thresholds are scaled down to the test."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.format_string("v%d", "id").alias("v"),
    ).write.parquet(str(tmp_path / "skewed"))
    yield spark.read.parquet(str(tmp_path / "skewed"))
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def split_joins(df):
    """Number of joins that AQE split in the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index("Initial Plan")].count("skew=true")


@pytest.mark.parametrize("how", ["keep", "drop", "lookup"])
def test_a_hot_key_is_split(skewed, how):
    if how == "lookup":
        lookups = skewed.select(F.lit(0).alias("priority"), F.col("k").alias("key"), F.col("v").alias("value"))
        df = lookup_with_fallback(skewed, lookups, "k", "found")
    else:
        keys = skewed.where("v < 'v5'")
        df = (j.keep_matching if how == "keep" else j.drop_matching)(skewed, keys, "k")
    plain = skewed.join(skewed.select("k").distinct(), "k", "left_semi")
    assert split_joins(plain) == 0
    assert split_joins(df) == 1


def _log(skewed):
    return skewed.select(
        F.col("v").alias("id"), F.col("k").alias("dataset"), F.lit("error").alias("overall"),
        F.lit("(ERROR)f:x").alias("detail"),
    )


def test_a_hot_dataset_is_spread(skewed):
    imported = skewed.where("k <> 'hot' and v < 'v5'").select(F.col("k").alias("dataset"))
    report = not_imported_errors(_log(skewed), imported, per_row=500)
    hot = report.where("dataset = 'hot'").select(F.spark_partition_id().alias("p"), F.size(F.split("ids", ", ")).alias("n"))
    tasks = rows(hot.groupBy("p").agg(F.sum("n")))
    assert sum(n for _, n in tasks) == 20000
    assert len(tasks) > 3


@pytest.mark.parametrize(("include_all", "include_ungrouped"), [(False, False), (True, False), (True, True)])
def test_a_hot_group_under_its_header_is_split(skewed, include_all, include_ungrouped):
    members = skewed.where("v < 'v8'").select(F.col("k").alias("group_id"), F.col("v").alias("id"))
    headers = members.select("group_id").distinct().withColumn("name", F.concat(F.lit("group "), "group_id"))
    report = group_error_report(
        _log(skewed), members, headers, include_all=include_all, include_ungrouped=include_ungrouped, per_row=1
    )
    assert split_joins(report) >= 1
    known = members.where("group_id = 'hot'").count()
    assert report.where("group_id = 'hot' AND name = 'group hot'").count() == known
    assert report.where("group_id IS NULL").count() == (60000 - members.count() if include_ungrouped else 0)
