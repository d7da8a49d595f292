from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from metacurate.operators import groups as g


@pytest.fixture
def skewed(spark):
    """One key holds two thirds of the rows; another key is NULL."""
    hot = spark.range(2000).select(F.lit("hot").alias("k"), F.format_string("i%05d", "id").alias("item"))
    rest = spark.range(900).select(
        F.concat(F.lit("k"), (F.col("id") % 300).cast("string")).alias("k"),
        F.format_string("i%05d", "id").alias("item"),
    )
    null = spark.range(3).select(F.lit(None).cast("string").alias("k"), F.format_string("n%d", "id").alias("item"))
    return hot.unionByName(rest).unionByName(null)


def test_pack_keeps_every_item_in_order(skewed):
    packed = g.pack_groups(skewed, ["k"], "item", per_row=100).collect()
    got = defaultdict(list)
    for r in sorted(packed, key=lambda r: r["part"]):
        assert r["part"] == len(got[r["k"]]) // 100
        got[r["k"]] += r["items"]
        assert len(r["items"]) <= 100
    expected = defaultdict(list)
    for k, item in skewed.collect():
        expected[k].append(item)
    assert got == {k: sorted(v) for k, v in expected.items()}
    assert {r["part"] for r in packed if r["k"] == "hot"} == set(range(20))
    assert all(r["n"] == len(expected[r["k"]]) for r in packed)


def test_the_size_of_a_group_does_not_change_the_rule(skewed):
    small = {(r["k"], r["part"], *r["items"]) for r in g.pack_groups(skewed, ["k"], "item", per_row=2).collect()}
    assert ("k7", 0, "i00007", "i00307") in small and ("k7", 1, "i00607") in small
    assert ("hot", 999, "i01998", "i01999") in small and (None, 1, "n2") in small


def test_hot_group_is_spread_even_if_the_input_is_partitioned_by_its_key(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        packed = g.pack_groups(skewed.repartition(4, "k"), ["k"], "item", per_row=100)
        tasks = packed.where("k = 'hot'").select(F.spark_partition_id().alias("p"), F.size("items").alias("s"))
        sizes = rows(tasks.groupBy("p").agg(F.sum("s")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4
    assert max(s for _, s in sizes) < 1200


def test_pack_in_given_order(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("a", 2, "z")], "k string, pos int, item string")
    (row,) = g.pack_groups(df, ["k"], "item", order=["pos"]).collect()
    assert [i["item"] for i in row["items"]] == ["y", "z", "x"] and row["n"] == 3


def test_joined_groups(spark):
    df = spark.createDataFrame([("a", "2"), ("a", "10"), ("b", "1")], "k string, item string")
    assert rows(g.joined_groups(df, ["k"], "item", "|"), "k", "n", "items") == [("a", 2, "10|2"), ("b", 1, "1")]
