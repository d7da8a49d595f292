"""Places in sorted groups."""

import random

import pytest

from metacurate.operators.ranks import ranked


@pytest.mark.parametrize("partitions", [1, 7])
def test_places_in_groups(spark, partitions):
    rnd = random.Random(5)
    data = [("hot", "x", i, rnd.random()) for i in range(3000)]
    data += [(g, None, i, rnd.random()) for g in (None, "a", "b") for i in range(40)]
    data += [("hot", None, 9, 0.5), ("one", "x", None, 0.5)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "g string, h string, i int, noise double").repartition(9)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = ranked(df, ["g", "h"], ["i"], rank="at", total="n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    groups = {}
    for g, h, i, _ in data:
        groups.setdefault((g, h), []).append((i is not None, i or 0))
    assert len(got) == len(data)
    for (g, h), items in groups.items():
        mine = sorted((r for r in got if (r["g"], r["h"]) == (g, h)), key=lambda r: r["at"])
        assert [r["at"] for r in mine] == list(range(len(items)))
        assert [(r["i"] is not None, r["i"] or 0) for r in mine] == sorted(items)
        assert {r["n"] for r in mine} == {len(items)}


def test_one_group_and_no_rows(spark):
    df = spark.range(100).selectExpr("99 - id AS id")
    assert all(r["id"] == r["rank"] for r in ranked(df, [], ["id"]).collect())
    assert ranked(df.where("id < 0"), [], ["id"], total="n").count() == 0
    assert ranked(df.where("id < 0"), ["id"], ["id"]).columns == ["id", "rank"]


def test_a_hot_group_takes_many_tasks(spark):
    df = spark.range(5000).selectExpr("'hot' AS g", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # the rows are few
    try:
        placed = ranked(df, ["g"], ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored_rows = spark.read.parquet(placed.inputFiles()[0].rsplit("/", 1)[0])
    assert stored_rows.selectExpr("shiftright(_ranked_row, 33) AS p").distinct().count() > 1
