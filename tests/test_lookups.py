import pytest
from pyspark.sql import functions as F

from conftest import rows
from metacurate.operators import lookups as lk


@pytest.fixture
def lookups(spark):
    return spark.createDataFrame(
        [(1, "r1", "auto1"), (0, "r1", "manual1"), (1, "r2", "auto2"), (0, "r3", ""), (1, "r3", "auto3"),
         (0, "r4", "0"), (0, "r5", None)],
        "priority int, key string, value string",
    )


def test_first_available(lookups):
    assert rows(lk.first_available(lookups)) == [("r1", "manual1"), ("r2", "auto2"), ("r3", "auto3")]


def test_lookup_keeps_every_row(spark, lookups):
    runs = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r4", "a"), ("r9", "a"), ("r3", None)], "run string, kind string")
    found = lk.lookup_with_fallback(runs, lookups, "run", "control")
    assert rows(found, "run", "control") == sorted(
        [("r1", "manual1"), ("r2", "auto2"), ("r3", "auto3"), ("r4", None), ("r9", None)], key=repr
    )
    some = lk.lookup_with_fallback(runs, lookups, "run", "control", F.col("kind") == "a")
    assert rows(some, "run", "control") == sorted(
        [("r1", "manual1"), ("r2", None), ("r3", None), ("r4", None), ("r9", None)], key=repr
    )


def test_references(spark):
    runs = spark.createDataFrame([(1, 10), (2, 11), (3, 99)], "run int, experiment_id int")
    experiments = spark.createDataFrame([(10, 5, 7), (11, 6, 7)], "experiment_id int, sample_id int, study_id int")
    samples = spark.createDataFrame([(5, "s5"), (6, "s6")], "sample_id int, s string")
    studies = spark.createDataFrame([(7, "st")], "study_id int, st string")
    out = lk.reference_chain(runs, experiments, samples, studies)
    assert rows(out, "run", "s", "st") == [(1, "s5", "st"), (2, "s6", "st")]
    assert rows(lk.missing_references(runs, experiments, "experiment_id")) == [(99,)]
    with pytest.raises(ValueError, match="99"):
        lk.require_references(runs, experiments, "experiment_id")
    ok = runs.where("run < 3")
    assert lk.require_references(ok, experiments, "experiment_id") is ok
