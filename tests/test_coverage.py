import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from metacurate.functions.text import lower_camel
from metacurate.operators import coverage as ops
from metacurate.plans.coverage import add_to_profile, coverage_audit, document_profile, gap_audit, merged_profile, missing_documents
from metacurate.sources.readers import read_hits, read_ruleset

RULES = {
    "rule_groups": [
        {"name": "standard", "rules": [
            {"name": "Sample Description", "mandatory": "optional"},
            {"name": "material", "mandatory": "mandatory"},
        ]},
        {"name": "animal", "condition": {"attribute_value_match": {"Material": ["organism", "other"]}}, "rules": [
            {"name": "birth_date", "mandatory": "recommended"},
            {"name": "breed", "mandatory": "optional"},
            {"name": "Sex", "mandatory": "mandatory"},
        ]},
        {"name": "cell line", "rules": [
            {"name": "passages", "mandatory": "optional"},
            {"name": "derived from", "mandatory": "mandatory"},
            {"name": "supplier", "mandatory": "mandatory"},
            {"name": "country", "mandatory": "mandatory"},
        ]},
        {"name": "cell culture", "rules": [{"name": "medium", "mandatory": "recommended"}]},
    ]
}
ORGANISMS = [
    ("o1", {"material": {"text": "organism"}, "description": "d", "birthDate": {"text": "2018"}, "breed": ["", "x"],
            "sex": {"text": "f"}}),
    ("o2", {"material": {"text": "organism"}, "description": "not provided", "breed": ["not provided", "x"],
            "birthDate": None, "sex": None}),
    ("o3", {"material": {"text": "organism"}, "breed": [], "birthDate": {"text": "", "ontologyTerms": "t"}}),
    ("o4", {"material": {"text": "odd"}, "description": "e", "breed": "z", "sex": []}),
]
SPECIMENS = [
    ("s1", {"material": {"text": "cell line"}, "derivedFrom": ["o1"],
            "cellLine": {"passages": {"text": "3"}, "supplier": "s", "country": "c"}}),
    ("s2", {"material": {"text": "cell line"}, "cellLine": {"passages": "restricted access", "supplier": None,
                                                            "country": "c"}}),
    # an object named after another section counts as present there, but not as meaningful
    ("s3", {"material": {"text": "pool of specimens"}, "derivedFrom": ["o1"], "cellLine": {"passages": "4"}}),
    ("s4", {"derivedFrom": ["o2"]}),
]


def page(docs):
    return {"hits": {"total": len(docs), "hits": [{"_id": i, "_source": d} for i, d in docs]}}


@pytest.fixture
def rules(spark, put):
    return read_ruleset(spark, put("rules.json", RULES))


@pytest.fixture
def organisms(spark, put):
    return read_hits(spark, put("organisms.json", page(ORGANISMS)))


@pytest.fixture
def specimens(spark, put):
    return read_hits(spark, put("specimens.json", page(SPECIMENS)))


@pytest.fixture
def profile(organisms, specimens):
    return document_profile(organisms, specimens)


def test_rules(rules):
    assert rows(rules.where("status = 'optional'"), "section", "field", "section_pos", "rule_pos") == [
        ("cell line", "passages", 2, 0), ("organism", "breed", 1, 1), ("standard", "description", 0, 0),
    ]


def test_coverage_detail(rules, profile):
    detail = coverage_audit(profile, rules).detail
    got = {r["field"]: r for r in detail.collect()}
    pick = lambda f: tuple(got[f][c] for c in ("section", "status", "total", "count", "present"))
    assert pick("description") == ("standard", "optional", 4, 2, 3)
    assert pick("birthDate") == ("organism", "recommended", 4, 1, 2)
    # an array stops at its first non-empty element; other materials count as present only
    assert pick("breed") == ("organism", "optional", 4, 1, 3)
    assert pick("passages") == ("cell line", "optional", 2, 1, 3)
    assert pick("medium") == ("cell culture", "recommended", 0, 0, 0)
    assert got["medium"]["ratio"] is None and got["medium"]["present_ratio"] is None
    assert got["passages"]["ratio"] == 0.5 and got["passages"]["present_ratio"] == 1.5


def test_coverage_averages(rules, profile):
    averages = coverage_audit(profile, rules).averages
    got = {(s, t): (round(a, 6), round(b, 6)) for s, t, a, b in averages.collect()}
    assert got == {
        ("standard", "optional"): (0.5, 0.75),
        ("organism", "recommended"): (0.25, 0.5),
        ("organism", "optional"): (0.25, 0.75),
        ("cell line", "optional"): (0.5, 1.5),
        ("animal", "optional"): (0.375, 0.75),
        ("animal", "recommended"): (0.25, 0.5),
        ("specimen", "optional"): (0.5, 1.5),
        ("overall", "optional"): (round(1.25 / 3, 6), 1.0),
        ("overall", "recommended"): (0.25, 0.5),
    }


def test_gaps(rules, profile):
    got = {r["field"]: (r["section"], r["n_missing"], r["n_expected"]) for r in gap_audit(profile, rules).collect()}
    # 3 of 4 specimens have a material, 2 of them are cell lines
    assert got == {
        "sex": ("organism", 3, 0),
        "supplier": ("cell line", 3, 1),
        "country": ("cell line", 2, 1),
    }


def test_batches_of_documents_add_up(spark, organisms, specimens, profile, tmp_path):
    path = str(tmp_path / "profile")
    first = F.col("_id").isin("o1", "o2", "s1")
    add_to_profile(path, "1", organisms.where(first), specimens.where(first))
    assert rows(merged_profile(spark, path)) != rows(profile)
    add_to_profile(path, "2", organisms, specimens)  # wrong documents
    add_to_profile(path, "2", organisms.where(~first), specimens.where(~first))
    assert rows(merged_profile(spark, path), *profile.columns) == rows(profile)
    add_to_profile(path, "3", organisms.where("false"), specimens.where("false"))
    assert rows(merged_profile(spark, path), *profile.columns) == rows(profile)
    with pytest.raises(ValueError, match="batch name"):
        add_to_profile(path, "a/b", organisms, specimens)


def test_ruled_paths_give_the_same_audits(rules, organisms, specimens, profile):
    ruled = document_profile(organisms, specimens, rules=rules)
    got, expected = coverage_audit(ruled, rules), coverage_audit(profile, rules)
    assert rows(got.detail) == rows(expected.detail)
    assert rows(got.averages) == rows(expected.averages)
    assert rows(gap_audit(ruled, rules)) == rows(gap_audit(profile, rules))
    named = {r["field"] for r in rules.collect()}
    assert {r["field"] for r in ruled.where("field IS NOT NULL").collect()} <= named
    assert not {r["field"] for r in profile.where("field IS NOT NULL").collect()} <= named


def test_ruled_paths_reach_the_scan(spark, rules, specimens, tmp_path):
    specimens.write.parquet(str(tmp_path / "s"))
    docs = ops.prepare_documents(spark.read.parquet(str(tmp_path / "s")), "specimen")
    counted = ops.ruled_counts(docs, [("cellLine", "passages"), ("", "derivedFrom")])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("HashAggregate")  # counters are unpivoted, not documents
    assert "ReadSchema: struct<doc:struct<" in plan  # paths, not whole documents
    none = ops.ruled_counts(docs, [])
    assert rows(none.where("field IS NULL"), "material", "n") == rows(docs.groupBy("material").count())


def test_missing_documents(rules, organisms):
    got = rows(missing_documents(organisms, rules))
    assert got == [("organism", "sex", "o2"), ("organism", "sex", "o3"), ("organism", "sex", "o4")]


def test_missing_ids_agree_with_the_gap_count(rules, organisms, profile):
    counted = {r["field"]: r["n_missing"] for r in gap_audit(profile, rules).where("section = 'organism'").collect()}
    listed = dict(rows(missing_documents(organisms, rules).groupBy("field").count()))
    assert counted == listed


def test_counts_are_nested(profile):
    # meaningful <= present <= all
    totals = {(r["scope"], r["material"]): r["n"] for r in ops.scope_totals(profile).collect()}
    for r in profile.where("field is not null").collect():
        assert r["n_meaningful"] <= r["n_present"] <= totals[r["scope"], r["material"]]


def test_missing_ids_of_no_rules_and_of_many(spark, rules, organisms):
    assert missing_documents(organisms, rules.where("false")).count() == 0
    many = spark.range(11_000).select(
        F.lit("organism").alias("section"), F.format_string("f%05d", "id").alias("field"), F.lit("mandatory").alias("status")
    )
    n = organisms.count()
    got = missing_documents(organisms, many).groupBy("field").count()
    assert rows(got.groupBy("count").agg(F.count("*").alias("fields"))) == [(n, 11_000)]


def test_column_coverage(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "not provided", None), ("a", None, 0), ("b", "", 5)], "s string, f string, g int"
    )
    assert rows(ops.column_coverage(df, "s", ["f", "g"])) == [
        ("a", "f", 3, 1, 2), ("a", "g", 3, 2, 2), ("b", "f", 1, 0, 1), ("b", "g", 1, 1, 1),
    ]


def test_material_totals(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "m string")
    assert rows(ops.material_totals(df, "m", grand_total=True)) == sorted(
        [("a", 2, False), ("b", 1, False), (None, 1, False), (None, 4, True)], key=repr
    )
    assert rows(ops.material_totals(df, F.upper("m"))) == sorted(
        [("A", 2, False), ("B", 1, False), (None, 1, False)], key=repr
    )


def test_container_names_follow_the_section(spark):
    df = spark.createDataFrame([("pool of specimens",)], "s string")
    assert df.select(lower_camel(F.col("s"))).first()[0] == "poolOfSpecimens"
