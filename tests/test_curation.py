import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from metacurate.operators import curation as cu
from metacurate.sources import schemas

SAMPLES = [
    {
        "accession": "S1",
        "characteristics": {
            "Sex": [{"text": "male", "ontologyTerms": ["old1", "old2"]}],
            "weight": [{"text": "3", "unit": "kg"}, {"text": "5"}],
            "note": [{"text": 'said "hi"'}],
            "empty": [],
        },
        "relationships": [
            {"type": "derived from", "source": "S1", "target": "P1"},
            {"type": "derived from", "source": "S1", "target": "P2"},
            {"type": "derived from", "source": "S9", "target": "P9"},
        ],
    },
    {"accession": "S2", "characteristics": {"Sex": [{"text": "f"}, {"text": "female", "ontologyTerms": ["old"]}]},
     "relationships": []},
    {"accession": "S3", "characteristics": {}, "relationships": [
        {"type": "derived from", "source": "S3", "target": "P3"}]},
    {"accession": "S4", "characteristics": {}, "relationships": [
        {"type": "has member", "source": "S4", "target": "P1"}]},
    {"accession": "S5", "characteristics": {}, "relationships": [
        {"type": "derived from", "source": "S5", "target": "missing"}]},
    {"accession": "P1", "characteristics": {"Organism": [{"text": "hen"}]}, "relationships": []},
    {"accession": "P2", "characteristics": {"Organism": [{"text": "Bos"}, {"text": "cow", "ontologyTerms": ["9913"]}]},
     "relationships": []},
    {"accession": "P3", "characteristics": {"Sex": [{"text": "x"}]}, "relationships": []},
]


@pytest.fixture
def samples(spark, put):
    return spark.read.schema(schemas.SAMPLE).option("multiLine", True).json(put("samples.json", SAMPLES))


def worklist(spark, *pairs):
    return spark.createDataFrame(list(pairs), "sample string, field string")


def payloads(records, domain="self.lab"):
    out = {}
    for r in cu.curation_payload(records, domain).collect():
        p = json.loads(r["payload"])
        assert p["sample"] == r["sample"] and p["domain"] == domain
        assert p["curation"]["externalReferencesPre"] == p["curation"]["externalReferencesPost"] == []
        out.setdefault((r["sample"], r["field"]), []).append(
            (p["curation"]["attributesPre"], p["curation"]["attributesPost"])
        )
    return out


SEX = {"type": "Sex", "value": "male", "iri": ["old1", "old2"]}
WEIGHT = {"type": "weight", "value": "5", "unit": "kg"}
NOTE = {"type": "note", "value": 'said "hi"'}


def test_remove_field(spark, samples):
    work = worklist(spark, ("S1", "Sex"), ("S1", "weight"), ("S1", "note"), ("S1", "absent"), ("S8", "Sex"),
                    ("S1", "empty"))
    assert payloads(cu.remove_field(work, samples)) == {
        ("S1", "Sex"): [([SEX], [])],
        ("S1", "weight"): [([WEIGHT], [])],
        ("S1", "note"): [([NOTE], [])],
        ("S1", "empty"): [([{"type": "empty", "value": ""}], [])],
    }


def test_a_repeated_work_item_gives_a_repeated_record(spark, samples):
    work = worklist(spark, ("S1", "Sex"), ("S1", "Sex"))
    assert payloads(cu.remove_field(work, samples)) == {("S1", "Sex"): [([SEX], [])] * 2}


def test_replace_value(spark, samples):
    work = worklist(spark, ("S1", "Sex"), ("S1", "weight"), ("S1", "note"))
    got = payloads(cu.replace_value(work, samples, 'n"ew'))
    assert got == {
        ("S1", "Sex"): [([SEX], [{**SEX, "value": 'n"ew'}])],
        # with a unit the value stays and the unit is replaced
        ("S1", "weight"): [([WEIGHT], [{**WEIGHT, "unit": 'n"ew'}])],
        ("S1", "note"): [([NOTE], [{"type": "note", "value": 'n"ew'}])],
    }


def test_remove_and_replace_agree_on_before(spark, samples):
    work = worklist(spark, ("S1", "Sex"), ("S1", "weight"), ("S2", "Sex"))
    before = lambda records: rows(records, "sample", "field", "before")
    assert before(cu.remove_field(work, samples)) == before(cu.replace_value(work, samples, "x"))


@pytest.mark.parametrize("as_table", [False, True])
def test_replace_term(spark, samples, as_table):
    terms = {"male": "iri:male", "female": "iri:female"}
    if as_table:
        terms = spark.createDataFrame(list(terms.items()), "text string, iri string")
    work = worklist(spark, ("S1", "Sex"), ("S2", "Sex"), ("S1", "note"))
    records, unmapped = cu.replace_term(work, samples, terms)
    assert payloads(records) == {
        ("S1", "Sex"): [([SEX], [{**SEX, "iri": ["iri:male"]}])],
        ("S2", "Sex"): [
            ([{"type": "Sex", "value": "female", "iri": ["old"]}],
             [{"type": "Sex", "value": "female", "iri": ["iri:female"]}])
        ],
    }
    assert rows(unmapped) == [("S1", "note", 'said "hi"')]


def test_replace_term_without_old_terms(spark, samples):
    records, _ = cu.replace_term(worklist(spark, ("S1", "note")), samples, {'said "hi"': "iri"})
    ((before, after),) = payloads(records)[("S1", "note")]
    assert before == [{**NOTE, "iri": []}] and after == [{**NOTE, "iri": ["iri"]}]


def test_replace_unit(spark, samples):
    got = payloads(cu.replace_unit(worklist(spark, ("S1", "weight"), ("S1", "note")), samples, "g"))
    assert got == {
        ("S1", "weight"): [([WEIGHT], [{**WEIGHT, "unit": "g"}])],
        ("S1", "note"): [([{**NOTE, "unit": ""}], [{**NOTE, "unit": "g"}])],
    }


def test_copy_from_parent(spark, samples):
    records, unresolved = cu.copy_from_parent(samples.where("accession like 'S%' or accession like 'P%'"), "Organism")
    # the last parent wins
    assert payloads(records) == {
        ("S1", "Organism"): [([], [{"type": "Organism", "value": "cow", "iri": ["9913"]}])]
    }
    assert rows(unresolved) == sorted(
        [("S2", "Organism", None), ("S3", "Organism", "P3"), ("S4", "Organism", None), ("S5", "Organism", "missing"),
         ("P3", "Organism", None)],
        key=repr,
    )


def test_samples_lacking(samples):
    assert rows(cu.samples_lacking(samples, "Sex"), "accession") == [("P1",), ("P2",), ("S3",), ("S4",), ("S5",)]


def test_only_listed_fields_are_shuffled(spark, samples):
    wanted = worklist(spark, ("S1", "Sex"))
    found = cu.worklist_values(wanted, samples)
    assert rows(found, "sample", "field") == [("S1", "Sex")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    below = plan.index("LeftSemi")
    assert plan.index("Join Inner") < below < plan.index("Generate explode(characteristics")


def test_of_a_repeated_text_one_term_counts(spark, samples):
    terms = spark.createDataFrame([("male", "b"), ("male", "a")], "text string, iri string")
    records, unmapped = cu.replace_term(worklist(spark, ("S1", "Sex"), ("S1", "note")), samples, terms)
    assert [r["after"][0]["iri"] for r in records.collect()] == [["a"]]
    assert rows(unmapped, "field") == [("note",)]
