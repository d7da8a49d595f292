import pytest
from pyspark.sql import functions as F

from conftest import rows
from metacurate.operators.entities import group_headers, group_ids, group_members, project_samples
from metacurate.sources import readers as r


def test_entities(spark, put):
    entities = [{"id": "A", "attributes": [{"name": "x", "value": "1"}]}, {"id": "B"}]
    df = r.read_entities(spark, put("e.json", entities))
    assert rows(df.select("id", F.size("attributes"))) == sorted([("A", 1), ("B", None)], key=repr)


def test_repeated_entities(spark, put):
    entities = [{"id": "A", "pos": 0, "attributes": [{"name": "old"}]},
                {"id": "A", "pos": 1, "attributes": [{"name": "new"}]}]
    path = put("e.json", entities)
    with pytest.raises(ValueError, match="repeated id"):
        r.read_entities(spark, path)
    last = r.read_entities(spark, path, on_duplicate="last", position="pos")
    assert rows(last.select("id", F.col("attributes")[0]["name"])) == [("A", "new")]
    with pytest.raises(ValueError, match="position"):
        r.read_entities(spark, path, on_duplicate="last")
    with pytest.raises(ValueError, match="on_duplicate"):
        r.read_entities(spark, path, on_duplicate="first")


def test_broken_entity_file_fails(spark, put):
    with pytest.raises(Exception):
        r.read_entities(spark, put("e.json", '[{"id": "A"'))


def test_unknown_layout(spark, put):
    with pytest.raises(ValueError, match="layout"):
        r.read_entities(spark, put("e.json", []), layout="tree")


def test_lookups(spark, put):
    df = r.read_lookups(spark, [put("manual.json", {"r1": "m1"}), put("auto.json", {"r1": "a1", "r2": ""})])
    assert rows(df) == [(0, "r1", "m1"), (1, "r1", "a1"), (1, "r2", "")]
    lines = put("l.jsonl", '{"key":"r1","value":"x"}\n{"key":"r2","value":null}\n')
    assert rows(r.read_lookups(spark, [lines], layout="lines")) == [(0, "r1", "x"), (0, "r2", None)]
    assert r.read_lookups(spark, []).columns == ["priority", "key", "value"]


def test_tab_separated_logs_keep_quotes(spark, put):
    df = r.read_sample_log(spark, put("l.tsv", 's1\torganism\terror\t(ERROR)a:"b\ns2\tspecimen\twarning\t(WARNING)c:d;\n'))
    assert rows(df) == [("s1", "organism", "error", '(ERROR)a:"b'), ("s2", "specimen", "warning", "(WARNING)c:d;")]
    df = r.read_experiment_log(spark, put("x.tsv", "e1\td1\tx\terror\t(ERROR)a:b\n"))
    assert rows(df) == [("e1", "d1", "error", "(ERROR)a:b")]
    assert rows(r.read_worklist(spark, put("w.tsv", "s1\tSex\ns1\tbreed\n"))) == [("s1", "Sex"), ("s1", "breed")]


def test_hits(spark, put):
    page = {"hits": {"hits": [{"_id": "1", "_source": {"a": [1, {"b": None}]}}, {"_id": "2", "_source": {"a": "x"}}]}}
    df = r.read_hits(spark, put("p.json", page))
    assert rows(df.select("_id", F.to_json("doc"))) == [("1", '{"a":[1,{"b":null}]}'), ("2", '{"a":"x"}')]
    lines = r.read_hits(spark, put("p.jsonl", '{"_id":"3","_source":{"a":1}}\n'), layout="lines")
    assert rows(lines.select("_id", F.to_json("doc"))) == [("3", '{"a":1}')]


def test_sample_pages_from_a_directory(spark, tmp_path):
    import json

    sample = lambda i, project: {
        "accession": i,
        "characteristics": {"project": [{"text": project}]},
        "relationships": [
            {"type": "has member", "source": "SAMEG12", "target": i},
            {"type": "has member", "source": "OTHER1", "target": i},
            {"type": "derived from", "source": "SAMEG13", "target": i},
        ],
    }
    for n, (i, project) in enumerate([("A", "Core"), ("B", "CORE"), ("C", "else")]):
        (tmp_path / f"{n}.json").write_text(json.dumps({"_embedded": {"samples": [sample(i, project)]}}))
    df = r.read_sample_pages(spark, str(tmp_path))
    assert rows(df, "accession") == [("A",), ("B",), ("C",)]
    core = project_samples(df, "core")
    assert rows(group_ids(core)) == [("A", "SAMEG12"), ("B", "SAMEG12")]


def test_groups(spark, put):
    group = {
        "accession": "G1", "name": "n", "releaseDate": "2018", "updateDate": "2019",
        "characteristics": {"Submission Title": [{"text": "t"}]},
        "contact": [{"Name": "X", "E-mail": "x@y"}, {"Name": "Y"}],
        "organization": [{"Name": "O"}, {"Name": "O"}, {"Name": "P"}],
        "relationships": [
            {"type": "has member", "source": "G1", "target": "A"},
            {"type": "has member", "source": "G1", "target": "A"},
            {"type": "has member", "source": "G2", "target": "B"},
            {"type": "other", "source": "G1", "target": "C"},
        ],
    }
    df = r.read_groups(spark, put("g.json", [group]), layout="array")
    assert rows(group_headers(df)) == [("G1", "n", "t", "2018", "2019", "X, Y", "x@y", "O, P")]
    assert rows(group_members(df)) == [("G1", "A")]


def test_rule_sections_and_aliases(spark, put):
    rules = {"rule_groups": [
        {"name": "g", "condition": {"attribute_value_match": {"Material": ["cell line", "x"]}},
         "rules": [{"name": "Sample_Description", "mandatory": "optional"}]},
        {"name": "h", "condition": {}, "rules": [{"name": "birth date", "mandatory": "mandatory"}]},
    ]}
    assert rows(r.read_ruleset(spark, put("r.json", rules))) == [
        ("cell line", "description", "optional", 0, 0), ("h", "birthDate", "mandatory", 1, 0),
    ]


FIELD_LIST = """#generated
#column\tsheet\tfile\telement\t\t\t
STRATEGY\tRuns\ta.xsd\ttypeStrategy
#a.xsd\tskipped

MODEL\tRuns\tb.xsd\tmodelOne
MODEL\tRuns\tb.xsd\tmodelTwo
"""


def test_field_list(spark, put):
    assert rows(r.read_field_list(spark, put("f.tsv", FIELD_LIST))) == [
        ("MODEL", "Runs", "b.xsd", "modelOne"), ("MODEL", "Runs", "b.xsd", "modelTwo"),
        ("STRATEGY", "Runs", "a.xsd", "typeStrategy"),
    ]


def test_allowed_values(spark, put):
    text = "# c\n\nX\ts\ta.xsd\ttag\t\tv1\tv2\n\t\ta.xsd\tone\t\tv3\n\t\ta.xsd\tnone\n"
    assert rows(r.read_allowed_values(spark, put("v.tsv", text))) == [
        ("a.xsd", "none", []), ("a.xsd", "one", ["v3"]), ("a.xsd", "tag", ["v1", "v2"]),
    ]


SCHEMA = """<?xml version="1.0"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:simpleType name="typeStrategy">
    <xs:restriction base="xs:string">
      <xs:enumeration value="WGS"/>
      <xs:enumeration value="RNA-Seq"><xs:annotation><xs:documentation>text</xs:documentation></xs:annotation></xs:enumeration>
    </xs:restriction>
  </xs:simpleType>
  <xs:simpleType name="single"><xs:restriction base="xs:string"><xs:enumeration value="only"/></xs:restriction></xs:simpleType>
  <xs:complexType name="LibraryType">
    <xs:sequence>
      <xs:element name="LAYOUT"><xs:complexType><xs:choice>
        <xs:element name="SINGLE"/><xs:element name="PAIRED"/>
      </xs:choice></xs:complexType></xs:element>
      <xs:element name="method"><xs:simpleType><xs:restriction base="xs:string">
        <xs:enumeration value="MD5"/><xs:enumeration value="SHA"/>
      </xs:restriction></xs:simpleType></xs:element>
    </xs:sequence>
    <xs:attribute name="filetype" use="optional">
      <xs:simpleType><xs:restriction base="xs:string"><xs:enumeration value="bam"/><xs:enumeration value="fastq"/></xs:restriction></xs:simpleType>
    </xs:attribute>
    <xs:attribute name="plain" type="xs:string" use="required"/>
  </xs:complexType>
  <xs:complexType name="PlatformType">
    <xs:choice><xs:element name="A"/><xs:element name="B"/></xs:choice>
  </xs:complexType>
</xs:schema>
"""


def test_schema_vocabularies(spark, put):
    df = r.read_schema_vocabularies(spark, put("s.xsd", SCHEMA))
    assert rows(df) == sorted(
        [
            ("s.xsd", "typeStrategy", ["WGS", "RNA-Seq"], None),
            ("s.xsd", "single", ["only"], None),
            ("s.xsd", "LAYOUT", ["SINGLE", "PAIRED"], None),
            ("s.xsd", "method", ["MD5", "SHA"], None),
            ("s.xsd", "filetype", ["bam", "fastq"], "optional"),
            ("s.xsd", "PlatformType", ["A", "B"], None),
        ],
        key=repr,
    )
    status = df.select("tag", r.field_status(F.col("use")).alias("m")).where("m is not null")
    assert rows(status) == [("filetype", "optional")]


NESTED = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:element name="OUTER"><xs:complexType><xs:sequence>
    <xs:element name="MIDDLE"><xs:complexType><xs:sequence><xs:element name="INNER">
      <xs:simpleType><xs:restriction base="xs:string"><xs:enumeration value="003"/><xs:enumeration value='true'/><xs:enumeration value="1.0"/>
      </xs:restriction></xs:simpleType>
    </xs:element></xs:sequence></xs:complexType></xs:element>
    <xs:element name="KIND"><xs:complexType><xs:choice>
      <xs:element name="ONE"/><xs:element name="TWO"><xs:complexType><xs:attribute name="level" use="optional">
        <xs:simpleType><xs:restriction base="xs:string"><xs:enumeration value="a &lt; b"/></xs:restriction></xs:simpleType>
      </xs:attribute></xs:complexType></xs:element>
    </xs:choice></xs:complexType></xs:element>
  </xs:sequence></xs:complexType></xs:element>
  <xs:simpleType name="level"><xs:restriction base="xs:string"><xs:enumeration value="top"/></xs:restriction></xs:simpleType>
  <xs:simpleType name="free"><xs:restriction base="xs:string"/></xs:simpleType>
</xs:schema>
"""


def test_nested_schema_vocabularies(spark, put):
    path = put("n.xsd", NESTED)
    own = [
        ("n.xsd", "INNER", ["003", "true", "1.0"], None),  # as written
        ("n.xsd", "KIND", ["ONE", "TWO"], None),
        ("n.xsd", "level", ["top"], None),  # the outer node of that name
    ]
    assert rows(r.read_schema_vocabularies(spark, path)) == own
    deep = rows(r.read_schema_lists(spark, path).select("owners.name", "allowed"))
    assert (["OUTER", "KIND", "TWO", "level"], ["a < b"]) in deep
    got = dict(rows(r.read_schema_vocabularies(spark, path, inherit=True), "tag", "allowed"))
    assert got["OUTER"] == ["ONE", "TWO"]  # the nearest list inside
    assert got["MIDDLE"] == ["003", "true", "1.0"] and got["TWO"] == ["a < b"]


def test_each_schema_document_is_scanned_once(spark, put, monkeypatch):
    reads = []
    original = r.read_xml_documents
    monkeypatch.setattr(r, "read_xml_documents", lambda *a: reads.append(1) or original(*a))
    found = r.read_schema_vocabularies(spark, put("n.xsd", NESTED))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert reads == [1] and "FileScan text" not in plan and "FileScan xml" not in plan


def test_table(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "a int, b int").write.parquet(str(tmp_path / "t"))
    assert r.read_table(spark, str(tmp_path / "t"), ["b"]).columns == ["b"]
