"""Array files read by byte ranges against a plain JSON parser."""

import json
import random

import pytest

from conftest import rows
from metacurate.sources import readers as r
from metacurate.sources.arrays import read_array_elements

TEXTS = ["", "}", "{", "}{", "[", "],[", '"', '\\', '\\"}', "a}b{c", "é\u2028", "\n", "plain", "\\\\", "},{"]


def element(rnd, depth=0):
    out = {}
    for _ in range(rnd.randint(0, 4)):
        kind = rnd.randint(0, 5 if depth < 3 else 2)
        value = rnd.choice(TEXTS) if kind < 2 else rnd.randint(0, 99) if kind == 2 else element(rnd, depth + 1)
        out[rnd.choice(TEXTS) + str(len(out))] = [value, element(rnd, depth + 1), []] if kind == 5 else value
    return out


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent", [None, 2])
def test_elements(spark, tmp_path, small_ranges, indent):
    rnd = random.Random(indent)
    files = {f"{i}.json": [element(rnd) for _ in range(rnd.randint(0, 25))] for i in range(4)}
    files["empty.json"] = []
    files["long.json"] = [{"a": "}{" * 200}, {}, {"b": [{"c": "x" * 300}]}]
    folder = tmp_path / "arrays"
    folder.mkdir()
    for name, content in files.items():
        (folder / name).write_text(json.dumps(content, indent=indent, ensure_ascii=indent is None), encoding="utf-8")
    got = {}
    for row in read_array_elements(spark, str(folder)).collect():
        got.setdefault(row["file"].rsplit("/", 1)[1], []).append(json.dumps(json.loads(row["element"])))
    expected = {n: sorted(json.dumps(e) for e in c) for n, c in files.items() if c}
    assert {n: sorted(e) for n, e in got.items()} == expected
    assert spark.read.option("lineSep", "}").text(str(folder)).rdd.getNumPartitions() > 20


def test_a_file_that_is_no_array(spark, put, small_ranges):
    for text in ('{"a": 1}', '{"a": {"b": 1}, "c": {}}'):
        with pytest.raises(Exception, match="not an array"):
            read_array_elements(spark, put("o.json", text)).collect()


def test_layouts_agree(spark, put, small_ranges):
    entities = [{"id": f"E{i}", "attributes": [{"name": "n}", "value": f"{{{i}"}]} for i in range(30)]
    path = put("e.json", entities)
    assert rows(r.read_entities(spark, path, layout="split")) == rows(r.read_entities(spark, path))
    hits = [{"_id": str(i), "_source": {"x y": {"z": i}}} for i in range(20)]
    found = r.read_hits(spark, put("h.json", hits), layout="split").selectExpr("_id", "to_json(doc) AS doc")
    assert rows(found) == sorted((h["_id"], json.dumps(h["_source"], separators=(",", ":"))) for h in hits)
    samples = [{"accession": f"S{i}", "characteristics": {"a": [{"text": "]"}]}, "relationships": []} for i in range(9)]
    assert r.read_sample_pages(spark, put("s.json", samples), layout="split").count() == 9
    with pytest.raises(Exception):
        r.read_entities(spark, put("b.json", '[{"id": 1}, {"id": nonsense}]'), layout="split").collect()
