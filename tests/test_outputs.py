import csv
import glob
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows, values
from metacurate.operators.checkpoints import new_folder, stored, temporary_tables
from metacurate.plans.url_audit import column_values, invalid_urls, url_audit, url_summary, url_values
from metacurate.sinks import writers as w
from metacurate.streaming.ledger import deliver, deliver_stream, delivered_rows, pending_only, read_ledger, read_seed_stream


def lines(path):
    out = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name, encoding="utf-8") as f:
            out += f.read().splitlines()
    return out


def test_manifest_file(spark, tmp_path):
    df = spark.createDataFrame([("R1", 'a "b", c', None, 1)], "accession string, `Project/lab` string, md5sum string, br int")
    w.write_manifest(df.coalesce(1), str(tmp_path / "m"))
    assert list(csv.reader(lines(tmp_path / "m"))) == [
        ["accession", "Project/lab", "md5sum", "br"], ["R1", 'a "b", c', "", "1"],
    ]


def test_coverage_files(spark, tmp_path):
    detail = spark.createDataFrame(
        [
            ("cell line", "optional", "numberOfPassages", 2, 0, 4, 1, 0.25, 3, 0.75),
            ("standard", "optional", "b", 0, 1, 0, 0, None, 0, None),
            ("standard", "optional", "a", 0, 0, 4, 2, 0.5, 2, 0.5),
            ("standard", "recommended", "c", 0, 2, 4, 2, 0.5, 2, 0.5),
            ("unlisted", "optional", "d", 0, 0, 4, 2, 0.5, 2, 0.5),
        ],
        "section string, status string, field string, section_pos int, rule_pos int, total long, count long, "
        "ratio double, present long, present_ratio double",
    )
    averages = spark.createDataFrame(
        [("standard", "optional", 0.5, 0.5), ("overall", "recommended", 0.5, 0.5), ("overall", "optional", 0.4, 0.6)],
        "section string, status string, excluding double, including double",
    )
    w.write_coverage(detail.coalesce(1), averages.coalesce(1), str(tmp_path / "c"))
    assert [x for x in lines(tmp_path / "c" / "detail") if not x.startswith("Section")] == [
        "standard\trecommended\tc\t4\t2\t0.5\t2\t0.5",
        "standard\toptional\ta\t4\t2\t0.5\t2\t0.5",
        "standard\toptional\tb\t0\t0\tNA\t0\tNA",
        "cell line\toptional\tnumber of passages\t4\t1\t0.25\t3\t0.75",
        "unlisted\toptional\td\t4\t2\t0.5\t2\t0.5",  # behind those in the list
    ]
    assert [x for x in lines(tmp_path / "c" / "averages") if not x.startswith("Section")] == [
        "overall\trecommended\t0.5\t0.5", "overall\toptional\t0.4\t0.6", "standard\toptional\t0.5\t0.5",
    ]
    w.write_coverage(detail, averages, str(tmp_path / "o"), sections=["cell line"], statuses=["optional"])
    assert [x.split("\t")[0] for x in lines(tmp_path / "o" / "detail") if not x.startswith("Section")] == [
        "cell line", "standard", "standard", "standard", "unlisted",
    ]
    assert [x.split("\t")[:2] for x in lines(tmp_path / "o" / "averages") if not x.startswith("Section")] == [
        ["overall", "optional"], ["overall", "recommended"], ["standard", "optional"],
    ]


def test_payload_and_candidate_files(spark, tmp_path):
    payloads = spark.createDataFrame([("s", "f", '{"sample":"s"}')], "sample string, field string, payload string")
    w.write_payloads(payloads, str(tmp_path / "p"))
    assert lines(tmp_path / "p") == ['{"sample":"s"}']
    w.write_candidates(spark.createDataFrame([("s", "f")], "sample string, field string"), str(tmp_path / "k"))
    assert lines(tmp_path / "k") == ["s\tf"]


def test_report_file_is_sorted(spark, tmp_path):
    found = spark.createDataFrame(
        [(g, "error", m, m.split(":")[0], m.split(":")[1], p, f"A{p}") for g in ("G2", "G1") for m in ("b:x", "a:y") for p in (1, 0)],
        "group_id string, severity string, msg string, field string, detail string, part bigint, ids string",
    )
    headers = spark.createDataFrame([("G1",), ("G2",), ("G3",)], "group_id string")
    w.write_report(headers, found.repartition(3), [("Group", "group_id")], "group_id", "sample", str(tmp_path / "r"))
    block = [
        "", "List of fields that are in error: a", "Summary of error: y", "Affected sample records: A0", ", A1",
        "", "List of fields that are in error: b", "Summary of error: x", "Affected sample records: A0", ", A1",
    ]
    assert lines(tmp_path / "r") == ["Group: G1", *block, *[""] * 4, "Group: G2", *block, *[""] * 4]


def test_rule_and_vocabulary_files(spark, tmp_path):
    fields = spark.createDataFrame(
        [("STRATEGY", "Runs", "a.xsd", "typeStrategy", ["x", "y"], None), ("T", "Runs", "a.xsd", "t", ["z"], "optional")],
        "column string, sheet string, file string, element string, allowed array<string>, mandatory string",
    )
    w.write_rule_entries(w.ruleset_fields(fields).coalesce(1), str(tmp_path / "j"))
    assert [json.loads(x) for x in lines(tmp_path / "j")] == [
        {"name": "STRATEGY", "expected_sheet": "Runs", "type": "text", "valid_values": ["x", "y"]},
        {"name": "T", "expected_sheet": "Runs", "type": "text", "valid_values": ["z"], "mandatory": "optional"},
    ]
    w.write_vocabulary(fields.coalesce(1), str(tmp_path / "v"))
    assert lines(tmp_path / "v") == ["STRATEGY\tRuns\ttypeStrategy\t\tx\ty", "T\tRuns\tt\t\tz"]
    assert values(w.vocabulary_text(fields, with_file=True))[1] == "T\tRuns\ta.xsd\tt\t\tz"


def test_ledger_delivers_each_seed_once(spark, tmp_path):
    ledger, out = str(tmp_path / "ledger"), tmp_path / "out"
    seeds = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    batches = []

    def write(pending):
        path = str(out / str(len(batches)))
        batches.append(path)
        pending.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    assert rows(deliver(spark, seeds, "id", ledger, write)) == [("a", 1), ("b", 2)]
    assert rows(deliver(spark, seeds, "id", ledger, write)) == []
    more = seeds.unionByName(spark.createDataFrame([("c", 3)], "id string, v int"))
    assert rows(deliver(spark, more, "id", ledger, write)) == [("c", 3)]
    assert rows(read_ledger(spark, ledger), "seed_id") == [("a",), ("b",), ("c",)]


def test_a_failed_delivery_leaves_the_seeds_pending(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    seeds = spark.createDataFrame([("a",)], "id string")

    def fail(pending):
        raise OSError("disk full")

    with pytest.raises(OSError):
        deliver(spark, seeds, "id", ledger, fail)
    assert rows(pending_only(seeds, read_ledger(spark, ledger), "id")) == [("a",)]


@pytest.fixture
def stream(spark, tmp_path):
    schema, seeds, out, state = "id string, v int", tmp_path / "seeds", str(tmp_path / "out"), str(tmp_path / "state")

    def arrive(*rows_):
        spark.createDataFrame(list(rows_), schema).coalesce(1).write.mode("append").parquet(str(seeds))

    def run():
        return delivered_rows(deliver_stream(read_seed_stream(spark, str(seeds), schema), "id", out, state))

    return arrive, run, lambda: rows(spark.read.parquet(out)), tmp_path / "state"


def test_a_stream_delivers_each_key_once(stream):
    arrive, run, delivered, _ = stream
    arrive(("a", 1), ("b", 2), (None, 9))
    assert run() == 2
    assert run() == 0  # nothing new
    arrive(("b", 3), ("c", 4), ("c", 4))
    arrive(("a", 5), ("d", 6))
    assert run() == 2
    assert delivered() == [("a", 1), ("b", 2), ("c", 4), ("d", 6)]


def test_a_repeated_batch_delivers_nothing_twice(stream):
    arrive, run, delivered, state = stream
    arrive(("a", 1))
    run()
    arrive(("b", 2))
    run()
    before = delivered()
    last = max((state / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()  # as if the run had stopped before it noted the batch
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run()
    assert delivered() == before == [("a", 1), ("b", 2)]
    arrive(("b", 3), ("c", 3))
    run()
    assert delivered() == [("a", 1), ("b", 2), ("c", 3)]


DOCS = [
    {"id": "1", "standardMet": "core", "a b": {"x-y": {"url": "http://ok.com"}}, "p": "nope"},
    {"id": "2", "standardMet": "core", "a b": {"x-y": {"url": "not a url"}}, "p": 5},
    {"id": "3", "standardMet": "core", "a b": {}, "p": ""},
    {"id": "4", "standardMet": "core", "p": ["http://ok.com"]},
    {"id": "5", "standardMet": "other", "p": "nope"},
    {"id": "6", "standardMet": "core", "p": None},
    {"id": "7", "standardMet": "core", "p": 0, "a b": {"x-y": {"url": False}}},
    {"id": "8", "standardMet": "core", "p": [], "a b": {"x-y": {"url": {}}}},
    {"p": "no id or standard"},
]


@pytest.fixture
def url_docs(spark):
    return spark.createDataFrame([(json.dumps(d),) for d in DOCS], "j string").select(F.parse_json("j").alias("doc"))


def test_url_audit(url_docs):
    got = rows(url_audit({"k": url_docs}, {"k": "id"}, "core", {"k": ["a b.x-y.url", "p", "p"]}))
    assert got == [
        ("k", "1", "p", "nope", "invalid_url"),
        ("k", "2", "a b.x-y.url", "not a url", "invalid_url"),
        ("k", "2", "p", "5", "not_a_string"),
        ("k", "4", "p", '["http://ok.com"]', "not_a_string"),
    ]


def test_url_summary(url_docs):
    summary = url_summary(url_values(url_docs, "k", "id", ["a b.x-y.url", "p"], "core"))
    assert rows(summary) == [("k", "a b.x-y.url", 2, 1), ("k", "p", 3, 3)]


def test_url_columns(spark):
    df = spark.createDataFrame([(1, "http://ok.com", None), (2, "", "bad")], "id int, a string, b string")
    assert rows(invalid_urls(column_values(df, "k", "id", ["a", "b"]))) == [("k", "2", "b", "bad", "invalid_url")]


def test_stored_tables_give_python_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    def longest():
        texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))
        got = stored(texts.mapInArrow(sizes, "n bigint, bytes bigint")).collect()
        assert sum(r["n"] for r in got) == 4000
        return max(r["bytes"] for r in got)

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    unset = spark.conf.get(key)
    assert longest() < 3e6  # 16 MB in one batch by Spark's default
    assert spark.conf.get(key) == unset
    spark.conf.set(key, "8m")  # a setting of the session's own counts
    try:
        assert 4e6 < longest() < 9e6
        assert spark.conf.get(key) == "8m"
    finally:
        spark.conf.unset(key)


def test_stored_results_cut_the_plan(spark):
    df = stored(spark.range(10).where("id > 5"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and rows(df) == [(6,), (7,), (8,), (9,)]


def test_tables_of_a_block_are_deleted_at_its_end(spark):
    kept, outside = new_folder(spark, "kept"), stored(spark.range(3))
    with temporary_tables(spark):
        inner = stored(spark.range(10).where("id > 5"), "inner")
        folder = inner.inputFiles()[0].rsplit("/", 1)[0]
        inner.write.parquet(kept)
    with temporary_tables(spark) as made:
        stored(spark.range(5))
        result = stored(spark.range(4), "result")
        made.pop()
    assert result.count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)
    assert rows(spark.read.parquet(kept)) == [(6,), (7,), (8,), (9,)]
    assert outside.count() == 3
    with pytest.raises(ZeroDivisionError), temporary_tables(spark):
        folder = stored(spark.range(1)).inputFiles()[0].rsplit("/", 1)[0]
        1 / 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)
