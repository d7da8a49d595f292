import pytest
from pyspark.sql import functions as F

from conftest import rows, values
from metacurate.plans import reports as rp
from metacurate.sinks.writers import report_lines

LOG = [
    ("A", "organism", "error",
     "(ERROR)size:too big (max 5) a:b;(WARNING)colour:odd;(error)id_number:attribute not in rule set;"),
    ("A", "organism", "error", "(ERROR)size:too big (max 9);(ERROR)Birth Date 1/2/2018 is odd;"
                               "(ERROR)Birth Date 3/4/2019 is odd"),
    ("B", "specimen", "warning", "(WARNING)colour:odd;(ERROR)hidden:by overall"),
    ("C", "specimen", "error", "(ERROR)gestational age at sample collection:no text provided;"
                               "(WARNING)weight:This field is optional, so if not providing x;;"),
    ("C", "specimen", "error", "(ERROR)gestational age at sample collection:no text provided"),
    ("D", "specimen", "error", "(ERROR)height:This field is optional, so if not providing 1/1/2011 x;(INFO)x:y;bare"),
]


@pytest.fixture
def log(spark):
    return spark.createDataFrame(LOG, "id string, type string, overall string, detail string")


def test_messages(log):
    assert rows(rp.message_parts(rp.log_messages(log))) == [
        ("A", "error", "Birth Date is odd", "Birth Date is odd", ""),
        ("A", "error", "size:too big (max 5", "size", "too big (max 5"),
        ("A", "error", "size:too big (max 9", "size", "too big (max 9"),
        ("C", "error", "gestational age at sample collection:no text provided",
         "gestational age at sample collection", "no text provided"),
        ("D", "error", "height:This field is optional, so if not providing 1/1/2011 x", "height",
         "This field is optional, so if not providing 1/1/2011 x"),
    ]


def test_messages_with_warnings(log):
    got = rows(rp.log_messages(log, include_warnings=True).where("severity = 'warning' or id = 'B'"))
    assert got == [
        ("A", "warning", "colour:odd"),
        ("B", "error", "hidden:by overall"),
        ("B", "warning", "colour:odd"),
        ("C", "warning", "weight:This field is optional, so if not providing x"),
    ]


def test_last_severity_of_a_line_wins(spark):
    line = "(ERROR)f:x;(WARNING)f:x;(WARNING)g:y;(ERROR)g:y;(ERROR)h:z;(INFO)h:z"
    log = spark.createDataFrame([("A", "t", "error", line)], "id string, type string, overall string, detail string")
    assert rows(rp.log_messages(log, include_warnings=True)) == [("A", "error", "g:y"), ("A", "warning", "f:x")]
    # warnings are left out before repeats are resolved
    assert rows(rp.log_messages(log)) == [("A", "error", "f:x"), ("A", "error", "g:y")]


def test_full_messages(log):
    got = rows(rp.message_parts(rp.log_messages(log, full_message=True), True).where("id = 'A' and field = 'size'"))
    assert got == [
        ("A", "error", "size:too big (max 5) a:b", "size", "too big (max 5) a:b"),
        ("A", "error", "size:too big (max 9)", "size", "too big (max 9)"),
    ]


def test_candidates(log):
    assert rows(rp.curation_candidates(log)) == [("C", "gestational age at sample collection"), ("D", "height")]
    assert rows(rp.curation_candidates(log, include_warnings=True)) == [
        ("C", "gestational age at sample collection"), ("C", "weight"), ("D", "height"),
    ]


@pytest.fixture
def groups(spark):
    members = spark.createDataFrame(
        [("G1", "A"), ("G1", "A"), ("G1", "C"), ("G2", "C"), ("G2", "B"), ("G3", "B")], "group_id string, id string"
    )
    headers = spark.createDataFrame([("G1", "one"), ("G2", "two"), ("G3", "three")], "group_id string, name string")
    return members, headers


AGE = "gestational age at sample collection"


def test_group_report(log, groups):
    report = rp.group_error_report(log, *groups)
    assert rows(report, "group_id", "name", "field", "n", "part", "ids") == sorted(
        [
            ("G1", "one", "Birth Date is odd", 1, 0, "A"),
            ("G1", "one", "size", 1, 0, "A"),
            ("G1", "one", "size", 1, 0, "A"),
            ("G1", "one", AGE, 1, 0, "C"),
            ("G2", "two", AGE, 1, 0, "C"),
        ],
        key=repr,
    )


def test_group_report_with_every_group_and_ungrouped_records(log, groups):
    every = rp.group_error_report(log, *groups, include_all=True)
    assert ("G3", "three", None) in rows(every, "group_id", "name", "msg")
    loose = rp.group_error_report(log, *groups, include_ungrouped=True)
    assert [r[1] for r in rows(loose.where("group_id is null"), "name", "ids")] == ["D"]
    both = rp.group_error_report(log, *groups, include_all=True, include_ungrouped=True)
    assert both.count() == 5 + 1 + 1


def test_ids_are_sorted_and_split(spark):
    log = spark.range(50).select(
        F.format_string("i%02d", 49 - F.col("id")).alias("id"), F.lit("t").alias("type"),
        F.lit("error").alias("overall"), F.lit("(ERROR)f:x").alias("detail"),
    )
    members = log.select(F.lit("G").alias("group_id"), "id")
    headers = spark.createDataFrame([("G", "g")], "group_id string, name string")
    (row,) = rp.group_error_report(log, members, headers).collect()
    assert row["n"] == 50 and row["ids"] == ", ".join(f"i{i:02d}" for i in range(50))
    parts = rp.group_error_report(log, members, headers, per_row=10).collect()
    assert len(parts) == 5 and {p["n"] for p in parts} == {50}
    parts.sort(key=lambda p: p["part"])
    assert [i for p in parts for i in p["ids"].split(", ")] == [f"i{i:02d}" for i in range(50)]


def page(headers, lines, **options):
    found = report_lines(headers, lines, [("Group id", "group_id"), ("Title", "name")], "group_id", "sample", **options)
    return values(found.orderBy("group_id", "section", "severity", "msg", "part").select("value"))


def test_report_lines(log, groups):
    members, headers = groups
    lines = rp.group_error_lines(log, members)
    assert "\n".join(page(headers.where("group_id = 'G2'"), lines)).split("\n") == [
        "Group id: G2", "Title: two", "", f"List of fields that are in error: {AGE}",
        "Summary of error: no text provided", "Affected sample records: C", "", "", "", "",
    ]
    heads = [v for v in page(headers, lines) if v.startswith("Group id")]
    assert [h.split("\n")[0] for h in heads] == ["Group id: G1", "Group id: G2"]  # once, however many messages
    every = [v.split("\n")[0] for v in page(headers, lines, include_all=True) if v.startswith("Group id")]
    assert every == ["Group id: G1", "Group id: G2", "Group id: G3"]
    loose = page(headers, rp.group_error_lines(log, members, include_ungrouped=True))
    assert loose[0].endswith("records: D")  # no group, no header


def test_a_long_list_of_ids_is_continued(spark):
    headers = spark.createDataFrame([("G", None)], "group_id string, name string")
    rows_ = [("G", "error", "f:x", f"i{i}") for i in range(5)]
    lines = rp.error_lines(spark.createDataFrame(rows_, "group_id string, severity string, msg string, id string"), "group_id", per_row=2)
    text = page(headers, lines)
    assert text[0] == "Group id: G"  # no line for a header that is NULL
    assert "".join(text[1:4]).split("\n")[-1] == "Affected sample records: i0, i1, i2, i3, i4"
    assert text[2:4] == [", i2, i3", ", i4"]


@pytest.fixture
def datasets(spark):
    return spark.createDataFrame(
        [
            ("D1", "core", "S1", "t1", [("cow",)], ["i"], ["c"], [("E1",)]),
            ("D2", None, "S2", "t2", [("cow",), ("hen",)], ["i", "j"], None, [("E2",), ("E3",)]),
            ("D3", "legacy", "S3", "t3", [], [], [], [("E9",)]),
        ],
        "id string, standardMet string, secondaryAccession string, title string, species array<struct<text:string>>, "
        "instrument array<string>, centerName array<string>, experiment array<struct<accession:string>>",
    )


@pytest.fixture
def experiment_log(spark):
    return spark.createDataFrame(
        [("E1", "D1", "error", "(ERROR)a:b"), ("E2", "D2", "error", "(ERROR)a:Date 1/1/2018 x"),
         ("E3", "D2", "error", "(ERROR)a:Date 1/1/2018 x;(WARNING)c:d"), ("E4", "D4", "error", "(ERROR)e:f"),
         ("E5", "D5", "pass", "")],
        "id string, dataset string, overall string, detail string",
    )


def test_dataset_report(datasets, experiment_log):
    headers = rp.dataset_headers(rp.unmet(datasets, "core"))
    report = rp.dataset_error_report(experiment_log, rp.dataset_experiments(datasets), headers)
    assert rows(report, "dataset", "animals", "instruments", "field", "detail", "n", "ids") == [
        # dates stay in experiment messages
        ("D2", "cow, hen", "i, j", "a", "Date 1/1/2018 x", 2, "E2, E3"),
    ]
    every = rp.dataset_error_report(
        experiment_log, rp.dataset_experiments(datasets), headers, include_all=True
    )
    assert rows(every, "dataset", "ids") == sorted([("D2", "E2, E3"), ("D3", None)], key=repr)


def test_not_imported(datasets, experiment_log):
    known = datasets.select(F.col("id").alias("dataset"), "standardMet")
    assert rows(rp.not_imported(experiment_log, known, "dataset")) == [("D4",), ("D5",)]
    # in the literal mode a dataset that met the standard is listed as well
    met = F.col("standardMet") == "core"
    assert rows(rp.not_imported(experiment_log, known, "dataset", met=met)) == [("D1",), ("D4",), ("D5",)]
    assert rows(rp.not_imported_errors(experiment_log, known), "dataset", "field", "ids") == [("D4", "e", "E4")]
