import json

from pyspark.sql import functions as F

from conftest import values
from metacurate.functions import messages as m
from metacurate.functions import urls
from metacurate.functions import values as v

SHAPES = [
    # document field, text, meaningful, present
    ({"text": "a"}, "a", True, True),
    ({"text": "", "ontologyTerms": ["t"]}, "", False, True),
    ({"text": None, "ontologyTerms": ["t"]}, None, False, True),
    ({"ontologyTerms": "t"}, "t", True, True),
    ({"other": 1}, None, False, True),
    ({}, None, False, False),
    (["", "not provided", "x"], "not provided", False, True),
    (["", {"text": "b"}], "b", True, True),
    ([{"text": ""}, "restricted access"], "restricted access", False, True),
    ([], None, False, False),
    ([None], None, False, False),
    ("not collected", "not collected", False, True),
    ("x", "x", True, True),
    ("", "", False, True),
    (0, "0", True, True),
    (False, "false", True, True),
    (None, None, False, False),
]


def test_polymorphic_values(spark):
    docs = spark.createDataFrame(
        [(i, json.dumps(shape)) for i, (shape, *_) in enumerate(SHAPES)], "i int, j string"
    ).select("i", F.parse_json("j").alias("v"))
    text = v.meaningful_text(F.col("v"))
    got = docs.select("i", text, v.is_meaningful(text), v.is_present(F.col("v"))).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [s[1:] for s in SHAPES]


def test_nested_path_with_blanks_and_hyphens(spark):
    doc = {"ChiP-seq histone": {"chip Protocol": {"url": "u"}}, "list": [1], "n": 5}
    df = spark.range(1).select(F.parse_json(F.lit(json.dumps(doc))).alias("d"))
    paths = ["ChiP-seq histone.chip Protocol.url", "ChiP-seq histone.absent.url", "n", "n.deeper"]
    row = df.select(*[v.at_path(F.col("d"), p) for p in paths]).first()
    assert tuple(row) == ("u", None, "5", None)


def test_truthy(spark):
    df = spark.createDataFrame([("a",), ("",), ("0",), ("00",), (None,)], "s string")
    assert values(df.select(v.truthy(F.col("s")))) == [True, False, False, True, False]


def test_merge_takes_the_last_of_each_part(spark):
    kind = "array<struct<text:string,ontologyTerms:array<string>,unit:string>>"
    df = spark.createDataFrame(
        [
            ([("a", ["t1"], None), ("b", None, "kg"), (None, ["t2", "t3"], None)],),
            ([("a", None, None)],),
            ([],),
        ],
        f"i {kind}",
    )
    got = [r[0].asDict() for r in df.select(v.merged_value(F.col("i"))).collect()]
    assert got == [
        {"text": "b", "iri": ["t2", "t3"], "unit": "kg"},
        {"text": "a", "iri": None, "unit": None},
        {"text": None, "iri": None, "unit": None},
    ]


def test_joined_text(spark):
    df = spark.createDataFrame([([("a",), ("b",)], ["x", "y"])], "s array<struct<text:string>>, p array<string>")
    assert tuple(df.select(v.joined_text(F.col("s"), "text"), v.joined_text(F.col("p"))).first()) == ("a, b", "x, y")


def test_urls(spark):
    cases = {
        "http://example.com": True,
        "https://www.example.com/a?b=c&d=e#f": True,
        "example.com": True,
        "a@b.com": True,
        "ftp://ab.org": True,
        "ftp://x.org": False,
        "HTTP://example.com": False,
        "localhost": False,
        "http://exa mple.com": False,
        "http://example.com/a b": False,
        "http://example.com\n": True,
        "http://example.com\r\n": False,
        "http://example.com\u0085": False,
        "": False,
    }
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = {r[0]: r[1] for r in df.select("s", urls.is_url(F.col("s"))).collect()}
    assert got == cases


def test_message_parts(spark):
    detail = "(ERROR)size:too big (max 5) now: really;;(Warning)Birth Date 1/12/2018 is odd;bare;"
    df = spark.createDataFrame([(detail,)], "d string").select(F.explode(m.split_messages(F.col("d"))).alias("e"))
    e = F.col("e")
    got = df.select(m.message_severity(e), m.message_text(e), m.message_text(e, full_message=True)).collect()
    assert [tuple(r) for r in got] == [
        ("error", "size:too big (max 5", "size:too big (max 5) now: really"),
        ("warning", "Birth Date 1/12/2018 is odd", "Birth Date 1/12/2018 is odd"),
        ("are", "", ""),
    ]


def test_message_field_and_detail(spark):
    df = spark.createDataFrame([("a:b:c",), ("a",), ("",)], "s string")
    s = F.col("s")
    got = df.select(m.message_field(s), m.message_detail(s), m.message_detail(s, full_message=True)).collect()
    assert [tuple(r) for r in got] == [("a", "b", "b:c"), ("a", "", ""), ("", "", "")]


def test_strip_date(spark):
    df = spark.createDataFrame(
        [("x:Birth Date 1/12/2018 is odd",), ("Date 1/1/18 odd",), ("x Date 1/1/18",), ("no date",)], "s string"
    )
    assert values(df.select(m.strip_date(F.col("s")))) == [
        "x:Birth Date is odd",
        "Date 1/1/18 odd",  # something has to precede the word
        "x Date 1/1/18",  # and something has to follow the date
        "no date",
    ]
