import pytest
from pyspark.sql import functions as F

from conftest import rows, values
from metacurate.operators import conditions as c
from metacurate.sinks import writers as w
from metacurate.operators.entities import pivot_fields, unpivot_columns
from metacurate.presets import SAMPLE_FIELDS

ATTRIBUTES = "array<struct<name:string,value:string,term_source_id:string>>"


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(
        [(1, "public", 9913), (2, "private", 9913), (3, None, 9031), (4, "", None), (5, "public", 9031)],
        "id int, status string, taxon int",
    )


def ids(df):
    return sorted(values(df.select("id")))


def test_require_columns(runs):
    assert ids(c.require_columns(runs, {"status": ["public"]})) == [1, 5]
    assert ids(c.require_columns(runs, {"status": "public", "taxon": ["9031"]})) == [5]
    assert ids(c.require_columns(runs, {"status": ["", "private"]})) == [2, 3, 4]
    assert ids(c.require_columns(runs, {"taxon": [9913, "x", "09031"]})) == [1, 2]
    assert ids(c.require_columns(runs, {})) == [1, 2, 3, 4, 5]


def test_exclude_columns(runs):
    assert ids(c.exclude_columns(runs, {"status": ["public"]})) == [2, 3, 4]
    assert ids(c.exclude_columns(runs, {"status": ["", "private"]})) == [1, 5]
    assert ids(c.exclude_columns(runs, {"status": "public", "taxon": 9913})) == [3, 4]


@pytest.mark.parametrize("condition", [{"status": ["public", ""]}, {"taxon": [9913]}, {"status": ["private"]}])
def test_require_and_exclude_partition_the_input(runs, condition):
    kept, dropped = ids(c.require_columns(runs, condition)), ids(c.exclude_columns(runs, condition))
    assert sorted(kept + dropped) == ids(runs)


def test_conditions_reach_the_scan(spark, tmp_path, runs):
    runs.write.parquet(str(tmp_path / "runs"))
    stored = spark.read.parquet(str(tmp_path / "runs"))
    kept = c.exclude_columns(c.require_columns(stored, {"taxon": [9913]}), {"status": ["private"]}).select("id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "taxon" in pushed and "status" in pushed


def test_unknown_columns_are_errors(runs):
    for call in (
        lambda: c.require_columns(runs, {"nope": ["x"]}),
        lambda: c.exclude_columns(runs, {"nope": ["x"]}),
        lambda: c.output_columns(runs, ["id", "nope"]),
    ):
        with pytest.raises(ValueError, match="nope"):
            call()


@pytest.fixture
def attributes(spark):
    return spark.createDataFrame(
        [
            (1, 0, "Assay", "ChIP"),
            (1, 1, "assay", "RNA"),
            (2, 0, "assay", None),
            (2, 1, "note", "x"),
            (3, 0, "other", "ChIP"),
            (5, 0, "assay", "RNA"),
        ],
        "id int, pos int, name string, value string",
    )


def test_attribute_conditions_use_the_first_occurrence_in_any_case(runs, attributes):
    base = runs.select("id")
    assert ids(c.attribute_conditions(base, attributes, "id", require={"ASSAY": ["ChIP"]})) == [1]
    # absent passes, a missing value counts as empty
    assert ids(c.attribute_conditions(base, attributes, "id", exclude={"assay": ["RNA"]})) == [1, 2, 3, 4]
    assert ids(c.attribute_conditions(base, attributes, "id", exclude={"assay": [""]})) == [1, 3, 4, 5]
    assert ids(c.attribute_conditions(base, attributes, "id", require={"assay": [""]})) == [2]


def test_attribute_output(runs, attributes):
    out = c.attribute_conditions(runs.select("id"), attributes, "id", output=["assay", "note"])
    assert rows(out) == sorted(
        [(1, "ChIP", None), (2, None, "x"), (3, None, None), (4, None, None), (5, "RNA", None)], key=repr
    )
    both = c.attribute_conditions(
        runs.select("id"), attributes, "id", require={"Assay": ["RNA"]}, output=["assay"]
    )
    assert rows(both) == [(5, "RNA")]


@pytest.fixture
def entities(spark):
    return spark.createDataFrame(
        [
            ("A", [("Organism", "cow", "9913"), ("organism", "bull", None), ("Sex", "f", "P_1")]),
            ("B", [("Organism", "hen", "9031")]),
            ("C", [("Sex", "m", None)]),
            ("D", None),
        ],
        f"id string, attributes {ATTRIBUTES}",
    )


def test_multi_value_conditions(entities):
    attrs = F.col("attributes")

    def kept(require=None, exclude=None):
        return sorted(values(entities.where(c.multi_value_conditions(attrs, require, exclude)).select("id")))

    assert kept({"organism": [{"term_source_id": 9913}]}) == ["A"]
    assert kept({"Organism": [{"value": "bull"}, {"term_source_id": "9031"}]}) == ["A", "B"]
    assert kept({"organism": [{"value": "hen"}], "sex": [{"value": "f"}]}) == []
    assert kept(exclude={"organism": [{"value": "bull"}]}) == ["B", "C", "D"]
    assert kept({"organism": []}) == []
    assert kept() == ["A", "B", "C", "D"]


def test_multi_value_filter_agrees_with_the_array_form(entities):
    instances = entities.select("id", F.inline("attributes"))
    for require, exclude in [
        ({"organism": [{"term_source_id": 9913}]}, None),
        (None, {"organism": [{"value": "bull"}, {"value": "hen"}]}),
        ({"sex": [{"value": "f"}, {"value": "m"}]}, {"organism": [{"value": "cow"}]}),
    ]:
        long = c.multi_value_filter(entities.select("id"), instances, "id", require, exclude)
        array = entities.where(c.multi_value_conditions(F.col("attributes"), require, exclude)).select("id")
        assert rows(long) == rows(array)


def test_output_instances(entities):
    out = entities.select("id", c.output_instances(F.col("attributes"), ["ORGANISM"]).alias("o"))
    got = {r["id"]: [x["value"] for x in r["o"]] if r["o"] is not None else None for r in out.collect()}
    assert got == {"A": ["cow", "bull"], "B": ["hen"], "C": [], "D": None}


def test_gates(spark):
    df = spark.createDataFrame([("error",), ("pass",), ("",), (None,)], "s string")
    assert values(df.select(c.strict_gate(F.col("s")))) == [False, True, True, False]
    assert values(df.select(c.lenient_gate(F.col("s")))) == [False, True, True, True]


def test_entity_status(spark):
    df = spark.createDataFrame(
        [
            ([("x", "y", None), ("metadata Validation status", "error", None), ("Metadata validation status", "pass", None)],),
            ([("Metadata validation status", None, None)],),
            ([],),
            (None,),
        ],
        f"a {ATTRIBUTES}",
    )
    assert values(df.select(c.entity_status(F.col("a")))) == ["error", "", None, None]


def test_pivot_fields_joins_names_that_differ_in_case(spark):
    fields = spark.createDataFrame(
        [(1, 0, "Sex", "f"), (1, 1, "Derived from", "P1"), (2, 0, "derived from", "P2"), (2, 1, "Derived from", "P3"),
         (3, 0, "unlisted", "x")],
        "id int, pos int, name string, value string",
    )
    wide = pivot_fields(fields, "id")
    assert len(SAMPLE_FIELDS) == 47 and len(wide.columns) == 1 + 46
    assert rows(wide, "id", "Sex", "derived from") == sorted([(1, "f", "P1"), (2, None, "P2")], key=repr)


def test_unpivot_skips_missing_values(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 5)], "id int, x string, y int")
    assert rows(unpivot_columns(df, "id", ["x", "y"])) == [(1, 0, "x", "a"), (2, 1, "y", "5")]


def scanned(df):
    """Rows that the file scan gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_written_attribute_table_is_pruned_by_name(spark, tmp_path):
    names = F.concat(F.lit("Name "), (F.col("id") % 50).cast("string"))
    many = spark.range(20_000).select(
        (F.col("id") / 50).cast("bigint").alias("entity_id"), F.lit(0).alias("pos"), names.alias("name"), F.col("id").cast("string").alias("value")
    )
    spark.conf.set("parquet.block.size", 20_000)
    try:
        w.write_attributes(many, str(tmp_path / "a"))
    finally:
        spark.conf.unset("parquet.block.size")
    table = spark.read.parquet(str(tmp_path / "a"))
    wanted = table.where(c.folded_name(table) == "name 7").select("entity_id", "value")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(name_key,name 7)" in plan
    assert wanted.count() == 400
    assert 400 <= scanned(wanted) < 10_000
    entities = spark.range(400).select(F.col("id").alias("entity_id"))
    options = dict(require={"NAME 7": ["7", "57"]}, output=["name 8"])
    plain = c.attribute_conditions(entities, many, "entity_id", **options)
    assert rows(c.attribute_conditions(entities, table, "entity_id", **options)) == rows(plain) == [(0, "8"), (1, "58")]
