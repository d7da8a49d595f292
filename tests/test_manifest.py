import pytest
from pyspark.sql import functions as F

from conftest import rows
from metacurate.operators.entities import unpivot_columns  # noqa: F401
from metacurate.plans.manifest import (
    Conditions,
    EntityConditions,
    Selection,
    first_files,
    ontology_terms,
    manifest_cells,
    registration_manifest,
    select_runs,
)
from metacurate.presets import MANIFEST_COLUMNS

STATUS = "Metadata validation status"
ENTITY = "id string, attributes array<struct<name:string,value:string,term_source_id:string>>"


@pytest.fixture
def tables(spark):
    def make(rows_, schema):
        return spark.createDataFrame(rows_, schema)

    files = [("f2", "md5b"), ("f1", "md5a")]
    return dict(
        collections=make(
            [(f"R{i}", "FASTQ", "file", files) for i in range(1, 9)]
            + [("R1x", "BAM", "file", files), ("R2x", "FASTQ", "other", files)],
            "name string, type string, table_name string, files array<struct<name:string,md5:string>>",
        ),
        runs=make(
            [(i, f"R{i}", 100 + i, "public", "c", None) for i in range(1, 8)] + [(8, "R8", 108, None, "c", None)],
            "run_id long, run_source_id string, experiment_id long, status string, center_name string, "
            "run_center_name string",
        ),
        experiments=make(
            [
                (101, "X1", 11, 21, "public", "ChIP-Seq", "PAIRED", "ILLUMINA", "H3K4me3"),
                (102, "X2", 11, 21, "public", "ChIP-Seq", "PAIRED", "ILLUMINA", "input DNA"),
                (103, "X3", 12, 21, "public", "ChIP-Seq", "PAIRED", "ILLUMINA", "CTCF"),
                (104, "X4", 13, 21, "public", "ChIP-Seq", "PAIRED", "ILLUMINA", "CTCF"),  # sample in error
                (105, "X5", 11, 21, "public", "ChIP-Seq", "PAIRED", "ILLUMINA", "CTCF"),  # experiment in error
                (106, "X6", 11, 21, "public", "ChIP-Seq", "PAIRED", "ILLUMINA", "CTCF"),  # unknown experiment
                (107, "X7", 14, 21, "public", "ChIP-Seq", "PAIRED", "ILLUMINA", "CTCF"),  # unknown sample
                (108, "X8", 11, 21, "public", "ChIP-Seq", "PAIRED", "ILLUMINA", "CTCF"),  # run not public
            ],
            "experiment_id long, experiment_source_id string, sample_id long, study_id long, status string, "
            "library_strategy string, library_layout string, instrument_platform string, experiment_type string",
        ),
        samples=make(
            [(11, "s11", "B11", "public"), (12, "s12", "B12", "public"), (13, "s13", "B13", "public"),
             (14, "s14", "B14", "public")],
            "sample_id long, sample_source_id string, biosample_id string, status string",
        ),
        studies=make([(21, "ST21", "public")], "study_id long, study_source_id string, status string"),
        entities=make(
            [
                ("B11", [("Sample Name", "n11", None), ("Organism", "cow", "NCBI_9913"), ("Sex", "f", "PATO_0_1"),
                         ("breed", "b", None), ("cell type", "x", "CL_1"), ("Cell Type", "y", "CL_2"),
                         ("secret", "z", "S_1"), (STATUS, "warning", None)]),
                ("B12", [("Organism", "hen", "NCBI_9031")]),  # no status: passes
                ("B13", [(STATUS, "error", None)]),
            ],
            ENTITY,
        ),
        experiment_entities=make(
            [("X1", [(STATUS, "pass", None)]), ("X2", [(STATUS, "pass", None)]), ("X3", [(STATUS, "warning", None)]),
             ("X4", [(STATUS, "pass", None)]), ("X5", [(STATUS, "error", None)]), ("X7", [(STATUS, "pass", None)]),
             ("X8", [(STATUS, "pass", None)]), ("X9", [])],
            ENTITY,
        ),
        lookups=make([(0, "R1", "MANUAL"), (1, "R1", "AUTO"), (1, "R2", "AUTO"), (0, "R3", "0")],
                     "priority int, key string, value string"),
        attributes=make(
            [("experiment", 101, 0, "Experiment Target", ""), ("experiment", 101, 1, "experiment target", "H3"),
             ("experiment", 102, 0, "EXPERIMENT TARGET", "Input dna"), ("experiment", 103, 0, "assay type", "a"),
             ("run", 1, 0, "note", "n1")],
            "entity string, entity_id long, pos int, name string, value string",
        ),
    )


def names(df):
    return [r[0] for r in rows(df, "run_source_id")]


def test_selection(tables):
    out = select_runs(**tables)
    assert rows(out, "run_source_id", "input_run_id", "biosample_id", "study_source_id") == sorted(
        [("R1", "MANUAL", "B11", "ST21"), ("R2", None, "B11", "ST21"), ("R3", None, "B12", "ST21")], key=repr
    )


def test_a_collection_without_a_run_is_an_error_when_checked(spark, tables):
    assert names(select_runs(**tables, check_runs=True)) == ["R1", "R2", "R3"]
    tables["runs"] = tables["runs"].where("run_id <> 2")
    assert names(select_runs(**tables)) == ["R1", "R3"]
    with pytest.raises(ValueError, match="R2"):
        select_runs(**tables, check_runs=True)


def test_controls_can_be_required(tables):
    # the input run needs none
    assert names(select_runs(**tables, selection=Selection(require_control=True))) == ["R1", "R2"]


def test_without_lookups(tables):
    tables.update(lookups=None)
    assert rows(select_runs(**tables), "run_source_id", "input_run_id") == [("R1", None), ("R2", None), ("R3", None)]


def test_entity_conditions(tables):
    only = Selection(entity=EntityConditions(require={"organism": [{"term_source_id": "NCBI_9031"}]}))
    assert names(select_runs(**tables, selection=only)) == ["R3"]
    none = Selection(entity=EntityConditions(exclude={"Organism": [{"value": "cow"}]}))
    assert names(select_runs(**tables, selection=none)) == ["R3"]


def test_attribute_conditions_of_runs(tables):
    run = Conditions(
        require_columns={"status": ["public"]}, require_attributes={"Note": ["n1"]},
        output_columns=("run_id", "run_source_id"), output_attributes=("note",),
    )
    out = select_runs(**tables, selection=Selection(run=run))
    assert rows(out, "run_source_id", "note") == [("R1", "n1")]
    tables["attributes"] = None
    with pytest.raises(ValueError, match="attribute table"):
        select_runs(**tables, selection=Selection(run=run))


def test_unknown_output_column(tables):
    with pytest.raises(ValueError, match="nope"):
        select_runs(**tables, selection=Selection(study=Conditions(output_columns=("nope",))))


def test_manifest(tables):
    out = registration_manifest(select_runs(**tables), "LAB-", "DB")
    assert out.columns == MANIFEST_COLUMNS
    got = {r["accession"]: r.asDict() for r in out.collect()}
    assert got["R1"] == {
        "accession": "R1", "epigenome": "n11", "assay": "H3K4me3", "br": 101, "tr": 1, "is_control": 0,
        "md5sum": "md5b", "local_url": "f2", "analysis": "ChIP-Seq", "Project/lab": "LAB-ST21",
        # classes in order, both cell types, the first underscore only, no term no entry
        "ontologies": "SAMPLE-PATO:0_1;TISSUE-CL:1;TISSUE-CL:2",
        "control_id": "MANUAL", "species": "cow", "xrefs": "DB-R1",
    }
    assert (got["R2"]["assay"], got["R2"]["is_control"], got["R2"]["control_id"]) == ("WCE", 1, None)
    assert (got["R3"]["epigenome"], got["R3"]["ontologies"], got["R3"]["control_id"]) == (None, "", None)


def test_sample_cells_are_computed_before_the_join(tables):
    runs = select_runs(**tables, sample_cells=manifest_cells())
    assert "entity_attributes" not in runs.columns
    early = registration_manifest(runs, "LAB-", "DB")
    assert rows(early) == rows(registration_manifest(select_runs(**tables), "LAB-", "DB"))
    plan = early._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Join Inner") < plan.rindex("transform(")  # below the joins


def test_manifest_needs_its_assay_column(tables):
    with pytest.raises(ValueError, match="other"):
        registration_manifest(select_runs(**tables), "LAB-", "DB", assay="other")


def test_ontology_classes_are_a_parameter(spark):
    df = spark.createDataFrame([([("b", "v", "T_1_2"), ("a", "v", "T_3")],)], ENTITY.split(", ", 1)[1])
    terms = ontology_terms(F.col("attributes"), {"K": ["a", "b"], "L": ["b"]})
    assert df.select(terms).first()[0] == "K-T:3;K-T:1_2;L-T:1_2"


def test_first_files(spark):
    df = spark.createDataFrame([("k", 2, "b", "mb"), ("k", 1, "a", "ma"), ("l", 5, "c", "mc")],
                               "k string, pos int, n string, m string")
    out = first_files(df, "k", ["pos"], F.col("n"), F.col("m"))
    assert rows(out.select("k", F.col("files")[0]["name"], F.col("files")[0]["md5"], F.size("files"))) == [
        ("k", "a", "ma", 1), ("l", "c", "mc", 1),
    ]
