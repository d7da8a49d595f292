"""Filters, joins, lookups and the registration manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.registry import query, table
from metacurate.operators.checkpoints import new_folder
from metacurate.operators.conditions import (
    attribute_conditions,
    exclude_columns,
    lenient_gate,
    multi_value_conditions,
    multi_value_filter,
    output_columns,
    output_instances,
    require_columns,
    strict_gate,
)
from metacurate.operators.entities import pivot_fields, unpivot_columns
from metacurate.operators.lookups import lookup_with_fallback, reference_chain
from metacurate.plans.manifest import (
    Conditions,
    EntityConditions,
    Selection,
    first_files,
    manifest_cells,
    registration_manifest,
    select_runs,
)
from metacurate.sinks.writers import write_attributes
from metacurate.streaming.ledger import pending_only


@query(
    "require_exclude_filter",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE coalesce(o_orderstatus, '') IN ('F', 'O') AND coalesce(o_orderpriority, '') <> '5-LOW'
    """,
)
def require_exclude_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders = require_columns(table(spark, sf, "orders"), {"o_orderstatus": ["F", "O"]})
    kept = exclude_columns(orders, {"o_orderpriority": "5-LOW"})
    return output_columns(kept, ["o_orderkey", "o_orderstatus", "o_orderpriority"])


@query(
    "attribute_pivot",
    """
    SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'high' END AS tier, CAST(c_nationkey AS VARCHAR) AS nation
    FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT c_acctbal < 0
    """,
)
def attribute_pivot(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    tier = F.when(F.col("c_acctbal") > 5000, "high").when(F.col("c_acctbal") < 0, "debt")
    attributes = unpivot_columns(
        customer,
        "c_custkey",
        {"Segment": F.col("c_mktsegment"), "tier": tier, "nation": F.col("c_nationkey")},
    )
    return attribute_conditions(
        customer.select("c_custkey"),
        attributes,
        "c_custkey",
        require={"segment": ["BUILDING", "MACHINERY"]},
        exclude={"tier": "debt"},
        output=["tier", "nation"],
    )


@query(
    "attribute_table",
    """
    SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'high' END AS tier, CAST(c_nationkey AS VARCHAR) AS nation
    FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT c_acctbal < 0
    """,
)
def attribute_table(spark: SparkSession, sf: str) -> DataFrame:
    """Conditions over attributes that were written as a table sorted by their folded names."""
    customer = table(spark, sf, "customer")
    tier = F.when(F.col("c_acctbal") > 5000, "high").when(F.col("c_acctbal") < 0, "debt")
    columns = {"Segment": F.col("c_mktsegment"), "Tier": tier, "NATION": F.col("c_nationkey"), "title": F.col("c_name")}
    path = new_folder(spark, "attributes")
    write_attributes(unpivot_columns(customer, "c_custkey", columns), path, key="c_custkey")
    return attribute_conditions(
        customer.select("c_custkey"),
        spark.read.parquet(path),
        "c_custkey",
        require={"segment": ["BUILDING", "MACHINERY"]},
        exclude={"tier": "debt"},
        output=["tier", "nation"],
    )


@query(
    "field_projection",
    """
    SELECT c_custkey, c_mktsegment AS "Organism",
           CASE WHEN c_acctbal > 5000 THEN 'lower ' || c_nationkey ELSE 'upper ' || c_nationkey END AS "derived from"
    FROM customer
    """,
)
def field_projection(spark: SparkSession, sf: str) -> DataFrame:
    nation = F.col("c_nationkey").cast("string")
    fields = unpivot_columns(
        table(spark, sf, "customer"),
        "c_custkey",
        {
            "derived from": F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("lower "), nation)),
            "Organism": F.col("c_mktsegment"),
            "Derived from": F.concat(F.lit("upper "), nation),
        },
    )
    return pivot_fields(fields, "c_custkey", ["Organism", "derived from", "Derived from"])


@query(
    "multi_value_filter",
    """
    SELECT o_orderkey, o_orderstatus FROM orders o
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
                  AND (l_returnflag = 'R' OR l_linestatus = 'O'))
      AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 45)
    """,
)
def multi_values(spark: SparkSession, sf: str) -> DataFrame:
    instances = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.inline(
            F.array(
                F.struct(
                    F.lit("Flag").alias("name"),
                    F.col("l_returnflag").alias("value"),
                    F.col("l_linestatus").alias("term_source_id"),
                ),
                F.struct(
                    F.lit("bulk").alias("name"),
                    F.when(F.col("l_quantity") >= 45, "yes").otherwise("no").alias("value"),
                    F.lit(None).cast("string").alias("term_source_id"),
                ),
            )
        ),
    )
    return multi_value_filter(
        table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"),
        instances,
        "o_orderkey",
        require={"flag": [{"value": "R"}, {"term_source_id": "O"}]},
        exclude={"bulk": [{"value": "yes"}]},
    )


@query(
    "multi_value_array",
    """
    SELECT doc_id, lang || '|' || upper(lang) || '|' || source AS kept FROM documents
    WHERE (lang IN ('en', 'de') OR lang = 'fr') AND source NOT IN ('src1', 'src2')
    """,
)
def multi_value_array(spark: SparkSession, sf: str) -> DataFrame:
    def instance(name: str, value, term=None):
        return F.struct(
            F.lit(name).alias("name"),
            value.alias("value"),
            (term if term is not None else F.lit(None).cast("string")).alias("term_source_id"),
        )

    lang, source = F.col("lang"), F.col("source")
    attributes = F.array(
        instance("Lang", lang, F.concat(F.lit("LANG_"), lang)),
        instance("lang", F.upper(lang)),
        instance("Source", source, F.concat(F.lit("SRC_"), source)),
        instance("size", F.col("n_chars").cast("string")),
    )
    docs = table(spark, sf, "documents").select("doc_id", attributes.alias("attributes"))
    kept = docs.where(
        multi_value_conditions(
            F.col("attributes"),
            require={"lang": [{"term_source_id": "LANG_en"}, {"value": "de"}, {"value": "FR"}]},
            exclude={"source": [{"value": "src1"}, {"term_source_id": "SRC_src2"}]},
        )
    )
    values = F.transform(output_instances(F.col("attributes"), ["lang", "source"]), lambda a: a["value"])
    return kept.select("doc_id", F.array_join(values, "|").alias("kept"))


@query(
    "validation_gate",
    """
    SELECT d.doc_id, CAST(coalesce(quality <> 0, false) AS INTEGER) AS strict,
           CAST(coalesce(quality <> 0, true) AS INTEGER) AS lenient
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def validation_gate(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("quality") == 0, "error").when(F.col("quality").isNotNull(), "pass")
    docs = table(spark, sf, "documents").select("doc_id")
    labelled = docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return labelled.select(
        "doc_id",
        strict_gate(status).cast("int").alias("strict"),
        lenient_gate(status).cast("int").alias("lenient"),
    )


@query(
    "reference_chain",
    """
    SELECT n_name AS study, r_name AS area, c_mktsegment AS segment,
           CAST(count(*) AS BIGINT) AS n_runs, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL
    """,
)
def chain(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    runs = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("experiment_id"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    experiments = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("experiment_id"), F.col("o_custkey").alias("sample_id")
    )
    samples = customer.select(
        F.col("c_custkey").alias("sample_id"),
        F.col("c_nationkey").alias("study_id"),
        F.col("c_mktsegment").alias("segment"),
    )
    studies = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("study_id"), F.col("n_name").alias("study"), F.col("r_name").alias("area"))
    )
    return (
        reference_chain(runs, experiments, samples, studies)
        .groupBy("study", "area", "segment")
        .agg(F.count("*").alias("n_runs"), F.sum("quantity").alias("quantity"))
    )


@query(
    "ordered_lookup",
    """
    WITH latest AS (
      SELECT o_custkey, o_orderstatus,
             arg_max(CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END,
                     (o_orderdate, o_orderkey)) AS v
      FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL),
    usable AS (SELECT * FROM latest WHERE v NOT IN ('', '0'))
    SELECT c_custkey,
           CASE WHEN c_mktsegment <> 'FURNITURE' THEN coalesce(f.v, o.v) END AS control
    FROM customer
    LEFT JOIN usable f ON f.o_custkey = c_custkey AND f.o_orderstatus = 'F'
    LEFT JOIN usable o ON o.o_custkey = c_custkey AND o.o_orderstatus = 'O'
    """,
)
def ordered_lookup(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "O"))
    value = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderkey").cast("string"))
    latest = orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.max(F.struct("o_orderdate", "o_orderkey", value.alias("value"))).alias("last")
    )
    lookups = latest.select(
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("priority"),
        F.col("o_custkey").alias("key"),
        F.col("last.value").alias("value"),
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    found = lookup_with_fallback(
        customers, lookups, "c_custkey", "control", F.lower("c_mktsegment") != "furniture"
    )
    return found.select("c_custkey", "control")


# --- the registration manifest: orders are runs and experiments, customers samples, nations studies ---


def _run_inputs(spark: SparkSession, sf: str) -> dict:
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    order_id = F.col("o_orderkey")
    run_name = F.concat(F.lit("R"), order_id.cast("string"))
    target = F.when(F.col("o_totalprice") < 100000, "input DNA").otherwise("H3K4me3")

    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    path = F.concat_ws("/", "l_partkey", "l_suppkey")
    files = first_files(
        items, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], path, F.md5(path.cast("binary"))
    )
    collections = files.select(
        F.concat(F.lit("R"), F.col("l_orderkey").cast("string")).alias("name"),
        F.lit("FASTQ").alias("type"),
        F.lit("file").alias("table_name"),
        "files",
    )
    runs = orders.select(
        order_id.alias("run_id"),
        run_name.alias("run_source_id"),
        order_id.alias("experiment_id"),
        F.when(F.col("o_orderstatus").isin("F", "O"), "public").otherwise("private").alias("status"),
        F.col("o_orderstatus").alias("center_name"),
        F.lit(None).cast("string").alias("run_center_name"),
    )
    experiments = orders.select(
        order_id.alias("experiment_id"),
        F.concat(F.lit("X"), order_id.cast("string")).alias("experiment_source_id"),
        F.col("o_custkey").alias("sample_id"),
        F.pmod("o_custkey", F.lit(25)).cast("int").alias("study_id"),
        F.lit("public").alias("status"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "RNA-Seq").otherwise("ChIP-Seq").alias("library_strategy"),
        F.lit("PAIRED").alias("library_layout"),
        F.lit("ILLUMINA").alias("instrument_platform"),
        target.alias("experiment_type"),
    )
    samples = customer.select(
        F.col("c_custkey").alias("sample_id"),
        F.concat(F.lit("B"), F.col("c_custkey").cast("string")).alias("biosample_id"),
        F.when(F.col("c_acctbal") < 9000, "public").otherwise("private").alias("status"),
    )
    studies = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("study_id"),
            F.col("n_name").alias("study_source_id"),
            F.when(F.col("r_name") == "AFRICA", "private").otherwise("public").alias("status"),
        )
    )

    def attribute(name: str, value, term=None):
        none = F.lit(None).cast("string")
        return F.struct(
            F.lit(name).alias("name"), value.alias("value"), (none if term is None else term).alias("term_source_id")
        )

    segment = F.col("c_mktsegment")
    status = F.when(F.col("c_acctbal") < 0, "error").otherwise("pass")
    entities = customer.select(
        F.concat(F.lit("B"), F.col("c_custkey").cast("string")).alias("id"),
        F.filter(
            F.array(
                attribute("Sample Name", F.col("c_name")),
                attribute("Organism", segment, F.concat(F.lit("TAXON_"), segment)),
                attribute(
                    "Sex",
                    F.when(F.col("c_acctbal") > 5000, "male").otherwise("female"),
                    F.when(F.col("c_acctbal") > 5000, "PATO_0000_384").otherwise("PATO_0000_383"),
                ),
                attribute("breed", segment),
                attribute("Cell type", segment, F.concat(F.lit("CL_"), F.col("c_nationkey").cast("string"))),
                attribute("cell type", segment, F.lit("CL:1")),
                attribute(
                    "Metadata validation status", F.when(F.col("c_acctbal") <= 8000, status)
                ),
            ),
            lambda a: a["value"].isNotNull(),
        ).alias("attributes"),
    )
    experiment_entities = orders.select(
        F.concat(F.lit("X"), order_id.cast("string")).alias("id"),
        F.filter(
            F.array(
                attribute(
                    "Metadata validation status",
                    F.when(F.col("o_orderpriority") == "3-MEDIUM", "error").when(
                        F.col("o_orderpriority") != "4-NOT SPECIFIED", "pass"
                    ),
                )
            ),
            lambda a: a["value"].isNotNull(),
        ).alias("attributes"),
    )
    attributes = unpivot_columns(orders, "o_orderkey", {"Experiment Target": target}).select(
        F.lit("experiment").alias("entity"), F.col("o_orderkey").alias("entity_id"), "pos", "name", "value"
    )
    customer_name = F.col("o_custkey").cast("string")
    manual = orders.where(F.col("o_totalprice") > 400000).select(
        F.lit(0).alias("priority"), run_name.alias("key"), F.concat(F.lit("M"), customer_name).alias("value")
    )
    auto = orders.where(F.col("o_orderstatus") == "F").select(
        F.lit(1).alias("priority"),
        run_name.alias("key"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.concat(F.lit("A"), customer_name)).alias("value"),
    )
    return dict(
        collections=collections,
        runs=runs,
        experiments=experiments,
        samples=samples,
        studies=studies,
        entities=entities,
        experiment_entities=experiment_entities,
        lookups=manual.unionByName(auto),
        attributes=attributes,
    )


_SELECTION = Selection(
    experiment=Conditions(
        require_columns={
            "status": ["public"],
            "library_strategy": ["ChIP-Seq", "RNA-Seq"],
            "instrument_platform": ["ILLUMINA"],
        },
        output_columns=("experiment_id", "experiment_source_id", "library_strategy", "library_layout"),
    ),
    entity=EntityConditions(exclude={"Organism": [{"term_source_id": "TAXON_FURNITURE"}]}),
)

_SELECTED = """
    files AS (
      SELECT l_orderkey, arg_min(l_partkey || '/' || l_suppkey, (l_linenumber, l_partkey, l_suppkey)) AS path
      FROM lineitem GROUP BY l_orderkey),
    selected AS (
      SELECT *, o_totalprice < 100000 AS is_input,
             CASE WHEN o_orderpriority = '2-HIGH' THEN 'RNA-Seq' ELSE 'ChIP-Seq' END AS strategy,
             CASE WHEN o_orderpriority <> '2-HIGH' AND o_totalprice >= 100000 THEN
               CASE WHEN o_totalprice > 400000 THEN 'M' || o_custkey
                    WHEN o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' THEN 'A' || o_custkey END
             END AS control
      FROM orders
      JOIN files ON l_orderkey = o_orderkey
      JOIN customer ON c_custkey = o_custkey
      JOIN nation ON n_nationkey = o_custkey % 25
      JOIN region ON r_regionkey = n_regionkey
      WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('3-MEDIUM', '4-NOT SPECIFIED')
        AND c_acctbal < 9000 AND r_name <> 'AFRICA' AND c_mktsegment <> 'FURNITURE'
        AND NOT c_acctbal < 0)
"""


@query(
    "run_selection",
    f"""
    WITH {_SELECTED}
    SELECT o_orderkey AS run_id, 'R' || o_orderkey AS run_source_id, 'X' || o_orderkey AS experiment_source_id,
           strategy AS library_strategy, 'B' || c_custkey AS biosample_id, n_name AS study_source_id,
           control AS input_run_id
    FROM selected
    """,
)
def run_selection(spark: SparkSession, sf: str) -> DataFrame:
    runs = select_runs(**_run_inputs(spark, sf), selection=_SELECTION)
    return output_columns(
        runs,
        [
            "run_id",
            "run_source_id",
            "experiment_source_id",
            "library_strategy",
            "biosample_id",
            "study_source_id",
            "input_run_id",
        ],
    )


@query(
    "registration_manifest",
    f"""
    WITH {_SELECTED}
    SELECT 'R' || o_orderkey AS accession, c_name AS epigenome,
           CASE WHEN is_input THEN 'WCE' ELSE 'H3K4me3' END AS assay,
           o_orderkey AS br, o_orderkey AS tr, CAST(is_input AS INTEGER) AS is_control,
           md5(path) AS md5sum, path AS local_url, strategy AS analysis, 'LAB-' || n_name AS "Project/lab",
           'SAMPLE-PATO:0000_' || CASE WHEN c_acctbal > 5000 THEN '384' ELSE '383' END
             || ';TISSUE-CL:' || c_nationkey || ';TISSUE-CL:1' AS ontologies,
           CASE WHEN NOT is_input THEN control END AS control_id,
           c_mktsegment AS species, 'RUNS-R' || o_orderkey AS xrefs
    FROM selected
    """,
)
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    runs = select_runs(**_run_inputs(spark, sf), selection=_SELECTION, sample_cells=manifest_cells())
    return registration_manifest(runs, project_prefix="LAB-", run_database="RUNS")


@query(
    "pending_only",
    "SELECT o_orderkey, o_custkey FROM orders WHERE NOT o_orderdate < TIMESTAMP '1997-01-01'",
)
def pending(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    ledger = orders.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("seed_id")
    )
    return pending_only(orders.select("o_orderkey", "o_custkey"), ledger, "o_orderkey")
