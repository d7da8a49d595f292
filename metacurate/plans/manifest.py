"""Selection of sequencing runs and the registration manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metacurate import presets
from metacurate.functions.text import cross_references, project_label, term_reference
from metacurate.functions.values import truthy
from metacurate.operators.conditions import (
    NAME_KEY,
    attribute_conditions,
    check_columns,
    entity_status,
    exclude_columns,
    folded_name,
    instances_of,
    lenient_gate,
    multi_value_conditions,
    output_instances,
    require_columns,
    strict_gate,
)
from metacurate.operators.lookups import lookup_with_fallback, require_references


@dataclass(frozen=True)
class Conditions:
    """What one kind of record has to satisfy and what it contributes to the output."""

    require_columns: Mapping[str, Sequence[str] | str] = field(default_factory=dict)
    exclude_columns: Mapping[str, Sequence[str] | str] = field(default_factory=dict)
    require_attributes: Mapping[str, Sequence[str] | str] = field(default_factory=dict)
    exclude_attributes: Mapping[str, Sequence[str] | str] = field(default_factory=dict)
    output_columns: Sequence[str] = ()
    output_attributes: Sequence[str] = ()


@dataclass(frozen=True)
class EntityConditions:
    """Conditions on multi-valued entity attributes."""

    require: Mapping[str, Sequence[Mapping[str, str]]] = field(default_factory=dict)
    exclude: Mapping[str, Sequence[Mapping[str, str]]] = field(default_factory=dict)
    output: Sequence[str] = tuple(presets.ENTITY_OUTPUT_ATTRIBUTES)


@dataclass(frozen=True)
class Selection:
    """All conditions of a run selection. The defaults select public runs."""

    collection: Conditions = Conditions(require_columns=presets.COLLECTION_COLUMNS)
    run: Conditions = Conditions(
        require_columns=presets.RUN_COLUMNS,
        output_columns=("run_id", "run_source_id", "center_name", "run_center_name"),
    )
    experiment: Conditions = Conditions(
        require_columns=presets.EXPERIMENT_COLUMNS,
        output_columns=("experiment_id", "experiment_source_id", "library_strategy", "library_layout"),
        output_attributes=("experiment target", "assay type"),
    )
    sample: Conditions = Conditions(
        require_columns=presets.SAMPLE_COLUMNS, output_columns=("biosample_id",)
    )
    study: Conditions = Conditions(
        require_columns=presets.STUDY_COLUMNS, output_columns=("study_source_id",)
    )
    entity: EntityConditions = EntityConditions()
    lookup_strategy: str = presets.LOOKUP_STRATEGY
    require_control: bool = False


def _selected(
    df: DataFrame, conditions: Conditions, attributes: DataFrame | None, key: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Filter one table and keep its keys and output columns; both reach the scan."""
    check_columns(df, conditions.output_columns)
    df = exclude_columns(require_columns(df, conditions.require_columns), conditions.exclude_columns)
    keep = list(dict.fromkeys([*extra, *conditions.output_columns]))
    names = [*conditions.require_attributes, *conditions.exclude_attributes, *conditions.output_attributes]
    if not names:
        return df.select(*keep)
    if attributes is None:
        raise ValueError(f"attribute conditions on {key} need an attribute table")
    df = attribute_conditions(
        df.select(*dict.fromkeys([key, *keep])),
        attributes,
        key,
        conditions.require_attributes,
        conditions.exclude_attributes,
        conditions.output_attributes,
    )
    return df.select(*keep, *[f"`{a}`" for a in conditions.output_attributes])


def _attributes_of(attributes: DataFrame | None, entity: str, key: str) -> DataFrame | None:
    if attributes is None:
        return None
    folded = [NAME_KEY] if NAME_KEY in attributes.columns else []
    return attributes.where(F.col("entity") == entity).select(
        F.col("entity_id").alias(key), "pos", "name", "value", *folded
    )


def target_of(attributes: DataFrame, key: str, name: str = presets.TARGET_ATTRIBUTE) -> DataFrame:
    """First truthy value of the target attribute per entity, ``(key, target)``."""
    rows = attributes.where((folded_name(attributes) == name.lower()) & truthy(F.col("value")))
    return rows.groupBy(key).agg(F.min_by("value", "pos").alias("target"))


def select_runs(
    collections: DataFrame,
    runs: DataFrame,
    experiments: DataFrame,
    samples: DataFrame,
    studies: DataFrame,
    entities: DataFrame,
    experiment_entities: DataFrame,
    lookups: DataFrame | None = None,
    attributes: DataFrame | None = None,
    selection: Selection = Selection(),
    check_runs: bool = False,
    sample_cells: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Runs that pass every condition, with their metadata: one lazy plan.

    A run needs a known sample entity, a known experiment entity whose status is
    given and not the error status, and a sample entity whose status is not the
    error status. A missing control keeps the run unless ``require_control``.
    ``check_runs`` first runs a job that fails if a collection names no run.

    Runs come with the output attributes of their sample as ``entity_attributes``.
    ``sample_cells`` (name and expression over that column, see
    ``manifest_cells``) are computed once a sample entity, before it is joined to
    its runs, and carried in its place.

    Each table is filtered and pruned before it is joined.
    """
    s = selection
    found = exclude_columns(
        require_columns(collections, s.collection.require_columns), s.collection.exclude_columns
    ).select(F.col("name").alias("run_source_id"), F.col("files").alias("collection_files"))
    if check_runs:
        require_references(found, runs, "run_source_id")

    run = _selected(
        runs, s.run, _attributes_of(attributes, "run", "run_id"), "run_id", ["run_source_id", "experiment_id"]
    )
    experiment_attributes = _attributes_of(attributes, "experiment", "experiment_id")
    experiment = _selected(
        experiments,
        s.experiment,
        experiment_attributes,
        "experiment_id",
        [
            c
            for c in ("experiment_id", "experiment_source_id", "sample_id", "study_id", "library_strategy",
                      "experiment_type")
            if c in experiments.columns
        ],
    )
    sample = _selected(
        samples, s.sample, _attributes_of(attributes, "sample", "sample_id"), "sample_id",
        ["sample_id", "biosample_id"],
    )
    study = _selected(
        studies, s.study, _attributes_of(attributes, "study", "study_id"), "study_id", ["study_id"]
    )

    attrs = F.col("attributes")
    sample_entity = entities.where(
        lenient_gate(entity_status(attrs)) & multi_value_conditions(attrs, s.entity.require, s.entity.exclude)
    ).select(
        F.col("id").alias("biosample_id"), output_instances(attrs, s.entity.output).alias("entity_attributes")
    )
    if sample_cells is not None:
        sample_entity = sample_entity.select("biosample_id", *[c.alias(name) for name, c in sample_cells.items()])
    experiment_entity = experiment_entities.where(strict_gate(entity_status(attrs))).select(
        F.col("id").alias("experiment_source_id")
    )

    # targets first: the last join then finds both sides freshly shuffled by experiment, which lets AQE
    # split an experiment that most runs belong to
    if lookups is not None and experiment_attributes is not None:
        experiment = experiment.join(target_of(experiment_attributes, "experiment_id"), "experiment_id", "left")
    else:
        experiment = experiment.withColumn("target", F.lit(None).cast("string"))
    experiment = (
        experiment.join(experiment_entity, "experiment_source_id", "left_semi")
        .join(sample.join(sample_entity, "biosample_id"), "sample_id")
        .join(study, "study_id")
    )
    out = found.join(run, "run_source_id")
    if lookups is None:
        out = out.withColumn("_control", F.lit(None).cast("string"))
    else:
        out = lookup_with_fallback(out, lookups, "run_source_id", "_control", unique_keys=True)
    out = out.join(experiment, "experiment_id")
    # the strategy is compared in any case
    looked_up = (F.upper("library_strategy") == s.lookup_strategy.upper()) & (
        F.coalesce(F.upper("target"), F.lit("")) != presets.CONTROL_ASSAY.upper()
    )
    if s.require_control:
        out = out.where(~F.coalesce(looked_up, F.lit(False)) | F.col("_control").isNotNull())
    out = out.withColumn("input_run_id", F.when(looked_up, F.col("_control"))).drop("_control")
    return out.drop("target", "sample_id", "study_id")


def first_files(files: DataFrame, key: str, order: Sequence[str], name: Column, md5: Column) -> DataFrame:
    """First file per key as ``(key, files)``, combined on the map side however many files a key has.

    ``name`` and ``md5`` are evaluated on the first row only; they may refer to
    the ``order`` columns and to columns that the order makes unique.
    """
    others = [c for c in files.columns if c != key and c not in order]
    first = files.groupBy(key).agg(F.min(F.struct(*order, *others)).alias("f")).select(key, "f.*")
    return first.select(key, F.array(F.struct(name.alias("name"), md5.alias("md5"))).alias("files"))


def ontology_terms(
    attributes: Column, classes: Mapping[str, Sequence[str]] = presets.ONTOLOGY_CLASSES
) -> Column:
    """``CLASS-term`` entries joined by ``;``: classes in order, then attributes, then positions."""
    wanted = F.array(
        *[
            F.struct(F.lit(f"{label}-").alias("label"), F.lit(name.lower()).alias("name"))
            for label, names in classes.items()
            for name in names
        ]
    )

    def entries(w: Column) -> Column:
        named = F.filter(attributes, lambda a: (F.lower(a["name"]) == w["name"]) & a["term_source_id"].isNotNull())
        return F.transform(named, lambda a: F.concat(w["label"], term_reference(a["term_source_id"])))

    return F.array_join(F.flatten(F.transform(wanted, entries)), ";")


def first_value(attributes: Column, name: str) -> Column:
    return F.try_element_at(instances_of(attributes, name), F.lit(1))["value"]


def manifest_cells(ontology_classes: Mapping[str, Sequence[str]] = presets.ONTOLOGY_CLASSES) -> dict[str, Column]:
    """The manifest cells that depend on the sample alone, for ``select_runs(sample_cells=...)``."""
    attrs = F.col("entity_attributes")
    return {
        "epigenome": first_value(attrs, presets.NAME_ATTRIBUTE),
        "ontologies": ontology_terms(attrs, ontology_classes),
        "species": first_value(attrs, presets.SPECIES_ATTRIBUTE),
    }


def registration_manifest(
    runs: DataFrame,
    project_prefix: str,
    run_database: str,
    assay: str = "experiment_type",
    project_id: str = "study_source_id",
    ontology_classes: Mapping[str, Sequence[str]] = presets.ONTOLOGY_CLASSES,
    columns: Sequence[str] = presets.MANIFEST_COLUMNS,
) -> DataFrame:
    """Manifest rows of the selected runs, a projection.

    A control run (its assay is the input material) gets the control label and no
    control id. Checksum and path are those of the first file. Cells of the
    sample that the runs carry already (``manifest_cells``) are taken as they are.
    """
    check_columns(runs, [assay, project_id])
    sample = {n: F.col(n) if n in runs.columns else c for n, c in manifest_cells(ontology_classes).items()}
    is_control = F.coalesce(F.col(assay) == presets.CONTROL_ASSAY, F.lit(False))
    file = F.try_element_at("collection_files", F.lit(1))
    cells = {
        "accession": F.col("run_source_id"),
        "epigenome": sample["epigenome"],
        "assay": F.when(is_control, F.lit(presets.CONTROL_LABEL)).otherwise(F.col(assay)),
        "br": F.col("experiment_id"),
        "tr": F.col("run_id"),
        "is_control": is_control.cast("int"),
        "md5sum": file["md5"],
        "local_url": file["name"],
        "analysis": F.col("library_strategy"),
        "Project/lab": project_label(project_prefix, F.coalesce(F.col(project_id).cast("string"), F.lit(""))),
        "ontologies": sample["ontologies"],
        "control_id": F.when(~is_control, F.col("input_run_id")),
        "species": sample["species"],
        "xrefs": cross_references([(run_database, F.col("run_source_id"))]),
    }
    return runs.select(*[cells[c].alias(c) for c in columns])
