"""Schema trees as edge tables: mandatory nodes, expansion to any depth, path labels."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metacurate.operators.checkpoints import stored
from metacurate.operators.joins import join_unique

INLINE = "inline type"
ROWS_PER_TASK = 1 << 19


def is_mandatory() -> Column:
    """An element without ``min_occurs`` 0, or an attribute whose use is required."""
    optional = F.coalesce(F.col("min_occurs") == "0", F.lit(False))
    required = F.coalesce(F.col("use") == "required", F.lit(False))
    return F.when(F.col("kind") == "attribute", required).otherwise(~optional)


def inline_types(edges: DataFrame) -> DataFrame:
    """Give every inline type its own name, ``parent::name``, under which its children are filed."""
    own = F.concat_ws("::", F.when(F.col("parent") != "", F.col("parent")), F.col("name"))
    return edges.withColumn("type", F.when(F.col("type") == INLINE, own).otherwise(F.col("type")))


def expand(edges: DataFrame, root: str = "", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """All nodes reachable from the root elements, once per path.

    ``edges`` is ``(file, parent, name, type, …)``; the children of a node are the
    edges filed under its type. Returns the edge columns of each node with
    ``path`` (types from the root down to its parent) and ``depth``. A type that
    is already on the path is not entered again, so cycles end.

    The edges are derived once and stored. The levels follow the distinct types of the parents, not the
    nodes, so what a level stores grows with the number of paths. The nodes are one
    join of all paths to the edges, which is not stored: Parquet files of so many repeated paths are
    small, and a task that reads one back gets far more rows than its size tells. The edges are dealt
    so that a task makes some ``rows_per_task`` nodes.
    """
    columns = edges.columns
    edges = stored(edges, "edges")
    roots = edges.where(F.col("parent") == root)
    uses = edges.where(F.col("type").isNotNull() & (F.col("type") != root)).select("file", "parent", "type").distinct()
    counts = stored(edges.groupBy("file", "parent").agg(F.count("*").alias("n")), "children")
    # only types with children lead on
    inner = stored(join_unique(uses, counts.select("file", F.col("parent").alias("type")), ["file", "type"], "left_semi"), "types")
    level = stored(inner.where(F.col("parent") == root).select("file", F.col("type").alias("parent"), F.array("type").alias("path")), "paths")
    levels = []
    while not level.isEmpty():
        levels.append(level)
        further = level.join(inner, ["file", "parent"]).where(~F.array_contains("path", F.col("type")))
        level = stored(further.select("file", F.col("type").alias("parent"), F.array_append("path", F.col("type")).alias("path")), "paths")
    out = roots.select(*columns, F.array().cast("array<string>").alias("path"), F.lit(0).alias("depth"))
    if not levels:
        return out
    paths = reduce(DataFrame.unionByName, levels)
    fans = join_unique(paths.groupBy("file", "parent").agg(F.count("*").alias("fan")), counts, ["file", "parent"])
    n_nodes = fans.agg(F.coalesce(F.sum(F.col("fan") * F.col("n")), F.lit(0))).first()[0]
    if n_nodes > rows_per_task:
        edges = edges.repartition(-(-n_nodes // rows_per_task), "file", "parent", "name", "type")
    below = edges.join(paths, ["file", "parent"])
    return out.unionByName(below.select(*columns, "path", F.size("path").alias("depth")))


class PathDictionary(NamedTuple):
    paths: DataFrame
    names: DataFrame


def path_id(path: Column) -> Column:
    """Id of a path, the same wherever it is computed."""
    return F.md5(F.to_json(path).cast("binary"))


def path_dictionary(nodes: DataFrame) -> PathDictionary:
    """The paths of expanded nodes in long form, in place of a text for each.

    ``paths`` is ``(file, path_id, parent_id, type, depth)``: a path is the path
    of its parent and one more type; the empty path has no row and is the parent
    of those of one type. ``names`` is ``(file, type, name)``, the names that use
    each type on a path, so the label of a path at any depth and with any number
    of names is read by following ``parent_id`` and joining the names. Nodes find
    their path by ``path_id(path)``.
    """
    distinct = nodes.select("file", "path").distinct().where(F.size("path") > 0)
    steps = F.transform(
        F.sequence(F.lit(1), F.size("path")),
        lambda i: F.struct(
            path_id(F.slice("path", 1, i)).alias("path_id"), path_id(F.slice("path", 1, i - 1)).alias("parent_id"),
            F.get("path", i - 1).alias("type"), i.alias("depth"),
        ),
    )
    paths = distinct.select("file", F.inline(steps)).distinct()
    uses = nodes.select("file", "type", "name").distinct()
    # only types on a path need names; a basic type may be used by any number of nodes
    return PathDictionary(paths, join_unique(uses, paths.select("file", "type").distinct(), ["file", "type"], "left_semi"))


def path_labels(nodes: DataFrame, sep: str = "::") -> DataFrame:
    """Add ``label``: the path with every type replaced by the ``|``-joined names that use it.

    A label is one text for display, in each node's row; where types have more
    names than a text should hold, ``path_dictionary`` has them as rows. Works on
    the distinct paths, which siblings share.
    """
    steps = nodes.select("file", "path").distinct()
    exploded = steps.select("file", "path", F.posexplode("path").alias("pos", "type"))
    names = path_dictionary(nodes).names.groupBy("file", "type").agg(F.array_join(F.array_sort(F.collect_set("name")), "|").alias("names"))
    named = join_unique(exploded, names, ["file", "type"], "left").select(
        "file", "path", F.struct("pos", F.coalesce("names", "type").alias("text")).alias("step")
    )
    # one entry per path element: bounded by the depth
    labels = named.groupBy("file", "path").agg(F.array_sort(F.collect_list("step")).alias("s"))
    labels = labels.select(
        "file", "path", F.array_join(F.transform("s", lambda x: x["text"]), sep).alias("label")
    )
    out = join_unique(nodes, labels, ["file", "path"], "left")
    return out.select(*nodes.columns, F.coalesce("label", F.lit("")).alias("label"))
