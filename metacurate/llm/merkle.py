"""Merkle manifest of a dataset as a content-addressed graph, and proofs by descent from its root.

A node is the hash of its children's digests in hexadecimal, and the records of
the graph say which children a digest has. A leaf is asked for by its rank: the
digits of the rank, to the base of the fanout, say which child to take at each
record on the way down from the root; the children not taken are collected, and
reversed they are the proof from the leaf up. Requests that share the upper part
of their way go down it together, so a record is looked up once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.llm.registry import query, table
from metacurate.operators.checkpoints import new_folder, stored
from metacurate.operators.joins import join_unique
from metacurate.operators.ranks import ranked

FANOUT = 3
LEVELS = 5  # levels that one grouping builds; FANOUT ** LEVELS digests are one row
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]

_RECORD = "tree string, rank bigint, nodes bigint, digest string, children array<string>, height int"


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row from its values in this order."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def _runs(digests: Column) -> Column:
    """Consecutive ``FANOUT`` elements each; the last run may be shorter."""
    starts = F.sequence(F.lit(1), F.size(digests), F.lit(FANOUT))
    return F.transform(starts, lambda i: F.slice(digests, i, FANOUT))


def _build_levels(nodes: DataFrame, base: int) -> DataFrame:
    """Records of the next ``LEVELS`` levels over ``nodes(tree, rank, nodes, digest)`` of height ``base``.

    Each row is a block of consecutive nodes, so all its levels are built in place.
    """
    span = FANOUT**LEVELS
    block = F.expr(f"rank DIV {span}").alias("block")
    at = (
        nodes.groupBy("tree", "nodes", block)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("at"))
        .select("tree", "block", F.col("nodes").alias("n0"), F.col("at.digest").alias("d0"))
    )
    for i in range(LEVELS):
        more = F.col(f"n{i}") > 1
        at = at.withColumns({
            f"c{i + 1}": F.when(more, _runs(F.col(f"d{i}"))),
            f"n{i + 1}": F.when(more, F.expr(f"(n{i} + {FANOUT - 1}) DIV {FANOUT}")).otherwise(F.col(f"n{i}")),
        })
        hashed = F.transform(f"c{i + 1}", lambda c: F.sha2(F.array_join(c, ""), 256))
        at = at.withColumn(f"d{i + 1}", F.when(more, hashed).otherwise(F.col(f"d{i}")))

    def level(i: int) -> Column:
        def record(children: Column, j: Column) -> Column:
            rank = F.col("block") * FANOUT ** (LEVELS - i) + j
            return F.struct(
                rank.alias("rank"), F.col(f"n{i}").alias("nodes"), F.col(f"d{i}")[j].alias("digest"),
                children.alias("children"), F.lit(base + i).alias("height"),
            )

        return F.transform(f"c{i}", record)

    made = F.filter(F.array(*[level(i) for i in range(1, LEVELS + 1)]), lambda records: records.isNotNull())
    return at.select("tree", F.inline(F.flatten(made)))


def build_records(leaves: DataFrame, label: str = "records") -> tuple[DataFrame, DataFrame]:
    """The graph over ``leaves(tree string, rank, nodes, digest)``, where ``nodes`` is the number of leaves of the tree.

    Returns the records ``(tree, rank, nodes, digest, children, height)``, one
    for each inner node, stored by height, and the roots ``(tree, digest,
    height)``. A tree of one leaf has no record; the leaf is its root. A hot
    tree's blocks are independent rows.
    """
    spark, folder = leaves.sparkSession, new_folder(leaves.sparkSession, label)
    records = spark.createDataFrame([], _RECORD)
    level, base = leaves, 0
    while not level.where("nodes > 1").isEmpty():
        _build_levels(level.where("nodes > 1").select("tree", "rank", "nodes", "digest"), base).write.mode("append").partitionBy(
            "height"
        ).parquet(folder)
        records, base = spark.read.schema(_RECORD).parquet(folder), base + LEVELS
        level = records.where(F.col("height") == base)
    roots = leaves.where("nodes = 1").select("tree", "digest", F.lit(0).alias("height"))
    return records, roots.unionByName(records.where("nodes = 1").select("tree", "digest", "height"))


def descend(roots: DataFrame, records: DataFrame, top: int, bottom: int) -> DataFrame:
    """All ways down from ``roots(tree, digest, height, path)`` to the nodes of height ``bottom``.

    Returns ``tree, root, height, prefix, digest, path``: ``prefix`` is the
    number whose digits were taken so far, ``path`` has a ``before, after``
    segment for each level, the digests of the children on either side of the
    one taken.
    Roots of at most that height come back as they are. Each level joins the
    nodes reached to the records of that height by digest.
    """
    reached = roots.withColumns({"prefix": F.lit(0).cast("bigint"), "root": F.col("digest")})
    for height in range(top, bottom, -1):
        known = records.where(F.col("height") == height).select("digest", "children").dropDuplicates(["digest"])
        digits = F.when(
            F.col("children").isNotNull(),
            F.transform("children", lambda c, i: F.struct((F.col("prefix") * FANOUT + i).alias("prefix"), c.alias("digest"),
                F.concat("path", F.array(_segment(F.col("children"), i))).alias("path"))),
        ).otherwise(F.array(F.struct("prefix", "digest", "path")))
        reached = join_unique(reached, known, "digest", "left").select(
            "tree", "root", (F.col("height") - F.col("children").isNotNull().cast("int")).alias("height"), F.inline(digits)
        )
    return reached


def _binary(digests: Column) -> Column:
    return F.unhex(F.array_join(digests, ""))


def _segment(children: Column, digit: Column) -> Column:
    """The children not taken, on either side of the digit's child."""
    return F.struct(
        _binary(F.slice(children, F.lit(1), digit)).alias("before"),
        _binary(F.slice(children, digit + 2, F.lit(FANOUT))).alias("after"),
    )


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path that runs from the leaf up."""
    sides = F.transform(path, lambda s: F.concat(_text(s["before"]), _text(s["after"])))
    return F.sha2(F.array_join(sides, ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path, from the leaf up, lead to."""
    return F.aggregate(
        path, leaf, lambda acc, s: F.sha2(F.concat(_text(s["before"]), acc, _text(s["after"])), 256)
    )


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    id_column: str = "doc_id",
    group_column: str = "source",
    received: Column | None = None,
) -> DataFrame:
    """Leaf, subtree root, root and proof of each row, and whether a received copy of it verifies.

    A row's leaf is the hash of ``columns``, each with its length, so null
    differs from empty text and any length of text is one value. The rows of a
    group form a subtree in ascending order of ``id_column`` (null first, equal
    ids by their leaf); the subtree roots in ascending order of the group (null
    first, by UTF-8 bytes) form the tree above it. ``received`` is the digest of
    the copy to verify (by default the row itself): ``folded_root`` is what that
    copy and the row's proof lead to.

    Returns ``id_column, leaf, subroot, root, proof_sha256, folded_root,
    verified``; other columns and their names do not matter. Repeated rows are
    leaves of their own. Without rows the result is empty. Only digests are
    shuffled; a hot group is sorted and built in as many parts as it fills.
    """
    leaf = leaf_digest([F.col(f"`{c}`") for c in columns])
    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_column}`").cast("string")), F.lit(""))
    digests = docs.select(
        F.col(f"`{id_column}`").alias("id"), group.alias("tree"), leaf.alias("digest"),
        (F.lit(None).cast("string") if received is None else received).alias("received"),
    )
    leaves = stored(ranked(digests, ["tree"], ["id", "digest"], total="nodes"), "leaves")
    records, subroots = build_records(leaves)
    tops = stored(ranked(subroots, [], ["tree"], total="nodes"), "subroots")
    top_records, top_root = build_records(tops.select(F.lit("").alias("tree"), "rank", "nodes", "digest"), "top_records")
    root = top_root.first()
    highest = tops.agg(F.max("height")).first()[0] or 0
    no_path = F.array().cast("array<struct<before: binary, after: binary>>")

    ways = descend(top_root.withColumn("path", no_path), top_records, root["height"] if root else 0, 0)
    starts = join_unique(tops.select("rank", "tree", "digest", "height"), ways.select(F.col("prefix").alias("rank"), "path"), "rank")
    # the last digit is taken beside the leaves, so that a long path is shuffled once for a run of them
    runs = descend(starts.select("tree", "digest", "height", "path"), records, highest, 1)
    known = records.where("height = 1").select("digest", "children").dropDuplicates(["digest"])
    runs = join_unique(runs, known, "digest", "left").select("tree", "prefix", "root", "path", "children")

    found = join_unique(leaves.withColumn("prefix", F.expr(f"rank DIV {FANOUT}")), runs, ["tree", "prefix"])
    digit = (F.col("rank") % FANOUT).cast("int")
    own = F.when(F.col("children").isNotNull(), F.array(_segment(F.col("children"), digit))).otherwise(no_path)
    out = found.select(
        F.col("id").alias(id_column), F.col("digest").alias("leaf"), F.col("root").alias("subroot"), "received",
        F.concat(own, F.reverse("path")).alias("proof"),
    ).withColumn("folded_root", folded(F.coalesce("received", "leaf"), F.col("proof")))
    top = F.lit(root["digest"] if root else None).cast("string")
    return out.select(
        id_column, "leaf", "subroot", top.alias("root"), proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == top).alias("verified"),
    )


@query(
    "op11_merkle_manifest",
    """
    WITH RECURSIVE docs AS (
      SELECT doc_id, source,
             list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)],
                            lambda x: coalesce(strlen(x) || ':' || x, '-')) AS front, text,
             replace(text, chr(10), '') AS joined
      FROM documents
    ), bits AS (
      SELECT *, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                       lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0])) AS steps FROM docs
    ), summed AS (
      SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(steps, lambda b: CAST(b AS BIGINT))),
                            lambda c, b: xor((xor(c, b) >> 1), CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)) AS crc
      FROM bits
    ), leaves AS (
      SELECT doc_id, source, sha256(array_to_string(front, '') || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             CASE WHEN xor(crc, 4294967295) % 2 = 0
                  THEN sha256(array_to_string(front, '') || coalesce(strlen(joined) || ':' || joined, '-')) END AS tampered
      FROM summed
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
    ), nodes(level, source, i, digest) AS (
      SELECT 0, source, CAST(place AS BIGINT), leaf FROM placed
      UNION ALL
      SELECT level + 1, source, i // 3, sha256(string_agg(digest, '' ORDER BY i))
      FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM nodes) t WHERE n > 1 GROUP BY level, source, i // 3
    ), subroots AS (
      SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
      FROM (SELECT source, digest AS subroot, level AS depth, max(level) OVER (PARTITION BY source) AS top FROM nodes) t WHERE depth = top
    ), tops(level, i, digest) AS (
      SELECT 0, CAST(place AS BIGINT), subroot FROM subroots
      UNION ALL
      SELECT level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM tops
      WHERE (SELECT count(*) FROM tops) > 1 GROUP BY level, i // 3
    ), root AS (
      SELECT digest AS root, level AS top FROM tops WHERE level = (SELECT max(level) FROM tops)
    ), own AS (
      SELECT p.*, s.subroot, s.depth, s.place AS above, coalesce(p.tampered, p.leaf) AS received
      FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
    ), segments AS (
      SELECT o.source, o.place, n.level, string_agg(CASE WHEN n.i = o.place // CAST(3 ** n.level AS BIGINT) THEN '*' ELSE n.digest END, ''
                                                    ORDER BY n.i) AS segment
      FROM own o JOIN nodes n ON n.source IS NOT DISTINCT FROM o.source AND n.level < o.depth
                             AND n.i // 3 = o.place // CAST(3 ** (n.level + 1) AS BIGINT)
      GROUP BY o.source, o.place, n.level
    ), lower_part AS (
      SELECT source, place, list(segment ORDER BY level) AS path FROM segments GROUP BY source, place
    ), top_segments AS (
      SELECT s.place, n.level, string_agg(CASE WHEN n.i = s.place // CAST(3 ** n.level AS BIGINT) THEN '*' ELSE n.digest END, ''
                                          ORDER BY n.i) AS segment
      FROM subroots s JOIN tops n ON n.level < (SELECT top FROM root) AND n.i // 3 = s.place // CAST(3 ** (n.level + 1) AS BIGINT)
      GROUP BY s.place, n.level
    ), upper_part AS (
      SELECT place, list(segment ORDER BY level) AS path FROM top_segments GROUP BY place
    ), proofs AS (
      SELECT o.doc_id, o.leaf, o.subroot, o.received,
             list_concat(coalesce(l.path, []), coalesce(u.path, [])) AS path
      FROM own o LEFT JOIN lower_part l ON l.source IS NOT DISTINCT FROM o.source AND l.place = o.place
                 LEFT JOIN upper_part u ON u.place = o.above
    ), folds AS (
      SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '*', '')) AS proof_sha256,
             list_reduce(list_prepend(received, path), lambda acc, s: sha256(replace(s, '*', acc))) AS folded_root
      FROM proofs, root
    )
    SELECT *, folded_root = root AS verified FROM folds
    """,
)
def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    received = leaf_digest([F.translate(c, "\n", "") if c == "text" else F.col(c) for c in COLUMNS])
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return manifest(docs, received=F.when(tampered, received))
