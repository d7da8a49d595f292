"""Quality rules: text statistics and a decision list learned from labels. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.llm.registry import query, table
from metacurate.operators.checkpoints import stored
from metacurate.operators.joins import join_unique

SPACE = r"[\x20\x09-\x0D]+"
NO_SPACE = r"[^\x20\x09-\x0D]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.95
MIN_COVERED = 5
EDGES = 32


def text_statistics(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Counts of each row's whole ``text``, after the columns of ``keep``.

    Words are runs without white space. ``n_repeat_words`` counts the words that
    lie in a 3-word window found twice or more in the text. Equal windows come
    together by sorting their hashes within the row, so a text of any length is
    handled in ``n log n``. A null or blank text has no words and zero counts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(*keep, text.alias("_text")).select(
        *keep, "_text",
        F.array_remove(F.split("_text", SPACE), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike(NO_SPACE)).alias("_lines"),
    )
    window = lambda i: F.struct(
        F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("p")
    )
    windows = F.when(F.size("_words") >= 3, F.transform(F.sequence(F.lit(0), F.size("_words") - 3), window))
    sorted_ = base.withColumn("_sorted", F.sort_array(windows))
    same = lambda x, i: (F.get("_sorted", i - 1)["h"] == x["h"]) | (F.get("_sorted", i + 1)["h"] == x["h"])
    twice = F.filter("_sorted", lambda x, i: F.coalesce(same(x, i), (F.get("_sorted", F.when(i > 0, i - 1).otherwise(i + 1))["h"] == x["h"]), F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return sorted_.select(
        *keep,
        n(F.size("_words")).alias("n_words"),
        n(F.length(F.array_join("_words", ""))).alias("word_chars"),
        n(F.regexp_count("_text", F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        n(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        n(F.when(F.col("_sorted").isNotNull(), F.size(covered))).alias("n_repeat_words"),
        n(F.size("_lines")).alias("n_lines"),
        n(F.size(F.array_distinct("_words"))).alias("n_distinct_words"),
        n(F.regexp_count("_text", F.lit(r"\p{Lu}"))).alias("n_upper"),
        n(F.regexp_count("_text", F.lit(r"[!?]"))).alias("n_marks"),
        n(F.regexp_count("_text", F.lit(r"[0-9]"))).alias("n_digits"),
    )


def _share(a: str, b: str) -> Column:
    return F.round(F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0), 5)


def features() -> dict[str, Column]:
    """Statistics that rules may test, as expressions over ``text_statistics``."""
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": _share("word_chars", "n_words"),
        "symbols": _share("n_symbols", "n_words"),
        "dup_lines": _share("n_dup_lines", "n_lines"),
        "repeats": _share("n_repeat_words", "n_words"),
        "distinct": _share("n_distinct_words", "n_words"),
        "upper": _share("n_upper", "word_chars"),
        "marks": _share("n_marks", "n_words"),
        "digits": _share("n_digits", "word_chars"),
        "line_words": _share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, expressions: dict[str, Column]) -> Column:
        value = expressions[self.feature]
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first whose conditions all hold rejects, a text that none rejects is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def kept(self) -> Column:
        """One conditional expression over ``text_statistics``."""
        expressions = features()
        out = None
        for rule in self.rules:
            test = reduce(and_, [c.column(expressions) for c in rule])
            out = F.when(test, False) if out is None else out.when(test, False)
        return F.lit(True) if out is None else out.otherwise(True)

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) or "keep all"


def learn_rules(
    labelled: DataFrame,
    max_rules: int = MAX_RULES,
    max_conditions: int = MAX_CONDITIONS,
    min_precision: float = MIN_PRECISION,
    min_covered: int = MIN_COVERED,
    edges: int = EDGES,
) -> DecisionList:
    """Learn a decision list from ``text_statistics`` with a column ``quality``, 0 to reject and 1 to keep.

    Sequential covering: two thirds of the rows grow a conjunction of threshold
    conditions, one at a time by information gain, until it covers no good row;
    the rest prunes it to the prefix with the best precision estimate. A rule is
    taken if it covers at least ``min_covered`` bad rows of all and its precision
    on the pruning rows, with one good row added, reaches ``min_precision`` as
    far as their number allows; what it covers is removed before the next. All
    labelled rows count: each step is one aggregate over rows binned at
    quantiles, and the driver sees counts per feature and bin only. Rows with a
    null label are ignored; without rows of both labels nothing is rejected.
    """
    names = list(features())
    rows = labelled.where("quality IS NOT NULL").select(
        "quality", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("fold"), *[c.alias(k) for k, c in features().items()]
    )
    rows = stored(rows, "labelled")
    at = [i / edges for i in range(1, edges)]
    cuts = rows.groupBy((F.col("quality") == 0).alias("bad")).agg(*[F.percentile_approx(k, at, 10_000).alias(k) for k in names]).collect()
    if len(cuts) < 2:
        return DecisionList(())
    grid = {k: sorted({v for r in cuts for v in r[k]}) for k in names}

    def bin_of(k: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(v) for v in grid[k]]), lambda e: e <= F.col(k))).alias(k)

    binned = stored(
        rows.select(
            (F.col("quality") == 0).alias("bad"), "fold", *[bin_of(k) for k in names]
        ).groupBy("bad", "fold", *names).agg(F.count("*").alias("n")),
        "binned",
    )

    def test(c: Condition) -> Column:
        place = grid[c.feature].index(c.threshold)
        return F.col(c.feature) > place if c.above else F.col(c.feature) <= place

    def counts(df: DataFrame) -> tuple[int, int]:
        got = {r["bad"]: r["n"] for r in df.groupBy("bad").agg(F.sum("n").alias("n")).collect()}
        return got.get(True, 0), got.get(False, 0)

    def best(df: DataFrame, bad: int, good: int) -> tuple[Condition, int, int] | None:
        long = df.select("bad", "n", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("bin")) for k in names])).alias("f"))
        table_ = long.groupBy("f.k", "f.bin").agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n")).collect()
        per: dict[str, dict[int, tuple[int, int]]] = {k: {} for k in names}
        for r in table_:
            per[r["k"]][r["bin"]] = (r["bad"], r["n"] - r["bad"])
        found = None
        for k in names:
            below_bad = below_good = 0
            for place, threshold in enumerate(grid[k]):
                b, g = per[k].get(place, (0, 0))
                below_bad, below_good = below_bad + b, below_good + g
                for above, p, q in ((True, bad - below_bad, good - below_good), (False, below_bad, below_good)):
                    if p and (p, q) != (bad, good):
                        value = gain(p, q, bad, good)
                        if found is None or value > found[0]:
                            found = value, Condition(k, above, threshold), p, q
        return found and found[1:]

    rules: list[tuple[Condition, ...]] = []
    left = binned
    while len(rules) < max_rules:
        grow, prune = left.where("fold > 0"), left.where("fold = 0")
        bad, good = counts(grow)
        if bad < min_covered:
            break
        rule: list[Condition] = []
        steps: list[tuple[int, int, int, int]] = []
        while good and len(rule) < max_conditions:
            step = best(grow, bad, good)
            if step is None:
                break
            rule.append(step[0])
            grow, prune = grow.where(test(step[0])), prune.where(test(step[0]))
            bad, good = step[1:]
            steps.append((*counts(prune), bad, good))
        if not steps:
            break
        score = lambda s: ((s[0] - s[1]) / (s[0] + s[1] + 1), s[0])
        cut = max(range(len(steps)), key=lambda i: (*score(steps[i]), -i))
        held_bad, held_good, grown_bad, grown_good = steps[cut]
        rule = rule[: cut + 1]
        total_bad, total_good = held_bad + grown_bad, held_good + grown_good
        if total_bad < min_covered or total_bad < min_precision * (total_bad + total_good) or held_bad < min_precision * (held_bad + held_good):
            break
        rules.append(tuple(rule))
        left = left.where(~reduce(and_, [test(c) for c in rule]))
    return DecisionList(tuple(rules))


def gain(p: int, q: int, bad: int, good: int) -> float:
    """Bits that a condition saves on the bad rows it keeps."""
    from math import log2

    return p * (log2(p / (p + q)) - log2(bad / (bad + good)))


def base_failed() -> Column:
    """The fixed rules: too few words, or too many in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))


def quality_labels(labels: DataFrame) -> DataFrame:
    """One label per document; the lowest counts if it has several."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))


def quality_verdicts(docs: DataFrame, labels: DataFrame, keep: Sequence[str] = ("doc_id",), **options) -> DataFrame:
    """``keep`` columns of ``docs``, the text statistics, ``base_failed`` and ``kept``.

    Statistics are stored once; the rules are learned from all labelled rows and
    applied as one conditional expression. Without labels only the fixed rules count.
    """
    names = [c for c in keep if c != "doc_id"]
    renamed = {c: f"_keep_{c}" for c in names}
    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *[F.col(c).alias(renamed[c]) for c in names])
    measured = stored(text_statistics(picked, ["doc_id", *renamed.values()]), "statistics")
    rules = learn_rules(join_unique(measured, quality_labels(labels), "doc_id"), **options)
    judged = measured.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & rules.kept())
    return judged.withColumnsRenamed({v: k for k, v in renamed.items()})


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = quality_verdicts(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
