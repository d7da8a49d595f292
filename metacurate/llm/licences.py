"""Licence scan over a positional index of rare licence words. DataFrame functions only.

Every template is a short passage with a label and a key phrase that has to be
there word for word. Document frequencies of the templates' words are counted
over all files; the two rarest words of a key phrase are its anchors. In each file
the postings of both anchors, shifted by their place in the template, are
intersected, which leaves the places where the template can stand. A place holds
if the key phrase stands there and the words that agree carry enough weight.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metacurate.llm.registry import query, table
from metacurate.operators.checkpoints import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str  # words in lower case, one space between
    key: str  # part of the text that must stand there whole
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_places(self) -> range:
        words, key = self.words, self.key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        return range(at, at + len(key))


# The phrases every scan looks for, each a template that is all key.
BASE = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
)

# Customary sentences of licence notices.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("mit", "released under the terms of the mit license", "mit license"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "general public license version 2"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    Template("agpl-3", "under the terms of the gnu affero general public license", "affero general public license"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    Template("cc0", "creative commons cc0 1 0 universal public domain dedication", "cc0 1 0"),
    Template("proprietary", "all rights reserved", "all rights reserved"),
)
MIN_WEIGHT = 0.6


def licence_words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; null has none."""
    folded = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(folded, NO_WORD), "")


def inverse_frequencies(postings: DataFrame, vocabulary: Sequence[str]) -> dict[str, float]:
    """``ln(1 + files / (1 + files with the word))`` of each template word, over all files."""
    counted = (
        postings.select(F.explode(F.array_distinct("hits.w")).alias("w")).groupBy("w").count().collect()
    )  # at most one row for each word of the templates
    files, seen = postings.count(), {r["w"]: r["count"] for r in counted}
    return {w: math.log(1 + files / (1 + seen.get(w, 0))) for w in vocabulary}


def _places(t: Template, idf: dict[str, float], min_weight: float) -> Column:
    """Start and weight of each place of a template; ``hits`` are its postings, ``kept`` the template words by position.

    Every hit is touched once an anchor and every possible place once, whatever their number.
    """
    words, key = t.words, t.key_places
    total = sum(idf[w] for w in words) or 1.0
    anchors = sorted(key, key=lambda i: (-idf[words[i]], i))[:2]

    def starts(i: int) -> Column:
        return F.transform(F.filter("hits", lambda h: (h["w"] == words[i]) & (h["p"] >= i)), lambda h: h["p"] - i)

    possible = F.array_distinct(starts(anchors[0]))
    for i in anchors[1:]:
        possible = F.array_intersect(possible, starts(i))

    def place(s: Column) -> Column:
        agrees = [F.get("kept", s + j) == w for j, w in enumerate(words)]
        weight = reduce(add, [F.when(a, idf[w] / total).otherwise(0.0) for a, w in zip(agrees, words, strict=True)])
        return F.struct(s.alias("start"), F.when(reduce(and_, [agrees[j] for j in key]), F.least(weight, F.lit(1.0))).otherwise(0.0).alias("weight"))

    least = 0.0 if t.base else min_weight
    return F.filter(F.transform(possible, place), lambda x: (x["weight"] > 0) & (x["weight"] >= least))


def scan_licences(
    docs: DataFrame, templates: Sequence[Template] = BASE + NOTICES, min_weight: float = MIN_WEIGHT
) -> DataFrame:
    """Licences of ``docs(doc_id, text)``: places of the base phrases, labels, and a score.

    One row per row of ``docs``. ``places`` has ``label, start, weight, base`` of
    every place, in text order. Null and empty texts have no words and no places;
    overlapping places and repeats all count. ``score`` is the weight of the best
    place, 0 without any. Postings hold template words only and are stored once.
    Null ids are kept and repeated rows scanned alike; the work grows linearly
    with a text, also where it is full of licence phrases.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    words = docs.select(F.col("doc_id").cast("bigint"), licence_words(F.col("text")).alias("words"))
    kept = F.transform("words", lambda w: F.when(w.isin(vocabulary), w))
    placed = F.transform("kept", lambda w, i: F.struct(w.alias("w"), i.alias("p")))
    indexed = stored(words.select("doc_id", F.size("words").cast("bigint").alias("n_words"), kept.alias("kept")), "licence_postings")
    postings = indexed.select("*", F.filter(placed, lambda x: x["w"].isNotNull()).alias("hits"))
    idf = inverse_frequencies(postings, vocabulary)

    def named(t: Template) -> Column:
        return F.transform(
            _places(t, idf, min_weight),
            lambda x: F.struct(x["start"].cast("bigint").alias("start"), F.lit(t.label).alias("label"), x["weight"].alias("weight"), F.lit(t.base).alias("base")),
        )

    each = [named(t) for t in templates]
    found = postings.select("doc_id", "n_words", F.sort_array(F.flatten(F.array(*each))).alias("places"))
    base = found.withColumn("base_places", F.filter("places", lambda x: x["base"]))
    labels = lambda c: F.array_join(F.sort_array(F.array_distinct(F.col(c)["label"])), ",")
    return base.select(
        "doc_id", "n_words", "places",
        F.size("base_places").cast("bigint").alias("n_base"),
        F.array_min(F.col("base_places")["start"]).alias("first_word"),
        F.array_max(F.col("base_places")["start"]).alias("last_word"),
        labels("base_places").alias("base_labels"),
        labels("places").alias("labels"),
        F.coalesce(F.array_max(F.col("places")["weight"]), F.lit(0.0)).alias("score"),
    )


@query("op3_licence_scan")
def op3_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licences(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
