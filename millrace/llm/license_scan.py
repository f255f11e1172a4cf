"""Licence scan by a positional index of rare tokens, native DataFrame operations only.

Every template is a short passage of a licence, with phrases that must be there.  Its content words are indexed
with their positions and weighed by how rare they are among the documents (inverse document frequency).

1.  One pass over the texts keeps, per document, the places of licence words and of phrases.
2.  Look-up: a document that holds at least ``need`` of a template's weight holds one of its rarest words, those
    that together weigh more than the rest of the weight allows to miss.  Only such pairs go on.
3.  Positions: a word at place p of the text and q of the template votes for the template to begin at p - q.
    Votes that lie within ``slack`` of each other count together, so a word more or less does no harm.
4.  Verification: where the votes have enough weight, each of the template's key phrases must stand within the
    passage.

No document, word or template is left out for being frequent: a template's words are ranked, not cut, and
the document's rows are spread by (row, template, place).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import store

# What lies between words (ASCII but digits and a-z), and words that no index needs.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STOP = ("a all an and any are as at be by for from if in is it its not of on or such that the this to under with you "
        "0 1 2 3 4").split()


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: tuple[str, ...]


# Phrases whose places count as base, with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Passages that public licences ask to be put into files, and their key phrases.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
             "http www apache org licenses license 2 0", ("apache org licenses",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("general public license", "version 3")),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
             "general public license as published by the free software foundation", ("general public license", "free software")),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license", ("lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files to deal in the software without restriction", ("permission is hereby granted",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
             "following conditions are met", ("source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
             "granted", ("permission to use copy modify",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license",
             ("eclipse public license",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this "
             "work", ("waived all copyright",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("public domain",)),
)


def _spaced(text: Column) -> Column:
    """Words with one space between, before and after them.

    Other letters than A-Z may become lower-case too: no such letter becomes an ASCII one, since the one that
    would (the Kelvin sign) is put away first.
    """
    low = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, BETWEEN, " ")), F.lit(" "))


def _places(words: Column, spaced: Column, phrase: str) -> Column:
    """Where the words of a phrase stand one behind another."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        fits = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            fits = fits & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return fits

    found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
    return F.when(spaced.contains(f" {phrase} "), found).otherwise(F.array().cast("array<int>"))


def template_postings(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """template, label, place and word of every content word of every template, its length and number of key phrases."""
    rows = [
        (k, t.label, place, word, len(t.text.split()), len(set(t.key)))
        for k, t in enumerate(templates) for place, word in enumerate(t.text.split()) if word not in STOP]
    return spark.createDataFrame(rows, "template int, label string, place int, word string, length int, keys int")


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    base: Sequence[tuple[str, str]] = BASE,
    need: float = 0.75,
    slack: int = 2,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: ``id``, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII.  ``base`` phrases are found at every
    place; n_base counts the places, first_word and last_word are the least and greatest word they begin at, from 0,
    else NULL.  A template adds its label where content words that hold ``need`` of its weight stand in
    its order, up to ``slack`` words off, and its key phrases within.  ``score`` is 1 with a base label, else the greatest
    share of weight of a template found, 0 without.  A word's weight is ln((N + 1) / (documents with it + 1)) + 1.

    NULL texts count as empty: no words, no places, empty labels, score 0.  Every row counts by itself, repeated rows and
    NULL ids too.  No rows give an empty result.  Extra columns aren't read.
    """
    spark = docs.sparkSession
    keys = sorted({k for t in templates for k in t.key})
    phrases = [p for p, _ in base] + keys
    postings = store(template_postings(spark, templates), "postings")
    vocabulary = sorted({w for t in templates for w in t.text.split()} - set(STOP))

    spaced = docs.select(F.col(id).alias("id"), _spaced(F.col(text)).alias("spaced"))
    words = spaced.select("id", "spaced", F.when(F.col("spaced") == "  ", F.array().cast("array<string>")).otherwise(
        F.split(F.trim("spaced"), " ")).alias("words"))
    licence = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))),
                       lambda x: x["word"].isin(vocabulary))
    rows = words.select(
        "id", F.size("words").cast("long").alias("n_words"), licence.alias("hits"),
        F.array(*[_places(F.col("words"), F.col("spaced"), p) for p in phrases]).alias("places"))
    rows = store(rows.withColumn("row", F.monotonically_increasing_id()), "licence-words")

    # Weights: one row per licence word, however large the corpus.
    held = rows.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    n = rows.agg(F.count(F.lit(1)).alias("n"))
    weight = F.log((n.select("n").scalar() + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    weighed = postings.join(held, "word", "left").withColumn("weight", weight)
    mass = weighed.groupBy("template").agg(F.sum("weight").alias("mass"))
    weighed = store(weighed.join(mass, "template"), "weights")
    # Rarest words first: as long as what comes before them is no more than a document may miss.
    more = weighed.select(F.col("template"), F.col("place").alias("other"), F.col("weight").alias("more"))
    ahead = weighed.join(more, "template").where(
        (F.col("more") > F.col("weight")) | ((F.col("more") == F.col("weight")) & (F.col("other") < F.col("place"))))
    ahead = ahead.groupBy("template", "place").agg(F.sum("more").alias("ahead"))
    index = weighed.join(ahead, ["template", "place"], "left").withColumn(
        "rare", F.coalesce("ahead", F.lit(0.0)) <= F.col("mass") * (1 - need) * (1 + 1e-9))

    hits = rows.where(F.size("hits") > 0).select("row", F.inline("hits"))
    looked = hits.select("row", "word").distinct().join(index.where("rare").select("word", "template").distinct(), "word")
    looked = looked.select("row", "template").distinct()
    votes = hits.join(index, "word").join(looked, ["row", "template"]).select(
        "row", "template", "label", "place", "weight", "mass", "length", "keys", (F.col("pos") - F.col("place")).alias("begin"))
    # A vote counts for each beginning up to slack behind it: votes within slack of each other meet.
    votes = votes.select("*", F.explode(F.sequence(F.col("begin"), F.col("begin") + slack)).alias("at"))
    agreed = votes.groupBy("row", "template", "label", "length", "keys", "mass", "at", "place").agg(F.first("weight").alias("weight"))
    agreed = agreed.groupBy("row", "template", "label", "length", "keys", "mass", "at").agg(F.sum("weight").alias("found"))
    agreed = agreed.withColumn("share", F.least(F.col("found") / F.col("mass"), F.lit(1.0))).where(F.col("share") >= need * (1 - 1e-9))

    must = spark.createDataFrame([(k, phrases.index(p, len(base)) + 1) for k, t in enumerate(templates) for p in sorted(set(t.key))],
                                 "template int, phrase int")
    marks = rows.where(F.exists(F.slice("places", len(base) + 1, len(keys)), lambda p: F.size(p) > 0)).select(
        "row", F.posexplode("places").alias("k", "at_all")).select(
        "row", (F.col("k") + 1).alias("phrase"), F.explode("at_all").alias("stands"))
    verified = (
        agreed.join(must, "template").join(marks, ["row", "phrase"])
        .where(F.col("stands").between(F.col("at") - slack - 1, F.col("at") + F.col("length") + slack))
        .groupBy("row", "template", "label", "keys", "at", "share").agg(F.count_distinct("phrase").alias("seen"))
        .where("seen = keys")
    )
    found = verified.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))

    mine = F.slice("places", 1, len(base))
    every = F.flatten(mine)
    labelled = F.filter(F.array(*[
        F.when(F.size(F.get("places", F.lit(k))) > 0, label) for k, (_, label) in enumerate(base)]), lambda x: x.isNotNull())
    told = rows.join(found, "row", "left").select(
        F.col("id"), "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"), labelled.alias("own"),
        F.coalesce("more", F.array().cast("array<string>")).alias("more"), F.coalesce("share", F.lit(0.0)).alias("share"))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return told.select(
        F.col("id").alias(id), "n_words", "n_base", "first_word", "last_word", joined(F.col("own")).alias("base_labels"),
        joined(F.concat("own", "more")).alias("labels"),
        F.when(F.size("own") > 0, 1.0).otherwise(F.round("share", 9)).alias("score"))
