"""License scan by diagonal voting.

All rolling word k-grams of the documents are hashed and joined to the positions of the same k-grams in the license
templates. A hit votes for the diagonal (document position minus template position) on which the template would start.
Neighbouring diagonals, which small insertions and deletions make, are merged into one span; a span is verified by the
share of the template's words that its hits cover, word by word, and by its density.

Two kinds of templates: phrases must stand whole on one diagonal; notices may be changed in some words.

Defined cases: a NULL or empty text has no words and no hits; rows with the same id and text have the same result each;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freightlane.llm.common import text_of, tokens_of

# Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Opening and core sentences of public license notices, as lower-case words.
NOTICES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"
    ),
    "apache": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
        " with the license you may obtain a copy of the license at"
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation either version 3 of the license or at your"
        " option any later version"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met"
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was"
        " not distributed with this file you can obtain one at"
    ),
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
}
NOTICE_GRAM = 4
#: Diagonals so near each other are one span, and so many of a notice's words must be covered.
MERGE_DIAGONALS = 3
COVERAGE = 0.6


def templates(spark, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row per k-gram of a template: template, label, phrase, k, n_words, at, grams (its words) and the key to join by.

    The table has as many rows as the templates have words. Phrases have bigrams, notices NOTICE_GRAM words.
    """
    rows = []
    for phrase, texts in ((True, phrases.items()), (False, ((v, k) for k, v in notices.items()))):
        for number, (text, label) in enumerate(texts):
            words, k = text.split(), 2 if phrase else NOTICE_GRAM
            name = f"{'phrase' if phrase else 'notice'} {number}"
            rows += [(name, label, phrase, k, len(words), at, words[at : at + k]) for at in range(len(words) - k + 1)]
    schema = "template string, label string, phrase boolean, k int, n_words int, at int, grams array<string>"
    grams = spark.createDataFrame(rows, schema)
    word = lambda i: F.get("grams", F.lit(i))
    keys = {k: _key(k, word) for k in (2, NOTICE_GRAM)}
    return grams.withColumn("key", F.when(F.col("k") == 2, keys[2]).otherwise(keys[NOTICE_GRAM]))


def _key(k: int, word) -> Column:
    return F.xxhash64(F.lit(k), *[word(i) for i in range(k)])


def hits(docs: DataFrame, grams: DataFrame, id_column: str, text: str) -> DataFrame:
    """id, print (of the text), label, phrase, template, n_words, diagonal, at: one row per k-gram that stands in a template."""
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.xxhash64(text_of(text)).alias("print"), tokens_of(text_of(text)).alias("words")
    ).filter(F.size("words") > 1)
    places = rows.withColumn("place", F.explode(F.sequence(F.lit(0), F.size("words") - 2)))
    word = lambda i: F.get("words", F.col("place") + i)
    # A gram that runs over the end has a NULL word, and the words are compared below: it matches nothing.
    keyed = places.withColumn("key", F.explode(F.array(_key(2, word), _key(NOTICE_GRAM, word))))
    met = keyed.join(F.broadcast(grams.withColumnRenamed("key", "template_key")), F.expr("key = template_key"))
    same = F.col("grams") == F.slice("words", F.col("place") + 1, F.col("k"))
    return met.filter(same).select(
        "id", "print", "template", "label", "phrase", "n_words", "k", "at", (F.col("place") - F.col("at")).alias("diagonal")
    )


def spans(found: DataFrame) -> DataFrame:
    """id, print, label, phrase, first_word (where the span starts), coverage: the verified spans.

    Votes are counted per diagonal before diagonals are brought together, so a group holds the diagonals of one
    document and template only.
    """
    votes = found.groupBy("id", "print", "template", "label", "phrase", "n_words", "k", "diagonal").agg(
        F.collect_set("at").alias("ats")
    )
    same = ("id", "print", "template", "label", "phrase", "n_words", "k")
    by_diagonal = Window.partitionBy(*same).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    own = F.col("phrase") | apart.isNull() | (apart > MERGE_DIAGONALS)
    groups = votes.withColumn("span", F.sum(own.cast("int")).over(by_diagonal))
    merged = groups.groupBy(*same, "span").agg(
        F.min("diagonal").alias("first_word"),
        F.max("diagonal").alias("last_diagonal"),
        F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"),
    )
    steps = F.expr("sequence(0, k - 1)")
    covered = F.array_distinct(F.flatten(F.transform("ats", lambda a: F.transform(steps, lambda j: a + j))))
    length = F.array_max("ats") - F.array_min("ats") + F.col("k") + F.col("last_diagonal") - F.col("first_word")
    measured = merged.withColumns({
        "coverage": F.size(covered) / F.col("n_words"),
        "density": F.size(covered) / length,
        "start": F.col("first_word") + F.when(F.col("phrase"), 0).otherwise(F.array_min("ats")),
    })
    good = F.when(F.col("phrase"), F.col("coverage") == 1).otherwise((F.col("coverage") >= COVERAGE) & (F.col("density") >= COVERAGE))
    return measured.filter(good).select("id", "print", "label", "phrase", F.col("start").cast("long").alias("first_word"), "coverage")


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
) -> DataFrame:
    """One row per document: its id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The base are the phrases; the score is the largest share of a template's words that a span covers, 0 without a span.
    """
    grams = templates(docs.sparkSession, phrases, notices)
    verified = spans(hits(docs, grams, id_column, text))
    joined = lambda labels: F.array_join(F.array_sort(F.collect_set(labels)), ",")
    facts = verified.groupBy("id", "print").agg(
        F.count_if("phrase").alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("first_word"))).alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first_word"))).alias("last_word"),
        joined(F.when(F.col("phrase"), F.col("label"))).alias("base_labels"),
        joined("label").alias("labels"),
        F.max("coverage").alias("score"),
    )
    rows = docs.select(
        F.col(f"`{id_column}`").alias("own_id"),
        F.xxhash64(text_of(text)).alias("own_print"),
        F.size(tokens_of(text_of(text))).cast("long").alias("n_words"),
    )
    out = rows.join(facts, F.expr("own_id <=> id AND own_print = print"), "left")
    return out.select(
        F.col("own_id").alias(id_column),
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
