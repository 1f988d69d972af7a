"""License scans by diagonal voting: word pairs joined to template positions, summed by offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordloom.llm.tables import cut_lineage

#: The phrases of the base and their labels.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
#: Passages of well-known licenses that the method labels in addition, of any length.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (
        "apache-2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions "
        "and limitations under the license",
    ),
    (
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or other materials provided with the distribution",
    ),
    (
        "gpl-notice",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose see the gnu general public license for more details",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the "
        "above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
        "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute "
        "sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following "
        "conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Share of a template's word pairs that a merged span must hold to give its label.
LEAST_COVER = 0.8
#: Places by which neighbouring diagonals may differ, and the end of a span and the start of the next.
SLACK = 3
#: Places of a template that share one bit mask; a longer template has a mask for each part.
MASK_BITS = 60
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: str) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(_WORD), F.lit(0))


def template_positions(spark) -> DataFrame:
    """``gram, part, bit, tw, tv, template, label, base, pairs, at``: a row per word pair of a template. Fixed and small."""
    rows = [(i, label, i < len(PHRASES), text) for i, (label, text) in enumerate(PHRASES + TEMPLATES)]
    words = spark.createDataFrame(rows, "template int, label string, base boolean, text string").withColumn("words", F.split("text", " "))
    place = words.select("template", "label", "base", (F.size("words") - 1).alias("pairs"), "words", F.explode(F.sequence(F.lit(0), F.size("words") - 2)).alias("at"))
    found = place.select("template", "label", "base", "pairs", "at", F.get("words", F.col("at")).alias("tw"), F.get("words", F.col("at") + 1).alias("tv"))
    at = F.col("at")
    return found.withColumns({"gram": F.xxhash64("tw", "tv"), "part": F.floor(at / MASK_BITS).cast("int"), "bit": F.expr(f"shiftleft(1L, at % {MASK_BITS})")})


def spans(docs: DataFrame) -> DataFrame:
    """Verified spans ``doc_id, h, template, label, base, first, last, cover`` of all texts.

    All rolling word pairs of all texts meet the template positions in a broadcast join (the
    templates are a fixed table of this module) and are confirmed on the words themselves. Hits
    are summed by diagonal (place in the text less place in the template) as bit masks of
    template positions, before the only shuffle. A phrase of the base is found where its
    diagonal is complete. For the other templates diagonals of nearly the same offset are
    gathered first, so a word pair that the template repeats does not come between them; those of
    a gathering that follow each other closely are merged, which bridges words put in or left out.
    """
    word = docs.select("doc_id", F.xxhash64("text").alias("h"), plain_words("text").alias("words"))
    pair = F.transform("words", lambda w, i: F.struct(w.alias("w"), F.get("words", i + 1).alias("v")))
    rolled = word.select("doc_id", "h", F.posexplode(pair).alias("pos", "p"))
    hit = rolled.withColumn("gram", F.xxhash64("p.w", "p.v")).join(F.broadcast(template_positions(docs.sparkSession)), "gram").where("p.w = tw AND p.v = tv")
    key = ["doc_id", "h", "template", "label", "base", "pairs"]
    diagonal = hit.groupBy(*key, (F.col("pos") - F.col("at")).alias("diagonal"), "part").agg(
        F.bit_or("bit").alias("mask"), F.min("pos").alias("first"), F.max(F.col("pos") + 1).alias("last")
    )
    diagonal = cut_lineage(diagonal, "llm-diagonals")  # few rows, read twice
    whole = diagonal.where("base").groupBy(*key, "diagonal").agg(F.sum(F.bit_count("mask")).alias("votes"), F.max("last").alias("last")).where("votes = pairs")
    base = whole.select("doc_id", "h", "template", "label", "base", F.col("diagonal").alias("first"), "last", F.lit(1.0).alias("cover"))
    near = Window.partitionBy("doc_id", "h", "template").orderBy("diagonal", "part")
    apart = F.col("diagonal") > F.lag("diagonal").over(near) + SLACK
    gathered = diagonal.where("NOT base").withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("near", F.sum("apart").over(near))
    place = Window.partitionBy("doc_id", "h", "template", "near").orderBy("first", "diagonal", "part")
    fresh = F.col("first") > F.max("last").over(place.rowsBetween(Window.unboundedPreceding, -1)) + SLACK
    grouped = gathered.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int")).withColumn("span", F.sum("fresh").over(place))
    parts = grouped.groupBy(*key, "near", "span", "part").agg(F.bit_count(F.bit_or("mask")).alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    merged = parts.groupBy(*key, "near", "span").agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    merged = merged.select("doc_id", "h", "template", "label", "base", "first", "last", (F.col("votes") / F.col("pairs")).alias("cover"))
    return base.unionByName(merged)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts all places where a phrase of the base stands, ``first_word`` and
    ``last_word`` are the smallest and largest start of one, null if there is none. ``labels``
    also has those of the other templates that a span covers to ``LEAST_COVER``; ``score`` is the
    best cover of any template. Null text has no words; an empty table gives no rows. Rows with the same id and text have the
    same result each; null ids are kept. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    found = spans(docs).groupBy("doc_id", "h").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set(F.when(F.col("cover") >= LEAST_COVER, F.col("label")))).alias("labels"),
        F.max("cover").alias("score"),
    ).withColumnsRenamed({"doc_id": "id", "h": "g"})
    sized = docs.select("doc_id", F.xxhash64("text").alias("h"), F.size(plain_words("text")).cast("long").alias("n_words"))
    joined = sized.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("g")), "left")
    text = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        text("base_labels").alias("base_labels"), text("labels").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
