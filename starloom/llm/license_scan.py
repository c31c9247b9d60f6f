"""License scan by diagonal voting [native].

All rolling k-grams of a text's words are hashed and joined to the positions
of the same k-grams in license templates. A match at text position d and
template position t votes for diagonal d - t: a whole notice puts all its votes
on one diagonal, or on neighbouring ones where words were put in or left out.
Votes are summed by diagonal, diagonals at most ``gap`` apart are merged, and a
merged span counts if it covers enough of the template, in little more room.

Words here are runs of letters and digits after lower-casing A-Z (every
character outside ASCII counts as a letter). Fixed phrases give base labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import KEY, lower_ascii, row_key, text_of, windows, word_hashes

K = 4
GAP = 3
MIN_COVER = 0.7
MAX_STRETCH = 1.5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Public notices, as their licences word them.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    (
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def scan_words(text: Column) -> Column:
    """The text's words. Only the first and the last piece can be empty."""
    parts = F.split(lower_ascii(text), SEPARATORS)
    head = F.when(F.get(parts, F.lit(0)) == "", F.lit(1)).otherwise(F.lit(0))
    tail = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), F.lit(1)).otherwise(F.lit(0))
    return F.slice(parts, head + F.lit(1), F.size(parts) - head - tail)


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """``gram``, ``template``, ``label``, ``t`` (position), ``n`` (positions in all).
    As large as the templates are; shorter ones than ``k`` words are refused."""
    table = spark.createDataFrame([(i, lab, txt) for i, (lab, txt) in enumerate(templates)], "template int, label string, txt string")
    hashed = table.select("template", "label", word_hashes(scan_words(F.col("txt"))).alias("h"))
    if hashed.filter(F.size("h") < k).limit(1).count():
        raise ValueError(f"a template needs at least {k} words")
    grams = hashed.select("template", "label", windows(F.col("h"), k).alias("g"))
    return grams.select("template", "label", F.size("g").alias("n"), F.posexplode("g").alias("t", "gram"))


def template_spans(
    rows: DataFrame, grams: DataFrame, *, k: int, gap: int, min_cover: float, max_stretch: float
) -> DataFrame:
    """``key_a``, ``key_b``, ``label``, ``first``, ``last`` (words), ``cover`` of every
    verified span. ``rows`` has the key and ``h`` (word hashes)."""
    # outer, as an inner explode filters on the size of g first, which would
    # work all windows out twice; a window that is too short matches nothing
    placed = rows.select(*KEY, windows(F.col("h"), k).alias("g")).select(
        *KEY, F.posexplode_outer("g").alias("d", "gram")
    )
    # the templates are a fixed parameter, not a table that grows with the data
    votes = placed.join(F.broadcast(grams), "gram")
    by_doc = [*KEY, "template", "label", "n"]
    diagonals = votes.groupBy(*by_doc, (F.col("d") - F.col("t")).alias("diagonal")).agg(
        F.collect_set("t").alias("ts"), F.min("d").alias("first"), F.max("d").alias("last")
    )
    along = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > gap, F.lit(True))
    grouped = diagonals.withColumn("fresh", fresh.cast("int")).withColumn("span", F.sum("fresh").over(along))
    spans = grouped.groupBy(*by_doc, "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("hit"),
        F.min("first").alias("first"),
        (F.max("last") + F.lit(k - 1)).alias("last"),
    )
    cover = F.col("hit") / F.col("n")
    room = F.col("last") - F.col("first") + 1
    return spans.filter(
        (cover >= min_cover) & (room <= (F.col("n") + F.lit(k - 1)) * F.lit(max_stretch))
    ).select(*KEY, "label", "first", "last", cover.alias("cover"))


def base_places(words: str, phrases=PHRASES) -> Column:
    """Array of (place, label), one for every place where a phrase stands."""
    w = F.col(words)

    def places(phrase: str, label: str) -> Column:
        want = phrase.split()

        def here(i: Column) -> Column:
            ok = F.lit(True)
            for j, x in enumerate(want):
                ok = ok & F.coalesce(F.get(w, i + F.lit(j)) == x, F.lit(False))
            return ok

        at = F.filter(F.sequence(F.lit(0), F.size(w)), here)
        return F.transform(at, lambda p: F.struct(p.alias("p"), F.lit(label).alias("l")))

    found = [places(*x) for x in phrases]
    some = F.lit(False)
    for last in sorted({p.split()[-1] for p, _ in phrases}):
        some = some | F.array_contains(w, last)
    return F.when(some, F.concat(*found)).otherwise(F.array().cast("array<struct<p:int,l:string>>"))


def scan_licenses(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates=TEMPLATES,
    phrases=PHRASES,
    k: int = K,
    gap: int = GAP,
    min_cover: float = MIN_COVER,
    max_stretch: float = MAX_STRETCH,
) -> DataFrame:
    """One row per document: ``id``, ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``labels``, ``score``, ``spans``.

    ``spans`` has (label, first, last, cover) of the verified template spans, words
    counted from 0; ``score`` is the largest cover, 0 without a span. Null text is
    empty: no words, no labels. A null id is a value like any other, repeated rows
    get equal results, an empty table an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), *row_key(id_col, text_col))
    hashed = rows.select(*KEY, word_hashes(scan_words(F.col("text"))).alias("h"))
    grams = template_grams(docs.sparkSession, templates, k)
    spans = template_spans(hashed, grams, k=k, gap=gap, min_cover=min_cover, max_stretch=max_stretch)
    span = F.struct("label", "first", "last", "cover")
    # equal rows have found the same spans; a set keeps one of each
    found = spans.groupBy(*KEY).agg(F.collect_set(span).alias("spans"))
    base = rows.select("id", *KEY, scan_words(F.col("text")).alias("w")).select(
        "id", *KEY, F.size("w").cast("bigint").alias("n_words"), base_places("w", phrases).alias("at")
    )
    joined = base.join(found, KEY, "left")
    own = F.array_distinct(F.transform("at", lambda x: x["l"]))
    more = F.coalesce(F.transform("spans", lambda x: x["label"]), F.array().cast("array<string>"))
    place = F.transform("at", lambda x: x["p"])
    return joined.select(
        "id",
        "n_words",
        F.size("at").cast("bigint").alias("n_base"),
        F.array_min(place).cast("bigint").alias("first_word"),
        F.array_max(place).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(own), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, more)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda x: x["cover"])), F.lit(0.0)).alias("score"),
        F.coalesce(F.sort_array("spans"), F.array().cast("array<struct<label:string,first:int,last:int,cover:double>>")).alias("spans"),
    )


def op9_query(spark: SparkSession, root: str) -> DataFrame:
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs).withColumnRenamed("id", "doc_id").drop("spans")
