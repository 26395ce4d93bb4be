"""License notices in documents, by MinHash bands over overlapping windows of text.

All of it are DataFrame operations. A text is lower-cased and cut into words of letters and
digits; its shingles are runs of five words. For a template of m shingles, windows of
``m + step - 1`` shingles start at every ``step`` (a quarter of m): any occurrence lies whole in
one of them. A band is one minimum of the window's shingle hashes under one order (the hash
xor'ed with the band's constant), and a window retrieves a template if they agree in a band.

A window that holds ``CONTAINED`` of a template's shingles has a Jaccard similarity to it of at
least ``CONTAINED * m / (window + m - CONTAINED * m)``, and agrees in each band with that
probability; the number of bands is chosen so that all of them miss with less than ``MISS``.
Candidates are then verified by counting the template's shingles in the window.

A window can agree in a band only if it holds the template's minimum, so minima are taken of the
windows around those few shingles alone. The templates are a list of the library, a few hundred
band keys in all; nothing that grows with the documents is broadcast.

A notice of fewer than five words has no shingle; it is a phrase, found wherever its words stand
in a row, and comes back in columns of its own.

Defined results: null and empty texts have no notice, and texts of fewer than five words none but
phrases. Repeated rows have a row each. A template of fewer than five words is an error.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expr import col
from tabulon.session import stored

SHINGLE = 5
CONTAINED = 0.75
#: Largest probability that a window holding enough of a template agrees with it in no band.
MISS = 1e-6

#: Names and texts of notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
        "express or implied."),
    "mit": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation"),
    "lgpl-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation"),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted"),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
                 "License",
    "unlicense": "This is free and unencumbered software released into the public domain",
}

#: The same for notices of fewer than five words.
PHRASES = {"all-rights-reserved": "All rights reserved"}

_SPANS = "array<struct<template: string, at: int, held: int>>"
_NOT_WORD = "[^\\p{L}\\p{N}]+"


def template_words(text: str) -> list[str]:
    """The words of a template, by the same rule as those of a document."""
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _NOT_WORD), lambda w: w != "")


def shingles(word_array: str) -> Column:
    """Hashes of all runs of ``SHINGLE`` words, in order."""
    each = ", ".join(f"{word_array}[i + {k}]" for k in range(SHINGLE))
    return F.expr(f"case when size({word_array}) >= {SHINGLE} then transform(sequence(0, "
                  f"size({word_array}) - {SHINGLE}), i -> xxhash64({each})) "
                  f"else cast(array() as array<bigint>) end")


def step_of(m: int) -> int:
    return max(1, m // 4)


def bands_for(m: int, contained: float = CONTAINED, miss: float = MISS) -> int:
    """Bands that miss a window holding ``contained`` of m shingles with at most ``miss``."""
    held = math.ceil(contained * m)
    similarity = held / (m + step_of(m) - 1 + m - held)
    return 1 if similarity >= 1 else math.ceil(math.log(miss) / math.log(1 - similarity))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(template, m, step, width, shingles, bands): one row per template."""
    rows = []
    for name, text in templates.items():
        w = template_words(text)
        if len(w) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        rows.append((name, w))
    table = (spark.createDataFrame(rows, "template string, words array<string>")
             .withColumn("shingles", F.array_distinct(shingles("words"))))
    sizes = {r["template"]: r["m"] for r in
             table.select("template", F.size("shingles").alias("m")).collect()}
    numbers = spark.createDataFrame(
        [(n, m, step_of(m), m + step_of(m) - 1, bands_for(m)) for n, m in sizes.items()],
        "template string, m int, step int, width int, bands int")
    return table.select("template", "shingles").join(numbers, "template")


def _order(band: str) -> str:
    """SQL: the constant that a band's order is xor'ed with."""
    return f"xxhash64({band}, 'band')"


def band_keys(table: DataFrame) -> DataFrame:
    """(template, ..., band, key, least): the shingle that is least in each band's order."""
    return (table.withColumn("band", F.explode(F.sequence(F.lit(1), "bands")))
            .withColumn("mask", F.expr(_order("band")))
            .withColumn("least", F.array_min(F.transform("shingles",
                                                         lambda x: x.bitwiseXOR(F.col("mask")))))
            .withColumn("key", F.col("least").bitwiseXOR(F.col("mask"))))


def _phrase_spans(phrases: dict[str, str], word_array: str) -> Column:
    """(template, at, held) wherever the words of a phrase stand in a row; ``held`` is 1."""
    def places(name: str, w: list[str]) -> Column:
        # Behind the end of the array ``get`` gives null, which is no match.
        at = F.filter(F.sequence(F.lit(0), F.greatest(F.size(word_array) - len(w), F.lit(0))),
                      lambda i: reduce(and_, (F.get(word_array, i + k) == F.lit(x)
                                              for k, x in enumerate(w))))
        return F.transform(at, lambda i: F.struct(
            F.lit(name).alias("template"), i.alias("at"), F.lit(1).alias("held")))

    found = {name: template_words(text) for name, text in phrases.items()}
    for name, w in found.items():
        if not w:
            raise ValueError(f"phrase {name} has no words")
    return F.sort_array(F.concat(F.expr(f"cast(array() as {_SPANS})"),
                                 *[places(name, w) for name, w in found.items()]))


def notices(docs: DataFrame, templates: dict[str, str] | None = None, text: str = "text",
            id_column: str = "doc_id", phrases: dict[str, str] | None = None) -> DataFrame:
    """Per document: id, ``n_words``, ``licenses`` (sorted names), ``spans``, and the same of
    short notices as ``phrases`` and ``phrase_spans``.

    A span is (template, at, held): the window's first shingle and how many of the template's
    shingles it holds; of overlapping windows that hold a template each has a span. That of a
    phrase is its first word.
    """
    short = _phrase_spans(PHRASES if phrases is None else phrases, "_w")
    spark = docs.sparkSession
    keys = stored(band_keys(template_table(spark, templates or TEMPLATES)), "band_keys")
    wanted = [r["key"] for r in keys.select("key").distinct().collect()]   # bounded by the list
    literals = F.array(*[F.lit(k) for k in wanted])
    hashed = (docs.select(F.col(id_column).alias("_id"), words(col(text)).alias("_w"))
              .select("_id", F.size("_w").alias("n_words"), shingles("_w").alias("_h"),
                      short.alias("phrase_spans")))
    base = stored(hashed.select(
        "_id", "n_words", "phrase_spans", F.when(F.arrays_overlap("_h", literals), F.col("_h")).alias("_h"))
        .withColumn("_row", F.monotonically_increasing_id()), "shingles")
    at = F.filter(F.transform("_h", lambda x, i: F.when(x.isin(wanted), i)),
                  lambda i: i.isNotNull())
    hits = (base.where("_h is not null").select("_row", "_h", F.explode(at).alias("_at"))
            .withColumn("key", F.expr("_h[_at]")))
    around = (hits.join(F.broadcast(keys), "key")
              .withColumn("_k", F.explode(F.expr(
                  "sequence(greatest(0, cast(ceil((_at - width + 1) / step) as int)), "
                  "cast(floor(_at / step) as int))")))
              .withColumn("_window", F.expr("slice(_h, _k * step + 1, width)")))
    agreeing = around.where(
        F.array_min(F.transform("_window", lambda x: x.bitwiseXOR(F.col("mask"))))
        == F.col("least"))
    verified = (agreeing.withColumn("held", F.size(F.array_intersect("shingles", "_window")))
                .where(f"held >= {CONTAINED} * m")
                .select("_row", "template", (F.col("_k") * F.col("step")).alias("at"), "held")
                .distinct())
    spans = verified.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("template", "at", "held"))).alias("spans"))
    empty = F.expr(f"cast(array() as {_SPANS})")
    return (base.select("_row", "_id", "n_words", "phrase_spans").join(spans, "_row", "left")
            .withColumn("spans", F.coalesce("spans", empty))
            .select(F.col("_id").alias(id_column), "n_words",
                    F.array_sort(F.array_distinct("spans.template")).alias("licenses"), "spans",
                    F.array_sort(F.array_distinct("phrase_spans.template")).alias("phrases"),
                    "phrase_spans"))
