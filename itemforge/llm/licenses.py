"""License scans in DataFrame operations only: MinHash bands retrieve templates, exact shingle containment verifies them.

A text is read in overlapping windows of words, a template in windows that fit whole into one of them. One MinHash
of word pairs makes a band. Of a window of 12 words that holds a template window of m words, a band agrees with
probability (m - 1) / 11 at least, so BANDS bands retrieve it with probability 1 - (1 - (m - 1) / 11) ** BANDS:
0.998 for five words and over 0.99999 for eight. Verification asks for the share of the template's
word pairs that stand around the window in the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.common import SPACE, evaluated, table

WINDOW = 12
STRIDE = 4
#: Words of a template window: those that a text window holds whole wherever it starts.
TEMPLATE_WORDS = WINDOW - STRIDE
BANDS = 14
CONTAINMENT = 0.9


@dataclass(frozen=True)
class Template:
    license: str
    text: str


#: Notices as their licenses' publishers word them.
TEMPLATES = (
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    Template("MIT", "Released under the MIT License"),
    Template("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    Template("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    Template("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    Template("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    Template("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    Template("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    Template("BSD", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    Template("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    Template("Unlicense", "This is free and unencumbered software released into the public domain."),
    Template("CC0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    Template("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    Template("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    Template("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    Template("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def words(text: Column) -> Column:
    """Lower-case words without punctuation at their ends."""
    bare = F.regexp_replace(F.lower(text), rf"[.,;:!?\"'()]+(?=[{SPACE}]|$)|(?<![^{SPACE}])[\"'(]+", "")
    return F.filter(F.split(bare, rf"[{SPACE}]+"), lambda w: w != "")


def with_pairs(rows: DataFrame, keep: list[str], text: Column) -> DataFrame:
    """keep, n_words and pairs: hashes of the word pairs of a text; a single word is a pair by itself."""
    split = evaluated(rows, keep, w=words(text))
    hashed = evaluated(split, keep, each=F.transform("w", lambda x: F.xxhash64(x)))
    n = F.size("each")
    pairs = F.when(n < 2, F.col("each")).otherwise(F.zip_with(F.slice("each", 1, n - 1), F.slice("each", 2, n - 1), lambda a, b: F.xxhash64(a, b)))
    return evaluated(hashed, keep, n_words=n, pairs=pairs)


def _among(values: list[int]):
    return lambda h: h.isin(values)


def _under(k: int):
    return lambda h: F.xxhash64(h, F.lit(k))


def with_bands(rows: DataFrame, keep: list[str]) -> DataFrame:
    """keep, pairs, band and hashes: a row for each band, with the pairs under its hash function."""
    bands = F.array(*(F.struct(F.lit(k).alias("band"), F.transform("pairs", _under(k)).alias("hashes")) for k in range(BANDS)))
    return rows.select(*keep, "pairs", F.inline(bands))


def _templates(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    rows = spark.createDataFrame([(i, t.license, t.text) for i, t in enumerate(templates)], "template int, license string, body string")
    return with_pairs(rows, ["template", "license"], F.col("body"))


def _template_bands(found: DataFrame) -> DataFrame:
    """(template, at, band, key): the bands of every template window of TEMPLATE_WORDS words, or of a shorter template."""
    n = F.size("pairs")
    span = TEMPLATE_WORDS - 1
    starts = F.when(n <= span, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), n - span + 1))
    cut = with_bands(found, ["template"]).select("template", "band", "hashes", F.explode(starts).alias("at"))
    return cut.select("template", "at", "band", F.array_min(F.slice("hashes", F.col("at"), span)).alias("key"))


def retrieved(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, template, at, around): windows whose bands meet a template's, with the pairs that stand around them.

    The templates are a fixed tuple, so the keys that are looked for are bounded by its length.
    """
    spark = docs.sparkSession
    known = _templates(spark, templates)
    bands = _template_bands(known)
    rows = bands.select("band", "key").distinct().collect()
    # A band's key is the hash of a template's pair, so a text without any of these pairs meets no band.
    wanted = [r[0] for r in known.select(F.explode("pairs")).distinct().collect()]
    pairs = with_pairs(docs, [key], F.coalesce(F.col(text), F.lit(""))).filter(F.exists("pairs", _among(wanted)))
    starts = F.sequence(F.lit(1), F.size("pairs"), F.lit(STRIDE))
    mins = F.transform(starts, lambda s: F.struct(s.alias("at"), F.array_min(F.slice("hashes", s, WINDOW - 1)).alias("key")))
    met = F.filter(mins, lambda x: x["key"].isin([r[1] for r in rows]))
    # A window's least hash is a template's only if the hash is there at all, so other bands need no windows.
    of_band = F.when(F.lit(False), F.lit(False))
    for k in range(BANDS):
        of_band = of_band.when(F.col("band") == k, F.exists("hashes", _among([r[1] for r in rows if r[0] == k])))
    each = with_bands(pairs, [key]).filter(of_band).select(key, "pairs", "band", F.inline(met))
    found = bands.join(known.select("template", "n_words"), "template")
    named = each.join(F.broadcast(found.select("template", "n_words", F.col("at").alias("template_at"), "band", "key")), ["band", "key"])
    # The template's window stands at template_at, so the whole template stands so much earlier; edits may shift it by a quarter.
    slack = F.ceil(F.col("n_words") / 4).cast("int") + WINDOW
    first = F.greatest(F.lit(1), F.col("at") - F.col("template_at") - slack)
    return named.select(key, "template", F.col("at"), F.slice("pairs", first, F.col("n_words") + slack * 2).alias("around"))


def licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, containment: float = CONTAINMENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, license, template, containment, n_windows, first_word): the templates that each whole text holds.

    containment is the largest share of a template's different word pairs around a retrieved window. Null and empty texts
    hold none. Rows that share a key are one document; rows with a null key are one as well.
    """
    known = _templates(docs.sparkSession, templates).select("template", "license", F.array_distinct("pairs").alias("wanted"))
    shares = retrieved(docs, templates, text, key).join(F.broadcast(known), "template")
    share = F.size(F.array_intersect("wanted", "around")) / F.size("wanted")
    good = shares.select(key, "license", "template", "at", share.alias("share")).filter(F.col("share") >= containment)
    return good.groupBy(key, "license", "template").agg(F.max("share").alias("containment"), F.count_distinct("at").alias("n_windows"), (F.min("at") - 1).alias("first_word"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license notices of every document."""
    return licenses(table(spark, sf_dir, "documents"))
