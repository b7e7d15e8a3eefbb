"""License scan with MinHash bands and exact containment, in DataFrame functions only.

Words are runs of a-z and 0-9 of the lower-cased text; a shingle is five words.  A text is covered by windows of
``WINDOW_WORDS`` words that begin every ``STRIDE`` words and overlap by as much.  A window's MinHash has ``BANDS`` values, each
the least of its shingles' hashes under another permutation (exclusive-or with a constant).  A band is one value.  Templates are
covered by windows at every word, so a window that lies in a copied template has an equal one there.

A window and a template window with Jaccard similarity s share a band with probability 1 - (1 - s) ** BANDS.  A whole window
inside a copy collides for certain; a template of a single shingle in a full window has s = 1/4: 0.9999 with 32 bands; s = 2/4
and above: more than 0.999999999.  Found templates are verified: at least ``LEAST`` of the template's distinct shingles stand in
the document.  Shingles are compared by 64-bit hashes.

A template of fewer words than a shingle is one shingle of its own length: in the same pass that length is hashed at every word,
and places with a template's hash are verified word by word.

Templates are a given table of license wordings, whose bands become literals of the plan.  They are scanned in parts of at most
``MAX_TEMPLATE_WORDS`` words (a longer template is a part of its own), and of a license's wordings the best counts; templates
without a word are refused.  Null and empty texts match nothing.  Rows with one doc_id are reported once per template.  A text of any
length is one row of words.  Of the documents' other columns none is read, so they may have any name; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
WINDOW_WORDS = 8
STRIDE = 4
BANDS = 32
LEAST = 0.8
MAX_TEMPLATE_WORDS = 20_000  # of the templates in one plan

# Wordings of well-known public licenses: (name, text).
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
                "work."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
# Wordings of fewer words than a shingle.
NOTICES = (("all-rights-reserved", "All rights reserved."),)


def words(text: Column) -> Column:
    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))
    return F.split(spaced, " ")


def shingles(word: Column, size: int = SHINGLE) -> Column:
    """Hashes of the runs of ``size`` words, in order; empty if there are fewer words."""
    places = F.when(F.size(word) >= size, F.sequence(F.lit(0), F.size(word) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(word, i + k) for k in range(size)]))


def _salt(band: int) -> int:
    """Constant of a band, spread over 64 bits by a rule."""
    value = (band + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    return value - (1 << 64) if value >> 63 else value


def minhash(hashes: Column, start: Column, band: int, width: int) -> Column:
    """The least value of ``width`` shingle hashes from ``start`` on, under the band's permutation."""
    salt = F.lit(_salt(band)).cast("bigint")
    values = [F.get(hashes, start + k).bitwiseXOR(salt) for k in range(width)]
    return F.least(*values) if width > 1 else values[0]  # nulls behind the end are skipped


def template_rows(spark: SparkSession, templates=TEMPLATES) -> list[dict]:
    """(template, license, words, shingles) as hashed by Spark itself.

    A template shorter than a shingle has one hash, of all its words.
    """
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    df = spark.createDataFrame(rows, "template int, license string, text string")
    split = df.select("template", "license", words(F.col("text")).alias("words"))
    hashes = shingles(F.col("words"))
    for size in range(1, SHINGLE):
        hashes = F.when(F.size("words") == size, shingles(F.col("words"), size)).otherwise(hashes)
    found = [r.asDict() for r in split.select("template", "license", "words", hashes.alias("shingles")).collect()]
    empty = sorted(r["license"] for r in found if r["words"] == [""])
    if empty:
        raise ValueError(f"templates without a word: {empty}")
    return found


def _band_values(rows: list[dict], bands: int, width: int) -> list[dict[int, set[int]]]:
    """By band: MinHash value -> templates with a window that has it; templates shorter than a shingle have none."""
    by_band: list[dict[int, set[int]]] = [{} for _ in range(bands)]
    for row in rows:
        hashes = row["shingles"]
        for at in range(max(1, len(hashes) - width + 1)) if len(row["words"]) >= SHINGLE else ():
            for band in range(bands):
                least = min(h ^ _salt(band) for h in hashes[at:at + width])
                by_band[band].setdefault(least, set()).add(row["template"])
    return by_band


def parts_of(templates, most: int | None = None) -> list[tuple]:
    """``templates`` in parts of at most ``most`` words, a longer one by itself."""
    most = MAX_TEMPLATE_WORDS if most is None else most
    parts, size = [[]], 0
    for template in templates:
        n = len((template[1] or "").split())
        if parts[-1] and size + n > most:
            parts.append([])
            size = 0
        parts[-1].append(template)
        size += n
    return [tuple(p) for p in parts]


def license_matches(docs: DataFrame, templates=TEMPLATES + NOTICES, bands: int = BANDS, window_words: int = WINDOW_WORDS,
                    stride: int = STRIDE, least: float = LEAST) -> DataFrame:
    """(doc_id, license, containment, first_word): one row per document and license found.

    ``containment`` is that of the license's best wording; ``first_word`` is where the first window that retrieved one of
    its wordings begins, or where a wording shorter than a shingle stands.
    """
    found = [_matches(docs, part, bands, window_words, stride, least) for part in parts_of(templates)]
    if len(found) == 1:
        return found[0]
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.min("first_word").alias("first_word"))


def _matches(docs: DataFrame, templates, bands: int, window_words: int, stride: int, least: float) -> DataFrame:
    """:func:`license_matches` for one part of the templates."""
    spark = docs.sparkSession
    width = window_words - SHINGLE + 1
    rows = template_rows(spark, templates)
    by_band = _band_values(rows, bands, width)
    short: dict[int, dict[int, set[int]]] = {}  # by words: hash -> templates of so many words
    for r in rows:
        if len(r["words"]) < SHINGLE:
            short.setdefault(len(r["words"]), {}).setdefault(r["shingles"][0], set()).add(r["template"])
    in_templates = sorted({h for r in rows if len(r["words"]) >= SHINGLE for h in r["shingles"]})
    # Both tables are bounded by MAX_TEMPLATE_WORDS, or by one template.
    by_value = spark.createDataFrame(
        [(b, value, sorted(ts)) for b in range(bands) for value, ts in by_band[b].items()]
        + [(-size, value, sorted(ts)) for size in short for value, ts in short[size].items()],
        "band int, value bigint, templates array<int>")
    wanted = spark.createDataFrame(
        [(r["template"], r["license"], r["words"], sorted(set(r["shingles"]))) for r in rows],
        "template int, license string, own array<string>, wanted array<bigint>")
    hashes, last = F.col("hashes"), F.size("hashes") - 1
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(stride))).otherwise(F.array().cast("array<int>"))

    def any_of(tests: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, tests)

    def retrieves(start: Column) -> Column:
        # A window's MinHash can only equal a template's if it is a template's shingle: windows without one are dismissed first.
        shares = any_of([F.coalesce(F.get(hashes, start + k).isin(in_templates), F.lit(False)) for k in range(width)])
        return shares & any_of([minhash(hashes, start, b, width).isin(list(by_band[b])) for b in range(bands)])

    def probes(start: Column) -> Column:
        return F.array(*[
            F.struct(start.alias("start"), F.lit(b).alias("band"), minhash(hashes, start, b, width).alias("value")) for b in range(bands)
        ])

    def probe(start: Column, size: int | None, value: Column) -> Column:
        band = F.lit(None if size is None else -size).cast("int")  # a length takes the place of a band
        return F.struct(start.alias("start"), band.alias("band"), value.cast("bigint").alias("value"))

    def short_places(size: int) -> Column:
        hits = F.filter(F.transform(f"hashes{size}", lambda h, i: probe(i, size, h)), lambda p: p["value"].isin(list(short[size])))
        # Texts without such a hash are dismissed before their places are laid out.
        none = F.array().cast("array<struct<start:int,band:int,value:bigint>>")
        return F.when(F.exists(f"hashes{size}", lambda h: h.isin(list(short[size]))), hits).otherwise(none)

    # Words and hashes are columns of their own: inside a lambda an expression is evaluated for each element.  The outer
    # explode keeps the optimizer from testing the windows once more below it.
    hashed = docs.select("doc_id", words(F.col("text")).alias("words")).select(
        "doc_id", "words", shingles(F.col("words")).alias("hashes"),
        *[shingles(F.col("words"), size).alias(f"hashes{size}") for size in sorted(short)])
    windows = F.transform(F.filter(starts, retrieves), lambda start: probe(start, None, F.lit(None)))
    met = F.col("met")
    found = (
        hashed.select("doc_id", "words", "hashes", F.concat(windows, *[short_places(size) for size in sorted(short)]).alias("places"))
        .select("doc_id", "words", "hashes", F.explode_outer("places").alias("met")).where("met IS NOT NULL")
        .select(
            "doc_id", F.array_distinct(F.filter(hashes, lambda h: h.isin(in_templates))).alias("common"),
            F.when(met["band"] < 0, F.slice("words", met["start"] + 1, -met["band"])).alias("here"),
            F.explode(F.when(met["band"].isNull(), probes(met["start"])).otherwise(F.array(met))).alias("probe"),
        )
        .select("doc_id", "common", "here", "probe.*")
        .join(F.broadcast(by_value), ["band", "value"])
        .select("doc_id", "common", "here", "start", F.explode("templates").alias("template"))
        .join(F.broadcast(wanted), "template")
    )
    containment = F.when(F.col("here").isNotNull(), (F.col("here") == F.col("own")).cast("double")).otherwise(
        F.size(F.array_intersect("wanted", "common")) / F.size("wanted"))
    return (
        found.withColumn("containment", containment).where(F.col("containment") >= least)
        .groupBy("doc_id", "license")
        .agg(F.max("containment").alias("containment"), F.min("start").cast("bigint").alias("first_word"))
    )
