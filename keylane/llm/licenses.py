"""License scans, with DataFrame functions only.

A text's words are cut into overlapping windows of six words, one beginning at
every word; a window holds two shingles of five words. A window's MinHash under
each of ``BANDS`` permutations is one band. The values of all bands of all
windows of a license template, and of each of its shingles alone, are its keys.
Permutations come in pairs of opposite order: of the two shingles of a window
one is the least under the first of a pair and the other under the second, so
each shingle of a text is among its keys and a text that holds any shingle of a
template always meets it. Templates so retrieved are verified by the exact
share of their shingles that the text holds. All of it happens in the row of
the text, so nothing is shuffled whatever the skew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keylane.llm.shared import documents

SHINGLE = 5
BANDS = 6
CONTAINMENT = 0.8
#: Most templates of a scan: they are part of the plan.
MOST_TEMPLATES = 2_000

# The usual notices of common licenses.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-grant": "You may not use this file except in compliance with the License. You may obtain a copy of the License at "
                        "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                 "License as published by the Free Software Foundation",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "proprietary": "All rights reserved. No part of this work may be reproduced without written permission.",
}


@dataclass(frozen=True)
class Template:
    name: str
    shingles: tuple[str, ...]
    keys: tuple[int, ...]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _bind(value: Column, body) -> Column:
    """The body with the value computed once: a lambda argument is not computed again where it is used."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(words: Column) -> Column:
    """A hash of each run of five words, from the hashes of the words; one of nulls where there are fewer words."""
    def rolled(hashes: Column) -> Column:
        out = hashes
        for i in range(1, SHINGLE):
            later = F.slice(hashes, i + 1, F.greatest(F.size(hashes) - i, F.lit(0)))
            # zip_with fills the shorter array with nulls, which hash as well; they are cut off below
            out = F.zip_with(out, later, lambda a, b: F.xxhash64(a, b))
        return F.slice(out, 1, F.greatest(F.size(hashes) - (SHINGLE - 1), F.lit(0)))

    return _bind(F.transform(words, lambda w: F.xxhash64(w)), rolled)


def _salt(k: int) -> int:
    """Salts of a pair differ in every bit, so they order any two values oppositely."""
    value = (0x9E3779B97F4A7C15 * (k // 2 + 1)) % 2**64
    value = value - 2**64 if value >= 2**63 else value
    return ~value if k % 2 else value


def window_keys(hashes: Column) -> Column:
    """Band values of all windows of two shingles; a text of one shingle is one window.

    A band's permutation is x -> x xor salt; the salt also tells the bands apart.
    """
    def keys(h: Column) -> Column:
        # the last shingle has none after it; null is passed over by least
        later = F.when(F.size(h) > 1, F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0)))).otherwise(h)
        return F.flatten(F.zip_with(h, later, _bands))

    return _bind(hashes, keys)


def _bands(a: Column, b: Column) -> Column:
    return F.array(*[F.least(a.bitwiseXOR(F.lit(_salt(k))), b.bitwiseXOR(F.lit(_salt(k)))) for k in range(BANDS)])


def _phrases(words: Column) -> Column:
    """The distinct shingles of the words as text."""
    def made(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1))
        return F.when(F.size(w) >= SHINGLE, F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(w, i, SHINGLE), " ")))
                      ).otherwise(F.array().cast("array<string>"))

    return _bind(words, made)


def prepared(spark: SparkSession, templates: dict[str, str]) -> list[Template]:
    """Shingles and keys of the templates. A template needs five words; its windows begin at every word."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    held = spark.createDataFrame(list(templates.items()), "name string, text string").select("name", words_of(F.col("text")).alias("w"))
    rows = held.select("name", _phrases(F.col("w")).alias("shingles"), F.array_distinct(
        F.concat(window_keys(shingle_hashes(F.col("w"))), _single_keys(F.col("w")))).alias("keys")).collect()
    short = [r["name"] for r in rows if not r["shingles"]]
    if short:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    return [Template(r["name"], tuple(r["shingles"]), tuple(r["keys"])) for r in rows]


def _single_keys(words: Column) -> Column:
    """Band values of each shingle alone: one of a pair is met by every window that holds it, whatever stands beside it."""
    return F.flatten(F.transform(shingle_hashes(words), lambda h: _bands(h, h)))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """Rows (doc_id, license, containment, shingles): templates of which a text holds that share of shingles or more.

    ``shingles`` is how many of the template's it holds. Null and empty texts,
    and texts of fewer than five words, hold none.
    """
    known = prepared(docs.sparkSession, templates)
    keys = F.array(*[F.lit(k) for k in sorted({k for t in known for k in t.keys})])
    listed = F.array(*[F.struct(F.lit(t.name).alias("license"), F.array(*map(F.lit, t.keys)).alias("keys"),
                                F.array(*map(F.lit, t.shingles)).alias("shingles")) for t in known])
    met = _bind(words_of(F.col("text")), lambda w: F.array_intersect(window_keys(shingle_hashes(w)), keys))
    near = docs.select("doc_id", "text", met.alias("met")).filter(F.size("met") > 0)
    candidates = near.select("doc_id", _phrases(words_of(F.col("text"))).alias("phrases"), F.filter(
        listed, lambda t: F.arrays_overlap(t["keys"], F.col("met"))).alias("candidates"))
    verified = _bind(F.col("phrases"), lambda p: F.transform(F.col("candidates"), lambda t: F.struct(
        t["license"].alias("license"), F.size(F.array_intersect(t["shingles"], p)).alias("held"), F.size(t["shingles"]).alias("all"))))
    return candidates.select("doc_id", F.explode(verified).alias("m")).select(
        "doc_id", "m.license", (F.col("m.held") / F.col("m.all")).alias("containment"), F.col("m.held").cast("long").alias("shingles")
    ).filter(F.col("containment") >= containment)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
