"""License scan by MinHash bands over text windows, in DataFrame functions only.

Texts and templates are word shingles. A template of many shingles is looked up by
windows of WINDOW shingles: those of a document start at every STRIDE-th shingle, those
of the template at every one, so a document window inside a copy of the template has
a template window that starts where it starts. A window's sketch is its BANDS least
shingle hashes, each of which is a band: two windows collide if a value is in both
sketches. Windows that share all but BANDS - 1 of their shingles always do: the least
hash that both have can only come after those that one has alone. BANDS - 1 of WINDOW
are a fifth at least, so in a copy with 80 % of a template's shingles a window collides.
A short template has windows of one shingle, on either side.

A collision names a candidate; it is a match if enough of the template's distinct
shingles occur in the document, which is counted exactly.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlog.llm.common import col, pinned

SHINGLE = 5
CONTAINMENT = 0.8
WINDOW, STRIDE, BANDS = 16, 8, 5
# Shingles from which a copy surely holds a whole document window.
LONG = WINDOW + STRIDE
# Values that a lookup may hold; more templates are scanned for in several passes.
LOOKUP = 20_000

# Customary license notices and the opening passages of license texts.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "BSD-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, text string")


def words_of(text: Column) -> Column:
    """The runs of letters and digits, lower-cased; none of a null text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """A hash of every ``size`` words in a row."""
    at = F.sequence(F.lit(0), F.size(words) - size)
    return F.when(F.size(words) >= size, F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))).otherwise(
        F.array().cast("array<bigint>")
    )


def band_values(shingles: Column, stride: int) -> Column:
    """The bands of all windows; the last window ends where the shingles end."""
    last = F.greatest(F.size(shingles) - WINDOW, F.lit(0))
    starts = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(stride)), F.array(last)))
    return F.flatten(F.transform(starts, lambda i: F.slice(F.sort_array(F.slice(shingles, i + 1, F.lit(WINDOW))), 1, BANDS)))


def _shingled(df: DataFrame, text: Column, *kept: Column) -> DataFrame:
    words = df.select(*kept, pinned(words_of(text)).alias("words"))
    return words.select(*[c for c in words.columns if c != "words"], pinned(shingle_hashes(F.col("words"))).alias("shingles"))


def scan(
    docs: DataFrame, templates: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", license_col: str = "license", template_col: str = "text", least: float = CONTAINMENT, lookup: int = LOOKUP
) -> DataFrame:
    """(id, license, n_shingles, n_found, first_shingle) for each template of which a
    document holds at least ``least`` of the distinct shingles.

    Null, empty and short texts have no shingles and no match. Equal rows each match;
    rows of ``templates`` with one name are separate templates. A template of fewer
    than five words cannot be told from chance and is an error, as no template is
    silently left out. No document is shuffled: lookups travel to the documents, at
    most ``lookup`` values in a pass.
    """
    known = _shingled(templates, col(template_col), col(license_col).alias("license")).withColumn("shingles", F.array_distinct("shingles"))
    if (short := known.where(F.size("shingles") == 0).first()) is not None:
        raise ValueError(f"template {short['license']!r} has fewer than {SHINGLE} words")
    rows = _shingled(docs, col(text_col), col(id_col).alias("id"))
    rows = rows.select("id", "shingles", pinned(band_values(F.col("shingles"), STRIDE)).alias("bands"))
    found = None
    for block in _blocks(known, lookup):
        part = _scan_block(rows, block, least)
        found = part if found is None else found.unionAll(part)
    if found is None:
        nothing = rows.select("id").limit(0)
        return nothing.selectExpr("id", "'' as license", "0L as n_shingles", "0L as n_found", "0L as first_shingle")
    return found


def _blocks(known: DataFrame, lookup: int):
    """The templates with what they are looked up by, in blocks of about ``lookup``
    values: ``bands`` of long ones, the shingles themselves of short ones."""
    by = F.array_distinct(F.when(F.size("shingles") >= LONG, band_values(F.col("shingles"), 1)).otherwise(F.col("shingles")))
    held, size = [], 0
    for row in known.select("license", "shingles", by.alias("by")).toLocalIterator():
        held.append(row)
        size += len(row["by"])
        if size >= lookup:
            yield held
            held, size = [], 0
    if held:
        yield held


def _scan_block(rows: DataFrame, block: list, least: float) -> DataFrame:
    named: dict[str, dict[int, list[int]]] = {"bands": {}, "shingles": {}}
    for n, r in enumerate(block):
        for value in r["by"]:
            named["bands" if len(r["shingles"]) >= LONG else "shingles"].setdefault(value, []).append(n)

    def templates(kind: str) -> Column:
        """The templates that the values of a document collide with. The lookup is one
        constant, and a document's templates are gathered within its row."""
        lookup = F.from_json(F.lit(json.dumps({str(v): ns for v, ns in named[kind].items()})), "map<string, array<int>>")
        values = F.from_json(F.lit(json.dumps(sorted(named[kind]))), "array<bigint>")
        return F.flatten(F.transform(F.array_intersect(F.col(kind), values), lambda v: F.element_at(lookup, v.cast("string"))))

    found = [templates(kind) for kind in named if named[kind]]
    candidates = rows.select("id", "shingles", pinned(F.array_distinct(F.concat(*found))).alias("templates"))
    table = rows.sparkSession.createDataFrame(
        [(n, r["license"], r["shingles"]) for n, r in enumerate(block)], "template int, license string, own array<bigint>"
    )
    # Bounded: a block of templates.
    pairs = candidates.select("id", "shingles", F.explode("templates").alias("template")).join(F.broadcast(table), "template")
    common = F.size(F.array_intersect("own", "shingles"))
    first = F.array_min(F.filter(F.transform("own", lambda v: F.array_position("shingles", v)), lambda p: p > 0)) - 1
    counted = pairs.select("id", "license", "own", "shingles", pinned(common).alias("n_found"))
    return counted.where(F.col("n_found") >= F.size("own") * least).select(
        "id", "license", F.size("own").cast("long").alias("n_shingles"), F.col("n_found").cast("long").alias("n_found"), first.alias("first_shingle")
    )
