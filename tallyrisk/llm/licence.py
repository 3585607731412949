"""Licence texts found by Dice coefficient over word bigrams, in DataFrame functions only.

A text is normalised (lower case, runs of letters and digits are words, version
numbers of the form 2.0 stay one word).  Each line and the whole text are units.
A unit matches a template if 2 * |common| / (|unit| + |template|) over distinct
word bigrams reaches the threshold.  So a unit's bigram count must lie within
[t / (2 - t), (2 - t) / t] times the template's; other units are dropped before
their bigrams are compared.  Common bigrams are counted by joining bigrams to
the bigrams of the templates, a fixed list that is broadcast.

Defined results: null, empty and one-word texts match nothing; a tie between
templates goes to the first name; repeated rows give repeated results; other
columns do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.text import with_row_id

#: Templates of licence notices and short licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["This work has been dedicated to the public domain under CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}


def normal_words(text: Column) -> Column:
    """Words of a normalised text."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?!\p{N})|(?<!\p{N})\.", " ")
    return F.array_remove(F.split(plain, " +"), "")


def bigrams(words: str) -> Column:
    """Distinct pairs of neighbouring words of the array column ``words``."""
    return F.expr(
        f"""CASE WHEN size({words}) < 2 THEN CAST(array() AS array<string>) ELSE array_distinct(transform(
        slice({words}, 1, size({words}) - 1), (w, i) -> concat(w, ' ', element_at({words}, i + 2)))) END"""
    )


def template_table(like: DataFrame) -> DataFrame:
    """One row per template and bigram: template number, licence, size of the template, bigram."""
    rows = [(k, name, body) for k, (name, body) in enumerate((n, b) for n, bodies in TEMPLATES.items() for b in bodies)]
    table = like.sparkSession.createDataFrame(rows, "template int, licence string, body string")
    words = table.withColumn("_w", normal_words(F.col("body"))).withColumn("_b", bigrams("_w"))
    return words.select("template", "licence", F.size("_b").alias("size"), F.explode("_b").alias("bigram"))


def matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """Rows (doc_id, line, licence, dice): units that match; ``line`` is 0 for the whole text, lines count from 1."""
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    known = F.broadcast(template_table(docs))
    sizes = template_table(docs).select("template", "size").distinct().collect()
    # As many sizes as there are templates: a fixed list.
    fits = sorted({n for r in sizes for n in range(math.ceil(low * r["size"] - 1e-9), math.floor(high * r["size"] + 1e-9) + 1)})
    rows = with_row_id(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_body")))
    units = rows.select(
        "doc_id", "_row", F.posexplode(F.concat(F.array("_body"), F.split("_body", "\n"))).alias("line", "unit")
    )
    # explode(array(x)) keeps x a column of its own: filters on it would otherwise compute it again.
    words = units.where(F.col("unit") != "").select("doc_id", "_row", "line", F.explode(F.array(normal_words(F.col("unit")))).alias("_w"))
    paired = words.where(F.size("_w") > fits[0]).select("doc_id", "_row", "line", F.explode(F.array(bigrams("_w"))).alias("_b"))
    sized = paired.where(F.size("_b").isin(fits)).withColumn("n", F.size("_b"))
    hits = (
        sized.select("doc_id", "_row", "line", "n", F.explode("_b").alias("bigram"))
        .join(known, "bigram")
        .where(F.col("n").between(low * F.col("size") - 1e-9, high * F.col("size") + 1e-9))
        .groupBy("_row", "doc_id", "line", "n", "template", "licence", "size")
        .agg(F.count("*").alias("common"))
        .withColumn("dice", 2 * F.col("common") / (F.col("n") + F.col("size")))
        .where(F.col("dice") >= threshold)
    )
    best = hits.groupBy("_row", "doc_id", "line").agg(F.max(F.struct("dice", (-F.col("template")).alias("first"), "licence")).alias("b"))
    return best.select("doc_id", "line", F.col("b.licence").alias("licence"), F.col("b.dice").alias("dice"))
