"""License scans: Dice coefficient over word bigrams against license templates.

A text is normalised (lower case; words are runs of a-z and 0-9) and compared with
each template by ``2 * |A & B| / (|A| + |B|)`` over the sets of neighbouring word
pairs. Its lines are compared as well, as a notice is mostly one line of a text.
As ``|A & B|`` is at most the smaller set, a template can only reach the threshold
if ``|A|`` lies between ``t / (2 - t)`` and ``(2 - t) / t`` times its size: others
are not compared.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Common notices and short license texts.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License. See LICENSE in the project root for license information.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
}


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, in order."""
    w = re.findall("[a-z0-9]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:], strict=False)))


def bounds(n: int, threshold: float) -> tuple[float, float]:
    """Sizes of a set that can reach the threshold with one of size ``n``."""
    return n * threshold / (2 - threshold), n * (2 - threshold) / threshold


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    """Hashes of the distinct bigrams."""
    n = F.size(words)
    each = F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(each, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1))))


def _best(pairs: Column, templates: dict[str, str], threshold: float) -> Column:
    """The best (dice, template) of a set, the first of equal ones; null below the threshold."""
    size = F.size(pairs)
    found = []
    for name, text in templates.items():
        own = bigrams(text)
        low, high = bounds(len(own), threshold)
        own_pairs = F.array(*(F.xxhash64(F.lit(b.split()[0]), F.lit(b.split()[1])) for b in own))
        dice = F.lit(2.0) * F.size(F.array_intersect(pairs, own_pairs)) / (size + len(own))
        found.append(F.when((size >= low - 1e-9) & (size <= high + 1e-9) & (dice >= threshold),
                            F.struct(dice.alias("dice"), F.lit(name).alias("license"))))
    better = lambda a, b: F.when(a.isNull() | (b["dice"] > a["dice"]), F.coalesce(b, a)).otherwise(a)
    return F.aggregate(F.filter(F.array(*found), lambda x: x.isNotNull()),
                       F.lit(None).cast("struct<dice:double,license:string>"), better)


def scan(docs: DataFrame, *, text: str = "text", key: str = "doc_id", templates: dict[str, str] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per document with the licenses that its lines or its whole text are close to.

    Returns ``key``, ``n_license_lines`` (long), ``licenses`` (names of lines' best
    templates, distinct, sorted, comma-joined; empty without any), ``line_dice``
    (best of them, else null), ``text_license`` and ``text_dice`` (of the whole text;
    null below the threshold). A null or empty text, and one of a single word, has
    none; of templates equally close the first counts. Rows are judged one by one,
    so repeated rows and null keys do not matter. No shuffle, no join.
    """
    templates = TEMPLATES if templates is None else templates
    least = min((bounds(len(bigrams(t)), threshold)[0] for t in templates.values()), default=0.0)
    df = docs.select(F.col(f"`{key}`"), F.transform(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n", -1),
                                                    _words).alias("_lines"))
    # A set is at most as large as the number of pairs, so short lines are left out first.
    df = df.withColumn("_text", F.flatten("_lines")).withColumn("_text", _pairs(F.col("_text"))) \
        .withColumn("_lines", F.transform(F.filter("_lines", lambda w: F.size(w) - 1 >= least - 1e-9), _pairs)) \
        .withColumn("_whole", _best(F.col("_text"), templates, threshold)) \
        .withColumn("_found", F.filter(F.transform("_lines", lambda p: _best(p, templates, threshold)),
                                       lambda x: x.isNotNull()))
    return df.select(F.col(f"`{key}`"), F.size("_found").cast("long").alias("n_license_lines"),
                     F.array_join(F.array_sort(F.array_distinct(F.transform("_found", lambda x: x["license"]))), ",")
                     .alias("licenses"), F.array_max(F.transform("_found", lambda x: x["dice"])).alias("line_dice"),
                     F.col("_whole.license").alias("text_license"), F.col("_whole.dice").alias("text_dice"))


def sql(table: str = "documents", threshold: float = THRESHOLD) -> str:
    """The same scan over ``TEMPLATES`` for DuckDB."""
    rows = ", ".join(f"({i}, '{n}', [{', '.join(repr(b) for b in bigrams(t))}])" for i, (n, t) in enumerate(TEMPLATES.items()))
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    words = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"
    return f"""WITH t(i, name, b) AS (VALUES {rows}),
      d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM {table}),
      u AS (SELECT r, -1 AS line, {words.format('text')} AS w FROM d
            UNION ALL SELECT r, n, {words.format('l')} FROM (SELECT r, unnest(string_split(text, chr(10))) AS l,
              generate_subscripts(string_split(text, chr(10)), 1) AS n FROM d)),
      p AS (SELECT r, line, {pairs} AS p FROM u),
      m AS (SELECT r, line, i, name, 2.0::DOUBLE * len(list_intersect(p, b)) / (len(p) + len(b)) AS dice FROM p, t
            WHERE len(p) BETWEEN 0.6 * len(b) AND 1.7 * len(b)),
      f AS (SELECT * FROM m WHERE dice >= {threshold}
            QUALIFY row_number() OVER (PARTITION BY r, line ORDER BY dice DESC, i) = 1),
      l AS (SELECT r, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names, max(dice) AS dice
            FROM f WHERE line >= 0 GROUP BY r)
      SELECT doc_id, coalesce(n, 0) AS n_license_lines, coalesce(names, '') AS licenses, l.dice AS line_dice,
        f.name AS text_license, f.dice AS text_dice
      FROM d LEFT JOIN l USING (r) LEFT JOIN f ON f.r = d.r AND f.line = -1"""
