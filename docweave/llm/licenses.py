"""Operator 4, licence scan (DataFrame functions only).

A document's units are its lines, its paragraphs and its whole text, and, for notices inside
longer lines, its windows as long as a template.  Texts are normalised to lower-case words and
compared with licence templates by the Dice coefficient of their sets of word bigrams.

1. Sieve, without loss: Dice >= t with a template of n bigrams needs t n / (2 - t) shared ones, and a
   unit's bigrams are a subset of its text's.  One pass counts the bigrams each text shares
   with each template; only texts that reach a template's number go on.
2. Units meet templates of admissible size: Dice >= t needs set sizes within a factor of (2 - t) / t, so a
   unit's bigram count is joined by equality with the templates' admissible counts.
3. Windows start where a bigram that occurs once in the template puts them.

The templates are a parameter, a list in the program, which bounds what is broadcast.

Defined results: one row per input row; ``license`` is null when no unit or window
reaches ``least``; ties go to the template first in alphabetical order; null and empty
texts have no unit; rows are judged by their own text, whether their id repeats or is null
(rows are told apart by id and 64 bits of the text's hash); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import id_and_text, saved

KEY = ["row_id", "text_hash"]  # a row's id (the least long if null) and its text

LEAST = 0.85
#: Short notices and headers of common licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met:"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
     "later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


#: Notices of sibling licences, titles of whole texts, and third conditions.
_GNU = {"GPL-1.0": ("General Public License", "1", "February 1989"), "GPL-2.0": ("General Public License", "2", "June 1991"),
        "GPL-3.0": ("General Public License", "3", "29 June 2007"), "LGPL-2.0": ("Library General Public License", "2", "June 1991"),
        "LGPL-2.1": ("Lesser General Public License", "2.1", "February 1999"),
        "LGPL-3.0": ("Lesser General Public License", "3", "29 June 2007"),
        "AGPL-3.0": ("Affero General Public License", "3", "19 November 2007")}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
SIBLINGS = [
    *[(name, f"This work is licensed under the GNU {full}, version {version}.") for name, (full, version, _) in _GNU.items()],
    *[(name, f"GNU {full} Version {version}, {date}") for name, (full, version, date) in _GNU.items()],
    *[(name, f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {full} as published "
       f"by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
      for name, (full, version, _) in _GNU.items() for what in (("library", "program") if name[0] == "L" else ("program",))],
    *[(f"CC-{code}-{v}", text) for code, full in _CC.items() for v in ("2.0", "2.5", "3.0", "4.0") for text in (
        f"Licensed under CC {code} {v}.",
        f"This work is licensed under a Creative Commons {full} {v} {'International' if v == '4.0' else 'Unported' if v == '3.0' else 'Generic'} License.")],
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission."),
]
#: Whole licence texts, one file per licence.
GNU_NAMES = {name.removesuffix(".0"): name for name in ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-3.0")}
BODIES = [(GNU_NAMES.get(f.stem, f.stem), f.read_text(encoding="utf-8", errors="replace"))
          for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
ALL_TEMPLATES = TEMPLATES + [t for t in SIBLINGS if t not in TEMPLATES] + BODIES
#: Licences that yield to another one, which holds their words and more.
PART_OF = {"BSD-2-Clause": "BSD-3-Clause"}


def ordered_bigrams(text: str) -> list[str]:
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def template_bigrams(text: str) -> list[str]:
    return sorted(set(ordered_bigrams(text)))


def template_table(spark: SparkSession, templates: list[tuple[str, str]], least: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Templates (template, license, grams, length in bigrams, at: place of each bigram that occurs once),
    their admissible unit sizes (size, template), and their bigrams (gram, template, needed)."""
    rows, sizes, grams = [], [], []
    for k, (name, text) in enumerate(templates):
        own, order = template_bigrams(text), ordered_bigrams(text)
        n = len(own)
        often = Counter(order)
        rows.append((k, name, own, len(order), {g: i for i, g in enumerate(order) if often[g] == 1}))
        sizes += [(size, k) for size in range(1, 3 * n + 2) if 2 * min(size, n) >= least * (size + n)]
        grams += [(g, k, math.ceil(n * least / (2 - least) - 1e-9)) for g in own]
    return (spark.createDataFrame(rows, "template int, license string, grams array<string>, length int, at map<string,int>"),
            spark.createDataFrame(sizes, "size int, template int"), spark.createDataFrame(grams, "gram string, template int, needed int"))


def all_bigrams(unit: Column) -> Column:
    """Word bigrams in order.  The words are bound to a lambda variable, so they are split once per unit."""
    split = F.split(F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.transform(F.array(split), lambda words: F.transform(
        F.slice(words, 2, F.size(words)), lambda word, i: F.concat(F.get(words, i), F.lit(" "), word)))[0]


def _other_than(name: str):
    return lambda hit: hit["license"] != name


def sieve(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """(key, templates): the texts that share enough bigrams with a template, and those templates."""
    own = texts.withColumn("copy", F.monotonically_increasing_id()).select(*KEY, "copy", F.explode(
        F.array_distinct(all_bigrams(F.col("text")))).alias("gram"))
    pairs = (own.join(F.broadcast(grams), "gram").groupBy(*KEY, "copy", "template")
             .agg(F.count("*").alias("shared"), F.first("needed").alias("needed")).filter("shared >= needed"))
    return pairs.groupBy(*KEY).agg(F.collect_set("template").alias("templates"))


def window_matches(passed: DataFrame, templates: DataFrame, least: float) -> DataFrame:
    """key, windows (d: negative Dice, license, start, end): the best window per text and template that
    reaches ``least``, without those that overlap a better one."""

    def dice(start):
        window = F.array_distinct(F.slice("order", start + 1, F.col("length")))
        return F.transform(F.array(window), lambda w: F.struct(
            (-2.0 * F.size(F.array_intersect(w, F.col("grams"))) / (F.size(w) + F.size("grams"))).alias("d"), start.alias("start")))[0]

    starts = F.array_distinct(F.filter(F.transform("order", lambda g, i: F.greatest(i - F.col("at")[g], F.when(F.col("at")[g].isNotNull(), F.lit(0)))),
                                       lambda s: s.isNotNull()))
    met = (passed.withColumn("order", all_bigrams(F.col("text"))).withColumn("template", F.explode("templates"))
           .join(F.broadcast(templates), "template"))
    best = met.select(*KEY, "license", "length", F.array_min(F.transform(starts, dice)).alias("best")).filter(F.col("best.d") <= -least)
    found = best.groupBy(*KEY).agg(F.collect_set(F.struct(
        "best.d", "license", "best.start", (F.col("best.start") + F.col("length")).alias("end"))).alias("windows"))
    return found.select(*KEY, F.filter("windows", lambda w: ~F.exists("windows", lambda v: (
        v < w) & (v["start"] < w["end"]) & (w["start"] < v["end"]))).alias("windows"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: list[tuple[str, str]] = ALL_TEMPLATES, least: float = LEAST) -> DataFrame:
    """doc_id, license, dice, n_matches per row: units that reach ``least`` for any template, and
    windows that do for a licence no unit reaches."""
    texts = id_and_text(docs, id_col, text_col).withColumns({
        "row_id": F.coalesce("doc_id", F.lit(-1 << 63)), "text_hash": F.xxhash64("text")})
    text = F.col("text")
    tables = template_table(docs.sparkSession, templates, least)
    passed = saved(texts.select(*KEY, "text").join(sieve(texts, tables[2]), KEY))
    units = passed.select(*KEY, F.explode(F.array_distinct(F.concat(
        F.split(text, "\n"), F.split(text, r"\n\s*\n"), F.array(text)))).alias("unit"))
    sized = units.select(*KEY, "unit", F.array_distinct(all_bigrams(F.col("unit"))).alias("own")).withColumn("size", F.size("own"))
    dice = 2.0 * F.size(F.array_intersect("own", "grams")) / (F.col("size") + F.size("grams"))
    reached = (sized.join(F.broadcast(tables[1]), "size").join(F.broadcast(tables[0]), "template")
               .withColumn("dice", dice).filter(F.col("dice") >= least))
    by_unit = reached.groupBy(*KEY, F.col("unit").alias("place")).agg(
        F.min(F.struct((-F.col("dice")).alias("d"), "license")).alias("best"), F.collect_set("license").alias("names"))
    by_text = by_unit.groupBy(*KEY).agg(
        F.collect_set("best").alias("found"), F.array_distinct(F.flatten(F.collect_set("names"))).alias("names"), F.count("*").alias("n"))
    both = by_text.join(window_matches(passed, tables[0], least), KEY, "full").withColumns({
        "found": F.coalesce("found", F.array()), "names": F.coalesce("names", F.array()), "windows": F.coalesce("windows", F.array())})
    new = F.filter("windows", lambda w: ~F.array_contains("names", w["license"]))
    both = both.withColumn("hits", F.concat("found", F.transform("windows", lambda w: F.struct(w["d"].alias("d"), w["license"].alias("license")))))
    shown = F.col("hits.license")
    for part, whole in PART_OF.items():
        both = both.withColumn("hits", F.when(F.array_contains(shown, whole), F.filter("hits", _other_than(part)))
                               .otherwise(F.col("hits")))
    found = both.select(*KEY, F.array_min("hits").alias("best"), (
        F.coalesce("n", F.lit(0).cast("long")) + F.size(new)).alias("n_matches"))
    return (texts.select("doc_id", *KEY).join(found, KEY, "left")
            .select("doc_id", F.col("best.license").alias("license"), (-F.col("best.d")).alias("dice"),
                    F.coalesce("n_matches", F.lit(0).cast("long")).alias("n_matches")))


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _values() -> str:
    rows = []
    for name, text in TEMPLATES:
        grams = ", ".join("'" + g + "'" for g in template_bigrams(text))
        rows.append(f"('{name}', [{grams}])")
    return ", ".join(rows)


ORACLE = f"""
WITH templates(license, grams) AS (VALUES {_values()}),
u AS (SELECT doc_id, unnest(list_distinct(string_split(text, chr(10)) || string_split_regex(text, '\\n\\s*\\n') || [text])) AS unit
      FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, unit, string_split(trim(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS words FROM u),
b AS (SELECT doc_id, unit, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS own FROM w),
d AS (SELECT doc_id, unit, license, 2.0::DOUBLE * len(list_intersect(own, grams)) / (len(own) + len(grams)) AS dice
      FROM b, templates WHERE 2 * least(len(own), len(grams)) >= {LEAST} * (len(own) + len(grams))),
m AS (SELECT doc_id, unit, min((-dice, license)) AS best FROM d WHERE dice >= {LEAST} GROUP BY ALL),
f AS (SELECT doc_id, min(best) AS best, count(*) AS n_matches FROM m GROUP BY doc_id)
SELECT documents.doc_id, best[2] AS license, -best[1] AS dice, coalesce(n_matches, 0) AS n_matches
FROM documents LEFT JOIN f USING (doc_id)
"""
