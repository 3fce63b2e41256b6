"""License scan: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies.

Only DataFrame functions. A template is a license notice; its shingles are runs of five words. For each number s
of shingles that a template has, a document holds the template if any 2 * s shingles in a row hold at least 0.8 of
it. The document is cut into stretches of 3 * s shingles that begin every s shingles, so each window of 2 * s lies
whole in one of them. A stretch that holds at least 0.8 of a template has a Jaccard similarity to it of 0.8 / 3.2 =
0.25 at least, and BANDS = 48 bands of one MinHash each collide at least once with a probability of 1 - 0.75 ** 48,
all but one in a million. What collides is verified: the part of the template's shingles, as words, that the
windows at each place of the stretch hold.

Stretches without any template shingle hold no part of a template. One look at the shingles of each document, by
hash, finds the places of template shingles, and only stretches around them are built, in the row that holds the
document; so most texts make none, and what is exploded and joined is small. The templates' bands are
broadcast: they are TEMPLATES, or a table of at most MOST_TEMPLATES notices.

Words are runs of letters and digits in lower case. Defined results: null and empty texts, and templates with
fewer than five words, match nothing; rows that repeat an id count as one document; of several windows that hold
a template the greatest containment counts, and of windows with that the first one at a multiple of s, or else the
first one; n_windows counts the windows at multiples of s and is 0 where none of them holds the template; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.base import Scratch

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 48
MOST_TEMPLATES = 2_000

#: Notices as they stand in texts and file headers (fixed values).
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted"
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _hashes(words: Column) -> Column:
    """A hash of each run of five words."""
    places = F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1))
    return F.when(F.size(words) >= SHINGLE, F.transform(places, lambda i: F.xxhash64(F.slice(words, i, SHINGLE))))


def _bands(hashes: Column) -> Column:
    """One key for each band: the least of the shingles' hashes under its own hash function."""
    return F.array(*[F.xxhash64(F.lit(b), _least(hashes, b)) for b in range(BANDS)])



def _least(hashes: Column, band: int) -> Column:
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))))


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    """template, n (shingles), shingles, hashes."""
    templates = TEMPLATES if templates is None else templates
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"at most {MOST_TEMPLATES} templates")
    table = spark.createDataFrame(sorted(templates.items()), "template string, text string")
    table = table.withColumn("words", words_of(F.col("text"))).filter(F.size("words") >= SHINGLE)
    places = F.sequence(F.lit(1), F.size("words") - (SHINGLE - 1))
    return table.select(
        "template",
        F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice("words", i, SHINGLE), " "))).alias("shingles"),
        F.array_distinct(_hashes(F.col("words"))).alias("hashes"),
    ).withColumn("n", F.size("shingles"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document and template found: id, template, containment, first_word, n_windows."""
    spark = docs.sparkSession
    table = template_table(spark, templates)
    # Bounded by MOST_TEMPLATES.
    known = table.select("template", "n", "hashes").collect()
    if not known:
        return docs.select(id_col).limit(0).selectExpr(id_col, "'' template", "0D containment", "0 first_word", "0L n_windows")
    sizes: dict[int, set[int]] = {}
    for row in known:
        sizes.setdefault(row["n"], set()).update(row["hashes"])

    def near(found: Column, hashes: Column) -> Column:
        """The stretches (first shingle, shingles) around the places of template shingles, for each size."""
        windows = []
        for n, own in sorted(sizes.items()):
            windows.append(_around(found, hashes, n, F.array(*[F.lit(h) for h in sorted(own)])))
        return F.flatten(F.array(*windows))

    every = F.array(*[F.lit(h) for h in sorted(set().union(*sizes.values()))])
    # The documents that share a hash with any template, with their words and hashes; the others end here. All is
    # one expression, so that nothing of it is computed twice, and is written, so that lambdas below read columns.
    looked = F.transform(
        F.transform(F.array(words_of(F.col(text))), lambda w: F.struct(w.alias("w"), _hashes(w).alias("h"))),
        lambda x: F.struct(x["w"].alias("w"), x["h"].alias("h"), F.array_intersect(x["h"], every).alias("shared")),
    )
    held = docs.select(F.col(id_col).alias("_id"), F.explode(F.filter(looked, lambda x: F.size(x["shared"]) > 0)).alias("x"))
    held = Scratch(spark, "licenses").cut(held.select("_id", "x.*"))
    windows = held.select(
        "_id",
        F.explode(
            F.transform(
                near(F.col("shared"), F.col("h")),
                lambda x: F.struct(
                    x["first"].alias("first"),
                    x["n"].alias("n"),
                    F.slice("h", x["first"] + 1, 3 * x["n"]).alias("h"),
                    F.slice("w", x["first"] + 1, 3 * x["n"] + (SHINGLE - 1)).alias("w"),
                ),
            )
        ).alias("win"),
    )
    windows = windows.select("_id", "win.*").withColumn("band", F.explode(_bands(F.col("h"))))
    bands = table.select("template", F.col("n").alias("size"), "shingles", F.explode(_bands(F.col("hashes"))).alias("band"))
    hit = windows.join(F.broadcast(bands), (windows["band"] == bands["band"]) & (F.col("n") == F.col("size")))
    hit = hit.select("_id", "template", "n", "first", _inside(F.col("shingles"), F.col("w")).alias("inside"))
    hit = hit.filter(_held(F.col("inside")) / F.col("n") >= CONTAINMENT)
    hit = hit.select("_id", "template", "n", "first", F.explode(_windows(F.col("inside"), F.col("n"))).alias("x"))
    hit = hit.select(
        "_id",
        "template",
        (F.col("first") + F.col("x.skip")).alias("first"),
        (F.col("x.held") / F.col("n")).alias("containment"),
        (F.col("x.skip") == 0).alias("even"),
    )
    hit = hit.filter(F.col("containment") >= CONTAINMENT).distinct()
    best = F.max(F.struct("containment", "even", (-F.col("first")).alias("first"))).alias("best")
    found = hit.groupBy("_id", "template").agg(best, F.count_if("even").alias("n_windows"))
    return found.select(
        F.col("_id").alias(id_col),
        "template",
        F.col("best.containment").alias("containment"),
        (-F.col("best.first")).cast("int").alias("first_word"),
        "n_windows",
    )


def _around(shared: Column, hashes: Column, n: int, own: Column) -> Column:
    """Distinct stretches of 3 * n shingles, begun every n, that hold a shingle of a template of this size."""
    none = F.array().cast("array<struct<first:int,n:int>>")

    def places(mine: Column) -> Column:
        at = F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(mine, h), i)), lambda i: i.isNotNull())
        begins = F.transform(at, lambda i: F.array(*[((F.floor(i / n) - back) * n).cast("int") for back in range(3)]))
        begins = F.filter(F.array_distinct(F.flatten(begins)), lambda b: b >= 0)
        return F.transform(begins, lambda b: F.struct(b.alias("first"), F.lit(n).alias("n")))

    return _let(F.array_intersect(shared, own), lambda mine: F.when(F.size(mine) > 0, places(mine)).otherwise(none))


def _inside(shingles: Column, words: Column) -> Column:
    """For each shingle of the words its place among the template's, 0 if it is none of them."""
    places = F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1))
    return F.transform(places, lambda i: F.array_position(shingles, F.array_join(F.slice(words, i, SHINGLE), " ")))


def _held(inside: Column) -> Column:
    return F.size(F.array_remove(F.array_distinct(inside), 0))


def _windows(inside: Column, n: Column) -> Column:
    """The window of 2 * n at the start of a stretch, and the best of those at the next n - 1 places, as
    (held, skip). Windows that do not begin with a shingle of the template hold no more than a later one that does."""
    window = lambda skip: F.struct(_held(F.slice(inside, skip + 1, 2 * n)).alias("held"), skip.alias("skip"))

    def with_later(start: Column) -> Column:
        skips = F.filter(F.sequence(F.lit(1), F.least(n, F.size(inside)) - 1), lambda i: F.get(inside, i) > 0)
        found = F.transform(skips, window)
        most = F.array_max(F.transform(found, lambda x: x["held"]))
        more = F.filter(found, lambda x: (x["held"] == most) & (x["held"] > start["held"]))
        several = F.least(n, F.size(inside)) > 1
        return F.when((start["held"] < n) & several, F.concat(F.array(start), F.slice(more, 1, 1))).otherwise(F.array(start))

    return _let(window(F.lit(0)), with_later)
