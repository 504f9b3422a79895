"""Licence scan: sparse TF-IDF cosine to templates, and inheritance by path joins, in DataFrame functions only.

Texts are cut into segments: lines, and of long lines windows of ``WINDOW`` tokens that overlap by half. A segment with a cue word is a
header, and the whole text of a document with a header is a segment too. A notice within a longer line, or broken over lines, is found
by further headers: at each anchor word of the text, for each anchor of a template, the window of the template's own length in which the
two coincide. A header counts for a template only if it has all of that template's names and version numbers. The cosine of a segment's TF-IDF vector with
each template's is computed by joining terms. A header with a cosine of ``LIMIT`` or more gives the document its own
licence; a document whose whole text reaches ``FILE_LIMIT``, or that has the name of a licence file and a header, is a licence file
of its directory. A document without its own licence inherits from the nearest ancestor directory that has such a file.

Inverse document frequencies of the templates' terms come from all documents: a term counts in each document that has it. Terms of no
template have the largest frequency weight. Equal segments are scored once, equal directories resolved once. Only the templates'
terms (a few hundred) and directories with over ``LARGE`` of all rows (at most 1 / LARGE) are broadcast.

Defined cases: null and empty texts have no header and may inherit. A null path has no directory. Of several licence files of a
directory the most similar decides, then the smallest path; of several headers the most similar, then the first name.
Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transferlens.llm.common import whole
from transferlens.session import stored

WINDOW = 48
LIMIT = 0.55
FILE_LIMIT = 0.7
#: A directory with more than this share of all rows is large; there are at most 1 / LARGE of them.
LARGE = 0.005
CUES = r"(?i)licen[sc]|copyright|spdx|permission\s+is\s+hereby|redistribut|public\s+domain|creative\s+commons|free\s+software"
#: Beginnings of the words at which texts and templates are laid side by side.
ANCHORS = ("licen", "spdx", "permission", "redistribut", "domain")
#: Terms of a template, besides numbers, that a header must have.
NAMES = r"^(?:[0-9]+|mit|apache|bsd|cc|by|nc|cc0|creative|commons|attribution|noncommercial|gnu|gpl|lesser|mozilla)$"
FILE_NAMES = r"(?i)(?:^|/)(?:licen[sc]e|copying|notice|unlicense)[^/]*$"
# Notices of public licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": ("This work is released into the public domain under CC0 1.0 Universal.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def _vectors(segments: DataFrame, keys: list[str], idf: DataFrame, unseen: Column) -> DataFrame:
    """(keys, term, weight) of unit length; ``segments`` has an array ``terms``."""
    counts = segments.select(*keys, F.explode("terms").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    weighted = counts.join(F.broadcast(idf), "term", "left").withColumn("weight", (1 + F.log("tf")) * F.coalesce("idf", unseen))
    norms = weighted.groupBy(*keys).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return weighted.join(norms, keys).select(*keys, "term", (F.col("weight") / F.col("norm")).alias("weight"))


def _versions(text: Column) -> Column:
    """``v3`` as ``3``."""
    return F.regexp_replace(F.lower(text), r"\bv(?=[0-9])", "")


def _anchors(notices: list[list[str]]) -> list[tuple[str, int, int]]:
    """(beginning of an anchor word, its place, length) of the templates' terms."""
    return sorted({(a, at, len(words)) for words in notices for at, word in enumerate(words) for a in ANCHORS if word.startswith(a)})


def _windows(tokens: Column, anchors: list[tuple[str, int, int]]) -> Column:
    """The parts of ``tokens`` on which a template's anchor meets one of the text."""
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(at).alias("at"), F.lit(n).alias("n")) for a, at, n in anchors])
    place = F.transform(tokens, lambda t, i: F.when(t.rlike("^(?:" + "|".join(ANCHORS) + ")"), i))
    place = F.filter(place, lambda i: i.isNotNull())
    first = lambda i, x: F.greatest(i - x["at"], F.lit(0))
    cut = lambda i, x: F.slice(tokens, first(i, x) + 1, i - x["at"] + x["n"] - first(i, x))
    return F.flatten(F.transform(place, lambda i: F.transform(F.filter(pairs, lambda x: F.get(tokens, i).startswith(x["a"])), lambda x: cut(i, x))))


def _segments(docs: DataFrame, anchors: list[tuple[str, int, int]]) -> DataFrame:
    """(file, whole, segment): headers, and the whole text of files that have one."""
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(CUES))
    rows = docs.filter(F.col("text").rlike(CUES)).withColumn("lines", lines).withColumn("tokens", terms(_versions(F.col("text"))))
    tokens = lambda line: terms(_versions(line))
    cut = lambda t: F.when(F.size(t) <= WINDOW, F.array(t)).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - WINDOW // 2, F.lit(1)), F.lit(WINDOW // 2)), lambda at: F.slice(t, at, WINDOW))
    )
    headers = F.flatten(F.transform("lines", lambda line: cut(tokens(line))))
    headers = F.array_distinct(F.concat(headers, _windows(F.col("tokens"), anchors)) if anchors else headers)
    parts = F.transform(headers, lambda t: F.struct(F.lit(False).alias("whole"), t.alias("terms")))
    all_parts = F.concat(parts, F.array(F.struct(F.lit(True).alias("whole"), F.col("tokens").alias("terms"))))
    return rows.select("file", F.explode(all_parts).alias("part")).select("file", "part.whole", "part.terms").filter(F.size("terms") > 0)


def scan(
    docs: DataFrame, path: Column, *, doc_id: str = "doc_id", text: str = "text", templates: Mapping[str, tuple[str, ...]] = TEMPLATES
) -> DataFrame:
    """(doc_id, path, own_license, similarity, is_license_file, license, inherited_from) of every row."""
    spark = docs.sparkSession
    names = [(name, k, notice) for name, notices in templates.items() for k, notice in enumerate(notices)]
    models = spark.createDataFrame(names, "license string, k int, notice string").withColumn("terms", terms(_versions(F.col("notice"))))
    needed = F.filter(F.array_distinct("terms"), lambda t: t.rlike(NAMES))
    models = models.withColumn("n_needed", F.size(needed))
    notices = [r["terms"] for r in models.select("terms").collect()]
    vocabulary = sorted({t for words in notices for t in words})
    body = whole(F.col(text))
    files = docs.select(F.col(doc_id).alias("doc_id"), path.alias("path"), body.alias("text"))
    files = files.withColumn("file", F.xxhash64("path", "doc_id", "text"))
    known = F.array(*map(F.lit, vocabulary))
    present = files.select(F.explode(F.array_intersect(terms(F.col("text")), known)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = files.count()
    idf = stored(present.select("term", (F.log(F.lit(1.0 + n) / (1 + F.col("df"))) + 1).alias("idf")), "licenses-idf")
    unseen = F.log(F.lit(1.0 + n)) + 1
    segments = stored(_segments(files, _anchors(notices)).withColumn("segment", F.xxhash64("whole", F.array_join("terms", " "))), "licenses-segments")
    distinct = segments.dropDuplicates(["segment"]).select("segment", "whole", "terms")
    target = _vectors(models, ["license", "k", "n_needed"], idf, unseen).withColumnRenamed("weight", "other")
    shared = _vectors(distinct, ["segment", "whole"], idf, unseen).join(F.broadcast(target), "term").groupBy("segment", "whole", "license", "k", "n_needed")
    cosines = shared.agg(F.sum(F.col("weight") * F.col("other")).alias("cosine"), F.count_if(F.col("term").rlike(NAMES)).alias("n_found"))
    cosines = cosines.filter(F.col("whole") | (F.col("n_found") == F.col("n_needed"))).groupBy("segment", "license").agg(F.max("cosine").alias("cosine"))
    best = cosines.groupBy("segment").agg(F.max("cosine").alias("cosine"), F.min_by("license", F.struct(-F.col("cosine"), "license")).alias("license"))
    scored = segments.select("file", "whole", "segment").distinct().join(best, "segment")
    header = F.when(~F.col("whole") & (F.col("cosine") >= LIMIT), F.struct((-F.col("cosine")).alias("cosine"), "license"))
    of_file = scored.groupBy("file").agg(F.min(header).alias("best"), F.max(F.when(F.col("whole"), F.col("cosine"))).alias("whole_cosine"))
    rows = files.select("doc_id", "path", "file").join(of_file, "file", "left")
    is_file = (F.col("whole_cosine") >= FILE_LIMIT) | (F.col("path").rlike(FILE_NAMES) & F.col("best").isNotNull())
    rows = rows.select(
        "doc_id",
        "path",
        F.col("best.license").alias("own_license"),
        (-F.col("best.cosine")).alias("similarity"),
        F.coalesce(is_file & F.col("best").isNotNull(), F.lit(False)).alias("is_license_file"),
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"),
    )
    rows = stored(rows.withColumn("dir", F.when(F.col("path").isNotNull(), F.col("dir"))), "licenses-own")
    return _inherited(rows)


def _inherited(rows: DataFrame) -> DataFrame:
    """Adds what the nearest ancestor directory with a licence file gives, by joining every directory's ancestors."""
    given = rows.filter("is_license_file and dir is not null").groupBy(F.col("dir").alias("above"))
    given = given.agg(F.min_by(F.struct("own_license", "path"), F.struct(-F.col("similarity"), "path")).alias("given"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    sizes = rows.filter(F.col("dir").isNotNull()).groupBy("dir").count()
    steps = sizes.select("dir", F.posexplode(F.array_distinct(above)).alias("depth", "above"))
    nearest = stored(steps.join(given, "above").groupBy("dir").agg(F.max_by("given", "depth").alias("given")), "licenses-nearest")
    # a large directory's rows stay where they are and meet the few large directories by broadcast
    large = sizes.filter(F.col("count") > LARGE * rows.count()).select("dir", F.lit(True).alias("large"))
    large = stored(large, "licenses-large")
    sized = rows.join(F.broadcast(large), "dir", "left")
    stay = sized.filter(F.col("large") | F.col("dir").isNull())
    few = F.broadcast(nearest.join(F.broadcast(large), "dir", "left_semi"))
    others = sized.filter(F.col("large").isNull() & F.col("dir").isNotNull())
    out = stay.join(few, "dir", "left").unionByName(others.join(nearest, "dir", "left"))
    inherits = F.col("own_license").isNull()
    return out.select(
        "doc_id",
        "path",
        "own_license",
        F.round("similarity", 6).alias("similarity"),
        "is_license_file",
        F.coalesce("own_license", "given.own_license").alias("license"),
        F.when(inherits, F.col("given.path")).alias("inherited_from"),
    )
