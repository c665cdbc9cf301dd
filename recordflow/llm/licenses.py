"""Licence scan: TF-IDF cosine of headers and licence files to templates, then inheritance along paths.

Units are the lines of a file that speak of a licence, the words around a cue
cut as the templates lie around theirs, and the whole text of a file named like
a licence file. Words run across line ends and comment marks, so a notice inside
a long line or wrapped over several is a unit of its own. Each is a sparse TF-IDF
vector, with document counts over all words of all files, joined term by term to
the templates.

Texts of one family differ in few words, so the cosine alone confuses them: a
template wins only if the unit has its version and its qualifiers (Lesser,
Affero, NonCommercial, ...), and a short unit no other qualifier. An SPDX tag
states its licences itself, known to the templates or not.

A file takes the licence of its best unit. A file without one inherits from the
nearest ancestor directory that holds a licence file, found by joining its
directories' paths.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordflow.llm.common import Stages, bounded, rows_of
from recordflow.llm.pii import term_documents
from recordflow.llm.shingles import word_hashes

#: Opening notices of public licences, as their texts give them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Stands beside notices of any licence, so it yields to one that is named.
RESERVED = "Proprietary"
THRESHOLD = 0.6
CUE = re.compile(r"licen[cs]e|copyright|all rights reserved|redistribut|permission is hereby|permission to use|unencumbered|\bcc by\b", re.IGNORECASE)
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicen[cs]e|notice)([-_.][^/]*)?$"
_NAME = re.compile(LICENCE_FILE.removeprefix("(?i)"), re.IGNORECASE)
_TERM = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([0-9A-Za-z(][0-9A-Za-z.+() \t-]*)", re.IGNORECASE)
_SPDX_WORD = re.compile(r"[()]|[0-9A-Za-z.+-]+")
# Words that tell licences of a family apart, in the forms of titles and of short names.
_QUALIFIERS = {
    "affero": "affero", "lesser": "lesser", "noncommercial": "nc", "nc": "nc", "noderivatives": "nd", "noderivs": "nd", "nd": "nd", "sharealike": "sa", "sa": "sa",
}
_VERSION = re.compile(r"(?<![0-9.])([0-9]{1,2}(?:\.[0-9]{1,2})?)(?![0-9]|\.[0-9])")
#: Units of more words may speak of other licences besides their own.
SHORT = 100


def marks(text: str) -> set[str]:
    """The version numbers of a text (2.0 is 2) and its qualifiers."""
    versions = {v[1].removesuffix(".0") for v in _VERSION.finditer(text)}
    return versions | {_QUALIFIERS[w] for w in _TERM.findall(text.lower()) if w in _QUALIFIERS}


def fits(needed: set[str], found: set[str], n_words: int) -> bool:
    """Has a unit all versions and qualifiers of a template, and a short one no other qualifier?"""
    others = found & set(_QUALIFIERS.values())
    return needed <= found and (n_words > SHORT or others <= needed)


def spdx_expression(tag: str) -> str:
    """The ids of a tag's expression in their usual spelling, with its operators; text after the expression is left out."""
    out, due = [], True  # is an id due?
    for word in _SPDX_WORD.findall(tag):
        if word in "()":
            continue
        if not due:
            if word not in ("OR", "AND", "WITH"):
                break
            out.append(word)
        else:
            plain = word.rstrip(".+-").removesuffix("-only").removesuffix("-or-later")
            out.append(_KNOWN.get(plain.lower(), plain))
        due = not due
    return " ".join(out if not due else out[:-1])


_KNOWN = {name.lower(): name for name, _ in TEMPLATES if name != RESERVED}


def terms(text: str) -> list[bytes]:
    """The words, less SPDX tags."""
    return [t.encode("utf-8", "surrogatepass") for t in _TERM.findall(_SPDX.sub(" ", text).lower())]


def counted(text: str) -> list[dict]:
    """Term hashes with their counts."""
    found = Counter(terms(text))
    return [{"t": t, "tf": n} for t, n in zip(word_hashes(list(found)).view(np.int64).tolist(), found.values())]


def cue_places(templates) -> dict[str, set[tuple[int, int]]]:
    """For the word or else the kind of a cue: how many words of a template stand before its place, and from it on."""
    places = defaultdict(set)
    for _, text in templates:
        words = list(_TERM.finditer(text))
        starts = [w.start() for w in words]
        for cue in CUE.finditer(text):
            k = bisect_right(starts, cue.start()) - 1
            places[words[k].group().lower()].add((k, len(words) - k))
            places[_kind(cue)].add((k, len(words) - k))
    return dict(places)


def _kind(cue: re.Match) -> str:
    return "cue:" + cue.group()[:5].lower()


def file_units(path: str, text: str, places: dict[str, set[tuple[int, int]]]) -> Iterator[tuple[int, int, str]]:
    """``(start, end, unit)``: all of a licence file, lines with a cue, and the words around each cue as templates have them."""
    if _NAME.match(path.rpartition("/")[2]):
        yield 0, len(text), text
    cues = list(CUE.finditer(text))
    end = -1
    for cue in cues:
        if cue.start() > end:
            start = text.rfind("\n", 0, cue.start()) + 1
            end = text.find("\n", cue.end())
            end = len(text) if end < 0 else end
            yield start, end, text[start:end]
    if not cues:
        return
    spans = [m.span() for m in _TERM.finditer(text)]
    starts = [a for a, _ in spans]
    seen = set()
    for cue in cues:
        k = bisect_right(starts, cue.start()) - 1
        a, b = spans[k]
        for before, on in places.get(text[a:b].lower()) or places.get(_kind(cue), ()):
            window = max(k - before, 0), min(k + on, len(spans))
            if window not in seen:
                seen.add(window)
                start, stop = starts[window[0]], spans[window[1] - 1][1]
                yield start, stop, text[start:stop]


_UNITS = pa.schema(
    [("unit", pa.int64()), ("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("stated", pa.string()), ("fits", pa.list_(pa.int32()))]
    + [("terms", pa.list_(pa.struct([("t", pa.int64()), ("tf", pa.int64())])))]
)


def units(files: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``(unit, path, start, end, stated, fits, terms)``: ``stated`` is an SPDX tag's expression, ``fits`` the templates that may win."""
    places = cue_places(templates)
    needed = [marks(text) for _, text in templates]

    def build(batches):
        base, count = TaskContext.get().partitionId() << 40, 0

        def rows(batch):
            nonlocal count
            for path, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = cell.as_py() or ""
                for tag in _SPDX.finditer(text):
                    stated = spdx_expression(tag[1])
                    if stated:
                        count += 1
                        yield base + count, path, tag.start(), tag.end(), stated, [], []
                for start, end, unit in file_units(path, text, places):
                    count += 1
                    found, n_words = marks(unit), len(_TERM.findall(unit))
                    yield base + count, path, start, end, None, [k for k, need in enumerate(needed) if fits(need, found, n_words)], counted(unit)

        yield from rows_of(batches, _UNITS, rows)

    return files.where("path IS NOT NULL").select("path", "text").mapInArrow(build, "unit long, path string, start long, end long, stated string, fits array<int>, terms array<struct<t:bigint,tf:bigint>>")


def header_licences(files: DataFrame, stages: Stages, templates, threshold: float) -> DataFrame:
    """``(path, licence, score, start, end)``: the best unit of each file that reaches the threshold."""
    spark = files.sparkSession
    found = stages.write(units(files, templates), "units")
    rows = [(k, name, x["t"], x["tf"]) for k, (name, text) in enumerate(templates) for x in counted(text)]
    template = spark.createDataFrame(rows, "template int, licence string, t long, ttf long")  # bounded: the templates' words
    exploded = found.select("unit", F.explode("terms").alias("x")).select("unit", "x.t", "x.tf")
    wanted = stages.write(exploded.select("t").union(template.select("t")).distinct(), "terms")
    documents = term_documents(files).join(bounded(wanted, 16 * wanted.count()), "t", "left_semi")
    documents = stages.write(documents, "counts")
    n_all = F.lit(float(files.count() + 1))
    idf = F.log(n_all / (F.coalesce("n", F.lit(0)) + 1)) + 1
    weighed = exploded.join(documents, "t", "left").select("unit", "t", (F.col("tf") * idf).alias("w"))
    norm = weighed.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    template = template.join(documents, "t", "left").select("template", "licence", "t", (F.col("ttf") * idf).alias("tw"))
    sizes = template.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    template = F.broadcast(template.join(sizes, "template"))  # a few hundred rows, as many as the templates have words
    dot = weighed.join(template, "t").groupBy("unit", "template", "licence").agg((F.sum(F.col("w") * F.col("tw")) / F.first("tnorm")).alias("dot"))
    scored = dot.join(norm, "unit").select("unit", "template", "licence", F.round(F.col("dot") / F.col("norm"), 9).alias("score")).where(F.col("score") >= threshold)
    best = scored.join(found.select("unit", "path", "start", "end", "fits"), "unit").where("array_contains(fits, template)")
    stated = found.where("stated IS NOT NULL").select("path", F.col("stated").alias("licence"), F.lit(1.0).alias("score"), "start", "end")
    best = best.select(*stated.columns).unionByName(stated)
    first = F.struct((F.col("licence") == RESERVED).alias("reserved"), -F.col("score"), "licence", "start", "end", "score")
    return best.groupBy("path").agg(F.min(first).alias("b")).select("path", "b.licence", "b.score", "b.start", "b.end")


def parent(path):
    """The directory of a path, empty at the top."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan_licences(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``(path, licence, origin, score, from_path)`` for every row of ``files(path, text, ...)``.

    ``origin`` is header (a notice in the file), file (a licence file), inherited
    (the nearest ancestor directory with a licence file; ``from_path`` is that
    directory) or null. An SPDX tag gives its whole expression ("Apache-2.0 OR
    MIT"), also of ids that no template has; such a file inherits nothing. Texts
    of any length are scanned whole. The best score wins, then the smaller licence name; "all
    rights reserved" alone yields to any named licence. A null path has no licence; rows that share a path are one file with
    one answer each; null and empty texts have no units; other columns are
    ignored; an empty table gives no rows.
    """
    stages = Stages(files.sparkSession, "licences")
    files = files.select(F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    own = stages.write(header_licences(files, stages, templates, threshold), "own")
    is_file = F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_FILE)
    folders = own.where(is_file).groupBy(parent(F.col("path")).alias("folder")).agg(F.min(F.struct((F.col("licence") == RESERVED).alias("reserved"), -F.col("score"), "licence")).alias("b"))
    folders = folders.select("folder", F.col("b.licence").alias("licence"))
    names = files.where("path IS NOT NULL").select("path")
    used = names.select(parent(F.col("path")).alias("used")).distinct()
    # A directory and its ancestors, the top (empty) included; their number is the path's depth.
    parts = F.split("used", "/")
    above = F.transform(F.sequence(F.lit(0), F.when(F.col("used") == "", 0).otherwise(F.size(parts))), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    climbed = used.select("used", F.explode(above).alias("folder")).join(folders, "folder")
    nearest = climbed.groupBy("used").agg(F.max_by(F.struct("folder", "licence"), F.length("folder")).alias("n")).select("used", "n.folder", F.col("n.licence").alias("given"))
    rows = files.select("path").join(own.withColumnRenamed("path", "own_path"), F.col("path") == F.col("own_path"), "left")
    rows = rows.join(nearest, parent(F.col("path")) == F.col("used"), "left")
    mine = F.col("licence").isNotNull()
    return rows.select(
        "path",
        F.coalesce("licence", "given").alias("licence"),
        F.when(mine, F.when(is_file, "file").otherwise("header")).when(F.col("given").isNotNull(), "inherited").alias("origin"),
        "score",
        F.when(mine, F.col("path")).otherwise(F.col("folder")).alias("from_path"),
    )
