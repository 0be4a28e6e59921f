"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest licence file above.

Every line of a file (a possible header) and the whole text of a licence file are compared with short licence statements. Weights are
term counts times inverse document frequency over all files, counted for the terms of the templates; any
other term counts as found in one file. A file without a statement of its own takes the licence of the nearest directory above it that
holds a licence file with one.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanquarry.llm.tables import batch_of, rows_of, stored

#: Cosine from which a line or licence file is taken for a template's licence.
THRESHOLD = 0.6

# fixed values: licence identifiers and statements by which files name them
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# fixed values: how licence files begin
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([.\-_].*)?$"

_TERM = re.compile(r"[^\W_]+(?:\.\d+)*")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class Matcher:
    """Cosine of a text to every template."""

    def __init__(self, templates, frequency: dict[str, int], files: int):
        self.rare = math.log(1 + files) + 1
        self.idf = {t: math.log((1 + files) / (1 + frequency.get(t, 0))) + 1 for _, text in templates for t in terms(text)}
        self.names, self.postings = [name for name, _ in templates], {}
        for n, (_, text) in enumerate(templates):
            weights = {t: k * self.idf[t] for t, k in Counter(terms(text)).items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            for t, w in weights.items():
                self.postings.setdefault(t, []).append((n, w / norm))

    def best(self, text: str, least: float) -> tuple[str, float] | None:
        found = Counter(terms(text))
        known = [(t, k * self.idf[t]) for t, k in found.items() if t in self.idf]
        inside = sum(w * w for _, w in known)
        # a text whose template terms make up too little of its length cannot reach the threshold
        outside = sum(k * k for t, k in found.items() if t not in self.idf) * self.rare**2
        if not known or inside < least * least * (inside + outside):
            return None
        dots = [0.0] * len(self.names)
        for t, w in known:
            for n, v in self.postings[t]:
                dots[n] += w * v
        top = max(range(len(dots)), key=lambda n: (dots[n], -n))
        score = dots[top] / math.sqrt(inside + outside)
        return (self.names[top], score) if score >= least else None


def own_licenses(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (path, text) with the licence each file states itself: license, score, is_file (null: none)."""
    wanted = sorted({t for _, text in templates for t in terms(text)})
    count_schema = pa.schema([("term", pa.string()), ("n", pa.int64())])

    def count(batches):
        seen, vocabulary, n = Counter(), set(wanted), 0
        for (texts,) in rows_of(batches, "text"):
            for text in texts:
                seen.update(vocabulary.intersection(terms(text or "")))
            n += len(texts)
        yield batch_of(count_schema, [*seen, ""], [*seen.values(), n])

    # a row per term of the templates
    frequency = {r["term"]: r["n"] for r in files.select("text").mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    matcher = Matcher(templates, frequency, frequency.get("", 0))
    named = files.withColumn("is_file", F.coalesce(F.rlike(F.element_at(F.split("path", "/"), -1), F.lit(LICENSE_FILE)), F.lit(False)))
    made = pa.schema([("license", pa.string()), ("score", pa.float64())])
    columns = [c for c in files.columns if c not in ("text", "license", "score", "is_file")]

    def match(batches):
        for batch in batches:
            out = []
            for text, whole in zip(batch.column("text").to_pylist(), batch.column("is_file").to_pylist()):
                tries = (text or "").splitlines() + [text or ""] * whole
                hits = [hit for hit in (matcher.best(t, threshold) for t in tries) if hit]
                out.append(max(hits, key=lambda h: h[1]) if hits else (None, None))
            extra = batch_of(made, *(zip(*out) if out else ([], [])))
            kept = [*columns, "is_file"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *extra.columns], names=[*kept, *made.names])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in files.schema if f.name in columns)
    return named.select(*columns, "is_file", "text").mapInArrow(match, kinds + "is_file boolean, license string, score double")


def license_scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Columns of ``files`` (path, text, ...) but the text, with license, score, from_path and inherited.

    A file keeps its best statement (most similar; ties: the earliest line). Otherwise it inherits from the
    nearest directory above; of several licence files in a directory the most similar counts, then the smallest path. A
    null path neither gives nor inherits; null and empty texts state nothing; repeated rows give repeated rows; columns
    named license, score, from_path or inherited are replaced; an empty table gives no rows.
    """
    own = stored(own_licenses(files, templates, threshold).withColumn("file", F.monotonically_increasing_id()), "licenses")
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    given = (
        own.where("is_file AND license IS NOT NULL AND path IS NOT NULL")
        .groupBy(folder.alias("folder"))
        .agg(F.min(F.struct((-F.col("score")).alias("low"), F.col("path").alias("from_path"), "license")).alias("given"))
    )
    parts = F.split(folder, "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("folder")))
    up = own.where("license IS NULL AND path IS NOT NULL").select("file", F.inline(above))
    heirs = (
        up.join(given, "folder").groupBy("file").agg(F.max_by("given", "depth").alias("given"))
    )
    columns = [c for c in own.columns if c not in ("license", "score", "is_file", "file", "from_path", "inherited")]
    return own.join(heirs, "file", "left").select(
        *columns,
        F.coalesce(own["license"], F.col("given.license")).alias("license"),
        F.coalesce(own["score"], -F.col("given.low")).alias("score"),
        F.when(own["license"].isNotNull(), F.col("path")).otherwise(F.col("given.from_path")).alias("from_path"),
        (own["license"].isNull() & F.col("given").isNotNull()).alias("inherited"),
    )
