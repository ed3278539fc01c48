"""Licence scan: sparse TF-IDF cosine to templates and inheritance from directories.

DataFrame operations only.  Passages that speak of a licence are cut out of whole texts, and
equal passages are scored once, as sparse term vectors joined by term with the templates.
A file without a licence of its own takes that of the licence file in its nearest
ancestor directory; ancestors are joined per directory, not per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import materialize, query, table

# Public licence notices in their usual wording.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
]
SIGNS = (
    r"(?i)licen[sc]e|permission is hereby granted|redistribution and use|public domain|"
    r"creative commons|\bgnu\b|free software|mozilla public|spdx"
)
#: A header: lines in a row that begin with a comment mark.
COMMENT = r"(?m)(?:^[ \t]*(?://|/?\*|#|--|;|%|<!--)[^\n]*(?:\n|\z))++"
LICENCE_FILE = r"(?i)(?:^|/)(?:un)?(?:licen[sc]e|copying|notice)[^/]*$"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z]+|[0-9]+(?:\.[0-9]+)*"), 0)


def passages(text: Column, whole_file: Column) -> Column:
    """Distinct passages that speak of a licence: lines, comment blocks, and the text of a licence file."""
    cut = F.concat(
        F.split(text, r"\r?\n"), F.regexp_extract_all(text, F.lit(COMMENT), 0), F.when(whole_file, F.array(text)).otherwise(F.array())
    )
    signed = F.array_distinct(F.filter(cut, lambda p: p.rlike(SIGNS)))
    return F.when(text.rlike(SIGNS), signed).otherwise(F.array().cast("array<string>"))


def _weights(counts: DataFrame, idf: DataFrame) -> DataFrame:
    """Term vectors (``vector``, ``term``, ``weight``) of length one."""
    raw = counts.join(idf, "term").withColumn("weight", F.col("tf") * F.col("idf"))
    norms = raw.groupBy("vector").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return raw.join(norms, "vector").select("vector", "term", (F.col("weight") / F.col("norm")).alias("weight"))


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.7) -> DataFrame:
    """Licences of ``files`` (``file_id``, ``path``, ``text``).

    Returns per row ``file_id``, ``path``, ``license``, ``cosine`` (of its own best passage, null without
    one), ``origin`` (``header``, ``licence file``, ``inherited`` or null) and ``inherited_from``, the
    directory.  The best template wins, of equals the first in the list; in a directory with several
    licence files the one that fits best, then the smallest name.  Inverse frequencies count
    passages of all files and the templates.  A null text has no licence of its own, a null path no
    directory; rows that share id and path are one file and are all returned.
    """
    spark = files.sparkSession
    named = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    rows = files.select("file_id", "path", "text", F.xxhash64("file_id", "path").alias("file"), named.alias("named"))
    hits = materialize(
        rows.where("text IS NOT NULL")
        .select("file", "named", "path", F.explode(F.transform(passages(F.col("text"), F.col("named")), _terms)).alias("terms"))
        .where(F.size("terms") > 0)
        .withColumn("vector", F.xxhash64("terms")),
        "licence-passages",
    )
    listed = F.array(*[F.struct(F.lit(-1 - i).cast("long").alias("vector"), F.lit(t).alias("text")) for i, (_, t) in enumerate(templates)])
    known = spark.range(1).select(F.explode(listed).alias("t")).select("t.*")
    own = hits.groupBy("vector").agg(F.count(F.lit(1)).alias("n"), F.first("terms").alias("terms"))

    def counted(vectors: DataFrame) -> DataFrame:
        return vectors.select("vector", "n", F.explode("terms").alias("term")).groupBy("vector", "n", "term").agg(
            F.count(F.lit(1)).alias("tf")
        )

    passage_terms = counted(own)
    template_terms = counted(known.select("vector", F.lit(1).cast("long").alias("n"), _terms(F.col("text")).alias("terms")))
    total = (own.agg(F.sum("n")).first()[0] or 0) + len(templates)
    idf = (
        passage_terms.unionByName(template_terms)
        .groupBy("term")
        .agg((F.log((F.lit(total) + 1.0) / (F.sum("n") + 1.0)) + 1.0).alias("idf"))
    )
    # the templates are a fixed list of short texts: a bounded side to broadcast
    pattern = _weights(template_terms, idf).select(F.col("vector").alias("template"), "term", F.col("weight").alias("other"))
    dots = (
        _weights(passage_terms, idf)
        .join(F.broadcast(pattern), "term")
        .groupBy("vector", "template")
        .agg(F.round(F.sum(F.col("weight") * F.col("other")), 9).alias("cosine"))
    )
    best = dots.groupBy("vector").agg(F.max(F.struct("cosine", "template")).alias("best"))
    names = F.array(*[F.lit(n) for n, _ in templates])
    own_best = materialize(
        hits.join(best, "vector")
        .groupBy("file")
        .agg(F.max("best").alias("best"), F.max("named").alias("named"), F.min("path").alias("path"))
        .where(F.col("best.cosine") >= threshold)
        .select(
            "file", "named", "path", F.col("best.cosine").alias("cosine"),
            F.element_at(names, (-F.col("best.template")).cast("int")).alias("own"),
        ),
        "licence-own",
    )

    def parent(path: str = "path") -> Column:
        return F.regexp_replace(F.col(path), "/?[^/]*$", "")

    granted = (
        own_best.where("named AND path IS NOT NULL")
        .groupBy(parent().alias("above"))
        .agg(F.min(F.struct((-F.col("cosine")).alias("order"), "path", "own")).alias("first"))
        .select("above", F.col("first.own").alias("given"))
    )
    parts = F.split("directory", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    nearest = (
        rows.where("path IS NOT NULL")
        .select(parent().alias("directory"))
        .distinct()
        .select("directory", F.posexplode(ancestors).alias("depth", "above"))
        .join(granted, "above")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "above", "given")).alias("near"))
        .select("directory", F.col("near.above").alias("above"), F.col("near.given").alias("given"))
    )
    found = (
        rows.select("file_id", "path", "file", "named", parent().alias("directory"))
        .join(own_best.select("file", "cosine", "own"), "file", "left")
        .join(nearest, "directory", "left")
    )
    return found.select(
        "file_id", "path",
        F.coalesce("own", "given").alias("license"),
        "cosine",
        F.when(F.col("own").isNotNull(), F.when(F.col("named"), "licence file").otherwise("header"))
        .when(F.col("given").isNotNull(), "inherited")
        .alias("origin"),
        F.when(F.col("own").isNull(), F.col("above")).alias("inherited_from"),
    )


@query("op10_licenses")
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a folder per source, thousand and hundred of ids; a text that opens with a
    licence line is the licence file of its folder."""
    docs = table(spark, sf_dir, "documents")
    opening = F.substring_index("text", "\n", 1)
    name = F.when(opening.rlike(SIGNS), F.lit("LICENSE")).otherwise(F.lit("text"))
    folder = [F.col("source"), F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 100)]
    path = F.concat_ws("/", *folder, F.concat_ws("-", name, F.col("doc_id")))
    found = scan(docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text"))
    return found.withColumnRenamed("file_id", "doc_id")
