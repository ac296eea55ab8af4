"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory above.

Built of DataFrame operations only.

Units of a file that are compared with the templates are its *headers*, the lines with a cue word
(``CUES``), and its whole text if it has a cue word at all (a licence file). A unit is the bag of its words,
runs of letters and digits in lower case. A word weighs its count times its idf, ln((1 + files) / (1 +
files with it)) + 1, counted over all files for the words of the templates; other words, which only make
units unlike templates, weigh as if no file had them. The cosine of unit and template is a join on their
common words. The best template from ``THRESHOLD`` on is the file's own licence: ``origin`` is ``file`` if
the whole text matches, else ``header``.

A file without a licence of its own inherits that of the nearest directory above it which has one
(``origin`` is ``inherited``). A directory has the licence of a file that governs it: one whose name says so
(LICENSE, COPYING and the like), whose whole text is a licence, or whose first line is its licence header;
of several the best match, then the first path. Chains of directories are joined by path, once for each
different directory, not for each file.

Defined cases: null and empty texts have no licence of their own; null paths inherit nothing. Ties between
templates go to the first licence in order of name, ties between units to the whole text, then the earlier
line. Repeated rows are files like any other. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailymart.llm.license_texts import TEXTS
from dailymart.llm.store import saved

THRESHOLD = 0.6
CUES = "licen[cs]e|copyright|copyleft|spdx|permission|public domain"
LICENCE_FILE = "(?i)^(un)?(licen[cs]e|copying|copyright|notice)([-._].*)?$"

#: Statements by which files declare a licence, beginnings of licence texts, and full texts.
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *TEXTS,
]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _template_words(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """``template, license, word, tf``; as many rows as the templates have words."""
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(templates)], "template int, license string, statement string")
    words = rows.select("template", "license", F.explode(_words(F.col("statement"))).alias("word"))
    return words.groupBy("template", "license", "word").agg(F.count("*").alias("tf"))


def _weights(files: DataFrame, words: list[str]) -> tuple[DataFrame, Column]:
    """``word, idf`` of the templates' words from all files, and the idf of any other word."""
    known = files.sparkSession.createDataFrame([(w,) for w in words], "word string")
    found = files.where("text IS NOT NULL").select(F.explode(F.array_distinct(_words(F.col("text")))).alias("word")).join(F.broadcast(known), "word")
    having = saved(found.groupBy("word").agg(F.count("*").alias("files")), "idf")
    total = files.count()
    every = known.join(having, "word", "left")
    idf = F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.coalesce("files", F.lit(0)))) + 1
    return every.select("word", idf.alias("idf")), F.log(F.lit(1.0 + total)) + 1


def own_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``row, license, similarity, line``: the best match of each row of ``files(row, text)`` that has one.

    ``line`` is -1 for the whole text.
    """
    spark = files.sparkSession
    statements = _template_words(spark, templates)
    words = sorted(r.word for r in statements.select("word").distinct().collect())
    idf, other = _weights(files, words)

    cued = files.where(F.col("text").rlike(f"(?i)({CUES})"))
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda t, i: F.struct(i.alias("line"), t.alias("unit"))),
        lambda u: u["unit"].rlike(f"(?i)({CUES})"),
    )
    whole = F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("unit")))
    units = cued.select("row", F.explode(F.concat(whole, lines)).alias("u")).select("row", "u.line", F.explode(_words(F.col("u.unit"))).alias("word"))
    # Templates are a bounded list of statements: their words go to every task.
    weighed = units.groupBy("row", "line", "word").agg(F.count("*").alias("n")).join(F.broadcast(idf), "word", "left")
    weighed = weighed.withColumn("weight", F.col("n") * F.coalesce("idf", other))
    unit = ["row", "line"]
    norms = weighed.groupBy(*unit).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))

    valued = statements.join(idf, "word").withColumn("value", F.col("tf") * F.col("idf"))
    lengths = valued.groupBy("template").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("length"))
    valued = saved(valued.join(lengths, "template").select("template", "license", "word", (F.col("value") / F.col("length")).alias("value")), "templates")
    dots = (
        weighed.join(F.broadcast(valued), "word")
        .groupBy(*unit, "template", "license")
        .agg(F.sum(F.col("weight") * F.col("value")).alias("dot"))
    )
    cosines = dots.join(norms, unit).withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 6))
    best = F.min(F.struct((-F.col("similarity")).alias("least"), "line", "license")).alias("best")
    return (
        cosines.where(F.col("similarity") >= threshold)
        .groupBy("row")
        .agg(best)
        .select("row", "best.license", (-F.col("best.least")).alias("similarity"), "best.line")
    )


def _directories(directory: Column) -> Column:
    """A directory and all above it, the root ("") included, with their depths."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")),
    )


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files(doc_id, path, text)`` as ``doc_id, path, license, origin, similarity, from_path``.

    ``license`` is null and ``origin`` is ``none`` where nothing declares one. ``similarity`` and
    ``from_path`` are those of the declaring file.
    """
    # 128 bits of the row itself: repeated rows are one to the scan, which only weighs its words.
    halves = [F.xxhash64(F.lit(n), "doc_id", F.coalesce("path", F.lit("")), F.col("path").isNull(), "text") for n in (1, 2)]
    rows = files.select("doc_id", "path", "text", F.struct(*[h.alias(f"h{i}") for i, h in enumerate(halves)]).alias("row"))
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    slim = rows.select("row", "doc_id", "path", F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/").alias("directory"), F.element_at(F.concat(F.array(F.lit("")), parts), -1).alias("name"))
    own = saved(own_licenses(rows.select("row", "text"), templates, threshold), "own")
    found = saved(slim.join(own, "row", "left"), "found")

    governs = (F.col("line") <= 0) | F.col("name").rlike(LICENCE_FILE)
    best = F.min(F.struct((-F.col("similarity")).alias("least"), "path", "license")).alias("best")
    governed = found.where(F.col("license").isNotNull() & F.col("path").isNotNull() & governs).groupBy("directory").agg(best)
    chains = found.where("license IS NULL AND path IS NOT NULL").select("directory").distinct()
    chains = chains.select("directory", F.inline(_directories(F.col("directory"))))
    nearest = (
        chains.join(governed.withColumnRenamed("directory", "above"), "above")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "best")).alias("nearest"))
        .select("directory", F.col("nearest.best").alias("best"))
    )
    inherited = found.join(nearest, "directory", "left")
    has = F.col("license").isNotNull()
    given = ~has & F.col("best").isNotNull()
    origin = F.when(has & (F.col("line") < 0), "file").when(has, "header").when(given, "inherited").otherwise("none")
    return inherited.select(
        "doc_id",
        "path",
        F.when(has, F.col("license")).when(given, F.col("best.license")).alias("license"),
        origin.alias("origin"),
        F.when(has, F.col("similarity")).when(given, -F.col("best.least")).alias("similarity"),
        F.when(has, F.col("path")).when(given, F.col("best.path")).alias("from_path"),
    )


#: Where the documents of the test tables lie: a directory for each source and language, one below for
#: each thousand ids.
def document_path() -> Column:
    return F.concat_ws("/", "source", "lang", (F.col("doc_id") / 1000).cast("long").cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same rows for the documents of the test tables (of distinct ids and without nulls)."""
    values = ",\n".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(templates))
    split = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda w: w <> '')".format
    return f"""
WITH files AS (
  SELECT doc_id, concat_ws('/', source, lang, (doc_id // 1000)::VARCHAR, doc_id::VARCHAR || '.txt') AS path,
         concat_ws('/', source, lang, (doc_id // 1000)::VARCHAR) AS directory, text FROM documents),
templates(template, license, statement) AS (VALUES {values}),
statements AS (
  SELECT template, license, word, COUNT(*) AS tf
  FROM (SELECT template, license, UNNEST({split('statement')}) AS word FROM templates) GROUP BY ALL),
having_it AS (
  SELECT word, COUNT(*) AS n FROM (SELECT DISTINCT doc_id, UNNEST({split('text')}) AS word FROM files)
  WHERE word IN (SELECT word FROM statements) GROUP BY word),
total AS (SELECT COUNT(*) AS n FROM files),
idf AS (
  SELECT s.word, ln((1.0::DOUBLE + (SELECT n FROM total)) / (1.0::DOUBLE + COALESCE(h.n, 0))) + 1 AS idf
  FROM (SELECT DISTINCT word FROM statements) s LEFT JOIN having_it h USING (word)),
lines AS (
  SELECT doc_id, UNNEST(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM files WHERE regexp_matches(text, '{CUES}', 'i')
  UNION ALL SELECT doc_id, text, -1 FROM files),
units AS (SELECT * FROM lines WHERE regexp_matches(unit, '{CUES}', 'i')),
weighed AS (
  SELECT doc_id, line, word, n * COALESCE(idf, ln(1.0::DOUBLE + (SELECT n FROM total)) + 1) AS weight
  FROM (SELECT doc_id, line, word, COUNT(*) AS n FROM (SELECT doc_id, line, UNNEST({split('unit')}) AS word FROM units) GROUP BY ALL)
  LEFT JOIN idf USING (word)),
norms AS (SELECT doc_id, line, sqrt(SUM(weight * weight)) AS norm FROM weighed GROUP BY ALL),
lengths AS (SELECT template, sqrt(SUM(tf * idf * tf * idf)) AS length FROM statements JOIN idf USING (word) GROUP BY ALL),
matched AS (
  SELECT doc_id, line, license, round(SUM(weight * tf * idf / length) / ANY_VALUE(norm), 6) AS similarity
  FROM weighed JOIN statements USING (word) JOIN idf USING (word) JOIN lengths USING (template) JOIN norms USING (doc_id, line)
  GROUP BY doc_id, line, template, license),
own AS (
  SELECT doc_id, license, similarity, line FROM matched WHERE similarity >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, line, license) = 1),
found AS (SELECT f.doc_id, path, directory, license, similarity, line FROM files f LEFT JOIN own USING (doc_id)),
governed AS (
  SELECT directory, license, similarity, path FROM found WHERE license IS NOT NULL AND line <= 0
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY similarity DESC, path) = 1),
inherited AS (
  SELECT f.doc_id, g.license, g.similarity, g.path FROM found f
  JOIN governed g ON f.directory = g.directory OR f.directory LIKE g.directory || '/%' OR g.directory = ''
  WHERE f.license IS NULL
  QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(g.directory) DESC) = 1)
SELECT f.doc_id, f.path, COALESCE(f.license, i.license) AS license,
       CASE WHEN f.license IS NOT NULL AND f.line < 0 THEN 'file' WHEN f.license IS NOT NULL THEN 'header'
            WHEN i.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       COALESCE(f.similarity, i.similarity) AS similarity,
       CASE WHEN f.license IS NOT NULL THEN f.path ELSE i.path END AS from_path
FROM found f LEFT JOIN inherited i USING (doc_id)"""
