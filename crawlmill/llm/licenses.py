"""License scans: sparse TF-IDF cosine to templates, then inheritance along directories.

Whole texts, their paragraphs and their lines are compared with notices of known licenses. Equal
passages are scored once. A file without a license of its own takes that of the nearest directory
above it that has a license file. Joins, aggregations and column expressions only.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmill.llm.common import text_or_empty
from crawlmill.session import materialize

# The notices that the licenses themselves ask for, and their short forms.
TEMPLATES = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work and dedicates it to the public domain."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Every template has one of these; only the check SQL compares no others.
ANCHOR = "licen[cs]|copyright|public domain|redistribut|permission"
WORD = r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"
LICENSE_FILE = r"^(licen[cs]e|copying|unlicense)([.-][a-z0-9.-]*)?$"
LEAST = 0.6


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _template_terms(spark: SparkSession) -> DataFrame:
    """(license, template, term, tf): as many rows as the templates have words."""
    given = spark.createDataFrame([(n, name, text) for n, (name, text) in enumerate(TEMPLATES)], "template int, license string, text string")
    return given.select("template", "license", F.explode(_words(F.col("text"))).alias("term")).groupBy("template", "license", "term").agg(F.count("*").alias("tf"))


def template_weights(docs: DataFrame) -> tuple[DataFrame, int]:
    """(template, license, term, idf, weight) with unit vectors, and the number of documents.

    idf = ln((1 + documents) / (1 + documents with the term)) + 1, over all documents.
    """
    terms = _template_terms(docs.sparkSession)
    vocabulary = F.broadcast(terms.select("term").distinct())  # the words of the templates
    counts = docs.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("term")).join(vocabulary, "term")
    counts = counts.groupBy("term").agg(F.count("*").alias("df"))
    total = docs.count()
    idf = F.log((1.0 + total) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0
    weighed = terms.join(counts, "term", "left").withColumn("idf", idf)
    norms = weighed.groupBy("template").agg(F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("norm"))
    weights = weighed.join(norms, "template").withColumn("weight", F.col("tf") * F.col("idf") / F.col("norm"))
    return materialize(weights.select("template", "license", "term", "idf", "weight"), "template_weights"), total


def _can_reach(text: Column, weights: list) -> Column:
    """Whether a passage with the words of ``text`` can have a score of LEAST; an exact bound.

    A cosine is at most the root of the squared weights of the template's words that the passage has.
    A template's lightest words alone stay below, so a passage without any of the others is out first.
    """
    bound = (LEAST - 1e-5) ** 2  # scores are rounded
    templates: dict[int, list] = {}
    for row in weights:
        templates.setdefault(row.template, []).append((row.weight**2, row.term))
    heavy, of = set(), {}
    for n, terms in templates.items():
        light = 0.0
        for square, term in sorted(terms):
            light += square
            if light >= bound:
                heavy.add(term)
            of.setdefault(term, []).append({"template": n, "square": square})
    # Constants that the optimizer folds; as expressions of their own they take long to plan.
    constants = lambda terms: F.split(F.lit(" ".join(sorted(terms))), " ")
    words = F.array_intersect(_words(text), constants(of))  # each once
    squares = F.from_json(F.lit(json.dumps(of)), "map<string, array<struct<template: int, square: double>>>")
    # Sorted by template, a run of equal ones is summed up.
    start = F.struct(F.lit(-1).alias("template"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("most"))

    def add(state: Column, entry: Column) -> Column:
        total = F.when(state["template"] == entry["template"], state["sum"]).otherwise(0.0) + entry["square"]
        return F.struct(entry["template"].alias("template"), total.alias("sum"), F.greatest(state["most"], total).alias("most"))

    def reaches(shared: Column) -> Column:
        entries = F.array_sort(F.flatten(F.transform(shared, lambda w: squares[w])))
        most = F.aggregate(entries, start, add, lambda state: state["most"])
        return F.when(F.arrays_overlap(shared, constants(heavy)), most >= bound).otherwise(False)

    return F.exists(F.array(words), reaches)  # the words are found once


def passages(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """(id, path, key, whole, passage): whole texts, paragraphs and lines that can score LEAST.

    A paragraph has no word that its text lacks, and a line none that its paragraph lacks, so the
    parts of what cannot score are left alone. The driver reads the weights of the templates' words.
    """
    rows = weights.select("template", "term", "weight").collect()
    passage, part = F.col("passage"), F.col("part")
    paragraphs = F.array_distinct(F.split("text", r"\n[\t\r ]*\n"))
    texts = docs.filter(_can_reach(F.col("text"), rows)).withColumn("parts", paragraphs)
    parts = texts.select("id", "path", "text", F.explode(F.concat(F.array("text"), F.filter("parts", lambda p: p != F.col("text")))).alias("part"))
    # The lines of a text in one paragraph are taken from the text, else from the paragraphs.
    single = ~F.col("text").rlike(r"\n[\t\r ]*\n")
    parts = parts.filter((part == F.col("text")) | _can_reach(part, rows))
    lines = F.when((part != F.col("text")) | single, F.filter(F.array_distinct(F.split("part", "\n")), lambda l: l != part))
    cut = F.concat(F.array("part"), F.coalesce(lines, F.array().cast("array<string>")))
    found = parts.select("id", "path", "text", "part", F.explode(cut).alias("passage"))
    found = found.filter((passage == part) | _can_reach(passage, rows))
    return found.select(
        "id", "path", F.md5("passage").alias("key"), (F.col("passage") == F.col("text")).alias("whole"), "passage"
    )


def score_passages(distinct: DataFrame, weights: DataFrame, documents: int) -> DataFrame:
    """(key, license, score) of passages (key, passage) near enough to a template; the nearest one.

    A word that no template has weighs like one that no document has. Scores are rounded to six
    places; ties go to the first license by name.
    """
    terms = distinct.select("key", F.explode(_words(F.col("passage"))).alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf"))
    idfs = F.broadcast(weights.select("term", "idf").distinct())
    rare = F.log(F.lit(1.0 + documents)) + 1.0
    terms = terms.join(idfs, "term", "left").withColumn("value", F.col("tf") * F.coalesce("idf", rare)).drop("idf")
    norms = terms.groupBy("key").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("norm"))
    products = terms.join(F.broadcast(weights.drop("idf")), "term").groupBy("key", "template", "license")
    products = products.agg(F.sum(F.col("value") * F.col("weight")).alias("product"))
    scores = products.join(norms, "key").withColumn("score", F.round(F.col("product") / F.col("norm"), 6))
    scores = scores.filter(F.col("score") >= LEAST).groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("below"), "license")).alias("best"))
    return scores.select("key", "best.license", (-F.col("best.below")).alias("score"))


def directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def _ancestors(dir_: Column) -> Column:
    """(depth, dir) of a directory and all above it, down to the root ''."""
    parts = F.split(dir_, "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")),
    )
    root = F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("above")))
    return F.when(dir_ == "", root).otherwise(F.concat(root, above))


def scan_licenses(
    files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``files``: id, license, score, origin (file, header or inherited), from_dir.

    ``origin`` is 'file' where the whole text is a notice, or the file has the name of a license file
    and a notice anywhere; 'header' where a paragraph or line is one. Else the license is inherited
    from the nearest directory, the file's own first, with a license file (of several in a directory
    the best score, then the first by name), with ``from_dir`` the directory and null score. All are
    null where there is none. Null texts count as empty; a null path has no directory and inherits
    nothing; a row with a null id can only inherit. Rows that repeat an id share the best of their notices. Other columns are not read; an
    empty table gives an empty result.

    Whole texts are read and the counts of the words of the templates cover all documents. Equal
    passages are scored once, so a notice in very many files is one row; files and directories meet
    their results in joins that can be split.
    """
    docs = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), text_or_empty(text_col).alias("text"))
    weights, total = template_weights(docs)
    found = materialize(passages(docs, weights), "license_passages")
    distinct = found.groupBy("key", "passage").agg(F.count("*").alias("n")).select("key", "passage")
    scored = materialize(score_passages(distinct, weights, total), "scored_passages")
    held = found.select("id", "path", "key", "whole").join(scored, "key")
    base = F.lower(F.regexp_extract("path", "([^/]*)$", 1))
    as_file = F.col("whole") | F.coalesce(base.rlike(LICENSE_FILE), F.lit(False))
    order = F.struct((~as_file).alias("header"), (-F.col("score")).alias("below"), "license")
    own = held.groupBy("id", "path").agg(F.min(order).alias("best"))
    own = materialize(
        own.select("id", "path", "best.license", (-F.col("best.below")).alias("score"), F.when(F.col("best.header"), "header").otherwise("file").alias("origin")),
        "own_licenses",
    )
    files_of = own.filter("origin = 'file' and path is not null")
    dirs = files_of.groupBy(directory(F.col("path")).alias("above")).agg(
        F.min(F.struct((-F.col("score")).alias("below"), "license")).alias("best")
    )
    dirs = dirs.select("above", "best.license")
    all_dirs = docs.filter("path is not null").select(directory(F.col("path")).alias("dir")).distinct()
    steps = all_dirs.select("dir", F.explode(_ancestors(F.col("dir"))).alias("step")).select("dir", "step.depth", "step.above")
    nearest = steps.join(dirs, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "license")).alias("at"))
    nearest = materialize(nearest.select("dir", F.col("at.license").alias("inherited"), F.col("at.above").alias("from_dir")), "directory_licenses")
    by_id = own.groupBy("id").agg(F.min(F.struct((F.col("origin") == "header").alias("h"), (-F.col("score")).alias("below"), "license")).alias("best"))
    by_id = materialize(by_id.filter("id is not null").select("id", "best"), "licenses_by_id")
    rows = docs.select("id", directory(F.col("path")).alias("dir")).join(by_id, "id", "left").join(nearest, "dir", "left")
    mine = F.col("best").isNotNull()
    return rows.select(
        F.col("id").alias(id_col),
        F.coalesce("best.license", "inherited").alias("license"),
        (-F.col("best.below")).alias("score"),
        F.when(mine, F.when(F.col("best.h"), "header").otherwise("file")).when(F.col("inherited").isNotNull(), "inherited").alias("origin"),
        F.when(~mine, F.col("from_dir")).alias("from_dir"),
    )


def oracle_sql(source: str) -> str:
    """DuckDB SQL for ``scan_licenses`` of the rows (id, path, text) of the SQL ``source``."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    templates = ", ".join(f"({n}, {quoted(name)}, {quoted(text)})" for n, (name, text) in enumerate(TEMPLATES))
    words = lambda c: f"regexp_extract_all(lower({c}), {quoted(WORD)})"
    return f"""
    WITH docs AS MATERIALIZED ({source}),
    templates(template, license, text) AS (VALUES {templates}),
    tt AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest({words("text")}) AS term FROM templates) GROUP BY ALL),
    vocabulary AS (SELECT DISTINCT term FROM tt),
    df AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({words("text")})) AS term FROM docs) JOIN vocabulary USING (term) GROUP BY term),
    total AS (SELECT count(*) AS n FROM docs),
    idf AS (SELECT term, ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1 AS idf FROM vocabulary LEFT JOIN df USING (term), total),
    weighed AS (SELECT template, license, term, tf * idf AS v FROM tt JOIN idf USING (term)),
    weights AS MATERIALIZED (SELECT template, license, term, v / sqrt(sum(v * v) OVER (PARTITION BY template)) AS weight FROM weighed),
    cut AS (SELECT id, path, text, unnest(list_distinct(list_concat([text], regexp_split_to_array(text, '\\n[\\t\\r ]*\\n'), string_split(text, chr(10))))) AS passage
            FROM docs WHERE regexp_matches(lower(text), '{ANCHOR}')),
    found AS MATERIALIZED (SELECT id, path, passage = text AS whole, passage FROM cut WHERE regexp_matches(lower(passage), '{ANCHOR}')),
    terms AS (SELECT passage, term, count(*) AS tf FROM (SELECT passage, unnest({words("passage")}) AS term FROM (SELECT DISTINCT passage FROM found)) GROUP BY ALL),
    vals AS MATERIALIZED (SELECT passage, term, tf * coalesce(idf, ln(1.0 + n) + 1) AS v FROM terms LEFT JOIN idf USING (term), total),
    norms AS (SELECT passage, sqrt(sum(v * v)) AS norm FROM vals GROUP BY passage),
    scores AS (SELECT passage, license, round(sum(v * weight) / any_value(norm), 6) AS score FROM vals JOIN weights USING (term) JOIN norms USING (passage) GROUP BY passage, template, license),
    scored AS (SELECT passage, license, score FROM scores WHERE score >= {LEAST} QUALIFY row_number() OVER (PARTITION BY passage ORDER BY score DESC, license) = 1),
    held AS (SELECT id, path, license, score, NOT (whole OR coalesce(regexp_matches(lower(regexp_extract(path, '([^/]*)$', 1)), {quoted(LICENSE_FILE)}), false)) AS header FROM found JOIN scored USING (passage)),
    own AS (SELECT * FROM held QUALIFY row_number() OVER (PARTITION BY id, path ORDER BY header, score DESC, license) = 1),
    by_id AS (SELECT id, license, score, header FROM own QUALIFY row_number() OVER (PARTITION BY id ORDER BY header, score DESC, license) = 1),
    dirs AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, license FROM own WHERE NOT header AND path IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY regexp_extract(path, '^(.*)/[^/]*$', 1) ORDER BY score DESC, license) = 1),
    placed AS (SELECT id, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, path FROM docs),
    near AS (SELECT p.dir, d.dir AS above, d.license FROM (SELECT DISTINCT dir FROM placed WHERE path IS NOT NULL) p JOIN dirs d ON d.dir = '' OR p.dir = d.dir OR starts_with(p.dir, d.dir || '/')
             QUALIFY row_number() OVER (PARTITION BY p.dir ORDER BY length(d.dir) DESC) = 1)
    SELECT p.id AS doc_id, coalesce(b.license, n.license) AS license, b.score,
           CASE WHEN b.id IS NOT NULL THEN CASE WHEN header THEN 'header' ELSE 'file' END WHEN n.license IS NOT NULL THEN 'inherited' END AS origin,
           CASE WHEN b.id IS NULL THEN n.above END AS from_dir
    FROM placed p LEFT JOIN by_id b ON p.id = b.id LEFT JOIN near n ON p.path IS NOT NULL AND p.dir = n.dir
    """


assert all(re.search(ANCHOR, text.lower()) for _, text in TEMPLATES)
