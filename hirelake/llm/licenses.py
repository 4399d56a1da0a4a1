"""License scans: a trained paragraph classifier with an unknown class, confirmed against templates.

Only DataFrame operations: n-grams are arrays, the classifier is multinomial logistic regression on sparse
n-gram counts, and its weights are a table that paragraphs join.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import documents, stored

#: Notices of licence families (fixed values).
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "MIT License",
        "Licensed under MIT.",
        "Veröffentlicht unter der MIT-Lizenz.",
        "Publié sous licence MIT.",
        "Publicado bajo la licencia MIT.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under Apache 2.0.",
        "Licensed under Apache-2.0.",
        "Apache License 2.0",
        "Lizenziert unter der Apache-Lizenz, Version 2.0.",
        "Publié sous licence Apache 2.0.",
        "Publicado bajo la licencia Apache 2.0.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GPL version 3 or later.",
        "Released under the GPLv3.",
        "Veröffentlicht unter der GNU General Public License, Version 3.",
        "Publié sous licence GNU GPL version 3.",
        "Publicado bajo la licencia GNU GPL versión 3.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "BSD 3-Clause",
        "BSD 2-Clause License",
        "Veröffentlicht unter der BSD-Lizenz.",
        "Publié sous licence BSD.",
        "Publicado bajo la licencia BSD.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Released under MPL 2.0.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Lizenziert unter CC BY 4.0.",
        "Publié sous licence CC BY 4.0.",
        "Publicado bajo la licencia CC BY 4.0.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "CC-BY-ND": [
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-ND 4.0.",
    ],
    "CC-BY-NC-SA": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "CC-BY-NC-ND": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "Released under the LGPLv3.",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPLv3.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "EPL-2.0": [
        "This program is made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, version 2.0.",
    ],
    "CC0-1.0": [
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "Released under CC0.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ],
}
#: Identifiers of the families in SPDX lines (fixed values).
SPDX = {
    "MIT": ["MIT"],
    "Apache-2.0": ["Apache-2.0"],
    "GPL": [f"GPL-{v}{x}" for v in ("2.0", "3.0") for x in ("", "-only", "-or-later")],
    "LGPL": [f"LGPL-{v}{x}" for v in ("2.1", "3.0") for x in ("", "-only", "-or-later")],
    "AGPL": [f"AGPL-3.0{x}" for x in ("", "-only", "-or-later")],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause"],
    "MPL-2.0": ["MPL-2.0"],
    "EPL-2.0": ["EPL-2.0"],
    "ISC": ["ISC"],
    "CC0-1.0": ["CC0-1.0"],
    "Unlicense": ["Unlicense"],
    **{f: [f"{f}-4.0"] for f in TEMPLATES if f.startswith("CC-BY")},
}
for _family, _ids in SPDX.items():
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {i}" for i in _ids]
#: What tells a family apart, in lower case: a paragraph of it has the first and not the second.
MARKS = {
    "MIT": (r"\bmit[ -]li[cz]en[sz]|\blicen(?:ce|cia) mit\b|(?:under(?: the)?|identifier:) mit\b|permission is hereby granted|\bthis permission\b|permission notice shall be included", r"$^"),
    "Apache-2.0": (r"\bapache\b.*\b2(?:\.0)?\b|\bapache li[cz]en", r"\b1\.[01]\b"),
    "GPL": (r"\bgnu general public\b|\bgpl", r"\blesser\b|\baffero\b"),
    "LGPL": (r"\blesser general public\b|\blgpl", r"$^"),
    "AGPL": (r"\baffero general public\b|\bagpl", r"$^"),
    "BSD": (r"\bbsd\b|redistribution and use in source and binary", r"$^"),
    "MPL-2.0": (r"\bmozilla public\b|\bmpl\b", r"\b1\.[01]\b"),
    "EPL-2.0": (r"\beclipse public\b|\bepl\b", r"\b1\.0\b"),
    "ISC": (r"\bisc li[cz]en|identifier: isc\b|permission to use, copy, modify", r"$^"),
    "CC0-1.0": (r"\bcc0\b", r"$^"),
    "Unlicense": (r"\bunlicense\b|unencumbered software released into the public domain", r"$^"),
}
_BY, _SA, _NC, _ND = r"creative commons attribution|\bcc[ -]by\b", r"share-?alike|\b(?:nc-)?sa\b", r"non-?commercial|\bnc\b", r"no-?deriv|\bnd\b"
for _family in [f for f in TEMPLATES if f.startswith("CC-BY")]:
    _has = [(r, _family[5:].find(n) >= 0) for n, r in (("SA", _SA), ("NC", _NC), ("ND", _ND))]
    MARKS[_family] = (
        "^" + "".join(f"(?=.*(?:{r}))" for r, yes in _has if yes) + f".*(?:{_BY})",
        "|".join(r for r, yes in _has if not yes) or r"$^",
    )
#: Paragraphs that speak of licences but grant none.
OTHER = [
    "You need a driving license to rent a car in this city.",
    "The license fee was paid under the old terms of the contract.",
    "All rights reserved. No part of this work may be copied without permission of the author.",
    "The software version of the story is free, and the public may use it in the library.",
    "She was granted a general license to use the source of the river.",
    "Copyright notice of the work of the author and associated files.",
    "The commons are open to the public, and the creative foundation may attribute the work.",
    "He lives under the MIT campus and studied the Apache language for 2 years.",
    "The MIT campus is open to the public and the apache helicopter is not.",
]
UNKNOWN = "unknown"
#: Each mark holds one of these.
CUES = r"(?i)li[cz]en[csz]|permission|redistribut|creative commons|\bcc[ -]?(?:by|0)\b|\bgnu\b|gpl|mozilla|general public|\b[me]pl\b|public domain|\bbsd\b|\bapache\b|eclipse public|under (?:the )?mit\b|identifier:"
#: Each cue holds one of these, in lower case: most lines are told by them and never meet the pattern.
HINTS = [
    "licen", "lizen", "permission", "redistribut", "creative commons", "ccby", "cc by", "cc-by", "cc0", "cc 0", "cc-0", "gnu", "gpl",
    "mozilla", "general public", "mpl", "epl", "public domain", "bsd", "apache", "eclipse public", "under mit", "under the mit", "identifier:",
]
#: Variants of each notice to train and to calibrate on, with words left out, and as how many paragraphs all those
#: of the corpus together weigh in the unknown class, if there are more.
VARIANTS, WEIGH = 24, 2000
#: Share of unknown paragraphs that calibration lets pass, and of n-grams that confirms a template; n-grams that
#: confirm one where no mark tells the family.
PASS, CONFIRM, SHARED = 0.001, 0.6, 12


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once: inside a lambda a repeated expression is computed each time."""
    return F.transform(F.array(value), use)[0]


def terms(text: Column) -> Column:
    """Distinct words and word pairs, in lower case."""

    def with_pairs(word: Column) -> Column:
        last = F.greatest(F.size(word) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(word, 1, last), F.slice(word, 2, last), lambda w, after: F.concat_ws(" ", w, after))
        return F.array_distinct(F.concat(word, pairs))

    return _with(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"), F.lit(0)), with_pairs)


def marked(text: Column) -> Column:
    """The families whose marks a paragraph holds."""
    low = F.lower(text)
    has = [F.when(F.regexp_like(low, F.lit(a)) & ~F.regexp_like(low, F.lit(b)), F.lit(f)) for f, (a, b) in MARKS.items()]
    return F.filter(F.array(*has), lambda f: f.isNotNull())


def _values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _needed(templates: DataFrame) -> tuple[list[str], list[str], int]:
    """(all terms, rare terms, most terms of one): what tells lines that no template can confirm.

    A line with as many terms as a template needs CONFIRM of the template's, so it holds one of any
    (1 - CONFIRM) * size + 1 of them: pairs before words and long before short are taken, as they are rare.
    A shorter line needs CONFIRM of its own terms.
    """
    of: dict[tuple, list[str]] = {}
    for family, template, term in templates.select("family", "template", "term").collect():  # a fixed table
        of.setdefault((family, template), []).append(term)
    rare = set()
    for found in of.values():
        found.sort(key=lambda t: (" " not in t, -len(t), t))
        rare.update(found[: len(found) - math.ceil(CONFIRM * len(found) - 1e-9) + 1])
    return sorted({t for found in of.values() for t in found}), sorted(rare), max(map(len, of.values()))


def _lines(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, x, paragraph, part, n, terms, reaches) of every line; ``reaches``: a template can confirm it.

    ``n`` counts a line's terms; of them ``terms`` holds those of the templates, no other has a weight. x is a hash of
    the text.
    """
    known, rare, most = _needed(templates)

    def part(line: Column, i: Column) -> Column:
        own = _with(terms(line), lambda t: F.struct(F.size(t).alias("n"), F.filter(t, lambda x: x.isin(known)).alias("terms")))
        return F.struct(i.alias("paragraph"), line.alias("part"), own.alias("own"))

    n, shared = F.col("own.n"), F.col("own.terms")
    enough = (F.size(shared) > 0) & (F.size(shared) >= CONFIRM * n - 1e-9)
    reaches = ((n < most) & enough) | F.exists(shared, lambda x: x.isin(rare))
    found = docs.select("doc_id", F.xxhash64("text").alias("x"), F.inline(F.transform(F.split("text", r"\n"), part)))
    return found.select("doc_id", "x", "paragraph", "part", n.alias("n"), shared.alias("terms"), reaches.alias("reaches"))


def _may(part: Column, own: Column) -> Column:
    """The families whose marks a paragraph holds, ``own``; without any, those that its words do not rule out."""
    low = F.lower(part)
    open_ = F.filter(F.array(*[F.when(~F.regexp_like(low, F.lit(b)), F.lit(f)) for f, (_, b) in MARKS.items()]), lambda f: f.isNotNull())
    return F.when(F.size(own) > 0, own).otherwise(open_)


def paragraphs(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, x, paragraph, n, terms, marked, may) of the paragraphs (lines) that a template can confirm.

    Every line is looked at; those that share too few terms with any template to be confirmed are not scored.
    """
    return _scored(_looked_at(docs, templates))


def _looked_at(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """The lines with what scoring and training take of them: (doc_id, x, paragraph, n, terms, reaches, may, plain, v).

    ``may`` is null if no template can confirm the line; ``plain``: it is not blank and of no family by its marks; v deals
    equal lines to training and calibration.
    """
    lines = _lines(docs, templates).withColumn("low", F.lower("part"))
    hint = functools.reduce(operator.or_, [F.contains("low", F.lit(x)) for x in HINTS])
    cue = hint & F.regexp_like("part", F.lit(CUES))
    own = F.when(F.col("reaches") | F.col("cue"), marked(F.col("part"))).otherwise(F.array().cast("array<string>"))
    lines = lines.withColumn("cue", cue)
    lines = lines.withColumn("own", own)
    return lines.select(
        "doc_id", "x", "paragraph", "n", "terms", "reaches",
        (F.size("own") > 0).alias("marked"),
        F.when(F.col("reaches"), _may(F.col("part"), F.col("own"))).alias("may"),
        ((F.trim("part") != "") & (~F.col("cue") | (F.size("own") == 0))).alias("plain"),
        F.pmod(F.xxhash64("part", F.lit(1)), F.lit(2 * VARIANTS)).cast("int").alias("v"),
    )


def _scored(lines: DataFrame) -> DataFrame:
    return lines.where("reaches").select("doc_id", "x", "paragraph", "n", "terms", "marked", "may")


def _templates(spark: SparkSession) -> DataFrame:
    """(family, template, term, size) of the notices."""
    known = [(f, i, t) for f, notices in TEMPLATES.items() for i, t in enumerate(notices)]
    notices = _values(spark, known, "family string, template int, part string").withColumn("terms", terms(F.col("part")))
    return notices.select("family", "template", F.explode("terms").alias("term"), F.size("terms").alias("size"))


def train(spark: SparkSession, lines: DataFrame, templates: DataFrame) -> tuple[DataFrame, list[tuple[str, float]], float]:
    """Weights (term, one column for each class), levels (class, level) and the least probability that is not unknown.

    Trained on the notices and variants of them with words left out, against the paragraphs of OTHER, their variants,
    and every line of the corpus without a mark of a family that no template confirms. Lines with the same terms are one
    row with their number as weight; all lines together weigh as WEIGH, if they are more, so that their number does
    not outweigh the notices. A second set of variants and lines calibrates: the threshold lets PASS of the unknown
    ones through.
    """
    families = list(TEMPLATES)
    known = [(f, t) for f in families for t in TEMPLATES[f]] + [(UNKNOWN, t) for t in OTHER]
    vocabulary = [r[0] for r in templates.select("term").distinct().orderBy("term").collect()]

    rows = _values(spark, known, "family string, part string")
    rows = rows.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(2 * VARIANTS - 1))))
    rows = rows.withColumn("w", F.split("part", " "))
    left = F.filter("w", lambda w, i: (F.col("v") == 0) | (F.pmod(F.xxhash64(w, i, F.col("v")), F.lit(10)) >= F.col("v") % 4))
    rows = rows.select("family", terms(F.array_join(left, " ")).alias("terms"), (F.col("v") < VARIANTS).alias("fit"), F.lit(1).cast("long").alias("c"))
    known_terms = F.filter("terms", lambda x: x.isin(vocabulary))
    rows = rows.withColumn("terms", known_terms).withColumn("corpus", F.lit(False))

    close = F.when(F.col("reaches") & (F.size("terms") >= SHARED), F.col("n"))  # no other line can be a notice
    fit = (F.col("v") < VARIANTS).alias("fit")
    plain = lines.where("plain").groupBy(F.array_sort("terms").alias("terms"), close.alias("n"), fit).agg(F.count("*").alias("c"))
    plain = stored(plain.withColumn("id", F.monotonically_increasing_id()).withColumn("marked", F.lit(False)), "lines")
    notices = _shares(plain.where("n IS NOT NULL"), ["id"], templates).select("id").distinct()
    plain = plain.join(notices, "id", "left_anti")  # notices are not unknown
    rows = rows.union(plain.select(F.lit(UNKNOWN), "terms", "fit", "c", F.lit(True)))
    labels = F.array_position(F.array(*[F.lit(f) for f in [*families, UNKNOWN]]), F.col("family")).cast("double") - 1
    rows = rows.withColumn("label", labels).withColumn("id", F.monotonically_increasing_id())
    rows = stored(rows, "training")
    n_lines = rows.where("corpus").agg(F.sum("c")).first()[0] or 0
    each = max(1.0, n_lines / WEIGH)  # lines that weigh as one
    weight = F.when(F.col("corpus"), F.col("c") / F.lit(each)).otherwise(1.0)

    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="features").setBinary(True)
    learner = LogisticRegression(regParam=0.002, maxIter=60, family="multinomial", standardization=False, weightCol="weight")
    model = learner.fit(vectors.transform(rows.where("fit").withColumn("weight", weight)))
    matrix, level = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    classes = [*families, UNKNOWN][: len(level)]
    weights = [(t, *(float(matrix[i, j]) for i in range(len(classes)))) for j, t in enumerate(vocabulary)]
    weights = _values(spark, weights, "term string, " + ", ".join(f"w{i} double" for i in range(len(classes))))
    levels = [(f, float(x)) for f, x in zip(classes, level, strict=True)]

    held = rows.where(~F.col("fit") & (F.col("family") == UNKNOWN))
    scored = predicted(held.select("id", "terms"), ["id"], weights, levels)
    count = F.when(F.col("corpus"), F.col("c")).otherwise(F.lit(round(each)))
    worst = stored(held.withColumn("c", count).join(scored, "id").select("c", "probability"), "calibration")
    over = worst.where("probability >= 0.5")
    (n,), (n_over,) = worst.agg(F.sum("c")).first(), over.agg(F.sum("c")).first()
    pass_, n_over = math.floor(PASS * (n or 0) + 1e-9), n_over or 0
    if n_over <= pass_:
        return weights, levels, 0.5
    rank = F.expr(f"percentile_approx(probability, {(n_over - pass_ - 0.5) / n_over}, 100000)")
    limit = over.select("probability", F.explode(F.sequence(F.lit(1).cast("long"), "c"))).agg(rank).first()[0]
    return weights, levels, float(limit)


def predicted(rows: DataFrame, key: list[str], weights: DataFrame, levels: list[tuple[str, float]]) -> DataFrame:
    """(key, family, probability): the likeliest licence family of each row's ``terms``, of those in ``may`` if it has that."""
    may = F.col("may") if "may" in rows.columns else F.array(*[F.lit(f) for f in TEMPLATES])
    sums = (
        rows.select(*key, may.alias("may"), F.explode("terms").alias("term"))
        .join(F.broadcast(weights), "term")  # bounded by the templates
        .groupBy(*key, "may")  # one row of sums for each row, no array to sort by
        .agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(levels))])
    )
    value = [F.struct((F.col(f"w{i}") + level).alias("value"), F.lit(f).alias("family")) for i, (f, level) in enumerate(levels)]
    value = sums.select(*key, "may", F.array(*value).alias("values"))
    best = F.array_max(F.filter("values", lambda v: F.array_contains("may", v["family"])))
    all_ = F.aggregate("values", F.lit(0.0), lambda a, v: a + F.exp(v["value"]))
    return value.select(*key, best.alias("best"), all_.alias("all")).select(
        *key, F.col("best.family").alias("family"), (F.exp(F.col("best.value")) / F.col("all")).alias("probability")
    )


def _shares(parts: DataFrame, key: list[str], templates: DataFrame) -> DataFrame:
    """(key, family, template, similarity) of the templates that confirm a paragraph (key, marked, n, terms).

    With a ``family`` in ``parts``, only the templates of it.
    """
    given = ["family"] if "family" in parts.columns else []
    return (
        parts.select(*key, *given, "marked", "n", F.explode("terms").alias("term"))
        .join(F.broadcast(templates), ["term", *given])  # a fixed table
        .groupBy(*key, "marked", "n", "family", "template", "size")
        .agg(F.count("*").alias("same"))
        .where(F.col("marked") | (F.col("same") >= SHARED))
        .withColumn("similarity", F.col("same") / F.least("n", "size"))
        .where(F.col("similarity") >= CONFIRM)
        .select(*key, "family", "template", "similarity")
    )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, family, probability, similarity, paragraph, n_notices, families) of each row of ``docs``.

    A paragraph is a line. It is unknown if the probability of the likeliest family is below the calibrated
    threshold; families are those that it has marks of, without marks all that its words do not rule out. Else
    the family has to be confirmed: the best of its templates shares CONFIRM of the smaller one's words and word
    pairs, and SHARED of them at least with a paragraph without marks. A document gets its likeliest confirmed paragraph,
    the number of confirmed paragraphs and their families in order.

    Null and empty texts, and documents without a notice: family null, 0 notices, no families. Rows of one
    doc_id get the notices of all of them. Ties go to the earlier paragraph. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    templates = _templates(spark)
    lines = stored(_looked_at(docs, templates), "lines")
    weights, levels, least = train(spark, lines, templates)
    key = ["doc_id", "x", "paragraph"]
    enough = (F.size("terms") >= SHARED) | F.col("marked")  # no template confirms any other paragraph
    parts = stored(_scored(lines).where(enough).distinct(), "paragraphs")
    id_ = F.xxhash64("doc_id", "x", "paragraph")
    parts = parts.withColumn("p", id_)
    guess = predicted(parts, ["p"], weights, levels).where(F.col("probability") >= least)
    guessed = parts.select(*key, "p", "n", "terms", "marked").join(guess, "p")
    found = _shares(guessed, [*key, "probability"], templates).groupBy(*key, "probability", "family").agg(F.max("similarity").alias("similarity"))
    order = F.struct(F.col("probability"), (-F.col("paragraph")).alias("early"), "family", "similarity")
    by_doc = found.groupBy("doc_id").agg(
        F.max(order).alias("top"), F.count("*").alias("n_notices"), F.sort_array(F.collect_set("family")).alias("families")
    )
    by_doc = by_doc.withColumnRenamed("doc_id", "d")
    return docs.select("doc_id").join(by_doc, F.col("doc_id").eqNullSafe(F.col("d")), "left").select(
        "doc_id",
        F.col("top.family").alias("family"),
        F.col("top.probability").alias("probability"),
        F.col("top.similarity").alias("similarity"),
        (-F.col("top.early")).alias("paragraph"),
        F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
