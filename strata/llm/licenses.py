"""Licence notices, found by a trained classifier of paragraphs and confirmed by templates.

A paragraph is a run of lines that hold more than white space and comment marks. Its lines are
put together and cut into sentences, where a full stop, colon, question or exclamation mark
comes before a capital letter, so that a notice may be wrapped at any width. Candidates are
the sentences and, of a sentence on several lines, also each line, as headings have no full
stop. Their features are words and word pairs, hashed; a multinomial logistic regression with
an L1 penalty tells the families of ``TEMPLATES`` and the class ``unknown`` apart. It is
trained here: the families' examples are the templates, whole, in part and amid ordinary
candidates; ``unknown`` has every different candidate of the corpus that is judged (it holds a
telling word, see ``telling_words``; no other candidate can become a notice) and shares too
little with any template. No text and no candidate is left out by chance. The same candidates
calibrate the unknown class: a family's probability has to exceed what all but ``ERROR`` of
them reach. A prediction counts when a template of the predicted family agrees: at least
``AGREE`` of a template sentence's word triples are in the candidate. A sentence counts once a family: by its lines that are notices
alone, or else as a whole, at its first line that holds three words of a template.

Everything is DataFrame functions and Spark's DataFrame-based ML; only the model and its
gradients, both of bounded size, pass the driver. Texts are cut into candidates once: those
with a telling word are stored, and training and judging read them.

Rows: null and blank texts have no paragraphs. Repeated rows stay. Null ids are allowed. Extra
columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.support import settle

# Wording of common licence notices, by family.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD License.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Dedicated to the public domain under CC0 1.0.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
TEMPLATES["EPL-2.0"] = [
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
]
TEMPLATES["ISC"] = [
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "Provided that the above copyright notice and this permission notice appear in all copies.",
]
TEMPLATES["Unlicense"] = [
    "This is free and unencumbered software released into the public domain.",
]
# Short names of the families and their tags; the forms in which both are used.
NAMES = {
    "Apache-2.0": ["Apache 2.0", "Apache License 2.0"], "BSD": ["BSD", "BSD 3-Clause", "BSD 2-Clause"], "EPL-2.0": ["Eclipse Public", "EPL 2.0"],
    "GPL": ["GNU GPL v3", "GNU GPL v2", "GPLv3", "GPLv2", "GPL"], "ISC": ["ISC"], "LGPL": ["GNU LGPL v3", "GNU LGPL v2.1", "LGPL"],
    "MIT": ["MIT"], "MPL-2.0": ["MPL 2.0", "Mozilla Public"], "Unlicense": ["Unlicense"],
}
FORMS = ["Licensed under the {} license.", "Licensed under {}.", "is {} licensed", "terms of the {}"]
TAGS = {
    "Apache-2.0": ["Apache-2.0"], "BSD": ["BSD-2-Clause", "BSD-3-Clause"], "CC-BY": ["CC-BY-4.0"], "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0"], "CC0": ["CC0-1.0"], "EPL-2.0": ["EPL-2.0"],
    "GPL": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-2.0", "GPL-3.0"], "ISC": ["ISC"],
    "LGPL": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"], "MIT": ["MIT"], "MPL-2.0": ["MPL-2.0"], "Unlicense": ["Unlicense"],
}
for _family, _names in NAMES.items():
    TEMPLATES[_family] += [form.format(name) for name in _names for form in FORMS]
for _family, _tags in TAGS.items():
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {tag}" for tag in _tags]
UNKNOWN = "unknown"
DIMENSIONS = 1 << 13
ERROR = 0.001
# The rank of the calibrating probability is exact to this share of the candidates: a hundredth of ``ERROR``.
_RANKS = 100_000
# Training rows that share one partial gradient (a megabyte) in each pass.
_GRADIENT_ROWS = 1 << 14
# Words of an ordinary candidate that an example stands amid.
_NOISE = 12
AGREE = 0.6
# Control characters that stand for: line number from, to; end of a sentence in a line; blank line.
_FROM, _TO, _STOP, _BLANK = "\x01", "\x02", "\x03", "\x04"
_FULL = r"(?<=[.!?:][\"')\]]{0,2})(?<!Identifier:)"
_IN_LINE = _FULL + r"\s+(?=[\"'(\[]{0,2}\p{Lu})"
_ENDS = rf"[{_STOP}{_BLANK}]+|{_FULL}[\s*/>-]*(?={_FROM}[0-9]+{_TO}[^\p{{L}}\p{{N}}{_FROM}-{_BLANK}]*\p{{Lu}})"
_NUMBER = rf"{_FROM}?[0-9]+{_TO}(?:\s*(?i:rem|dnl)\s)?"
_APART = r"[^\p{L}\p{N}+]*(?:\s+|$)[^\p{L}\p{N}+]*"


def words(paragraph: Column) -> Column:
    """Lower-case words without the punctuation around them."""
    bare = F.regexp_replace(F.lower(paragraph), r"^[^\p{L}\p{N}+]+", "")
    return F.filter(F.split(bare, _APART), lambda w: w != "")


def _grams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` words; none if there are fewer."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    runs = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, runs).otherwise(F.array().cast("array<string>"))


def _featured(df: DataFrame) -> DataFrame:
    """Add ``features`` from ``tokens``: words and pairs, present or not."""
    pairs = F.zip_with(F.col("tokens"), F.slice("tokens", 2, 1 << 30), lambda a, b: F.concat_ws(" ", a, b))
    terms = df.withColumn("terms", F.concat("tokens", pairs))
    return HashingTF(inputCol="terms", outputCol="features", numFeatures=DIMENSIONS, binary=True).transform(terms).drop("terms")


def _own_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^\w+]*(?:\s+|$)[^\w+]*", re.sub(r"^[^\w+]+", "", text.lower())) if w]


def _triples(text: str) -> list[str]:
    tokens = _own_words(text)
    return sorted({" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))})


def _agreement(tokens: Column, family: Column | None = None) -> Column:
    """The largest share of a template's triples that the paragraph has; of one family or of all."""
    own = F.array_distinct(F.concat(_grams(tokens, 3), F.array(F.array_join(tokens, " "))))
    shares = []
    for name, templates in TEMPLATES.items():
        best = F.greatest(F.lit(0.0), *[
            F.size(F.array_intersect(own, F.array(*map(F.lit, _triples(t))))) / F.lit(float(len(_triples(t)))) for t in templates
        ])
        shares.append(best if family is None else F.when(family == name, best))
    if family is not None:
        return F.coalesce(*shares, F.lit(0.0))
    every = F.array(*map(F.lit, sorted({x for t in sum(TEMPLATES.values(), []) for x in _triples(t)})))
    return F.when(F.arrays_overlap(own, every), F.greatest(*shares)).otherwise(0.0)


def _marked(text: Column) -> Column:
    """The text with a line number where a line or a sentence begins; blank lines are one character."""
    def mark(line: Column, i: Column) -> Column:
        number = F.concat(F.lit(_FROM), i.cast("string"), F.lit(_TO))
        shown = F.concat(number, F.regexp_replace(line, F.lit(_IN_LINE), F.concat(F.lit(_STOP), number)))
        return F.when(F.regexp_like(line, F.lit(r"[^\s/*#;%<>!-]")), shown).otherwise(F.lit(_BLANK))

    plain = F.translate(text, _FROM + _TO + _STOP + _BLANK, "    ")
    return F.array_join(F.transform(F.split(plain, "\n"), mark), "")


def _lines(part: Column) -> Column:
    return F.filter(F.split(part, _FROM), lambda s: s != "")


def _number(line: Column) -> Column:
    return F.regexp_extract(line, f"^{_FROM}?([0-9]+){_TO}", 1).cast("int")


def _plain(part: Column) -> Column:
    return F.regexp_replace(part, _NUMBER, " ")


def _candidates(marked: Column) -> Column:
    """Structs of sentence, ``alone`` (one line of several) and part."""
    def parts(sentence: Column, k: Column) -> Column:
        lines = F.transform(_lines(sentence), lambda s: F.struct(k.alias("sentence"), F.lit(True).alias("alone"), s.alias("part")))
        whole = F.array(F.struct(k.alias("sentence"), F.lit(False).alias("alone"), sentence.alias("part")))
        return F.when(F.instr(F.substring(sentence, 2, 1 << 30), _FROM) > 0, F.concat(whole, lines)).otherwise(whole)

    return F.flatten(F.transform(F.filter(F.split(marked, _ENDS), lambda s: s != ""), parts))


def telling_words() -> list[str]:
    """Words of the templates without which no candidate has ``AGREE`` of a template's triples."""
    out: set[str] = set()
    for t in sum(TEMPLATES.values(), []):
        triples, longest = _triples(t), sorted(set(_own_words(t)), key=lambda w: (-len(w), w))
        while sum(out.isdisjoint(x.split()) for x in triples) >= AGREE * len(triples):
            out.add(longest.pop(0))
    return sorted(out)


def _telling(part: Column) -> Column:
    """Whether a telling word stands in the part; others are not judged, as no template could agree."""
    either = "|".join(re.escape(w) for w in telling_words())
    return F.regexp_like(F.lower(part), F.lit(rf"(?<![\p{{L}}\p{{N}}])(?:{either})"))


def candidates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row, n_paragraphs, sentence, alone, part, tokens``: one row a candidate with a telling word, one with null tokens for a text without any."""
    marked = _marked(F.col(f"`{text}`"))
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.monotonically_increasing_id().alias("row"), marked.alias("marked"))
    blocks = F.size(F.filter(F.split("marked", f"{_BLANK}+"), lambda b: b != ""))
    blocks = F.when(F.col("marked").isNull(), 0).otherwise(blocks).cast("long")
    rows = rows.select("doc_id", "row", blocks.alias("n_paragraphs"), F.explode_outer(F.filter(_candidates(F.col("marked")), lambda c: _telling(c["part"]))).alias("x"))
    return rows.select("doc_id", "row", "n_paragraphs", "x.*", words(_plain(F.col("x.part"))).alias("tokens"))


def _first_line(part: Column, family: Column) -> Column:
    """The number of the first line that holds a triple of the family's templates, or else of the first line."""
    own = F.coalesce(*[
        F.when(family == name, F.array(*map(F.lit, sorted({x for t in templates for x in _triples(t)})))) for name, templates in TEMPLATES.items()
    ])
    held = F.filter(_lines(part), lambda s: F.arrays_overlap(_grams(words(_plain(s)), 3), own))
    return _number(F.coalesce(F.try_element_at(held, F.lit(1)), part))


def _examples(spark: SparkSession) -> DataFrame:
    """``k, label, tokens``: the templates, whole and in part, numbered."""
    rows = []
    for name, templates in TEMPLATES.items():
        for t in [*templates, " ".join(templates)]:
            tokens = _own_words(t)
            half = len(tokens) // 2
            rows += [(name, part) for part in (tokens, tokens[: max(half, 5)], tokens[-max(half, 5) :], tokens[1:])]
    array = F.array(*[F.struct(F.lit(n).alias("label"), F.array(*map(F.lit, t)).alias("tokens")) for n, t in rows if t])
    return spark.range(1).select(F.posexplode(array).alias("k", "x")).select("k", "x.label", "x.tokens")


def _ordinary(found: DataFrame) -> DataFrame:
    """``h, tokens``: the different candidates of ``candidates`` that share too little with any template."""
    parts = found.filter(F.col("part").isNotNull()).select(_plain(F.col("part")).alias("p"))
    # Equal candidates have one hash, so they are one candidate each.
    different = parts.groupBy(F.xxhash64("p").alias("h")).agg(F.min("p").alias("p")).select("h", words(F.col("p")).alias("tokens"))
    # Stored first: pushed below the words, the comparison would find them anew for every template.
    return settle(different).filter(_agreement(F.col("tokens")) < AGREE / 2)


def _packed(rows: DataFrame) -> DataFrame:
    """The stored ``rows`` in partitions of about ``_GRADIENT_ROWS``.

    Every pass of the training shuffles a partial gradient a partition: their number has to
    follow the rows, not the shuffle partitions that the rows come from.
    """
    return rows.coalesce(max(1, math.ceil(rows.count() / _GRADIENT_ROWS)))


def train(found: DataFrame) -> tuple[LogisticRegressionModel, list[str], float]:
    """The model, its classes in order, and the probability that a family has to exceed, from the rows of ``candidates``."""
    ordinary = settle(_ordinary(found))
    usual = ordinary.select(F.lit(UNKNOWN).alias("label"), "tokens", F.lit(False).alias("amid"))
    numbered = settle(_examples(found.sparkSession))  # some hundred literals, which no later plan should carry
    examples = numbered.select("label", "tokens", F.lit(False).alias("amid"))
    # Every ordinary candidate's words stand behind an example, which one its hash decides.
    noise = ordinary.select(F.pmod("h", F.lit(numbered.count())).cast("int").alias("k"), F.slice("tokens", 1, _NOISE).alias("noise"))
    mixed = noise.join(F.broadcast(numbered), "k").select("label", F.concat("tokens", "noise").alias("tokens"), F.lit(True).alias("amid"))
    classes = [UNKNOWN, *TEMPLATES]
    number = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))])
    # Classes weigh alike, whatever their number of examples, and in a class plain examples and those amid words.
    rows = examples.unionByName(mixed).unionByName(usual)
    sizes = rows.groupBy("label", "amid").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("kinds", F.count(F.lit(1)).over(Window.partitionBy("label")))
    rows = _featured(rows.join(F.broadcast(sizes), ["label", "amid"])).select(  # two rows a class
        number[F.col("label")].alias("label"), "features", (F.lit(1000.0) / (F.col("n") * F.col("kinds"))).alias("weight")
    )
    model = LogisticRegression(
        weightCol="weight", regParam=1e-4, elasticNetParam=1.0, maxIter=25, family="multinomial"
    ).fit(_packed(settle(rows)))
    top = F.array_max(F.slice(vector_to_array("probability"), 2, len(classes) - 1))
    reached = model.transform(_featured(ordinary)).select(F.percentile_approx(top, 1 - ERROR, _RANKS).alias("p")).head()
    return model, classes[: model.numClasses], max(0.5, (reached.p if reached and reached.p is not None else 0.5))


def find_licenses(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_paragraphs, notices``: confirmed notices as structs of line, family and score."""
    cut = candidates(df, doc_id, text)
    # Stored once; the words are cheaper to find again than to store.
    stored = settle(cut.drop("tokens")).withColumn("tokens", words(_plain(F.col("part"))))
    model, classes, least = train(stored)
    scored = model.transform(_featured(stored.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))))
    p = vector_to_array("probability")
    scored = scored.select(
        "doc_id", "row", "n_paragraphs", "sentence", "alone", "part", "tokens",
        F.element_at(F.array(*map(F.lit, classes)), (F.col("prediction") + 1).cast("int")).alias("family"), F.array_max(p).alias("score"),
    )
    is_license = (F.col("family") != UNKNOWN) & (F.col("score") > least) & (F.size("tokens") > 0)
    line = _first_line(F.col("part"), F.col("family")).alias("line")
    confirmed = F.when(is_license, F.when(_agreement(F.col("tokens"), F.col("family")) >= AGREE, F.struct("sentence", "family", (~F.col("alone")).alias("whole"), line, "score")))
    scored = scored.select("doc_id", "row", "n_paragraphs", confirmed.alias("notice"))
    # A text's candidates are next to each other: the partial aggregate leaves one row a text.
    found = scored.groupBy("doc_id", "row").agg(F.max("n_paragraphs").alias("n_paragraphs"), F.sort_array(F.collect_list("notice")).alias("found"))
    # Sorted, a sentence stands right behind its own lines of the same family.
    nothing = F.lit(None).cast(found.schema["found"].dataType.elementType)
    before = F.slice(F.concat(F.array(nothing), F.col("found")), F.lit(1), F.size("found"))
    same = lambda n, o: F.coalesce((o["sentence"] == n["sentence"]) & (o["family"] == n["family"]), F.lit(False))
    marked = F.zip_with("found", before, lambda n, o: F.struct(n["line"].alias("line"), n["family"].alias("family"), n["score"].alias("score"), (n["whole"] & same(n, o)).alias("again")))
    kept = F.filter(marked, lambda n: ~n["again"])
    notices = F.array_sort(F.transform(kept, lambda n: F.struct(n["line"].alias("line"), n["family"].alias("family"), n["score"].alias("score"))))
    return found.select("doc_id", "n_paragraphs", notices.alias("notices"))
