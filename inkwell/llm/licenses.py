"""Licence scans: a trained paragraph classifier, in DataFrame operations only.

A paragraph is a line of a text. Its features are the word n-grams (one to three
words, each holding a content word) that it contains; a sparse logistic
regression over them names a licence family or none. The regression is trained on
the driver, on paragraphs written from the templates below, and its temperature
and the probability under which a paragraph is called unknown are calibrated on
paragraphs held back. A named family must be confirmed: the paragraph has to
share most of its word triples with one of the family's templates.

The main path is one scan: lines without a content word of the vocabulary have no
feature and are unknown by arithmetic, so they go first; the other lines' n-grams
meet the weights in a broadcast join whose size the code bounds.
"""

from __future__ import annotations

import random
from functools import cache
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import ascii_lower, table

UNKNOWN = "unknown"
#: Families and the sentences that licence notices of each are made of.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, without warranties or conditions of any kind, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GPL version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "agpl": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "http://creativecommons.org/licenses/by/4.0/",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "http://creativecommons.org/licenses/by-sa/4.0/",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "http://creativecommons.org/licenses/by-nc/4.0/",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Licensed under CC0 1.0 Universal.",
        "This work is dedicated to the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright 2024 Example Inc. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "This software is proprietary and confidential; unauthorized copying of this file is strictly prohibited.",
    ),
}
#: Words that alone say nothing, and sentences near to licences that are none.
STOP = frozenset("the of and to in a an is are be was for this that these those with without by on or as under at from it its not no you your may any all can if we our i he she they but so than then there here has have had will would shall should which who whom what when where how up out into over such only other some more most one two do does did his her their them us http https www com org".split())
OTHERS = (
    "The driver was licensed to operate heavy trucks.", "She renewed her driving license last week.", "The new version of the software was released yesterday.", "Public opinion is divided on the work of the foundation.",
    "The library is open to the public on weekdays.", "He obtained a copy of the book free of charge.", "The author reserved a table for the evening.", "General conditions of use are described in the documentation.",
    "The source of the river lies in the mountains.", "Permission to enter the building was granted by the owner.", "The program was modified by the committee.", "They published a notice in the paper.", "Creative work is common in this school.",
    "The commercial was distributed by the network.", "International law applies to the agreement.", "Rights and duties of the members are listed below.", "The students reproduced the experiment without modification.", "The file contains the terms of the contract.",
)
WIDEST, CONFIRM, CONFIDENT = 3, 0.6, 0.9


def tokens(text: str) -> list[str]:
    out, word = [], ""
    for c in text:
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if "a" <= c <= "z" or "0" <= c <= "9":
            word += c
        elif word:
            out.append(word)
            word = ""
    return [*out, word] if word else out


def content(word: str) -> bool:
    return word not in STOP and not word.isdigit()


def grams(words: list[str], n: int) -> set[str]:
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


def features(words: list[str]) -> set[str]:
    return {g for n in range(1, WIDEST + 1) for g in grams(words, n) if any(map(content, g.split()))}


def triples(text: str) -> set[str]:
    """The word triples of a template or paragraph; a shorter one is a single gram."""
    words = tokens(text)
    return grams(words, min(3, len(words))) if words else set()


class Model:
    """weights: gram to one number for each family and, last, unknown. A paragraph's probabilities are the softmax of (bias + sums) / temperature."""

    def __init__(self, families: list[str], weights: dict[str, list[float]], bias: list[float], temperature: float, threshold: float):
        self.families, self.weights, self.bias, self.temperature, self.threshold = families, weights, bias, temperature, threshold


def _written(rng: random.Random) -> tuple[list[str], str]:
    """The words of one generated paragraph, and its family."""
    noise = lambda n: ["".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(2, 9))) for _ in range(n)]
    if rng.random() < 0.45:
        words = tokens(rng.choice(OTHERS))
        if rng.random() < 0.6:  # content words of templates, torn from their context
            pool = [w for ts in TEMPLATES.values() for t in ts for w in tokens(t) if content(w)]
            words += [rng.choice(pool) for _ in range(rng.randint(1, 4))]
            rng.shuffle(words)
        return noise(rng.randint(0, 6)) + words + noise(rng.randint(0, 6)), UNKNOWN
    family = rng.choice(list(TEMPLATES))
    words = tokens(rng.choice(TEMPLATES[family]))
    if len(words) > 6 and rng.random() < 0.4:
        words = [w for w in words if rng.random() > 0.06]
    return noise(rng.choice([0, 0, 0, 2, 5])) + words + noise(rng.choice([0, 0, 0, 2, 5])), family


@cache
def train(examples: int = 3000, rounds: int = 120, least: float = 0.02, precision: float = 0.995, seed: int = 5) -> Model:
    """Proximal gradient with an L1 term, then temperature and threshold on the last third of the paragraphs."""
    rng = random.Random(seed)
    rows = [_written(rng) for _ in range(examples)]
    classes = [*TEMPLATES, UNKNOWN]
    known = sorted({f for ts in TEMPLATES.values() for t in ts for f in features(tokens(t))} | {f for t in OTHERS for f in features(tokens(t))})
    index = dict(zip(known, count()))
    x, y = np.zeros((examples, len(known)), np.float32), np.array([classes.index(c) for _, c in rows])
    for i, (words, _) in enumerate(rows):
        for f in features(words):
            if f in index:
                x[i, index[f]] = 1
    cutoff = examples * 2 // 3
    w, b = np.zeros((len(known), len(classes)), np.float32), np.zeros(len(classes), np.float32)
    target = np.eye(len(classes), dtype=np.float32)[y[:cutoff]]
    step = 0.5
    for _ in range(rounds):
        z = x[:cutoff] @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p = p / p.sum(1, keepdims=True) - target
        w -= step * (x[:cutoff].T @ p) / cutoff * 4
        w = np.sign(w) * np.maximum(np.abs(w) - step * 4e-4, 0)
        b -= step * p.mean(0)
    w[np.abs(w).max(1) < least] = 0
    z, truth = x[cutoff:] @ w + b, y[cutoff:]

    def probabilities(t: float) -> np.ndarray:
        e = np.exp((z - z.max(1, keepdims=True)) / t)
        return e / e.sum(1, keepdims=True)

    temperature = min((0.2, 0.3, 0.5, 0.7, 1.0, 1.4, 2.0), key=lambda t: -np.log(probabilities(t)[np.arange(len(truth)), truth] + 1e-9).mean())
    p = probabilities(temperature)
    named = p.argmax(1) != len(classes) - 1
    best = p.max(1)
    threshold = next((t for t in (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, CONFIDENT) if (p.argmax(1) == truth)[named & (best >= t)].mean() >= precision), CONFIDENT)
    kept = np.flatnonzero(np.abs(w).max(1))
    return Model(classes, {known[k]: [round(float(v), 5) for v in w[k]] for k in kept}, [round(float(v), 5) for v in b], temperature, threshold)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """One row for each row of docs: (id, found, unconfirmed).

    found: an array of (paragraph, family, probability) with the confirmed ones,
    paragraphs counted from 0 by newlines; unconfirmed: the number of paragraphs
    that the regression names but no template confirms. Null and empty texts have
    none. Rows are told apart by id and text together, so null and repeated ids
    keep their rows. Other columns are not read.
    """
    spark, model = docs.sparkSession, model or train()
    k = len(model.families)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("mark"))
    vocabulary = sorted({w for g in model.weights for w in g.split() if content(w)})
    lines = own.where("text IS NOT NULL").select("id", "mark", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    words = F.filter(F.split(ascii_lower(F.col("line")), "[^a-z0-9]+"), lambda w: w != "")
    # The generator of one element keeps the optimiser from writing the split into every use of w.
    lines = lines.select("id", "mark", "paragraph", F.explode(F.array(words)).alias("w")).where(F.arrays_overlap("w", F.array(*map(F.lit, vocabulary))))
    run = lambda n: F.array_distinct(F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))), lambda i: F.array_join(F.slice("w", i, n), " "))).otherwise(F.expr("cast(array() as array<string>)")))
    met = lines.select("id", "mark", "paragraph", F.explode(F.array(run(3))).alias("triples"), "w").select("id", "mark", "paragraph", F.size("triples").alias("n3"), F.explode(F.concat(F.array(F.lit("")), run(1), run(2), "triples")).alias("gram"))
    # For each gram its weights, and the templates that it is a triple of. The empty gram counts a paragraph's repetitions in repeated rows. All bounded by the templates above.
    known = [(f, triples(t)) for f, ts in TEMPLATES.items() for t in ts]
    grams_ = sorted({*model.weights, *(g for _, t in known for g in t), ""})
    listed = [(g, *model.weights.get(g, [0.0] * k), *(int(g in t) for _, t in known)) for g in grams_]
    table_ = spark.createDataFrame(listed, "gram string, " + ", ".join([f"w{i} double" for i in range(k)] + [f"t{j} int" for j in range(len(known))]))
    sums = met.join(F.broadcast(table_), "gram").groupBy("id", "mark", "paragraph").agg(F.count_if(F.col("gram") == "").alias("times"), F.max("n3").alias("n3"), *(F.sum(f"w{i}").alias(f"w{i}") for i in range(k)), *(F.sum(f"t{j}").alias(f"t{j}") for j in range(len(known))))
    logit = F.array(*((F.col(f"w{i}") / F.col("times") + model.bias[i]) / model.temperature for i in range(k)))

    def share(family: str):
        """The largest share of triples in common with a template of the family."""
        own = [(F.col(f"t{j}") / F.col("times"), len(t)) for j, (f, t) in enumerate(known) if f == family]
        return F.greatest(F.lit(0.0), *(F.greatest(c / n, F.when(F.col("n3") >= 2, c / F.col("n3")).otherwise(0.0)) for c, n in own))

    shares = F.array(*(share(f) for f in model.families[:-1]), F.lit(0.0))
    scored = sums.select("id", "mark", "paragraph", logit.alias("z"), shares.alias("shares")).withColumn("top", F.array_max("z"))
    at = F.array_position("z", F.col("top")).cast("int")
    scored = scored.withColumn("probability", 1 / F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("top")))).withColumn("family", F.element_at(F.array(*map(F.lit, model.families)), at)).withColumn("confirmed", F.element_at("shares", at) >= CONFIRM)
    judged = scored.where((F.col("family") != UNKNOWN) & (F.col("probability") >= model.threshold))
    each = F.when(F.col("confirmed"), F.struct("paragraph", "family", "probability"))
    per = judged.groupBy("id", "mark").agg(F.array_sort(F.collect_list(each)).alias("found"), F.count_if(~F.col("confirmed")).alias("unconfirmed"))
    per = per.select(F.col("id").alias("i"), F.col("mark").alias("m"), "found", "unconfirmed")
    out = own.select("id", "mark").join(per, F.col("id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")), "left")
    none = F.expr("cast(array() as array<struct<paragraph:int,family:string,probability:double>>)")
    return out.select("id", F.coalesce("found", none).alias("found"), F.coalesce("unconfirmed", F.lit(0)).alias("unconfirmed"))


def op1(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["family"]))), ",").alias("licenses"),
        F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"])), ",").alias("paragraphs"),
        F.size("found").cast("long").alias("n_paragraphs"), F.col("unconfirmed").alias("n_unconfirmed"),
    )


def op1_sql() -> str:
    """The same with the model's numbers written into DuckDB SQL."""
    model = train()
    k = len(model.families)
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    listed = ", ".join(f"({quoted(g)}, {', '.join(f'{v}::DOUBLE' for v in ws)})" for g, ws in sorted(model.weights.items()))
    templates = ", ".join(f"({quoted(f)}, [{', '.join(map(quoted, sorted(triples(t))))}])" for f, ts in TEMPLATES.items() for t in ts)
    z = ", ".join(f"(coalesce(sum(w{i}), 0) + {model.bias[i]}::DOUBLE) / {model.temperature}::DOUBLE" for i in range(k))
    families = ", ".join(map(quoted, model.families))
    joined = lambda n: f"list_distinct(list_transform(generate_series(1, len(w) - {n - 1}), lambda i: array_to_string(w[i:i + {n - 1}], ' ')))"
    return rf"""
WITH weights(gram, {", ".join(f"w{i}" for i in range(k))}) AS (VALUES {listed}),
templates(family, template) AS (VALUES {templates}),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS paragraph FROM documents WHERE text IS NOT NULL),
word AS (SELECT doc_id, paragraph, list_filter(regexp_split_to_array(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM lines),
gram AS (SELECT doc_id, paragraph, unnest(list_concat({joined(1)}, {joined(2)}, {joined(3)})) AS gram FROM word WHERE len(w) > 0),
z AS (SELECT doc_id, paragraph, [{z}] AS z FROM gram JOIN weights USING (gram) GROUP BY doc_id, paragraph),
p AS (SELECT doc_id, paragraph, ([{families}])[list_position(z, list_max(z))] AS family, 1 / list_sum(list_transform(z, lambda v: exp(v - list_max(z)))) AS probability FROM z),
named AS (SELECT p.doc_id, p.paragraph, p.family, CASE WHEN len(w) >= 3 THEN {joined(3)} ELSE [array_to_string(w, ' ')] END AS triples
          FROM p JOIN word ON p.doc_id = word.doc_id AND p.paragraph = word.paragraph WHERE family <> 'unknown' AND probability >= {model.threshold}),
judged AS (SELECT doc_id, paragraph, family, max(greatest(len(list_intersect(template, triples)) / len(template), CASE WHEN len(triples) >= 2 THEN len(list_intersect(template, triples)) / len(triples) ELSE 0 END)) >= {CONFIRM} AS confirmed
           FROM named JOIN templates USING (family) GROUP BY doc_id, paragraph, family),
per AS (SELECT doc_id, string_agg(DISTINCT family, ',' ORDER BY family) FILTER (WHERE confirmed) AS licenses, string_agg(paragraph || ':' || family, ',' ORDER BY paragraph) FILTER (WHERE confirmed) AS paragraphs,
        count(*) FILTER (WHERE confirmed) AS n, count(*) FILTER (WHERE NOT confirmed) AS u FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, coalesce(paragraphs, '') AS paragraphs, CAST(coalesce(n, 0) AS BIGINT) AS n_paragraphs, CAST(coalesce(u, 0) AS BIGINT) AS n_unconfirmed
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id
"""
