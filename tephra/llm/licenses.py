"""Which licence families a document's paragraphs name. DataFrame operations only."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import let, packed, table, unpacked

#: What the notices of each family say.
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "mit": ["Released under the MIT License.", "This project is licensed under the terms of the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
            "You should have received a copy of the GNU General Public License along with this program."],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or any later version.",
             "You should have received a copy of the GNU Lesser General Public License along with this library."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "Licensed under the Creative Commons CC BY-NC licence; non-commercial use only, with attribution."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
            "Released under the 3-Clause BSD License.", "Use of this source code is governed by a BSD-style license."],
    "proprietary": ["All rights reserved.", "Copyright (c) 2020 the authors. All rights reserved.", "No part of this publication may be reproduced or transmitted without the prior written permission of the publisher."],
}
#: Headings and short forms: a unit must be little more than one of these.
TITLES = {
    "apache": ["Apache License", "Apache License, Version 2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", "Apache-2.0", "SPDX-License-Identifier: Apache-2.0"],
    "mit": ["MIT License", "The MIT License (MIT)", "SPDX-License-Identifier: MIT"],
    "gpl": ["GNU General Public License", "GNU General Public License, Version 3", "GPL-3.0-or-later", "GPL-2.0-only", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only"],
    "lgpl": ["GNU Lesser General Public License", "LGPL-2.1-or-later", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "mpl": ["Mozilla Public License Version 2.0", "MPL-2.0", "SPDX-License-Identifier: MPL-2.0"],
    "cc-by": ["Creative Commons Attribution 4.0 International", "CC BY 4.0", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-sa": ["Creative Commons Attribution-ShareAlike 4.0 International", "CC BY-SA 4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc-by-nc": ["Creative Commons Attribution-NonCommercial", "Creative Commons Attribution-NonCommercial 4.0 International", "CC BY-NC 4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "bsd": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "SPDX-License-Identifier: BSD-3-Clause"],
}
UNKNOWN = "unknown"
#: Notices of other licences, and sentences with the words of notices: what the class unknown is learnt from.
OTHERS = ["Licensed under the Academic Free License, Version 3.0.", "Academic Free License, Version 3.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0.", "Eclipse Public License, Version 2.0", "SPDX-License-Identifier: EPL-2.0",
          "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice appear in all copies.", "ISC License", "SPDX-License-Identifier: ISC",
          "Distributed under the Boost Software License, Version 1.0.", "Boost Software License, Version 1.0", "This software is provided 'as-is', without any express or implied warranty.", "The zlib License", "SPDX-License-Identifier: Zlib",
          "This is free and unencumbered software released into the public domain.", "Released under the Unlicense.", "Licensed under the European Union Public Licence, version 1.2.", "The Artistic License 2.0", "Licensed under the Artistic License, version 2.0.",
          "To the extent possible under law, the author has waived all copyright and related rights to this work.", "CC0 1.0 Universal", "Do what you want to public license", "Licensed under the Open Software License version 3.0.", "SIL Open Font License, Version 1.1",
          "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "Licensed under CC BY-ND 4.0.", "Python Software Foundation License, Version 2", "Microsoft Public License (Ms-PL)",
          "We discussed all rights reserved for members under the new law.", "The rights of all members are reserved by the council.", "He lost his driving license under the new general rules.", "The apache helicopter was released to the public.",
          "She studied at MIT and published software there.", "The public may obtain a copy of the report at the office.", "All rights to the land were reserved for the tribe.", "Permission to enter was granted free of charge.",
          "The general public license fee pays for radio and television.", "The creative commons of the village were used for grazing.", "The notice shall be included in the minutes of the meeting.", "Modification of the source of the river is not permitted.",
          "Version 2.0 of the program was published in 2004.", "The foundation distributes free copies of the book.", "The binary forms of the words are listed with their sources.", "Attribution of the painting is uncertain.", "Commercial use of the hall needs the permission of the owner.",
          "A copy of the license must be carried by every person who drives.", "The software is distributed on discs without conditions.", "Part of this publication was transmitted by telegraph.", "The copyright of the authors ends after seventy years."]
#: Words of the templates that any line may hold. All others make a unit a candidate, however common they are in a corpus.
COMMON = set("0 1 2 3 4 a above all an and any as at be by c either except following for foundation free from have if in is it later law may not of on only or part person project provided "
             "published should substantial terms that the this to under use v version with without work you".split())


#: What parts words: ASCII control characters and marks, and the marks of print.
PARTING = "".join(chr(c) for c in range(128) if not chr(c).isalnum()) + "\u00a0«»©®·–—‘’“”„•…™"


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.lower(line), PARTING, " " * len(PARTING)), " "), "")


def n_grams(words: Column) -> Column:
    """Distinct words and pairs of neighbouring words."""
    pairs = F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(words, pairs))


def without_third(words: str, k: int) -> Column:
    return F.filter(words, lambda w, i: F.floor(i * 3 / F.size(words)) != k)


def template_rows(spark: SparkSession) -> DataFrame:
    """(family, title, line, words, grams, keys): one row for each template; `keys` are its words that no other family's templates hold."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(short).alias("title"), F.lit(t).alias("line")) for short, group in ((False, TEMPLATES), (True, TITLES)) for f, texts in group.items() for t in texts]
    rows += [F.struct(F.lit(UNKNOWN).alias("family"), F.lit(False).alias("title"), F.lit(t).alias("line")) for t in OTHERS]
    each = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*").withColumn("words", words_of(F.col("line")))
    own = each.where(F.col("family") != UNKNOWN).select("family", F.explode("words").alias("word")).where(~F.col("word").isin(sorted(COMMON))).groupBy("word").agg(F.collect_set("family").alias("who")).where(F.size("who") == 1)
    own = own.groupBy(F.element_at("who", 1).alias("of")).agg(F.collect_set("word").alias("owned"))
    each = each.join(own, F.col("family") == F.col("of"), "left")
    return each.select("family", "title", "line", "words", n_grams(F.col("words")).alias("grams"), F.coalesce(F.array_intersect("words", "owned"), F.array().cast("array<string>")).alias("keys"))


class Model:
    """The fitted machine: sparse n-gram vectors, the regression over families and unknown, and the calibration. Its size is that of the templates."""

    def __init__(self, features: list[str], vectors: CountVectorizerModel, classes: LogisticRegressionModel, slope: float, offset: float):
        self.features, self.vectors, self.classes, self.slope, self.offset = features, vectors, classes, slope, offset

    def single_words(self) -> list[str]:
        return [g for g in self.features if " " not in g]


def train(spark: SparkSession, l1: float = 0.0005) -> Model:
    """Multinomial logistic regression over the families and unknown, learnt from the notices of this module alone, so that it is the same for every corpus.

    Templates count whole, without each third of their words, and, as unknown, without the words that only their family has; OTHERS are
    unknown. Features are the words of the families' templates that are not in COMMON and pairs that hold such a word, as
    sparse vectors. A second regression turns the margin over unknown into the probability of being a notice at all, fitted
    on the two halves that the other half's machine has not seen.
    """
    phrases = materialize(template_rows(spark))
    grams = phrases.where(F.col("family") != UNKNOWN).select(F.explode("grams").alias("gram")).distinct()
    found = sorted(r.gram for r in grams.collect())               # of the templates above, not of a corpus
    single = {g for g in found if " " not in g and g not in COMMON}
    features = sorted(g for g in found if g in single or " " in g and single & set(g.split(" ")))
    classes = [UNKNOWN, *TEMPLATES]
    vectors = CountVectorizerModel.from_vocabulary(features, inputCol="grams", outputCol="features", minTF=0.0)
    vectors.setBinary(True)
    whole = F.array(F.struct(F.col("family").alias("of"), F.col("words").alias("words")))
    cut = F.array(*[F.struct(F.col("family").alias("of"), without_third("words", k).alias("words")) for k in range(3)])
    bare = F.array(F.struct(F.lit(UNKNOWN).alias("of"), F.array_except("words", "keys").alias("words")))
    some = F.when(F.col("family") == UNKNOWN, whole).when(F.col("title"), F.concat(whole, F.when(F.size("keys") > 0, bare).otherwise(F.slice(bare, 1, 0)))).otherwise(F.concat(whole, cut, F.when(F.size("keys") > 0, bare).otherwise(F.slice(bare, 1, 0))))
    rows = phrases.select(F.explode(some).alias("r"), F.pmod(F.xxhash64("line"), F.lit(2)).alias("fold")).select("r.*", "fold")
    label = F.element_at(F.create_map(*[F.lit(x) for k, c in enumerate(classes) for x in (c, float(k))]), F.col("of"))
    rows = materialize(rows.select(label.alias("label"), "fold", n_grams(F.col("words")).alias("grams")).repartition(2))
    rows = vectors.transform(rows).select("label", "fold", "features")
    fit = lambda part: LogisticRegression(family="multinomial", regParam=l1, elasticNetParam=0.5, maxIter=60, standardization=False).fit(part)
    seen = [fit(rows.where(F.col("fold") != k)).transform(rows.where(F.col("fold") == k)).select((F.col("label") > 0).cast("double").alias("label"), F.array_max(margin_of(vector_to_array("rawPrediction"), n)).alias("m"))
            for n, k in ((len(classes) - 1, 0), (len(classes) - 1, 1))]
    margins = seen[0].unionByName(seen[1])
    second = LogisticRegression(regParam=1e-3, maxIter=30).fit(margins.select("label", array_to_vector(F.array("m")).alias("features")))
    return Model(features, vectors, fit(rows), float(second.coefficients[0]), float(second.intercept))


def margin_of(raw: Column, n: int) -> Column:
    """Each family's lead over unknown, which is first."""
    return F.transform(F.slice(raw, 2, n), lambda x: x - F.element_at(raw, 1))


def units_of(text: Column) -> Column:
    """A text's paragraphs as sentences: comment marks at line starts removed, wrapped lines joined, cut at blank lines and sentence ends."""
    plain = F.regexp_replace(text, r"(?m)^[ \t]*+(?:#++|//++|/?\*++/?|;++|--++|%++|>++|<!--++)", "")
    return F.split(plain, r"\n[ \t\r]*+\n|(?<=[.!?;])\s++")


def license_units(base: DataFrame, model: Model, least: float = 0.5, agree: float = 0.6, within: float = 0.33) -> DataFrame:
    """(id, version, pos, family, probability, agreement) of the sentences of `base` (id, version, text) taken for notices.

    A sentence without any of the model's words has no feature and is unknown; so is a longer one with a single such word, since every template that
    is not a title has several. Of the others, the family that the regression prefers
    counts if the calibrated probability of a notice is `least` or more, and the comparison confirms it: of all templates, other licences' included, the one
    that holds the sentence best (by share of its n-grams, then by their number) must be the family's; at least a share `agree` of its n-grams and half
    of the words that only its family has must be there; and a short template or title must make up a share `within` (titles: half) of the sentence.
    """
    spark = base.sparkSession
    cues = F.array(*map(F.lit, model.single_words()))
    each = base.select("id", "version", F.posexplode(units_of(F.col("text"))).alias("pos", "unit")).select("id", "version", "pos", words_of(F.col("unit")).alias("words"))
    some = each.where(F.arrays_overlap("words", cues)).where((F.size("words") <= 16) | (F.size(F.array_intersect("words", cues)) > 1)).select("id", "version", "pos", n_grams(F.col("words")).alias("grams"))
    raw = model.classes.transform(model.vectors.transform(some)).select("id", "version", "pos", "grams", margin_of(vector_to_array("rawPrediction"), len(TEMPLATES)).alias("lead"))
    raw = materialize(raw)                                         # else the filter below scores every sentence a second time
    top = F.array_max("lead")
    family = F.element_at(F.array(*map(F.lit, TEMPLATES)), F.array_position("lead", top).cast("int"))
    guess = raw.select("id", "version", "pos", "grams", family.alias("family"), (1 / (1 + F.exp(-(model.slope * top + model.offset)))).alias("probability")).where(F.col("probability") >= least)
    known = template_rows(spark).agg(F.collect_list(F.struct("family", "title", "grams", "keys")).alias("known"))      # one row, the templates above

    def against(t: Column) -> Column:
        short = t["title"] | (F.size(t["grams"]) < 10)
        own = lambda: 2 * F.size(F.array_intersect("grams", t["keys"])) >= F.size(t["keys"])
        # most templates share less than the least share with a sentence, and are done with one intersection
        return let(F.size(F.array_intersect("grams", t["grams"])), lambda both: F.when(
            (both >= agree * F.size(t["grams"])) & (~short | (both >= F.when(t["title"], 0.5).otherwise(within) * F.size("grams"))) & own(),
            F.struct((both / F.size(t["grams"])).alias("share"), both.alias("both"), (t["family"] == F.col("family")).alias("same"))))
    best = guess.join(F.broadcast(known)).select("id", "version", "pos", "family", "probability", F.array_max(F.transform("known", against)).alias("best"))
    return best.where("best.same").select("id", "version", "pos", "family", "probability", F.col("best.share").alias("agreement"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = True, **options) -> DataFrame:
    """`docs` with licenses array<string> (families, sorted) and n_notices long.

    A notice is a sentence of a paragraph, or a run of neighbouring sentences, that names one family; line breaks within a sentence and
    comment marks do not matter. Null and empty texts have none. Rows without an id, and repeated rows, are judged by their text like all
    others. Equal leads go to the family listed first. An empty table gives no rows. Extra columns stay; licenses and n_notices are replaced.
    Without `keep` only id, licenses and n_notices return, and no text is shuffled.
    """
    base = packed(docs, id_col, text_col).withColumn("version", F.xxhash64("text"))
    found = license_units(base.select("id", "version", "text").where(F.col("text").isNotNull()), train(docs.sparkSession), **options)
    # repeated rows find the same sentences
    found = found.select("id", "version", "family", "pos").distinct()
    goes_on = F.lag("pos").over(Window.partitionBy("id", "version", "family").orderBy("pos")) == F.col("pos") - 1
    found = found.select("id", "version", "family", F.coalesce(goes_on, F.lit(False)).alias("goes_on"))
    found = materialize(found.groupBy("id", "version").agg(F.array_sort(F.collect_set("family")).alias("licenses"), F.count_if(~F.col("goes_on")).alias("n_notices")))
    own = base if keep else base.select("id", "version")
    both = own.alias("b").join(found.alias("f"), F.col("b.id").eqNullSafe(F.col("f.id")) & (F.col("b.version") == F.col("f.version")), "left")
    out = {"licenses": F.coalesce("licenses", F.array().cast("array<string>")), "n_notices": F.coalesce("n_notices", F.lit(0))}
    return unpacked(both, docs.columns, **out) if keep else both.select(F.col("b.id").alias("id"), *[v.alias(c) for c, v in out.items()])


def op2_license_scan(spark, sf_dir):
    out = license_scan(table(spark, sf_dir, "documents"), keep=False)
    return out.select(F.col("id").alias("doc_id"), F.array_join("licenses", ",").alias("licenses"), "n_notices")


QUERIES = {"op2_license_scan": op2_license_scan}
ORACLES: dict[str, str] = {}
