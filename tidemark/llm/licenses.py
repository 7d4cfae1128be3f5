"""Licence scan: normalised text against licence templates by Dice over word bigrams.

A unit is a line of a text or the whole text. Both are normalised alike: lower case, words of
letters and digits only, single spaces. The Dice coefficient of two sets of word bigrams is twice
the shared ones over the sum of their sizes, so a template of m bigrams can reach ``threshold`` t
only with units of ``t / (2 - t) * m`` to ``(2 - t) / t * m`` bigrams. That bound drops whole
texts and lines before any bigram is matched. All of it is DataFrame expressions; the templates are
a short constant table.

A notice that is wrapped stands on several lines of a longer text. :func:`scan_runs` finds those, as
runs of consecutive lines, and complete licence texts (:data:`BODIES`) wherever they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.6

#: Licence notices as published by their authors. Fixed values.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
           "software and associated documentation files (the \"Software\"), to deal in the "
           "Software without restriction, including without limitation the rights to use, copy, "
           "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
           "and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
                  "use this file except in compliance with the License. You may obtain a copy of "
                  "the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without "
                    "modification, are permitted provided that the following conditions are met:",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the "
               "terms of the GNU General Public License as published by the Free Software "
               "Foundation, either version 3 of the License, or (at your option) any later "
               "version.",
    "LGPL-3.0": "This library is free software; you can redistribute it and/or modify it under "
                "the terms of the GNU Lesser General Public License as published by the Free "
                "Software Foundation; either version 3 of the License, or (at your option) any "
                "later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
               "2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
               "at https://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with "
           "or without fee is hereby granted, provided that the above copyright notice and this "
           "permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
                 "License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                    "International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related "
               "or neighboring rights to this work.",
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice-2": "Licensed under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "SPDX-MIT": "SPDX-License-Identifier: MIT",
    "SPDX-Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "SPDX-GPL-3.0": "SPDX-License-Identifier: GPL-3.0-or-later",
    "All-rights-reserved": "Copyright. All rights reserved.",
}


_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
          "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
          "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
          "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
          "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
          "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_NO_LIABILITY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
                 "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
                 "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS {}BE LIABLE "
                 "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
                 "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
                 "OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_1_2 = ("1. Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer. 2. Redistributions in binary form must "
            "reproduce the above copyright notice, this list of conditions and the following "
            "disclaimer in the documentation and/or other materials provided with the "
            "distribution. ")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used "
          "to endorse or promote products derived from this software without specific prior "
          "written permission. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
            "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
            "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
            "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
            "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
            "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
            "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
            "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
            "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

#: Complete licence texts. The long ones are not among them: of the Apache licence, GPL and MPL the
#: notice is found that their own texts quote, LGPL and Creative Commons texts only by a notice.
BODIES = {
    "MIT-text": TEMPLATES["MIT"] + " The above copyright notice and this permission notice shall be "
                "included in all copies or substantial portions of the Software. "
                + _NO_LIABILITY.format("OR COPYRIGHT HOLDERS "),
    "BSD-3-Clause-text": TEMPLATES["BSD-3-Clause"] + " " + _BSD_1_2 + _BSD_3 + _BSD_END,
    "BSD-2-Clause-text": TEMPLATES["BSD-3-Clause"] + " " + _BSD_1_2 + _BSD_END,
    "ISC-text": TEMPLATES["ISC"] + " " + _AS_IS,
    "Unlicense-text": TEMPLATES["Unlicense"] + " Anyone is free to copy, modify, publish, use, "
                      "compile, sell, or distribute this software, either in source code form or as "
                      "a compiled binary, for any purpose, commercial or non-commercial, and by any "
                      "means. In jurisdictions that recognize copyright laws, the author or authors "
                      "of this software dedicate any and all copyright interest in the software to "
                      "the public domain. We make this dedication for the benefit of the public at "
                      "large and to the detriment of our heirs and successors. We intend this "
                      "dedication to be an overt act of relinquishment in perpetuity of all present "
                      "and future rights to this software under copyright law. "
                      + _NO_LIABILITY.format(""),
}


def normalised(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _pairs(words: Column) -> Column:
    """The pairs of neighbouring words, of two words or more."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - 1),
                       lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))


def bigrams(words: Column) -> Column:
    """The distinct pairs of neighbouring words; a single word counts as one."""
    return F.when(F.size(words) >= 2, F.array_distinct(_pairs(words))).otherwise(
        F.filter(words, lambda w: w != ""))


def template_table(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``license, bigram, template_bigrams``: a few hundred constant rows."""
    rows = spark.createDataFrame(list(templates.items()), "license string, template string")
    grams = rows.withColumn("g", bigrams(F.split(normalised(F.col("template")), " ")))
    return grams.select("license", F.explode("g").alias("bigram"),
                        F.size("g").alias("template_bigrams"))


def _size_bounds(templates: dict[str, str], threshold: float) -> tuple[int, int]:
    """Fewest and most words a unit can have to reach the threshold with any template.

    Distinct bigrams are at most words - 1 (so too few words are too few bigrams); a unit of more
    words can have few distinct bigrams, so the upper bound holds for distinct ones only.
    """
    import re
    sizes = []
    for text in templates.values():
        words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
        sizes.append(len(set(zip(words, words[1:], strict=False))) or 1)
    low = threshold / (2 - threshold) * min(sizes)
    return int(low), int((2 - threshold) / threshold * max(sizes)) + 1


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text",
         templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``key, line, license, score, n_bigrams``: every unit's templates at or above the threshold.

    ``line`` is the line number from 1, or 0 for the whole text (only of texts with more than one
    line; a single line is its own text). Null, empty and wordless units match nothing; keys that
    repeat or are null keep their rows apart by nothing but the key, so equal rows give equal
    lines; extra columns are ignored.
    """
    low, high = _size_bounds(templates, threshold)
    lines = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"),
                        lambda line: F.split(normalised(line), " "))
    parts = F.transform("lines", lambda ws, i: F.struct((i + 1).alias("line"), ws.alias("words")))
    whole = F.struct(F.lit(0).alias("line"),
                     F.filter(F.flatten("lines"), lambda w: w != "").alias("words"))
    words = docs.select(key, lines.alias("lines")).select(key, F.explode(
        F.when(F.size("lines") > 1, F.concat(F.array(whole), parts)).otherwise(parts))
        .alias("u")).select(key, "u.*")
    grams = (words.filter(F.size("words") >= max(1, low))
             .withColumn("g", bigrams(F.col("words")))
             .withColumn("n_bigrams", F.size("g"))
             .filter(F.col("n_bigrams").between(low, high))
             .select(key, "line", "n_bigrams", "g", F.monotonically_increasing_id().alias("_u")))
    table = template_table(docs.sparkSession, templates)
    # the templates are constants of the call
    shared = (grams.select(key, "line", "n_bigrams", "_u", F.explode("g").alias("bigram"))
              .join(F.broadcast(table), "bigram"))
    ratio = threshold / (2 - threshold)
    fits = (F.col("n_bigrams") >= F.col("template_bigrams") * ratio) & (
        F.col("template_bigrams") >= F.col("n_bigrams") * ratio)
    score = 2.0 * F.count("*") / (F.col("n_bigrams") + F.col("template_bigrams"))
    return (shared.filter(fits)
            .groupBy(key, "line", "_u", "license", "n_bigrams", "template_bigrams")
            .agg(score.alias("score")).filter(F.col("score") >= threshold)
            .select(key, "line", "license", "score", "n_bigrams"))


_RUN = "struct<first:int,last:int,score:double,n:int>"


def _held(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that is reckoned once per row: not again in filters or lambdas."""
    return rows.withColumn(name, F.explode_outer(F.array(value)))


def _runs(texts: DataFrame, threshold: float) -> DataFrame:
    """``first, last, score, n`` of runs of lines that reach the threshold with the row's template.

    ``grams`` stand on the lines ``lo`` to ``hi``. A run that scores best starts and ends on a line
    with a bigram of the template, so others are not tried. From a start the text is followed until
    it has more distinct bigrams than fit the template: at most to the end of the first block of
    bigrams that alone has too many.
    """
    t, n, block = F.col("t"), F.size("grams"), F.col("block")
    rows = _held(texts, "own", F.array_intersect(t["grams"], F.col("hits")))
    rows = _held(rows, "places", F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.array_contains(
        F.col("own"), F.get(F.col("grams"), i))))
    rows = _held(rows, "block", F.greatest(
        F.lit(512), 2 * t["most"], F.floor(n / 64).cast("int")))
    blocks = F.filter(F.sequence(F.lit(0), F.floor(n / block).cast("int")),
                      lambda k: (k + 1) * block <= n)
    rows = _held(rows, "full", F.filter(blocks, lambda k: F.size(F.array_distinct(
        F.slice("grams", k * block + 1, block))) > t["most"]))
    rows = rows.withColumn("first", F.explode_outer(F.array_distinct(F.transform(
        "places", lambda i: F.get(F.col("lo"), i)))))
    rows = _held(rows, "p", F.array_position("lo", F.col("first")).cast("int") - 1)
    end = F.coalesce((F.get(F.filter("full", lambda k: k * block >= F.col("p")), F.lit(0)) + 1)
                     * block, n)
    rows = _held(rows, "far", F.slice("grams", F.col("p") + 1, end - F.col("p")))
    rows = _held(rows, "over", F.get(F.array_distinct("far"), t["most"]))
    rows = _held(rows, "win", F.when(F.col("over").isNull(), F.col("far")).otherwise(F.slice(
        "far", F.lit(1), F.array_position("far", F.col("over")).cast("int") - 1)))
    rows = _held(rows, "here", F.filter("places", lambda i: (i >= F.col("p")) & (
        i < F.col("p") + F.size("win")))).filter(F.size("here") >= t["least"])
    rows = _held(rows, "back", F.reverse(F.slice("hi", F.col("p") + 1, F.size("win"))))
    rows = rows.withColumn("last", F.explode_outer(F.array_distinct(F.transform(
        "here", lambda i: F.get(F.col("hi"), i)))))
    cuts = _held(rows, "cut", F.slice("win", F.lit(1), F.size("back") + 1 - F.array_position(
        "back", F.col("last")).cast("int")))
    # a line that goes on behind the window has too many bigrams
    return cuts.filter(F.coalesce(
        F.get("hi", F.col("p") + F.size("cut")) != F.col("last"), F.lit(True))).withColumn(
        "n", F.size(F.array_distinct("cut"))).withColumn(
        "score", 2.0 * F.size(F.array_intersect(t["grams"], F.col("cut")))
        / (F.col("n") + t["n"])).filter(F.col("score") >= threshold)


def scan_runs(docs: DataFrame, key: str = "doc_id", text: str = "text",
              templates: dict[str, str] = TEMPLATES, bodies: dict[str, str] = BODIES,
              threshold: float = THRESHOLD) -> DataFrame:
    """What :func:`scan` cannot see, in its columns: runs of two or more lines that reach the
    threshold, and of ``bodies`` also single lines and whole texts.

    ``line`` is the first line of the run. Runs of a template that overlap are one match, the best
    of them (ties: the earlier, then the shorter). A run is no match where the template was found
    already: if a line of the run or the whole text reaches the threshold by itself. All of it is
    reckoned within the row; only texts that have enough bigrams of a template are looked at twice.
    """
    ratio = threshold / (2 - threshold)
    spark = docs.sparkSession
    rows = spark.createDataFrame(
        [(k, v, False) for k, v in templates.items()] + [(k, v, True) for k, v in bodies.items()],
        "name string, template string, body boolean")
    one = rows.withColumn("grams", bigrams(F.split(normalised(F.col("template")), " "))).withColumn(
        "n", F.size("grams")).agg(
        F.array_distinct(F.flatten(F.collect_list("grams"))).alias("_all"),
        F.collect_list(F.struct(
            "name", "body", "grams", "n", F.ceil(F.col("n") * ratio - 1e-9).cast("int").alias("least"),
            F.floor(F.col("n") / ratio + 1e-9).cast("int").alias("most"))).alias("_templates"))
    found = F.filter("_templates", lambda t: F.size(F.array_intersect(t["grams"], F.col("hits")))
                     >= t["least"])
    # a line end is no letter: the words of the whole text are those of its lines. One row of
    # templates is broadcast.
    words = F.split(normalised(F.col("text")), " ")
    texts = _held(docs.select(key, F.col(text).alias("text")), "words", words)
    texts = _held(texts, "grams", F.when(F.size("words") >= 2, _pairs(F.col("words"))).otherwise(
        F.array().cast("array<string>"))).drop("words").crossJoin(F.broadcast(one))
    texts = _held(texts, "hits", F.array_intersect("_all", "grams")).filter(F.size("hits") > 0)
    texts = texts.select(key, "text", "grams", "hits", F.explode_outer(found).alias("t")).filter(
        F.col("t").isNotNull()).withColumn("_u", F.monotonically_increasing_id())
    sizes = F.transform(F.split("text", "\n"), lambda line: F.size(
        F.filter(F.split(normalised(line), " "), lambda w: w != "")))
    places = _held(texts, "n_all", F.size(F.array_distinct("grams")))
    places = _held(places, "at", F.flatten(F.transform(
        sizes, lambda n, i: F.array_repeat(i + 1, n))))
    places = _held(places, "lo", F.slice("at", F.lit(1), F.size("at") - 1))
    places = _held(places, "hi", F.slice("at", F.lit(2), F.size("at") - 1)).drop("at")
    t = F.col("t")
    whole = 2.0 * F.size(F.array_intersect(t["grams"], F.col("hits"))) / (F.col("n_all") + t["n"])
    runs = (_runs(places, threshold)
            .groupBy(key, "_u", t["name"].alias("license"), t["body"].alias("body"),
                     (F.instr("text", "\n") > 0).alias("several"), "n_all", whole.alias("whole"))
            .agg(F.array_sort(F.collect_list(F.struct("first", "last", "score", "n")).cast(
                f"array<{_RUN}>")).alias("runs")))
    own = F.filter("runs", lambda r: r["first"] == r["last"])
    free = F.filter("runs", lambda r: (r["first"] < r["last"]) & ~F.exists(
        F.col("own"), lambda o: (o["first"] >= r["first"]) & (o["first"] <= r["last"])))

    def joined(done, r):
        last = F.get(done, F.size(done) - 1)
        best = F.when(r["score"] > last["score"], r).otherwise(last)
        return F.when(F.coalesce(last["last"] >= r["first"], F.lit(False)), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1), F.array(best))).otherwise(
            F.concat(done, F.array(r)))
    none = F.array().cast(f"array<{_RUN}>")
    by_itself = F.col("several") & (F.col("whole") >= threshold)
    matches = runs.withColumn("own", own).withColumn("free", free).select(
        key, "license", F.explode(F.concat(
            F.when(by_itself, none).otherwise(F.aggregate("free", none, joined)),
            F.when(F.col("body"), F.col("own")).otherwise(none),
            F.when(F.col("body") & by_itself, F.array(F.struct(
                F.lit(0).alias("first"), F.lit(0).alias("last"), F.col("whole").alias("score"),
                F.col("n_all").alias("n")))).otherwise(none))).alias("r"))
    return matches.select(key, F.col("r.first").alias("line"), "license",
                          F.col("r.score").alias("score"), F.col("r.n").alias("n_bigrams"))


def best_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  templates: dict[str, str] = TEMPLATES,
                  threshold: float = THRESHOLD, bodies: dict[str, str] = BODIES) -> DataFrame:
    """``key, license, score, line, n_found`` of every key with a match: its best unit or run.

    Ties go to the smaller licence name, then the smaller line. ``n_found`` counts the matches.
    """
    found = scan(docs, key, text, templates, threshold).unionByName(
        scan_runs(docs, key, text, templates, bodies, threshold))
    first = F.min(F.struct((-F.col("score")).alias("s"), "license", "line"))
    return found.groupBy(key).agg(first.alias("b"), F.count("*").alias("n_found")).select(
        key, "b.license", (-F.col("b.s")).alias("score"), "b.line", "n_found")
