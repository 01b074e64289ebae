"""License scans: headers and licence files by TF-IDF cosine to templates, then inheritance from the nearest directory.

Compared are single lines, sentences inside longer lines, paragraphs and longer runs of neighbouring lines that speak mostly
in the templates' words, so notices wrapped over lines and whole headers, and files with the name of a licence file whole.
Terms are words and versions, so comment marks between them do not matter. Vectors are sparse and live on the templates'
terms, function words left out; other words only add to their length. So what holds none of these terms needs no vector,
and equal contents are scored once for the whole corpus. How rare a term is, is counted over all lines of all files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapelake.llm.common import settle, whole_text

#: Fixed texts: usual notices of common licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work, CC0 1.0 Universal."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_WARRANTY = "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software."
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_WARRANTY = "The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software."
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_WARRANTY = "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage."
_GNU_WARRANTY = "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU General Public License for more details."
_GNU_COPY = "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
#: Fixed texts: whole bodies of short licences, the headers and titles of long ones; for joined lines and whole files.
TEXTS = (
    ("MIT", _GRANT),
    ("MIT", f"{_GRANT} {_MIT_WARRANTY}"),
    ("MIT", f"MIT License {_GRANT} {_MIT_WARRANTY}"),
    ("ISC", _ISC_GRANT),
    ("ISC", f"{_ISC_GRANT} {_ISC_WARRANTY}"),
    ("BSD-2-Clause", f"{_BSD_GRANT} {_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_NAMES}"),
    ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_NAMES} {_BSD_WARRANTY}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0", _GNU.format(3)),
    ("GPL-3.0", f"{_GNU.format(3)} {_GNU_WARRANTY} {_GNU_COPY}"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-2.0", _GNU.format(2)),
    ("GPL-2.0", f"{_GNU.format(2)} {_GNU_WARRANTY} {_GNU_COPY}"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
)
#: Function words, which no vector holds.
STOP_WORDS = (
    "a an and any are as at be by can for found free from in into is it may not of on or other s see that the this to under "
    "use v with without work you"
).split()
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
SENTENCE_END = r"(?<=[.;!?])\s+"
LICENSE_NAME = r"(?i)^(un)?licen[cs]es?(\.[a-z]+)?$|^copying(\.[a-z]+)?$"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def template_terms(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """``(template, license, term, tf)``."""
    rows = spark.createDataFrame([(k, *t) for k, t in enumerate(templates)], "template int, license string, text string")
    return (
        rows.select("template", "license", F.explode(terms(F.col("text"))).alias("term"))
        .filter(~F.col("term").isin(STOP_WORDS))
        .groupBy("template", "license", "term")
        .agg(F.count("*").cast("double").alias("tf"))
    )


def matched_lines(
    lines: DataFrame, n_lines: int, templates: tuple[tuple[str, str], ...], least: float, seen: DataFrame | None = None
) -> DataFrame:
    """``(content, license, similarity)`` of the best template of each line content, if similar enough; ties to the first
    licence by name. ``lines(content, n)`` are distinct contents and how often they occur, n_lines the lines of all files.
    If those are more than ``lines``, ``seen(term, df)`` tells how many of them hold each term of the templates."""
    spark = lines.sparkSession
    wanted = template_terms(spark, templates)
    words = lines.select("content", "n", F.explode(F.split("content", " ")).alias("term")).filter(~F.col("term").isin(STOP_WORDS))
    tf = words.groupBy("content", "term").agg(F.count("*").cast("double").alias("tf"), F.first("n").alias("n"))
    vocabulary = wanted.select("term").distinct()
    if seen is None:
        seen = tf.join(vocabulary, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    rarest = F.lit(1.0) + F.log(F.lit(float(n_lines + 1)))
    idf = settle(
        vocabulary.join(seen, "term", "left").select("term", (rarest - F.log1p(F.coalesce("df", F.lit(0)))).alias("idf")), "idf"
    )
    line = tf.join(idf, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", rarest))
    norm = line.groupBy("content").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    other = wanted.join(idf, "term").withColumn("v", F.col("tf") * F.col("idf"))
    other_norm = other.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("other_norm"))
    other = other.join(other_norm, "template").select("template", "license", "term", (F.col("v") / F.col("other_norm")).alias("v"))
    dot = line.join(other, "term").groupBy("content", "template", "license").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = dot.join(norm, "content").select("content", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("similarity"))
    best = cosine.filter(F.col("similarity") >= least).groupBy("content")
    best = best.agg(F.min(F.struct((-F.col("similarity")).alias("s"), "license")).alias("b"))
    return best.select("content", "b.license", (-F.col("b.s")).alias("similarity"))


def may_match(words: Column, vocabulary: list[str], least: float) -> Column:
    """False only for lines that no template can be as similar to. No word is rarer than one the templates lack, so s
    occurrences of their terms and u of other words bound the squared cosine by s * s / (s * s + u)."""
    shared = F.size(F.filter(words, lambda w: w.isin(vocabulary))).cast("double")
    other = F.size(F.filter(words, lambda w: ~w.isin(vocabulary) & ~w.isin(STOP_WORDS)))
    return shared * shared * (1 - least * least) >= least * least * other * (1 - 1e-9)


def vocabulary_of(templates: tuple[tuple[str, str], ...]) -> list[str]:
    return sorted({t for _, text in templates for t in _python_terms(text)} - set(STOP_WORDS))


def line_contents(text: Column) -> Column:
    """The terms of each line, joined by one space."""
    return F.transform(F.split(text, "\n"), lambda x: F.array_join(terms(x), " "))


def terms_of_lines(lines: Column, templates: tuple[tuple[str, str], ...]) -> Column:
    """The templates' terms in each of the line contents, one after the other and each once a line."""
    vocabulary = vocabulary_of(templates)
    return F.flatten(F.transform(lines, lambda x: F.array_distinct(F.filter(F.split(x, " "), lambda w: w.isin(vocabulary)))))


def line_units(text: Column, lines: Column, templates: tuple[tuple[str, str], ...], least: float) -> Column:
    """``[(kind, content)]``: lines, and the sentences of lines that hold several, that a template may be similar to."""
    vocabulary = vocabulary_of(templates)
    known = r"(?:^| )(?:" + "|".join(v.replace(".", r"\.") for v in vocabulary) + r")(?: |$)"
    several = F.filter(F.transform(F.split(text, "\n"), lambda x: F.split(x, SENTENCE_END)), lambda x: F.size(x) > 1)
    sentences = F.transform(F.flatten(several), lambda x: F.array_join(terms(x), " "))

    def kept(contents: Column, kind: int) -> Column:
        contents = F.filter(contents, lambda x: x.rlike(known) & may_match(F.split(x, " "), vocabulary, least))
        return F.transform(contents, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("content")))

    return F.concat(kept(lines, 0), kept(sentences, 1))


def joined_units(lines: Column, is_license: Column, templates: tuple[tuple[str, str], ...], least: float) -> Column:
    """``[(kind, content)]``: paragraphs of several lines, longer runs of lines, and the whole text of a licence file.

    A run is made of neighbouring lines that have at least as many words of the templates as others, function words not
    counted; lines without words stand inside it, and part its paragraphs.
    """
    vocabulary = vocabulary_of(templates)

    def of_a_notice(line: Column) -> Column:
        words = F.split(line, " ")
        known = F.size(F.filter(words, lambda w: w.isin(vocabulary)))
        return (line == "") | (known >= F.size(F.filter(words, lambda w: ~w.isin(vocabulary) & ~w.isin(STOP_WORDS))))

    marked = F.array_join(F.transform(lines, lambda x: F.when(of_a_notice(x), x).otherwise("\r")), "\n")
    several = lambda x: x.contains("\n")
    runs = F.filter(F.transform(F.split(marked, "\r"), lambda x: F.trim(x, F.lit("\n"))), several)
    paragraphs = F.flatten(F.transform(F.filter(runs, lambda x: x.contains("\n\n")), lambda x: F.split(x, "\n\n+")))
    whole = F.when(is_license, F.array(F.array_join(lines, "\n"))).otherwise(F.array().cast("array<string>"))

    def kept(raw: Column, kind: int) -> Column:
        contents = F.transform(raw, lambda x: F.trim(F.regexp_replace(x, "\n+", " ")))
        contents = F.filter(contents, lambda x: may_match(F.split(x, " "), vocabulary, least))
        return F.transform(contents, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("content")))

    return F.concat(kept(F.filter(paragraphs, several), 2), kept(runs, 3), kept(whole, 4))


def licenses(
    files: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    least: float = 0.75,
    file_share: float = 0.5,
    texts: tuple[tuple[str, str], ...] = TEXTS,
) -> DataFrame:
    """``(doc_id, path, license, origin, similarity)`` for each row of ``files(doc_id, path, text)``.

    Every line of a file, and every sentence of a line with several, is compared with all templates; paragraphs and runs of
    lines that speak in their words, and files named as licence files, with templates and texts. The best match of cosine
    ``least`` or more is the file's own licence (origin ``own``; ties to the first by name). A licence file is one named
    so, or with ``file_share`` of its characters in matches of one kind; its licence holds for its directory. A file
    without an own licence inherits from the nearest directory above it that has one (origin ``inherited``, similarity that
    of the match there; of several licence files the best match counts), else license and origin are null. Null and empty
    texts match nothing, null paths have no directory; repeated rows give repeated rows; other columns are not read;
    without files the result is empty.
    """
    path = F.col("path").cast("string")
    named = F.coalesce(F.element_at(F.split(F.trim(path, F.lit("/")), "/+"), -1).rlike(LICENSE_NAME), F.lit(False))
    lines = F.col("_lines")
    whole = files.select("doc_id", path.alias("path"), whole_text().alias("_text"))
    slim = whole.withColumn("_lines", line_contents(F.col("_text"))).select(
        "doc_id",
        "path",
        F.length("_text").alias("chars"),
        F.size("_lines").alias("n_lines"),
        F.concat(line_units(F.col("_text"), lines, templates, least), joined_units(lines, named, templates + texts, least)).alias("units"),
        terms_of_lines(lines, templates + texts).alias("terms"),
    )
    slim = settle(slim.withColumn("row", F.monotonically_increasing_id()), "license-lines")  # read back, the ids are fixed
    n_lines = slim.agg(F.sum("n_lines")).first()[0] or 0
    # Rarity is counted over all lines of all files, also those that no template may be similar to.
    seen = slim.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    seen = settle(seen, "license-terms")
    exploded = slim.select("row", F.explode("units").alias("u")).select("row", "u.*", (F.col("u.kind") >= 2).alias("joined"))
    contents = settle(exploded.groupBy("content", "joined").agg(F.count("*").alias("n")), "license-contents")
    sides = [
        matched_lines(contents.filter(F.col("joined") == side), n_lines, of, least, seen).withColumn("joined", F.lit(side))
        for side, of in ((False, templates), (True, templates + texts))
    ]
    found = settle(sides[0].unionByName(sides[1]), "license-matches")
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "license")).alias("b")
    own = exploded.join(found, ["content", "joined"]).groupBy("row", "kind").agg(best, F.sum(F.length("content")).alias("covered"))
    own = own.groupBy("row").agg(F.min("b").alias("b"), F.max("covered").alias("covered"))
    own = own.select("row", F.col("b.license").alias("own"), (-F.col("b.s")).alias("similarity"), "covered")
    parts = F.split(F.trim(F.col("path"), F.lit("/")), "/+")
    rows = slim.drop("units", "terms", "n_lines").join(own, "row", "left").withColumn("parts", parts)
    rows = rows.withColumn("dir", F.array_join(F.slice("parts", 1, F.size("parts") - 1), "/"))
    rows = settle(rows.withColumn("name", F.element_at("parts", -1)).drop("parts"), "license-files")
    is_license = F.col("name").rlike(LICENSE_NAME) | (F.col("covered") >= file_share * F.col("chars"))
    of_dir = rows.filter(F.col("own").isNotNull() & F.col("dir").isNotNull() & is_license).groupBy("dir")
    of_dir = of_dir.agg(F.min(F.struct((-F.col("similarity")).alias("s"), F.col("own").alias("license"))).alias("held"))
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, 1, k), "/").alias("at")))
    dirs = rows.select("dir").filter("dir is not null").distinct().select("dir", F.explode(above).alias("a")).select("dir", "a.depth", F.col("a.at").alias("at"))
    nearest = dirs.join(of_dir.withColumnRenamed("dir", "at"), "at").groupBy("dir").agg(F.max_by("held", "depth").alias("held"))
    nearest = settle(nearest, "license-directories")  # of a known size: sent to the rows if small, so a full directory is no hot key
    rows = rows.join(nearest, "dir", "left")
    return rows.select(
        "doc_id",
        "path",
        F.coalesce("own", "held.license").alias("license"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("held").isNotNull(), "inherited").alias("origin"),
        F.when(F.col("own").isNotNull(), F.col("similarity")).otherwise(-F.col("held.s")).alias("similarity"),
    )


def _python_terms(text: str) -> list[str]:
    import re

    return re.findall(TERM, text.lower())
