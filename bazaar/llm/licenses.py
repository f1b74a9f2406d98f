"""License scan: TF-IDF cosine of headers and licence files to templates,
then inheritance from the nearest ancestor directory.

1. The parts of a text that may carry a notice are its lines and paragraphs
   with a cue and the words around each cue, so that a notice may be wrapped
   over lines or stand inside a long sentence.  A licence file adds its whole
   text and its head.  Equal parts are scored once.
2. Parts and templates become sparse TF-IDF vectors over the templates'
   words; the frequencies are counted over all parts and templates.  A part
   takes the template with the highest cosine if that reaches ``min_cosine``.
3. A file takes the license of its best part; in a licence file the whole text
   and the head go before single parts, as a licence may name others.  A
   directory takes the license of its licence files.  A file without a license
   of its own inherits from the nearest ancestor directory, by a join on the
   ancestors of its path.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm.common import stored

# Short notices, titles and the texts of short licenses, by SPDX identifier.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:")
_MIT_REST = (
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE.")
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.")
_BSD_NAMES = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
_BSD_REST = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU_HEAD = (
    " Copyright (C) 2007 Free Software Foundation, Inc. https://fsf.org/ Everyone is permitted to copy and distribute "
    "verbatim copies of this license document, but changing it is not allowed.")
_NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ "
     "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MIT", "Released under the MIT License"),
    ("MIT", _MIT_GRANT),
    ("MIT", _MIT_GRANT + _MIT_REST),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007" + _GNU_HEAD),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007" + _GNU_HEAD),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007" + _GNU_HEAD),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD 3-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License " + _BSD_GRANT + _BSD_NAMES + _BSD_REST),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License " + _BSD_GRANT + _BSD_REST),
    ("BSD-2-Clause", _BSD_GRANT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved. Unauthorized copying is prohibited"),
    ("Proprietary", "All rights reserved."),
)
# Each identifier also stands for itself in an SPDX tag.
TEMPLATES = _NOTICES + tuple((i, f"SPDX-License-Identifier: {i}") for i in sorted({i for i, _ in _NOTICES}))

#: A reservation of rights often stands beside a license, so it counts only without one.
LAST_RESORT = "Proprietary"

# Cues of parts, the same as single words, and names of licence files.
CUES = ("licen[cs]e|spdx-|copyright|all rights reserved|public domain|permission is hereby granted"
        "|redistribution and use")
CUE_WORDS = "licen[cs]e|spdx|copyright|reserved|domain|hereby|redistribution"
LICENCE_FILES = r"(?i)^(licen[cs]e|copying|copyright|notice|unlicense)([.\-_].*)?$"

#: Lower-case words; dots and hyphens inside a word stay (versions, ids).
TERM = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"
#: A paragraph ends at a line of blanks or comment signs.
BLANK_LINE = r"\n[ \t#*/;-]*\n"
#: Words before a cue, words of its whole window, words of a licence file's head.
BEFORE, AROUND, HEAD = 8, 20, 40
#: Long paragraphs are cut into pieces before windows are taken; a second
#: cut half a piece further on has the windows that the first one parts.
PIECE = r"(?:[^ \t\n]+[ \t\n]*){1,200}"
HALF_PIECE = r"^[ \t\n]*(?:[^ \t\n]+[ \t\n]*){1,100}"

MIN_COSINE = 0.6
#: Templates of more characters than this are joined without a broadcast.
SMALL_TEMPLATES = 1 << 20


def _terms(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TERM), F.lit(0))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    return spark.createDataFrame(list(templates), "license string, notice string")


def _windows(terms: Column) -> Column:
    """The words around each cue word, as texts."""
    return F.array_compact(F.transform(terms, lambda x, i: F.when(
        x.rlike(CUE_WORDS), F.array_join(F.slice(terms, F.greatest(i - BEFORE + 1, F.lit(1)), AROUND), " "))))


def _pieces(paragraph: Column) -> Column:
    cut = F.regexp_extract_all(paragraph, F.lit(PIECE), F.lit(0))
    shifted = F.regexp_extract_all(F.regexp_replace(paragraph, HALF_PIECE, ""), F.lit(PIECE), F.lit(0))
    return F.concat(cut, shifted)


def parts(files: DataFrame) -> DataFrame:
    """(_key, _path, _named, kind, part) of every part that may carry a
    notice, in one pass; ``files`` has _key, _path, text.  ``kind`` is 'line',
    'paragraph', 'window' or, of licence files, 'whole' or 'head'."""
    named = F.element_at(F.split("_path", "/"), -1).rlike(LICENCE_FILES)
    keys = ["_key", "_path", "_named"]
    cut = (files.where(named | F.lower("text").rlike(CUES))
           .select("_key", "_path", named.alias("_named"), F.regexp_replace("text", r"\r\n?", "\n").alias("text"))
           .select(*keys, "text",
                   F.filter(F.split("text", "\n"), lambda x: F.col("_named") | F.lower(x).rlike(CUES)).alias("line"),
                   F.filter(F.split("text", BLANK_LINE), lambda x: F.lower(x).rlike(CUES)).alias("paragraph"))
           .select("*", F.filter(F.flatten(F.transform("paragraph", _pieces)),
                                 lambda x: F.lower(x).rlike(CUE_WORDS)).alias("piece"))
           .select("*", F.transform("piece", _terms).alias("terms")))
    head = F.array_join(F.slice(_terms(F.regexp_extract("text", HALF_PIECE, 0)), 1, HEAD), " ")

    def kind(name: str, texts: Column) -> Column:
        return F.transform(texts, lambda x: F.struct(F.lit(name).alias("kind"), x.alias("part")))
    each = F.concat(kind("line", F.col("line")), kind("paragraph", F.col("paragraph")),
                    kind("window", F.flatten(F.transform("terms", _windows))),
                    kind("whole", F.filter(F.array("text"), lambda x: F.col("_named"))),
                    kind("head", F.filter(F.array(head), lambda x: F.col("_named"))))
    return cut.select(*keys, F.inline(each)).where(F.length(F.trim("part")) > 0)


def score_parts(bodies: DataFrame, templates: DataFrame, min_cosine: float = MIN_COSINE, small: bool = True) -> DataFrame:
    """(unit, license, cosine) of the distinct parts that match a template;
    ``bodies`` has unit (a digest) and part.  ``small``: broadcast templates.

    Ties of the cosine go to the license that sorts first.
    """
    hint = F.broadcast if small else (lambda df: df)
    texts = bodies.groupBy("unit").agg(F.first("part").alias("part"))
    tf_templates = (templates.select("license", "notice", F.explode(_terms(F.col("notice"))).alias("term"))
                    .groupBy("license", "notice", "term").agg(F.count(F.lit(1)).alias("ttf")))
    words = tf_templates.groupBy("term").agg(F.count(F.lit(1)).alias("tdf"))
    # only words of templates count, so long prose around a notice costs nothing
    tf = (texts.select("unit", F.explode(_terms(F.col("part"))).alias("term")).join(hint(words.select("term")), "term")
          .groupBy("unit", "term").agg(F.count(F.lit(1)).alias("tf")))
    df = (words.join(tf.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term", "left")
          .select("term", (F.col("tdf") + F.coalesce("n", F.lit(0))).alias("df")))
    n = (texts.agg(F.count(F.lit(1)).alias("n")).crossJoin(templates.agg(F.count(F.lit(1)).alias("t")))  # one row each
         .select((F.col("n") + F.col("t")).alias("n")))
    idf = (df.crossJoin(F.broadcast(n))  # one row
           .select("term", (F.log((F.col("n") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf")))
    wt = tf_templates.join(idf, "term").select("license", "notice", "term", (F.col("ttf") * F.col("idf")).alias("tw"))
    tnorm = wt.groupBy("license", "notice").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    wt = wt.join(tnorm, ["license", "notice"]).select("license", "notice", "term", (F.col("tw") / F.col("tnorm")).alias("tw"))
    w = tf.join(hint(idf), "term").select("unit", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = w.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = w.join(hint(wt), "term").groupBy("unit", "license", "notice").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cosine = dots.join(norm, "unit").withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6))
    # highest cosine first, then the license that sorts first
    best = cosine.groupBy("unit").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("best"))
    return (best.where(-F.col("best.c") >= min_cosine)
            .select("unit", F.col("best.license").alias("license"), (-F.col("best.c")).alias("cosine")))


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(path: Column) -> Column:
    """The directories above a path, nearest first; the root is ''."""
    parts = F.split(_parent(path), "/")
    depth = F.when(_parent(path) == "", 0).otherwise(F.size(parts))
    return F.transform(F.sequence(F.lit(0), depth), lambda up: F.struct(
        up.alias("up"), F.array_join(F.slice(parts, 1, depth - up), "/").alias("dir")))


def license_scan(files: DataFrame, key_col: str, path_col: str, text_col: str,
                 templates: DataFrame | None = None, min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row per file: key, path, license, how it was found, cosine, lines
    that match a template.

    ``found`` is 'header' (its own text), 'inherited' (from the directory
    named in ``from_dir``) or 'none'.  A licence file hands its license to its
    directory.  Null or empty texts have no header; a null path stands in the
    root.  Keys are expected to be unique; rows that repeat a key share the
    license found for the key.  Equal directories with several licence files
    take the highest cosine, then the license that sorts first.  A reservation
    of rights counts only where no license is found.
    """
    spark = files.sparkSession
    small = templates is None
    if templates is None:
        templates = template_table(spark)
    else:
        templates = templates.select("license", "notice").where("notice is not null").distinct()
        chars = templates.agg(F.sum(F.length("notice"))).first()[0]
        small = (chars or 0) <= SMALL_TEMPLATES
    rows = files.select(F.col(key_col).alias("_key"),
                        F.regexp_replace(F.coalesce(F.col(path_col), F.lit("")), r"^/+|(?<=/)/+", "").alias("_path"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # few parts have a cue, and three plans read them
    units = stored(parts(rows).withColumn("unit", F.sha2("part", 256)), "license-parts")
    hits = units.drop("part").join(score_parts(units.select("unit", "part"), templates, min_cosine, small), "unit")
    late = (F.col("license") == LAST_RESORT).alias("late")
    part = (~F.col("kind").isin("whole", "head")).alias("part")
    own = (hits.groupBy("_key", "_path", "_named")
           .agg(F.min(F.struct(late, part, (-F.col("cosine")).alias("c"), "license")).alias("own"),
                F.count(F.when(F.col("kind") == "line", 1)).alias("n_lines"))
           .select("_key", "_path", "_named", "own.late", "own.license", (-F.col("own.c")).alias("cosine"), "n_lines"))
    by_dir = (own.where("_named").groupBy(_parent(F.col("_path")).alias("dir"))
              .agg(F.min(F.struct("late", (-F.col("cosine")).alias("c"), "license")).alias("top"))
              .select("dir", F.col("top.license").alias("dir_license"), (-F.col("top.c")).alias("dir_cosine")))
    # inheritance is decided per directory, not per file
    dirs = rows.select(_parent(F.col("_path")).alias("_dir")).distinct()
    chain = dirs.select("_dir", F.explode(ancestors(F.concat(F.col("_dir"), F.lit("/x")))).alias("a"))
    chain = chain.select("_dir", F.col("a.up").alias("up"), F.regexp_replace("a.dir", "^/", "").alias("dir"))
    near = (chain.join(by_dir, "dir").groupBy("_dir")
            .agg(F.min(F.struct("up", "dir", "dir_license", "dir_cosine")).alias("near")))
    mine = own.select(F.col("_key").alias("_k"), F.col("_path").alias("_p"), "license", "cosine", "n_lines")
    return (rows.select("_key", "_path", _parent(F.col("_path")).alias("_dir"))
            .join(mine, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_path") == F.col("_p")), "left")
            .join(near, "_dir", "left")
            .select(F.col("_key").alias("key"), F.col("_path").alias("path"),
                    F.coalesce("license", "near.dir_license").alias("license"),
                    F.when(F.col("license").isNotNull(), "header")
                    .when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("found"),
                    F.when(F.col("license").isNull(), F.col("near.dir")).alias("from_dir"),
                    F.coalesce("cosine", "near.dir_cosine").alias("cosine"),
                    F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines")))
