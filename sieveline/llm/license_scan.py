"""License scans: an exact set-similarity join of text blocks with license templates.

A document's words are cut into blocks twice as long as the stride they start at, so whatever is at
most a stride long lies in one block whole. The stride is 32 words for templates of up to 32 words, and for
longer ones the power of two that the longest fits in: a template is found at every offset.
A block meets a template when it holds at least ceil(threshold * size) of the template's distinct words. The join is a prefix join: words are
ordered by how often the whole corpus has them, rarest first; a block that meets the template
must hold one of its first size - need + 1 words, and is paired with it only at the first of
these. Before the overlap is counted, the length filter (enough words of the vocabulary at
all) and the positional filter (enough words left after the shared one, on either side) run.
Base phrases are templates with threshold 1, and an exact check then finds the places where
their words stand consecutively.

Templates are a parameter and small: their vocabulary and prefix index are bounded by it, not
by the corpus. Null and empty texts have no words and no labels; equal rows are scanned each
on its own; a text of any length is cut by one task; words that are equally frequent are ordered by
themselves; ids may have any type; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import lower_ascii, text_of

TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STRIDE = 32


_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = 0.8
    base: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(TERM, self.text.translate(_LOWER))

    @property
    def need(self) -> int:
        return math.ceil(self.threshold * len(set(self.words)) - 1e-9)


# Phrases, openings and whole texts of public licenses.
TEMPLATES = (
    Template("mit", "under the mit license", 1.0, True),
    Template("apache-2", "apache license version 2", 1.0, True),
    Template("cc-by-nc", "cc by nc", 1.0, True),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction"),
    Template("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", 0.85),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", 0.85),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", 0.85),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", 0.85),
    Template("all-rights-reserved", "all rights reserved", 1.0),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    Template(
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. "
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
)


def strides(templates) -> list[int]:
    """The stride of each template's blocks."""
    longest = max((len(t.words) for t in templates), default=0)
    return [STRIDE if len(t.words) <= STRIDE else 1 << (longest - 1).bit_length() for t in templates]


def terms(text: str = "text") -> Column:
    return F.regexp_extract_all(lower_ascii(text_of(text)), F.lit(TERM), F.lit(0))


def word_order(docs: DataFrame, vocabulary: set[str], text: str = "text") -> list[str]:
    """The vocabulary from its rarest word in the whole corpus to the commonest; ties by the word. One row a word comes to the driver."""
    counts = docs.select(F.explode(F.filter(terms(text), lambda w: w.isin(*sorted(vocabulary)))).alias("term")).groupBy("term").count()
    found = {r["term"]: r["count"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (found.get(w, 0), w))


def license_scan(docs: DataFrame, templates=TEMPLATES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of docs."""
    spark = docs.sparkSession
    order = word_order(docs, {w for t in templates for w in t.words}, text)
    rank = {w: k for k, w in enumerate(order)}
    index, prefix_words = [], set()
    strided = strides(templates)
    for nth, t in enumerate(templates):
        ordered = sorted(set(t.words), key=rank.get)
        for i, w in enumerate(ordered[: len(ordered) - t.need + 1]):
            prefix_words.add(w)
            index.append((strided[nth], w, nth, t.label, t.base, ordered, t.need, i, t.words if t.base else None))
    index_rows = spark.createDataFrame(
        index, "for_stride int, term string, nth int, label string, base boolean, t_words array<string>, need int, i int, phrase array<string>"
    )
    strings = lambda words: F.array(*[F.lit(w) for w in words])
    prefix = strings(sorted(prefix_words, key=rank.get))

    n = F.size("words")
    def blocks_of(stride: int) -> Column:
        """The blocks that hold a prefix word, by the words' places."""
        starts = F.filter(F.array_distinct(F.flatten(F.transform("places", lambda i: F.array(F.floor(i / stride), F.floor(i / stride) - 1)))), lambda b: b >= 0)
        return F.transform(starts, lambda b: F.struct(F.lit(stride).alias("stride"), (b * stride).cast("int").alias("at"), F.slice("words", (b * stride + 1).cast("int"), 2 * stride).alias("w")))

    cut = F.concat(*[blocks_of(stride) for stride in sorted(set(strided)) or [STRIDE]])
    places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(*prefix_words) if prefix_words else F.lit(False), i)), lambda i: i.isNotNull())
    blocks = (
        # explode, so that words and places are made once
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.explode(F.array(terms(text))).alias("words"))
        .select("row", "doc_id", "words", F.explode(F.array(places)).alias("places"))
        .select("row", "doc_id", n.cast("long").alias("n_words"), F.explode_outer(cut).alias("x"))
        .select("row", "doc_id", "n_words", F.col("x.stride").alias("stride"), F.col("x.at").alias("at"), F.col("x.w").alias("w"), F.explode_outer(F.array_intersect(prefix, F.col("x.w"))).alias("word"))
        .withColumn("ordered", F.array_intersect(strings(order), "w"))
    )
    left_in_block = F.size("ordered") - F.array_position("ordered", F.col("word")).cast("int")
    left_in_template = F.size("t_words") - F.col("i") - 1
    meets = (
        (F.col("word") == F.col("term"))
        & (F.col("stride") == F.col("for_stride"))
        & (F.size("ordered") >= F.col("need"))
        & (F.least(left_in_block, left_in_template) + 1 >= F.col("need"))
        & ~F.arrays_overlap(F.slice("t_words", 1, F.col("i")), F.col("w"))
        & (F.size(F.array_intersect("t_words", "w")) >= F.col("need"))
    )
    pairs = blocks.join(F.broadcast(index_rows), meets, "left")
    starts = F.filter(F.sequence(F.lit(0), F.lit(STRIDE - 1)), lambda k: F.slice("w", k + 1, F.size("phrase")) == F.col("phrase"))
    pairs = pairs.withColumn("starts", F.when(F.col("base"), starts)).withColumn("hit", F.when(F.col("base"), F.size("starts") > 0).otherwise(F.col("label").isNotNull()))
    found = pairs.groupBy("row", "doc_id", "n_words").agg(
        F.sum(F.when(F.col("hit") & F.col("base"), F.size("starts")).otherwise(0)).alias("n_base"),
        F.min(F.when(F.col("hit"), F.col("at") + F.array_min("starts"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("hit"), F.col("at") + F.array_max("starts"))).cast("long").alias("last_word"),
        F.collect_set(F.when(F.col("hit") & F.col("base"), F.col("label"))).alias("base_set"),
        F.collect_set(F.when(F.col("hit"), F.col("label"))).alias("label_set"),
        F.max(F.when(F.col("hit"), F.size(F.array_intersect("t_words", "w")) / F.size("t_words")).otherwise(0.0)).alias("score"),
    )
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", joined("base_set").alias("base_labels"), joined("label_set").alias("labels"), "score")


def license_sql(templates=TEMPLATES) -> str:
    """The same over DuckDB's table documents, every block against every template."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ", ".join(f"({s}, '{t.label}', {str(t.base).lower()}, {quoted(sorted(set(t.words)))}, {t.need}, {quoted(t.words)})" for t, s in zip(templates, strides(templates), strict=True))
    return rf"""
        WITH t(stride, label, base, toks, need, phrase) AS (VALUES {rows}),
        d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS words FROM documents),
        s AS (SELECT DISTINCT stride FROM t),
        b AS (SELECT rid, stride, pos, words[pos + 1 : pos + 2 * stride] AS w FROM (SELECT rid, stride, words, unnest(range(0, len(words), stride)) AS pos FROM d, s)),
        m AS (SELECT rid, pos, label, base, len(list_filter(toks, lambda x: list_contains(w, x))) AS k, len(toks) AS size,
                CASE WHEN base THEN list_filter(range(0, {STRIDE}), lambda k: w[k + 1 : k + len(phrase)] = phrase) END AS starts
              FROM b JOIN t USING (stride) WHERE len(list_filter(toks, lambda x: list_contains(w, x))) >= need),
        h AS (SELECT * FROM m WHERE NOT base OR len(starts) > 0),
        g AS (SELECT rid, sum(CASE WHEN base THEN len(starts) ELSE 0 END) AS n_base, min(pos + list_min(starts)) AS first_word, max(pos + list_max(starts)) AS last_word,
                string_agg(DISTINCT CASE WHEN base THEN label END, ',' ORDER BY CASE WHEN base THEN label END) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
                max(k / size) AS score FROM h GROUP BY rid)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
          coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
        FROM d LEFT JOIN g USING (rid)"""
