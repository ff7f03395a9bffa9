"""License scans by diagonal voting: word k-gram hashes of texts meet template positions in a Spark join and vote for the offset between the two."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import ascii_lower, text_of

#: Phrases whose every place counts, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Well-known licences, whole where they are short, and notices, as templates of the method, with their labels.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT
OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."""
UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone
to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you
must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be
plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
#: Whole texts, and short notices that say the same.
TEXTS = [
    ("mit", MIT), ("bsd", BSD), ("isc", ISC), ("apache", APACHE), ("gpl", GPL), ("unlicense", UNLICENSE), ("zlib", ZLIB), ("mpl", MPL),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"), ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"), ("mit", "Released under the MIT License"), ("mit", MIT[: MIT.index(", and to permit")]),
    ("apache", "Licensed under the Apache License, Version 2.0"), ("gpl", "This work is licensed under the GNU General Public License version 3"), ("bsd", BSD[: BSD.index(": 1.")]), ("isc", ISC[: ISC.index(", provided")]),
    ("gpl", GPL[: GPL.index(", either version")]),
]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEMPLATES = [(label, " ".join(WORD.findall(text.lower()))) for label, text in TEXTS]
GRAM, PHRASE_GRAM = 3, 2
#: Diagonals at most so far apart vote together: so many words may be added or missing between two matches.
NEIGHBOURS = 3
#: A span counts if it covers this share of its template's words and of its own words.
MIN_COVER, MIN_DENSITY = 0.6, 0.6
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NOTHING = -1  # template number of the row that every document keeps


def _hashes(words: Column) -> Column:
    """Each word's two 64-bit hashes, taken once; grams combine those of neighbours."""
    return F.transform(words, lambda w: F.struct(F.xxhash64(w).alias("x"), F.xxhash64(F.lit(1), w).alias("y")))


def _grams(hashes: str, k: int) -> Column:
    """Every k-gram of hashed words: position and a 128-bit hash, so that grams which meet are equal beyond doubt."""

    def one(i: Column) -> Column:
        near = [F.get(F.col(hashes), i + n) for n in range(k)]
        return F.struct(i.alias("pos"), F.xxhash64(F.lit(k), *(w["x"] for w in near)).alias("h"), F.xxhash64(F.lit(k), *(w["y"] for w in near)).alias("g"))

    return F.when(F.size(hashes) >= k, F.transform(F.sequence(F.lit(0), F.size(hashes) - k), one)).otherwise(F.array())


def template_positions(spark: SparkSession, phrases: dict[str, str], templates: list[tuple[str, str]]) -> DataFrame:
    """Grams of all templates with their places; as many rows as the templates, a parameter, have words."""
    rows = [(n, text.split(" "), PHRASE_GRAM) for n, text in enumerate(phrases)] + [(len(phrases) + n, text.split(" "), GRAM) for n, (_, text) in enumerate(templates)]
    words = spark.createDataFrame(rows, "template int, words array<string>, k int")
    grams = F.when(F.col("k") == GRAM, _grams("hashes", GRAM)).otherwise(_grams("hashes", PHRASE_GRAM))
    placed = words.withColumn("hashes", _hashes(F.col("words"))).select("template", F.inline(grams)).withColumnRenamed("pos", "at")
    nothing = spark.createDataFrame([(_NOTHING, 0, 0, 0)], "template int, at int, h long, g long")
    return placed.unionByName(nothing)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score and the verified `spans`.

    A null text is empty. Rows repeated with the same id and text come out as often as they stand. Extra columns are not read. A null id is kept.

    All rolling grams of all texts are joined with the template positions (broadcast: their number is that of the template words). A match
    votes for its diagonal, the text position less the template position. Of a phrase, the diagonals with every gram are its places. Of a
    template, diagonals at most NEIGHBOURS apart are merged and their span is verified by the share of the template that it covers and by
    how much of the span matches. Only matches are shuffled; one document's matches are summed up by template and diagonal before it.
    """
    spark = docs.sparkSession
    label = {n: x for n, x in enumerate([*phrases.values(), *(x for x, _ in templates)])}
    length = {n: len(x.split(" ")) for n, x in enumerate([*phrases, *(t for _, t in templates)])}
    labels_of = F.create_map(*(F.lit(x) for pair in label.items() for x in pair))
    length_of = F.create_map(*(F.lit(x) for pair in length.items() for x in pair))

    words = F.filter(F.split(ascii_lower(F.col("_text")), GAP), lambda w: w != "")
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).select("_id", F.xxhash64("_text").alias("_sum"), _hashes(words).alias("_words"))
    nothing = F.array(F.struct(F.lit(0).alias("pos"), F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("g")))
    known = template_positions(spark, phrases, templates)
    wanted = sorted(r[0] for r in known.select("h").distinct().collect())  # as many as the templates have words
    met = F.expr(f"filter(_grams, x -> x.h IN ({','.join(f'{h}L' for h in wanted)}))")
    listed = rows.select("_id", "_sum", F.size("_words").alias("_n"), F.concat(_grams("_words", PHRASE_GRAM), _grams("_words", GRAM)).alias("_grams"))
    grams = listed.select("_id", "_sum", "_n", F.inline(F.concat(nothing, met)))
    hits = grams.join(F.broadcast(known), ["h", "g"])
    votes = hits.groupBy("_id", "_sum", "_n", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("at"), F.count("*").alias("_rows"))

    doc = ["_id", "_sum", "_n"]
    kept = votes.withColumn("_length", F.coalesce(labels_or(length_of, "template"), F.lit(0)))
    near = Window.partitionBy(*doc, "template").orderBy("diagonal")
    merged = kept.withColumn("_new", F.when(F.col("diagonal") - F.lag("diagonal").over(near) <= NEIGHBOURS, 0).otherwise(1)).withColumn("_group", F.sum("_new").over(near))
    # A phrase's diagonals stay apart: each is a place.
    merged = merged.withColumn("_group", F.when(F.col("template") < len(phrases), F.col("diagonal")).otherwise(F.col("_group")))
    spans = merged.groupBy(*doc, "template", "_group").agg(
        F.min(F.col("diagonal") + F.array_min("at")).alias("start"), F.max(F.col("diagonal") + F.array_max("at")).alias("last"),
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), F.first("_length").alias("_length"), F.sum("_rows").alias("_rows"),
    )
    gram = F.when(F.col("template") < len(phrases), PHRASE_GRAM).otherwise(GRAM)
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + gram - 1)))))
    spans = spans.withColumn("_covered", covered).withColumn("cover", F.col("_covered") / F.greatest("_length", F.lit(1))).withColumn("_end", F.col("last") + gram)
    base = (F.col("template") >= 0) & (F.col("template") < len(phrases)) & (F.col("_covered") == F.col("_length"))
    found = (F.col("template") >= len(phrases)) & (F.col("cover") >= MIN_COVER) & (F.col("_covered") >= MIN_DENSITY * (F.col("_end") - F.col("start")))
    name = labels_or(labels_of, "template")
    out = spans.groupBy(*doc).agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, name))), ",").alias("base_labels"), F.array_join(F.array_sort(F.collect_set(F.when(base | found, name))), ",").alias("labels"),
        F.coalesce(F.max(F.when(base | found, F.least(F.col("cover"), F.lit(1.0)))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(found, F.struct("start", F.col("_end").alias("end"), name.alias("label"), "cover")))).alias("spans"),
        F.max(F.when(F.col("template") == _NOTHING, F.col("_rows"))).alias("_times"),
    )
    return out.select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))), "*").select(
        F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"
    )


def labels_or(mapping: Column, key: str) -> Column:
    """A value of a literal map, null for a key that it lacks."""
    return F.try_element_at(mapping, F.col(key))
