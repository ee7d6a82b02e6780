"""License scan by diagonal voting (operator 3).

All rolling hashes of ``GRAM`` words of a text are joined with the places of the same hash
in license templates. A match of word p of the text with word j of a template votes for the
diagonal p - j. A phrase stands complete where its diagonal has a vote of every gram. For
the longer notices, neighbouring diagonals are merged (words put in or left out shift the
rest), and a merged span counts if it covers enough of the template without being much
longer than it. Names of licenses differ by single words, so a name must be covered in full.
The score is the largest cover of a notice, found or not (1 with a phrase); labels of equal
cover all stand.

Nulls and edge cases: a null or empty text has no words, no labels and score 0; a repeated
or null id is one row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.llm.common import long_list, map_arrow, stored, text_slices
from martwright.llm.words import grams, words

GRAM = 3
SHIFT_MOST = 6       # diagonals nearer than this are merged
COVER_LEAST = 0.6    # share of a notice's grams that a span must have (of a name's: all)
STRETCH_MOST = 1.5   # times a notice's length that a span may take

# Fixed values of the contract: phrases and labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices of public licenses as they are usually given, and the labels this scan
# gives them. Those of up to NAME_WORDS words are names, which must stand there completely.
NAME_WORDS = 20
NOTICES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the Software), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software": "mit",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the Software), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, "
    "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
    "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
    "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE.": "mit",
    "you may not use this file except in compliance with the License. You may obtain a copy of "
    "the License at http://www.apache.org/licenses/LICENSE-2.0": "apache-2",
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met": "bsd",
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.": "bsd",
    "Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission.": "bsd-3-clause",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this permission "
    "notice appear in all copies.": "isc",
    "This software is provided as-is, without any express or implied warranty. In no event will "
    "the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely": "zlib",
    "This is free and unencumbered software released into the public domain. Anyone is free to "
    "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
    "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
    "any means.": "unlicense",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
    "copy of the MPL was not distributed with this file, You can obtain one at "
    "https://mozilla.org/MPL/2.0/.": "mpl-2",
    "GNU General Public License, version 2": "gpl-2",
    "GNU General Public License, version 3": "gpl-3",
    "GNU General Public License as published by the Free Software Foundation, either version 2 "
    "of the License": "gpl-2",
    "GNU General Public License as published by the Free Software Foundation, either version 3 "
    "of the License": "gpl-3",
    "GNU Lesser General Public License": "lgpl",
    "GNU Affero General Public License": "agpl",
    "Creative Commons Attribution 4.0 International": "cc-by",
    "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa",
    "Creative Commons Attribution-NoDerivatives 4.0 International": "cc-by-nd",
    "Creative Commons Attribution-NonCommercial 4.0 International": "cc-by-nc",
    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International": "cc-by-nc-sa",
    "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International": "cc-by-nc-nd",
}
_MARK = -1  # stands before every text, and matches the template of that name


def _template_words(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.encode(), np.uint8)
    spans, h = words(raw, np.array([0, len(raw)]))
    return h, spans.rows


def templates(spark: SparkSession, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(gram places, templates); both of fixed size."""
    places, heads = [(0, _MARK, 0)], [(_MARK, "", 1, 1, False, 1.0)]
    for t, (text, label, base) in enumerate([(k, v, True) for k, v in PHRASES.items()]
                                            + [(k, v, False) for k, v in NOTICES.items()]):
        h, rows = _template_words(text)
        g = grams(h, rows, gram)[0].view(np.int64)
        places += [(int(x), t, j) for j, x in enumerate(g)]
        heads.append((t, label, len(g), len(h), base, 1.0 if len(h) <= NAME_WORDS else COVER_LEAST))
    return (spark.createDataFrame(places, "g bigint, t int, j int"),
            spark.createDataFrame(heads, "t int, label string, n_grams int, n_template int, base boolean, least double"))


def text_grams(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """(row, doc_id, n_words, grams): all rolling hashes, after the mark."""

    def task(batches):
        for batch in batches:
            for row, end, data, offsets in text_slices(batch):
                spans, h = words(data, offsets)
                g, _, cuts = grams(h, spans.rows, gram)
                g[g == 0] = 1  # 0 is the mark
                part = batch.slice(row, end - row)
                yield pa.record_batch([
                    part.column("row"), part.column("doc_id"), pa.array(np.diff(spans.rows)),
                    long_list(np.insert(g, cuts[:-1], 0), cuts + np.arange(len(cuts)))],
                    names=["row", "doc_id", "n_words", "grams"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, task, "row bigint, doc_id bigint, n_words bigint, grams array<bigint>")


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    places, heads = templates(spark)
    # the mark is element 0 of the grams: word p is element p + 1
    each = text_grams(docs).select("row", "doc_id", "n_words",
                                   F.posexplode("grams").alias("p", "g"))
    votes = (each.join(F.broadcast(places), "g")  # of fixed size, under a thousand rows
             .select("row", "doc_id", "n_words", "t", "j", (F.col("p") - 1).alias("p"))
             .repartition("row"))
    diagonals = (votes.groupBy("row", "doc_id", "n_words", "t", (F.col("p") - F.col("j")).alias("d"))
                 .agg(F.collect_set("j").alias("js"), F.min("p").alias("lo"), F.max("p").alias("hi")))
    along = Window.partitionBy("row", "t").orderBy("d")
    islands = (diagonals.join(F.broadcast(heads), "t")
               .withColumn("new", F.when(F.col("d") - F.lag("d").over(along) <= SHIFT_MOST, 0).otherwise(1))
               .withColumn("island", F.sum("new").over(along)))
    islands = stored(islands.drop("new"), "license-islands")
    whole = F.col("base") & (F.size("js") == F.col("n_grams"))
    limit = F.col("n_template") * STRETCH_MOST
    spans = (islands.groupBy("row", "doc_id", "n_words", "t", "island", "label", "base", "n_grams",
                             "n_template", "least")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("js")))).alias("covered"),
                  (F.max("hi") - F.min("lo") + GRAM).alias("length"),
                  F.sum(whole.cast("long")).alias("places"),
                  F.min(F.when(whole, F.col("d"))).alias("first"),
                  F.max(F.when(whole, F.col("d"))).alias("last"))
             .withColumn("notice", ~F.col("base") & (F.col("t") != _MARK)))
    # an island longer than a notice may be: its best stretch of that length counts
    key = ["row", "t", "island"]
    long = spans.where(F.col("notice") & (F.col("length") > limit)
                       & (F.col("covered") >= F.col("least") * F.col("n_grams"))).select(*key)
    # as far ahead as the longest notice allows; each island's own limit is in ``near``
    most = int(STRETCH_MOST * heads.agg(F.max("n_template")).first()[0])
    ahead = Window.partitionBy(*key).orderBy(F.col("lo").cast("long")).rangeBetween(0, most)
    near = F.filter("near", lambda x: x["hi"] + GRAM - F.col("lo") <= limit)
    best = (islands.join(long, key, "left_semi")
            .withColumn("near", F.collect_list(F.struct("hi", "js")).over(ahead))
            .groupBy(*key).agg(F.max(F.size(F.array_distinct(F.flatten(F.transform(near, lambda x: x["js"])))))
                               .alias("stretch")))
    spans = spans.join(best, key, "left").withColumn("cover", F.when(
        F.col("notice"), F.when(F.col("length") <= limit, F.col("covered")).otherwise(F.coalesce("stretch", F.lit(0)))
        / F.col("n_grams")).otherwise(F.lit(0.0)))
    based = F.when(F.col("places") > 0, F.col("label"))
    noticed = F.when(F.col("cover") >= F.col("least"), F.col("label"))

    def joined(names):
        return F.concat_ws(",", F.array_sort(F.array_distinct(names)))

    return (spans.groupBy("row", "doc_id", "n_words")
            .agg(F.sum("places").alias("n_base"), F.min("first").cast("long").alias("first_word"),
                 F.max("last").cast("long").alias("last_word"),
                 joined(F.collect_set(based)).alias("base_labels"),
                 joined(F.collect_set(F.coalesce(based, noticed))).alias("labels"),
                 F.greatest(F.max("cover"), F.max(F.when(F.col("places") > 0, 1.0).otherwise(0.0)))
                 .alias("score")))


def run(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return scan(spark, docs).select("doc_id", "n_words", "n_base", "first_word", "last_word",
                                    "base_labels", "labels", "score")
