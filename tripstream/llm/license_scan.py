"""License scan by diagonal voting (DataFrame functions only).

Templates are license texts, from a phrase to a whole license. All rolling word
k-grams (k = 2) of every document are joined by hash to the k-grams of the
templates; a hit of the template's p-th k-gram at word i votes for the *diagonal*
i - p. Votes are added up per (document, template, diagonal). A *place* of a
template is a diagonal on which all its k-grams voted: its words stand there
consecutively. Neighbouring diagonals (at most ``GAP`` apart, so a few words put
in or left out) are merged to a *span*; a span is verified by the share of the
template's k-grams found in it and by its length in words. Hash hits are
checked against the words themselves, so equal hashes of different words
do not vote.

The template table is a fixed small list (its size is checked) and is
broadcast. A document passes through one scan, linear in its words: k-grams are made
and held against the templates' hashes inside its array of words, and only hits leave it.
These (and one row that says how many words it has) are shuffled, by document.

Edge cases: null or empty text -> no words, no labels, score 0, null first
and last word; empty table -> no rows; repeated rows are scanned one by one
(a row is known by its place in the scan); other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripstream.llm.common import lower_ascii

# Words: ASCII letters and digits, and everything beyond ASCII.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

GAP = 2                 # words put in or left out between two diagonals of a span
MIN_SHARE = 0.75        # of a template's k-grams in a verified span
MAX_STRETCH = 1.34      # a verified span's words per word of the template
MAX_GRAMS = 50_000      # k-grams of all templates together: bounds the broadcast


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    base: bool = False


# The phrases and labels of the query's contract.
BASE = [
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
]

METHOD = [
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    Template("cc-by-4.0", "licensed under cc by 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
]


# License texts and notices as their publishers word them, as words.
TEXTS = [
    Template("mit", """
permission is hereby granted free of charge to any person obtaining a copy of this software and associated
documentation files the software to deal in the software without restriction including without limitation the rights
to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom
the software is furnished to do so subject to the following conditions the above copyright notice and this permission
notice shall be included in all copies or substantial portions of the software the software is provided as is without
warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a
particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim
damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with
the software or the use or other dealings in the software"""),
    Template("bsd", """
redistribution and use in source and binary forms with or without modification are permitted provided that the
following conditions are met 1 redistributions of source code must retain the above copyright notice this list of
conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this
list of conditions and the following disclaimer in the documentation and or other materials provided with the
distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission this software is provided by the
copyright holders and contributors as is and any express or implied warranties including but not limited to the implied
warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright
holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages
including but not limited to procurement of substitute goods or services loss of use data or profits or business
interruption however caused and on any theory of liability whether in contract strict liability or tort including
negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such
damage"""),
    Template("apache-2.0", """
licensed under the apache license version 2 0 the license you may not use this file except in compliance with the
license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable
law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties
or conditions of any kind either express or implied see the license for the specific language governing permissions and
limitations under the license"""),
    Template("gpl-3.0", """
this program is free software you can redistribute it and or modify it under the terms of the gnu general public
license as published by the free software foundation either version 3 of the license or at your option any later
version this program is distributed in the hope that it will be useful but without any warranty without even the
implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more
details you should have received a copy of the gnu general public license along with this program if not see https www
gnu org licenses"""),
    Template("mpl-2.0", """
this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
distributed with this file you can obtain one at https mozilla org mpl 2 0"""),
]


def template_grams(templates: list[Template]) -> list[tuple[int, int, str, str, int]]:
    """``t, p, w0, w1, m`` (m: k-grams of template t)."""
    rows = []
    for t, x in enumerate(templates):
        words = x.words.split()
        if len(words) < 2:
            raise ValueError(f"a template has two words or more: {x.words!r}")
        rows += [(t, p, words[p], words[p + 1], len(words) - 1) for p in range(len(words) - 1)]
    if len(rows) > MAX_GRAMS:
        raise ValueError(f"the templates have more than {MAX_GRAMS} k-grams")
    return rows


def vote(documents: DataFrame, templates: list[Template], doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per vote, and one with t = -1 per document: ``row, doc_id, n_words, t, p, m, at``."""
    spark = documents.sparkSession
    grams = spark.createDataFrame(template_grams(templates) + [(-1, -1, None, None, 0)],
                                  "t int, p int, w0 string, w1 string, m int")
    grams = grams.withColumn("hash", F.when(F.col("t") >= 0, F.xxhash64("w0", "w1")).otherwise(0))
    known = sorted({r.hash for r in grams.select("hash").distinct().collect()})     # MAX_GRAMS at most
    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text), F.lit(""))), F.lit(LICENSE_WORD), F.lit(0))
    docs = (documents.select(F.monotonically_increasing_id().alias("row"),
                             F.col(doc_id).cast("long").alias("doc_id"), words.alias("w"))
            .select("row", "doc_id", F.explode(F.array("w")).alias("w")))   # computed once

    def gram(x: Column, i: Column) -> Column:
        after = F.get("w", i + 1)
        return F.struct(i.alias("at"), x.alias("v0"), after.alias("v1"), F.xxhash64(x, after).alias("hash"))

    # the hash 0 ends each document's list and keeps documents without hits
    end = F.struct(F.size("w").alias("at"), F.lit(None).cast("string").alias("v0"), F.lit(None).cast("string").alias("v1"),
                   F.lit(0).cast("long").alias("hash"))
    hits = F.concat(F.filter(F.transform("w", gram), lambda g: g["hash"].isin(known)), F.array(end))
    # the words are left behind before the hits are dealt out, so no hit copies them
    rows = docs.select("row", "doc_id", F.size("w").alias("n_words"), hits.alias("hits"))
    rows = rows.select("row", "doc_id", "n_words", F.explode("hits").alias("g")).select("row", "doc_id", "n_words", "g.*")
    same = (F.col("v0") == F.col("w0")) & (F.col("v1") == F.col("w1"))
    return (rows.join(F.broadcast(grams), "hash")
            .where(F.when(F.col("t") < 0, F.col("at") == F.col("n_words")).otherwise(same))
            .select("row", "doc_id", "n_words", "t", "p", "m", "at"))


def scan_licenses(documents: DataFrame, base: list[Template] | None = None,
                  method: list[Template] | None = None) -> DataFrame:
    """Per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score`` and ``spans`` (label, start, end, share of its k-grams)."""
    base = BASE if base is None else base
    method = METHOD + TEXTS if method is None else method
    templates = base + method
    names = F.array(*[F.lit(x.label) for x in templates])
    is_base = F.col("t").between(0, len(base) - 1)
    doc = ["row", "doc_id", "n_words"]
    # all that follows is per document: one exchange
    votes = vote(documents, templates).repartition("row")
    diagonals = votes.groupBy(*doc, "t", "m", (F.col("at") - F.col("p")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min("at").alias("start"), F.max("at").alias("end"),
        F.collect_set("p").alias("grams"))
    w = Window.partitionBy(*doc, "t", "m").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(w) > GAP, F.lit(True))
    # a place of a base phrase stands alone: its diagonals are not merged
    marked = diagonals.select("*", (apart | is_base).cast("int").alias("fresh"))
    spans = marked.select("*", F.sum("fresh").over(w).alias("span")).groupBy(*doc, "t", "m", "span").agg(
        F.min("start").alias("start"), (F.max("end") + 2).alias("end"), F.max("votes").alias("votes"),
        F.size(F.array_distinct(F.flatten(F.collect_list("grams")))).alias("n"))
    share = F.col("n") / F.col("m")
    good = F.when(F.col("t") < 0, False).when(is_base, F.col("votes") == F.col("m")).otherwise(
        (share >= MIN_SHARE) & (F.col("end") - F.col("start") <= F.ceil(MAX_STRETCH * (F.col("m") + 1))))
    spans = spans.select("*", is_base.alias("base"), good.alias("good"),
                         F.when(F.col("t") >= 0, F.get(names, F.col("t"))).alias("label"),
                         F.when(F.col("t") >= 0, share).otherwise(0.0).alias("share"))
    place = F.col("good") & F.col("base")

    def joined(labels):
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    return spans.groupBy(*doc).agg(
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(place, F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("good"), F.col("label"))).alias("labels"),
        F.max(F.when(F.col("good"), F.col("share")).otherwise(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("good"), F.struct("start", "end", "label", "share")))).alias("spans"),
    ).select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
             "base_labels", "labels", "score", "spans")
