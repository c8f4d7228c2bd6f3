r"""License scan by diagonal voting, in DataFrame operations only.

Every rolling window of GRAM words of every document is hashed and joined to the places in TEMPLATES that have the
same window. A match at document word p and template word q votes for the diagonal p - q. Diagonals of a template
that lie within GAP of each other, where a word was put in or left out, are merged to a run. A run is verified word
by word: of its windows those count that go on in the template as they do in the text. It covers the share of the
template's windows that count, which must be COVERED or more; and the template's words that no window has, with the
words of the span that are put in between, may be at most the rest, 1 - COVERED, of the template's words. The
templates are fixed in number and length, so their table may be broadcast; the matches are grouped by document, so a
notice that a third of all documents carry is no hot key.

Besides, PHRASES are found wherever their words stand one after another: these make the base columns.

Null text counts as empty: no words, no labels, score 0. Repeated rows get equal results. An empty table gives an
empty one; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floeframe.llm.common import ids_and_text
from floeframe.llm.personal import row_key

GRAM, GAP, COVERED = 3, 2, 0.6
#: What separates words once A-Z are lower case.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: phrase: label
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Public notices and short mentions, as their words (fixed values). Paragraphs stand by themselves, so that a notice
#: of which only one is left is found. Mentions hold little besides the license's name: what all licenses say must not
#: reach COVERED alone, nor may another license's notice.
TEMPLATES = (
    ("agpl-3.0", "the gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "of the apache license"),
    (
        "apache-2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed"
        " on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    (
        "bsd",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
        " disclaimer in the documentation and or other materials provided with the distribution",
    ),
    (
        "bsd",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties"
        " including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    ),
    ("bsd", "of the bsd license"),
    (
        "bsd-3-clause",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
    ),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd-4.0", "creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international license"),
    ("cc0-1.0", "cc0 1 0 universal public domain dedication"),
    (
        "cc0-1.0",
        "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work",
    ),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    (
        "gpl-3.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
        " license as published by the free software foundation",
    ),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (
        "isc",
        "the software is provided as is and the author disclaims all warranties with regard to this software including all"
        " implied warranties of merchantability and fitness",
    ),
    ("isc", "of the isc license"),
    ("lgpl", "the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "of the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    (
        "mit",
        "to deal in the software without restriction including without limitation the rights to use copy modify merge"
        " publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is"
        " furnished to do so",
    ),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    (
        "mit",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the"
        " warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    (
        "unlicense",
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or"
        " as a compiled binary for any purpose commercial or non commercial and by any means",
    ),
)


def words(text: Column) -> Column:
    """Lower case changes letters beyond A-Z too, none of them into or out of a separator or a letter of a phrase."""
    return F.array_remove(F.split(F.lower(text), SEPARATOR), "")


def template_grams(spark: SparkSession) -> DataFrame:
    """(gram, template, label, at, grams): every window of every template; a few hundred rows, fixed."""
    rows = [(i, label, text.split(" ")) for i, (label, text) in enumerate(TEMPLATES)]
    each = spark.createDataFrame(rows, "template int, label string, words array<string>").select("template", "label", "words", F.explode(F.sequence(F.lit(0), F.size("words") - GRAM)).alias("at"))
    return each.select(F.xxhash64(*(F.get("words", F.col("at") + k) for k in range(GRAM))).alias("gram"), "template", "label", "at", (F.size("words") - GRAM + 1).alias("grams"))


def matches(rows: DataFrame) -> DataFrame:
    """(row, template, label, grams, at, place) of every window of rows (row, words) that a template has."""
    hashed = rows.select("row", F.transform("words", lambda w, i: F.xxhash64(w, *(F.get("words", i + k) for k in range(1, GRAM)))).alias("hashes"))
    grams = hashed.select("row", F.posexplode_outer("hashes").alias("place", "gram"))
    return grams.join(F.broadcast(template_grams(rows.sparkSession)), "gram").select("row", "template", "label", "grams", "at", "place")


def in_order(matched: Column) -> Column:
    """(hit, covered) of matches (place, at) in order: windows that go on in the template, and template words they have."""
    begin = F.struct(F.lit(-1).alias("at"), F.lit(0).alias("end"), F.lit(0).alias("hit"), F.lit(0).alias("covered"))

    def step(acc: Column, x: Column) -> Column:
        end = (x["at"] + GRAM).cast("int")
        new = end - F.greatest(x["at"], acc["end"])
        onward = F.struct(x["at"].alias("at"), end.alias("end"), (acc["hit"] + 1).alias("hit"), (acc["covered"] + new).alias("covered"))
        return F.when(x["at"] > acc["at"], onward).otherwise(acc)

    return F.aggregate(matched, begin, step)


def runs(found: DataFrame) -> DataFrame:
    """(row, template, label, first, last, cover) of merged diagonals that verify; the span's words are first to last."""
    diagonal = (F.col("place") - F.col("at")).alias("diagonal")
    places = F.collect_set(F.struct("place", "at")).alias("places")
    votes = found.groupBy("row", "template", "label", "grams", diagonal).agg(places)
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    split = F.when(F.col("diagonal") - F.lag("diagonal").over(order) > GAP, 1).otherwise(0)
    merged = votes.withColumn("new", split).withColumn("run", F.sum("new").over(order))
    together = merged.groupBy("row", "template", "label", "grams", "run")
    together = together.agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("places"))
    read = together.withColumn("read", in_order(F.col("places")))
    first, last = F.array_min("places")["place"], F.array_max("places")["place"] + GRAM - 1
    spans = read.select("row", "template", "label", "grams", first.alias("first"), last.alias("last"), "read.hit", "read.covered")
    words_, span = F.col("grams") + GRAM - 1, F.col("last") - F.col("first") + 1
    edits = words_ - F.col("covered") + F.greatest(span - F.col("covered"), F.lit(0))
    good = spans.withColumn("cover", F.col("hit") / F.col("grams"))
    good = good.where((F.col("cover") >= COVERED) & (edits <= (1 - COVERED) * words_ + 1e-9))
    return good.select("row", "template", "label", "first", "last", "cover")


def _phrase_columns(spaced: Column, n_words: Column) -> list[Column]:
    """Count, first start, last start and label of each phrase in text whose every word has a space on both sides."""
    made = []
    for phrase, label in PHRASES.items():
        key = "".join(f" {w} " for w in phrase.split())
        there = F.contains(spaced, F.lit(key))
        words_in = lambda s: F.floor((F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))) / 2)
        count = (F.length(spaced) - F.length(F.replace(spaced, F.lit(key), F.lit("")))) / len(key)
        made.append(
            F.struct(
                F.when(there, count).otherwise(0).cast("long").alias("n"),
                F.when(there, words_in(F.substring_index(spaced, key, 1))).cast("long").alias("first"),
                F.when(there, n_words - words_in(F.substring_index(spaced, key, -1)) - len(phrase.split())).cast("long").alias("last"),
                F.when(there, F.lit(label)).alias("label"),
            )
        )
    return made


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row of docs.

    spans: label:first:last of each verified run, its first and last word, by place, comma-joined.
    """
    keyed = ids_and_text(docs).withColumn("row", row_key())
    # explode of one array: else the optimizer puts the split in place of every later mention of its result
    split = keyed.select("row", "doc_id", F.explode(F.array(words(F.col("text")))).alias("words"))
    best = runs(matches(split.select("row", "words"))).groupBy("row").agg(
        F.collect_set("label").alias("more"),
        F.max("cover").alias("cover"),
        F.array_sort(F.collect_set(F.struct("first", "last", "label"))).alias("spans"),
    )
    one_line = F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))
    spaced = split.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), one_line.alias("spaced"))
    base = spaced.select("row", "doc_id", "n_words", F.array(*_phrase_columns(F.col("spaced"), F.col("n_words"))).alias("p"))
    joined = base.join(best, "row", "left")
    own = F.array_compact(F.col("p")["label"])
    none = F.array().cast("array<string>")
    shown = lambda s: F.concat_ws(":", s["label"], s["first"], s["last"])
    return joined.select(
        "doc_id",
        "n_words",
        F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_base"),
        F.array_min(F.col("p")["first"]).alias("first_word"),
        F.array_max(F.col("p")["last"]).alias("last_word"),
        F.array_join(F.array_sort(own), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(own, F.coalesce("more", none)))), ",").alias("labels"),
        F.when(F.size(own) > 0, F.lit(1.0)).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
        F.coalesce(F.array_join(F.transform("spans", shown), ","), F.lit("")).alias("spans"),
    )
