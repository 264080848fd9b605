"""Diagonal voting: word k-grams of texts are joined to places in license templates, and hits are counted by diagonal.

A hit at word p of a text and word q of a template votes for the diagonal p - q. Words put in or left out move what follows to
a neighbouring diagonal, so diagonals close to each other are merged into one span, which is then verified: its k-grams
are the template's own words, they must cover enough of the template, and enough of the span's words must be hits.

Built-in functions only. The table of template k-grams has a fixed size and is broadcast; the words of a text are spread
and joined where they are read, so only hits are shuffled, by text, template and diagonal.

Cases: a null or empty text has no words, no labels and score 0. Rows of one doc_id and text get equal results, each row
its own. Texts are read whole, whatever their length. Ties between templates do not matter: all verified labels are
returned. Extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word of a lower-cased text. Capitals count too, so that templates and texts are cut alike.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed phrases that are a finding by themselves, with their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Public license notices, as (label, text).
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("mit", "Released under the MIT License."),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any
        later version."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]

GRAM_WORDS = 4
#: Diagonals at most so far apart are one span.
DIAGONAL_GAP = 4
#: Of a hundred words of the template, and of the span, so many must be covered by hits.
MIN_PERCENT = 80


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def template_grams(templates: list[tuple[str, str]] = TEMPLATES) -> list[tuple[int, str, int, int, list[str]]]:
    """(template, label, its words, place, k-gram) of all templates; a template needs k words at least."""
    out = []
    for number, (label, text) in enumerate(templates):
        own = template_words(text)
        if len(own) < GRAM_WORDS:
            raise ValueError(f"template {number} has fewer than {GRAM_WORDS} words")
        out += [(number, label, len(own), at, own[at : at + GRAM_WORDS]) for at in range(len(own) - GRAM_WORDS + 1)]
    return out


def _words(text: Column) -> Column:
    """The words of a text, lower-cased, in its own row."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _places(words: Column, joined: Column, phrase: str) -> Column:
    """Where the phrase's words stand consecutively; places are only looked for in texts that hold the phrase."""
    own = phrase.split(" ")
    here = lambda i: functools.reduce(Column.__and__, [F.get(words, i + k) == w for k, w in enumerate(own)])
    found = F.filter(F.sequence(F.lit(0), F.size(words) - len(own)), here)
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))


def _base(documents: DataFrame, phrases: Mapping[str, str]) -> DataFrame:
    """Words, and places of the phrases, by the row's own text."""
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_key"), _words(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "text_key", "words", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("joined"))
    places = F.array(*[_places(F.col("words"), F.col("joined"), p) for p in phrases])
    rows = rows.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), places.alias("places"))
    labels = [F.when(F.size(F.get("places", F.lit(k))) > 0, F.lit(label)) for k, label in enumerate(phrases.values())]
    every = F.flatten("places")
    return rows.select(
        "doc_id",
        "text_key",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base_found"),
    )


def grams_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per k-gram of a template, with its hash."""
    rows = spark.createDataFrame(template_grams(templates), "template int, label string, template_words int, at int, gram array<string>")
    return rows.select("template", "label", "template_words", "at", F.array_join("gram", " ").alias("gram"), F.xxhash64(*[F.get("gram", F.lit(k)) for k in range(GRAM_WORDS)]).alias("h"))


def template_spans(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Verified spans: doc_id, text_key, label, template, start, end (words, end exclusive), share of the template covered."""
    grams = grams_table(documents.sparkSession, templates)
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_key"), _words(F.col("text")).alias("words"))
    rows = rows.where(F.size("words") >= GRAM_WORDS)
    rows = rows.select("doc_id", "text_key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - GRAM_WORDS)).alias("p"))
    at = [F.get("words", F.col("p") + k) for k in range(GRAM_WORDS)]
    rows = rows.select("doc_id", "text_key", "words", "p", F.xxhash64(*at).alias("h"))
    hits = rows.join(F.broadcast(grams), "h").where(F.concat_ws(" ", *at) == F.col("gram"))  # the templates have a fixed size
    diagonal = (F.col("p") - F.col("at")).alias("diagonal")
    votes = hits.groupBy("doc_id", "text_key", "template", "label", "template_words", diagonal).agg(
        F.min("p").alias("start"), F.max("p").alias("last"), F.collect_set("at").alias("covers")  # bounded by the template's words
    )
    line = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(line) > DIAGONAL_GAP
    votes = votes.withColumn("span", F.count(F.when(apart, 1)).over(line))
    spans = votes.groupBy("doc_id", "text_key", "template", "label", "template_words", "span").agg(
        F.min("start").alias("start"), (F.max("last") + GRAM_WORDS).alias("end"), F.array_distinct(F.flatten(F.collect_set("covers"))).alias("covers")
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("covers", lambda a: F.sequence(a, a + (GRAM_WORDS - 1))))))
    spans = spans.withColumn("covered", covered).withColumn("share", F.col("covered") / F.col("template_words"))
    longer = F.greatest(F.col("template_words"), F.col("end") - F.col("start"))
    verified = 100 * F.col("covered") >= MIN_PERCENT * longer
    return spans.where(verified).select("doc_id", "text_key", "label", "template", "start", "end", "share")


def license_labels(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """One row per document: places of the base phrases, base labels, all labels, and a score.

    The score is 1 with a base phrase, else the largest share of a template that a verified span covers, else 0.
    """
    found = template_spans(documents, templates).groupBy("doc_id", "text_key").agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))
    found = found.select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key"), "found", "share")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))
    rows = _base(documents, phrases).join(found, same, "left")
    listed = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    every = F.concat("base_found", F.coalesce("found", F.array().cast("array<string>")))
    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        listed(F.col("base_found")).alias("base_labels"),
        listed(every).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
