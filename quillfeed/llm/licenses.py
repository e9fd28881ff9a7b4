"""Licence scan by a positional rare-token index (operator 3), DataFrame functions only.

The licence templates are indexed by word and position. One pass over all
documents counts in how many documents each word of a mandatory key phrase
occurs; a template's postings are the ``RARE`` places of its key phrase with the
rarest words (its highest-IDF words). A second pass looks up which of these words
a file holds. Templates that lack one of theirs are out; for the others every
place of a rare word gives, by relative position, the start at which the template
would have to stand. The starts of a template's postings are intersected, and
where the key phrase really stands, word by word, is a match; the share of the
whole template's words that agree in place is the match's score.

Every occurrence of a key phrase holds all its rare words, each at its distance
from the start, so no place is lost. A text is gone through once, whatever the number of
templates; words that are frequent in the corpus are looked up only in files that
hold the template's rarer ones.
There is no shuffle of texts: the first pass shuffles one count per template
word and task, and both passes are plain projections. The word counts collected
to the driver are bounded by the templates' vocabulary (key phrases only).

Defined results: null text is empty (no words, no labels, score 0); a null
doc_id passes through; repeated rows give repeated results; extra columns are
ignored; empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Lower-case words of a licence text; ``key`` is the part that must stand
    there word by word. ``base`` templates give the base columns."""

    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        k, w = self.key_words, self.words
        return next(i for i in range(len(w)) if w[i:i + len(k)] == k)


# The base phrases and labels are fixed values of the task.
BASE_TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
)

# Opening or telling sentences of common licences.
METHOD_TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
             " associated documentation files", "permission is hereby granted free of charge"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except"
             " in compliance with the license", "not use this file except in compliance with the license"),
    Template("gpl-3", "gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license", "gnu affero general public license"),
    Template("mpl-2", "mozilla public license version 2 0", "mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"
             " provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without"
             " fee is hereby granted", "and or distribute this software for any purpose"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
    Template("cc-by-sa", "cc by sa", "cc by sa"),
    Template("cc-by-nc", "creative commons attribution noncommercial", "commons attribution noncommercial"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
    # Whole opening paragraphs and notices.
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
             " associated documentation files the software to deal in the software without restriction including"
             " without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"
             " of the software and to permit persons to whom the software is furnished to do so subject to the"
             " following conditions", "to deal in the software without restriction"),
    Template("mit", "the software is provided as is without warranty of any kind express or implied including but not"
             " limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no"
             " event shall the authors or copyright holders be liable for any claim damages or other liability",
             "in no event shall the authors or copyright holders be liable"),
    Template("apache-2", "unless required by applicable law or agreed to in writing software distributed under the"
             " license is distributed on an as is basis without warranties or conditions of any kind either express or"
             " implied", "agreed to in writing software distributed under the license"),
    Template("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
             " general public license as published by the free software foundation either version 3 of the license or"
             " at your option any later version",
             "gnu general public license as published by the free software foundation either version 3"),
    Template("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
             " general public license as published by the free software foundation either version 2 of the license or"
             " at your option any later version",
             "gnu general public license as published by the free software foundation either version 2"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the"
             " mpl was not distributed with this file you can obtain one at",
             "this source code form is subject to the terms"),
    Template("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse"
             " or promote products derived from this software without specific prior written permission",
             "endorse or promote products derived from this software"),
    Template("isc", "the software is provided as is and the author disclaims all warranties with regard to this software"
             " including all implied warranties of merchantability and fitness",
             "author disclaims all warranties with regard to this software"),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the"
             " authors be held liable for any damages arising from the use of this software",
             "in no event will the authors be held liable"),
    Template("bsl-1", "boost software license version 1 0", "boost software license"),
    Template("epl-2", "eclipse public license v 2 0", "eclipse public license"),
    Template("ofl", "this font software is licensed under the sil open font license version 1 1",
             "sil open font license"),
    Template("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in"
             " source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
             "free to copy modify publish use compile sell or distribute"),
    Template("cc0", "has waived all copyright and related or neighboring rights to this work",
             "waived all copyright and related or neighboring rights"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
             "creative commons attribution 4 0"),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international"
             " license", "creative commons attribution sharealike"),
    Template("cc-by-nd", "creative commons attribution noderivatives", "creative commons attribution noderivatives"),
    Template("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu"
             " free documentation license", "gnu free documentation license"),
    Template("postgresql", "permission to use copy modify and distribute this software and its documentation for any"
             " purpose without fee and without a written agreement is hereby granted",
             "without fee and without a written agreement"),
    Template("artistic-2", "artistic license 2 0", "artistic license 2 0"),
)

TEMPLATES = BASE_TEMPLATES + METHOD_TEMPLATES
MIN_SCORE = 0.5
RARE = 3  # postings of a template
_SHIFT, _BACK = 1 << 40, 1 << 20  # a template's number and start in one long


def words_of(text: Column) -> Column:
    """Lower-cased words (runs of digits, letters and everything beyond ASCII).

    Spark's ``lower`` also changes letters beyond ASCII; only two of those would
    turn into ASCII letters (the Kelvin sign and the dotted capital I), so they
    are replaced by another letter first, which keeps every other word unequal
    to any licence word."""
    safe = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("é")),
                     F.lit("İ"), F.lit("é"))
    parts = F.split(F.lower(safe), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def document_frequencies(words: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """In how many rows of ``words`` (column ``words``) each template word occurs."""
    vocabulary = sorted({w for t in templates for w in t.key_words})
    found = words.select(F.explode(F.array_intersect("words", _strings(vocabulary))).alias("word"))
    return {r.word: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def postings(templates, frequency: dict[str, int], rare: int = RARE) -> list[list[tuple[str, int]]]:
    """Per template its rarest key words, each with its place in the template,
    the rarest first (fewer than ``rare`` for a shorter key phrase)."""
    out = []
    for t in templates:
        k = t.key_words
        places = sorted(range(len(k)), key=lambda i: (frequency.get(k[i], 0), i))[:rare]
        out.append([(k[at], t.key_at + at) for at in places])
    return out


def _or_empty(condition: Column, value: Column, kind: str) -> Column:
    return F.when(condition, value).otherwise(F.array().cast(kind))


def scan_documents(docs: DataFrame, templates=TEMPLATES, min_score: float = MIN_SCORE, rare: int = RARE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, ``matches`` (template
    label, base flag, start word, score of every verified place) and ``labels``.

    Each step is a column of its own that the next one names twice or more, so
    that the optimizer doesn't move it into a loop over words."""
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    index = postings(templates, document_frequencies(words, templates), rare)
    vocabulary = sorted({word for of in index for word, _ in of})
    w = F.col("words")

    # Rank 0 to rare - 1 of every template; a short key phrase repeats its last.
    posted = F.array(*[
        F.struct(_strings(word for word, _ in of).alias("rare"), F.array(*[
            F.struct(F.lit(word).alias("word"), F.lit(k).alias("k"), F.lit(n * _SHIFT + _BACK - at).alias("code"))
            for k, (word, at) in enumerate(of + of[-1:] * (rare - len(of)))]).alias("postings"))
        for n, of in enumerate(index)])
    full = F.array(*[
        F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(t.key_at).alias("key_at"),
                 _strings(t.key_words).alias("key"), _strings(t.words).alias("words")) for t in templates])

    held = F.col("held")
    looked_up = words.withColumn("held", F.array_intersect(w, _strings(vocabulary)))
    alive = F.filter(posted, lambda t: F.forall(t["rare"], lambda x: F.array_contains(held, x)))
    looked_up = looked_up.withColumn("postings", _or_empty(
        F.size(held) > 0, F.flatten(F.transform(alive, lambda t: t["postings"])), "array<struct<word:string,k:int,code:bigint>>"))
    looked_up = looked_up.withColumn("wanted", F.array_distinct(F.transform("postings", lambda p: p["word"])))

    places = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.array_contains("wanted", F.get(w, i)))

    def starts(i):
        mine = F.filter("postings", lambda p: p["word"] == F.get(w, i))
        return F.transform(mine, lambda p: F.struct(p["k"].alias("k"), (p["code"] + i).alias("code")))

    looked_up = looked_up.withColumn("starts", _or_empty(
        F.size("wanted") > 0, F.flatten(F.transform(places, starts)), "array<struct<k:int,code:bigint>>"))

    def of_rank(k: int) -> Column:
        return F.transform(F.filter("starts", lambda s: s["k"] == k), lambda s: s["code"])

    common = of_rank(0)
    for k in range(1, rare):
        common = F.array_intersect(common, of_rank(k))

    def candidate(code):
        number = F.shiftright(code, 40).cast("int")
        return F.struct((F.pmod(code, F.lit(_SHIFT)) - _BACK).cast("int").alias("start"), F.get(full, number).alias("t"))

    def verified(c):
        at = c["start"] + c["t"]["key_at"]
        return (at >= 0) & (F.slice(w, F.greatest(at, F.lit(0)) + 1, F.size(c["t"]["key"])) == c["t"]["key"])

    def match(c):
        agree = F.size(F.filter(
            F.sequence(F.lit(0), F.size(c["t"]["words"]) - 1),
            lambda j: (c["start"] + j >= 0) & (F.get(w, F.greatest(c["start"] + j, F.lit(0))) == F.get(c["t"]["words"], j))))
        return F.struct(c["t"]["label"].alias("label"), c["t"]["base"].alias("base"), c["start"].cast("long").alias("start"),
                        (agree / F.size(c["t"]["words"])).alias("score"))

    found = F.transform(F.filter(F.transform(common, candidate), verified), match)
    found = F.filter(found, lambda m: m["base"] | (m["score"] >= min_score))
    matches = _or_empty(F.size("starts") > 0, found, "array<struct<label:string,base:boolean,start:bigint,score:double>>")
    return looked_up.select(
        "doc_id", F.size(w).cast("long").alias("n_words"), matches.alias("matches")
    ).withColumn("labels", F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["label"]))))
