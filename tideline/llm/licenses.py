"""License scans: a positional index of the rare words of licence phrases and texts."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm._native import let, replace_columns, words


@dataclass(frozen=True)
class Template:
    """A licence's words, or a phrase that names it. key: words of it that must stand in the file just so for a match; base: it is one of the contract's phrases."""

    label: str
    wording: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(r"[a-z0-9]+", self.wording.lower())


# Phrases and the labels they stand for, then sentences and texts by which licences are known.
TEMPLATES = (
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("agpl", "gnu affero general public license", "affero general public license"),
    Template("mpl", "mozilla public license version 2 0", "mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("bsd", "bsd license", "bsd license"),
    Template("isc", "isc license", "isc license"),
    Template("epl", "eclipse public license", "eclipse public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted free of charge"),
    Template("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("gpl", "licensed under the gnu general public license version 3", "gnu general public license version"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0"),
    Template(
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
        "hereby granted free of charge",
    ),
    Template(
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
        "with or without fee is hereby granted",
    ),
    Template(
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
        "source and binary forms",
    ),
    Template(
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
        "apache license version 2 0",
    ),
    Template(
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
        License for more details.""",
        "gnu general public license as published by",
    ),
    Template(
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely.""",
        "alter it and redistribute it freely",
    ),
    Template(
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
        "free and unencumbered software",
    ),
)
#: A template of n words is worth n / (n + MENTION): naming a licence is less than bringing its text.
MENTION = 4


@dataclass(frozen=True)
class Indexed:
    """A template in the index: its words with their IDF, its key with its place in them, and postings: the key's words of the highest IDF, rarest first, each with its place in the key."""

    label: str
    base: bool
    words: list[str]
    idf: list[float]
    key_at: int
    key: list[str]
    postings: list[tuple[str, int]]


def build_index(docs: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> list[Indexed]:
    """Positional index of the templates, with IDF of all documents.

    Gathers a count for each word of the templates, however many documents there are. A template of whose key some
    word is in no document can't match, and is left out.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    once = F.array_intersect(words(F.col(text_col)), F.array(*map(F.lit, vocabulary)))
    counts = docs.select(F.explode(F.concat(once, F.array(F.lit("")))).alias("w")).groupBy("w").count()
    seen = {r["w"]: r["count"] for r in counts.collect()}  # a row for each word of the templates, and one for all documents
    total = seen.get("", 0)
    idf = {w: math.log((total + 1) / (seen.get(w, 0) + 1)) for w in vocabulary}
    index = []
    for t in templates:
        text, key = t.words, t.key.split()
        key_at = next(i for i in range(len(text)) if text[i : i + len(key)] == key)
        if all(w in seen for w in key):
            rarest = sorted(set(key), key=lambda w: (-idf[w], w))[:2]
            index.append(Indexed(t.label, t.base, text, [idf[w] for w in text], key_at, key, [(w, key.index(w)) for w in rarest]))
    return index


def _places(w: Column, index: list[Indexed]) -> Column:
    """(label, base, start, share, worth) of every match of every template in the words w."""
    anchors = sorted({word for t in index for word, _ in t.postings})
    rare = F.array(*map(F.lit, sorted({t.postings[0][0] for t in index})))

    def of(t: Indexed, at: Column) -> Column:
        """at: the (word, i) of w that are words of postings."""

        def starts_by(word: str, place: int) -> Column:
            return F.transform(F.filter(at, lambda x: x["word"] == word), lambda x: x["i"] - place)

        starts = starts_by(*t.postings[0])
        for posting in t.postings[1:]:
            starts = F.array_intersect(starts, starts_by(*posting))
        key, text, idf, whole = F.array(*map(F.lit, t.key)), F.array(*map(F.lit, t.words)), F.array(*map(F.lit, t.idf)), sum(t.idf)
        starts = F.filter(starts, lambda s: F.when(s >= 0, F.slice(w, F.greatest(s, F.lit(0)) + 1, len(t.key)) == key).otherwise(False))

        def match(s: Column) -> Column:
            """share: what part of the template's IDF stands at the places that this start gives it."""
            if len(t.words) == len(t.key) or not whole:
                share = F.lit(1.0)
            else:
                there = F.transform(text, lambda word, j: F.when(F.get(w, s + j - t.key_at) == word, F.get(idf, j)).otherwise(0.0))
                share = F.aggregate(there, F.lit(0.0), lambda a, b: a + b) / F.lit(whole)
            worth = F.lit(len(t.words) / (len(t.words) + MENTION))
            return F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), s.alias("start"), share.alias("share"), worth.alias("worth"))

        return F.transform(starts, match)

    def body(at: Column) -> Column:
        return F.flatten(F.array(*(of(t, at) for t in index)))

    pairs = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("word"), i.alias("i"))), lambda x: x["word"].isin(anchors))
    return F.when(F.arrays_overlap(w, rare), let(pairs, body))


def scan_licenses(docs: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Returns the documents with n_words, places (label, base, start, share, worth), base_labels, labels and score.

    The two words of a template's key with the highest IDF have postings, their places in it. In a file each of their
    occurrences gives the start that the key would have; starts that both give are the intersection, and there the
    key's words must stand one after another. share is the part of the whole template's IDF that stands at its
    relative position, worth what a template of its length counts; score is the largest share * worth (0 without a
    place, rounded to six digits): near 1 for a whole licence, a third for a bare "mit license". base_labels and labels
    are sorted, distinct and comma-joined.

    A null or empty text has no words, no places (an empty array) and no labels; a very long one is one row, whose
    words must fit in a task. Repeated rows get the same results. On an empty table the index is empty. Input columns
    named as the results are replaced. The index is a few hundred words in the plan, whatever the input; nothing is
    shuffled but their counts.
    """
    index = build_index(docs, text_col, templates)
    none = F.array().cast("array<struct<label:string,base:boolean,start:int,share:double,worth:double>>")

    def body(w: Column) -> Column:
        return F.struct(F.size(w).alias("n"), F.coalesce(_places(w, index), none).alias("places") if index else none.alias("places"))

    found = docs.withColumn("__found", let(words(F.col(text_col)), body))
    places = F.col("__found.places")

    def names(x: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda p: p["label"]))), ",")

    return replace_columns(
        found,
        {
            "n_words": F.col("__found.n").cast("long"),
            "places": places,
            "base_labels": names(F.filter(places, lambda p: p["base"])),
            "labels": names(places),
            "score": F.round(F.coalesce(F.array_max(F.transform(places, lambda p: p["share"] * p["worth"])), F.lit(0.0)), 6),
        },
    )
