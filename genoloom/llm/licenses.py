"""Licence scan with a positional rare-token index, in DataFrame operations only.

Licence templates are indexed by word and place. Of the words that a template's key phrases hold,
the one with the highest inverse document frequency in the scanned table is looked up in every file;
each hit proposes where the template would begin in the file. Every place is then checked against
the licence words around it: each key phrase must stand there word by word, near its place, and
enough indexed words near theirs, so an inserted, dropped or changed word does not hide a notice.
As a notice holds its template's rarest word, none is missed, however many stand in a file.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoloom.llm.common import ascii_lower, settle, whole

# Licence notices as their publishers word them, with the phrases that must stand in
# them; the words of a phrase are consecutive words of the notice.
TEMPLATES = (
    ("mit", "Released under the MIT License", ("mit license",)),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction",
     ("permission is hereby granted", "without restriction")),
    ("apache", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ("general public license",)),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation", ("gnu general public license",)),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     ("creative commons attribution noncommercial 4 0",)),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
     ("creative commons attribution sharealike 4 0",)),
    ("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ("creative commons attribution 4 0",)),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
            "this software to the public domain worldwide", ("related and neighboring rights", "public domain")),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ("mozilla public license",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted", ("permission to use copy modify", "for any purpose with or without fee is hereby granted")),
    ("eupl", "Licensed under the European Union Public Licence", ("european union public licence",)),
    ("eupl", "Licensed under the EUPL", ("under the eupl",)),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License",
     ("eclipse public license",)),
    ("agpl", "GNU Affero General Public License", ("gnu affero general public license",)),
    ("bsl", "Distributed under the Boost Software License, Version 1.0", ("boost software license",)),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ("free and unencumbered software", "public domain")),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software",
     ("in no event will the authors be held liable for any damages",)),
)
# Licence expressions that package files hold without a notice.
EXPRESSIONS = (
    ("mit", "Apache-2.0 OR MIT", ("apache 2 0 or mit",)),
    ("mit", "MIT OR Apache-2.0", ("mit or apache 2 0",)),
    ("apache", "Apache-2.0", ("apache 2 0",)),
)
# SPDX identifiers and the label of each.
SPDX = (
    ("MIT", "mit"), ("Apache-2.0", "apache"), ("GPL-2.0", "gpl"), ("GPL-3.0", "gpl"), ("LGPL-2.1", "lgpl"), ("LGPL-3.0", "lgpl"),
    ("AGPL-3.0", "agpl"), ("CC-BY-4.0", "cc-by"), ("CC-BY-SA-4.0", "cc-by-sa"), ("CC-BY-NC-4.0", "cc-by-nc"), ("CC0-1.0", "cc0"),
    ("BSD-2-Clause", "bsd"), ("BSD-3-Clause", "bsd"), ("MPL-2.0", "mpl"), ("ISC", "isc"), ("EUPL-1.2", "eupl"), ("EPL-2.0", "epl"),
    ("BSL-1.0", "bsl"), ("Unlicense", "unlicense"), ("Zlib", "zlib"),
)
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

INDEX_CHARS = 6  # shorter words carry too little information to count as agreeing
AGREE = 2  # indexed words that must stand near their places, or all if a template has fewer
SLACK = 4  # words by which a phrase or an indexed word may be off its place

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _split(phrase: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in phrase.lower()).split()


def _all_templates() -> tuple[tuple[str, str, tuple[str, ...]], ...]:
    """The notices, the expressions, and a line ``SPDX-License-Identifier: X`` of every identifier, alone or in an expression."""
    return TEMPLATES + EXPRESSIONS + tuple(
        (label, f"SPDX-License-Identifier: {name}", ("spdx license identifier", " ".join(_split(name)))) for name, label in SPDX)


def _places(words: list[str], phrases: tuple[str, ...]) -> list[tuple[int, list[str]]]:
    """Where each phrase begins in its notice, and its words."""
    parts = [_split(p) for p in phrases]
    return [(next(i for i in range(len(words)) if words[i : i + len(p)] == p), p) for p in parts]


INDEX = [(label, _split(notice), _places(_split(notice), phrases)) for label, notice, phrases in _all_templates()]
INDEXED = [[(w, i) for i, w in enumerate(words) if len(w) >= INDEX_CHARS] for _, words, _ in INDEX]
REACH = max(len(words) for _, words, _ in INDEX) + SLACK  # no word of a notice is further from another one
VOCABULARY = sorted({w for t in INDEXED for w, _ in t} | {w for *_, places in INDEX for _, p in places for w in p}
                    | {w for p, _ in BASE_PHRASES for w in p.split()})


def licence_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """rid, doc_id, n_words and ``hits``, the places of licence words, of every row; settled.

    Words are runs of ASCII letters, digits and all other characters above U+007F, with A-Z
    lower-cased; a null text is empty. ``rid`` tells rows that share a doc_id apart.
    """
    words = F.split(F.btrim(F.regexp_replace(ascii_lower(whole(text)), NOT_WORD, " ")), " ")
    rows = docs.select(F.col(doc_id).alias("doc_id"), words.alias("words"))
    n = F.when(F.col("words")[0] == "", F.lit(0)).otherwise(F.size("words")).cast("long")
    places = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    hits = F.filter(places, lambda h: h["word"].isin(VOCABULARY))
    return settle(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", n.alias("n_words"), hits.alias("hits")))


def _phrase_starts(phrase: str) -> Column:
    """Places in ``hits`` where the phrase begins; all its words are licence words, so they are neighbours there."""
    words = phrase.split()

    def here(h: Column, i: Column) -> Column:
        found = h["word"] == words[0]
        for k, w in enumerate(words[1:], 1):
            after = F.get("hits", i + k)
            found = found & F.coalesce((after["word"] == w) & (after["at"] == h["at"] + k), F.lit(False))
        return found

    return F.transform(F.filter("hits", here), lambda h: h["at"])


def _rarest(df: dict[str, int], n_files: int) -> list[tuple[str, int]]:
    """Word and place of every template's rarest word among those of its key phrases."""
    idf = {w: math.log((n_files + 1) / (df.get(w, 0) + 1)) for w in VOCABULARY}
    return [min(((w, at + k) for at, p in places for k, w in enumerate(p)), key=lambda m: (-idf[m[0]], m)) for *_, places in INDEX]


def _facts(spark: SparkSession, rare: list[tuple[str, int]]) -> DataFrame:
    """One row per template, its indexed words and key phrases as arrays (the templates' size bounds it)."""
    def words(pairs: list[tuple[str, int]]) -> Column:
        return F.array(*(F.struct(F.lit(w).alias("word"), F.lit(i).alias("place")) for w, i in pairs)).cast(
            "array<struct<word:string,place:int>>")

    rows = [F.struct(
        F.lit(label).alias("label"), F.lit(word).alias("rare"), F.lit(place).alias("rare_place"), words(indexed).alias("indexed"),
        F.array(*(F.struct(F.lit(at).alias("place"), F.array(*map(F.lit, p)).alias("words")) for at, p in places)).alias("phrases"),
    ) for (word, place), (label, _, places), indexed in zip(rare, INDEX, INDEXED, strict=True)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _agreeing() -> Column:
    """How many indexed words stand near their places."""
    def near(p: Column) -> Column:
        return F.exists("around", lambda x: (x["word"] == p["word"]) & (F.abs(x["at"] - F.col("begins") - p["place"]) <= SLACK))

    return F.size(F.filter("indexed", near))


def _phrases_met() -> Column:
    """Whether every key phrase stands word by word near its place; its words are neighbours in ``around``."""
    def stands(p: Column, x: Column, i: Column) -> Column:
        n = F.size(p["words"])
        here = F.slice("around", i + 1, n)
        unbroken = F.coalesce(F.get(here, n - 1)["at"] == x["at"] + n - 1, F.lit(False))
        return (F.abs(x["at"] - F.col("begins") - p["place"]) <= SLACK) & (F.transform(here, lambda y: y["word"]) == p["words"]) & unbroken

    return F.forall("phrases", lambda p: F.size(F.filter("around", lambda x, i: stands(p, x, i))) > 0)


def notices(files: DataFrame) -> DataFrame:
    """rid, label, at, score of every licence notice that is verified in ``licence_words`` rows.

    A hit of a rare word carries the licence words within ``REACH`` hits of it, so a proposal is
    verified in its own row and nothing but proposals leaves a file. ``score`` is the share of the
    template's indexed words that stand near their place, 1 if it has none. A notice may be
    proposed, and returned, more than once.
    """
    spark = files.sparkSession
    n_files = files.count()
    held = files.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word"))
    rare = _rarest({r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}, n_files)
    numbered = F.transform("hits", lambda h, i: F.struct(h["at"].alias("at"), h["word"].alias("word"), i.alias("i")))
    proposing = F.filter(numbered, lambda h: h["word"].isin(sorted({w for w, _ in rare})))
    around = F.transform(proposing, lambda h: F.struct(
        h["at"].alias("at"), h["word"].alias("rare"), F.slice("hits", F.greatest(h["i"] + 1 - REACH, F.lit(1)), 2 * REACH + 1).alias("around")))
    places = files.select("rid", F.inline(around)).join(F.broadcast(_facts(spark, rare)), "rare").withColumn(
        "begins", F.col("at") - F.col("rare_place"))
    agreed = places.where(_phrases_met()).withColumn("agree", _agreeing()).where(F.col("agree") >= F.least(F.lit(AGREE), F.size("indexed")))
    share = F.when(F.size("indexed") > 0, F.col("agree") / F.size("indexed")).otherwise(F.lit(1.0))
    return agreed.select("rid", "label", F.col("begins").alias("at"), share.alias("score"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base places are the fixed phrases, wherever they stand; the index adds labels of verified
    notices. ``score`` is the best notice's, at least 0.5 where a base phrase stands, else 0.
    """
    files = licence_words(docs, doc_id, text)
    found = notices(files).groupBy("rid").agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
    starts = files.select("rid", "doc_id", "n_words", *(_phrase_starts(p).alias(f"p{k}") for k, (p, _) in enumerate(BASE_PHRASES)))
    names = [f"p{k}" for k in range(len(BASE_PHRASES))]
    base = F.array_compact(F.array(*(F.when(F.size(n) > 0, F.lit(label)) for n, (_, label) in zip(names, BASE_PHRASES, strict=True))))
    starts = starts.select("rid", "doc_id", "n_words", F.concat(*names).alias("at"), F.array_sort(F.array_distinct(base)).alias("base"))
    joined = starts.join(found, "rid", "left")
    every = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"), F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"), F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("at") > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"))
