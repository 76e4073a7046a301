"""License scans by sentence rules.

Texts are cut into sentences and normalised. A sentence that belongs to a known
license, on one line or wrapped over several, becomes an identifier; all others vanish. What is left of a text is a short
sequence of identifiers with gaps, in which ordered rules are recognised, longest
first: a full license text before the notice that is part of it.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from .common import map_columns

# Licenses in the order of their rules. A rule is the sentences that must
# follow each other; the SQL of this scan has the same ones.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ]),
    ("BSD-2-Clause", [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ]),
    ("Apache-2.0", [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at",
    ]),
    ("GPL-3.0", [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ]),
    ("Unlicense", [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ]),
    ("ISC", ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."]),
    ("MPL-2.0", ["This Source Code Form is subject to the terms of the Mozilla Public License, v2.0."]),
    ("MIT", ["Released under the MIT License."]),
    ("MIT", ["Licensed under the MIT License."]),
    ("MIT", ["This project is licensed under the MIT License."]),
    ("Apache-2.0", ["Licensed under the Apache License, Version 2.0."]),
    ("Apache-2.0", ["Released under the Apache License, Version 2.0."]),
    ("GPL-3.0", ["This work is licensed under the GNU General Public License, version 3."]),
    ("GPL-3.0", ["Licensed under the GNU General Public License, version 3."]),
    ("GPL-2.0", ["Licensed under the GNU General Public License, version 2."]),
    ("LGPL-3.0", ["Licensed under the GNU Lesser General Public License, version 3."]),
    ("BSD-3-Clause", ["Licensed under the BSD 3-Clause License."]),
    ("CC-BY-NC-4.0", ["Licensed under CC BY-NC 4.0."]),
    ("CC-BY-SA-4.0", ["Licensed under CC BY-SA 4.0."]),
    ("CC-BY-4.0", ["Licensed under CC BY 4.0."]),
    ("CC-BY-4.0", ["This work is licensed under a Creative Commons Attribution 4.0 International License."]),
    ("CC-BY-SA-4.0", ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."]),
    ("CC-BY-NC-4.0", ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."]),
    ("CC0-1.0", ["This work is dedicated to the public domain under CC0 1.0."]),
]

# Rules beside those, as the published texts have them. "..." is a gap of other sentences,
# {} stands for up to 12 words, such as a holder's name.
_BSD = RULES[1][1]
_GPL = RULES[3][1]
PUBLISHED: list[tuple[str, list[str]]] = [
    ("BSD-3-Clause", [*_BSD, "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."]),
    ("BSD-3-Clause", [*_BSD, "The name of {} may not be used to endorse or promote products derived from this software without specific prior written permission."]),
    ("BSD-3-Clause", [*_BSD, "Neither the name of {} nor the names of contributors may be used to endorse or promote products derived from this software without specific prior written permission."]),
    ("GPL-3.0", [_GPL[0], "...", _GPL[1]]),
    ("MPL-2.0", ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."]),
]

# Every sentence of the rules holds one of these; other texts need no closer look.
HINT = r"(?i)licen[sc]e|copyright|permission|redistribut|public\W+domain|anyone\W+is\W+free"
# A sentence can end at a line's end, or at its stop before a blank. A known one may also
# go on there: only an empty line, one of symbols alone included, parts it for sure.
SENTENCE_END = re.compile(r"([.!?:]+[\x20\x09-\x0D]+|[\n\r]+)")
EMPTY_LINE = re.compile(r"(?:\r\n|[\n\r])[\x20\x09-\x0D]*?(?:\r\n|(?<!\r)\n|\r(?!\n))")
# Signs of a comment vanish with all symbols; these two are words.
# The number of a list's entry, alone or before its text.
NUMBER = re.compile(r"[0-9]{1,2}|[a-z]|[ivx]{2,4}")
NUMBERED = re.compile(r"[^\w]*(?:[0-9]{1,2}|[A-Za-z]|[ivx]{2,4})\)\s")
WILD = 12  # words at most
COMMENT = re.compile(r"[^\w]*(?:rem|REM|dnl)(?=\s)")


def normalise(sentence: str) -> str:
    """Lower-case letters and digits with single blanks between; everything else parts words."""
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower())
    return " ".join(kept.split())


def sentence_ids() -> dict[str, int]:
    """Normalised sentences with their identifiers, in order of the rules."""
    known: dict[str, int] = {}
    for _, sentences in RULES:
        for sentence in sentences:
            known.setdefault(normalise(sentence), len(known) + 1)
    return known


def rule_sequences() -> list[tuple[str, str]]:
    """Rules as license and identifier sequence, longest first, else as listed."""
    known = sentence_ids()
    rules = [(name, [known[normalise(s)] for s in sentences]) for name, sentences in RULES]
    rules.sort(key=lambda rule: -len(rule[1]))
    return [(name, "".join(f"<{i}>" for i in ids)) for name, ids in rules]


@cache
def all_ids() -> dict[str, int]:
    """The sentences of all rules with their identifiers; those of ``RULES`` come first."""
    known = sentence_ids()
    for _, sentences in PUBLISHED:
        for sentence in sentences:
            if sentence != "...":
                known.setdefault(" {} ".join(map(normalise, sentence.split("{}"))), len(known) + 1)
    return known


def all_sequences() -> list[tuple[str, str]]:
    """All rules as license and pattern of identifiers, longest first, else as listed."""
    known, rules = all_ids(), []
    for name, sentences in RULES + PUBLISHED:
        keys = [s if s == "..." else " {} ".join(map(normalise, s.split("{}"))) for s in sentences]
        pattern = "".join("-*" if key == "..." else f"<{known[key]}>" for key in keys)
        rules.append((name, pattern, pattern.count("<")))
    rules.sort(key=lambda rule: -rule[2])
    return [(name, pattern) for name, pattern, _ in rules]


@cache
def sentence_tree() -> dict:
    """The known sentences word by word; None leads from a last word to the identifier."""
    tree: dict = {}
    for sentence, number in all_ids().items():
        node = tree
        for word in sentence.split():
            node = node.setdefault(word, {})
        node[None] = number
    return tree


def paragraphs(text: str) -> list[list[list[str]]]:
    """Words of the parts between possible sentence ends, by paragraph."""
    found: list[list[list[str]]] = [[]]
    pieces = SENTENCE_END.split(text)
    for at in range(0, len(pieces), 2):
        piece = pieces[at]
        if at and pieces[at - 1][-1] in "\n\r":
            piece = COMMENT.sub("", piece, count=1) if COMMENT.match(piece) else piece
        words = normalise(piece).split()
        if NUMBERED.match(piece):
            found[-1].append(words[:1])
        if rest := words[1:] if NUMBERED.match(piece) else words:
            found[-1].append(rest)
        if found[-1] and (not words or at + 1 < len(pieces) and EMPTY_LINE.search(pieces[at + 1])):
            found.append([])
    return found


def known_run(parts: list[list[str]], start: int) -> tuple[int, int] | None:
    """The longest known sentence made of whole parts from ``start`` on: identifier and end."""
    tree, best = sentence_tree(), None
    open_ = [(tree, start, 0)]
    seen = set()
    while open_:
        node, at, word = open_.pop()
        if at < len(parts) and word == len(parts[at]):
            at, word = at + 1, 0
        if (id(node), at, word) in seen:
            continue
        seen.add((id(node), at, word))
        if None in node and word == 0 and (best is None or at > best[1]):
            best = node[None], at
        if at == len(parts):
            continue
        if parts[at][word] in node:
            open_.append((node[parts[at][word]], at, word + 1))
        if "{}" in node:
            for _ in range(WILD):
                at, word = (at, word + 1) if word + 1 < len(parts[at]) else (at + 1, 0)
                open_.append((node["{}"], at, word))
                if at == len(parts):
                    break
    return best


def identified(text: str) -> tuple[str, str]:
    """A text's recognised sentences as a string of identifiers; a dash is a gap of others.

    The second string is what rules are matched in: numbers of list entries make no gap.
    """
    marks = []
    for parts in paragraphs(text):
        at = 0
        while at < len(parts):
            if run := known_run(parts, at):
                marks.append(f"<{run[0]}>")
                at = run[1]
            else:
                number = len(parts[at]) == 1 and NUMBER.fullmatch(parts[at][0])
                marks.append("#" if number else "-")
                at += 1
    found = "".join(marks)
    return re.sub("[-#]+", "-", found), re.sub("-+", "-", found.replace("#", ""))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licenses that every whole text states.

    Columns: ``doc_id``, ``n_sentences`` (recognised ones), ``n_statements`` (rules met,
    repeats counted), ``licenses`` (names in order of code point, comma-joined, each once,
    empty if none) and ``license_ids`` (identifiers in order with gaps as dashes).

    Case, punctuation, spacing and the signs of comments do not matter. A sentence may be
    wrapped over lines, but not over an empty one, and begins and ends at the border of a
    line or of a sentence. A null or empty
    text states nothing. Null ids stay null, repeated rows give one row each, an empty
    table an empty result. Rules are applied in order; a sentence used by one rule is not
    used by a later one. Only the id and the text are read.
    """
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.when(F.rlike(F.col(f"`{text_col}`"), F.lit(HINT)), F.col(f"`{text_col}`")).alias("_text"),
    )

    def make():
        def identify(ids, texts):
            for key, text in zip(ids, texts):
                yield key, *identified(text or "")

        return identify

    rows = map_columns(rows, "doc_id long, _ids string, _match string", make)
    # One step per rule: what a rule meets is counted and taken away. Texts without
    # any identifier, nearly all, pass by a single test.
    stated = F.struct(F.col("_match").alias("left"), F.array().cast("array<string>").alias("names"), F.lit(0).alias("n"))
    rules = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(s).alias("ids")) for n, s in all_sequences()))

    def apply(so_far: Column, rule: Column) -> Column:
        left = F.regexp_replace(so_far["left"], rule["ids"], F.lit("-"))
        met = F.regexp_count(so_far["left"], rule["ids"])
        names = F.when(met > 0, F.concat(so_far["names"], F.array(rule["name"]))).otherwise(so_far["names"])
        return F.struct(left.alias("left"), names.alias("names"), (so_far["n"] + met).alias("n"))

    rows = rows.withColumn("_met", F.when(F.col("_ids").contains("<"), F.aggregate(rules, stated, apply)))
    names = F.array_join(F.sort_array(F.array_distinct("_met.names")), ",")
    found = F.length("_ids") - F.length(F.replace(F.col("_ids"), F.lit("<"), F.lit("")))
    return rows.select(
        "doc_id",
        found.cast("long").alias("n_sentences"),
        F.coalesce(F.col("_met.n"), F.lit(0)).cast("long").alias("n_statements"),
        F.coalesce(names, F.lit("")).alias("licenses"),
        F.when(F.col("_ids").contains("<"), F.col("_ids")).otherwise("").alias("license_ids"),
    )
