"""Licence scan by a positional index of rare licence words.

Every template (a licence text or phrase) is indexed by its rarest words: their inverse document frequencies are counted
over the whole table of documents. The index maps such a word to its places in templates. A file's rare words are looked
up, each place found proposes starts of the template in the file, and a start is accepted if the template's mandatory
phrases stand there word for word and enough of its other words stand at their relative positions. A word or phrase may
stand up to `slack` words before or behind its position, so words put in or left out do not hide a paragraph. A template of
n words that may miss m of them is indexed by m + 1 words, so at least one of them stands in every match: nothing is
overlooked. Of accepted starts of a template at most `slack` apart, the one with the greatest share counts, then the first.

All of it is one projection per row: no shuffle but for the frequencies of the template words, whose number is fixed.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows and any ids are scanned alike; an
empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    mandatory: tuple[str, ...] = field(default=())
    base: bool = False
    slack: int = 0

    @property
    def words(self) -> list[str]:
        return self.text.split(" ")

    def phrase_places(self) -> list[list[int]]:
        """Places of the words of each phrase that must stand; without mandatory phrases the whole template is one."""
        words, places = self.words, []
        for phrase in self.mandatory or (self.text,):
            key = phrase.split(" ")
            at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
            places.append(list(range(at, at + len(key))))
        return places

    def mandatory_places(self) -> list[int]:
        return sorted({k for places in self.phrase_places() for k in places})

    def shifts(self) -> list[int]:
        """How far from its position a word may stand, nearest first."""
        return sorted(range(-self.slack, self.slack + 1), key=lambda d: (abs(d), d))

    def may_miss(self, share: float) -> int:
        return min(len(self.words) - len(self.mandatory_places()), math.floor(len(self.words) * (1 - share) + 1e-9))


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, BREAKS), lambda w: w != "")


def document_frequencies(documents: DataFrame, words: list[str]) -> dict[str, int]:
    """In how many documents each of the given words stands."""
    held = F.array_distinct(F.filter(words_of(F.col("text")), lambda w: w.isin(words)))
    counts = documents.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return {word: 0 for word in words} | {r["word"]: r["df"] for r in counts.collect()}  # at most len(words) rows


def rare_index(templates: list[Template], frequencies: dict[str, int], share: float) -> dict[str, list[tuple[int, int]]]:
    """Rare word -> its (template, place) entries, from the words of each template in order of rarity."""
    index: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        words = template.words
        by_rarity = sorted(range(len(words)), key=lambda k: (frequencies[words[k]], k))
        for place in by_rarity[: template.may_miss(share) + 1]:
            index.setdefault(words[place], []).append((number, place))
    return index


def _sql(value: object) -> str:
    """A constant as SQL text, which Spark reads in one step however many values it has."""
    if isinstance(value, dict):
        return f"named_struct({', '.join(f'{_sql(k)}, {_sql(v)}' for k, v in value.items())})"
    if isinstance(value, list):
        return f"array({', '.join(map(_sql, value))})"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def _literal_templates(templates: list[Template], share: float) -> Column:
    def one(t: Template) -> dict:
        return {
            "label": t.label, "base": t.base, "words": t.words, "phrases": t.phrase_places(),
            "least": len(t.words) - t.may_miss(share), "shifts": t.shifts(), "slack": t.slack,
        }

    return F.expr(_sql([one(t) for t in templates]))


def _starts(words: Column, templates: list[Template], index: dict[str, list[tuple[int, int]]]) -> Column:
    """Proposed starts, as sorted distinct numbers: template * 2^32 + start."""
    rare = sorted(index)
    offsets = {w: sorted({(n, k + d) for n, k in index[w] for d in templates[n].shifts()}) for w in rare}
    listed = [f"{_sql(w)}, {_sql([{'template': n, 'offset': k} for n, k in offsets[w]])}" for w in rare]
    entries = F.expr(f"map({', '.join(listed)})")
    places = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(rare), i)))
    proposed = F.transform(
        places,
        lambda p: F.transform(F.element_at(entries, F.get(words, p)), lambda e: F.when(p >= e["offset"], F.shiftleft(e["template"].cast("long"), 32) + p - e["offset"])),
    )
    return F.sort_array(F.array_distinct(F.array_compact(F.flatten(proposed))))


def find_licenses(words: Column, templates: list[Template], index: dict[str, list[tuple[int, int]]], share: float) -> Column:
    """Matches in an array of words: structs of template, slack, label, base, start (from 0) and share of the template's words."""
    all_templates = _literal_templates(templates, share)

    def judge(code: Column) -> Column:
        template = F.get(all_templates, F.shiftright(code, 32).cast("int"))
        return F.get(F.transform(F.array(template), lambda t: against(code, t)), 0)

    def against(code: Column, template: Column) -> Column:
        start = code.bitwiseAND(0xFFFFFFFF).cast("int")
        same = lambda k, d: F.coalesce(F.get(words, start + k + d) == F.get(template["words"], k), F.lit(False))
        phrases = F.forall(template["phrases"], lambda ks: F.exists(template["shifts"], lambda d: F.forall(ks, lambda k: same(k, d))))
        found = F.size(
            F.filter(F.sequence(F.lit(0), F.size(template["words"]) - 1), lambda k: F.exists(template["shifts"], lambda d: same(k, d)))
        )
        return F.when(
            phrases & (found >= template["least"]),
            F.struct(
                F.shiftright(code, 32).alias("template"),
                template["slack"].alias("slack"),
                template["label"].alias("label"),
                template["base"].alias("base"),
                start.cast("long").alias("start"),
                (found / F.size(template["words"])).alias("share"),
            ),
        )

    def best(accepted: Column) -> Column:
        """Starts are distinct and in order, so those within the slack of one are among as many entries beside it."""
        def beaten(m: Column, i: Column, d: Column) -> Column:
            other = F.get(accepted, i + d)
            near = (other["template"] == m["template"]) & (F.abs(other["start"] - m["start"]) <= m["slack"])
            return near & ((other["share"] > m["share"]) | ((other["share"] == m["share"]) & (d < 0)))

        beside = lambda m: F.filter(F.sequence(-m["slack"], m["slack"]), lambda d: d != 0)
        return F.filter(
            accepted, lambda m, i: (m["slack"] == 0) | ~F.exists(beside(m), lambda d: F.coalesce(beaten(m, i, d), F.lit(False)))
        )

    accepted = F.array_compact(F.transform(_starts(words, templates, index), judge))
    return F.get(F.transform(F.array(accepted), best), 0)


def scan_licenses(documents: DataFrame, templates: list[Template], share: float = 0.8) -> DataFrame:
    """One row per document with all matches; `share`: least part of a template's words that must stand in place."""
    vocabulary = sorted({w for t in templates for w in t.words})
    index = rare_index(templates, document_frequencies(documents, vocabulary), share)
    worded = documents.select("doc_id", words_of(F.col("text")).alias("words"))
    return worded.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), find_licenses(F.col("words"), templates, index, share).alias("matches")
    )


def license_report(documents: DataFrame, templates: list[Template], share: float = 0.8) -> DataFrame:
    """Counts and places of base phrases, and labels of base phrases and of all templates."""
    scanned = scan_licenses(documents, templates, share)
    base = F.filter("matches", lambda m: m["base"])

    def names(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["start"])).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )


def paragraph(label: str, text: str, *mandatory: str) -> Template:
    """A template from running text, whose words may be shifted by up to two."""
    return Template(label, " ".join(re.findall(r"[a-z0-9]+", text.lower())), mandatory, slack=2)


#: Paragraphs of published licences. Versions are told apart by their mandatory phrases.
PARAGRAPHS = [
    paragraph(
        "mit-text",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions:""",
        "permission is hereby granted free of charge",
    ),
    paragraph(
        "mit-text",
        """The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
        "this permission notice shall be included",
    ),
    paragraph(
        "bsd-text",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met:""",
        "redistribution and use in source and binary forms",
    ),
    paragraph(
        "bsd-text",
        """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution.""",
        "redistributions in binary form must reproduce",
    ),
    paragraph(
        "bsd-3-clause",
        """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.""",
        "to endorse or promote products derived from this software",
    ),
    paragraph(
        "apache-2.0-text",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at""",
        "you may not use this file except in compliance with the license",
    ),
    paragraph(
        "gpl-2.0-text",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
        version.""",
        "gnu general public license",
        "either version 2 of the license",
    ),
    paragraph(
        "gpl-3.0-text",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version.""",
        "gnu general public license",
        "either version 3 of the license",
    ),
    paragraph(
        "lgpl-2.1-text",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)
        any later version.""",
        "gnu lesser general public license",
        "version 2 1 of the license",
    ),
    paragraph(
        "agpl-3.0-text",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
        "gnu affero general public license",
        "version 3 of the license",
    ),
    paragraph(
        "mpl-2.0-text",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at""",
        "mozilla public license v 2 0",
    ),
    paragraph(
        "isc-text",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
        "for any purpose with or without fee is hereby granted",
    ),
    paragraph(
        "unlicense-text",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
        "unencumbered software released into the public domain",
    ),
    paragraph(
        "zlib-text",
        """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
        alter it and redistribute it freely, subject to the following restrictions:""",
        "permission is granted to anyone to use this software",
    ),
]
