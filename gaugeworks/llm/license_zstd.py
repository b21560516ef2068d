"""License scans by conditional compression (operator 10).

The words around a cue are a candidate block, wherever in the text and however it is laid out. It is compressed
with each license template as a raw zstandard dictionary, and templates are ranked by how much smaller they make
it than no dictionary does. In that order each is compared with the block word by word, by a smallest number of
missing and extra words over all places of the block; all that come within the bound are confirmed. Of confirmed
licenses that overlap, the one with most words stays.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.shared import fresh

#: Wording of public licenses and of the notices that refer to them.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "mit-notice": "Released under the MIT License.",
    "mit-license": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."
    ),
    "lgpl-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights-reserved": "All rights reserved.",
}
#: What a candidate block holds; each template holds one of them.
CUES = ("licens", "permission", "redistribut", "public domain", "rights reserved")

#: Per cent of a long template's words that may be missing or extra together; a template under LONG words must
#: stand there as it is, and words with a digit must never be missing.
LOOSE_PERCENT, LONG = 20, 30
#: Words of a block at most; longer stretches are cut into blocks that overlap by the longest possible finding.
BLOCK_WORDS = 4096

WORD = re.compile(r"[^\W_]+(?:[.\-/][^\W_]+)*")
CUE = re.compile("|".join(cue.replace(" ", r"[\W_]+") for cue in CUES), re.IGNORECASE)
#: The last word of each cue: a text without any of them has no block.
STEMS = tuple(cue.split()[-1] for cue in CUES)
FOUND = "array<struct<license:string,start:int,end:int,saved:int,missing:int,extra:int>>"
NEVER = 1 << 14


def words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


class Scanner:
    """Templates with their dictionaries; one per worker process."""

    def __init__(self, templates: dict[str, str], level: int = 3) -> None:
        if bare := [name for name, text in templates.items() if not CUE.search(text)]:
            raise ValueError(f"templates without a cue: {bare}")
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self.words = {name: words(text) for name, text in templates.items()}
        self.allowed = {name: len(w) * LOOSE_PERCENT // 100 if len(w) >= LONG else 0 for name, w in self.words.items()}
        self.around = max((len(w) + self.allowed[name] for name, w in self.words.items()), default=0)
        self.with_dict = {}
        for name, text in templates.items():
            raw = zstandard.ZstdCompressionDict(" ".join(text.lower().split()).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.with_dict[name] = zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False, write_dict_id=False)

    def ranked(self, block: str) -> list[tuple[int, str]]:
        """(bytes saved, license) of all templates, most first; ties in order of templates."""
        flat = " ".join(block.lower().split()).encode("utf-8", "replace")
        alone = len(self.plain.compress(flat))
        saved = [(alone - len(one.compress(flat)), name) for name, one in self.with_dict.items()]
        return sorted(saved, key=lambda s: -s[0])

    def blocks(self, text: str) -> Iterator[list[re.Match]]:
        """The words around cues: as many before and after each as a finding can have, cues that are near in one block."""
        cues = (m.start() for m in CUE.finditer(text))
        cue = next(cues, None)
        before: deque[re.Match] = deque(maxlen=self.around)
        block: list[re.Match] = []
        left = 0
        for word in WORD.finditer(text):
            hit = False
            while cue is not None and cue < word.end():
                hit, cue = True, next(cues, None)
            if hit:
                block = block or list(before)
                left = self.around + 1
            if not left:
                if cue is None:
                    return
                before.append(word)
                continue
            block.append(word)
            left -= 1
            if not left:
                yield block
                before.extend(block)
                block = []
            elif len(block) >= max(BLOCK_WORDS, 2 * self.around):
                yield block
                block = block[-self.around :]
        if block:
            yield block

    def confirm(self, text: list[str], name: str) -> list[tuple[int, int, int, int]]:
        """(first word, end, missing, extra) of the places where the template's wording stands, none overlapping."""
        template, allowed = self.words[name], self.allowed[name]
        if not allowed:
            first, n = template[0], len(template)
            return [(i, i + n, 0, 0) for i, word in enumerate(text) if word == first and text[i : i + n] == template]
        if sum((Counter(template) & Counter(text)).values()) < len(template) - allowed:
            return []
        costs = differences(text, template)
        found: list[tuple[int, int, int, int]] = []
        for end in sorted(np.flatnonzero(costs[-1] <= allowed).tolist(), key=lambda j: (costs[-1, j], j)):
            place = trace(costs, text, template, end)
            if all(place[1] <= f[0] or place[0] >= f[1] for f in found):
                found.append(place)
        return found

    def scan(self, text: str | None) -> list[dict]:
        """The licenses of a text by start; of overlapping ones that with most words, then fewest differences, then most saved."""
        if not text or not any(stem in lowered for lowered in (text.lower(),) for stem in STEMS):
            return []
        results: dict[tuple[str, int, int], tuple] = {}
        for block in self.blocks(text):
            lower = [m.group().lower() for m in block]
            for saved, name in self.ranked(text[block[0].start() : block[-1].end()]):
                for first, end, missing, extra in self.confirm(lower, name):
                    span = (block[first].start(), block[end - 1].end())
                    weight = (len(self.words[name]) - missing, -missing - extra, saved)
                    one = (weight, {"license": name, "start": span[0], "end": span[1], "saved": saved, "missing": missing, "extra": extra})
                    results[name, *span] = max(one, results.get((name, *span), one), key=lambda o: o[0])
        kept: list[dict] = []  # by start, and so by end: none overlap
        for _, one in sorted(results.values(), key=lambda o: (*(-w for w in o[0]), o[1]["start"])):
            i = bisect.bisect(kept, one["start"], key=lambda other: other["start"])
            if (not i or kept[i - 1]["end"] <= one["start"]) and (i == len(kept) or kept[i]["start"] >= one["end"]):
                kept.insert(i, one)
        return kept


def differences(text: list[str], template: list[str]) -> np.ndarray:
    """Cell (i, j): least number of missing and extra words between the first i words of the template and a stretch of the text that ends at j."""
    numbers = {word: i for i, word in enumerate(dict.fromkeys(template))}
    coded = np.array([numbers.get(word, -1) for word in text])
    along = np.arange(len(text) + 1, dtype="i4")
    costs = np.zeros((len(template) + 1, len(text) + 1), "i2")
    for i, word in enumerate(template, start=1):
        step = costs[i - 1].astype("i4") + (NEVER if any(c.isdigit() for c in word) else 1)
        matched = coded == numbers[word]
        step[1:][matched] = np.minimum(step[1:][matched], costs[i - 1, :-1][matched])
        costs[i] = np.minimum(np.minimum.accumulate(step - along) + along, NEVER)
    return costs


def trace(costs: np.ndarray, text: list[str], template: list[str], end: int) -> tuple[int, int, int, int]:
    """(first word, end, missing, extra) of the stretch behind a cell of the last row; words match where they can."""
    i, j, missing, extra, last = len(template), end, 0, 0, end
    while i:
        if j and text[j - 1] == template[i - 1] and costs[i, j] == costs[i - 1, j - 1]:
            i, j = i - 1, j - 1
        elif j and costs[i, j] == costs[i, j - 1] + 1:
            j, extra = j - 1, extra + 1
        else:
            i, missing = i - 1, missing + 1
    return j, last, missing, extra


@functools.cache
def _scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(dict(templates))


def licenses(text: Column, templates: dict[str, str] = TEMPLATES) -> Column:
    """For each text the licenses found in it, with code-point offsets; none for null and empty texts."""
    frozen = tuple(templates.items())

    @F.arrow_udf(FOUND)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fields = [("license", pa.string()), *((name, pa.int32()) for name in ("start", "end", "saved", "missing", "extra"))]
        for batch in batches:
            yield pa.array([_scanner(frozen).scan(row.as_py()) for row in batch], pa.list_(pa.struct(fields)))

    return scanned(text)


def scan_licenses(documents: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per license found: doc_id, license, start, end, saved, missing, extra.

    Each row of `documents` is scanned alone and whole, its words one by one: memory holds a block, however long
    the text. Repeated rows repeat their results, a null doc_id stays null, null and empty texts and empty
    tables give none, and other columns are ignored. A text may hold any number of licenses; two that overlap
    are one finding. Every template must hold a cue; a finding needs one in reach.
    """
    name = fresh(["doc_id"], "found")
    found = F.explode(licenses(F.col("text"), templates)).alias(name)
    return documents.select("doc_id", found).select("doc_id", f"{name}.*")
