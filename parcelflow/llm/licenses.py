"""License notices by conditional compression.

A candidate block is the part of a text around words that notices use, cut into overlapping windows of a few
template lengths. A window is compressed alone and with each template as the compressor's dictionary; templates are ranked by how many bytes
they save, as a share of what they save on themselves. From the top down, as long as they save enough, they are confirmed word by
word: every place of the window where one fits with few changes and holds the template's key words, and these changes. Of places that
overlap the one with more words in place wins, and among equals the better rank.

The gate on words runs in the JVM, so that only texts with such a word reach Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

#: Words of which every template holds one.
ANCHOR = r"(?i)licen[sc]|copyright|redistribut|warrant|permission|public domain"
#: Least share of its own saving that a template must save on a block, and least share of its words in place.
MIN_SAVING = 0.25
MIN_WORDS = 0.8
# Blocks and templates are short: small tables, and a search that finds every match of three bytes.
SETTINGS = {"window_log": 16, "hash_log": 13, "chain_log": 13, "search_log": 6, "min_match": 3, "target_length": 64,
            "strategy": zstandard.STRATEGY_BTOPT, "write_content_size": False}
_WORD = re.compile(r"[^\W_]+(?:[.\-+][^\W_]+)*")

# Wordings of public license notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."
    ),
    "BSD-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "LGPL-3.0-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "ISC-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-notice": "Released under the BSD License.",
    "BSD-conditions": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
}
# Words that tell a notice from those that are worded like it.
KEYS = {
    "MIT-notice": ("mit",), "Apache-2.0-notice": ("apache", "2.0"), "GPL-3.0-notice": ("general", "3"),
    "CC-BY-NC-4.0-notice": ("by-nc", "4.0"), "CC-BY-4.0-notice": ("commons", "attribution", "4.0"),
    "MPL-2.0-notice": ("mozilla",), "Apache-2.0-header": ("apache", "2.0"), "GPL-3.0-header": ("general", "3"),
    "GPL-2.0-notice": ("general", "2"), "GPL-2.0-header": ("general", "2"), "LGPL-2.1-header": ("lesser", "2.1"), "LGPL-3.0-header": ("lesser", "3"),
    "AGPL-3.0-header": ("affero", "3"), "BSD-notice": ("bsd",), "CC-BY-SA-4.0-notice": ("commons", "attribution-sharealike", "4.0"),
    "CC0-1.0-notice": ("waived", "neighboring"), "Unlicense": ("unencumbered",),
}
SCHEMA = "doc_id bigint, license string, start bigint, end bigint, saving double, rank int, changed_words int, similarity double, wording string, changes string"


def words_of(text: str) -> list[tuple[str, int, int]]:
    """Lower-case words with their places."""
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def blocks(text: str, words: list[tuple[str, int, int]], reach: int) -> Iterator[tuple[int, int]]:
    """Runs of words around anchors, ``reach`` to each side; runs that meet are one."""
    held = None
    anchors = re.compile(ANCHOR)
    for i, (_, start, end) in enumerate(words):
        # "public domain" is two words, so the gap behind a word is part of the search.
        if anchors.search(text, start, words[i + 1][2] if i + 1 < len(words) else end):
            low, high = max(0, i - reach), min(len(words), i + reach + 1)
            if held and low <= held[1]:
                held = (held[0], max(held[1], high))
            else:
                if held:
                    yield held
                held = (low, high)
    if held:
        yield held


def windows(low: int, high: int, reach: int) -> Iterator[tuple[int, int]]:
    """A block in parts of three reaches that overlap by one, which is a template and as many words put in.

    What a template saves is so measured on few words, however long a block grows, and each notice lies whole in a part.
    """
    while high - low > 3 * reach:
        yield low, low + 3 * reach
        low += 2 * reach
    yield low, high


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.words = name, [w for w, *_ in words_of(text)]
        self.keys = set(KEYS.get(name, ()))
        self.codes = {w: i for i, w in enumerate(dict.fromkeys(self.words))}
        self.reach = 2 * len(self.words)
        self.text = " ".join(self.words)
        data = zstandard.ZstdCompressionDict(self.text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.with_template = zstandard.ZstdCompressor(dict_data=data, compression_params=_SETTINGS)
        self.own = max(1, len(_ALONE.compress(self.text.encode())) - len(self.with_template.compress(self.text.encode())))

    def saving(self, block: bytes, alone: int) -> float:
        return (alone - len(self.with_template.compress(block))) / self.own

    def places(self, words: list[str], low: int, high: int, min_words: float) -> Iterator[tuple[int, int, int, int, str]]:
        """(minus the words in place, changed words, start, end, name) where the template fits, best for each end.

        Of starts with as few changes the last one counts. A place that lacks a key word is none.
        """
        n, size = len(self.words), high - low
        if size / n < min_words:
            return
        right = np.array([self.codes.get(w, -1) for w in words[low:high]], int)
        # A number holds changes and start of the best fit that ends at a word: changes * scale - start.
        scale = size + 1
        steps = np.arange(size + 1) * scale
        row = -np.arange(size + 1)
        for k, word in enumerate(self.words, 1):
            new = np.empty_like(row)
            new[0] = k * scale
            new[1:] = np.minimum(row[:-1] + (right != self.codes[word]) * scale, row[1:] + scale)
            row = np.minimum.accumulate(new - steps) + steps  # words of the text that the template lacks
        changes = -(-row // scale)
        for end in np.flatnonzero(1 - changes / n >= min_words).tolist():
            changed = int(changes[end])
            start = changed * scale - int(row[end])
            if end > start and self.keys <= set(words[low + start : low + end]):
                yield changed - n, changed, low + start, low + end, self.name


_SETTINGS = zstandard.ZstdCompressionParameters(**SETTINGS)
_ALONE = zstandard.ZstdCompressor(compression_params=_SETTINGS)


@lru_cache(maxsize=4)
def compiled(templates: tuple[tuple[str, str], ...]) -> list[Template]:
    return [Template(*t) for t in templates]


def _confirmed(words: list[str], low: int, high: int, templates: list[Template], min_saving: float, min_words: float) -> Iterator[tuple]:
    """(place, saving, rank) of the notices in one window, the template that saves most first."""
    data = " ".join(words[low:high]).encode()
    alone = len(_ALONE.compress(data))
    ranked = sorted(((t.saving(data, alone), t) for t in templates), key=lambda x: (-x[0], x[1].name))
    for rank, (saving, t) in enumerate(ranked, 1):
        if saving < min_saving:
            break
        for place in t.places(words, low, high, min_words):
            yield place, saving, rank


def classes_of(templates: list[Template]) -> list[list[Template]]:
    """Templates by length: those of a class reach at most half as far again as its shortest, and are ranked against each other."""
    classes: list[list[Template]] = []
    for t in sorted(templates, key=lambda t: (t.reach, t.name)):
        if classes and 2 * t.reach <= 3 * classes[-1][0].reach:
            classes[-1].append(t)
        else:
            classes.append([t])
    return classes


def notices(text: str, templates: list[Template], min_saving: float = MIN_SAVING, min_words: float = MIN_WORDS) -> list[tuple]:
    """(license, start, end, saving, rank, changed words, similarity, wording, changes) of each notice in a text.

    Blocks and windows are as wide as their templates ask for, so that a short notice stands out; templates of about one length are
    ranked in one window. Of notices that overlap, in one window or in two, the one with more words in place counts, then the one
    of better rank. A notice lacks none of its template's key words.
    """
    words = words_of(text)
    plain = [w for w, *_ in words]
    best: dict[tuple, tuple[int, float]] = {}  # place: rank, and minus the saving
    for some in classes_of(templates):
        reach = max(t.reach for t in some)
        for block in blocks(text, words, reach):
            for window in windows(*block, reach):
                for place, saving, rank in _confirmed(plain, *window, some, min_saving, min_words):
                    best[place] = min((rank, -saving), best.get(place, (rank, -saving)))
    known = {t.name: t for t in templates}
    taken = np.zeros(len(words), bool)
    # Words in place lead, then the rank of the template.
    found, queue = [], sorted((place[0], best[place][0], *place[1:]) for place in best)
    while queue:
        in_place, rank, changed, start, end, name = heappop(queue)
        t, (rank, saving) = known[name], best[in_place, changed, start, end, name]
        held = np.flatnonzero(taken[start:end])
        if len(held):
            # What is left of the place may still hold the notice with more changes.
            for rest in t.places(plain, start + int(held[-1]) + 1, end, min_words):
                if rest[3] == end and rest not in best:
                    best[rest] = (rank, saving)
                    heappush(queue, (rest[0], rank, *rest[1:]))
            continue
        taken[start:end] = True
        first, last = words[start][1], words[end - 1][2]
        changes = "; ".join(
            f"{' '.join(t.words[a:b])} -> {' '.join(plain[start + c : start + d])}"
            for kind, a, b, c, d in SequenceMatcher(None, t.words, plain[start:end], autojunk=False).get_opcodes() if kind != "equal"
        )
        found.append((t.name, first, last, -saving, rank, changed, 1 - changed / len(t.words), text[first:last], changes))
    return sorted(found, key=lambda f: f[1])


def _scan(templates: tuple, min_saving: float, min_words: float):
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.string(), pa.string())
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = compiled(templates)
        for batch in batches:
            rows = [
                (doc_id.as_py(), *notice)
                for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True)
                for notice in notices(text.as_py(), known, min_saving, min_words)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
         min_saving: float = MIN_SAVING, min_words: float = MIN_WORDS) -> DataFrame:
    """One row per notice: (id_col, license, start, end, saving, rank, changed_words, similarity, wording, changes).

    start and end are places in the text, in characters. Null, empty and other texts without a notice give no
    row; repeated rows give repeated notices. Each template must hold a word of ``ANCHOR``.
    """
    known = TEMPLATES if templates is None else templates
    if bare := [n for n, t in known.items() if not re.search(ANCHOR, t)]:
        raise ValueError(f"no anchor word in {bare}")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.filter(F.col("text").rlike(ANCHOR)).mapInArrow(_scan(tuple(known.items()), min_saving, min_words), SCHEMA).withColumnRenamed("doc_id", id_col)
