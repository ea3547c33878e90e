"""License notices by conditional compression, confirmed by exact differences in wording.

A block is what stands around a word that license notices use. It is compressed alone and with each
template as a raw zstandard dictionary; how much smaller it gets with a template ranks the templates.
All that take off enough are then compared with the block word by word: a notice is confirmed if enough of the template's
words stand in the block in order and close together, and the words that differ are part of the result. If among them
are words that tell the licenses of a family apart (numbers, "Lesser", "NonCommercial"), the notice is of a license
that has no template: it is reported as ``unknown`` and the family.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from difflib import SequenceMatcher
from functools import partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import binaries, slices

# Short notices by which texts state their license.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-2-Clause": "Use of this source code is governed by the BSD 2-Clause license.",
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    **{
        f"{short}-{number}": f"This work is licensed under the GNU {name} Public License, version {number.removesuffix('.0')}."
        for short, name, number in (
            ("GPL", "General", "2.0"), ("GPL", "General", "3.0"), ("LGPL", "Lesser General", "2.1"), ("LGPL", "Lesser General", "3.0"),
            ("LGPL", "Library General", "2.0"), ("AGPL", "Affero General", "3.0"),
        )
    },
    **{
        f"GPL-{n}.0-or-later": (
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            f"Public License as published by the Free Software Foundation, either version {n} of the License, or (at your "
            "option) any later version."
        )
        for n in (2, 3)
    },
    **{
        f"{short}-{number}-name": f"GNU {name} Public License, version {number.removesuffix('.0')}"
        for short, name, number in (
            ("GPL", "General", "2.0"), ("GPL", "General", "3.0"), ("LGPL", "Lesser General", "2.1"), ("LGPL", "Lesser General", "3.0"),
            ("AGPL", "Affero General", "3.0"),
        )
    },
    "EPL-1.0": "This program is made available under the terms of the Eclipse Public License v1.0.",
    "EPL-2.0": "This program is made available under the terms of the Eclipse Public License 2.0.",
    "Apache-1.1": "Licensed under the Apache Software License, Version 1.1.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    **{
        f"CC-{short}-{number}": f"Licensed under CC {short} {number}."
        for short in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for number in ("2.0", "2.5", "3.0", "4.0")
    },
    **{
        f"CC-{short}-{number}-long": f"This work is licensed under a Creative Commons {name} {number} {kind} License."
        for short, name in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for number, kind in (("3.0", "Unported"), ("4.0", "International"))
    },
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
    ),
    "all-rights-reserved": "All rights reserved.",
}
# Words that tell the licenses of a family apart, besides numbers. A notice must agree in them.
TELLING = frozenset(
    "nc sa nd noncommercial sharealike noderivatives noderivs lesser library affero general unported clause all no not".split()
)
# The families.
FAMILIES = ["Apache", "MIT", "BSD", "AGPL", "LGPL", "GPL", "MPL", "EPL", "CC0", "CC", "Unlicense", "ISC"]
ANCHOR = r"(?i)licen[sc]|copyright|permission|redistribut|public domain|rights reserved"
MARGIN = 12  # words more than the longest template on each side of an anchor
GAIN = 0.15  # least share that a template must take off a block's compressed size
MATCH = 0.85  # least share of a template's words in the block

WORDS = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
RESULT = (
    "id {kind}, begin bigint, end bigint, license string, gain double, match double, missing string, added string"
)


def words_of(text: str) -> list[tuple[str, int, int]]:
    return [(m.group().lower(), m.start(), m.end()) for m in WORDS.finditer(text)]


def blocks(text: str, anchor: re.Pattern, reach: int) -> Iterator[tuple[int, int]]:
    """Spans around anchors: ``reach`` words to each side, one after the other where they meet.

    A run of anchors that meet is cut so that each block has at most one template's reach on either
    side of an anchor; neighbours overlap, so a notice lies whole in one of them.
    """
    last = -1
    for found in anchor.finditer(text):
        if found.start() < last:
            continue
        before = list(WORDS.finditer(text, max(0, found.start() - 16 * reach), found.start()))[-reach:]
        begin = before[0].start() if before else found.start()
        end, n = found.end(), 0
        for word in WORDS.finditer(text, found.start()):
            end, n = word.end(), n + 1
            if n > 2 * reach:
                break
        last = found.start() + (end - found.start()) // 2 if n > 2 * reach else end
        yield begin, end


def named(template: str, missing: str, added: str) -> str:
    """The template's name, or its family's if the wording differs in a word that tells licenses apart."""
    parts = {p for word in f"{missing} {added}".split() for p in re.split("[.-]", word)}
    if any(p in TELLING or re.fullmatch(r"v?\d+", p) for p in parts):
        return "unknown " + next((f for f in FAMILIES if template.startswith(f)), template)
    return template


class Scanner:
    def __init__(self, templates: Mapping[str, str], anchor: str = ANCHOR):
        self.anchor = re.compile(anchor)
        self.templates = {name: [w for w, _, _ in words_of(t)] for name, t in templates.items()}
        self.reach = max(map(len, self.templates.values())) + MARGIN
        self.plain = zstandard.ZstdCompressor(level=3)
        self.own = {name: len(self.plain.compress(" ".join(w).encode())) for name, w in self.templates.items()}
        self.given = {
            name: zstandard.ZstdCompressor(
                level=3, dict_data=zstandard.ZstdCompressionDict(" ".join(w).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            )
            for name, w in self.templates.items()
        }

    def gains(self, words: list[str]) -> list[tuple[float, str]]:
        """Templates by the bytes that they take off the block, relative to their own size."""
        block = " ".join(words).encode()
        alone = len(self.plain.compress(block))
        saved = [(alone - len(c.compress(block)), name) for name, c in self.given.items()]
        return sorted(((s / self.own[name], name) for s, name in saved), key=lambda x: (-x[0], x[1]))

    def confirm(self, words: list[str], name: str) -> list[tuple[int, int, float, str, str]]:
        """Places of the template in the block: (first word, end word, share, missing, added)."""
        wanted, found, low = self.templates[name], [], 0
        while low < len(words):
            best = None
            matcher = SequenceMatcher(None, wanted, words[low:], autojunk=False)
            seed = matcher.find_longest_match(0, len(wanted), 0, len(words) - low)
            if not seed.size:
                break
            # a notice has its words around the longest common run, give or take a few
            a = max(low, low + seed.b - seed.a - 3)
            b = min(len(words), low + seed.b + len(wanted) - seed.a + 3)
            near = SequenceMatcher(None, wanted, words[a:b], autojunk=False)
            runs = [m for m in near.get_matching_blocks() if m.size]
            share = sum(m.size for m in runs) / len(wanted)
            if share >= MATCH:
                first, end = a + runs[0].b, a + runs[-1].b + runs[-1].size
                missing, added = [], []
                for op, i, j, k, m in SequenceMatcher(None, wanted, words[first:end], autojunk=False).get_opcodes():
                    if op != "equal":
                        missing += wanted[i:j]
                        added += words[first + k : first + m]
                best = (first, end, share, " ".join(missing), " ".join(added))
            if best is None:
                break
            found.append(best)
            low = best[1]
        return found

    def _hits(self, words: list[str], free: list[tuple[int, int]]) -> list[tuple]:
        """(first word, end word, template, gain, share, missing, added) in the free stretches of a block."""
        rest = [w for a, b in free for w in words[a:b]]
        found = []
        for gain, name in self.gains(rest):
            if gain < GAIN:
                break
            for a, b in free:
                found += [(a + first, a + end, name, gain, *wording) for first, end, *wording in self.confirm(words[a:b], name)]
        return found

    def _block(self, words: list[str]) -> list[tuple]:
        """The notices of a block. What is confirmed is taken out and the rest compressed again, as one notice may
        hide what a like one would save; wording that fits exactly goes first."""
        free, found = [(0, len(words))], []
        while free:
            hits = self._hits(words, free)
            exact = [h for h in hits if h[4] == 1 and not h[6]]
            taken = _apart(exact or hits)
            if not taken:
                break
            found += taken
            for first, end, *_ in taken:
                free = [x for a, b in free for x in ((a, min(b, first)), (max(a, end), b)) if x[0] < x[1]]
        return found

    def __call__(self, text: str) -> list[tuple]:
        """(begin, end, license, gain, match, missing, added), best first where they overlap."""
        found = []
        for begin, end in blocks(text, self.anchor, self.reach):
            words = words_of(text[begin:end])
            for first, stop, name, gain, share, missing, added in self._block([w for w, _, _ in words]):
                span = (begin + words[first][1], begin + words[stop - 1][2])
                found.append((*span, named(name, missing, added), gain, share, missing, added))
        # neighbouring blocks overlap
        return sorted(_apart(list(set(found))))


def _apart(hits: list[tuple]) -> list[tuple]:
    """Of hits that overlap the one whose wording fits best and longest."""
    taken: list[tuple] = []
    for hit in sorted(hits, key=lambda h: (-h[4] + 0.01 * len(h[6].split()), h[0] - h[1], -h[3], h[2])):
        if all(hit[1] <= t[0] or hit[0] >= t[1] for t in taken):
            taken.append(hit)
    return taken


def _scan(batches: Iterator[pa.RecordBatch], templates: Mapping[str, str]):
    scan = Scanner(templates)
    names = ["id", "begin", "end", "license", "gain", "match", "missing", "added"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.string(), pa.string()]
    for batch in batches:
        for part in slices(batch, 200):
            hits = [(k, *h) for k, t in enumerate(binaries(part, "text")) for h in scan(t.decode())]
            columns = list(zip(*hits)) if hits else [[]] * 8
            ids = part.column("id").take(pa.array(columns[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns[1:], kinds)]], names=names)


def scan_licenses(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: Mapping[str, str] = TEMPLATES
) -> DataFrame:
    """One row per notice found: id, begin and end (characters), license, gain, match, missing, added.

    Whole texts are scanned. Null and empty texts have no notice. Rows that repeat an id are scanned one
    by one. An empty table gives an empty result; other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where(F.col("text").rlike(ANCHOR))
    return rows.mapInArrow(partial(_scan, templates=dict(templates)), RESULT.format(kind=kind)).withColumnRenamed("id", id_column)
