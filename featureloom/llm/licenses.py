"""License scan by conditional compression.

A candidate block is the text around license cue words (``REACH`` characters
to either side, overlapping windows merge). It is cut into parts that overlap by
half, of a size set by the template (``step`` characters from part to part: twice
the template, at least ``STEP``; a dictionary's saving vanishes in longer input).

1. Compress: every part is compressed by zstandard alone and with every template
   as a raw-content dictionary. The size reduction is the part's saving.
2. Rank: the templates of a part are ranked by their savings. One wins if it saves
   at least ``share`` of what it saves on its own wording; others are out.
3. Confirm: only winners are compared with the part's words. A place is confirmed
   where the template's words lie in order with few differences: at least
   ``coverage`` of its letters match, no word that tells licenses apart (one with a
   digit or in ``TELLING``) is missing, replaced or added, and fewer than half as
   many words are added. The differing words are reported.

A block can name several licenses; of places that meet, that of the template with
the larger saving stays, of one template's the one with fewer differences.

Rules: null and empty texts have no blocks; texts are scanned whole and a
block's length is not limited; repeated rows are scanned one by one; null ids
pass through; extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts

REACH = 240
STEP = 128
#: Words and phrases that license notices hold.
CUE_TEXTS = ("licen[sc]", "copyright", "spdx-", "public domain", "all rights reserved", "permission is hereby", "permission to use",
             "redistribution and use", "neither the name of", "without warrant", "implied warrant", "creativecommons")
CUE = re.compile("|".join(CUE_TEXTS), re.IGNORECASE)
CUES = tuple(c.replace("[sc]", "").encode() for c in CUE_TEXTS)
WORD = re.compile(r"[A-Za-z]+|\d+(?:\.\d+)*")

#: Notices of public licenses, by SPDX identifier.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License 2.0",
        "Apache License Version 2.0, January 2004",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "MIT": (
        "License: MIT",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "GPL-3.0": (
        "licensed under the GNU General Public License, version 3",
        "licensed under the GNU General Public License v3.0",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3",
    ),
    "GPL-2.0": (
        "licensed under the GNU General Public License, version 2",
        "licensed under the GNU General Public License v2.0",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2",
    ),
    "LGPL-3.0": (
        "licensed under the GNU Lesser General Public License, version 3",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3",
    ),
    "LGPL-2.1": (
        "licensed under the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1",
    ),
    "AGPL-3.0": (
        "licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3",
    ),
    "MPL-2.0": (
        "subject to the terms of the Mozilla Public License, v. 2.0",
        "licensed under the Mozilla Public License 2.0",
    ),
    "EPL-2.0": (
        "made available under the terms of the Eclipse Public License 2.0",
        "licensed under the Eclipse Public License v2.0",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Boost Software License - Version 1.0 - August 17th, 2003",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Released under the BSD License",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License",),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Licensed under the ISC License",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0",
                     "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0",
                     "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC0-1.0": ("dedicated to the public domain under CC0 1.0",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
#: The notices and the identifier line of each license.
TEMPLATES = {name: (*forms, *(() if name == "BSD" else (f"SPDX-License-Identifier: {name}",))) for name, forms in NOTICES.items()}
#: Words that tell licenses apart.
TELLING = frozenset("apache mit gnu general lesser affero mozilla bsd cc by sa nc nd commons attribution sharealike "
                    "noncommercial unencumbered gpl lgpl agpl mpl epl bsl redistribution isc boost eclipse zlib unlicense".split())


def blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of the candidate blocks, in code points."""
    low = text.encode().lower()
    if not any(c in low for c in CUES):
        return []
    out: list[list[int]] = []
    for m in CUE.finditer(text):
        s, e = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and s <= out[-1][1]:
            out[-1][1] = e
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def confirm(template: list[str], words: list[str], where: dict[str, list[int]], coverage: float) -> list[tuple]:
    """(rank, first word, end word, differences) of the template's places among ``words``, best first.

    ``where`` has the places of each word in ``words``."""
    letters = sum(map(len, template))
    must = {w for w in template if w in TELLING or any(c.isdigit() for c in w)}

    def hopeless(met) -> bool:
        """Too few of the template's words are there, in whatever order."""
        return not must <= met.keys() or sum(len(w) for w in template if w in met) / letters < coverage

    if hopeless(where):
        return []
    places = []
    # a place keeps every telling word, and one of any words that hold more than the letters it may miss
    rare, held = [], sum(len(w) for w in template if w not in where)
    for w in sorted(must or {w for w in template if w in where}, key=lambda w: (len(where[w]), -len(w), w)):
        rare.append(w)
        held += len(w) * template.count(w)
        if must or 1 - held / letters < coverage - 1e-9:
            break
    # the window starts where the template would without added words, or at any word of it before
    anchors = {max(0, k - i) for w in rare for k in where[w] for i, v in enumerate(template) if v == w}
    anchors |= {j for w in rare for k in where[w] for j in range(max(0, k - 2 * len(template) + 1), k + 1) if words[j] in template}
    seen = set()
    for first in sorted(anchors):
        window = words[first:first + 2 * len(template)]
        if hopeless(dict.fromkeys(window)):
            continue
        match = SequenceMatcher(None, template, window, autojunk=False)
        parts = [b for b in match.get_matching_blocks() if b.size]
        if not parts:
            continue
        kept = {i for b in parts for i in range(b.a, b.a + b.size)}
        share = sum(len(template[i]) for i in kept) / letters
        missing = [w for i, w in enumerate(template) if i not in kept]
        if share < coverage or not must.isdisjoint(missing):
            continue
        s, e = parts[0].b, parts[-1].b + parts[-1].size
        met = {j for b in parts for j in range(b.b, b.b + b.size)}
        added = [window[j] for j in range(s, e) if j not in met]
        if any(w in TELLING for w in added) or 2 * len(added) >= len(template):  # another license's name stands between
            continue
        if (first + s, first + e) in seen:
            continue
        seen.add((first + s, first + e))
        places.append(((-share, len(added)), first + s, first + e, [f"-{w}" for w in missing] + [f"+{w}" for w in added]))
    return sorted(places)


def saving(plain: zstandard.ZstdCompressor, given: zstandard.ZstdCompressor, data: bytes) -> int:
    """Bytes that a compressor's dictionary saves on ``data``."""
    return len(plain.compress(data)) - len(given.compress(data))


class Scanner:
    """Templates as dictionaries: (license, words, compressor, least saving of a winner), by the step of their parts."""

    def __init__(self, templates: dict[str, tuple[str, ...]], coverage: float, share: float = 0.2):
        self.coverage = coverage
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.templates, self.steps = [], defaultdict(list)
        for name, forms in templates.items():
            for form in forms:
                own = form.lower().encode()
                raw = zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                raw.precompute_compress(level=3)
                given = zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False, write_dict_id=False)
                least = max(1.0, share * saving(self.plain, given, own))
                self.steps[max(STEP, 1 << (2 * len(form) - 1).bit_length())].append(len(self.templates))
                self.templates.append((name, [w.lower() for w in WORD.findall(form)], given, least))

    def winners(self, data: bytes, candidates: list[int]) -> list[tuple[int, int]]:
        """(saving, template) of the templates that save enough on ``data``, best first."""
        alone = len(self.plain.compress(data))
        saved = ((alone - len(self.templates[k][2].compress(data)), k) for k in candidates)
        return sorted(((s, k) for s, k in saved if s >= self.templates[k][3]), key=lambda w: (-w[0], w[1]))

    def scan(self, text: str) -> tuple[int, list[dict]]:
        found, out = blocks(text), []
        for start, end in found:
            block = text[start:end]
            tokens = [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(block)]
            words, begins = [t[0] for t in tokens], [t[1] for t in tokens]
            places = defaultdict(list)  # by template: its confirmed places with the saving of the part they start in
            for step, candidates in self.steps.items():
                last = max(0, -(-len(block) // step) - 2) * step
                for at in range(0, last + 1, step):
                    lo, hi = bisect_left(begins, at), len(words) if at == last else bisect_left(begins, at + step)
                    for saved, k in self.winners(block[at:at + 2 * step].lower().encode(), candidates):
                        template = self.templates[k][1]
                        first = max(0, lo - 2 * len(template))
                        near, where = words[first:hi + 2 * len(template)], defaultdict(list)
                        for n, w in enumerate(near):
                            where[w].append(n)
                        places[k] += [(rank, first + s, first + e, saved, d) for rank, s, e, d in confirm(template, near, where, self.coverage)
                                      if lo <= first + s < hi]
            chosen = []
            for k, mine in places.items():
                for _, s, e, saved, differences in _apart(sorted(mine), len(words)):
                    chosen.append((-saved, s, e, k, differences))
            for saved, s, e, k, differences in _apart(sorted(chosen), len(words)):
                out.append({"license": self.templates[k][0], "s": start + tokens[s][1], "e": start + tokens[e - 1][2],
                            "saved": -saved, "differences": " ".join(differences)})
        return len(found), sorted(out, key=lambda r: (r["s"], r["license"]))


def _apart(places: list[tuple], words: int) -> Iterator[tuple]:
    """The places (_, first word, end word, ...) that meet none before them."""
    taken = bytearray(words)
    for place in places:
        if 1 not in taken[place[1]:place[2]]:
            taken[place[1]:place[2]] = b"\1" * (place[2] - place[1])
            yield place


def find_licenses(docs: DataFrame, keep: list[str], text_col: str = "text", templates: dict[str, tuple[str, ...]] | None = None,
                  coverage: float = 0.85, share: float = 0.2) -> DataFrame:
    """The ``keep`` columns, ``n_blocks`` and ``matches``: (license, s, e, saved, differences) by position."""
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    forms = templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        scanner = Scanner(forms, coverage, share)
        for batch in batches:
            for at, some in texts(batch, text_col):
                got = [scanner.scan(t or "") for t in some]
                yield {**{c: batch.column(c).slice(at, len(some)) for c in keep},
                       "n_blocks": [g[0] for g in got], "matches": [g[1] for g in got]}

    return map_batches(docs.select(*dict.fromkeys([text_col, *keep])), run, "".join(f"`{c}` {types[c]}, " for c in keep) +
                       "n_blocks long, matches array<struct<license:string,s:long,e:long,saved:long,differences:string>>")


def license_digest(found: DataFrame) -> DataFrame:
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m.license)))
    return found.select("doc_id", "n_blocks", F.size("matches").cast("long").alias("n_matches"),
                        F.array_join(names, ",").alias("licenses"),
                        F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m.license, m.s.cast("string"), m.e.cast("string"))), ",").alias("spans"),
                        F.array_join(F.transform("matches", lambda m: m.differences), ";").alias("differences"))
