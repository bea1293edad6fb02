"""License scan: normalised text against licence templates by the Dice coefficient over word bigrams.

A text's segments (lines, paragraphs between blank lines, and the whole text) are normalised to lower-case words and
compared with every template as multisets of word bigrams: Dice = 2 * shared / (size a + size b). A template can only
reach the threshold t if the sizes satisfy min / max >= t / (2 - t), so templates sorted by size are pruned by two bounds
before anything is compared; of the rest, only those that share a bigram with the segment are scored. The words outside
matched segments are also compared in windows of about each template's size, so that a notice is found within a line or
across lines; a window begins and ends with a bigram of the template.

The templates are notices, short forms and whole licence texts (TEMPLATES, TEXTS); ``templates`` is a parameter.

Defined results. Null, empty and wordless texts: no match. A segment equal to several templates reports the best, ties to the first name. Very long texts are whole
(a segment longer than the largest template's bound costs one count). Repeated rows: the same answer each. Empty table: no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from .store import add_columns

THRESHOLD = 0.8

# Fixed texts: notices and short forms in their usual wording.
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "All-Rights-Reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "BSD-short": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT-short": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

TEMPLATES |= {
    "Apache-2.0-header": TEMPLATES["Apache-2.0"] + " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-url": TEMPLATES["Apache-2.0"] + " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "LGPL-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "EPL-1.0-notice": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
for _v, _port in {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}.items():
    for _k, _name in _CC.items():
        TEMPLATES[f"CC-{_k}-{_v}-short"] = f"Licensed under CC {_k} {_v}."
        TEMPLATES.setdefault(f"CC-{_k}-{_v}", f"This work is licensed under a Creative Commons {_name} {_v} {_port} License.")
for _k in ("AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
           "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib"):
    TEMPLATES[f"{_k}-spdx"] = f"SPDX-License-Identifier: {_k}"

#: Whole licence texts, without the copyright line of the short ones.
TEXTS = {f"{p.stem}-text": p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}

_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
_BLANK = re.compile(r"\n\s*\n")


def bigrams(text: str) -> Counter:
    """Pairs of neighbouring normalised words, the first and last with a border."""
    w = ["", *_WORD.findall(text.lower()), ""]
    return Counter(zip(w, w[1:], strict=False)) if len(w) > 2 else Counter()


def dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    return 2 * sum(min(n, b[k]) for k, n in a.items() if k in b) / total if total else 0.0


class Scanner:
    def __init__(self, templates: dict[str, str] | None = None, threshold: float = THRESHOLD):
        templates = TEMPLATES | TEXTS if templates is None else templates
        made = sorted((bigrams(t).total(), name, bigrams(t)) for name, t in sorted(templates.items()) if bigrams(t))
        self.sizes, self.names, self.bags = [m[0] for m in made], [m[1] for m in made], [m[2] for m in made]
        self.threshold, self.ratio = threshold, threshold / (2 - threshold)
        self.words = {w for b in self.bags for pair in b for w in pair if w}
        self.least = self.sizes[0] * self.ratio if made else 0
        self.most = self.sizes[-1] / self.ratio if made else -1
        self.holding: dict[tuple[str, str], list[int]] = {}
        for i, b in enumerate(self.bags):
            for pair in b:
                self.holding.setdefault(pair, []).append(i)

    def segment(self, words: list[str]) -> tuple[str, float] | None:
        """Best template of a segment's words."""
        size = len(words) + 1
        low, high = bisect_left(self.sizes, size * self.ratio - 1e-9), bisect_right(self.sizes, size / self.ratio + 1e-9)
        if low >= high or len(words) == 0:
            return None
        w = ["", *words, ""]
        bag = Counter(zip(w, w[1:], strict=False))
        near = {i for pair in bag for i in self.holding.get(pair, ()) if low <= i < high}
        best = min(((-dice(bag, self.bags[i]), self.names[i]) for i in near), default=None)
        return (best[1], -best[0]) if best and -best[0] >= self.threshold else None

    def scan(self, text: str | None) -> dict[str, float]:
        """Templates found in a text, with their best Dice coefficient."""
        out: dict[str, float] = {}
        if not text:
            return out
        lowered = text.lower()
        words_of = [_WORD.findall(line) for line in lowered.split("\n")]
        every = [x for w in words_of for x in w]
        pieces, runs, at, begin = [], [], 0, None
        for w in [*words_of, []]:
            if w:
                begin = at if begin is None else begin
                pieces.append((at, at + len(w)))
                at += len(w)
            elif begin is not None:
                runs.append((begin, at))
                begin = None
        pieces = list(dict.fromkeys([*pieces, *runs, (0, len(every))]))
        covered = []
        for start, end in pieces:
            if self.least <= end - start + 1 <= self.most and (hit := self.segment(every[start:end])):
                out[hit[0]] = max(out.get(hit[0], 0.0), hit[1])
                covered.append((start, end))
        done = 0
        for start, end in [*sorted(covered), (len(every), len(every))]:
            if start > done:
                for name, score in self.windows(every[done:start]):
                    out[name] = max(out.get(name, 0.0), score)
            done = max(done, end)
        return out

    def windows(self, words: list[str]) -> list[tuple[str, float]]:
        """Templates that a stretch within ``words`` matches: stretches of about a template's word count, from one shared
        bigram to another. Of stretches that overlap, the one that shares most counts."""
        places: dict[int, list[int]] = {}
        for k, pair in enumerate(zip(words, words[1:], strict=False)):
            for i in self.holding.get(pair, ()):
                places.setdefault(i, []).append(k)
        found = []
        for i, at in places.items():
            # at least this many bigrams, of which the borders give two
            if len(at) + 2 >= self.sizes[i] * self.ratio - 1e-9:
                found += [(-shared, -score, self.names[i], start, end) for shared, score, start, end in self.stretches(i, at, words)]
        starts: list[int] = []              # of the stretches taken, ascending; they don't overlap
        ends: list[int] = []
        out = []
        for _, score, name, start, end in sorted(found):
            i = bisect_left(starts, start)
            if (i == 0 or ends[i - 1] <= start) and (i == len(starts) or end <= starts[i]):
                starts.insert(i, start)
                ends.insert(i, end)
                out.append((name, -score))
        return out

    def stretches(self, i: int, at: list[int], words: list[str]) -> list[tuple[int, float, int, int]]:
        """(shared, Dice, start, end) of the stretches that reach the threshold. The window slides over the places ``at``
        of template i's bigrams with its shared count kept."""
        bag, size, out = self.bags[i], self.sizes[i], []
        for longest in sorted({size - 1, int(size / self.ratio) - 1}):
            have: Counter = Counter()
            shared, right = 0, 0
            for left, begin in enumerate(at):
                while right < len(at) and at[right] + 2 - begin <= longest:
                    pair = (words[at[right]], words[at[right] + 1])
                    have[pair] += 1
                    shared += have[pair] <= bag[pair]
                    right += 1
                if right > left:
                    end = at[right - 1] + 2
                    borders = (("", words[begin]) in bag) + ((words[end - 1], "") in bag)
                    score = 2 * (shared + borders) / (end - begin + 1 + size)
                    if score >= self.threshold:
                        out.append((shared + borders, score, begin, end))
                    pair = (words[begin], words[begin + 1])
                    shared -= have[pair] <= bag[pair]
                    have[pair] -= 1
                else:
                    right = left + 1
        return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` but its text, with n_licences, licences (names in order, comma-joined) and best (Dice, 0 without)."""
    scanner = Scanner(templates, threshold)

    def run(batch: pa.RecordBatch) -> list:
        found = [scanner.scan(t) for t in batch.column("text").to_pylist()]
        return [[len(f) for f in found], [",".join(sorted(f)) for f in found], [max(f.values(), default=0.0) for f in found]]

    return add_columns(docs, {"n_licences": "long", "licences": "string", "best": "double"}, run, drop=["text"])
