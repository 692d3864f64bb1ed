"""License scans by conditional compression.

A candidate block (the words as far from a licensing cue as a template can
reach) is compressed alone and with each template as zstandard raw dictionary;
templates are ranked by how much they shorten it. All that the block's words
let reach ``SIMILARITY`` are confirmed by exact wording differences: each is
aligned inside the block, and the window of words nearest to it must reach it.
Neither line ends, sentences nor the text around a wording matter, and a block
may have any length.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import text_of

SIMILARITY = 0.8
LEVEL = 9
# Wordings of well-known licences and notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "MIT-warranty": ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
                     "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "Apache-2.0-warranty": ("Unless required by applicable law or agreed to in writing, software distributed under the License is "
                            "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "GPL-3.0-or-later": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                         "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                         "option) any later version."),
    "BSD-conditions": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met:"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
    "All-rights-reserved": "All rights reserved.",
}
_GNU = ("This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}General Public License as "
        "published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version.")
_GNU_ONLY = ("This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}General Public License "
             "version {4} as published by the Free Software Foundation.")
_GNU_VERSIONS = (("GPL-2.0", "program", ";", "", ";", "2"), ("GPL-3.0", "program", ":", "", ",", "3"),
                 ("LGPL-2.0", "library", ";", "Library ", ";", "2"), ("LGPL-2.1", "library", ";", "Lesser ", ";", "2.1"),
                 ("LGPL-3.0", "library", ":", "Lesser ", ",", "3"), ("AGPL-3.0", "program", ":", "Affero ", ",", "3"))
for _name, *_parts in _GNU_VERSIONS:
    TEMPLATES[f"{_name}-or-later"] = _GNU.format(*_parts)
    TEMPLATES[f"{_name}-only"] = _GNU_ONLY.format(*_parts)
    if _parts[0] == "library":      # headers of programs under the library's licence
        TEMPLATES[f"{_name}-or-later-program"] = _GNU.format("program", *_parts[1:])
        TEMPLATES[f"{_name}-only-program"] = _GNU_ONLY.format("program", *_parts[1:])
TEMPLATES |= {
    "GPL-1.0-notice": "This work is licensed under the GNU General Public License, version 1.",
    "LGPL-2.0-notice": "This work is licensed under the GNU Library General Public License, version 2.",
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "GNU-warranty": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
                     "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "MPL-2.0-header": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                       "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "MPL-1.1": ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this "
                "file except in compliance with the License."),
    "EPL-1.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
                "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
                "is available at https://www.eclipse.org/legal/epl-2.0/"),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    "ISC-warranty": ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
                     "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means."),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "BSL-1.0-text": ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                     "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
                     "execute, and transmit the Software"),
    "Zlib": ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
             "and redistribute it freely, subject to the following restrictions:"),
    "BSD-2-Clause-notice": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause-notice": "Licensed under the BSD 3-Clause License.",
    "ISC-notice": "Licensed under the ISC License.",
    "CC0-1.0-notice": "Released under CC0 1.0.",
    "MIT-licensed": "Licensed under the MIT License.",
}
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: {} Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. {} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_NAME = (" {} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission.")
for _end, _marks in (("", ("1.", "2.", "3.")), ("-bullets", ("*", "*", "*"))):
    TEMPLATES[f"BSD-2-Clause{_end}"] = _BSD.format(*_marks)
    TEMPLATES[f"BSD-3-Clause{_end}"] = _BSD.format(*_marks) + _BSD_NAME.format(_marks[2])
for _name, _long in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                     ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                     ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _kind = "International" if _version == "4.0" else "Unported" if _version == "3.0" else "Generic"
        TEMPLATES[f"CC-{_name}-{_version}"] = f"Licensed under CC {_name} {_version}."
        TEMPLATES[f"CC-{_name}-{_version}-long"] = (
            f"This work is licensed under a Creative Commons {_long} {_version} {_kind} License.")
for _name in ("MIT", "MIT-0", "Apache-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
              "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only",
              "LGPL-3.0-or-later", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-1.1",
              "MPL-2.0", "EPL-1.0", "EPL-2.0", "Unlicense", "BSL-1.0", "Zlib", "0BSD", "CC0-1.0",
              *(f"CC-BY{_kind}-{_version}" for _kind in ("", "-SA", "-NC", "-ND", "-NC-SA", "-NC-ND")
                for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"))):
    TEMPLATES[f"SPDX-{_name}"] = f"SPDX-License-Identifier: {_name}"
# Words that tell licences apart, as versions do.
TOKENS = frozenset("sa nd nc lesser library affero only later mit apache bsd isc mpl mozilla epl eclipse gpl lgpl agpl boost bsl zlib unlicense "
                   "cc cc0 noncommercial sharealike noderivatives noderivs attribution clause spdx".split())
CUES = ("licen", "copyright", "permission is hereby", "free software", "redistribution and use", "warrant", "all rights reserved", "cc0",
        "permission to use", "permission is granted", "free and unencumbered", "made available under", "mozilla public")
_CUES = [(cue.split()[0], re.compile(r"\W+".join(map(re.escape, cue.split())))) for cue in CUES]     # over line ends, too
_MARKS = re.compile(r"[.!?]*")
_ON = re.compile(r"\.0*[1-9]|-\w|\+")      # after a fixed word: it is another one
_WORD = re.compile(r"\w+")


def plain(text: str) -> bytes:
    """What is compressed: lower case, one blank between words."""
    return " ".join(text.lower().split()).encode()


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def fixed(word: str) -> bool:
    """Words that may not differ: another version or kind is another licence."""
    return word[0].isdigit() or word in TOKENS


class Scanner:
    def __init__(self, templates: dict[str, str]):
        packer = zstandard.ZstdCompressor
        flags = dict(level=LEVEL)
        self.alone = packer(**flags)
        self.given = [(name, words(text), packer(dict_data=zstandard.ZstdCompressionDict(
            plain(text), dict_type=zstandard.DICT_TYPE_RAWCONTENT), **flags)) for name, text in sorted(templates.items())]
        self.given = [(name, wording, Counter(wording), packer) for name, wording, packer in self.given if wording]
        self.codes = {w: code for code, w in enumerate(sorted({w for _, wording, *_ in self.given for w in wording}))}

    def scan(self, text: str):
        """(start, end, template, alone, given, differing words)."""
        low = text.lower()
        if len(low) != len(text):               # offsets must be those of the text
            low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        places = sorted(m.start() for word, cue in _CUES if word in low for m in cue.finditer(low))
        if not places or not self.given:
            return
        spans = [m.span() for m in _WORD.finditer(low)]
        own = [low[a:b] for a, b in spans]
        starts = [a for a, _ in spans]
        cues = sorted({max(0, bisect_right(starts, at) - 1) for at in places})
        for a, b in _around(cues, max(reach(len(wording)) for _, wording, _, _ in self.given), len(own)):
            inside = cues[bisect_left(cues, a):bisect_left(cues, b)]
            for first, last, k, differ in self.judge(text, spans, own, a, b, inside):
                name, _, _, packer = self.given[k]
                end = _MARKS.match(text, spans[last][1]).end()
                raw = plain(text[spans[first][0]:end])
                yield (spans[first][0], end, name, len(self.alone.compress(raw)), len(packer.compress(raw)), differ)

    def judge(self, text, spans, own, a: int, b: int, cues: list[int]):
        """The confirmed windows of the block of words ``a`` to ``b``, by
        place: (first word, last word, template, words that differ)."""
        found, held = [], Counter(own[a:b])     # (differing less equal words, rank, first, last, template, differing)
        able = [k for k, (_, wording, counts, _) in enumerate(self.given) if _able(held, wording, counts)]
        if not able:
            return found
        raw = plain(text[spans[a][0]:spans[b - 1][1]])
        codes = np.fromiter((self.codes.get(w, len(self.codes)) for w in own[a:b]), np.int32, b - a)
        ranked = sorted((len(self.given[k][3].compress(raw)), k) for k in able)
        for rank, (_, k) in enumerate(ranked):
            _, wording, counts, _ = self.given[k]
            for c, d in _around(cues, reach(len(wording)), b, a):
                for e, f in _places(codes[c - a:d - a], [(self.codes[w], n, fixed(w)) for w, n in counts.items()], len(wording)):
                    for first, last, differ in windows(own[c + e:c + f], wording):
                        first, last = first + c + e, last + c + e
                        at = bisect_left(cues, first)
                        if at < len(cues) and cues[at] <= last and not _goes_on(text, spans[last], own[last]):
                            equal = (last + 1 - first + len(wording) - differ) // 2
                            found.append((differ - equal, rank, first, last, k, differ))
        taken, out = bytearray(b - a), []
        for _, _, first, last, k, differ in sorted(found):
            if not any(taken[first - a:last + 1 - a]):
                taken[first - a:last + 1 - a] = b"\1" * (last + 1 - first)
                out.append((first, last, k, differ))
        return sorted(out)


def _goes_on(text: str, span: tuple[int, int], word: str) -> bool:
    """Whether the fixed word at the end of a window is part of a longer
    version or name: version 3 of 3.1, MIT of MIT-0."""
    return fixed(word) and _ON.match(text, span[1]) is not None


def reach(n: int) -> int:
    """A window of more words cannot reach SIMILARITY = 2 * equal / (window + template)."""
    return int((2 - SIMILARITY) / SIMILARITY * n + 1e-9)


def _able(held: Counter, wording: list[str], counts: Counter) -> bool:
    """Whether words held may reach SIMILARITY: each equal word is in both, so
    equal >= SIMILARITY / 2 * (equal + template), and no fixed word may differ."""
    equal = 0
    for word, n in counts.items():
        got = held[word]
        if got < n and fixed(word):
            return False
        equal += min(got, n)
    return equal * (2 - SIMILARITY) >= SIMILARITY * len(wording) - 1e-9


def _places(codes: np.ndarray, counts: list[tuple[int, int, bool]], n: int) -> list[tuple[int, int]]:
    """(first, end) of the runs of words outside of which no window reaches
    SIMILARITY with a template of ``n`` words, given the codes of the words and
    (code, occurrences, fixed) of the template's. A window lies in the span of
    ``reach(n)`` words from its first word, so the span holds the template's
    fixed words, and words of the template enough for the equal ones that
    :func:`_able` asks for: sums of each span, in time linear in the words."""
    far, size = reach(n), len(codes)
    ends = np.minimum(np.arange(size) + far, size)

    def held(hits: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(hits, dtype=np.int64)))
        return sums[ends] - sums[:-1]

    known = np.isin(codes, [code for code, _, _ in counts])
    able = known & (held(known) * (2 - SIMILARITY) >= SIMILARITY * n - 1e-9)
    for code, least, kept in counts:
        if kept and able.any():
            able &= held(codes == code) >= least
    at = np.flatnonzero(able)
    out: list[tuple[int, int]] = []
    for first, end in zip(at.tolist(), ends[at].tolist()):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((first, end))
    return out


def windows(own: list[str], wording: list[str]):
    """(first, last, words that differ) of the windows of ``own`` that come
    near the template: for each last word that of fewest differences, the
    longest of them, if it reaches SIMILARITY. Rows of an edit table (a word
    is kept or left out; no fixed word is left out) whose cells hold
    differences * scale + start."""
    n, scale = len(wording), len(own) + 1
    never = (n + len(own) + 1) * scale
    steps = np.concatenate(([0], np.cumsum([never if fixed(w) else scale for w in wording])))
    equal = {w: np.array([v == w for v in wording]) for w in set(own) & set(wording)}
    row = steps.copy()
    for i, word in enumerate(own):
        new = row + (never if fixed(word) else scale)
        new[0] = i + 1
        same = equal.get(word)
        if same is not None:
            np.minimum(new[1:], row[:-1], out=new[1:], where=same)
        row = np.minimum.accumulate(new - steps) + steps
        if same is not None and row[n] < never:
            differ, first = divmod(int(row[n]), scale)
            if differ <= (1 - SIMILARITY) * (i + 1 - first + n) + 1e-9 and first <= i:
                yield first, i, differ


def _around(cues: list[int], far: int, stop: int, start: int = 0) -> list[tuple[int, int]]:
    """(first, end) of the runs of words at most ``far`` from a cue."""
    out: list[tuple[int, int]] = []
    for at in cues:
        a, b = max(start, at - far), min(stop, at + far + 1)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


_OUT = ("doc_id long, start long, end long, license string, bytes_alone long, bytes_given long, reduction double, n_differences long")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()),
                     ("bytes_alone", pa.int64()), ("bytes_given", pa.int64()), ("reduction", pa.float64()), ("n_differences", pa.int64())])


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """A row per confirmed window of each row of ``docs`` (``doc_id``, ``text``;
    others ignored): doc_id, start and end in code points, license (template),
    the window's bytes alone and given the template, reduction, and the number
    of words that differ. Null and empty texts have none; repeated rows each
    report; of windows that overlap, the one with the most equal words less the
    differing ones, then of the higher ranked template, is named."""
    templates = TEMPLATES if templates is None else templates

    def run(batches):
        scanner = Scanner(templates)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [{"doc_id": doc_id, "start": a, "end": b, "license": name, "bytes_alone": alone, "bytes_given": given,
                          "reduction": 1 - given / alone, "n_differences": n} for a, b, name, alone, given, n in scanner.scan(text)]
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(run, _OUT)
