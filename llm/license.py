"""License scans by conditional compression.

A candidate block is compressed by itself and again with each notice that could be there as
raw dictionary. Notices are ranked by the bytes that they save; all that save any are confirmed by
the words in which the text differs from them. Of those confirmed at one place the one counts
that saves most bytes of that stretch, less the bytes that it needs itself given the stretch. A
notice could be at a place if they share a run of words that no allowed difference would break. SPDX tags are read as expressions.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from llm.common import map_texts


def _gnu(kind: str, version: str) -> list[str]:
    """Notices of a GNU license: the short one, headers with and without later versions, names."""
    name = f"GNU {kind} Public License"
    out = [
        f"This work is licensed under the {name}, version {version}.",
        f"you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
        f"you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation; version {version} of the License.",
        f"you can redistribute it and/or modify it under the terms of the {name} version {version} as published by the Free Software Foundation.",
        f"under the terms of the {name} as published by the Free Software Foundation, version {version}.",
        f"licensed under the {name} version {version}",
        f"licensed under the {name} v{version}",
        f"licensed under the terms of the {name} version {version}",
        f"under the terms of the {name} version {version}",
        f"released under the {name} version {version}",
        f"{name} Version {version}, {_GNU_DATES[kind, version]}",
    ]
    if version.endswith(".0") or version in {"2", "3"}:
        out += [f"licensed under the {name} v{version}.0", f"licensed under the {name}, version {version}.0"]
    return out


_GNU_DATES = {("Affero General", "3"): "19 November 2007", ("General", "2"): "June 1991", ("General", "3"): "29 June 2007", ("Library General", "2"): "June 1991", ("Lesser General", "2.1"): "February 1999", ("Lesser General", "3"): "29 June 2007"}


def _cc(kind: str, short: str, version: str = "4.0") -> list[str]:
    """Notices of a Creative Commons license."""
    names = [f"Creative Commons {kind} {version} International License", f"Creative Commons {kind} {version} International", f"CC {short} {version}", f"CC-{short}-{version}"]
    uses = ["Licensed under {}.", "Licensed under a {}.", "Licensed under the {}.", "This work is licensed under {}.", "This work is licensed under a {}.", "Released under {}.", "available under the {}."]
    return [u.format(n) for n in names for u in uses]


def _named(*names: str) -> list[str]:
    """Short notices of a license by its names."""
    uses = ["Released under the {}.", "Licensed under the {}.", "Distributed under the {}.", "under the terms of the {}.", "available under the {}."]
    return [u.format(n) for n in names for u in uses]


def _numbered(text: str) -> list[str]:
    """A text with numbered conditions, and with other marks before them."""
    return [text, re.sub(r"\b[1-4]\. ", "", text)]


_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_TWO = f"{_BSD_START}: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THREE = [f"{_BSD_TWO} 3. Neither the name of {who} may be used to endorse or promote products derived from this software without specific prior written permission." for who in ("the copyright holder nor the names of its contributors", "the University nor the names of its contributors")]
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
_MIT_RIGHTS = "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
_APACHE = "Licensed under the Apache License, Version 2.0"
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

_BSD_THREE.append(f"{_BSD_TWO} 3. The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.")
_BSD_FOUR = _BSD_THREE[0].replace("3. ", "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization. 4. ")

#: Notices by SPDX identifier. Fixed values.
TEMPLATES = {
    "0BSD": [f"{_ISC}."],
    "AGPL-3.0": _gnu("Affero General", "3"),
    "Apache-2.0": [f"{_APACHE}.", f"{_APACHE} (the \"License\"); you may not use this file except in compliance with the License.", f"{_APACHE} (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "Apache License Version 2.0, January 2004", *_named("Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 license", "Apache-2.0 license")],
    "BSD-2-Clause": [f"{_BSD_START}.", *_numbered(_BSD_TWO), *_named("BSD 2-Clause License", "BSD-2-Clause License", "2-Clause BSD License", "Simplified BSD License")],
    "BSD-3-Clause": [*(t for text in _BSD_THREE for t in _numbered(text)), *_named("BSD 3-Clause License", "BSD-3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License")],
    "BSD-4-Clause": _numbered(_BSD_FOUR),
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", *_named("Boost Software License 1.0")],
    "CC-BY-4.0": _cc("Attribution", "BY"),
    "CC-BY-NC-4.0": _cc("Attribution-NonCommercial", "BY-NC"),
    "CC-BY-NC-ND-4.0": _cc("Attribution-NonCommercial-NoDerivatives", "BY-NC-ND"),
    "CC-BY-NC-SA-4.0": _cc("Attribution-NonCommercial-ShareAlike", "BY-NC-SA"),
    "CC-BY-ND-4.0": _cc("Attribution-NoDerivatives", "BY-ND"),
    "CC-BY-SA-4.0": _cc("Attribution-ShareAlike", "BY-SA"),
    "CC-BY-SA-3.0": _cc("Attribution-ShareAlike", "BY-SA", "3.0") + ["licensed under the Creative Commons Attribution-ShareAlike 3.0 Unported License."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "Licensed under CC0 1.0.", "Released under CC0 1.0.", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at", *_named("Eclipse Public License 2.0", "Eclipse Public License, Version 2.0", "Eclipse Public License v. 2.0")],
    "GPL-2.0": _gnu("General", "2"),
    "GPL-3.0": _gnu("General", "3"),
    "ISC": [f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.", *_named("ISC License")],
    "LGPL-2.0": _gnu("Library General", "2"),
    "LGPL-2.1": _gnu("Lesser General", "2.1"),
    "LGPL-3.0": _gnu("Lesser General", "3"),
    "MIT": [f"{_MIT}.", f"{_MIT}, {_MIT_RIGHTS}, subject to the following conditions", "licensed under MIT license", *_named("MIT License", "MIT/X11 License")],
    "MIT-0": [f"{_MIT}, {_MIT_RIGHTS}.", *_named("MIT No Attribution License")],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", *_named("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0")],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", *_named("Unlicense")],
    "Zlib": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions", *_named("zlib License")],
}
#: Words that make a place of a text a candidate: of every template more than may differ. Fixed values.
CUES = ["(?:sub|un)?licen[sc]e[ds]?", "licen[sc]ing", "redistribut(?:e|ed|ion|ions)", "cc0", "cc-by[a-z-]*-[0-9]", "hereby", "granted", "permission", "permitted", "public", "unencumbered", "spdx-license-identifier", "copyright", "software", "gnu", "mozilla", "eclipse", "apache", "bsd", "source code", "binary", "disclaimer", "waived", "neighboring", "endorse", "merge", "without", "documentation", "conditions", "commercial", "distribute", "modify", "creative commons", "international", "cc", "mit"]
_CUE = re.compile(r"(?<![A-Za-z0-9])(?:" + "|".join(CUES) + r")(?![A-Za-z0-9])", re.I)
_WORD = re.compile(r"[A-Za-z0-9]+(?:[.\-][A-Za-z0-9]+)*")
#: Comment marks that look like words, at the start of a line.
_MARK = re.compile(r"^[ \t]*(?:dnl|rem)\b", re.I | re.M)
#: Words that tell licenses apart: none of them may differ.
_TELLING = re.compile(r"\d|attribution|commercial|deriv|sharealike|affero|lesser|library|clause|^(?:mit|bsd|isc|gnu|cc|by|nc|nd|sa|apache|mozilla|eclipse|boost|zlib|unlicense|neither)$")
_TAG = re.compile(r"SPDX-License-Identifier\s*:[ \t]*", re.I)
_TERM = re.compile(r"[ \t(]*([A-Za-z0-9][A-Za-z0-9.\-]*[A-Za-z0-9]\+?)[ \t)]*")
_OPERATOR = re.compile(r"(AND|OR|WITH)[ \t(]+")
#: Level of compression, and the size of a block that it is tuned for.
LEVEL, BLOCK = 3, 4096
#: Part of a template's words that may differ; words from which on a template is a body, with names of its own filled in.
DIFFERENT, BODY = 0.12, 60


def _words(text: str) -> list[re.Match]:
    """Words of a text without comment marks."""
    return list(_WORD.finditer(_MARK.sub(lambda m: " " * len(m.group()), text)))


def _allowed(n: int) -> int:
    return int(DIFFERENT * n)


#: Words on either side of a cue: as many as the longest notice can have.
AROUND = max(n + _allowed(n) for texts in TEMPLATES.values() for n in (len(_WORD.findall(t)) for t in texts))


def blocks(text: str) -> list[tuple[int, int]]:
    """Ranges of the text around cues, over line ends and comment marks; overlapping ones joined."""
    cues = [m.start() for m in _CUE.finditer(text)]
    if not cues:
        return []
    words = _words(text)
    starts = [w.start() for w in words]
    out: list[tuple[int, int]] = []
    for at in cues:
        k = max(0, bisect_right(starts, at) - 1)
        low, high = max(0, k - AROUND), min(len(words), k + AROUND + 1)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return [(starts[low], words[high - 1].end()) for low, high in out]


def tags(text: str) -> list[tuple[int, str]]:
    """Place and license of each identifier of the text's SPDX tags."""
    out = []
    for m in _TAG.finditer(text):
        at, exception = m.end(), False
        while term := _TERM.match(text, at):
            if not exception:
                name = re.sub(r"(?:-only|-or-later|\+)$", "", term.group(1), flags=re.I)
                out.append((term.start(1), _KNOWN.get(name.lower(), name)))
            more = _OPERATOR.match(text, term.end())
            if not more:
                break
            at, exception = more.end(), more.group(1) == "WITH"
    return out


_KNOWN = {name.lower(): name for name in TEMPLATES}


class Scanner:
    def __init__(self):
        import zstandard as z

        self.z = z
        self.known, self.seeds, self.primed, self.pairs = [], {}, {}, set()
        for name, texts in TEMPLATES.items():
            for text in texts:
                words = tuple(w.lower() for w in _WORD.findall(text))
                k, n = len(self.known), len(words)
                self.known.append((name, words, text))
                # So many words in a row are left whole by any differences that are allowed.
                run = -(-(n - _allowed(n)) // (_allowed(n) + 1))
                for at in range(n - run + 1):
                    self.seeds.setdefault(run, {}).setdefault(words[at : at + run], set()).add((k, at))
                    self.pairs.add(words[at : at + 2])

    def compressor(self, template: str):
        """Compressor with a template as raw dictionary; an empty one is none."""
        if template not in self.primed:
            if len(self.primed) > 1000:
                self.primed.clear()
            sizes = self.z.ZstdCompressionParameters.from_level(LEVEL, source_size=BLOCK, dict_size=len(template), write_content_size=False, write_dict_id=False)
            made = self.z.ZstdCompressionDict(template.lower().encode(), dict_type=self.z.DICT_TYPE_RAWCONTENT) if template else None
            if made:
                made.precompute_compress(compression_params=sizes)
            self.primed[template] = self.z.ZstdCompressor(dict_data=made, compression_params=sizes)
        return self.primed[template]

    def saved(self, block: bytes, template: str) -> int:
        """Bytes of a block that a template saves as dictionary."""
        return len(self.compressor("").compress(block)) - len(self.compressor(template).compress(block))

    def gain(self, stretch: str, template: str) -> int:
        """Bytes of a stretch that a template saves, less those of the template that the stretch leaves open."""
        return self.saved(stretch.lower().encode(), template) - len(self.compressor(stretch).compress(template.lower().encode()))

    def block(self, text: str) -> list[tuple[str, float, int, list[str]]]:
        """Confirmed licenses of a block: name, saving, word differences, the words that differ."""
        found = _words(text)
        words = [w.group().lower() for w in found]
        places = set()
        for i, pair in enumerate(zip(words, words[1:])):
            if pair in self.pairs:
                for run, seeds in self.seeds.items():
                    for k, at in seeds.get(tuple(words[i : i + run]), ()):
                        places.add((k, i - at))
        ends = [w.end() for w in found]
        starts = [w.start() for w in found]
        ranked = []
        for k, at in places:
            # The candidate block of a notice: as many words as it has, where it would lie.
            low, high = max(0, at), min(len(words), at + len(self.known[k][1]))
            block = text[starts[low] : ends[high - 1]].lower().encode()
            saved = self.saved(block, self.known[k][2])
            if saved > 0:
                ranked.append((-saved, k, at))
        fits, tried = {}, set()
        for _, k, at in sorted(ranked):
            for low, high, differ, apart in self.confirmed(words, k, at, tried):
                if (k, low, high) not in fits:
                    gain = self.gain(text[starts[low] : ends[high - 1]], self.known[k][2])
                    fits[k, low, high] = (-gain, differ, low, high, k, apart)
        # A place goes to the notice that gains most of the stretch that it is found in.
        out, taken = [], bytearray(len(words))
        for _, differ, low, high, k, apart in sorted(fits.values()):
            if not any(taken[low:high]):
                taken[low:high] = b"\1" * (high - low)
                out.append((low, high, self.known[k][0], self.known[k][2], differ, list(apart)))
        for at, name in tags(text):
            low = bisect_right(starts, at) - 1
            out.append((low, low + 1, name, f"SPDX-License-Identifier: {name}", 0, []))
        rows = []
        for low, high, name, template, differ, apart in sorted(out, key=lambda f: (f[0], f[2])):
            stretch = text[starts[low] : ends[high - 1]].lower().encode()
            rows.append((name, self.saved(stretch, template) / len(stretch), differ, apart))
        return rows

    def confirmed(self, words: list[str], k: int, at: int, tried: set) -> list[tuple[int, int, int, tuple[str, ...]]]:
        """(low, high, differences, differing words) where a block holds a template near ``at``, but for allowed differences."""
        template = self.known[k][1]
        if at >= 0 and tuple(words[at : at + len(template)]) == template:
            return [(at, at + len(template), 0, ())]
        spare = _allowed(len(template))
        low, high = max(0, at - spare), min(len(words), at + len(template) + spare)
        if (k, low, high) in tried:
            return []
        tried.add((k, low, high))
        fits = []
        for start, end, differ in aligned(words[low:high], template, spare):
            own = words[low + start : low + end]
            apart = set(own) ^ set(template)
            if not any(map(_TELLING.search, apart if len(template) < BODY else set(template) - set(own))):
                fits.append((low + start, low + end, differ, tuple(sorted(apart))))
        return fits


def aligned(words: list[str], template: tuple[str, ...], most: int) -> list[tuple[int, int, int]]:
    """(start, end, differences) of the runs of words nearest to a template, of each start and end the best.

    Differences are words changed, left out or put in, as the least number of them.
    """
    if not most:
        n = len(template)
        return [(i, i + n, 0) for i in range(len(words) - n + 1) if tuple(words[i : i + n]) == template]
    # Rows of the table are template words: a cell has the differences and, negative, the start.
    row = [(0, -j) for j in range(len(words) + 1)]
    for i, t in enumerate(template, 1):
        new = [(i, 0)]
        for j, w in enumerate(words, 1):
            d, s = row[j - 1]
            best = (d + (w != t), s)
            for d, s in (row[j], new[j - 1]):
                if (d + 1, s) < best:
                    best = (d + 1, s)
            new.append(best)
        row = new
    least = min(d for d, _ in row)
    return [(-s, j, d) for j, (d, s) in enumerate(row) if d == least] if least <= most else []


FOUND = ArrayType(StructType([StructField("start", IntegerType()), StructField("length", IntegerType()), StructField("license", StringType()), StructField("saving", DoubleType()), StructField("word_differences", IntegerType()), StructField("differing_words", ArrayType(StringType()))]))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, start, length, license, saving, word_differences, differing_words of every notice.

    ``start`` and ``length`` are code points of the block within the whole text. Texts without a
    cue give no rows, as null and empty ones and an empty table do; very long texts are scanned
    whole, in blocks around cues; repeated rows are scanned as rows of their own; other columns are not read.
    Of templates that fit one place the one that gains most bytes there counts; a notice that is
    there several times gives as many rows. ``saving`` is the part of the notice's bytes that its template saves as dictionary.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("license", pa.string()), ("saving", pa.float64()), ("word_differences", pa.int32()), ("differing_words", pa.list_(pa.string()))]))

    def compute():
        scanner = Scanner()
        known: dict[str, list] = {}

        def block(body: str) -> list:
            if len(known) > 20_000:
                known.clear()
            if body not in known:
                known[body] = scanner.block(body)
            return known[body]

        def run(texts):
            out = []
            for t in texts:
                own = []
                for low, high in blocks(t or ""):
                    own += [{"start": low, "length": high - low, "license": n, "saving": s, "word_differences": d, "differing_words": w} for n, s, d, w in block(t[low:high])]
                out.append(own)
            return [pa.array(out, kind)]

        return run

    found = map_texts(docs, text, [StructField("found", FOUND)], compute, ["doc_id"])
    return found.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")
