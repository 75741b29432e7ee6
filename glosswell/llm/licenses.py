"""Licence notices and texts inside documents, by conditional compression.

Words that licences use are gathered into blocks with their neighbours, as many words on both sides as
a window of the longest template has; lines, sentences and comment marks do not count. A block is
looked at in all windows of each template's size that hold the names of its licence. They are compressed
alone and with the template as a raw dictionary; those that get shorter by enough of what the template
saves on itself are ranked, and from the best on confirmed by their exact wording: the words of the
template that the window lacks, and those it adds in between, must be few, and none that tells this
licence from another or its version.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.llm.common import map_rows

#: Every template has a hint among its names, or more hints than words that may be missing.
HINTS = re.compile(r"licen[sc]|copyright|warrant|distribut|permission|public|spdx|\bgnu\b|apache|mozilla|\bcc0?\b", re.I)
TOKENS = re.compile(r"[^\W_]+")
#: Comment marks that are words.
MARKS = re.compile(r"^[ \t]*(?:dnl|rem|c)(?=[ \t])", re.I | re.M)


@dataclass(frozen=True)
class Template:
    license: str
    text: str
    #: Words without which it is another licence.
    names: tuple[str, ...]


# Public wordings of notices and of the licences' own terms.
TEMPLATES = (
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0.", ("apache", "2", "0")),
    Template(
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
        ("apache", "2", "0"),
    ),
    Template("Apache-2.0", "SPDX-License-Identifier: Apache-2.0", ("spdx", "apache", "2", "0")),
    Template("MIT", "Released under the MIT License.", ("mit",)),
    Template("MIT", "Licensed under the MIT License.", ("mit",)),
    Template(
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
        ("sublicense", "hereby", "substantial"),
    ),
    Template("MIT", "SPDX-License-Identifier: MIT", ("spdx", "mit")),
    Template(
        "GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", ("gnu", "general", "3")
    ),
    Template(
        "GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", ("gnu", "general", "2")
    ),
    Template(
        "LGPL-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        ("gnu", "lesser", "3"),
    ),
    Template(
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        ("gnu", "general", "3"),
    ),
    Template("CC-BY-4.0", "Licensed under CC BY 4.0.", ("cc", "by", "4", "0")),
    Template("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", ("cc", "by", "sa", "4", "0")),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", ("cc", "by", "nc", "4", "0")),
    Template(
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        ("creative", "attribution", "4", "0"),
    ),
    Template("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal.", ("cc0",)),
    Template(
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
        ("redistribution", "neither", "endorse"),
    ),
    Template(
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        ("mozilla", "2", "0"),
    ),
)


@dataclass(frozen=True)
class Settings:
    #: Share of a template's words that may be missing or added.
    most_missing: float = 0.15
    #: Least saving of a window, as a share of what its template saves on itself. Notices with as many words
    #: missing or added as allowed save 0.57 and more; prose with the names put in 0.2, rarely 0.6.
    least_saving: float = 0.5


def words_of(text: str) -> list[str]:
    return TOKENS.findall(text.lower())


@dataclass(frozen=True)
class Block:
    """Words with the place in the text where each begins and ends."""

    text: str
    words: list[str]
    begins: list[int]
    ends: list[int]

    def passage(self, first: int, last: int) -> str:
        return self.text[self.begins[first] : self.ends[last]]


def blocks(text: str | None, around: int) -> list[Block]:
    """Candidate blocks in order: hints with ``around`` words on both sides, joined where they meet."""
    if not text or not HINTS.search(text):
        return []
    plain = MARKS.sub(lambda m: " " * len(m[0]), text)
    found = [(m[0], *m.span()) for m in TOKENS.finditer(plain)]
    groups: list[list[int]] = []
    for i, (word, _, _) in enumerate(found):
        if HINTS.search(word):
            if groups and i - around <= groups[-1][1]:
                groups[-1][1] = i + around + 1
            else:
                groups.append([max(0, i - around), i + around + 1])
    return [
        Block(text, [w.lower() for w, _, _ in part], [b for _, b, _ in part], [e for _, _, e in part])
        for part in (found[first:end] for first, end in groups)
    ]


class Scanner:
    """Compressors for the templates, in one worker."""

    def __init__(self, templates: tuple[Template, ...], settings: Settings):
        import zstandard

        self.templates = templates
        self.words = [words_of(t.text) for t in templates]
        self.spare = [int(settings.most_missing * len(w)) for w in self.words]
        self.around = max(map(sum, zip(map(len, self.words), self.spare)), default=0)
        self.telling = {w for t in templates for w in t.names}
        raw = zstandard.DICT_TYPE_RAWCONTENT
        self.plain = zstandard.ZstdCompressor(level=9).compress
        self.given = [
            zstandard.ZstdCompressor(
                level=9, dict_data=zstandard.ZstdCompressionDict(" ".join(w).encode(), dict_type=raw)
            ).compress
            for w in self.words
        ]
        own = [" ".join(w).encode() for w in self.words]
        self.bounds = [settings.least_saving * (len(self.plain(x)) - len(given(x))) for x, given in zip(own, self.given)]

    def places(self, i: int, words: list[str]) -> list[int]:
        """Starts of the windows with all names of template ``i``; no confirmed wording is longer than a window."""
        size = min(len(words), len(self.words[i]) + self.spare[i])

        def held(which: list[bool]) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(which)])
            return upto[size:] - upto[: len(upto) - size]

        able = np.ones(len(words) - size + 1, bool)
        for name in self.templates[i].names:
            able &= held([w == name for w in words]) > 0
        return np.flatnonzero(able).tolist()

    def winners(self, i: int, words: list[str]) -> list[tuple[float, int]]:
        """(share of its compressed size that a window keeps, start) of the windows that template ``i`` makes
        shorter by enough, the best first."""
        size, ranked = len(self.words[i]) + self.spare[i], []
        for at in self.places(i, words):
            raw = " ".join(words[at : at + size]).encode()
            plain, given = len(self.plain(raw)), len(self.given[i](raw))
            if plain - given > self.bounds[i]:
                ranked.append((given / plain, at))
        return sorted(ranked)

    def confirmed(self, i: int, words: list[str]) -> dict | None:
        """The words that a window lacks and adds, if it has the wording of template ``i``."""
        template, wanted = self.templates[i], self.words[i]
        same = [m for m in SequenceMatcher(None, wanted, words, autojunk=False).get_matching_blocks() if m.size]
        matched = {j for m in same for j in range(m.a, m.a + m.size)}
        missing = [w for j, w in enumerate(wanted) if j not in matched]
        # Words put in between what matches.
        added = [w for m, n in zip(same, same[1:]) for w in words[m.b + m.size : n.b]]
        if (
            len(missing) + len(added) > self.spare[i]
            or set(missing) & set(template.names)
            or set(added) & self.telling - set(template.names)
        ):
            return None
        return {"license": template.license, "missing": missing, "added": added}

    def findings(self, block: Block) -> list[dict]:
        """Confirmed templates of a block, the largest saving first; of one licence the best."""
        words, best = block.words, {}
        present = set(words)
        for i, template in enumerate(self.templates):
            if not present.issuperset(template.names):
                continue
            size = len(self.words[i]) + self.spare[i]
            for kept, at in self.winners(i, words):
                found = self.confirmed(i, words[at : at + size])
                if found:
                    if kept < 1 - best.get(template.license, {"saving": -1})["saving"]:
                        last = min(at + size, len(words)) - 1
                        best[template.license] = found | {"saving": 1 - kept, "block": block.passage(at, last)}
                    break
        return sorted(best.values(), key=lambda f: -f["saving"])


def scan(
    documents: DataFrame, templates: tuple[Template, ...] = TEMPLATES, settings: Settings = Settings()
) -> DataFrame:
    """doc_id, n_blocks, licenses, findings: licences found in whole texts.

    ``n_blocks`` counts candidate blocks, ``licenses`` are the confirmed ones, distinct and in order,
    ``findings`` has each with its window of the block, the share of that window's compressed size that the template saves,
    and the words of the template that are missing and those put in between. One row per row of ``documents``, repeated or
    not. A null, empty or unsuspicious text has no blocks. Further columns are not read.
    """

    def work(part: pa.RecordBatch) -> dict:
        scanner = Scanner(templates, settings)
        out: dict = {"doc_id": part.column("doc_id"), "n_blocks": [], "licenses": [], "findings": []}
        for text in part.column("text").to_pylist():
            candidates = blocks(text, scanner.around)
            found = [f for block in candidates for f in scanner.findings(block)]
            out["n_blocks"].append(len(candidates))
            out["licenses"].append(sorted({f["license"] for f in found}))
            out["findings"].append(found)
        return out

    return map_rows(
        documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        work,
        "doc_id long, n_blocks long, licenses array<string>, "
        "findings array<struct<license:string,saving:double,missing:array<string>,added:array<string>,block:string>>",
        "text",
    )
