"""License scan by templates with optional and replaceable regions.

A template is its wording with markup: ``[[optional words]]`` may be missing,
``<<n>>`` stands for up to n words of any kind (not at the beginning), everything else is mandatory and has to
match exactly, in order. Each template is compiled into an automaton over words; it is
run from every place where it can begin, and accepts the longest stretch it can. Three
short phrases give base labels wherever their words stand consecutively.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Null texts are
empty; an empty text has no words, no labels and score 0. Repeated rows give repeated
rows, an empty table an empty result, and further columns are ignored. The score is the
share of the text's words inside accepted stretches and base phrases.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import LOWER, chunks, words_of

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Own labels; the wording is that of common notices and of the licences' standard headers.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license [[version]] 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    ],
    "mit": [
        "[[released]] [[licensed]] under the [[terms of the]] mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    ],
    "gpl-3.0": [
        "licensed under [[the terms of]] the gnu general public license [[version]] [[v]] 3",
        "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or [[at your option]] any later version",
    ],
    "gpl-2.0": [
        "licensed under [[the terms of]] the gnu general public license [[version]] [[v]] 2",
        "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or [[at your option]] any later version",
    ],
    "cc-by-4.0": ["licensed under [[a]] [[the]] [[creative commons]] cc by 4 0"],
    "cc-by-sa-4.0": ["licensed under [[a]] [[the]] [[creative commons]] cc by sa 4 0"],
    "cc-by-nc-4.0": ["licensed under [[a]] [[the]] [[creative commons]] cc by nc 4 0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "copyright-notice": ["copyright <<8>> all rights reserved"],
}

# Wording of common short licences, with holders and names replaceable.
_BSD_HEAD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "[[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "[[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation "
    "and or other materials provided with the distribution "
)
_BSD_TAIL = (
    "this software is provided by <<8>> as is and any express or implied warranties including but not limited to the implied warranties of merchantability "
    "and fitness for a particular purpose are disclaimed in no event shall <<8>> be liable for any direct indirect incidental special exemplary or "
    "consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of "
    "the use of this software even if advised of the possibility of such damage"
)
FULL_TEXTS = {
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in "
        "the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of "
        "the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this "
        "permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software the software is provided as "
        "is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and "
        "noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract "
        "tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
    ),
    "isc-text": (
        "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided that the above "
        "copyright notice and this permission notice appear in all copies the software is provided as is and <<6>> disclaims all warranties with regard to this "
        "software including all implied warranties of merchantability and fitness in no event shall <<6>> be liable for any special direct indirect or "
        "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other "
        "tortious action arising out of or in connection with the use or performance of this software"
    ),
    "bsd-2-clause-text": _BSD_HEAD + _BSD_TAIL,
    "bsd-3-clause-text": _BSD_HEAD + (
        "[[3]] neither the name of <<8>> nor the names of [[its]] contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission "
    ) + _BSD_TAIL,
    "apache-2.0-notice": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the "
        "license at [[http]] [[https]] www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific "
        "language governing permissions and limitations under the license"
    ),
    "gpl-3.0-notice": (
        "this [[program]] [[software]] [[library]] is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
        "foundation either version 3 of the license or [[at your option]] any later version <<2>> is distributed in the hope that it will be useful but without "
        "any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"
    ),
    "zlib-text": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use "
        "of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
        "redistribute it freely subject to the following restrictions [[1]] the origin of this software must not be misrepresented you must not claim that you "
        "wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not "
        "required [[2]] altered source versions must be plainly marked as such and must not be misrepresented as being the original software [[3]] this notice "
        "may not be removed or altered from any source distribution"
    ),
}
TEMPLATES |= {label: [text] for label, text in FULL_TEXTS.items()}

#: Every template and phrase holds one of these words or begins with one; texts without them are only counted.
#: Texts lie side by side while hints are searched, so a match takes one byte and never hides the next text's hint.
_HINT = re.compile(rb"c(?=c|opyright)|l(?=icen[sc]e)|r(?=ights|edistribution)|p(?=ublic|ermission)")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_ANY = None


class Automaton:
    """Words-to-states table of one template. State k has read the first k items;
    ``skip`` has the states reached from a state without reading."""

    def __init__(self, template: str):
        self.steps: list[list[tuple[bytes | None, int]]] = [[]]
        self.skip: list[list[int]] = [[]]
        for optional, wild, word in re.findall(r"\[\[(.*?)\]\]|<<(\d+)>>|(\S+)", template):
            if wild:
                for _ in range(int(wild)):
                    self.skip[-1].append(len(self.steps))
                    self._read(_ANY)
            elif optional:
                begin = len(self.steps) - 1
                for w in optional.split():
                    self._read(w.encode())
                self.skip[begin].append(len(self.steps) - 1)
            else:
                self._read(word.encode())
        self.final = len(self.steps) - 1

    def _read(self, word: bytes | None) -> None:
        self.steps[-1].append((word, len(self.steps)))
        self.steps.append([])
        self.skip.append([])

    def _closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def firsts(self) -> set[bytes | None]:
        return {word for s in self._closed({0}) for word, _ in self.steps[s]}

    def match(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted stretch that begins at ``at``; -1 if none."""
        states, end = self._closed({0}), -1
        for k in range(at, len(words)):
            states = self._closed({to for s in states for word, to in self.steps[s] if word is _ANY or word == words[k]})
            if not states:
                break
            if self.final in states:
                end = k + 1
        return end


@lru_cache(maxsize=1)
def _compiled():
    begin: dict[bytes, list[tuple[str, bool, Automaton]]] = {}
    for base, table in ((True, {label: [phrase] for phrase, label in BASE.items()}), (False, TEMPLATES)):
        for label, templates in table.items():
            for template in templates:
                automaton = Automaton(template)
                for word in automaton.firsts():
                    begin.setdefault(word, []).append((label, base, automaton))
    return begin


def scan(words: list[bytes]) -> tuple[int, int | None, int | None, set[str], set[str], int]:
    """(places of base phrases, smallest and largest start, base labels, all labels, words covered)."""
    begin, starts, base_labels, labels, covered = _compiled(), [], set(), set(), set()
    for at, word in enumerate(words):
        for label, base, automaton in begin.get(word, ()):
            end = automaton.match(words, at)
            if end < 0:
                continue
            labels.add(label)
            covered.update(range(at, end))
            if base:
                starts.append(at)
                base_labels.add(label)
    return len(starts), min(starts, default=None), max(starts, default=None), base_labels, labels, len(covered)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of findings for each document; row by row, without a shuffle."""

    def work(batches):
        for batch in batches:
            rows = []
            for _, _, data, offsets in chunks(batch.column(1)):
                lower = LOWER[data]
                counts = words_of(lower, offsets, _INSIDE).counts
                raw = lower.tobytes()
                hits = np.fromiter((m.start() for m in _HINT.finditer(raw)), np.int64)
                hit = set((np.searchsorted(offsets, hits, side="right") - 1).tolist())
                for k, n in enumerate(counts.tolist()):
                    if k in hit:
                        found, low, high, base, labels, inside = scan(_WORD.findall(raw[offsets[k] : offsets[k + 1]]))
                    else:
                        found, low, high, base, labels, inside = 0, None, None, (), (), 0
                    rows.append((n, found, low, high, ",".join(sorted(base)), ",".join(sorted(labels)), inside / n if n else 0.0))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]], names=[id_col, *NAMES]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(work, schema)


NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
