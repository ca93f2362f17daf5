"""License scan by template markup.

A template is license wording with optional regions ``[[ ... ]]`` and
replaceable regions ``{{n}}`` (at most n words of any kind).  It is compiled to
a token automaton; a text is accepted where all mandatory words stand exactly,
in order.  A template is tried only where its first mandatory words stand, so a
text costs one pass plus the automaton steps at those places.

Words are runs of [0-9a-z] and non-ASCII characters after lower-casing A-Z.
``base`` phrases are counted at every place.  The score is 1 where a phrase or
a whole template was found, else the largest part of a template's mandatory
words that was matched from its start before it failed.

Defined cases: null and empty texts have no words, no places (first_word and
last_word null), empty labels and score 0; repeated rows and extra columns do
not matter; very long texts are scanned whole.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import text_chunks
from .common import in_batches

# Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_MIT_WARRANTY = ("the software is provided as is without warranty of any kind express or implied including but not limited to the "
                 "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {{16}} be "
                 "liable for any claim damages or other liability whether in an action of contract tort or otherwise arising "
                 "from out of or in connection with the software or the use or other dealings in the software")
_BSD_CONDITIONS = ("redistribution and use in source and binary forms with or without modification are permitted provided that "
                   "the following conditions are met [[1]] redistributions of source code must retain the above copyright "
                   "notice this list of conditions and the following disclaimer [[2]] redistributions in binary form must "
                   "reproduce the above copyright notice this list of conditions and the following disclaimer in the "
                   "documentation and or other materials provided with the distribution ")
_BSD_WARRANTY = (" this software is provided by {{16}} as is and any express or implied warranties including but not limited to "
                 "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event "
                 "shall {{16}} be liable for any direct indirect incidental special exemplary or consequential damages "
                 "including but not limited to procurement of substitute goods or services loss of use data or profits or "
                 "business interruption however caused and on any theory of liability whether in contract strict liability or "
                 "tort including negligence or otherwise arising in any way out of the use of this software even if advised of "
                 "the possibility of such damage")

# Wording of public licenses (mit, isc, bsd and zlib to the end of
# the mandatory wording) and usual notices.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
            "permit persons to whom the software is furnished to do so subject to the following conditions the above "
            "copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies "
            "or substantial portions of the software " + _MIT_WARRANTY),
    ("mit", "released under the mit license"),
    ("isc", "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies the "
            "software is provided as is and {{16}} disclaims all warranties with regard to this software including all implied "
            "warranties of merchantability and fitness in no event shall {{16}} be liable for any special direct indirect or "
            "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action "
            "of contract negligence or other tortious action arising out of or in connection with the use or performance of "
            "this software"),
    ("bsd-2", _BSD_CONDITIONS + _BSD_WARRANTY),
    ("bsd-3", _BSD_CONDITIONS + "[[3]] neither the name of {{12}} nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission" + _BSD_WARRANTY),
    ("apache-2", "licensed under the apache license version 2 [[0]] [[the license]]"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-2", "gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3", "gnu general public license version 3"),
    ("gpl-3", "gnu general public license as published by the free software foundation either version 3 of the license"),
    ("lgpl-2.1", "gnu lesser general public license [[as published by the free software foundation either]] version 2 1"),
    ("lgpl-3", "gnu lesser general public license [[as published by the free software foundation either]] version 3"),
    ("agpl-3", "gnu affero general public license [[as published by the free software foundation either]] version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", "mozilla public license version 2 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be "
             "held liable for any damages arising from the use of this software permission is granted to anyone to use "
             "this software for any purpose including commercial applications and to alter it and redistribute it freely "
             "subject to the following restrictions [[1]] the origin of this software must not be misrepresented you must not "
             "claim that you wrote the original software if you use this software in a product an {{1}} in the product "
             "documentation would be appreciated but is not required [[2]] altered source versions must be plainly marked as "
             "such and must not be misrepresented as being the original software [[3]] this notice may not be removed or "
             "altered from any source distribution"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "creative commons [[cc0]] {{3}} public domain dedication"),
    ("cc-by", "creative commons attribution [[{{1}} 0]] international license"),
    ("cc-by-sa", "creative commons attribution share alike [[{{1}} 0]] international license"),
    ("cc-by-sa", "creative commons attribution sharealike [[{{1}} 0]] international license"),
    ("cc-by-nc", "creative commons attribution non commercial [[{{1}} 0]] international license"),
    ("cc-by-nc", "creative commons attribution noncommercial [[{{1}} 0]] international license"),
    ("cc-by-nc", "licensed under cc by nc [[{{1}} 0]]"),
]

ANCHOR_WORDS = 3
# bytes -> bytes: A-Z to lower case, everything outside words to a space
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))


def parse(markup: str) -> list:
    """Nodes of a template: a word, an int (replaceable words) or a list (optional)."""
    stack: list[list] = [[]]
    for token in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", markup):
        if token == "[[":
            stack.append([])
        elif token == "]]":
            if len(stack) < 2:
                raise ValueError(f"unbalanced markup: {markup}")
            region = stack.pop()
            stack[-1].append(region)
        elif token.startswith("{{"):
            stack[-1].append(int(token[2:-2]))
        else:
            stack[-1].append(token.encode())
    if len(stack) != 1:
        raise ValueError(f"unbalanced markup: {markup}")
    return stack[0]


class TokenAutomaton:
    """Nondeterministic automaton over words; states are numbered, state 0
    starts.  ``depth`` holds the mandatory words behind each state."""

    def __init__(self, label: str, markup: str):
        self.label = label
        self.words: list[dict[bytes, int]] = [{}]
        self.any: list[int | None] = [None]
        self.skip: list[list[int]] = [[]]
        self.depth = [0]
        nodes = parse(markup)
        self.final = self._build(0, nodes, True)
        self.mandatory = max(self.depth)
        lead = []
        for node in nodes:
            if not isinstance(node, bytes) or len(lead) == ANCHOR_WORDS:
                break
            lead.append(node)
        if not lead:
            raise ValueError(f"a template starts with a mandatory word: {markup}")
        self.anchor = b" " + b" ".join(lead) + b" "

    def _state(self, depth: int) -> int:
        self.words.append({})
        self.any.append(None)
        self.skip.append([])
        self.depth.append(depth)
        return len(self.words) - 1

    def _build(self, at: int, nodes: list, mandatory: bool) -> int:
        for node in nodes:
            if isinstance(node, bytes):
                new = self._state(self.depth[at] + mandatory)
                self.words[at][node] = new
            elif isinstance(node, int):
                new = self._state(self.depth[at])
                self.skip[at].append(new)
                step = at
                for _ in range(node):
                    following = self._state(self.depth[at])
                    self.any[step] = following
                    self.skip[following].append(new)
                    step = following
            else:
                inner = self._state(self.depth[at])
                self.skip[at].append(inner)
                end = self._build(inner, node, False)
                new = self._state(self.depth[at])
                self.skip[at].append(new)
                self.skip[end].append(new)
            at = new
        return at

    def _closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def match(self, words: list[bytes], at: int) -> float:
        """1.0 if the words from ``at`` on are accepted, else the matched part
        of the mandatory wording."""
        states, best = self._closure({0}), 0
        for i in range(at, len(words) + 1):
            if self.final in states:
                return 1.0
            best = max(best, max((self.depth[s] for s in states), default=0))
            if i == len(words) or not states:
                break
            moved = {self.words[s][words[i]] for s in states if words[i] in self.words[s]}
            moved |= {self.any[s] for s in states if self.any[s] is not None}
            states = self._closure(moved)
        return best / self.mandatory


def _places(joined: bytes, phrase: bytes) -> list[int]:
    """Word positions where ``phrase`` (with its outer spaces) stands."""
    out, at, counted, word = [], joined.find(phrase), 0, 0
    while at >= 0:
        word += joined.count(b" ", counted, at)
        counted = at
        out.append(word)
        at = joined.find(phrase, at + 1)
    return out


class LicenseScanner:
    def __init__(self, templates=None, base=None):
        self.automata = [TokenAutomaton(label, markup) for label, markup in (templates or TEMPLATES)]
        self.base = [(b" " + p.encode() + b" ", label) for p, label in (BASE if base is None else base).items()]

    def scan(self, text: str) -> tuple:
        words = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split(b" ")
        words = [w for w in words if w]
        joined = b" " + b" ".join(words) + b" "
        base_labels, places = set(), []
        for phrase, label in self.base:
            if phrase in joined:
                found = _places(joined, phrase)
                places += found
                base_labels.add(label)
        labels, score = set(base_labels), 1.0 if base_labels else 0.0
        for automaton in self.automata:
            if automaton.label in labels and score == 1.0 or automaton.anchor not in joined:
                continue
            for at in _places(joined, automaton.anchor):
                part = automaton.match(words, at)
                score = max(score, part)
                if part == 1.0:
                    labels.add(automaton.label)
                    break
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base_labels)), ",".join(sorted(labels)), score)


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double")


def scan_documents(docs: DataFrame, templates=None, base=None) -> DataFrame:
    """License findings of every document of ``docs`` (doc_id, text)."""

    def work(batches):
        scanner = LicenseScanner(templates, base)
        for batch in batches:
            rows = [scanner.scan(t) for texts in text_chunks(batch.column(1)) for t in texts]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=[f.split()[0] for f in SCHEMA.split(", ")])

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, SCHEMA)
