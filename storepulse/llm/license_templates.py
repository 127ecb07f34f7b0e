"""License scans by matching marked-up templates (operator 9).

A template is a license text with two kinds of markup:

    <<optional>> ... <</optional>>   wording that may be there, as a whole, or not (may be nested)
    <<words 0 6>>                    a replaceable region of 0 to 6 words, whatever they are

Each template is compiled into an automaton over words (case, punctuation and
white space don't count).  It accepts a run of words if the mandatory wording
stands there exactly, in order, with the optional parts whole or left out and
the replaceable regions within their bounds.  From each start the longest run
counts; runs of one template don't overlap.

A word is what ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` finds after A-Z are
lower-cased, compared by its 64-bit hash.  Fixed phrases are found over whole
blocks by vector comparison; the automata run only in texts that have every
mandatory word of the template, from the words it can start with.

Defined results: null text is empty (no words, no places, score 0); repeated
rows and null ids are scanned one by one; overlapping phrases all count; an
empty table gives an empty result; columns of the input named like an output
are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import license_texts
from .frames import map_arrow, unused, without
from .textbytes import LOWER, blocks, column_bytes, hashes, spans

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = True
_WORD[0x61:0x7B] = True
_WORD[0x80:] = True

#: Fixed phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_UNDER = ("<<optional>><<optional>><<optional>>you can<</optional>> redistribute it and/or modify it<</optional>>"
          "<<optional>>licensed<</optional>><<optional>>released<</optional>><<optional>>distributed<</optional>> "
          "under the <<optional>>terms of the<</optional>><</optional>>")
_LATER = "<<optional>>or (at your option) any later version<</optional>>"
_GPL = (_UNDER + "GNU general public license <<optional>>, as published by the free software foundation,<</optional>> "
        "<<optional>>either<</optional>> version {0} <<optional>>of the license<</optional>>" + _LATER)
_CC = "<<optional>>licensed under <<optional>>a<</optional>><<optional>>the<</optional>><</optional>>"

#: Templates and the labels they add.
TEMPLATES = {
    "mit-notice": "<<optional>>this <<words 1 3>> is<</optional>> released under the <<optional>>terms of the<</optional>> MIT license",
    "mit-text": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: <<optional>>The above copyright notice and this permission notice
        <<optional>>(including the next paragraph)<</optional>> shall be included in all copies or substantial
        portions of the Software.<</optional>>
        <<optional>>The software is provided "as is", without warranty of any kind, express or implied, including but
        not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no
        event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an
        action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or
        other dealings in the software.<</optional>>""",
    "apache-notice": "licensed under the Apache license <<optional>>, version 2.0<</optional>><<optional>>(the "
                     "\"License\")<</optional>>",  # whatever the version
    "apache-2.0": _UNDER + """ Apache license <<optional>>, version<</optional>> 2.0 <<optional>>(the "License")<</optional>>
        <<optional>>; you may not use this file except in compliance with the License. You may obtain a copy of the
        License at <<words 0 10>> Unless required by applicable law or agreed to in writing, software distributed under
        the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
        implied. See the License for the specific language governing permissions and limitations under the
        License.<</optional>>""",
    "apache-2.0-text": license_texts.APACHE_2,
    "gpl-3.0": _GPL.format(3),
    "gpl-3.0-text": license_texts.GPL_3,
    "gpl-2.0": _GPL.format(2),
    "gpl-2.0-text": license_texts.GPL_2,
    "cc-by-4.0": _CC + "<<optional>>creative commons<</optional>> CC BY 4.0",
    "cc-by-nc-4.0": _CC + "<<optional>>creative commons<</optional>> CC BY-NC 4.0",
    "cc-by-sa-4.0": _CC + "<<optional>>creative commons<</optional>> CC BY-SA 4.0",
    "all-rights-reserved": "<<optional>>copyright <<words 0 8>><</optional>> all rights reserved",
}

_CC_NAME = (_CC + "creative commons attribution {0} 4.0 <<optional>>international<</optional>> "
            "<<optional>><<optional>>public<</optional>> license<</optional>>")

#: Other wordings of the notices above: label and template.
WORDINGS = [
    ("mit-notice", "licensed under the <<optional>>terms of the<</optional>> MIT license"),
    ("mit-notice", "distributed under the <<optional>>terms of the<</optional>> MIT license"),
    ("mit-notice", "SPDX-License-Identifier: MIT"),
    ("apache-2.0", _UNDER + "Apache license version 2"),
    ("apache-2.0", _UNDER + "Apache license v2 <<optional>>0<</optional>>"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    *((f"gpl-{n}.0", t.format(n)) for n in (3, 2) for t in (
        _UNDER + "GNU general public license v{0} <<optional>>0<</optional>>" + _LATER,
        "version {0} of the GNU general public license" + _LATER,
        "GNU GPL <<optional>>version<</optional>> {0}",
        "GNU GPL v{0}",
        "SPDX-License-Identifier: GPL-{0}.0 <<optional>>only<</optional>><<optional>>or later<</optional>>")),
    *((f"cc-by{k}-4.0", t) for k, names in (("", [""]), ("-nc", ["noncommercial", "non commercial"]), ("-sa", ["sharealike", "share alike"]))
      for t in (*map(_CC_NAME.format, names), f"SPDX-License-Identifier: CC-BY{k}-4.0")),
]


def word_hashes(text: str) -> list[int]:
    """Hashes of the words of a template's or phrase's wording."""
    data, at = column_bytes(pa.array([text]))
    data = LOWER[data]
    start, end, _ = spans(_WORD[data], at)
    return hashes(data, start, end).tolist()


@dataclass
class Automaton:
    """States with moves by word (None: any word) and moves without a word; state 0 starts, the last accepts."""

    moves: list[dict[int | None, list[int]]] = field(default_factory=lambda: [{}])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    mandatory: set[int] = field(default_factory=set)

    def _state(self) -> int:
        self.moves.append({})
        self.free.append([])
        return len(self.moves) - 1

    def _step(self, at: int, word: int | None) -> int:
        to = self._state()
        self.moves[at].setdefault(word, []).append(to)
        return to

    def _reach(self, states) -> frozenset[int]:
        seen, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.add(s)
                todo += self.free[s]
        return frozenset(seen)

    def starts(self) -> set[int | None]:
        """Words a match can begin with."""
        return {w for s in self._reach([0]) for w in self.moves[s]}

    def longest(self, words: np.ndarray, start: int) -> int:
        """End of the longest accepted run of words from ``start``; -1 if there is none."""
        accept, end = len(self.moves) - 1, -1
        now, at = self._reach([0]), start
        while now:
            if accept in now:
                end = at
            if at == len(words):
                break
            w = int(words[at])
            now = self._reach([t for s in now for key in (w, None) for t in self.moves[s].get(key, ())])
            at += 1
        return end if end > start else -1


def compiled(template: str) -> Automaton:
    """The automaton of a marked-up template."""
    out, at, opened = Automaton(), 0, []
    for part in re.split(r"(<<[^<>]*>>)", template):
        if part == "<<optional>>":
            opened.append(at)
        elif part == "<</optional>>":
            if not opened:
                raise ValueError("<</optional>> without <<optional>>")
            end = out._state()
            out.free[at].append(end)
            out.free[opened.pop()].append(end)
            at = end
        elif m := re.fullmatch(r"<<words (\d+) (\d+)>>", part):
            least, most = int(m[1]), int(m[2])
            ends = []
            for k in range(most + 1):
                if k >= least:
                    ends.append(at)
                at = out._step(at, None) if k < most else at
            end = out._state()
            for s in ends:
                out.free[s].append(end)
            at = end
        elif part.startswith("<<"):
            raise ValueError(f"unknown markup {part}")
        else:
            for w in word_hashes(part):
                at = out._step(at, w)
                if not opened:
                    out.mandatory.add(w)
    if opened:
        raise ValueError("<<optional>> is not closed")
    end = out._state()
    out.free[at].append(end)
    if not out.mandatory:
        raise ValueError("a template needs mandatory wording")
    return out


class Scanner:
    """Compiled phrases and templates."""

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]]):
        self.phrases = [(np.array(word_hashes(p), np.uint64), label) for p, label in phrases.items()]
        self.automata = []  # (label, automaton, words a match begins with; None if any can)
        for label, t in templates:
            a = compiled(t)
            starts = a.starts()
            self.automata.append((label, a, None if None in starts else np.array(sorted(starts), np.uint64)))
        wanted = {w for _, a, _ in self.automata for w in a.mandatory}
        self.wanted = np.array(sorted(wanted), np.uint64)

    def scan(self, column: pa.Array) -> tuple[np.ndarray, list[list[dict]], np.ndarray]:
        """(words, places, share of words within a place) of each text."""
        n_words, share = np.zeros(len(column), np.int64), np.zeros(len(column))
        places: list[list[dict]] = [[] for _ in range(len(column))]
        for lo, hi, data, at in blocks(column):
            data = LOWER[data]
            start, end, row = spans(_WORD[data], at)
            h = hashes(data, start, end)
            n = hi - lo
            size = np.bincount(row, minlength=n)
            first = np.cumsum(size) - size
            n_words[lo:hi] = size
            for wording, label in self.phrases:
                k = wording.size
                if h.size < k:
                    continue
                hit = row[:h.size - k + 1] == row[k - 1:]
                for j, w in enumerate(wording):
                    hit &= h[j:h.size - k + 1 + j] == w
                for i in np.flatnonzero(hit).tolist():
                    r = int(row[i])
                    places[lo + r].append({"label": label, "base": True, "first": i - int(first[r]), "end": i - int(first[r]) + k})
            for r in self._rows_with_all(h, row, n):
                own = h[first[r]:first[r] + size[r]]
                have = set(own[np.isin(own, self.wanted)].tolist())
                for label, a, starts in self.automata:
                    if not a.mandatory <= have:
                        continue
                    at_words = range(own.size) if starts is None else np.flatnonzero(np.isin(own, starts)).tolist()
                    until = 0
                    for i in at_words:
                        if i >= until and (e := a.longest(own, i)) > 0:
                            places[lo + r].append({"label": label, "base": False, "first": i, "end": e})
                            until = e
            for r in range(lo, hi):
                if places[r]:
                    covered = np.zeros(n_words[r], bool)
                    for p in places[r]:
                        covered[p["first"]:p["end"]] = True
                    share[r] = covered.mean()
        return n_words, places, share

    def _rows_with_all(self, h: np.ndarray, row: np.ndarray, n: int) -> list[int]:
        """Rows that have every mandatory word of some template."""
        if not h.size or not self.wanted.size:
            return []
        at = np.minimum(np.searchsorted(self.wanted, h), self.wanted.size - 1)
        i = np.flatnonzero(self.wanted[at] == h)
        have = np.zeros((n, self.wanted.size), bool)
        have[row[i], at[i]] = True
        some = np.zeros(n, bool)
        for _, a, _ in self.automata:
            some |= have[:, np.searchsorted(self.wanted, np.array(sorted(a.mandatory), np.uint64))].all(1)
        return np.flatnonzero(some).tolist()


PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()),
                      T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
OUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(PLACE)),
                    T.StructField("score", T.DoubleType())])


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None,
         text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (all, if None), number of words, places and the share of words within them.

    A place has its label, whether a fixed phrase (``base``) or a template, and the words [first, end).
    """
    given_templates = [*TEMPLATES.items(), *WORDINGS] if templates is None else list(templates.items())
    scanner = Scanner(PHRASES if phrases is None else phrases, given_templates)
    fields = without(docs.select(*(docs.columns if carry is None else carry)).schema, OUT.names)
    names = [f.name for f in fields]
    place = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first", pa.int64()), ("end", pa.int64())]))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, places, share = scanner.scan(batch.column(batch.num_columns - 1))
        made = [pa.array(n), pa.array(places, place), pa.array(share)]
        return pa.RecordBatch.from_arrays([*batch.columns[:len(names)], *made], [*names, *OUT.names])

    given = docs.select(*names, F.col(text).cast("string").alias(unused(docs, "text_of_row")))
    return map_arrow(given, one, T.StructType([*fields, *OUT.fields]))
