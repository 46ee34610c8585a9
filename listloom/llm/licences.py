"""Licence scans by a generalised suffix automaton of licence tokens.

The automaton holds every run of words of the licence templates and phrases. A text streams through it once and gives its
matching statistics: at each word, the longest run of words up to there that some template has. Long maximal matches are
chained, in order both in the text and in a template, into covered spans of the template.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache
from itertools import repeat
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame

from listloom.llm.common import map_texts

#: Phrases whose places are counted, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Public licence texts and notices, by SPDX identifier. Short licences are whole, without titles and names; of
#: long ones it is the notice that their authors ask to put into files. read_templates() takes whole texts from a folder.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
     to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
     whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
     notice shall be included in all copies or substantial portions of the Software."""),
    ("MIT", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
     WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
     to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
     whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
     notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
     WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
     PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
     OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
     SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
     the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
     law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
     CONDITIONS OF ANY KIND, either express or implied."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
     License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
     This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
     MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to
     this software to the public domain worldwide. This software is distributed without any warranty."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
     License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("LGPL-2.1", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
     Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later
     version."""),
    ("LGPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General
     Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
     version."""),
    ("AGPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
     Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
     version."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
     distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
     following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
     and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
     conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS
     SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
     NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
     SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
     DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
     INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
     NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
     DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
     following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
     and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
     conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither
     the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
     software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
     AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR
     A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
     INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
     SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
     CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
     EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
     provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
     THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
     FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
     WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
     ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
     use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
     commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this
     software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit
     of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
     relinquishment in perpetuity of all present and future rights to this software under copyright law."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
     liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
     purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
     1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
     this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
     source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice
     may not be removed or altered from any source distribution."""),
]
#: A match of fewer words says nothing; words between two matches of a chain at most.
LEAST, GAP = 4, 24
#: Share of a template's words that a chain covers for the template's label.
COVER = 0.8
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str) -> list[bytes]:
    """Runs of digits, letters a-z and characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return _WORDS.findall(text.encode("utf-8", "replace").lower())


@dataclass
class State:
    length: int
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)
    #: Where in templates its strings end: (template, words up to there).
    ends: set[tuple[int, int]] = field(default_factory=set)
    #: Phrases that are suffixes of its strings: (words, phrase).
    phrases: list[tuple[int, int]] = field(default_factory=list)


class Automaton:
    """The generalised suffix automaton of token sequences."""

    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES):
        self.labels = [label for label, _ in templates]
        self.texts = [words(text) for _, text in templates]
        self.phrase_labels = list(phrases.values())
        sequences = self.texts + [words(p) for p in phrases]
        self.shortest = min([LEAST, *(len(words(p)) for p in phrases)])
        self.vocabulary: dict[bytes, int] = {}
        self.states = [State(0)]
        for t, sequence in enumerate(sequences):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)))
                self.states[last].ends.add((t, i + 1))
        order = sorted(range(1, len(self.states)), key=lambda v: -self.states[v].length)
        for v in order:  # an end of a state's strings is one of their suffixes', too
            self.states[self.states[v].link].ends |= self.states[v].ends
        for k in range(len(phrases)):
            at = 0
            for word in sequences[len(templates) + k]:
                at = self.states[at].next[self.vocabulary[word]]
            self.states[at].phrases.append((len(sequences[len(templates) + k]), k))
        for v in reversed(order):
            self.states[v].phrases += self.states[self.states[v].link].phrases
        for s in self.states:
            s.ends = {(t, i) for t, i in s.ends if t < len(templates)}
        self.steps = [s.next for s in self.states]

    def _extend(self, last: int, c: int) -> int:
        states = self.states
        if (q := states[last].next.get(c)) is not None:
            return q if states[q].length == states[last].length + 1 else self._clone(last, c, q)
        new = len(states)
        states.append(State(states[last].length + 1))
        p = last
        while p >= 0 and c not in states[p].next:
            states[p].next[c] = new
            p = states[p].link
        if p < 0:
            states[new].link = 0
        else:
            q = states[p].next[c]
            states[new].link = q if states[q].length == states[p].length + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        states = self.states
        copy = len(states)
        states.append(State(states[p].length + 1, states[q].link, dict(states[q].next)))
        states[q].link = copy
        while p >= 0 and states[p].next.get(c) == q:
            states[p].next[c] = copy
            p = states[p].link
        return copy

    def scan(self, text: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """(place, phrase) of every phrase, and (place, words, state) of every maximal match of LEAST words or more.

        Words that no template has end all matches, so only runs of known words, as long as the shortest phrase, go through
        the automaton.
        """
        n = len(text)
        ids = np.fromiter(map(self.vocabulary.get, text, repeat(-1)), np.int32, n)
        known = np.concatenate(([False], ids >= 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1]).reshape(-1, 2)
        edges = edges[edges[:, 1] - edges[:, 0] >= self.shortest]
        places: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int]] = []
        states, steps = self.states, self.steps
        for begin, end in edges.tolist():
            v = length = 0
            for i, c in enumerate(ids[begin:end].tolist(), begin):
                if (to := steps[v].get(c)) is None:
                    if length >= LEAST:
                        matches.append((i - length, length, v))
                    while (to := steps[v].get(c)) is None:
                        v = states[v].link
                        length = states[v].length
                v, length = to, length + 1
                for size, k in states[v].phrases:
                    if size <= length:
                        places.append((i + 1 - size, k))
            if length >= LEAST:
                matches.append((end - length, length, v))
        return places, matches

    def chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """(label, first word, word after the last, covered share) of the best chain that ends with each match, if it covers COVER of its template.

        A match may follow any earlier one that ends GAP words before it or later. Ends rise with the places, so going back
        from a match ends there: the work is bounded by GAP and the match's own length, and no predecessor is left out.
        """
        by: dict[int, list[tuple[int, int, int]]] = {}
        for at, length, v in matches:
            for t, stop in self.states[v].ends:
                if stop >= length:
                    by.setdefault(t, []).append((at, stop - length, length))
        out = []
        for t, found in by.items():
            found.sort()
            best: list[tuple[int, int]] = []  # words covered, where the chain begins
            for j, (at, place, length) in enumerate(found):
                own = (length, at)
                for i in range(j - 1, -1, -1):
                    a, p, m = found[i]
                    if at - a - m > GAP:
                        break
                    shared = max(0, a + m - at, p + m - place)  # overlapping words count once
                    if a < at and p < place and shared < length:
                        own = max(own, (best[i][0] + length - shared, best[i][1]), key=lambda x: (x[0], -x[1]))
                best.append(own)
                share = min(1.0, own[0] / len(self.texts[t]))
                if share >= COVER:
                    out.append((self.labels[t], own[1], at + length, share))
        return out

    def spans(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """chains() that do not lie within a longer one: a licence that repeats another's text is not that other."""
        out: list[tuple[str, int, int, float]] = []
        widest = (0, 0)
        for span in sorted(set(self.chains(matches)), key=lambda x: (x[1], -x[2], x[0], -x[3])):
            own = span[1:3]
            if own[1] > widest[1] or own == widest:
                widest = own
                out.append(span)
        return out

    def best_share(self, matches: list[tuple[int, int, int]]) -> float:
        """The largest share of a template that a single match or a chain of COVER covers."""
        single = max((min(1.0, length / len(self.texts[t])) for _, length, v in matches for t, _ in self.states[v].ends), default=0.0)
        return max([single, *(c[3] for c in self.chains(matches))]) if single < 1 else single


@cache
def automaton(templates: tuple[tuple[str, str], ...] = tuple(TEMPLATES)) -> Automaton:
    return Automaton(list(templates))


def read_templates(folder: str) -> list[tuple[str, str]]:
    """(label, text) of every file in a folder of licence texts; a file's name, without ".txt", is its label."""
    return [(path.name.removesuffix(".txt"), path.read_text(encoding="utf-8", errors="replace")) for path in sorted(Path(folder).iterdir()) if path.is_file() and not path.is_symlink()]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row.

    n_base counts every place where a phrase's words stand, first_word and last_word are the smallest and largest such
    place (null without one), score is the largest covered share of a template. Null texts have no words. Spans may overlap,
    but none lies within a longer one. Repeated rows give repeated results; other columns are left out. templates: (label,
    text) beside TEMPLATES.
    """
    known = (*TEMPLATES, *(templates or []))

    def rows() -> Callable[[list], list[tuple]]:
        found = automaton(known)

        def one(x: str | None) -> tuple:
            text = words(x) if x else []
            places, matches = found.scan(text) if text else ([], [])
            if not places and not matches:
                return len(text), 0, None, None, "", "", 0.0, []
            spans = found.spans(matches)
            base = {found.phrase_labels[k] for _, k in places}
            at = [i for i, _ in places]
            score = found.best_share(matches)
            return (
                len(text), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
                ",".join(sorted(base | {s[0] for s in spans})), score,
                [{"label": a, "first_word": b, "end": c, "share": d} for a, b, c, d in spans],
            )

        return lambda texts: [one(x) for x in texts]

    added = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<label:string,first_word:bigint,end:bigint,share:double>>"
    return map_texts(docs, text, [doc_id], added, rows)
