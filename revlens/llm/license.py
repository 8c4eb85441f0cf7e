"""Licence scan by template-markup matching.

A template is licence wording with markup: optional regions
``<<beginOptional>>...<<endOptional>>`` and replaceable regions
``<<var;words=a-b>>`` (a to b words of any text).  It is compiled into an
automaton over word tokens; a place of a text is accepted where all mandatory
words follow one another exactly, optional regions taken or left out and
replaceable regions filled.  Places may stand anywhere in the text.

Words are runs of ASCII digits and letters and of all characters from U+0080
on, A-Z lower-cased; all else separates words.

Defined results: a null text is empty.  Among places of one template that
begin at the same word the longest counts; places of a template do not
overlap (the leftmost counts).  Repeated rows give repeated results.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import map_texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})

#: Fixed phrases with their labels (the base of the scan).
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Fixed spellings that licence texts use for one another.
EQUIVALENT = {"licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing", "sublicence": "sublicense",
              "acknowledgement": "acknowledgment", "authorisation": "authorization", "organisation": "organization"}

#: Fixed wording of disclaimers, each an optional end of its licence.
MIT_END = """<<beginOptional>>THE <<var;words=1-6>> IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
    BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND <<var;words=1-4>>. IN NO EVENT
    SHALL <<var;words=1-10>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
    OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE <<var;words=1-6>> OR THE USE OR OTHER DEALINGS IN THE
    SOFTWARE.<<endOptional>>"""
BSD_END = """<<beginOptional>><<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above copyright notice,
    this list of conditions and the following disclaimer. <<beginOptional>>2<<endOptional>> Redistributions in binary form must
    reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
    materials provided with the distribution. <<beginOptional>><<beginOptional>>3<<endOptional>> Neither the name of
    <<var;words=1-12>> may be used to endorse or promote products derived from this software without specific prior written
    permission.<<endOptional>> <<beginOptional>>THIS SOFTWARE IS PROVIDED BY <<var;words=1-12>> "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
    DISCLAIMED. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
    CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS;
    OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
    (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
    DAMAGE.<<endOptional>><<endOptional>>"""
ISC_END = """<<beginOptional>>THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1-10>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
    SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;words=1-10>> BE LIABLE FOR ANY
    SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
    IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
    SOFTWARE.<<endOptional>>"""
APACHE_END = """<<beginOptional>>You may obtain a copy of the License at <<var;words=1-10>> Unless required by applicable law or agreed to in
    writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
    either express or implied. See the License for the specific language governing permissions and limitations under the
    License.<<endOptional>>"""
GPL_END = """<<beginOptional>><<beginOptional>>This program<<endOptional>> <<beginOptional>><<var;words=1-3>><<endOptional>> is distributed in
    the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
    PARTICULAR PURPOSE. See the GNU <<beginOptional>>Affero<<endOptional>> General Public License for more details.<<endOptional>>"""

#: Fixed wording of public licences and of their usual notices.
TEMPLATES = (
    ("mit", """<<beginOptional>>Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software <<beginOptional>>and associated documentation files (the "Software")<<endOptional>>, to deal in the
        <<var;words=1-6>> without restriction,<<endOptional>> including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the <<var;words=1-6>>, and to permit
        persons to whom the <<var;words=1-6>> is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>>
        shall be included in all copies or substantial portions of the <<var;words=1-6>>. """ + MIT_END),
    ("mit", "Released under the MIT License"),
    ("mit", "<<beginOptional>>is<<endOptional>> licensed under the <<beginOptional>>terms of the<<endOptional>> "
            "MIT <<beginOptional>>open source<<endOptional>> License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 <<beginOptional>>(the \"License\"); you may not use "
                 "this <<var;words=1-4>> except in compliance with the License " + APACHE_END + "<<endOptional>>"),
    ("gpl-3", "<<beginOptional>>is<<endOptional>> licensed under the <<beginOptional>>terms of the<<endOptional>> "
              "GNU General Public License, <<beginOptional>>as published by the Free Software Foundation, either"
              "<<endOptional>> version 3"),
    ("gpl-2", "<<beginOptional>>is<<endOptional>> licensed under the <<beginOptional>>terms of the<<endOptional>> "
              "GNU General Public License, <<beginOptional>>as published by the Free Software Foundation, either"
              "<<endOptional>> version 2"),
    ("gpl-3", """you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version """ + GPL_END),
    ("gpl-2", """you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
        version """ + GPL_END),
    ("agpl-3", """you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version """ + GPL_END),
    ("agpl-3", "licensed under the <<beginOptional>>terms of the<<endOptional>> GNU Affero General Public License, "
               "<<beginOptional>>as published by the Free Software Foundation, either<<endOptional>> version 3"),
    ("lgpl", "GNU Lesser General Public License <<beginOptional>>as published by the Free Software Foundation; "
             "either<<endOptional>> version <<var;words=1-2>>"),
    ("cc-by-nc", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> CC BY-NC "
                 "<<beginOptional>>4.0<<endOptional>>"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial <<var;words=1-2>> <<beginOptional>>International"
                 "<<endOptional>> License"),
    ("cc-by-sa", "licensed under <<beginOptional>>a<<endOptional>> CC BY-SA <<beginOptional>>4.0<<endOptional>>"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike <<var;words=1-2>> <<beginOptional>>International"
                 "<<endOptional>> License"),
    ("cc-by", "Creative Commons Attribution 4.0 <<beginOptional>>International<<endOptional>> License"),
    ("cc0", "Creative Commons CC0 1.0 Universal"),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted
        <<beginOptional>>(subject to the limitations in the disclaimer below)<<endOptional>> provided that the
        following conditions are met: """ + BSD_END),
    ("bsd", "licensed under <<beginOptional>>the<<endOptional>> <<beginOptional>>terms of the<<endOptional>> BSD "
            "<<beginOptional>>2-Clause<<endOptional>> <<beginOptional>>3-Clause<<endOptional>> License"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. """ + ISC_END),
    ("0bsd", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1-10>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will <<var;words=1-6>> be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
        purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: <<beginOptional>>1<<endOptional>> The origin of this software must not be misrepresented; you must not claim that
        you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be
        appreciated but is not required. <<beginOptional>>2<<endOptional>> Altered source versions must be plainly marked as such, and
        must not be misrepresented as being the original software. <<beginOptional>>3<<endOptional>> This notice may not be removed or
        altered from any source distribution."""),
    ("bsl-1", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit
        the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do
        so, all subject to the following"""),
    ("eupl", "licensed under the EUPL"),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
        <<beginOptional>>If a copy of the MPL was not distributed with this file, You can obtain one at
        <<var;words=1-8>><<endOptional>>"""),
    ("unlicense", """This is free and unencumbered software released into the public domain. <<beginOptional>>Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.<<endOptional>>"""),
    ("all-rights-reserved", "© <<var;words=1-8>> All rights reserved"),
    ("all-rights-reserved", "Copyright <<beginOptional>>(c)<<endOptional>> <<var;words=1-8>> All rights reserved"),
)

MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")


def words_of(text: str | None) -> list[str]:
    """A-Z lower-cased, then the words."""
    return WORD.findall((text or "").translate(LOWER))


class Automaton:
    """States are numbered nodes; ``word`` maps a node to {word: next node},
    ``free`` a node to its (next, any-word) moves, ``skip`` to moves without a word."""

    def __init__(self, markup: str):
        self.word: list[dict[str, list[int]]] = [{}]
        self.any: list[list[int]] = [[]]
        self.skip: list[list[int]] = [[]]
        self.mandatory = 0
        at, opened, pos = 0, [], 0
        for m in [*MARK.finditer(markup), None]:
            for w in map(lambda x: EQUIVALENT.get(x, x), words_of(markup[pos:m.start() if m else None])):
                at = self._step(at, w)
                self.mandatory += not opened
            if m is None:
                break
            pos = m.end()
            if m[1] == "beginOptional":
                opened.append(at)
            elif m[1] == "endOptional":
                self.skip[opened.pop()].append(at := self._join(at))
            else:
                least, most = int(m[2]), int(m[3])
                ends = []
                for k in range(most):
                    if k >= least:
                        ends.append(at)
                    new = self._node()
                    self.any[at].append(new)
                    at = new
                for e in ends:
                    self.skip[e].append(at)
        if opened:
            raise ValueError("an optional region is not closed")
        self.end = at
        self.close = [self._closure(s) for s in range(len(self.word))]
        self.starts = {w for s in self.close[0] for w in self.word[s]}
        if self.end in self.close[0] or any(self.any[s] for s in self.close[0]):
            raise ValueError("a template must begin with a word")

    def _node(self) -> int:
        self.word.append({})
        self.any.append([])
        self.skip.append([])
        return len(self.word) - 1

    def _step(self, at: int, w: str) -> int:
        new = self._node()
        self.word[at].setdefault(w, []).append(new)
        return new

    def _join(self, at: int) -> int:
        new = self._node()
        self.skip[at].append(new)
        return new

    def _closure(self, s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def longest(self, words: list[str], start: int) -> int:
        """End (exclusive) of the longest accepted place that begins at ``start``, or -1."""
        live, best = set(self.close[0]), -1
        for i in range(start, len(words)):
            w, new = words[i], set()
            for s in live:
                for t in self.word[s].get(w, ()):
                    new |= self.close[t]
                for t in self.any[s]:
                    new |= self.close[t]
            if not new:
                break
            if self.end in new:
                best = i + 1
            live = new
        return best


@lru_cache(maxsize=8)
def compiled(templates: tuple = TEMPLATES, phrases: tuple = PHRASES):
    """(automata by their possible first words, phrases by first word); built once in a worker."""
    by_first: dict[str, list[tuple[int, str, Automaton]]] = {}
    for k, (label, markup) in enumerate(templates):
        a = Automaton(markup)
        for w in a.starts:
            by_first.setdefault(w, []).append((k, label, a))
    base: dict[str, list[tuple[list[str], str]]] = {}
    for phrase, label in phrases:
        base.setdefault(phrase.split()[0], []).append((phrase.split(), label))
    return by_first, base, frozenset(by_first) | frozenset(base)


def scan(text: str | None, templates: tuple = TEMPLATES, phrases: tuple = PHRASES):
    """(words, base places [(start, end, label)], template places [(start, end, label)])."""
    by_first, base, first = compiled(templates, phrases)
    words = words_of(text)
    same = words if EQUIVALENT.keys().isdisjoint(words) else [EQUIVALENT.get(w, w) for w in words]  # for templates; phrases are exact
    found, placed = [], []
    free: dict[int, int] = {}  # template -> first word that its earlier places leave free
    if first.isdisjoint(same):
        return words, found, placed
    for i in [k for k, w in enumerate(same) if w in first]:
        w = same[i]
        for phrase, label in base.get(w, ()):
            if words[i:i + len(phrase)] == phrase:
                found.append((i, i + len(phrase), label))
        for k, label, automaton in by_first.get(w, ()):
            if i >= free.get(k, 0) and (end := automaton.longest(same, i)) > 0:
                placed.append((i, end, label))
                free[k] = end
    return words, found, placed


FIELDS = (("n_words", "long"), ("n_base", "long"), ("first_word", "long"), ("last_word", "long"),
          ("base_labels", "string"), ("labels", "string"), ("score", "double"), ("n_places", "long"),
          ("places", "string"))


def _row(text: str | None, templates: tuple, phrases: tuple) -> tuple:
    words, found, placed = scan(text, templates, phrases)
    base = sorted({x for _, _, x in found})
    every = sorted({x for _, _, x in placed}.union(base))
    covered: set[int] = set()
    for a, b, _ in found + placed:
        covered.update(range(a, b))
    spans = sorted(set(found + placed))
    return (len(words), len(found), min((a for a, _, _ in found), default=None),
            max((a for a, _, _ in found), default=None), ",".join(base), ",".join(every),
            len(covered) / len(words) if words else 0.0, len(placed), ",".join(f"{x}:{a}:{b}" for a, b, x in spans))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple = TEMPLATES,
                 phrases: tuple = PHRASES, carry: bool = False) -> DataFrame:
    """One row for each document: the base phrases' places, the labels of base
    and templates, ``places`` (label:first word:end word of all of them) and
    ``score``, the share of the text's words that stand in such a place."""
    def run(texts: list) -> list:
        return list(zip(*(_row(t, templates, phrases) for t in texts))) or [[] for _ in FIELDS]

    return map_texts(docs, run, FIELDS, id_col, text_col, carry=carry)
