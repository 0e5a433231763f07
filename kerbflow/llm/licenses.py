"""License scans: matching statistics against a generalised suffix automaton, chained into covered template spans."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from kerbflow.llm.registry import query, table
from kerbflow.llm.rows import folded_words, map_texts

#: Phrases that name a licence, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Passages of public licences and of their notices, and their labels.
TEMPLATES = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    ],
    "apache": [
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        "See the License for the specific language governing permissions and limitations under the License",
        "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable "
        "copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and "
        "distribute the Work and such Derivative Works in Source or Object form",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details",
        "You should have received a copy of the GNU General Public License along with this program",
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
    "unlicense": [
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
        "as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    ],
}

#: A match shorter than this covers nothing of a template.
MIN_MATCH = 4
#: A label is added when the chained matches cover this part of one of its templates.
MIN_COVER = 0.6


@dataclass
class Automaton:
    """Generalised suffix automaton over word ids of all templates and phrases."""

    min_match: int = MIN_MATCH
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    longest: list[int] = field(default_factory=lambda: [0])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])
    labels: list[str] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    named: list[list[tuple[int, str]]] = field(default_factory=list)

    @classmethod
    def build(cls, templates: dict[str, list[str]], phrases: dict[str, str], min_match: int = MIN_MATCH) -> Automaton:
        made = cls(min_match)
        for label, passages in templates.items():
            for text in passages:
                made._add(folded_words(text.encode()), label)
        named = []
        for text, label in phrases.items():
            named.append((made._add(folded_words(text.encode()), None), label))
        # A state ends in a phrase if the state of the phrase lies on its chain of suffix links.
        by_state: dict[int, list[tuple[int, str]]] = {}
        for (state, size), label in named:
            by_state.setdefault(state, []).append((size, label))
        made.named = [[] for _ in made.step]
        for state in sorted(range(len(made.step)), key=made.longest.__getitem__):
            above = made.named[made.link[state]] if made.link[state] >= 0 else []
            made.named[state] = above + by_state.get(state, [])
        for state in sorted(range(1, len(made.step)), key=made.longest.__getitem__, reverse=True):
            if made.link[state] > 0:
                made.ends[made.link[state]] |= made.ends[state]
        return made

    def _new(self, longest: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.longest.append(longest)
        self.ends.append(set())
        return len(self.step) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state for exactly `state` followed by `word`, cut off from `target` where that also has longer strings."""
        if self.longest[state] + 1 == self.longest[target]:
            return target
        cut = self._new(self.longest[state] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = cut
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = cut
            state = self.link[state]
        return cut

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word, self.step[last][word])
        new, state = self._new(self.longest[last] + 1, 0, {}), last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, self.step[state][word])
        return new

    def _add(self, words: list[bytes], label: str | None) -> tuple[int, int]:
        """Add one sequence; its last state and its length."""
        template, state = len(self.labels), 0
        if label is not None:
            self.labels.append(label)
            self.sizes.append(len(words))
        for i, word in enumerate(words):
            state = self._extend(state, self.vocabulary.setdefault(word, len(self.vocabulary)))
            if label is not None:
                self.ends[state].add((template, i + 1))
        return state, len(words)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, int]]]:
        """Phrase places (first word, size, label) and maximal matches (end, length, state), in text order."""
        get, step, link, longest, named = self.vocabulary.get, self.step, self.link, self.longest, self.named
        places, matches = [], []
        state = size = 0
        for i, word in enumerate(words):
            token = get(word)
            if token is None:
                if size >= self.min_match:
                    matches.append((i, size, state))
                state = size = 0
                continue
            after = step[state].get(token)
            if after is None:
                if size >= self.min_match:
                    matches.append((i, size, state))
                while state >= 0 and token not in step[state]:
                    state = link[state]
                size, state = (longest[state] + 1, step[state][token]) if state >= 0 else (0, 0)
            else:
                state, size = after, size + 1
            for length, label in named[state]:
                if length <= size:
                    places.append((i + 1 - length, length, label))
        if size >= self.min_match:
            matches.append((len(words), size, state))
        return places, matches

    def spans(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """(template, first word, last word, share) of the best chain of matches of each template that has one.

        A chain takes matches in the order of text and template; the share is that of the template's words it covers, and
        the words are those of the text where its first match begins and its last one ends. Of equal shares the chain that
        ends first stays, of those that end together the one that begins last.
        """
        chains: dict[int, dict[int, tuple[int, int]]] = {}  # template -> position -> words covered up to it, less the first word
        best: dict[int, tuple[int, int, int]] = {}  # template -> words covered, less the last word, first word
        for stop, size, state in matches:
            gained = []
            for template, end in self.ends[state]:
                start = end - size
                before = max(((c - max(0, p - start), first) for p, (c, first) in chains.get(template, {}).items() if p < end), default=(0, 0))
                gained.append((template, end, (before[0] + size, before[1]) if before[0] > 0 else (size, stop - size)))
            for template, end, chain in gained:
                own = chains.setdefault(template, {})
                own[end] = max(own.get(end, (0, 0)), chain)
                best[template] = max(best.get(template, (0, 0, 0)), (chain[0], 1 - stop, chain[1]))
        return [(template, first, -last, covered / self.sizes[template]) for template, (covered, last, first) in sorted(best.items())]


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text: str = "text", templates: dict[str, list[str]] | None = None,
                  phrases: dict[str, str] | None = None, min_match: int = MIN_MATCH, min_cover: float = MIN_COVER) -> DataFrame:
    """Licence phrases, covered template spans and labels of every text, without a shuffle.

    `spans` has one entry for each passage of a template of which a long match was found: its label, the first and last
    word of the text (from 0) that the best chain of matches reaches over, and the share of the passage that it covers.
    The automaton is small (it holds the templates, not the corpus) and is built once per task. A null or empty text
    has no words, no labels and score 0. Repeated rows give equal rows; ids may be null. Columns named like an output
    column do not matter, since only the id and the text are read.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases

    def make():
        automaton = Automaton.build(templates, phrases, min_match)

        def one(text: bytes) -> tuple:
            words = folded_words(text)
            places, matches = automaton.scan(words)
            spans = [(automaton.labels[t], first, last, round(share, 6)) for t, first, last, share in automaton.spans(matches)]
            base = {label for _, _, label in places}
            found = base | {label for label, _, _, share in spans if share >= min_cover}
            return (len(words), len(places), min((p for p, _, _ in places), default=None), max((p for p, _, _ in places), default=None),
                    ",".join(sorted(base)), ",".join(sorted(found)), 1.0 if base else max((share for *_, share in spans), default=0.0),
                    [dict(zip(("label", "first_word", "last_word", "cover"), span)) for span in spans])

        return lambda texts: list(zip(*map(one, texts))) if texts else [[] for _ in range(8)]

    return map_texts(docs, [id_column], text, make, "n_words long, n_base long, first_word long, last_word long, "
                     "base_labels string, labels string, score double, "
                     "spans array<struct<label:string,first_word:long,last_word:long,cover:double>>")


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")
