"""Licence scan: a generalised suffix automaton of licence words gives matching statistics of a text;
long matches are chained into covered spans of a template.

The automaton holds every run of words of every template. A text is streamed through it; where the
current match cannot grow, it is kept if it has at least ``MIN_MATCH`` words. Matches of one template
that follow each other in text and template, with at most ``GAP`` words between them, form a chain. A
template counts as present if a chain covers ``COVERED`` of its words, or ``LONG_COVER`` words.
Words outside every template cannot match, so only runs of template words are streamed.

Defined results: null and empty texts have no words, no labels and score 0.0. Repeated rows are each
scanned. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import map_rows, table
from tidemark.llm.registry import query

MIN_MATCH = 3
GAP = 6
COVERED = 0.75
LONG_COVER = 12

# The phrases every scan looks for, and the label of each.
PHRASES = (
    ((b"mit", b"license"), "mit"),
    ((b"apache", b"license"), "apache"),
    ((b"general", b"public", b"license"), "gpl"),
)

# Notices and passages of public licences, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice, this"
        " list of conditions and the following disclaimer.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cases A-Z only; bytes above 0x7F belong to words."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


@dataclass
class Automaton:
    """Suffix automaton over several word sequences; a state knows where its words end in them."""

    step: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])
    sizes: list[int] = field(default_factory=list)

    def add(self, words: list[bytes]) -> None:
        last, number = 0, len(self.sizes)
        self.sizes.append(len(words))
        for at, word in enumerate(words):
            last = self._extend(last, word)
            self.ends[last].add((number, at + 1))

    def _state(self, length: int, step: dict[bytes, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.step) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        """The state below ``q`` for sequences of one word more than ``p``'s."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.step[last]:  # known from an earlier sequence
            return self._split(last, self.step[last][word], word)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.step[p][word], word)
        return new

    def finish(self) -> Automaton:
        """Hand the end places up the suffix links, longest states first."""
        for state in sorted(range(1, len(self.step)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]
        return self

    def matches(self, words: list[bytes], first: int = 0) -> list[tuple[int, int, int]]:
        """(start, end, state) of every match that cannot grow to the right, of ``MIN_MATCH`` words or more."""
        found, state, size = [], 0, 0
        for at, word in enumerate(words, first):
            if word not in self.step[state] and size >= MIN_MATCH:
                found.append((at - size, at, state))
            while state and word not in self.step[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.step[state]:
                state, size = self.step[state][word], size + 1
        if size >= MIN_MATCH:
            found.append((first + len(words) - size, first + len(words), state))
        return found


def build() -> tuple[Automaton, list[str]]:
    automaton = Automaton()
    for _, text in TEMPLATES:
        automaton.add(words_of(text))
    return automaton.finish(), [label for label, _ in TEMPLATES]


@dataclass(frozen=True)
class Span:
    template: int
    start: int
    end: int
    covered: int


def chain(matches: list[tuple[int, int, int]], automaton: Automaton) -> list[Span]:
    """Chains of matches in order of text and template; each place of a match joins the best open chain."""
    open_chains: list[tuple[int, int, int, int, int]] = []  # template, first word, text end, template end, covered
    done: list[Span] = []
    for start, end, state in matches:
        still = []
        for c in open_chains:
            if start - c[2] > GAP:
                done.append(Span(c[0], c[1], c[2], c[4]))
            else:
                still.append(c)
        grown = []
        for template, t_end in sorted(automaton.ends[state]):
            t_start = t_end - (end - start)
            best = (template, start, end, t_end, end - start)
            for c in still:
                over = max(0, c[2] - start, c[3] - t_start)
                if c[0] == template and t_start - c[3] <= GAP and t_end > c[3] and end - start > over:
                    if c[4] + end - start - over > best[4]:
                        best = (template, c[1], end, t_end, c[4] + end - start - over)
            grown.append(best)
        open_chains = list(dict.fromkeys(still + grown))
    return done + [Span(c[0], c[1], c[2], c[4]) for c in open_chains]


@dataclass(frozen=True)
class Scan:
    n_words: int
    base: list[tuple[int, str]]
    spans: list[tuple[str, int, int, float]]

    @property
    def score(self) -> float:
        return max((s[3] for s in self.spans), default=0.0)


class Scanner:
    """Scans texts; built once per task."""

    def __init__(self) -> None:
        self.automaton, self.labels = build()
        self.known = frozenset(self.automaton.step[0])
        self.first = {}
        for phrase, label in PHRASES:
            self.first.setdefault(phrase[0], []).append((phrase, label))

    def scan(self, text: str | None) -> Scan:
        words = words_of(text)
        known = self.known
        at = [i for i, w in enumerate(words) if w in known]
        base, matches, run = [], [], 0
        for k, i in enumerate(at):
            for phrase, label in self.first.get(words[i], ()):
                if tuple(words[i : i + len(phrase)]) == phrase:
                    base.append((i, label))
            if k + 1 == len(at) or at[k + 1] != i + 1:  # the run of known words ends here
                if k + 1 - run >= MIN_MATCH:
                    matches += self.automaton.matches(words[at[run] : i + 1], at[run])
                run = k + 1
        spans: dict[tuple[int, int, int], float] = {}
        for s in chain(matches, self.automaton) if matches else ():
            share = min(1.0, s.covered / self.automaton.sizes[s.template])
            if share >= COVERED or s.covered >= LONG_COVER:
                spans[s.template, s.start, s.end] = max(share, spans.get((s.template, s.start, s.end), 0.0))
        return Scan(len(words), base, [(self.labels[t], a, b, share) for (t, a, b), share in sorted(spans.items())])


_scanners: list[Scanner] = []


def scanner() -> Scanner:
    if not _scanners:
        _scanners.append(Scanner())
    return _scanners[0]


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, base places and covered template spans of every document."""

    def scanned(ids, texts):
        found = [scanner().scan(t) for t in texts]
        return {
            "doc_id": ids,
            "n_words": [f.n_words for f in found],
            "base": [[{"word": i, "label": label} for i, label in f.base] for f in found],
            "spans": [[{"label": s[0], "first": s[1], "end": s[2], "covered": s[3]} for s in f.spans] for f in found],
            "score": [f.score for f in found],
        }

    return map_rows(
        documents,
        scanned,
        "doc_id long, n_words long, base array<struct<word: long, label: string>>,"
        " spans array<struct<label: string, first: long, end: long, covered: double>>, score double",
        "doc_id", "text",
    )


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = "array_join(array_sort(array_distinct({})), ',')"
    return scan(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        "n_words",
        "cast(size(base) AS long) AS n_base",
        "array_min(base.word) AS first_word",
        "array_max(base.word) AS last_word",
        joined.format("base.label") + " AS base_labels",
        joined.format("concat(base.label, spans.label)") + " AS labels",
        "score",
    )
