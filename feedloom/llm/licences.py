"""License scans by a generalised suffix automaton of licence tokens.

The automaton holds every run of words of the licence templates. A text is streamed through it,
which gives for each word the longest run ending there that some template has (the matching
statistics). Long runs are chained, in text and template order, into covered template spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import texts

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Public licence notices, by label.
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of
     this software and associated documentation files (the "Software"), to deal in the Software
     without restriction, including without limitation the rights to use, copy, modify, merge,
     publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
     whom the Software is furnished to do so, subject to the following conditions: The above
     copyright notice and this permission notice shall be included in all copies or substantial
     portions of the Software."""),
    ("mit", "Released under the MIT License."),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
     this file except in compliance with the License. You may obtain a copy of the License at
     http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in
     writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
     WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the
     terms of the GNU General Public License as published by the Free Software Foundation, either
     version 3 of the License, or (at your option) any later version. This program is distributed
     in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
     warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification,
     are permitted provided that the following conditions are met: Redistributions of source code
     must retain the above copyright notice, this list of conditions and the following
     disclaimer."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v.
     2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
     https://mozilla.org/MPL/2.0/."""),
    ("cc-by", """This work is licensed under a Creative Commons Attribution 4.0 International
     License. To view a copy of this license, visit
     http://creativecommons.org/licenses/by/4.0/."""),
    ("cc-by-sa", """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0
     International License."""),
]

#: Runs shorter than this are not chained; a label needs a chain that covers this many words of
#: a template, and this share of it.
MIN_RUN, MIN_COVER, MIN_SHARE = 4, 5, 0.35
#: A chain goes on over at most this many other words, in the text and in the template.
GAP = 12

#: All bytes that words do not hold become spaces, A-Z lower case.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90
    else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122
    else 32
    for c in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


class SuffixAutomaton:
    """All runs of tokens of several sequences; each state knows one end per sequence it is in."""

    def __init__(self, sequences: list[list[int]]):
        self.length, self.link = [0], [-1]
        self.next: list[dict[int, int]] = [{}]
        self.ends: list[dict[int, int]] = [{}]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].setdefault(number, place + 1)
        # A state's runs end wherever those of the states linked to it do.
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            for number, end in self.ends[state].items():
                into = self.ends[self.link[state]]
                into[number] = min(end, into.get(number, end))

    def _state(self, length: int, link: int, onward: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(onward)
        self.ends.append({})
        return len(self.length) - 1

    def _split(self, state: int, token: int) -> int:
        """The target of ``state`` by ``token``, split off where it also has longer runs."""
        target = self.next[state][token]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, token)
        return new

    def statistics(self, tokens) -> Iterator[tuple[int, int]]:
        """Per token the state of the longest run ending there, and its length."""
        state, run = 0, 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                run = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                run += 1
            yield state, run


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.labels = [label for label, _ in templates]
        cut = [words_of(text.encode()) for _, text in templates]
        vocabulary = sorted({word for words in cut for word in words})
        self.number = {word: k for k, word in enumerate(vocabulary)}
        self.sizes = [len(words) for words in cut]
        self.automaton = SuffixAutomaton([[self.number[w] for w in words] for words in cut])
        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]

    def base(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Word places at which a phrase stands, and the phrases' labels."""
        joined = b" " + b" ".join(words) + b" "
        places, labels = [], set()
        for phrase, label in self.phrases:
            at = joined.find(phrase)
            counted, upto = 0, 0
            while at >= 0:
                counted += joined.count(b" ", upto, at)
                upto = at
                places.append(counted)
                labels.add(label)
                at = joined.find(phrase, at + 1)
        return places, labels

    def runs(self, words: list[bytes]) -> Iterator[tuple[int, int, dict[int, int]]]:
        """Maximal long runs: (start, end) in words, and where each template has the run's end.

        Only stretches of template words of at least ``MIN_RUN`` can hold one; others are skipped.
        """
        numbers = np.fromiter(
            (-1 if k is None else k for k in map(self.number.get, words)), np.int32, len(words)
        )
        inside = np.concatenate([[0], (numbers >= 0).view(np.int8), [0]])
        edges = np.flatnonzero(np.diff(inside))
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if last - first < MIN_RUN:
                continue
            before = None
            for place, (state, run) in enumerate(
                self.automaton.statistics(numbers[first:last].tolist()), first
            ):
                # A run is maximal if the next one does not go on with it.
                if before and run != before[1] + 1 and before[1] >= MIN_RUN:
                    yield place - before[1], place, self.automaton.ends[before[0]]
                before = (state, run)
            if before and before[1] >= MIN_RUN:
                yield last - before[1], last, self.automaton.ends[before[0]]

    def spans(self, words: list[bytes]) -> list[tuple[str, int, int, int, float]]:
        """(label, first word, end, covered words, share of the template) of every long chain."""
        open_chains: dict[int, list[int]] = {}
        done = []

        def close(template: int) -> None:
            chain = open_chains.pop(template)
            share = chain[2] / self.sizes[template]
            if chain[2] >= MIN_COVER and share >= MIN_SHARE:
                done.append((self.labels[template], chain[0], chain[1], chain[2], min(1.0, share)))

        for start, end, ends in self.runs(words):
            for template, upto in ends.items():
                chain = open_chains.get(template)
                # Runs may share words with the one before; those count once.
                new = end - max(start, chain[1]) if chain else 0
                if (
                    chain
                    and new > 0
                    and start - chain[1] <= GAP
                    and 0 <= upto - new - chain[3] <= GAP
                ):
                    chain[1], chain[2], chain[3] = end, chain[2] + new, upto
                elif not chain or start >= chain[1] or end - start > chain[2]:
                    if chain:
                        close(template)
                    open_chains[template] = [start, end, end - start, upto]
        for template in list(open_chains):
            close(template)
        return sorted(done, key=lambda s: (s[1], s[2], s[0]))


def _scan(templates, phrases):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for batch in batches:
            out = []
            for raw in texts(batch["text"]):
                words = words_of(raw)
                places, labels = scanner.base(words)
                spans = scanner.spans(words)
                out.append(
                    {
                        "n_words": len(words),
                        "n_base": len(places),
                        "first_word": min(places, default=None),
                        "last_word": max(places, default=None),
                        "base_labels": sorted(labels),
                        "labels": sorted(labels | {s[0] for s in spans}),
                        "spans": [dict(zip(("label", "start", "end", "covered", "share"), s)) for s in spans],
                        "score": max((s[4] for s in spans), default=0.0),
                    }
                )
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(out, FOUND)], ["row", "licences"]
            )

    return scan


FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.list_(pa.string())),
        ("labels", pa.list_(pa.string())),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [
                        ("label", pa.string()),
                        ("start", pa.int64()),
                        ("end", pa.int64()),
                        ("covered", pa.int64()),
                        ("share", pa.float64()),
                    ]
                )
            ),
        ),
        ("score", pa.float64()),
    ]
)
FOUND_DDL = (
    "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,"
    "base_labels:array<string>,labels:array<string>,spans:array<struct<label:string,start:bigint,"
    "end:bigint,covered:bigint,share:double>>,score:double>"
)


def scan_licences(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    templates=TEMPLATES,
    phrases=PHRASES,
) -> DataFrame:
    """The columns ``keep`` and ``licences``: base places and labels, chained spans and a score.

    The score is the largest share of a template that a chain covers. Texts are read whole; a
    null or empty text has no words, no places and score 0; repeated rows each have their
    result; other columns are left behind; an empty table gives no rows. The automaton is made
    from the templates in every task and does not grow with the data. Nothing is shuffled.
    """
    kinds = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in keep)
    found = docs.select(
        F.struct(*keep).alias("row"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(_scan(templates, phrases), f"row struct<{kinds}>, licences {FOUND_DDL}")
    return found.select("row.*", "licences")
