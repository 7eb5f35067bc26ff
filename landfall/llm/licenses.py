"""Licence texts in documents, by a generalised suffix automaton of licence words.

The automaton accepts every run of words of every template. A document's words are
streamed through it once; each step gives the longest run that ends there and
stands in some template (the matching statistics). Long runs become matches,
matches in the order of one template and close to each other are chained, and a
chain that covers enough of the template gives its label. The base phrases are
templates like the others: a phrase stands wherever the automaton's state has the
phrase's end among its suffixes.

Edge cases: a NULL text is an empty one: no word, no label. A NULL id is kept.
Repeated rows get equal results, an empty table an empty one. Texts are streamed
whole, whatever their length. Other columns are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Fixed phrases and labels of the contract.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Fixed openings and notices of public licences, by label.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this"
    " software and associated documentation files the software to deal in the software without"
    " restriction including without limitation the rights to use copy modify merge publish"
    " distribute sublicense and or sell copies of the software",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this"
    " file except in compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are"
    " permitted provided that the following conditions are met",
    "gpl": "this program is free software you can redistribute it and or modify it under the"
    " terms of the gnu general public license as published by the free software foundation",
    "gpl-3": "this work is licensed under the gnu general public license version 3",
    "cc-by-nc": "this work is licensed under a creative commons attribution noncommercial 4 0"
    " international license",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
LEAST_MATCH = 4
LEAST_COVER = 0.6
MOST_GAP = 8

_NO_WORD = bytes.maketrans(
    bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]), b" " * (0x30 + 0x27 + 5)
)


def license_words(text: str) -> list[bytes]:
    """Lower-case words of ASCII letters, digits and anything beyond ASCII, as UTF-8."""
    return text.encode().lower().translate(_NO_WORD).split()


@dataclass
class Automaton:
    """A generalised suffix automaton over numbered words.

    `ends[state]` has (template, words of it up to the run's end) of the first place
    the state's runs were seen in.
    """

    words: dict[bytes, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])
    phrases: list[tuple[tuple[int, int], ...]] = field(default_factory=list)

    def _state(self, length: int, like: int | None = None) -> int:
        self.step.append({} if like is None else dict(self.step[like]))
        self.link.append(-1 if like is None else self.link[like])
        self.length.append(length)
        self.ends.append([])
        return len(self.step) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """The target's shorter runs, those of one word more than `at`, get a state of their own."""
        copy = self._state(self.length[at] + 1, target)
        self.link[target] = copy
        while at != -1 and self.step[at].get(word) == target:
            self.step[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            exact = self.length[known] == self.length[last] + 1
            return known if exact else self._split(last, word, known)
        new = self._state(self.length[last] + 1)
        at = last
        while at != -1 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at == -1:
            self.link[new] = 0
        else:
            target = self.step[at][word]
            exact = self.length[target] == self.length[at] + 1
            self.link[new] = target if exact else self._split(at, word, target)
        return new

    def add(self, words: list[bytes], template: int) -> int:
        """Add a template; the state that the whole of it leads to."""
        last = 0
        for word in words:
            last = self._extend(last, self.words.setdefault(word, len(self.words)))
        return last

    def place(self, words: list[bytes], template: int) -> None:
        """Note for every state which places of a template its runs end at."""
        at = 0
        for i, word in enumerate(words, 1):
            at = self.step[at][self.words[word]]
            suffix = at
            while suffix > 0:
                self.ends[suffix].append((template, i))
                suffix = self.link[suffix]


@dataclass(frozen=True)
class Licences:
    automaton: Automaton
    labels: tuple[str, ...]
    sizes: tuple[int, ...]
    n_base: int


def build(base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES) -> Licences:
    """The automaton of the phrases and templates, a state's phrases worked out beforehand."""
    automaton = Automaton()
    entries = [*base.items(), *((text, label) for label, text in templates.items())]
    spelled = [(text.encode().split(), label) for text, label in entries]
    for i, (words, _) in enumerate(spelled):
        automaton.add(words, i)
    for i, (words, _) in enumerate(spelled):
        automaton.place(words, i)
    wholes: dict[int, tuple[int, int]] = {}
    for i, (words, _) in enumerate(spelled[: len(base)]):
        at = 0
        for word in words:
            at = automaton.step[at][automaton.words[word]]
        wholes[at] = (i, len(words))
    for state in range(len(automaton.step)):
        found, at = [], state
        while at > 0:
            if at in wholes:
                found.append(wholes[at])
            at = automaton.link[at]
        automaton.phrases.append(tuple(found))
    return Licences(
        automaton,
        tuple(label for _, label in spelled),
        tuple(len(words) for words, _ in spelled),
        len(base),
    )


def scan(words: list[bytes], licences: Licences) -> tuple[list[tuple[int, int]], list[tuple]]:
    """Phrases found, as (first word, phrase), and runs, as (first, end, places of their end).

    A run is a longest match that the next word doesn't prolong.
    """
    automaton = licences.automaton
    step, link, length = automaton.step, automaton.link, automaton.length
    phrases, runs = [], []
    ids = list(map(automaton.words.get, words))
    known = np.fromiter((i is not None for i in ids), bool, len(ids))
    least = min(LEAST_MATCH, min(licences.sizes))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
    for first, end in edges.reshape(-1, 2):
        if end - first < least:
            continue  # too few words in a row that any template has
        state, run = 0, 0
        for i in range(first, end):
            word = ids[i]
            if word not in step[state]:
                if run >= LEAST_MATCH:
                    runs.append((i - run, i, automaton.ends[state]))
                while state > 0 and word not in step[state]:
                    state = link[state]
                run = length[state]
            if word in step[state]:
                state = step[state][word]
                run += 1
            for phrase, size in automaton.phrases[state]:
                if size <= run:
                    phrases.append((int(i) + 1 - size, phrase))
        if run >= LEAST_MATCH:
            runs.append((end - run, end, automaton.ends[state]))
    return phrases, runs


def chain(runs: list[tuple], licences: Licences) -> dict[int, tuple[float, int, int]]:
    """For each template its best chain: share of the template covered, first and last word."""
    best: dict[int, tuple[float, int, int]] = {}
    open_: dict[int, list[tuple[int, int, int, int]]] = {}
    for start, end, places in runs:
        for template, to in places:
            if template < licences.n_base:
                continue
            size = end - start
            cover, first = min(size, to), start
            kept = [c for c in open_.get(template, []) if start - c[2] <= MOST_GAP]
            for c_cover, c_first, c_end, c_to in kept:
                new = min(to - c_to, size)  # words of the template the run adds to the chain
                if new > 0 and end > c_end and c_cover + new > cover:
                    cover, first = c_cover + new, c_first
            open_[template] = [*kept, (cover, first, end, to)]
            share = min(1.0, cover / licences.sizes[template])
            if share > best.get(template, (0.0, 0, 0))[0]:
                best[template] = (share, int(first), int(end) - 1)
    return best


def find_licences(text: str, licences: Licences) -> dict:
    """Everything about one text: phrases, labels, template spans and score."""
    words = license_words(text)
    phrases, runs = scan(words, licences)
    chains = chain(runs, licences)
    spans = [
        {"label": licences.labels[t], "first": first, "last": last, "cover": share}
        for t, (share, first, last) in sorted(chains.items())
        if share >= LEAST_COVER
    ]
    starts = [at for at, _ in phrases]
    base = {licences.labels[p] for _, p in phrases}
    return {
        "n_words": len(words),
        "n_base": len(phrases),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {s["label"] for s in spans})),
        "score": 1.0 if phrases else max((share for share, _, _ in chains.values()), default=0.0),
        "spans": spans,
    }


FOUND = {
    "n_words": "long",
    "n_base": "long",
    "first_word": "long",
    "last_word": "long",
    "base_labels": "string",
    "labels": "string",
    "score": "double",
    "spans": "array<struct<label: string, first: long, last: long, cover: double>>",
}


def licences_in(text: str = "text", licences: Licences | None = None) -> Column:
    """A struct of what `find_licences` tells of each whole text."""
    known = licences or build()

    @F.arrow_udf(returnType=", ".join(f"{k} {v}" for k, v in FOUND.items()))
    def found(texts: pa.Array) -> pa.Array:
        span = pa.struct(
            [
                ("label", pa.string()),
                ("first", pa.int64()),
                ("last", pa.int64()),
                ("cover", pa.float64()),
            ]
        )
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
        kind = pa.struct(list(zip(FOUND, kinds, strict=True)))
        return pa.array([find_licences(x.as_py(), known) for x in texts], kind)

    return found(text_of(text))


def scan_licences(documents: DataFrame) -> DataFrame:
    """`doc_id` and what was found in each document."""
    return documents.select("doc_id", licences_in().alias("found")).select("doc_id", "found.*")
