"""Licence scans with a generalised suffix automaton of licence texts.

Every document is streamed through the automaton, which gives matching statistics: at each
word the longest stretch ending there that occurs in a licence text. Long matches that follow
each other in a document and in one text are chained, and a chain that covers enough of the
text is a span of that licence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from queixa.llm.columns import others, set_aside
from queixa.llm.words import LETTERS, hashed

# Phrases that are reported wherever they stand, with their labels.
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

# Opening passages and notices of common licences, with the labels they give.
TEXTS = [
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the Software), to deal in the Software without restriction", "mit"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation", "gpl"),
    ("either version 3 of the License, or (at your option) any later version", "gpl-3.0"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
]

# A match counts from so many words, a chain skips at most so many in the document or the text,
# and a span covers at least this share of its text.
LONG_MATCH, GAP, COVERED = 3, 12, 0.7

_TEXTS = T.ArrayType(T.StringType())
_SPAN = T.StructType().add("label", "string").add("start", "long").add("end", "long").add("covered", "double")
RESULT = (T.StructType().add("n_words", "long").add("n_base", "long").add("first_word", "long").add("last_word", "long")
          .add("base_labels", _TEXTS).add("labels", _TEXTS).add("spans", T.ArrayType(_SPAN))
          .add("longest_match", "long").add("score", "double"))


class Automaton:
    """All stretches of several word sequences; a state holds stretches that end at the same places."""

    def __init__(self, texts: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        for t, words in enumerate(texts):
            at = 0
            for i, word in enumerate(words):
                at = self._extend(at, word)
                self.places[at].add((t, i + 1))
        # places of a state are those of all states that link to it
        for s in sorted(range(1, len(self.length)), key=lambda x: -self.length[x]):
            self.places[self.link[s]] |= self.places[s]
        self.places[0] = set()

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.places.append(set())
        return len(self.length) - 1

    def _split(self, at: int, word: int) -> int:
        """The state reached by `word` from `at`, holding no longer stretches than that."""
        to = self.next[at][word]
        if self.length[to] == self.length[at] + 1:
            return to
        half = self._state(self.length[at] + 1)
        self.next[half], self.link[half] = dict(self.next[to]), self.link[to]
        self.link[to] = half
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = half
            at = self.link[at]
        return half

    def _extend(self, at: int, word: int) -> int:
        if word in self.next[at]:
            return self._split(at, word)
        new = self._state(self.length[at] + 1)
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        self.link[new] = self._split(at, word) if at >= 0 else 0
        return new

    def matches(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """After each word: the state, and how many words end here that stand in a text."""
        at = n = 0
        for word in words:
            while at and word not in self.next[at]:
                at = self.link[at]
                n = self.length[at]
            if word in self.next[at]:
                at, n = self.next[at][word], n + 1
            yield at, n


class Scanner:
    """The automaton, the word numbers it uses, and which word pairs and one-word phrases occur in it."""

    def __init__(self, phrases: list[tuple[str, str]], texts: list[tuple[str, str]]):
        self.labels = [label for _, label in [*phrases, *texts]]
        self.n_phrases = len(phrases)
        both = pa.array([text for text, _ in [*phrases, *texts]], pa.string())
        found = [part.hashes[a:b] for part in hashed(both, LETTERS, fold=True)
                 for a, b in zip(part.bounds[:-1], part.bounds[1:], strict=True)]
        self.known = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
        self.texts = [np.searchsorted(self.known, x).tolist() for x in found]
        self.automaton = Automaton(self.texts)
        self.pairs = np.zeros((len(self.known) + 1, len(self.known) + 1), dtype=bool)
        for words in self.texts:
            self.pairs[words[:-1], words[1:]] = True
        self.alone = np.zeros(len(self.known) + 1, dtype=bool)
        self.alone[[x[0] for x in self.texts[:self.n_phrases] if len(x) == 1]] = True
        # phrases that are endings of a state's stretches, with their lengths: its own and those of its links
        link, length, places = self.automaton.link, self.automaton.length, self.automaton.places
        self.phrase_ends: list[list[tuple[int, int]]] = [[] for _ in length]
        for s in sorted(range(1, len(length)), key=length.__getitem__):
            own = [(t, end) for t, end in sorted(places[s]) if t < self.n_phrases and end == len(self.texts[t])
                   and length[link[s]] < end <= length[s]]
            self.phrase_ends[s] = own + self.phrase_ends[link[s]]

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at, len(self.known))

    def scan(self, words: list[int], start: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Phrase places (start, phrase) and maximal matches (start, words, state) of a stretch."""
        phrases, found, before = [], [], (0, 0)
        for i, (state, n) in enumerate(self.automaton.matches(words)):
            if n <= before[1]:
                found.append((start + i - before[1], before[1], before[0]))
            for t, size in self.phrase_ends[state]:
                if size <= n:
                    phrases.append((start + i + 1 - size, t))
            before = (state, n)
        found.append((start + len(words) - before[1], before[1], before[0]))
        return phrases, [x for x in found if x[1] >= LONG_MATCH]

    def chains(self, found: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Spans (label, start, end, covered share) of one document's matches, in reading order.

        A match continues its text's open chain if it follows there too, within GAP words."""
        open_: dict[int, list[int]] = {}
        done: list[tuple[str, int, int, float]] = []

        def close(t: int) -> None:
            first, last, _, covered = open_.pop(t)
            done.append((self.labels[t], first, last, covered / len(self.texts[t])))

        for start, n, state in found:
            for t, end in sorted(self.automaton.places[state]):
                if t < self.n_phrases:
                    continue
                begin = end - n
                if t in open_ and not (0 <= start - open_[t][1] <= GAP and 0 <= begin - open_[t][2] <= GAP):
                    close(t)
                if t not in open_:
                    open_[t] = [start, start, begin, 0]
                open_[t] = [open_[t][0], start + n, end, open_[t][3] + n]
        for t in list(open_):
            close(t)
        return sorted(done, key=lambda x: (x[1], x[2], x[0]))


def _scan(batches: Iterator[pa.RecordBatch], scanner, kept: list[str], text: str) -> Iterator[pa.RecordBatch]:
    scanner = scanner.value
    for batch in batches:
        texts = batch.column(batch.schema.names.index(text))
        out: dict[str, list] = {name: [] for name in RESULT.names}
        for part in hashed(texts, LETTERS, fold=True):
            n = part.last - part.first
            number = scanner.numbered(part.hashes)
            same = scanner.pairs[number[:-1], number[1:]]
            edges = part.bounds[(part.bounds > 0) & (part.bounds < len(number))]
            same[edges - 1] = False
            # stretches in which every word pair occurs in a text; elsewhere matches are single words, of which
            # only whole phrases count
            step = np.diff(np.concatenate([[0], same.astype(np.int8), [0]]))
            begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1) + 1
            if scanner.alone.any():
                single = scanner.alone[number]
                single[:-1] &= ~same
                single[1:] &= ~same
                at = np.flatnonzero(single)
                begin, end = np.sort(np.concatenate([begin, at])), np.sort(np.concatenate([end, at + 1]))
            row = np.searchsorted(part.bounds, begin, side="right") - 1
            phrases: dict[int, list] = {}
            found: dict[int, list] = {}
            for r, a, b in zip(row.tolist(), begin.tolist(), end.tolist(), strict=True):
                p, f = scanner.scan(number[a:b].tolist(), a - int(part.bounds[r]))
                if p:
                    phrases.setdefault(r, []).extend(p)
                if f:
                    found.setdefault(r, []).extend(f)
            sizes = np.diff(part.bounds).tolist()
            for i in range(n):
                places = phrases.get(i, ())
                spans = [x for x in scanner.chains(found[i]) if x[3] >= 0] if i in found else []
                good = [x for x in spans if x[3] >= COVERED]
                base = {scanner.labels[t] for _, t in places}
                for name, value in (
                        ("n_words", sizes[i]), ("n_base", len(places)),
                        ("first_word", min((s for s, _ in places), default=None)),
                        ("last_word", max((s for s, _ in places), default=None)),
                        ("base_labels", sorted(base)), ("labels", sorted(base | {x[0] for x in good})),
                        ("spans", [dict(zip(("label", "start", "end", "covered"), x, strict=True)) for x in good]),
                        ("longest_match", max((x[1] for x in found.get(i, ())), default=0)),
                        ("score", min(1.0, max((x[3] for x in spans), default=0.0)))):
                    out[name].append(value)
        text_list = pa.list_(pa.string())
        span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())]))
        kinds = [pa.int64()] * 4 + [text_list, text_list, span, pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.names.index(c)) for c in kept]
            + [pa.array(x, kind) for x, kind in zip(out.values(), kinds, strict=True)], names=[*kept, *out])


def scan_licences(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES,
                  texts: list[tuple[str, str]] = TEXTS) -> DataFrame:
    """Every document with the licences it mentions.

    `docs` needs `text`. Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lowered. Returned are all columns of `docs` (its own columns named as a result are replaced) and:
    n_words; n_base, places where a phrase's words stand consecutively, overlapping ones and all
    repeats included; first_word, last_word, their smallest and largest start (null without);
    base_labels; labels, those and the labels of spans; spans (label, word range, covered share
    of the licence text); longest_match in words, from LONG_MATCH on; score, the largest covered
    share, 0 to 1. Null or empty texts have no words and score 0. Every row is judged by itself.
    """
    own = others(docs.columns, RESULT.names)
    sent = docs.sparkSession.sparkContext.broadcast(Scanner(phrases, texts))
    kept, plain, back = set_aside(docs, own)
    scan = partial(_scan, scanner=sent, kept=plain, text=plain[[c.casefold() for c in own].index("text")])
    return back(kept.mapInArrow(scan, T.StructType([*kept.schema.fields, *RESULT.fields])))
