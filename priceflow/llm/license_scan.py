"""Licence scan by matching statistics of a suffix automaton (operator 1).

The licence templates (short notices, below) are joined into one generalised
suffix automaton over words.  Every whole text is streamed through it, which
gives at each word the length of the longest run of words ending there that
also occurs in some template.  Two things are read off this stream:

* the places of the base phrases: a phrase ends at a word exactly when the
  match there is at least as long as the phrase and the phrase is a suffix of
  it;
* matches of ``MIN_PIECE`` words or more, at each place of a template where they
  grow no further (also where the longest match grows on in another template),
  which are chained per template.  A match
  follows another if it ends later in text and template, with at most
  ``MAX_GAP`` words between them in either; where the two overlap, the later one is
  trimmed.  The chain that covers most words is found by dynamic programming
  over the matches by text end; words that agree in its gaps, and just before
  and after it, are covered too.  A span labels the text if its covered words are
  ``MIN_COVER`` of the template and of the span; chains without a match of
  ``MIN_MATCH`` words count only then.

Words outside the templates' vocabulary end every match, so the automaton only
walks runs of known words; those runs are found on whole Arrow batches.

A null or empty text has no words, no places, empty labels and score 0.  Rows
are scanned one by one: repeated rows, null ids and other columns make no
difference, and an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from priceflow.llm import common

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Templates: widely used public notices, their openings and their full texts.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in"
        " compliance with the license",
        "unless required by applicable law or agreed to in writing software distributed under the license"
        " is distributed on an as is basis without warranties or conditions of any kind",
    ],
    "gpl-3.0": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation",
        "this program is distributed in the hope that it will be useful but without any warranty without even the"
        " implied warranty of merchantability or fitness for a particular purpose see the gnu general public"
        " license for more details",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction including"
        " without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
        " copies of the software and to permit persons to whom the software is furnished to do so subject to"
        " the following conditions the above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the software",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is"
        " hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "zlib": [
        "this software is provided as is without any express or implied warranty in no event will the authors be"
        " held liable for any damages arising from the use of this software permission is granted to anyone to"
        " use this software for any purpose including commercial applications and to alter it and redistribute"
        " it freely",
    ],
    "unlicense": [
        "this is free and unencumbered software released into the public domain anyone is free to copy modify"
        " publish use compile sell or distribute this software either in source code form or as a compiled"
        " binary for any purpose commercial or non commercial and by any means",
    ],
    "bsl-1.0": [
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the"
        " software and accompanying documentation covered by this license the software to use reproduce display"
        " distribute execute and transmit the software and to prepare derivative works of the software",
    ],
    "lgpl": [
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
        " general public license as published by the free software foundation",
    ],
    "agpl-3.0": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero"
        " general public license as published by the free software foundation",
    ],
    "cc-by-nc-4.0": ["licensed under cc by nc 4 0"],
    "cc-by-4.0": ["licensed under cc by 4 0", "creative commons attribution 4 0 international license"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the"
        " following disclaimer redistributions in binary form must reproduce the above copyright notice this list"
        " of conditions and the following disclaimer in the documentation and or other materials provided with"
        " the distribution",
    ],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
}
MIN_PIECE = 2
MIN_MATCH = 4
MAX_GAP = 4
MIN_COVER = 0.8

SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
          " base_labels string, labels string, score double,"
          " spans array<struct<template:string, first_word:bigint, last_word:bigint, cover:double>>")


class Automaton:
    """Generalised suffix automaton of word sequences, with what ends at each state."""

    def __init__(self, sequences: list[list[int]], phrases: list[tuple[list[int], str]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for seq in sequences:
            last = 0
            for word in seq:
                last = self._extend(last, word)
        #: (template, end position) pairs whose prefix ends with the state's words
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for t, seq in enumerate(sequences):
            at = 0
            for k, word in enumerate(seq):
                at = self.next[at][word]
                v = at
                while v > 0:
                    self.ends[v].append((t, k))
                    v = self.link[v]
        #: (phrase, its length) for phrases that are suffixes of the state's words
        self.phrases = self._suffixes([seq for seq, _ in phrases])

    def _suffixes(self, sequences: list[list[int]]) -> list[list[tuple[int, int]]]:
        out: list[list[tuple[int, int]]] = [[] for _ in self.next]
        own: dict[int, list[tuple[int, int]]] = {}
        for p, seq in enumerate(sequences):
            at = 0
            for word in seq:
                at = self.next[at][word]
            own.setdefault(at, []).append((p, len(seq)))
        for v in range(len(self.next)):
            u = v
            while u > 0:
                out[v] += own.get(u, [])
                u = self.link[u]
        return out

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(dict(edges))
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._new(self.length[p] + 1, self.link[q], self.next[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        cur = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return cur


class Scanner:
    """The automaton and the vocabulary; built once per task."""

    def __init__(self, base: dict[str, str], templates: dict[str, list[str]]):
        if any(len(phrase.split()) < 2 for phrase in base):
            raise ValueError("a base phrase needs two words or more")
        vocabulary: dict[str, int] = {}
        encode = lambda text: [vocabulary.setdefault(w, len(vocabulary)) for w in text.split()]
        self.phrases = [(encode(p), label) for p, label in base.items()]
        named = [(label, encode(t)) for label, texts in templates.items() for t in texts]
        self.names, sequences = [label for label, _ in named], [seq for _, seq in named]
        self.sequences, self.sizes = sequences, [len(s) for s in sequences]
        self.machine = Automaton(sequences + [p for p, _ in self.phrases], self.phrases)
        hashes = np.array([common.word_hash(w) for w in vocabulary], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes, self.words = hashes[self.order], list(vocabulary)

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of every word, -1 if it has none."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def scan(self, known: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Base places (first word, phrase) and long matches (template, text end,
        template end, words) of one text."""
        places, matches = [], []
        inside = known >= 0
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
        m = self.machine
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo < 2:
                continue
            state = length = 0
            run = known[lo:hi].tolist()
            for i, word in enumerate(run, lo):
                while state and word not in m.next[state]:
                    state = m.link[state]
                    length = m.length[state]
                if word in m.next[state]:
                    state, length = m.next[state][word], length + 1
                else:
                    length = 0
                for p, size in m.phrases[state]:
                    if size <= length:
                        places.append((i - size + 1, p))
                self._grown(state, length, i, run[i + 1 - lo] if i + 1 < hi else -1, matches)
        return places, matches

    def _grown(self, state: int, length: int, i: int, following: int, matches: list) -> None:
        """Matches that end at word i and go on in no template: the suffix links lead to
        the places in templates that hold only the match's last words."""
        m, seen = self.machine, set()
        while length >= MIN_PIECE:
            for t, k in m.ends[state]:
                if t < len(self.sizes) and (t, k) not in seen:
                    seen.add((t, k))
                    if k + 1 >= self.sizes[t] or self.sequences[t][k + 1] != following:
                        matches.append((t, i, k, min(length, k + 1)))
            state = m.link[state]
            length = m.length[state]

    def spans(self, matches: list[tuple[int, int, int, int]], known: np.ndarray) -> list[tuple[int, int, int, float]]:
        """Best chains of matches per template: (template, first word, last word, cover)."""
        by: dict[int, set[tuple[int, int, int]]] = {}
        for t, end, k, size in matches:
            by.setdefault(t, set()).add((end, k, size))
        out = []
        for t, found in by.items():
            for chain in best_chains(sorted(found)):
                first, last, covered = self._filled(t, chain, known)
                span = (t, first, last, covered / self.sizes[t])
                if self.labels(span) or any(size >= MIN_MATCH for _, _, size in chain):
                    out.append(span)
        return out

    def labels(self, span: tuple[int, int, int, float]) -> bool:
        """Whether a span is most of its template, and its template most of the span."""
        t, first, last, cover = span
        return cover * self.sizes[t] >= MIN_COVER * max(self.sizes[t], last - first + 1)

    def _filled(self, t: int, chain: list[tuple[int, int, int]], known: np.ndarray) -> tuple[int, int, int]:
        """First and last word of a chain and its covered words, with those that agree
        in the gaps and within MAX_GAP words of its ends."""
        template = self.sequences[t]
        end, k, size = chain[0]
        start, head = end - size + 1, k - size + 1
        before, after = agreeing(known[max(0, start - MAX_GAP):start].tolist(), template[max(0, head - MAX_GAP):head])
        first, covered = start - (min(MAX_GAP, start) - before if after else 0), after + size
        for (e1, k1, _), (e2, k2, s2) in zip(chain, chain[1:]):
            kept = s2 - max(0, e1 - (e2 - s2), k1 - (k2 - s2))
            gap = known[e1 + 1:e2 - kept + 1].tolist()
            covered += kept + agreeing(gap, template[k1 + 1:k2 - kept + 1])[1]
        end, k, _ = chain[-1]
        behind = known[end + 1:end + 1 + MAX_GAP].tolist()
        # the same from the other side: how far the last word that agrees is
        far, more = agreeing(behind[::-1], template[k + 1:k + 1 + MAX_GAP][::-1])
        return first, end + (len(behind) - far if more else 0), covered + more


def agreeing(a: list[int], b: list[int]) -> tuple[int, int]:
    """(place in ``a`` of the first word, number of words) of a longest common subsequence."""
    best = [[(0, 0)] * (len(b) + 1) for _ in range(len(a) + 1)]  # (words, first place negated)
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1])
            if a[i] == b[j] and a[i] >= 0:
                best[i][j] = max(best[i][j], (best[i + 1][j + 1][0] + 1, -i))
    n, place = best[0][0]
    return -place, n


def best_chains(found: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Chains of (text end, template end, words) matches of one template, best first.

    A chain's worth is the words it covers.  The best chain that ends in each match is
    found over the matches in order of text end; only those that end shortly before a
    match begins, or inside it, can come before it.  Then chains are read off from the
    worthiest end, leaving out matches that a better chain has taken or lies over.
    """
    ends = [end for end, _, _ in found]
    worth, come_from = [size for _, _, size in found], [-1] * len(found)
    for j, (e2, k2, s2) in enumerate(found):
        for i in range(bisect_left(ends, e2 - s2 - MAX_GAP), j):
            e1, k1, _ = found[i]
            kept = s2 - max(0, e1 - (e2 - s2), k1 - (k2 - s2))
            if (e1 < e2 and k1 < k2 and kept > 0 and e2 - kept - e1 <= MAX_GAP and k2 - kept - k1 <= MAX_GAP
                    and worth[i] + kept > worth[j]):
                worth[j], come_from[j] = worth[i] + kept, i
    chains, taken = [], []  # taken: disjoint text ranges, in order
    used = [False] * len(found)
    for j in sorted(range(len(found)), key=lambda j: (-worth[j], found[j])):
        chain = []
        while j >= 0 and not used[j]:
            end, _, size = found[j]
            at = bisect_left(taken, (end - size + 1, -1))
            if any(a <= end and end - size + 1 <= b for a, b in taken[max(0, at - 1):at + 1]):
                break
            used[j] = True
            chain.append(found[j])
            j = come_from[j]
        if chain:
            chain.reverse()
            chains.append(chain)
            insort(taken, (chain[0][0] - chain[0][2] + 1, chain[-1][0]))
    return chains


def scan(docs: DataFrame, base: dict[str, str] = BASE, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per document: words, base places, labels, score and covered spans."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("template", pa.string()), ("first_word", pa.int64()),
                                      ("last_word", pa.int64()), ("cover", pa.float64())])))])

    def rows(part: pa.RecordBatch, scanner: Scanner) -> pa.RecordBatch:
        data, offsets = common.text_buffer(part.column(1))
        starts, _, hashes = common.words(data, offsets, common.LETTERS, common.LOWER)
        bounds = common.per_text(starts, offsets)
        known = scanner.known(hashes)
        hot = np.flatnonzero((known[:-1] >= 0) & (known[1:] >= 0))  # a match needs two known words in a row
        hot_in = np.searchsorted(hot, bounds)
        out: dict[str, list] = {name: [] for name in schema.names}
        for i, doc in enumerate(part.column(0).to_pylist()):
            lo, hi = int(bounds[i]), int(bounds[i + 1])
            places, matches = scanner.scan(known[lo:hi]) if hot_in[i] < hot_in[i + 1] else ([], [])
            spans = scanner.spans(matches, known[lo:hi]) if matches else []
            base_labels = {scanner.phrases[p][1] for _, p in places}
            labels = base_labels | {scanner.names[span[0]] for span in spans if scanner.labels(span)}
            where = [w for w, _ in places]
            score = max([1.0 if places else 0.0, *(min(1.0, cover) for _, _, _, cover in spans)])
            row = (doc, hi - lo, len(places), min(where, default=None), max(where, default=None),
                   ",".join(sorted(base_labels)), ",".join(sorted(labels)), score,
                   [{"template": scanner.names[t], "first_word": a, "last_word": b, "cover": min(1.0, c)}
                    for t, a, b, c in sorted(spans)])
            for name, value in zip(schema.names, row):
                out[name].append(value)
        return pa.RecordBatch.from_pydict(out, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, templates)
        for batch in batches:
            for part in common.pieces(batch):
                yield rows(part, scanner)

    return common.map_arrow(docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text"), run, SCHEMA)
