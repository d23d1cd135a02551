"""Licence scans: a generalised suffix automaton of licence tokens, streamed over every text.

All templates and phrases go into one automaton over words. A text is streamed through it: after each word the automaton
knows the longest suffix read so far that occurs in some template (the matching statistic) and where it occurs. A place
in a template that the next word does not continue is a match, reported if it is long (LONG words, or the whole of a shorter
template). Matches of one template that follow each other in the text and in the template, with gaps of at most GAP words
in either, are chained into spans; a span is the template's if it covers SHARE of the template's words. Of spans that
overlap by more than half the one with more covered words stays. Phrases are templates that only count whole; the automaton's
states know which phrases end there.

One narrow pass. Words are found with numpy; as a statistic of two words or more needs a pair of neighbours that some
template has, only runs of such pairs are streamed word by word, which leaves all statistics of two and more as they are.
The automaton, under twice as many states as template words (at most MAX_WORDS, checked), is broadcast.

Defined results: null or empty text has no words, empty labels and score 0; words before and after a place don't matter,
so places may overlap and lie in templates; a match hidden inside a longer match of other templates is not reported; a
repeated row is a document of its own; an empty table gives an empty result; templates of one word are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .decontaminate import words_of
from .kernel import flat, runs

LONG, GAP, SHARE = 5, 12, 0.5
MAX_WORDS = 1 << 20
PIECE = 4 << 20

# The phrases of the contract, and the wording of public licences and of the notices that name them.
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License."""),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions
        and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
        and the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("bsd-3-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions
        and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
        and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of
        the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission."""),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-2.0", "GNU General Public License version 2"),
    ("gpl-3.0", "GNU General Public License version 3"),
    ("gpl-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies."""),
    ("lgpl", "GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
        in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
        IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means."""),
]


class Automaton:
    """States of all substrings of several sequences: ``next``, ``link`` and ``length``; state 0 is the empty string."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, c: int) -> int:
        """The state for the longest string of p followed by c, cut out of a state that has longer ones too."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = own
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = own
            p = self.link[p]
        return own

    def add(self, tokens: list[int]) -> None:
        last = 0
        for c in tokens:
            if c in self.next[last]:  # an earlier sequence has it
                last = self._split(last, c)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, c)
            last = new

    def walk(self, tokens: list[int]) -> list[int]:
        """The state after each token of one of the sequences."""
        out, s = [], 0
        for c in tokens:
            s = self.next[s][c]
            out.append(s)
        return out


def compile_templates(templates=TEMPLATES, phrases=PHRASES) -> dict:
    """The automaton with what its states stand for: places in templates, and phrases that end there."""
    texts = [t for _, t in (*templates, *phrases)]
    words, first = words_of(*flat(pa.array(texts, pa.string())))
    if len(words) > MAX_WORDS or (np.diff(first) < 2).any():
        raise ValueError(f"templates have two words at least, and together at most {MAX_WORDS}")
    vocabulary, code = np.unique(words, return_inverse=True)
    rows = [code[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
    m = Automaton()
    for r in rows:
        m.add(r)
    n = len(m.link)
    places: list[set] = [set() for _ in range(n)]
    whole: list[tuple] = [() for _ in range(n)]
    for t, r in enumerate(rows[: len(templates)]):
        for end, s in enumerate(m.walk(r), 1):
            places[s].add((t, end))
    for p, r in enumerate(rows[len(templates) :]):
        whole[m.walk(r)[-1]] += (p,)
    need = [min(LONG, len(r)) for r in rows[: len(templates)]]
    order = sorted(range(1, n), key=lambda s: -m.length[s])
    for s in order:  # what ends with a string ends with its suffixes, as far as they are long
        up = m.link[s]
        places[up] |= {x for x in places[s] if m.length[up] >= need[x[0]]}
    above: list[tuple] = [() for _ in range(n)]
    for s in reversed(order):
        above[s] = above[m.link[s]] + whole[m.link[s]]
    v = len(vocabulary)
    pairs = np.unique([a * v + b for r in rows for a, b in zip(r, r[1:])]).astype(np.uint64)
    return {
        "next": m.next, "link": m.link, "length": m.length, "places": [tuple(sorted(x)) for x in places], "whole": whole, "above": above, "need": need, "size": [len(r) for r in rows[: len(templates)]],
        "labels": [x for x, _ in templates], "phrases": [x for x, _ in phrases], "phrase_size": [len(r) for r in rows[len(templates) :]], "vocabulary": vocabulary, "pairs": pairs,
    }


def codes(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Numbers of the words, -1 for those that no template has."""
    if not len(vocabulary):
        return np.full(len(words), -1)
    at = np.searchsorted(vocabulary, words)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == words, at, -1)


def stream(m: dict, tokens: list[int], begin: int, matches: list, found: list) -> None:
    """One run of words; ``begin`` is the place of the first. Adds (start, length, places) and (phrase, start)."""
    move, link, length, places, whole, above = m["next"], m["link"], m["length"], m["places"], m["whole"], m["above"]
    s = size = 0
    for i, c in enumerate(tokens, begin):
        before, size_before = s, size
        while s and c not in move[s]:
            s = link[s]
            size = length[s]
        if c in move[s]:
            s = move[s][c]
            size += 1
        else:
            size = 0
        had = places[before]
        if had and not (size == size_before + 1 and len(places[s]) == len(had)):
            go_on = {(t, e - 1) for t, e in places[s]} if size == size_before + 1 else ()
            if ended := [x for x in had if x not in go_on]:
                matches.append((i - size_before, size_before, ended))
        for p in above[s]:
            found.append((p, i + 1 - m["phrase_size"][p]))
        if whole[s] and size == length[s]:
            for p in whole[s]:
                found.append((p, i + 1 - m["phrase_size"][p]))
    if places[s]:
        matches.append((begin + len(tokens) - size, size, places[s]))


def chain(m: dict, matches: list) -> list[tuple[int, int, int, int]]:
    """(template, start, end, covered words) of chained matches of one text, matches in the order of their ends."""
    out, open_ = [], {}
    for start, size, places in matches:
        by_template: dict[int, list[int]] = {}
        for t, end in places:
            if size >= m["need"][t]:
                by_template.setdefault(t, []).append(end)
        for t, ends in by_template.items():
            now = open_.get(t)
            best = None
            if now is not None and start - now[2] <= GAP:
                for end in ends:
                    extra = min(size, end - now[3], start + size - now[2])
                    gap = end - extra - now[3]
                    if extra > 0 and gap <= GAP and (best is None or gap < best[0]):
                        best = (gap, extra, end)
            if best is not None:
                open_[t] = (t, now[1], start + size, best[2], now[4] + best[1])
            else:
                if now is not None:
                    out.append((t, now[1], now[2], now[4]))
                open_[t] = (t, start, start + size, min(ends), size)
    return out + [(t, a, b, c) for t, a, b, _, c in open_.values()]


def resolve(m: dict, chains: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, int, float]]:
    """(label, start, end, covered, share) of the spans that stay, by place."""
    spans = [(c, c / m["size"][t], m["labels"][t], a, b) for t, a, b, c in chains if c >= SHARE * m["size"][t]]
    spans.sort(key=lambda x: (-x[0], -x[1], x[2], x[3]))
    out = []
    if spans:
        base = min(x[3] for x in spans)
        taken = np.zeros(max(x[4] for x in spans) - base, bool)
        for c, share, label, a, b in spans:
            own = taken[a - base : b - base]
            if 2 * int(own.sum()) <= b - a:
                own[:] = True
                out.append((label, a, b, c, min(1.0, share)))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())])
RESULTS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def _scan(block, kept: int):
    @X.tidy
    def run(batches):
        m = block.value
        v = np.uint64(max(1, len(m["vocabulary"])))
        for table in X.gathered(batches, PIECE):
            words, first = words_of(*flat(table["body"]))
            n = table.num_rows
            code = codes(words, m["vocabulary"])
            pair = np.zeros(len(words), bool)
            both = np.flatnonzero((code[:-1] >= 0) & (code[1:] >= 0)) if len(words) else np.zeros(0, np.int64)
            pair[both] = X.member(code[both].astype(np.uint64) * v + code[both + 1].astype(np.uint64), m["pairs"])
            pair[first[1:-1][first[1:-1] > 0] - 1] = False  # texts end here
            a, b = runs(pair)
            doc = np.searchsorted(first, a, "right") - 1
            matches: dict[int, list] = {}
            found: dict[int, list] = {}
            for d, x, y in zip(doc.tolist(), a.tolist(), b.tolist()):
                stream(m, code[x : y + 1].tolist(), x - int(first[d]), matches.setdefault(d, []), found.setdefault(d, []))
            rows = []
            for d, size in enumerate(np.diff(first).tolist()):
                base = found.get(d, [])
                chains = chain(m, matches.get(d, []))
                spans = resolve(m, chains)
                own = sorted({m["phrases"][p] for p, _ in base})
                at = [x for _, x in base]
                score = 1.0 if base else max((min(1.0, c / m["size"][t]) for t, _, _, c in chains), default=0.0)
                rows.append((size, len(base), min(at, default=None), max(at, default=None), ",".join(own), ",".join(sorted({*own, *(s[0] for s in spans)})), score, [dict(zip(("label", "start", "end", "covered", "share"), s)) for s in spans]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(SPAN)]
            out = {f"k{i}": table[f"k{i}"] for i in range(kept)} | {name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(zip(RESULTS, kinds))}
            yield from pa.table(out).combine_chunks().to_batches(max_chunksize=max(1, min(n, 4000)))

    return run


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with n_words, n_base (places of phrases), first_word and last_word (their least and greatest
    start), base_labels, labels (phrases and spans), score (greatest share of a template or phrase that is there) and
    spans (label, start, end exclusive, covered words, share of the template)."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    X.small_batches(docs.sparkSession)
    block = docs.sparkSession.sparkContext.broadcast(compile_templates(templates, phrases))
    base = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("body"))
    cols = "".join(f"k{i} {base.schema[f'k{i}'].dataType.simpleString()}, " for i in range(len(keep)))
    found = base.mapInArrow(_scan(block, len(keep)), f"{cols}n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<label: string, start: bigint, end: bigint, covered: bigint, share: double>>")
    return X.renamed(found, keep, RESULTS)


def op11(spark, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep=["doc_id"])
