"""Licence scans with a generalised suffix automaton.

The automaton recognises every run of words of every licence template. A text streams through it once, which gives for each word the
longest run ending there that some template holds (matching statistics); suffix links lead to the shorter runs that other templates hold. Runs of ``LONG``
words or more that can't be extended at their place in a template are chained, for each template, into the largest part of the template that they cover in
order; a template is reported when that part is large enough. A run inside a longer run of a reported template counts for no other label: the notice of
one version isn't that of another. Words that no template has cut the stream, so only stretches of ``LONG`` template words in a row need the automaton at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import arrow, slices, table

LONG = 4
GAP = 60  # words between matches of one chain
COVERED = 0.6
#: Fixed phrases of the base search.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Fixed texts: notices, grants and whole short licences as licensors publish them, in lower-case words. Longer texts (whole GPL, Apache) are passed as ``templates``.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ],
    "gpl-3.0": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    ],
    "gpl-2.0": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "lgpl": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "cc-by-4.0": ["this work is licensed under a creative commons attribution 4 0 international license", "licensed under cc by 4 0"],
    "cc-by-sa-4.0": ["this work is licensed under a creative commons attribution sharealike 4 0 international license", "licensed under cc by sa 4 0"],
    "cc-by-nc-4.0": ["this work is licensed under a creative commons attribution noncommercial 4 0 international license", "licensed under cc by nc 4 0"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    ],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"],
    "zlib": ["this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions the origin of this software must not be misrepresented you must not claim that you wrote the original software altered source versions must be plainly marked as such and must not be misrepresented as being the original software this notice may not be removed or altered from any source distribution"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"],
    "rights-reserved": ["all rights reserved"],
}

#: Bytes of a text to those that separate words (space) or belong to them: letters, digits and all beyond ASCII.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, offsets of each text's): lower-cased letters, digits and characters beyond ASCII."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    # one pass over the bytes of the whole buffer; places of texts stay
    _, offsets, data = texts.buffers()
    data = pa.py_buffer(data.to_pybytes().translate(_WORDS) if data is not None else b"")
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, data], offset=texts.offset)
    pieces = pc.ascii_split_whitespace(plain)
    real = pc.not_equal(pieces.values, "")
    upto = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return pieces.values.filter(real), upto[pieces.offsets.to_numpy()]


class Automaton:
    """Suffix automaton of several word sequences; a state knows in which templates, and where, its runs end."""

    def __init__(self, sequences: list[list[int]]):
        self.sequences = sequences
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]  # template -> first end
        self.places: list[set[tuple[int, int]]] = [set()]  # (template, end), all of them
        for t, seq in enumerate(sequences):
            last = 0
            for at, c in enumerate(seq):
                last = self._extend(last, c)
                self.ends[last].setdefault(t, at + 1)
                self.places[last].add((t, at + 1))
        # a run of a longer state ends where the longer one does
        for s in sorted(range(1, len(self.length)), key=lambda x: -self.length[x]):
            self.places[self.link[s]] |= self.places[s]
            up = self.ends[self.link[s]]
            for t, at in self.ends[s].items():
                up[t] = min(up.get(t, at), at)

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        self.places.append(set())
        return len(self.length) - 1

    def _split(self, p: int, c: int) -> int:
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        self.link[new] = 0 if p < 0 else self._split(p, c)
        return new

    def statistics(self, codes: list[int]):
        """(length, state) of the longest run of a template that ends at each word."""
        state = length = 0
        out = []
        for c in codes:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if c in self.next[state]:
                state = self.next[state][c]
                length += 1
            out.append((length, state))
        return out

    def matches(self, codes: list[int], long: int = LONG) -> list[tuple[int, int, int, int]]:
        """(end in text, template, first and end in template) of runs of ``long`` words or more that can't be extended at that place of the template."""
        out = []
        for i, (n, state) in enumerate(self.statistics(codes)):
            after = codes[i + 1] if i + 1 < len(codes) else None
            below: set[tuple[int, int]] = set()
            while n >= long:
                for t, end in self.places[state] - below:
                    seq = self.sequences[t]
                    if end == len(seq) or seq[end] != after:
                        out.append((i + 1, t, end - n, end))
                below = self.places[state]
                state = self.link[state]
                n = self.length[state]
        return out


class Scanner:
    def __init__(self, templates: dict[str, list[str]] = TEMPLATES):
        own, offsets = split_words(pa.array([text for texts in templates.values() for text in texts], pa.string()))
        labels = [label for label, texts in templates.items() for _ in texts]
        rows = [(label, own[int(a) : int(b)].to_pylist()) for label, a, b in zip(labels, offsets, offsets[1:], strict=False)]
        phrases = [p.split() for p in PHRASES]
        vocabulary = sorted({w for _, ws in rows for w in ws} | {w for p in phrases for w in p})
        code = {w: k for k, w in enumerate(vocabulary)}
        self.vocabulary = pa.array(vocabulary, pa.large_string())
        self.labels = [label for label, _ in rows]
        self.sizes = [len(ws) for _, ws in rows]
        self.long = min(LONG, *self.sizes)
        self.automaton = Automaton([[code[w] for w in ws] for _, ws in rows])
        self.phrases = [([code[w] for w in p], label) for p, label in zip(phrases, PHRASES.values(), strict=True)]

    def chain(self, t: int, rows: list[tuple[int, int, int]]) -> tuple[int, list[tuple[int, int]]]:
        """(words, runs in the text) of the chain that covers most of template ``t``; no word of either counts twice."""
        size, top, last = self.sizes[t], (0, -1), -GAP
        rows = sorted(rows)
        before: list[int] = []  # the match before, in the best chain that ends with each
        best = who = None
        recent: list[tuple[int, int, int, int]] = []  # (end in text, end in template, value, match) of those that a later match may overlap in the text
        for k, (at, a, b) in enumerate(rows):
            start = at - (b - a)
            if best is None or start - last > GAP:
                best = np.zeros(size + 1, dtype=np.int64)  # most words covered by a chain that ends at a place or before
                who = np.full(size + 1, -1)
                recent = []
            while recent and recent[0][0] <= at - size:
                _, y, value, j = recent.pop(0)
                better = best[y:] < value
                best[y:][better], who[y:][better] = value, j
            values = best[: b + 1] + b - np.maximum(a, np.arange(b + 1))
            p = int(values.argmax())
            value, prior = int(values[p]), int(who[p])
            for x, y, v, j in recent:
                if x < at and y < b:
                    v += min(b - max(a, y), at - max(start, x))
                    if v > value:
                        value, prior = v, j
            before.append(prior)
            recent.append((at, b, value, k))
            top, last = top if top[0] >= value else (value, k), at
            if value == size:
                break
        runs, k = [], top[1]
        while k >= 0:
            at, a, b = rows[k]
            runs.append((at - (b - a), at))
            k = before[k]
        return top[0], runs

    def parts(self, found: list[tuple[int, int, int, int]]) -> tuple[float, set[str]]:
        """(covered part of the best chain, labels of templates that are covered)."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for at, t, a, b in found:
            by.setdefault(t, []).append((at, a, b))
        chains = {t: self.chain(t, rows) for t, rows in by.items()}
        score = max((words / self.sizes[t] for t, (words, _) in chains.items()), default=0.0)
        labels: set[str] = set()
        # most words first; what lies inside a longer run of a reported template is no sign of another label
        while chains:
            t = max(chains, key=lambda x: (chains[x][0], -x))
            words, runs = chains.pop(t)
            if words / self.sizes[t] < COVERED:
                continue
            labels.add(self.labels[t])
            for o in [o for o in chains if self.labels[o] != self.labels[t]]:
                left = [(at, a, b) for at, a, b in by[o] if not any(x <= at - (b - a) and at <= y and b - a < y - x for x, y in runs)]
                if len(left) < len(by[o]):
                    by[o] = left
                    chains[o] = self.chain(o, left)
        return score, labels

    def scan(self, texts: pa.Array) -> list[tuple]:
        """(n_words, n_base, first, last, base labels, labels, score) of each text."""
        words, offsets = split_words(texts)
        codes = pc.fill_null(pc.index_in(words, value_set=self.vocabulary), -1).to_numpy().astype(np.int64)
        n = np.diff(offsets)
        row = np.repeat(np.arange(len(n)), n)
        places: list[list[tuple[int, str]]] = [[] for _ in n]
        for seq, label in self.phrases:
            k = len(seq)
            if len(codes) < k:
                continue
            hit = row[: len(row) - k + 1] == row[k - 1 :]
            for j, c in enumerate(seq):
                hit = hit & (codes[j : len(codes) - k + 1 + j] == c)
            for i in np.flatnonzero(hit).tolist():
                places[row[i]].append((i - int(offsets[row[i]]), label))
        # stretches of template words inside one text
        known = np.concatenate([[False], codes >= 0, [False]])
        cut = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
        starts = np.flatnonzero(known[1:-1] & (~known[:-2] | cut))
        ends = np.flatnonzero(known[1:-1] & (~known[2:] | np.concatenate([cut[1:], [True]]))) + 1 if len(row) else starts
        found: dict[int, list] = {}
        for k in np.flatnonzero(ends - starts >= self.long).tolist():
            a, b = int(starts[k]), int(ends[k])
            base = a - int(offsets[row[a]])
            for at, t, x, y in self.automaton.matches(codes[a:b].tolist(), self.long):
                if y - x >= min(LONG, self.sizes[t]):
                    found.setdefault(int(row[a]), []).append((base + at, t, x, y))
        out = []
        for i in range(len(n)):
            score, own = self.parts(found[i]) if i in found else (0.0, set())
            base = sorted({label for _, label in places[i]})
            at = [p for p, _ in places[i]]
            out.append((int(n[i]), len(at), min(at, default=None), max(at, default=None), ",".join(base), ",".join(sorted({*base, *own})), score))
        return out


_SCANNERS: dict[str, Scanner] = {}


def scanner(templates: dict[str, list[str]] | None = None) -> Scanner:
    """A scanner for the texts; a worker keeps the last one."""
    name = repr(sorted(templates.items())) if templates else ""
    if name not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[name] = Scanner(templates or TEMPLATES)
    return _SCANNERS[name]


NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _scanned(templates):
    def run(batches):
        for b in slices(batches, "text"):
            cols = list(zip(*scanner(templates).scan(b.column(1)), strict=True))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["doc_id", *NAMES])

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row for each row of ``docs`` (doc_id, text used).

    Null, empty and wordless texts have no words, no places and score 0; null ids and repeated rows give rows of their own; an empty table
    gives an empty table; other columns are ignored; texts are scanned whole. ``templates`` (label to texts) replaces the texts above; of labels with
    the same words covered the first counts first.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return arrow(docs.select("doc_id", "text"), _scanned(templates), schema)


def op6_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))
