"""License scans: winnowed fingerprints of templates pick candidates, banded alignment measures them.

Templates and texts are reduced to their letters and digits; hashes of character k-grams are winnowed, so a common
run of K + WINDOW - 1 characters has a fingerprint in common. The templates' fingerprints are an inverted index that
goes to the executors (templates are a parameter of bounded size). Of a whole license, hits near one diagonal are a
candidate stretch, so any part of it is found; of a short notice, each hit is a candidate of all its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .columns import doc_rows, text_bytes

# Notices of well-known public licenses; between bars, the words that tell them from others.
NOTICES = {
    "MIT-notice": "Released under the |MIT License|",
    "ISC-notice": "Released under the |ISC License|",
    "Apache-2.0-notice": "Licensed under the |Apache License|, |Version 2.0|",
    "GPL-2.0-notice": "This work is licensed under the |GNU General Public License|, |version 2|",
    "GPL-3.0-notice": "This work is licensed under the |GNU General Public License|, |version 3|",
    "LGPL-2.1-notice": "This work is licensed under the |GNU Lesser General Public License|, |version 2.1|",
    "LGPL-3.0-notice": "This work is licensed under the |GNU Lesser General Public License|, |version 3|",
    "AGPL-3.0-notice": "This work is licensed under the |GNU Affero General Public License|, |version 3|",
    "MPL-2.0-notice": "Licensed under the |Mozilla Public License|, |Version 2.0|",
    "CC-BY-4.0-notice": "Licensed under |CC BY 4.0|",
    "CC-BY-SA-4.0-notice": "Licensed under |CC BY-SA 4.0|",
    "CC-BY-NC-4.0-notice": "Licensed under |CC BY-NC 4.0|",
    "CC-BY-NC-SA-4.0-notice": "Licensed under |CC BY-NC-SA 4.0|",
    "CC-BY-ND-4.0-notice": "Licensed under |CC BY-ND 4.0|",
    "CC-BY-NC-ND-4.0-notice": "Licensed under |CC BY-NC-ND 4.0|",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the |GNU General Public License| as published by the Free Software Foundation; either |version 2| of the License, or (at your option) any later version",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the |GNU General Public License| as published by the Free Software Foundation, either |version 3| of the License, or (at your option) any later version",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the |GNU Affero General Public License| as published by the Free Software Foundation, either |version 3| of the License, or (at your option) any later version",
}
# Licenses given whole, each in a file of its name.
WHOLE = ("Apache-2.0", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0")


def packaged_templates() -> dict[str, str]:
    """The notices, the whole texts shipped with this module, and an SPDX line for each license."""
    texts = {name: (files(__package__) / "license_texts" / f"{name}.txt").read_text("utf-8") for name in WHOLE}
    bsd = texts["BSD-3-Clause"]
    texts["BSD-2-Clause"] = bsd[: bsd.index("3. Neither")] + bsd[bsd.index("THIS SOFTWARE") :]
    spdx = {f"{name}-SPDX": f"|SPDX-License-Identifier: {name}|" for name in texts}
    return NOTICES | texts | spdx


# Characters of a fingerprint, hashes of which one is kept, words an alignment may shift, share of words to report.
K, WINDOW, BAND, COVERAGE = 10, 6, 8, 0.8
# Templates of so many words are found in parts too: parts of at least LEAST words, whose hits are at most GAP apart.
LONG, LEAST, GAP = 60, 25, 40
# Pairs of fingerprints looked at together.
TOGETHER = 1 << 18

_DROP = bytes(b for b in range(128) if not chr(b).isalnum())
_LOWER = bytes(ord(chr(b).lower()) if b < 128 else b for b in range(256))
_KEPT = np.array([b not in _DROP for b in range(256)])
_WORD = re.compile(r"[A-Za-z0-9]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def winnow(bare: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k-grams and their places: of every ``window`` in a row the least; of fewer, the least of all."""
    n = len(bare) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            hashes = hashes * _BASE + bare[i : i + n] + np.uint64(1)
        hashes ^= hashes >> np.uint64(29)
        hashes *= _BASE
    if n <= window:
        at = np.array([int(hashes.argmin())])
    else:
        # The place of the least of each window, by doubling: no more than one array per power of two.
        best, width = np.arange(n), 1
        while width < window:
            step = min(width, window - width)
            left, right = best[:-step], best[step:]
            best = np.where(hashes[left] <= hashes[right], left, right)
            width += step
        at = np.unique(best)
    return hashes[at], at


def align(template: Sequence[str], words: Sequence[str], band: int = BAND) -> tuple[int, int]:
    """Most words of ``template`` found in order in ``words``, both from their beginnings; how many words that takes.

    Word i of the one meets word j of the other only where they are at most ``band`` apart.
    """
    before: dict[int, int] = {}
    best, reach = 0, 0
    for i, wanted in enumerate(template):
        row: dict[int, int] = {}
        for j in range(max(0, i - band), min(len(words), i + band + 1)):
            count = max(before.get(j, 0), row.get(j - 1, 0))
            if words[j] == wanted:
                count = max(count, before.get(j - 1, 0) + 1)
                if count > best or (count == best and j + 1 < reach):
                    best, reach = count, j + 1
            row[j] = count
        before = row
    return best, reach


def _holds(words: Sequence[str], phrase: Sequence[str]) -> bool:
    return any(list(words[i : i + len(phrase)]) == list(phrase) for i in range(len(words) - len(phrase) + 1))


class Index:
    """The templates' fingerprints as sorted hashes, each with its template and the word it begins in."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        lower = [templates[n].lower() for n in self.names]
        self.words = [_WORD.findall(t) for t in lower]
        self.telling = [[_WORD.findall(p) for p in t.split("|")[1::2]] for t in lower]
        found = []
        for t, words in enumerate(self.words):
            starts = np.repeat(np.arange(len(words)), [len(w) for w in words])
            hashes, places = winnow(np.frombuffer("".join(words).encode(), np.uint8))
            found.append((hashes, np.full(len(hashes), t), starts[places]))
        self.hashes, self.template, self.word = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (zip(*found) if found else [[]] * 3))
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.template, self.word = self.hashes[order], self.template[order], self.word[order]
        self.long = np.array([len(w) >= LONG for w in self.words], bool)

    def matches(self, text: bytes, coverage: float = COVERAGE) -> list[tuple[str, int, float, int, int]]:
        """``(template, matched, coverage, start, end)`` of a text, in code points, without overlaps, in order."""
        bare = np.frombuffer(text.translate(_LOWER, _DROP), np.uint8)
        hashes, places = winnow(bare)
        if not len(hashes) or not len(self.hashes):
            return []
        low, high = np.searchsorted(self.hashes, hashes), np.searchsorted(self.hashes, hashes, side="right")
        hit = np.flatnonzero(high > low)
        if not len(hit):
            return []
        whole = text.decode("utf-8", "replace")
        spans = [m.span() for m in _WORD.finditer(whole)]
        words = [whole[a:b].lower() for a, b in spans]
        # The code point of a byte of the bare text, and the word that it is in.
        raw = np.frombuffer(text, np.uint8)
        point_at = np.cumsum((raw & 0xC0) != 0x80)[np.flatnonzero(_KEPT[raw])[places[hit]]] - 1
        word_at = np.maximum(np.searchsorted(np.array([a for a, _ in spans] or [0]), point_at, side="right") - 1, 0)
        low, many = low[hit], (high - low)[hit]
        found, stretches = set(), []
        sums = np.cumsum(many)
        begin = 0
        while begin < len(hit):
            end = max(begin + 1, int(np.searchsorted(sums, (sums[begin - 1] if begin else 0) + TOGETHER, side="right")))
            size = many[begin:end]
            entry = np.repeat(low[begin:end] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            at, template, inside = np.repeat(word_at[begin:end], size), self.template[entry], self.word[entry]
            short = ~self.long[template]
            for w, t, q in set(zip(at[short].tolist(), template[short].tolist(), inside[short].tolist())):
                found |= self._notice(words, w, t, q, coverage)
            stretches += _stretches(at[~short], template[~short], inside[~short])
            begin = end
        for t, stretch in _joined(stretches):
            found |= self._part(words, t, stretch, coverage)
        told, taken = [], []
        # Of what overlaps, the most words are told; of as many, those that are more of their template.
        for matched, size, a, b, t in sorted(found, key=lambda f: (-f[0], f[1], f[2], f[3] - f[2], self.names[f[4]])):
            if not any(a < y and x < b for x, y in taken):
                taken.append((a, b))
                told.append((self.names[t], matched, matched / size, spans[a][0], spans[b - 1][1]))
        return sorted(told, key=lambda r: r[3:])

    def _notice(self, words: list[str], w: int, t: int, q: int, coverage: float) -> set[tuple]:
        """The whole of template ``t`` around the word ``w`` of the text that is its word ``q``."""
        template = self.words[t]
        before, back = align(template[:q][::-1], words[max(0, w - q - BAND) : w][::-1])
        after, onward = align(template[q:], words[w : w + len(template) - q + BAND])
        a, b, matched = w - back, w + onward, before + after
        if not matched or matched < coverage * len(template) or not all(_holds(words[a:b], p) for p in self.telling[t]):
            return set()
        return {(matched, len(template), a, b, t)}

    def _part(self, words: list[str], t: int, stretch: list[int], coverage: float) -> set[tuple]:
        """The stretch of template ``t`` whose first and last fingerprints are given, made longer while words agree."""
        a, b, q, r = stretch  # first and last words of the text, of the template
        template = self.words[t]
        while a and q and words[a - 1] == template[q - 1]:
            a, q = a - 1, q - 1
        while b + 1 < len(words) and r + 1 < len(template) and words[b + 1] == template[r + 1]:
            b, r = b + 1, r + 1
        if min(b - a, r - q) + 1 < LEAST:
            return set()
        matched, reach = align(template[q : r + 1], words[a : b + 1], BAND + abs(b - a - r + q))
        if matched < LEAST or matched < coverage * (r - q + 1):
            return set()
        return {(matched, len(template), a, a + reach, t)}


def _stretches(at: np.ndarray, template: np.ndarray, inside: np.ndarray) -> list[tuple[int, ...]]:
    """``(template, first word, last word, first and last word of the template)`` of two hits or more near a diagonal."""
    bucket = (at - inside) // BAND
    order = np.lexsort((inside, at, bucket, template))
    at, template, inside, bucket = at[order], template[order], inside[order], bucket[order]
    new = np.r_[True, (np.diff(template) != 0) | (np.diff(bucket) != 0) | (np.diff(at) > GAP)] if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)][: len(first)] - 1
    keep = at[last] > at[first]
    first, last = first[keep], last[keep]
    return list(zip(*(c.tolist() for c in (template[first], at[first], at[last], inside[first], inside[last]))))


def _joined(stretches: list[tuple[int, ...]]) -> Iterator[tuple[int, list[int]]]:
    """Stretches of a template that go on where others end, a little shifted, as one."""
    open_: list[list[int]] = []
    of = None
    for t, a, b, q, r in sorted(stretches):
        if t != of:
            yield from ((of, o) for o in open_)
            of, open_ = t, []
        yield from ((t, o) for o in open_ if o[1] + GAP < a)
        open_ = [o for o in open_ if o[1] + GAP >= a]
        for o in open_:
            if abs((a - q) - (o[1] - o[3])) <= BAND and o[2] <= q <= o[3] + GAP:
                if b >= o[1] and r >= o[3]:
                    o[1], o[3] = b, r
                break
        else:
            open_.append([a, b, q, r])
    yield from ((of, o) for o in open_)


def license_spans(
    docs: DataFrame, templates: Mapping[str, str] | None = None, doc_id: str = "doc_id", text: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """``<doc_id, template, matched, coverage, start, end>``: one row for each place where a text holds a template.

    ``templates`` are texts by name, by default whole public licenses, notices, and SPDX lines; words between bars
    must stand in the text as they are, one after the other. ``matched`` are the template's words found in order,
    ``coverage`` their share, ``start`` and ``end`` (exclusive) code points. Notices (under LONG words) are told with
    ``coverage`` of their words or more; of longer templates any stretch of LEAST words or more of which so many are
    found, with its share of the whole. A template given several times has a row each time; of those that overlap the
    one with most words is told, then the one of greatest coverage. Texts without one, null and empty texts have no
    row; repeated rows have theirs each. Whole texts are read. Two words or fewer are too little for a template.
    """
    templates = packaged_templates() if templates is None else templates
    shared = docs.sparkSession.sparkContext.broadcast({n: t for n, t in templates.items() if len(_WORD.findall(t)) > 2})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value)
        for batch in batches:
            rows = [
                (doc, *match)
                for doc, value in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")))
                for match in index.matches(value, coverage)
            ]
            columns = zip(*rows) if rows else [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "template", "matched", "coverage", "start", "end"]
            )

    schema = "doc_id bigint, template string, matched bigint, coverage double, start bigint, end bigint"
    return doc_rows(docs, doc_id, text).mapInArrow(scan, schema)
