"""License notices in texts: winnowed fingerprints pick candidates, banded alignment measures them.

Templates and texts are sequences of words. Of every run of ``WINNOW`` consecutive word 4-grams of a template the one
with the smallest fingerprint is kept; an inverted index holds where each kept one stands. All 4-grams of a text are
looked up, so any run of WINNOW + 3 words that a text shares with a template is found. Hits of one template on nearby
diagonals form a candidate, and a local alignment in a band around these diagonals tells how many words of the template
match, and where.

A match names its license only if the words that tell the license from its siblings (family, version, variant) are those
of the template: no other may stand there and none may be missing. Else it is reported without a name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.arrow import batch, columns, map_batches
from trendspark.llm.words import LEADING_BYTES, LOWERED, byte_set, span_prints, texts, window_prints

GRAM, WINNOW = 4, 2
MIN_COVERAGE = 0.8
MATCH, MISMATCH, GAP = 2, -1, -1
_NOTICE_BYTES = byte_set(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))

# Short notices and standard wordings of public licenses.
_WORDINGS: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "ISC-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-2-Clause-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ),
    (
        "BSD-3-Clause-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "MPL-2.0-header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


# Licenses of the GNU family and the variants and versions of Creative Commons.
_GNU = (
    ("GPL-2.0", "GNU General Public License", "2"),
    ("GPL-3.0", "GNU General Public License", "3"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3"),
    ("AGPL-3.0", "GNU Affero General Public License", "3"),
)
_CC_VARIANTS = ("BY", "BY-SA", "BY-NC", "BY-NC-SA", "BY-ND", "BY-NC-ND")
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def _family_templates() -> Iterator[tuple[str, str]]:
    for name, title, version in _GNU:
        yield name, f"This work is licensed under the {title}, version {version}."
        yield (
            f"{name}-header",
            f"This program is free software: you can redistribute it and/or modify it under the terms of the {title} as "
            f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
            "later version.",
        )
    for version in _CC_VERSIONS:
        for variant in _CC_VARIANTS:
            yield f"CC-{variant}-{version}", f"Licensed under CC {variant} {version}."


TEMPLATES: tuple[tuple[str, str], ...] = (*_WORDINGS, *_family_templates())

# The words that tell a license from its siblings, by the beginning of its name.
_TELLING = {
    "GPL": "gnu general lesser library affero 1 2 3",
    "LGPL": "gnu general lesser library affero 1 2 3",
    "AGPL": "gnu general lesser library affero 1 2 3",
    "CC-": "cc by sa nc nd 0 1 2 3 4 5",
    "Apache": "apache 0 1 2",
    "MPL": "mozilla mpl 0 1 2",
    "MIT": "mit bsd isc",
    "BSD": "neither endorse",
}
# Words before a notice that deny it.
_DENIALS = "not never"


def notice_prints(text: bytes) -> np.ndarray:
    """Fingerprints of the words (ASCII letters and digits, non-ASCII characters, A-Z lower-cased) of a text."""
    for some in texts(pa.array([text], pa.large_binary())):
        inside = _NOTICE_BYTES[some.data]
        return span_prints(LOWERED[some.data], *some.spans(inside))
    return np.zeros(0, np.uint64)


def winnowed(prints: np.ndarray, gram: int = GRAM, window: int = WINNOW) -> list[tuple[int, int]]:
    """(fingerprint, word number) of the word grams that winnowing keeps: the last smallest of every window."""
    grams, at = window_prints(prints, np.zeros(len(prints), np.int64), gram)
    kept: dict[int, int] = {}
    for low in range(max(1, len(grams) - window + 1) if len(grams) else 0):
        some = grams[low : low + window]
        best = low + len(some) - 1 - int(np.argmin(some[::-1]))
        kept[int(at[best])] = int(grams[best])
    return [(value, place) for place, value in sorted(kept.items())]


@dataclass(frozen=True)
class Index:
    """Templates as word fingerprints, and the inverted index of their winnowed grams."""

    names: list[str]
    words: list[list[int]]
    grams: np.ndarray
    places: list[list[tuple[int, int]]]
    # For each template the telling words of its family, and those that it has.
    telling: list[tuple[frozenset[int], frozenset[int]]]
    denials: frozenset[int]

    @classmethod
    def build(cls, templates: Sequence[tuple[str, str]]) -> Index:
        prints = [notice_prints(text.encode()) for _, text in templates]
        found: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(prints):
            if 0 < len(words) < GRAM:
                raise ValueError(f"template {templates[t][0]} has fewer than {GRAM} words")
            for gram, place in winnowed(words):
                found.setdefault(gram, []).append((t, place))
        grams = sorted(found)
        telling = []
        for (name, _), words in zip(templates, prints, strict=True):
            family = " ".join(w for start, w in _TELLING.items() if name.startswith(start))
            known = frozenset(notice_prints(family.encode()).tolist())
            telling.append((known, known & set(words.tolist())))
        denials = frozenset(notice_prints(_DENIALS.encode()).tolist())
        words = [p.tolist() for p in prints]
        return cls([n for n, _ in templates], words, np.array(grams, np.uint64), [found[g] for g in grams], telling, denials)

    def names_it(self, template: int, words: list[int], matches: int, first: int, end: int) -> bool:
        """True if the words of a match tell its license from the siblings, and nothing denies it."""
        known, own = self.telling[template]
        # Where the template's first words are missing, others may stand for them.
        before = words[max(0, first - 1 - (len(self.words[template]) - matches)) : first]
        return known & set(words[first:end]) == own and not self.denials & set(before)

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``grams``, number of the known gram) of the grams in the index."""
        if not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        there = np.flatnonzero(self.grams[at] == grams)
        return there, at[there]


def aligned(template: list[int], words: list[int], low: int, high: int) -> tuple[int, int, int]:
    """(matches, first word, past the last word) of the best local alignment of a template with a text.

    Word i of the template may only stand at words i + low to i + high of the text.
    """
    n, width = len(words), high - low + 1
    # Cells hold (score, matches, first word); a row is the template's word i, a column the diagonal.
    best, zero = (0, 0, 0, 0), (0, 0, -1)
    before = [zero] * width
    for i, word in enumerate(template):
        row = []
        for k in range(width):
            j = i + low + k
            if not 0 <= j < n:
                row.append(zero)
                continue
            same = word == words[j]
            score, matches, first = before[k]
            cell = (score + MATCH, matches + 1, first if first >= 0 else j) if same else (score + MISMATCH, matches, first)
            if k + 1 < width and before[k + 1][0] + GAP > cell[0]:
                score, matches, first = before[k + 1]
                cell = (score + GAP, matches, first)
            if k and row[k - 1][0] + GAP > cell[0]:
                score, matches, first = row[k - 1]
                cell = (score + GAP, matches, first)
            if cell[0] <= 0:
                cell = zero
            elif same and (cell[0], cell[1]) > best[:2]:
                best = (*cell, j + 1)
            row.append(cell)
        before = row
    return best[1], best[2], best[3]


def _band(template: list[int]) -> int:
    return max(2, len(template) // 8)


Found = tuple[int, bool, float, int, int]


def found_in(index: Index, prints: np.ndarray, places: list[tuple[int, int, int]], min_coverage: float) -> list[Found]:
    """(template, named, coverage, first word, past the last) of the notices of one text; ``places`` are its hits
    (template, diagonal, word)."""
    out: list[Found] = []
    words = prints.tolist()
    groups: list[list[tuple[int, int, int]]] = []
    for hit in sorted(places):
        group = groups[-1] if groups else None
        band = _band(index.words[hit[0]])
        # A group spans a few bands, however long a text goes on repeating itself.
        if group and group[-1][0] == hit[0] and hit[1] - group[-1][1] <= band and hit[1] - group[0][1] <= 2 * band:
            group.append(hit)
        else:
            groups.append([hit])
    for group in groups:
        t = group[0][0]
        template, band = index.words[t], _band(index.words[t])
        matches, first, end = aligned(template, words, group[0][1] - band, group[-1][1] + band)
        # Most of the template must stand there, and most of what stands there must be the template.
        if matches and matches >= min_coverage * max(len(template), end - first):
            out.append((t, index.names_it(t, words, matches, first, end), matches / len(template), first, end))
    # Templates share wording: of overlapping matches a named one counts first, then the one with most words, then the one
    # that fits best, then the template that stands first in the list.
    def rank(found: Found) -> tuple:
        t, named, coverage, first, end = found
        size = len(index.words[t])
        matches = round(coverage * size)
        return not named, -matches, -matches / max(size, end - first), first, end, t

    chosen: list[Found] = []
    for found in sorted(set(out), key=rank):
        if not any(found[3] < end and first < found[4] for *_, first, end in chosen):
            chosen.append(found)
    return sorted(chosen, key=lambda f: f[3:])


_FOUND = "id bigint, license string, coverage double, start bigint, end bigint, start_word bigint, end_word bigint"
_FOUND_ARROW = pa.schema(
    [("id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64())]
)


def scan_licenses(
    df: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    min_coverage: float = MIN_COVERAGE,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row (id, license, coverage, start, end, start_word, end_word) for each notice in a text of ``df``.

    ``coverage`` is the share of the template's words that match, ``start`` and ``end`` are code points of the text.
    ``license`` is null where the wording matches but a word that tells the license from its siblings does not, or where
    ``not`` stands before the notice. Of overlapping matches one is reported: a named one, the one with most words, the one
    that fits best, the first template. Null and empty texts have no notices; a text of any length is searched whole, in
    time in proportion to its words and hits; null and repeated ids give rows of their own; other columns are ignored.
    Templates are few: they are sent to all tasks.
    """
    index = Index.build(templates)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: list[tuple] = []
            ids = rows.column(0)
            for some in texts(rows.column(1)):
                starts, ends = some.spans(_NOTICE_BYTES[some.data])
                row = some.rows_of(starts)
                prints = span_prints(LOWERED[some.data], starts, ends)
                grams, at = window_prints(prints, row, GRAM)
                there, known = index.hits(grams)
                hits: dict[int, list[tuple[int, int]]] = {}
                for word, gram in zip(at[there].tolist(), known.tolist(), strict=True):
                    hits.setdefault(int(row[word]), []).append((word, gram))
                for r, words in hits.items():
                    first, last = (int(x) for x in np.searchsorted(row, (r, r + 1)))
                    places = [(t, w - first - place, w - first) for w, gram in words for t, place in index.places[gram]]
                    body = some.data[some.offsets[r] : some.offsets[r + 1]]
                    points = np.concatenate(([0], np.cumsum(LEADING_BYTES[body])))
                    base = int(some.offsets[r])
                    for t, named, coverage, a, b in found_in(index, prints[first:last], places, min_coverage):
                        start, end = int(points[starts[first + a] - base]), int(points[ends[first + b - 1] - base])
                        out.append((ids[some.first + r].as_py(), index.names[t] if named else None, coverage, start, end, a, b))
            yield batch(_FOUND_ARROW, *(zip(*out, strict=True) if out else [[]] * 7))

    source = columns(df, id=id_col, text=text).withColumn("id", F.col("id").cast("bigint"))
    return map_batches(source, task, _FOUND).withColumnRenamed("id", id_col)
