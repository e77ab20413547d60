"""License scan: winnowed fingerprints pick candidates, banded alignment verifies them.

Templates and texts are sequences of words in lower case (runs of ASCII letters,
digits and non-ASCII characters). Of every two neighbouring three-word grams the
one with the smaller hash is a fingerprint, so that four words in common give one.
An inverted index maps the templates' fingerprints to their places. Hits of one
template on nearby diagonals are a candidate; its words are aligned with the text
around that diagonal, in a band, and reported if enough of them match.

Where the words that may be replaced or missing need not leave four in a row (at
0.8, templates of up to 7 words, of 10, 11 and 15), words are looked up instead: any
place where enough of the template's words stand together is a candidate.

A null or empty text or template has no words and matches nothing. Templates that repeat both name and
text count once; repeated rows of documents each give theirs. A text may hold a
template several times; of candidates that end up at overlapping spans the best is
reported, the earlier of equals. Columns other than doc_id and text are not read.

Templates are sent to the tasks in blocks of bounded size, each of which reads
the documents once. Documents are not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm.blocks import LOWER_ASCII, Words, blocks, find_words, rolling, window_starts
from brooklog.llm.decontaminate import NOT_WORDS

GRAM = 3
#: Least share of a template's words that must match.
COVERAGE = 0.8
#: Words by which a match may drift from its diagonal: this many, or this share.
BAND = 3
BAND_SHARE = 0.2
#: Words of all templates that are sent to a task at once.
BLOCK_WORDS = 1 << 19

# Notices of well-known licenses, as their authors ask to use them.
_SHORT = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0 header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-2.0 header",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-3.0 header",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1 header",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0 header",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    ),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("All rights reserved", "All rights reserved."),
)

#: Whole texts, from the first to the last word, each in a file of its name.
TEXTS = Path(__file__).with_name("license_texts")
NOTICES = _SHORT + tuple(
    (f"{file.stem} text", file.read_text(encoding="utf-8").strip().rstrip("."))
    for file in sorted(TEXTS.glob("*.txt"))
)


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "name string, text string")


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    lowered = LOWER_ASCII[data]
    words = find_words(lowered, offsets, NOT_WORDS)
    r = rolling(51)
    return words, r.runs(r.of_bytes(lowered), words.starts, words.ends)


def fingerprints(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed grams of texts whose words are ``hashes``: the word each starts at, its hash."""
    r = rolling(52)
    at, text = window_starts(first, GRAM)
    grams = r.runs(r.sums(hashes), at, at + GRAM)
    keep = np.zeros(len(at), bool)
    pair = text[1:] == text[:-1]
    left = pair & (grams[:-1] <= grams[1:])
    keep[:-1] |= left
    keep[1:] |= pair & ~left
    alone = np.ones(len(at), bool)
    alone[1:] &= ~pair
    alone[:-1] &= ~pair
    keep |= alone
    return at[keep], grams[keep]


class Postings:
    """Keys of templates, sorted, each with its template and place."""

    def __init__(self, keys: np.ndarray, template: np.ndarray, place: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.template, self.place = keys[order], template[order], place[order]

    def hits(self, at: np.ndarray, keys: np.ndarray):
        """(word, template, place in it) of every one of ``keys`` that is here."""
        if len(self.keys) == 0:
            return at[:0], self.template, self.place
        left = np.searchsorted(self.keys, keys, "left")
        hit = self.keys[np.minimum(left, len(self.keys) - 1)] == keys
        at, keys, left = at[hit], keys[hit], left[hit]
        many = np.searchsorted(self.keys, keys, "right") - left
        row = np.repeat(np.arange(len(at)), many)
        entry = left[row] + np.arange(len(row)) - (np.cumsum(many) - many)[row]
        return at[row], self.template[entry], self.place[entry]


def _drift(size: int) -> int:
    return max(BAND, int(BAND_SHARE * size))


class Index:
    """Inverted indexes of templates: by fingerprints, and by words where few may match."""

    def __init__(self, names: list[str], words: list[np.ndarray], coverage: float):
        self.names, self.words = names, words
        self.counts = [np.unique(w, return_counts=True) for w in words]
        self.least = [math.ceil(coverage * len(w)) for w in words]
        # so many words in at most so many runs: is one of them longer than a gram?
        by_word = np.array(
            [least <= GRAM * (len(w) - least + 1) for w, least in zip(words, self.least)]
        )
        self.short = np.flatnonzero(by_word)
        first = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        hashes = np.concatenate(words)
        at, grams = fingerprints(hashes, first)
        template = np.searchsorted(first, at, "right") - 1
        at, grams, template = (x[~by_word[template]] for x in (at, grams, template))
        self.grams = Postings(grams, template, at - first[template])
        at = np.arange(len(hashes))
        template = np.searchsorted(first, at, "right") - 1
        at, template = (x[by_word[template]] for x in (at, template))
        self.single = Postings(hashes[at], template, at - first[template])

    def hits(self, words: np.ndarray, first: np.ndarray):
        """(word, template, place in it) where a match may be."""
        at, template, place = self.single.hits(np.arange(len(words)), words)
        near = np.zeros(len(at), bool)
        for k in self.short if len(at) else ():
            own = np.flatnonzero(template == k)
            stands = np.unique(at[own])
            near[own] = np.isin(at[own], stands[self._together(k, stands, first)])
        found = self.grams.hits(*fingerprints(words, first))
        return [np.concatenate(x) for x in zip(found, (at[near], template[near], place[near]))]

    def _together(self, k: int, stands: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which of the words at ``stands`` are among enough of template ``k``'s."""
        least = max(self.least[k], 1)
        if len(stands) < least:
            return np.zeros(len(stands), bool)
        low, high = stands[: len(stands) - least + 1], stands[least - 1 :]
        widest = len(self.words[k]) - 1 + 2 * _drift(len(self.words[k]))
        text = np.searchsorted(first, stands, "right")
        enough = (high - low <= widest) & (text[: len(low)] == text[least - 1 :])
        edges = np.zeros(len(stands) + 1, np.int64)
        edges[: len(low)] += enough
        edges[least : least + len(low)] -= enough
        return np.cumsum(edges[:-1]) > 0

    def may_match(self, k: int, words: np.ndarray) -> bool:
        """Whether enough of template ``k``'s words are among ``words``, in any order."""
        if len(words) < self.least[k]:
            return False
        sought, counts = self.counts[k]
        at = np.minimum(np.searchsorted(sought, words), len(sought) - 1)
        there = np.bincount(at[sought[at] == words], minlength=len(sought))
        return int(np.minimum(there, counts).sum()) >= self.least[k]


def align(template: np.ndarray, words: np.ndarray, start: int, width: int):
    """Best fit of a template into words from ``start`` on, drifting up to ``width`` words.

    A match counts 2, a word replaced, missing or added -1; words before and after
    the template are free. Returns the matched places in ``words``.
    """
    m = len(template)
    column = np.arange(width + 1)
    score = np.zeros(width + 1, np.int64)
    ways = np.zeros((m, width + 1), np.int8)
    for i in range(m):
        at = start + i + column
        inside = (at >= 0) & (at < len(words))
        same = inside & (words[np.clip(at, 0, len(words) - 1)] == template[i])
        stay = score + np.where(same, 2, -1)
        skip = np.append(score[1:], -(1 << 40)) - 1
        base = np.maximum(stay, skip)
        run = np.maximum.accumulate(base + column) - column
        ways[i] = np.where(run > base, 3, np.where(stay >= skip, np.where(same, 1, 0), 2))
        score = run
    c, matched = int(np.argmax(score)), []
    i = m - 1
    while i >= 0:
        way = ways[i, c]
        if way == 3:
            c -= 1
        elif way == 2:
            c += 1
            i -= 1
        else:
            if way == 1:
                matched.append(start + i + c)
            i -= 1
    return matched[::-1]


def matches(words: np.ndarray, first: np.ndarray, index: Index, coverage: float):
    """(text, template, matched, first word, last word) of every reported match."""
    at, template, place = index.hits(words, first)
    if len(at) == 0:
        return []
    text = np.searchsorted(first, at, "right") - 1
    origin = at - place
    order = np.lexsort((origin, template, text))
    text, template, origin = text[order], template[order], origin[order]
    out: list[tuple[int, int, int, int, int]] = []
    k = 0
    while k < len(text):
        t, name = int(text[k]), int(template[k])
        own = index.words[name]
        band = _drift(len(own))
        end = k + 1
        # a chain of near diagonals, but no wider than one match can drift
        while (
            end < len(text)
            and text[end] == t
            and template[end] == name
            and origin[end] - origin[k] <= band
        ):
            end += 1
        low, high = int(origin[k]) - band, int(origin[end - 1]) + band
        body = words[first[t] : first[t + 1]]
        k, begin = end, low - int(first[t])
        if not index.may_match(name, body[max(begin, 0) : max(high - int(first[t]) + len(own), 0)]):
            continue
        found = align(own, body, begin, high - low)
        if len(found) >= coverage * len(own):
            out.append((t, name, len(found), int(first[t]) + found[0], int(first[t]) + found[-1]))
    # of overlapping spans of one template the best
    out.sort(key=lambda x: (x[0], x[1], -x[2], x[3]))
    kept: list[tuple[int, int, int, int, int]] = []
    for match in out:
        same = [x for x in reversed(kept) if x[:2] == match[:2]] if kept and kept[-1][:2] == match[:2] else []
        if all(match[3] > x[4] or match[4] < x[3] for x in same):
            kept.append(match)
    return kept


def _blocks_of(
    templates: DataFrame, coverage: float, most: int = BLOCK_WORDS
) -> Iterator[Index]:
    rows = templates.select("name", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    names, words, total = [], [], 0
    for row in rows.distinct().orderBy("name", "text").toLocalIterator():
        data = np.frombuffer(row.text.encode(), np.uint8)
        own = _hashed(data, np.array([0, len(data)]))[1]
        if len(own) == 0:
            continue
        if names and total + len(own) > most:
            yield Index(names, words, coverage)
            names, words, total = [], [], 0
        names.append(row.name)
        words.append(own)
        total += len(own)
    if names:
        yield Index(names, words, coverage)


_FOUND = (
    "doc_id long, license string, n_matched long, n_words long, coverage double, "
    "start long, end long, span string"
)


def _scan(docs: DataFrame, index: Index, coverage: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for block in blocks(batch.column("text")):
                words, hashes = _hashed(block.data, block.offsets)
                found = matches(hashes, words.first, index, coverage)
                if not found:
                    continue
                rows: dict[str, list] = {c: [] for c in ("t", "n", "k", "m", "a", "b", "s")}
                for t, name, matched, low, high in found:
                    begin = int(block.offsets[t])
                    a, b = int(words.starts[low]), int(words.ends[high])
                    before = block.data[begin:a].tobytes().decode()
                    span = block.data[a:b].tobytes().decode()
                    rows["t"].append(block.first + t)
                    rows["n"].append(index.names[name])
                    rows["k"].append(matched)
                    rows["m"].append(len(index.words[name]))
                    rows["a"].append(len(before))
                    rows["b"].append(len(before) + len(span))
                    rows["s"].append(span)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows["t"])),
                        pa.array(rows["n"], pa.string()),
                        pa.array(rows["k"], pa.int64()),
                        pa.array(rows["m"], pa.int64()),
                        pa.array([k / m for k, m in zip(rows["k"], rows["m"])], pa.float64()),
                        pa.array(rows["a"], pa.int64()),
                        pa.array(rows["b"], pa.int64()),
                        pa.array(rows["s"], pa.string()),
                    ],
                    names=[
                        "doc_id", "license", "n_matched", "n_words", "coverage",
                        "start", "end", "span",
                    ],
                )

    return docs.select("doc_id", "text").mapInArrow(run, _FOUND)


def scan(docs: DataFrame, templates: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Templates found in documents, with the share of words matched and the span.

    ``docs`` has doc_id and text, ``templates`` has name and text. Returns (doc_id,
    license, n_matched, n_words, coverage, start, end, span): characters ``start`` to
    ``end`` of the text are ``span``, from the first matched word to the last.
    """
    parts = [_scan(docs, index, coverage) for index in _blocks_of(templates, coverage)]
    if not parts:
        return docs.sparkSession.createDataFrame([], _FOUND)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
