"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a line.  With ``wrapped`` (as the registered query has it) every window of consecutive words is a block too,
wherever lines end, so that a notice wrapped over several lines is found; a window is as long as the template divided by
``threshold``.  A block matches a template when it holds at least ``threshold`` of the template's distinct words.  Words are
ordered by how often the whole corpus uses them, rarest first, and three filters cut the work without losing a match:

* prefix: with k words needed out of n, one of the template's first n - k + 1 words must be there;
* length: a block with fewer than k template words cannot match;
* position: from the first shared word on, the shorter rest bounds what can still be shared.

What passes is counted exactly.  The templates are a fixed, short list, so their index travels with the tasks; documents
are never shuffled.

Besides, fixed phrases are found at every place where their words stand next to each other.

Defined cases: null and empty texts have no words, labels are empty strings, places null and the score 0; a text of any
length is read whole; equal templates all report; repeated rows are judged one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField

from hexcohort.llm.common import append_columns, bound_batches, fresh, texts_of

#: Phrases that count wherever they stand, and what they are called.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices by label.
TEMPLATES = {
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
    "mit-notice": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "reserved": "Copyright. All rights reserved.",
}
THRESHOLD = 0.8

# every byte that separates words becomes a blank, A-Z become small; bytes beyond ASCII belong to words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]     # distinct, rarest first
    needed: int
    window: int                  # words of a block that lies across lines


class Index:
    """Templates in one global word order, with their prefixes by word."""

    def __init__(self, templates: dict[str, str], threshold: float, frequency: dict[bytes, int]):
        listed = {label: words_of(t) for label, t in templates.items()}
        sets = {label: set(words) for label, words in listed.items()}
        vocabulary = sorted({w for s in sets.values() for w in s}, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(vocabulary)}
        self.prefixes: dict[bytes, list[tuple[int, Template]]] = {}
        self.templates: list[Template] = []
        for label, found in sorted(sets.items()):
            needed = sum(n < threshold * len(found) - 1e-9 for n in range(len(found) + 1))
            t = Template(label, tuple(sorted(found, key=self.rank.__getitem__)), needed, int(len(listed[label]) / threshold + 1e-9))
            self.templates.append(t)
            for i, w in enumerate(t.words[:len(t.words) - needed + 1]):
                self.prefixes.setdefault(w, []).append((i, t))

    def matches(self, block: set[bytes]) -> Iterator[tuple[str, float]]:
        """(label, contained share) of every template that the block matches."""
        shared = sorted(block & self.rank.keys(), key=self.rank.__getitem__)
        seen: set[str] = set()
        for j, w in enumerate(shared):
            for i, t in self.prefixes.get(w, ()):
                if t.label in seen:
                    continue
                seen.add(t.label)     # the first shared word gives the tightest bound; no later one can do better
                rest = min(len(t.words) - i, len(shared) - j)
                if len(shared) >= t.needed and rest >= t.needed:
                    overlap = len(block.intersection(t.words))
                    if overlap >= t.needed:
                        yield t.label, overlap / len(t.words)


    def windows(self, words: list[bytes]) -> Iterator[tuple[str, float]]:
        """(label, largest contained share) of every template that a window of the text matches."""
        places: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.rank:
                places.setdefault(w, []).append(i)
        for t in self.templates:
            # prefix and length filter, for all windows at once
            if not any(w in places for w in t.words[:len(t.words) - t.needed + 1]) or sum(w in places for w in t.words) < t.needed:
                continue
            most, inside = 0, Counter[bytes]()
            order = sorted((i, w) for w in t.words for i in places.get(w, ()))
            first = 0
            for i, w in order:
                inside[w] += 1
                while order[first][0] <= i - t.window:
                    gone = order[first][1]
                    inside[gone] -= 1
                    if not inside[gone]:
                        del inside[gone]
                    first += 1
                most = max(most, len(inside))
            if most >= t.needed:
                yield t.label, most / len(t.words)


def word_counts(docs: DataFrame, vocabulary: frozenset[bytes], text: str = "text") -> dict[bytes, int]:
    """How often all documents use the given words; one small row per word and batch is shuffled, one per word collected."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: Counter[bytes] = Counter()
            for t in texts_of(b.column(0)):
                found.update(w for w in words_of(t) if w in vocabulary)
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found], pa.string()),
                                              pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    counted = docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"].encode(): r["n"] for r in counted.collect()}     # at most the vocabulary of the templates


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(word number, label) of each place of a phrase."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in PHRASES.items():
        needle = f" {phrase} ".encode()
        at = line.find(needle)
        while at >= 0:
            found.append((line.count(b" ", 0, at), label))
            at = line.find(needle, at + 1)
    return found


def judge(text: str, index: Index, wrapped: bool = False) -> tuple[int, int, int | None, int | None, str, str, float]:
    words = words_of(text)
    places = phrase_places(words)
    best: dict[str, float] = {}
    if not index.prefixes.keys().isdisjoint(words):
        lines = text.split("\n")
        for found in (*(index.matches(set(words_of(line))) for line in lines), index.windows(words) if wrapped and len(lines) > 1 else ()):
            for label, share in found:
                best[label] = max(share, best.get(label, 0.0))
    base = sorted({label for _, label in places})
    at = [p for p, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(base),
            ",".join(sorted({*base, *best})), 1.0 if places else max(best.values(), default=0.0))


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None,
         threshold: float = THRESHOLD, wrapped: bool = False) -> DataFrame:
    """``docs`` with words, phrase places, labels and a score: 1 with a phrase, else the best matching share, else 0."""
    templates = TEMPLATES if templates is None else templates
    vocabulary = frozenset(w for t in templates.values() for w in words_of(t))
    index = Index(templates, threshold, word_counts(docs, vocabulary, text))
    kinds = {"n_words": LongType(), "n_base": LongType(), "first_word": LongType(), "last_word": LongType(),
             "base_labels": StringType(), "labels": StringType(), "score": DoubleType()}
    arrow = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(column: pa.Array) -> list[pa.Array]:
        rows = [judge(t, index, wrapped) for t in texts_of(column)]
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(arrow)]

    fields = [StructField(n, k) for n, k in zip(fresh(docs, *kinds), kinds.values(), strict=True)]
    return append_columns(docs, text, fields, run)
