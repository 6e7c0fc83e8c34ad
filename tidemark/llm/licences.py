"""Licence scan: which licences do texts name or carry, and where.

Templates are licence notices with mandatory key phrases; phrases are short
wordings that must stand as they are. Both are indexed by word and position.
What a word is worth is its inverse document frequency, counted over all
documents in a first pass (for the words of the templates only, so the counts are
few whatever the input).

The second pass looks only at texts that hold every word of a template's key
phrases. There it takes the ``ANCHORS`` words of the template that are rarest in
the corpus among those the text has, and intersects their postings: each
occurrence in the text, less each position in the template, is a relative
position, and one that two anchors share is a place where the template may stand.
A template word counts as found if the text has it there or at most ``SLACK``
words away (words were put in or left out). A place holds when the words found make up ``MIN_SHARE`` of the template's worth and every
key phrase stands, word after word, within the place and ``SLACK`` words around
it. A phrase is a template of which every word must be found at its place. Every
occurrence is looked up: no limit on places, anchors' occurrences or texts.

Words are runs of ASCII letters and digits and of anything beyond ASCII, after
lower-casing A-Z; places are counted in words, from 0, the end exclusive. Defined
results: NULL or empty text has no words and no places; equal texts have equal
places; equal worths order by word; an empty table gives no rows; other columns,
whatever their names, are not read; texts are scanned whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANCHORS = 3
SLACK = 4
MIN_SHARE = 0.6

# Phrases that name a licence, and the opening words of published
# licence notices with the phrases that tell them apart.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction",
     ("permission is hereby granted free of charge", "without restriction")),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies", ("with or without fee is hereby granted",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                 "except in compliance with the License. You may obtain a copy of the License at",
     ("apache license version 2 0", "except in compliance with the license")),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2",
     ("gnu general public license", "version 2")),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3",
     ("gnu general public license", "version 3")),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation, either version 3 of the License, "
              "or (at your option) any later version",
     ("gnu general public license", "either version 3 of the license")),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation; either version 2 of the License, "
              "or (at your option) any later version",
     ("gnu general public license", "either version 2 of the license")),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
     ("gnu lesser general public license",)),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
     ("gnu affero general public license",)),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ("mozilla public license v 2 0",)),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ("creative commons attribution 4 0",)),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
     ("creative commons attribution sharealike",)),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     ("creative commons attribution noncommercial",)),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
            "to this work", ("waived all copyright",)),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
)

#: word bytes, A-Z lower-cased; all others become spaces
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_TO_WORDS).split()


@dataclass(frozen=True)
class Template:
    """``exact``: a phrase, found only as it stands."""
    label: str
    words: tuple[bytes, ...]
    key_phrases: tuple[tuple[bytes, ...], ...]
    exact: bool


def templates_of(notices: Sequence = NOTICES, phrases: Sequence = PHRASES) -> list[Template]:
    w = lambda s: tuple(words_of(s.encode()))
    return ([Template(label, w(p), (w(p),), True) for label, p in phrases]
            + [Template(label, w(t), tuple(map(w, keys)), False) for label, t, keys in notices])


PLACE = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()),
                   ("share", pa.float64()), ("exact", pa.bool_())])
PLACE_SQL = "array<struct<label:string,first:bigint,end:bigint,share:double,exact:boolean>>"


class LicenceIndex:
    """Positions of the templates' words, and their worth in the corpus."""

    def __init__(self, templates: Sequence[Template], n_docs: int = 0, doc_counts: dict[bytes, int] | None = None):
        counts = doc_counts or {}
        self.templates = list(templates)
        vocabulary = sorted({w for t in templates for w in t.words} | {w for t in templates for p in t.key_phrases
                                                                       for w in p})
        self.number = {w: i for i, w in enumerate(vocabulary)}
        self.vocabulary = frozenset(vocabulary)
        self.worth = np.array([1 + math.log((n_docs + 1) / (counts.get(w, 0) + 1)) for w in vocabulary])
        ids = lambda ws: np.array([self.number[w] for w in ws], np.int64)
        self.ids = [ids(t.words) for t in templates]
        self.key_ids = [[ids(p) for p in t.key_phrases] for t in templates]
        self.needed = [frozenset(w for p in t.key_phrases for w in p) for t in templates]

    def places(self, words: list[bytes]) -> list[tuple]:
        """(label, first, end, share, exact) of every place, by start."""
        present = self.vocabulary.intersection(words)
        wanted = [k for k, need in enumerate(self.needed) if need <= present]
        if not wanted:
            return []
        doc = np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))
        here = np.flatnonzero(doc >= 0)
        by_word = here[np.argsort(doc[here], kind="stable")]         # postings, word after word
        edges = np.searchsorted(doc[by_word], np.arange(len(self.number) + 1))
        postings = lambda w: by_word[edges[w]:edges[w + 1]]
        out = []
        for k in wanted:
            find = self._exact if self.templates[k].exact else self._notice
            out += find(k, doc, postings)
        return sorted(out, key=lambda p: (p[1], p[2], p[0]))

    def _starts(self, ids: np.ndarray, doc: np.ndarray, postings) -> np.ndarray:
        """Where the words ``ids`` stand one after the other: the postings of the
        word of the highest worth, then the others by relative position."""
        rare = int(np.argmax(self.worth[ids]))
        at = postings(ids[rare]) - rare
        at = at[(at >= 0) & (at + len(ids) <= len(doc))]
        for i, w in enumerate(ids):
            at = at[doc[at + i] == w]
        return at

    def _exact(self, k: int, doc: np.ndarray, postings) -> list[tuple]:
        t, ids = self.templates[k], self.ids[k]
        return [(t.label, int(s), int(s) + len(ids), 1.0, True) for s in self._starts(ids, doc, postings)]

    def _notice(self, k: int, doc: np.ndarray, postings) -> list[tuple]:
        t, ids = self.templates[k], self.ids[k]
        keys = [self._starts(p, doc, postings) for p in self.key_ids[k]]
        if any(not len(s) for s in keys):
            return []
        own = sorted({int(w) for w in ids if len(postings(w))}, key=lambda w: (-self.worth[w], w))[:ANCHORS]
        offsets = [np.unique((postings(w)[:, None] - np.flatnonzero(ids == w)).ravel()) for w in own]
        at, hits = np.unique(np.concatenate(offsets), return_counts=True)
        at = at[hits >= min(2, len(own))]
        if not len(at):
            return []
        share = np.zeros(len(at))
        for i, w in enumerate(ids):
            own_at, near = postings(w), at + i
            share += self.worth[w] * (np.searchsorted(own_at, near - SLACK, "left")
                                      < np.searchsorted(own_at, near + SLACK, "right"))
        share /= self.worth[ids].sum()
        good = share >= MIN_SHARE
        for starts, p in zip(keys, self.key_ids[k], strict=True):
            first = np.searchsorted(starts, at - SLACK, "left")
            good &= first < np.searchsorted(starts, at + len(ids) + SLACK - len(p), "right")
        at, share = at[good], share[good]
        out = []
        for run in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > SLACK) + 1):
            if len(run):                                             # neighbours are one place: the best
                b = run[int(np.argmax(share[run]))]
                out.append((t.label, max(0, int(at[b])), min(len(doc), int(at[b]) + len(ids)), float(share[b]), False))
        return out


def _texts(column: pa.Array) -> Iterator[bytes]:
    binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for x in binary:
        yield x.as_py() or b""


def document_counts(docs: DataFrame, vocabulary: frozenset[bytes], text_col: str = "text") -> tuple[int, dict]:
    """Number of documents, and of those that hold each word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, all_rows = dict.fromkeys(vocabulary, 0), 0
        for batch in batches:
            all_rows += batch.num_rows
            for data in _texts(batch.column(0)):
                for w in vocabulary.intersection(words_of(data)):
                    n[w] += 1
        rows = [(None, all_rows), *((w.decode(), c) for w, c in n.items() if c)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                          pa.array([r[1] for r in rows], pa.int64())], ["word", "n"])

    per_task = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "word string, n long")
    got = {r["word"]: r["n"] for r in per_task.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # |vocabulary|
    return got.pop(None, 0), {w.encode(): c for w, c in got.items()}


def scan_licences(docs: DataFrame, templates: Sequence[Template] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_words and places (label, first, end, share, exact) of every row."""
    templates = templates or templates_of()
    index = LicenceIndex(templates, *document_counts(docs, LicenceIndex(templates).vocabulary, text_col))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in PLACE]
        for batch in batches:
            n_words, places = [], []
            for data in _texts(batch.column(1)):
                words = words_of(data)
                n_words.append(len(words))
                places.append([dict(zip(names, p, strict=True)) for p in index.places(words)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(places, pa.list_(PLACE))],
                ["doc_id", "n_words", "places"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, "
                                 f"places {PLACE_SQL}")
