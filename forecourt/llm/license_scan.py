"""License scan: an exact set-similarity join of text blocks with license templates.

Blocks are windows of words over the whole document, whatever its lines: for templates of at most L words, 2L words every
L words, so that a notice lies whole in a window wherever it stands and however it is wrapped. Tokens are ordered by how many
documents hold them, rarest first, counted over the whole corpus. A block can reach the containment |block & template| /
|template| >= t only if it holds a token of the template's prefix, its first |T| - ceil(t|T|) + 1 tokens in that order;
candidates from the prefix index pass the length filter and, token by token, the positional filter (what still can be shared)
before the overlap is counted in full. Of templates that nearly contain each other the best one in overlapping blocks stands.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: On UTF-8 bytes: ASCII letters (lower-cased before) and digits, and everything that is not ASCII.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


#: Of so few words, most occur together by chance, or in another notice.
SHORT = 12


@dataclass(frozen=True)
class Template:
    """kind "phrase": the words must stand consecutively, anywhere in the document (block: the whole document, containment 1).
    kind "notice": a window that holds at least ``least`` of the distinct words, among them all that tell it from its rivals: numbers, and words
    that a similar notice lacks. A notice of fewer than SHORT words must stand in the window word for word."""

    label: str
    text: str
    kind: str = "notice"
    least: float = 0.8

    @property
    def words(self) -> list[bytes]:
        return _words(self.text)


def _words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


# Phrases and their labels.
PHRASES = (
    Template("gpl", "gnu general public license", "phrase", 1.0),
    Template("apache", "apache license", "phrase", 1.0),
    Template("cc-by", "cc by", "phrase", 1.0),
    Template("mit", "mit license", "phrase", 1.0),
)
# Wording of widely used license notices.
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    Template("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    Template("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)


def token_counts(docs: DataFrame, templates: Sequence[Template]) -> dict[bytes, int]:
    """How many documents hold each template token; over all documents, one row a token comes back."""
    vocabulary = frozenset(w for t in templates for w in t.words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(vocabulary.intersection(_WORD.findall(text.as_buffer().to_pybytes().lower())))
        yield pa.RecordBatch.from_pydict({"token": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

    counted = docs.select(text_or_empty().alias("text")).mapInArrow(count, "token binary, n long")
    return dict.fromkeys(vocabulary, 0) | {bytes(r["token"]): r["n"] for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class SimilarityIndex:
    """Prefix index over templates under a global token order."""

    def __init__(self, templates: Sequence[Template], counts: dict[bytes, int]):
        self.templates = list(templates)
        self.place = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}
        self.sets = [sorted({self.place[w] for w in t.words}) for t in self.templates]
        self.short = [t.kind == "notice" and len(t.words) < SHORT for t in self.templates]
        self.need = [len(s) if short else math.ceil(t.least * len(s) - 1e-9) for t, s, short in zip(self.templates, self.sets, self.short)]
        self.prefix: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, s in enumerate(self.sets):
            for i, token in enumerate(s[: len(s) - self.need[k] + 1]):
                self.prefix[token].append((k, i))
        self.vocabulary = frozenset(self.place)
        self.width = [1 << max(3, (len(t.words) - 1).bit_length()) for t in self.templates]
        self.widths = {token: sorted({self.width[k] for k, _ in of if self.templates[k].kind == "notice"}) for token, of in self.prefix.items()}
        near = lambda a, b: len({*a} & {*b}) >= 0.8 * min(len(a), len(b))
        self.rivals = [[j for j, b in enumerate(self.sets) if j != k and self.templates[j].kind == "notice" and near(a, b)] for k, a in enumerate(self.sets)]
        numbers = {self.place[w] for w in self.place if w.isdigit()}
        self.telling = [{t for t in a if t in numbers or any(t not in self.sets[j] for j in self.rivals[k] if self.templates[j].label != self.templates[k].label)} if self.templates[k].kind == "notice" else set() for k, a in enumerate(self.sets)]
        self.rarest = [min(range(len(t.words)), key=lambda i: self.place[t.words[i]]) for t in self.templates]

    def notices(self, words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """(template, block number, first word, containment) of the blocks of a document's words that meet a notice. A template is looked
        for only in the blocks around words of its prefix."""
        spots = [(i, self.place[w]) for i, w in enumerate(words) if w in self.vocabulary]
        starts, found = [i for i, _ in spots], []
        blocks = sorted({(width, b) for i, token in spots for width in self.widths.get(token, ()) for b in (i // width, i // width - 1) if b >= 0})
        for width, b in blocks:
            held = {t for _, t in spots[bisect_left(starts, b * width) : bisect_left(starts, (b + 2) * width)]}
            for k, c in self.join_places(held, "notice"):
                block = words[b * width : (b + 2) * width]
                if self.width[k] == width and self.telling[k] <= held and (not self.short[k] or _places(block, self.templates[k].words, self.rarest[k])):
                    found.append((k, b, b * width, c))
        best = lambda m: (m[3], len(self.sets[m[0]]), -m[0])
        meet = lambda m, o: m[2] < o[2] + 2 * self.width[o[0]] and o[2] < m[2] + 2 * self.width[m[0]]
        return [m for m in found if not any(o[0] in self.rivals[m[0]] and meet(m, o) and best(o) > best(m) for o in found)]

    def join(self, words: frozenset[bytes] | set[bytes], kind: str) -> list[tuple[int, float]]:
        """words: those of a block that are in the vocabulary (others can't be shared). All templates of the kind
        that reach their threshold, with their containment."""
        return self.join_places({self.place[w] for w in words}, kind)

    def join_places(self, places: set[int], kind: str) -> list[tuple[int, float]]:
        block, found, tried = sorted(places), [], set()
        for j, token in enumerate(block):
            for k, i in self.prefix.get(token, ()):
                if k in tried or self.templates[k].kind != kind:
                    continue
                tried.add(k)  # this is the first shared token: none before it is in both
                s, need = self.sets[k], self.need[k]
                if len(block) < need or min(len(s) - i, len(block) - j) < need:
                    continue
                if (shared := self._overlap(s, i, block, j, need)) >= need:
                    found.append((k, shared / len(s)))
        return found

    @staticmethod
    def _overlap(s: list[int], i: int, block: list[int], j: int, need: int) -> int:
        shared = 0
        while i < len(s) and j < len(block) and shared + min(len(s) - i, len(block) - j) >= need:
            if s[i] == block[j]:
                shared, i, j = shared + 1, i + 1, j + 1
            elif s[i] < block[j]:
                i += 1
            else:
                j += 1
        return shared


def _places(words: list[bytes], phrase: list[bytes], rare: int) -> list[int]:
    """Starts of all places where phrase stands; looks for its token number ``rare`` first."""
    found, at, n = [], -1, len(phrase)
    while True:
        try:
            at = words.index(phrase[rare], at + 1)
        except ValueError:
            return found
        if at >= rare and words[at - rare : at - rare + n] == phrase:
            found.append(at - rare)


MATCH = "struct<label:string,kind:string,block:int,start:long,containment:double>"


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = PHRASES + NOTICES) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, n_words, matches: one entry for each place of a phrase (block -1, start in
    words) and for each window that meets a notice (block: its number among those of its width, start: its first word).
    A notice that stands in the half that two windows share is found in both.

    Null text counts as empty: no words, no match. Repeated rows each get their row; null ids pass; other columns are
    ignored. Without templates nothing matches. Two scans, no shuffle of texts; a task holds one text and its words.
    """
    index = SimilarityIndex(templates, token_counts(docs, templates))
    phrases = {k: t.words for k, t in enumerate(index.templates) if t.kind == "phrase"}
    rare = {k: min(range(len(w)), key=lambda i: index.place[w[i]]) for k, w in phrases.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = index.vocabulary
        for batch in batches:
            n_words, matches = [], []
            for text in batch.column(1):
                words, found = _WORD.findall(text.as_buffer().to_pybytes().lower()), []
                held = vocabulary.intersection(words)
                # no block can hold what the document doesn't
                if held and index.join(held, "notice"):
                    found += [(index.templates[k].label, "notice", block, at, c) for k, block, at, c in index.notices(words)]
                if held and (candidates := index.join(held, "phrase")):
                    found += [(index.templates[k].label, "phrase", -1, at, 1.0) for k, _ in candidates for at in _places(words, phrases[k], rare[k])]
                n_words.append(len(words))
                matches.append([dict(zip(("label", "kind", "block", "start", "containment"), m)) for m in found])
            kind = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("block", pa.int32()), ("start", pa.int64()), ("containment", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(matches, kind)], ["doc_id", "n_words", "matches"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(scan, f"doc_id long, n_words long, matches array<{MATCH}>")


def op9_license_scan(spark, sf_dir):
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("matches", lambda m: m.kind == "phrase")
    joined = lambda m: F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x.label))), ",")
    starts = F.transform(base, lambda m: m.start)
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("matches")).alias("labels"), F.coalesce(F.array_max(F.transform("matches", lambda m: m.containment)), F.lit(0.0)).alias("score"))
