"""License scan: exact set-similarity join of text blocks with license templates.

Words are maximal runs of ASCII letters and digits (A-Z lower-cased) and
non-ASCII characters. A template is the set of its words; a block is a window of
2m words that begins at every m-th word, m being the smallest of ``STEPS`` (and
so on, by fours) that is at least the template's length, so each passage of a template's length lies
whole in some block. A block matches when it holds ``threshold`` of the
template's words or more.

1. One pass over the whole texts keeps, for each document, the base phrases'
   places and the positions of template words only (``scan``).
2. The frequency of each template word over all documents gives the global order,
   rarest first (one row for each template word, so it is of fixed size).
3. A block is compared with a template only if it holds a word of the template's
   prefix (its rarest n - ceil(threshold * n) + 1 words), it has enough template
   words (length filter), and enough of them from the first shared one on
   (positional filter). What remains is counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textnum as tn
from .scratch import materialise, ship

# Phrases of the base labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Characteristic sentences of public licenses, as words.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under the creative commons attribution sharealike license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
STEPS = (16, 64, 256)
SCANNED = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, at binary, token binary"
RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


@dataclass(frozen=True)
class Templates:
    """Templates as sets over one vocabulary; ``threshold``: the share of a template's words that a block must hold."""

    texts: tuple[tuple[str, str], ...] = TEMPLATES
    threshold: float = 0.8

    @property
    def vocabulary(self) -> list[str]:
        return sorted({w for _, t in self.texts for w in t.split()} | {w for p in BASE for w in p.split()})

    def sets(self) -> list[tuple[str, int, set[int]]]:
        """(label, step of its blocks, token ids) of each template."""
        number = {w: i for i, w in enumerate(self.vocabulary)}
        return [(label, step_of(len(t.split())), {number[w] for w in t.split()}) for label, t in self.texts]


def step_of(length: int) -> int:
    """The step of the blocks of a template of so many words."""
    step = next((s for s in STEPS if s >= length), STEPS[-1])
    while step < length:
        step *= 4
    return step


def _word_hashes(words: list[str]) -> np.ndarray:
    buf, offsets = tn.flat(pa.array(words))
    return tn.span_hash(buf, offsets[:-1], offsets[1:])


def scan(docs: DataFrame, templates: Templates) -> DataFrame:
    """Word count, base phrases, and positions and ids of template words (int32 arrays) of each whole text."""
    ship(docs.sparkSession)
    words = templates.vocabulary
    phrases = [(label, [words.index(w) for w in p.split()]) for p, label in BASE.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _word_hashes(words)
        by_hash = np.argsort(hashes)
        ordered = hashes[by_hash]
        for batch in batches:
            for lo, hi, raw, offsets in tn.pieces(batch.column("text")):
                buf = tn.LOWER[raw]
                starts, ends, first = tn.spans(buf, offsets, tn.ALNUM_WORD)
                h = tn.span_hash(buf, starts, ends)
                near = np.minimum(np.searchsorted(ordered, h), len(ordered) - 1)
                token = np.where(ordered[near] == h, by_hash[near], -1).astype(np.int32)
                owner = np.repeat(np.arange(hi - lo), np.diff(first))
                places = []
                for k, (_, ids) in enumerate(phrases):
                    n = len(token) - len(ids) + 1
                    hit = np.ones(max(n, 0), bool)
                    for j, i in enumerate(ids):
                        hit &= token[j : j + n] == i if n > 0 else hit
                    if n > 0:
                        hit &= owner[:n] == owner[len(ids) - 1 :]
                    at = np.flatnonzero(hit)
                    places.append(np.stack([owner[at], at - first[owner[at]], np.full(len(at), k)]))
                doc, at, kind = np.concatenate(places, axis=1)
                n_base = np.bincount(doc, minlength=hi - lo)
                first_at, last_at = np.full(hi - lo, np.iinfo(np.int64).max), np.full(hi - lo, -1)
                np.minimum.at(first_at, doc, at)
                np.maximum.at(last_at, doc, at)
                labels: list[set[str]] = [set() for _ in range(hi - lo)]
                for d, k in zip(doc.tolist(), kind.tolist()):
                    labels[d].add(phrases[k][0])
                held = np.flatnonzero(token >= 0)
                cut = np.searchsorted(held, first)
                where = (held - first[owner[held]]).astype(np.int32)
                what = token[held]
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(first), pa.int64()), pa.array(n_base, pa.int64()),
                        pa.array(first_at, pa.int64(), mask=none), pa.array(last_at, pa.int64(), mask=none),
                        pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                        pa.array([where[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                        pa.array([what[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "at", "token"],
                )

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, SCANNED)


def frequencies(scanned: DataFrame, templates: Templates) -> list[int]:
    """Occurrences of each template word over all documents (one number a word of the templates)."""
    size = len(templates.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            data, _ = tn.flat(batch.column("token"))
            total += np.bincount(data.view(np.int32), minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total, pa.int64())], ["token", "n"])

    counted = {r.token: r.n for r in scanned.select("token").mapInArrow(run, "token int, n long").groupBy("token").agg({"n": "sum"}).toDF("token", "n").collect()}
    return [counted.get(i, 0) for i in range(size)]


def _matches(at: np.ndarray, token: np.ndarray, sets, prefixes, rank: np.ndarray, threshold: float) -> dict[str, float]:
    """Labels of the templates that a block of this document holds, and the largest share held."""
    found: dict[str, float] = {}
    for (label, step, words), prefix in zip(sets, prefixes):
        needed = math.ceil(threshold * len(words) - 1e-9)
        blocks = {b for p in at[np.isin(token, prefix)].tolist() for b in (p // step - 1, p // step) if b >= 0}
        for b in blocks:
            lo, hi = np.searchsorted(at, [b * step, (b + 2) * step])
            held = sorted(set(token[lo:hi].tolist()), key=rank.__getitem__)
            if len(held) < needed:
                continue
            begin = next(j for j, w in enumerate(held) if w in words)
            if len(held) - begin < needed:
                continue
            shared = sum(w in words for w in held[begin:])
            if shared >= needed:
                found[label] = max(found.get(label, 0.0), shared / len(words))
    return found


def license_scan(docs: DataFrame, templates: Templates = Templates()) -> DataFrame:
    """Base phrases and matching templates of every row's whole text.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels
    and score: 1 if there is a base phrase, else the largest share of a matching
    template that one block holds, else 0. Null or empty text: no words, null
    positions, empty labels, score 0. Repeated rows give a row each, a null doc_id
    is kept, an empty table gives an empty result, and other columns are not read.
    """
    scanned = materialise(scan(docs, templates), "license")
    counts = frequencies(scanned, templates)
    threshold = templates.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = templates.sets()
        rank = np.empty(len(counts), np.int64)
        rank[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
        prefixes = []
        for _, _, words in sets:
            rarest = sorted(words, key=rank.__getitem__)
            prefixes.append(np.array(rarest[: len(words) - math.ceil(threshold * len(words) - 1e-9) + 1], np.int32))
        watched = np.unique(np.concatenate(prefixes))
        for batch in batches:
            labels, scores = [], []
            for at, token, base in zip(batch.column("at").to_pylist(), batch.column("token").to_pylist(), batch.column("base_labels").to_pylist()):
                token = np.frombuffer(token, np.int32)
                found = {}
                if len(token) and np.isin(token, watched).any():
                    found = _matches(np.frombuffer(at, np.int32), token, sets, prefixes, rank, threshold)
                own = set(base.split(",")) - {""}
                labels.append(",".join(sorted(own | set(found))))
                scores.append(1.0 if own else max(found.values(), default=0.0))
            kept = [batch.column(c) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return scanned.mapInArrow(run, RESULT)
