"""Licence texts found in documents.

A generalised suffix automaton over the tokens of licence templates is walked along each document; it
gives at every token the longest match that ends there (matching statistics). Long matches are chained,
in the order of the template, into the span of a template that the document covers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstrata.llm.common import pieces

# The base phrases and their labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Notices and permission texts by which licences are recognised besides.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2"),
    ("lgpl", "This work is licensed under the GNU Lesser General Public License"),
    ("agpl-3", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation"),
    ("lgpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation"),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
     "General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
]
# Bytes that belong to tokens, in lower case; all others are spaces.
TOKEN_BYTES = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def tokens(text: str) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII; A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(TOKEN_BYTES).split()


@dataclass
class Automaton:
    """States of a generalised suffix automaton. State 0 is the empty match."""

    number: dict[bytes, int]  # of each token
    step: list[dict[int, int]]
    link: list[int]
    length: list[int]
    ends: list[list[tuple[int, int]]]  # (text, place) where a state's longest match first ends in each text
    phrases: list[list[int]]  # whole phrases that are suffixes of a state's matches, longest last


def build(texts: list[list[bytes]], phrases: int) -> Automaton:
    """The automaton of `texts`; the first `phrases` of them are reported wherever they end."""
    number: dict[bytes, int] = {}
    step, link, length, ends = [{}], [-1], [0], [[]]

    def extend(last: int, token: int) -> int:
        if token in step[last]:
            # The text so far is part of an earlier one.
            to = step[last][token]
            return to if length[to] == length[last] + 1 else split(last, to, token)
        new = add(length[last] + 1, {})
        at = last
        while at >= 0 and token not in step[at]:
            step[at][token] = new
            at = link[at]
        if at < 0:
            link[new] = 0
        else:
            to = step[at][token]
            link[new] = to if length[to] == length[at] + 1 else split(at, to, token)
        return new

    def add(size: int, steps: dict[int, int]) -> int:
        step.append(steps)
        link.append(0)
        length.append(size)
        ends.append([])
        return len(step) - 1

    def split(at: int, to: int, token: int) -> int:
        copy = add(length[at] + 1, dict(step[to]))
        link[copy], link[to] = link[to], copy
        while at >= 0 and step[at].get(token) == to:
            step[at][token] = copy
            at = link[at]
        return copy

    for text in texts:
        last = 0
        for word in text:
            last = extend(last, number.setdefault(word, len(number)))
    whole: dict[int, list[int]] = {}
    for t, text in enumerate(texts):
        at = 0
        for place, word in enumerate(text):
            at = step[at][number[word]]
            up = at
            while up > 0:
                if not any(seen == t for seen, _ in ends[up]):
                    ends[up].append((t, place))
                up = link[up]
        if t < phrases and text:
            whole.setdefault(at, []).append(t)
    found: list[list[int]] = [[] for _ in step]
    for state in sorted(range(1, len(step)), key=length.__getitem__):
        found[state] = found[link[state]] + whole.get(state, [])
    return Automaton(number, step, link, length, ends, found)


@dataclass
class Match:
    """A maximal match: `size` tokens that end at `end` (inclusive) of the document and `place` of a text."""

    text: int
    end: int
    place: int
    size: int


def statistics(automaton: Automaton, words: list[bytes], sizes: list[int], min_match: int) -> tuple[list[tuple[int, int]], list[Match]]:
    """Places (phrase, first word) where whole phrases stand, and the maximal matches of `min_match` tokens or more."""
    step, link, length = automaton.step, automaton.link, automaton.length
    places, matches = [], []
    state, size = 0, 0

    def keep(end: int) -> None:
        if size >= min_match:
            matches.extend(Match(t, end, place, size) for t, place in automaton.ends[state])

    for i, token in enumerate(map(automaton.number.get, words)):
        if token is None:
            if size:
                keep(i - 1)
                state, size = 0, 0
            continue
        if size and token not in step[state]:
            keep(i - 1)
            while state and token not in step[state]:
                state = link[state]
                size = length[state]
        if token in step[state]:
            state, size = step[state][token], size + 1
            for phrase in automaton.phrases[state]:
                if sizes[phrase] <= size:
                    places.append((phrase, i + 1 - sizes[phrase]))
    keep(len(words) - 1)
    return places, matches


def chain(matches: list[Match], sizes: list[int], max_gap: int) -> list[tuple[int, int, int, float]]:
    """Spans (text, first word, end word, share of the text covered) of disjoint chains, the best chain first.

    Matches follow one another in a chain when both their words and their places in the template rise and at
    most `max_gap` words of the document lie between them. For each match, in the order of their ends, the best
    chain that ends with it is found among the matches close before it; then chains are taken from the best on,
    without those that share a match with a better one. Two copies that interleave are two chains.
    """
    spans, by_text = [], {}
    for m in matches:
        by_text.setdefault(m.text, []).append(m)
    for text, found in by_text.items():
        found.sort(key=lambda m: (m.end, m.place))
        covered, before = [m.size for m in found], [-1] * len(found)
        for i, m in enumerate(found):
            nearest = m.end - m.size + 1 - max_gap
            for j in range(i - 1, -1, -1):
                k = found[j]
                if k.end < nearest:
                    break
                if k.end < m.end and k.place < m.place:
                    sum_of = covered[j] + min(m.size, m.place - k.place, m.end - k.end)
                    # Of equal ones the earliest, which leaves the later ones to the other copy.
                    if sum_of > covered[i] or (sum_of == covered[i] and before[i] >= 0):
                        covered[i], before[i] = sum_of, j
        used = [False] * len(found)
        for i in sorted(range(len(found)), key=lambda i: (-covered[i], found[i].end)):
            path, at = [], i
            while at >= 0 and not used[at]:
                path.append(at)
                at = before[at]
            if at < 0:
                for at in path:
                    used[at] = True
                first = found[path[-1]]
                spans.append((text, first.end - first.size + 1, found[i].end + 1, min(1.0, covered[i] / sizes[text])))
    return sorted(spans, key=lambda s: (-s[3], -sizes[s[0]], s[1], s[0]))


def best_spans(spans: list[tuple[int, int, int, float]], min_cover: float) -> list[tuple[int, int, int, float]]:
    """Of spans that lie over one another by more than half, in the order of `chain`, the first only.

    Licences that differ in a word or a number cover each other's notices nearly whole; what a notice says whole,
    and at greatest length, is what it is.
    """
    out: list[tuple[int, int, int, float]] = []
    for span in spans:
        _, a, b, cover = span
        if cover >= min_cover and all(2 * (min(b, d) - max(a, c)) <= min(b - a, d - c) for _, c, d, _ in out):
            out.append(span)
    return out


def scan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    phrases: list[tuple[str, str]] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    min_match: int = 4,
    min_cover: float = 0.8,
    max_gap: int = 10,
) -> DataFrame:
    """One row per row of `docs`: `id`, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`,
    `labels`, `score` and `spans` (label, first word, end word, cover).

    `n_base` counts all places, overlapping ones too, where a phrase's words stand one after another;
    `first_word` and `last_word` are the smallest and largest start, null without a place. `labels` adds
    those of templates of which a chain of matches of `min_match` tokens or more covers `min_cover`, the best of those
    over the same words; `spans` has these chains. `score` is 1 with a base place, else the largest cover of any chain, else 0. A null or empty
    text has no words. Every row is scanned whole and alone, in one pass without a shuffle: repeated rows
    and null ids are scanned like others, an empty table gives no rows, other columns are not read.
    The automaton is made from the given phrases and templates and travels with the tasks.
    """
    entries = [(tokens(t), label) for label, t in [*phrases, *templates]]
    automaton = build([t for t, _ in entries], len(phrases))
    sizes, labels = [len(t) for t, _ in entries], [label for _, label in entries]
    read = docs.select(F.col(id).alias(id), F.col(text).alias("_text"))
    span_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())]))
    names = [id, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span_type]

    def look(one: str) -> tuple:
        words = tokens(one)
        places, matches = statistics(automaton, words, sizes, min_match)
        chains = chain([m for m in matches if m.text >= len(phrases)], sizes, max_gap)
        base = {labels[p] for p, _ in places}
        spans = [{"label": labels[t], "first": a, "end": b, "cover": c} for t, a, b, c in best_spans(chains, min_cover)]
        starts = [s for _, s in places]
        return (
            len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {s["label"] for s in spans})),
            1.0 if places else min(1.0, max((c for *_, c in chains), default=0.0)), spans,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "_text"):
            columns = zip(*map(look, texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True))], names
            )

    numbers = [F.lit(0).cast("long").alias(c) for c in names[1:5]]
    schema = read.select(
        id, *numbers, F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"),
        F.array().cast("array<struct<label: string, first: bigint, end: bigint, cover: double>>").alias("spans"),
    ).schema
    for field in schema.fields:
        field.nullable = True
    return read.mapInArrow(run, schema)
