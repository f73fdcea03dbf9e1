"""Licence notices that differ in a word, and chains beside an exhaustive search."""

import random
from itertools import combinations

from crawlstrata.llm import licenses
from crawlstrata.llm.licenses import Match

NOTICES = {
    "This work is licensed under the GNU General Public License, version 2.": "gpl-2",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3",
    "x This work is licensed under the GNU Affero General Public License, version 3 y": "agpl-3",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation": "lgpl",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License": "cc-by-nd",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl-2",
    "nothing is licensed here": "",
}


def test_notices_that_differ_in_a_word_get_their_own_label(spark):
    rows = list(enumerate(NOTICES))
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: NOTICES[t] for i, t in rows}
    # Two notices one after another are both found.
    both = "\n".join(list(NOTICES)[:2])
    assert licenses.scan(spark.createDataFrame([(1, both)], "doc_id long, text string")).first().labels == "gpl-2,gpl-3"


def best_cover(matches, gap):
    """The most tokens that any chain of the matches covers."""
    best = 0
    for n in range(1, len(matches) + 1):
        for some in combinations(sorted(matches, key=lambda m: (m.end, m.place)), n):
            pairs = list(zip(some, some[1:], strict=False))
            if all(a.end < b.end and a.place < b.place and b.end - b.size + 1 - a.end <= gap for a, b in pairs):
                best = max(best, some[0].size + sum(min(b.size, b.place - a.place, b.end - a.end) for a, b in pairs))
    return best


def test_the_first_chain_is_the_best_of_all():
    rnd = random.Random(2)
    for _ in range(300):
        matches = {(rnd.randrange(3, 30), rnd.randrange(3, 20)): rnd.randrange(1, 4) for _ in range(rnd.randrange(1, 9))}
        found = [Match(0, end, place, size) for (end, place), size in matches.items()]
        spans = licenses.chain(found, [40], 5)
        assert round(spans[0][3] * 40) == best_cover(found, 5)


def test_interleaved_copies_are_two_chains():
    first, second = [Match(0, e, p, 4) for e, p in ((5, 5), (15, 15))], [Match(0, e, p, 4) for e, p in ((10, 5), (20, 15))]
    spans = licenses.chain([*first, *second], [16], 10)
    assert [round(s[3] * 16) for s in spans] == [8, 8]


def test_a_long_text_of_repeated_notices_is_scanned_in_time(spark):
    text = " ".join(t for _, t in licenses.TEMPLATES) * 200
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(row.labels.split(",")) > 10 and row.score == 1.0
