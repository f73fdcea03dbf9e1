"""Stages of the corpus pipeline on small tables."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
import test_operators as brute

import corpus_pipeline
from crawlstrata.llm.catalog import MIX_ROUNDS, mix_columns

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Documents of (doc_id, text, lang), from ten sources."""
    return spark.createDataFrame([(i, t, lang, f"src{(i or 0) % 10}", None if t is None else len(t)) for i, t, lang in rows], SCHEMA).repartition(3)


def test_mixture_keeps_languages_without_a_target(spark):
    rnd = random.Random(4)
    langs = ["en", "fr", "de", "es", "it", None]
    rows = [(i, "w " * rnd.randrange(1, 50), langs[i % 6]) for i in range(1200)]
    kept = corpus_pipeline.mixture(spark, documents(spark, rows), "").collect()
    share = {lang: sum(r.n_chars for r in kept if r.lang == lang) / sum(r.n_chars for r in kept) for lang in langs}
    assert share["it"] > 0 and share[None] > 0 and abs(share["it"] + share[None] - 0.05 / 1.05) < 0.03
    assert set(corpus_pipeline.MIX) == set(mix_columns())


def test_language_stage_without_labels_keeps_what_has_a_letter(spark):
    rows = [(1, "some text", None), (1, "some text", None), (2, "12 !?", None), (3, None, None), (4, "", None), (None, "\u00e9", None), (5, "7 \U00010400", None)]
    got = corpus_pipeline.language_id(spark, documents(spark, rows), "")
    assert sorted((r.doc_id or 0, r.lang) for r in got.collect()) == [(0, None), (1, None), (1, None), (5, None)]
    # Rows of the fold that is held out teach nothing.
    held = [(i, "some text", "en") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    got = corpus_pipeline.language_id(spark, documents(spark, [*rows, *held]), "")
    assert Counter((r.doc_id, r.lang) for r in got.collect() if r.lang) == Counter((i, lang) for i, _, lang in held)


def language_ids(rows):
    return Counter(i for i, t in rows if any(map(str.isalpha, t or "")))


def near_ids(rows):
    kept = {i for i, _, least in brute.brute_components(rows, 5, 80) if i == least}
    return Counter(i for i, _ in set(rows) if i in kept)


def mixture_ids(rows):
    topic = lambda t: "tabular" if " | " in (t or "") else "contact" if "@" in (t or "") else "prose"
    cell = lambda i, t: ("src0" if i is not None and i % 2 == 0 else "other", "en", topic(t))
    cells = Counter()
    for i, t in rows:
        cells[cell(i, t)] += len(brute.WORD.findall(t or ""))
    p = brute.brute_budget(cells, list(corpus_pipeline.MIX.values()), MIX_ROUNDS, corpus_pipeline.MIX_BUDGET)
    number = lambda i: 0 if i is None else int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) / 2**32
    return Counter(i for i, t in rows if number(i) < p[cell(i, t)])


WANT = {"language_id": language_ids, "line_dedup": lambda rows: Counter(i for i, _ in rows), "near_copies": near_ids, "mixture": mixture_ids}


@pytest.mark.parametrize("kind", ["mixed", "nulls", "empty"])
def test_stages_keep_what_brute_force_keeps(spark, kind):
    # Without the last row, whose id is that of another text.
    rows = {"mixed": brute.mixed_rows(2, 40)[:-1], "nulls": [(1, None), (1, None), (2, None), (None, None)], "empty": []}[kind]
    docs = brute.docs_of(spark, rows or [(1, "x")]).filter("true" if rows else "false")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, "")
        if name == "packed":
            length, whole = Counter(), {}
            for r in got.collect():
                length[r.doc_id] += r.length
                whole[r.doc_id] = r.doc_tokens
            assert {i: n // whole[i] for i, n in length.items()} == dict(Counter(i for i, _ in rows))
            assert all(n % whole[i] == 0 for i, n in length.items())
            continue
        found = got.collect()
        assert got.columns == docs.columns and Counter(r.doc_id for r in found) == WANT[name](rows), name
        if name == "line_dedup":
            assert Counter((r.doc_id, r.text) for r in found) == Counter((i, text) for i, *_, text in brute.brute_lines(rows))
            assert all(r.n_chars == len(r.text) for r in found)


def test_language_stage_rejects_unlikely_languages_only(spark):
    """Three languages that share no letter: their documents stay, and one without any of their letters goes."""
    words = {"en": "aba cab ", "fr": "xyx zyx ", "de": "mnm onm "}
    rows = [(i, words[k] * 9, k) for i in range(300) for k in [["en", "fr", "de"][i % 3]]] + [(900, "qqqq", None), (901, "aba cab", None)]
    docs = documents(spark, rows)
    told = {r.doc_id: r for r in corpus_pipeline.langid.identify(docs).collect()}
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert set(kept) == {i for i, r in told.items() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
    assert kept == {i: k for i, _, k in rows[:300]} | {901: "en"}
