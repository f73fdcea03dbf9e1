"""Corpus operators on small tables against brute force, with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crawlstrata.llm import exactdedup, jaccard, langid, licenses, linededup, mixing, packing, quality, toxicity, urlfilter
from crawlstrata.session import scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = re.compile("[\x20\x09-\x0D]+")
WORD = re.compile("[^\x20\x09-\x0D]+")
# Columns whose names the operators use themselves or that differ from a document's in nothing but meaning.
CLASH = ["n", "tokens", "rep", "digest", "score", "kept", "pos", "h", "w", "label", "part", "start", "length", "segment"]


def docs_of(spark, rows, clash=True, parts=3):
    """Documents (doc_id, text); every column that could clash holds something."""
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.when(F.col("doc_id") % 2 == 0, "src0").otherwise("src9"), "n_chars": F.length("text").cast("long")}
    )
    return (df.withColumns({c: F.lit("x") for c in CLASH}) if clash else df).repartition(parts)


def mixed_rows(seed=1, n=120):
    """Texts with shared lines, near and exact copies, odd spaces, nulls and empty ones, and repeated rows."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeéßÇ") for _ in range(rnd.randrange(1, 8))) for _ in range(300)]
    shared = [" ".join(rnd.choice(words) for _ in range(12)) for _ in range(4)]
    rows = []
    for i in range(n):
        lines = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 30))) for _ in range(rnd.randrange(1, 6))]
        lines += [f"  {rnd.choice(shared).upper() if rnd.random() < 0.3 else rnd.choice(shared)}\t" for _ in range(rnd.randrange(3))]
        rnd.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    for i in range(n, n + 60):
        text = rnd.choice(rows)[1]
        parts = text.split(" ")
        for _ in range(rnd.randrange(3)):
            parts[rnd.randrange(len(parts))] = "zzz"
        rows.append((i, rnd.choice([" ", "  "]).join(parts)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "x"), (904, "X  y"), (905, "x Y"), (None, "null id"), (None, "null id")]
    rows += [(906, "lorem ipsum " * 3000), rows[5], rows[5], (7, "another text of an id that is used twice")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return mixed_rows()


# Line dedup


def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    top = lambda ids: max((i for i in ids if i is not None), default=None)
    gone = {k: top(v) for k, v in holders.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if not (key(line) in gone and gone[key(line)] != i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_equals_brute_force(spark, rows):
    got = linededup.dedup_lines(docs_of(spark, rows))
    assert got.columns[:2] == ["doc_id", "lang"] and set(CLASH) <= set(got.columns)
    found = [(r.doc_id, r._n_lines, r._n_dropped, r.text) for r in got.collect()]
    order = lambda x: (x[0] is None, x[0] or 0, x[3])
    want = brute_lines(rows)
    assert sum(x[2] for x in want) > 20
    assert sorted(found, key=order) == sorted(want, key=order)


# Exact dedup


def brute_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACES.sub(" ", t or "")].append(i)
    out, seen = [], set()
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        text = SPACES.sub(" ", t or "")
        keep = min((x for x in groups[text] if x is not None), default=None)
        first = i == keep and text not in seen
        if first:
            seen.add(text)
        out.append((i, keep, len(groups[text]), first, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("bits", [12, 1])
def test_exact_copies_equal_brute_force(spark, rows, bits):
    got = exactdedup.exact_copies(docs_of(spark, rows), bits_per_row=bits)
    assert Counter(tuple(r) for r in got.collect()) == brute_copies(rows)


@pytest.mark.parametrize("bits", [1000, 6000])
def test_exact_copies_in_slices_equal_brute_force(spark, bits, monkeypatch):
    rows = [(i, f"text {i % 170}" if i % 3 else f"only {i}") for i in range(600)] + [(900 + i, "hot  text") for i in range(300)]
    planes, plane = [], exactdedup.repeated_plane
    monkeypatch.setattr(exactdedup, "repeated_plane", lambda part, words: planes.append((part.count(), words)) or plane(part, words))
    got = exactdedup.exact_copies(docs_of(spark, rows), bits_per_row=bits, max_filter_bytes=32 << 10)
    assert Counter(tuple(r) for r in got.collect()) == brute_copies(rows)
    assert len(planes) == -(-900 * bits // (32 << 13)) and sum(n for n, _ in planes) == 900 and {w for _, w in planes} == {4096}


def test_slices_leave_single_digests_alone(spark):
    rows = [(i, f"text {i}") for i in range(30_000)] + [(40_000 + i, f"text {i}") for i in range(50)]
    key = F.conv(F.substr("_hex", F.lit(-4)), 16, 10).cast("int").alias("_key")
    made = spark.createDataFrame(rows, "_id long, t string").withColumn("_hex", F.sha2("t", 256)).select("_id", F.unhex("_hex").alias("_sha"), key)
    marked = exactdedup.marked_in_slices(made, 12, 32 << 10)
    repeated = marked.filter("_id < 50 or _id >= 40000")
    assert marked.count() == 30_050 and repeated.filter("_maybe").count() == 100
    assert marked.filter("_maybe").count() < 100 + 0.05 * 30_000


def test_bloom_planes_find_every_repeated_digest():
    digests = [hashlib.sha256(str(i % 800).encode()).digest() for i in range(1000)]
    words = exactdedup.filter_words(1000, 12, 1 << 20)
    once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    for i in range(0, 1000, 70):
        exactdedup.add(once, twice, exactdedup.places(digests[i : i + 70], words))
    at = exactdedup.places(digests, words)
    hit = ((twice[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)
    repeated = {d for d, n in Counter(digests).items() if n > 1}
    assert all(hit[i] for i, d in enumerate(digests) if d in repeated)
    assert sum(hit[i] for i, d in enumerate(digests) if d not in repeated) < 60


# Jaccard join


def brute_components(rows, size, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(zip(*(w[k:] for k in range(size)))) if len(w) >= size else frozenset([tuple(w)] if w else []))
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    part[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (2, 60)])
def test_jaccard_join_equals_brute_force(spark, rows, size, percent):
    got = jaccard.link_documents(docs_of(spark, rows), size=size, percent=percent)
    assert Counter(tuple(r) for r in got.collect()) == brute_components(rows, size, percent)


def test_jaccard_join_of_a_large_group_without_a_centre(spark):
    """A chain of texts, each near its neighbours only, and a hundred variants of one text."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i : i + 100])) for i in range(60)]
    rnd = random.Random(4)
    base = [f"b{i}" for i in range(200)]
    for i in range(100, 200):
        text = list(base)
        for _ in range(rnd.randrange(4)):
            text[rnd.randrange(200)] = f"u{i}"
        rows.append((i, " ".join(text)))
    got = jaccard.link_documents(docs_of(spark, rows, clash=False))
    assert Counter(tuple(r) for r in got.collect()) == brute_components(rows, 3, 90)
    kept = jaccard.representatives(docs_of(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute_components(rows, 3, 90)})
    assert kept.columns == docs_of(spark, rows).columns


def test_texts_of_sets_need_one_python_worker_a_task(spark):
    """A join that is broadcast leaves the functions before and after it in one task, with a Python worker each."""
    rows = [(i, f"some words of text {i} and more") for i in range(40)] + [(None, "no id has this text"), (3, "another text of three"), (7, None)]
    docs = spark.createDataFrame(rows, "_id long, _text string").repartition(3)
    digest = lambda text: jaccard.digest_of(jaccard.shingles([text or ""], 3)[0])
    sets = spark.createDataFrame([(digest(t), i) for i, t in rows if t], "digest binary, rep long")
    wanted = [rows[k][1] for k in (1, 3, 20, 40, 41)]
    digests = spark.createDataFrame([(digest(t),) for t in wanted], "digest binary")
    texts = jaccard.texts_of(digests, sets, docs, 3, scratch(spark, "wanted"))
    assert texts._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert {(bytes(r.digest), r._text) for r in texts.collect()} == {(digest(t), t) for t in wanted} and texts.count() == 5


def test_components_of_chains_and_stars(spark):
    links = [(f"{i:03d}", f"{i + 1:03d}") for i in range(40)] + [("100", f"{i}") for i in range(101, 150)] + [("300", "299")]
    got = {r.node: r.label for r in jaccard.components(spark.createDataFrame(links, "a string, b string")).collect()}
    want = {f"{i:03d}": "000" for i in range(1, 41)} | {f"{i}": "100" for i in range(101, 150)} | {"300": "299"}
    assert got == want


# Packing


def test_millions_of_blanks_are_packed(spark):
    """The quicker encoder refuses a million blanks; the ids are those of the JSON file all the same."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, " " * 2_000_000), (2, "a word" + " \t" * 1_000_000 + "b"), (3, "x " * 100_000)]
    ids = defaultdict(list)
    for r in sorted(packing.pack(docs_of(spark, rows)).collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(ids[r.doc_id])
        ids[r.doc_id] += r.ids
    assert ids == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in rows}


def packed_rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("size,windows", [(1024, 256), (64, 4), (7, 2)])
def test_packing_is_an_exact_round_trip(spark, rows, size, windows):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = [(k, t) for k, (_, t) in enumerate(rows)] + [(990, "a<|endoftext|>b"), (991, "\u200b\x00 \U0001f600")]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    found = packed_rows(packing.pack(docs_of(spark, rows, parts=5), size=size, open_windows=windows))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        assert r["length"] == len(r["ids"]) and r["doc_tokens"] == len(want[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    for i, ids in want.items():
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert [x for p in pieces for x in p["ids"]] == ids and [p["start"] for p in pieces] == [
            sum(p["length"] for p in pieces[:k]) for k in range(len(pieces))
        ]
    room = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in pieces] == [sum(p["length"] for p in pieces[:k]) for k in range(len(pieces))]
        fill = sum(p["length"] for p in pieces)
        assert fill <= size
        room += size - fill
    if size == 1024:
        assert room < 0.05 * sum(map(len, want.values())) + size


def test_ids_of_open_windows_are_not_copied():
    ids = np.arange(1_000_000, dtype=np.int32)
    lists = pa.chunked_array([pa.array(np.split(part, 500), pa.list_(pa.int32())) for part in np.split(ids, 2)] + [pa.array([[5], [7, 8], [9]], pa.list_(pa.int32())).slice(1)])
    tracemalloc.start()
    found = packing._ids_of(lists)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2_000_000 and len(found) == 1002 and found[0].dtype == np.uint32
    assert np.array_equal(np.concatenate(found[:1000]), ids) and [f.tolist() for f in found[1000:]] == [[7, 8], [9]]


def test_open_windows_place_best_fit_and_emit_the_fullest():
    windows = packing.OpenWindows(10, 2)
    assert windows.place(6, "a") == [] and windows.place(7, "b") == []
    assert windows.place(3, "c") == [(1, [(0, "b"), (7, "c")])]
    assert windows.place(8, "d") == []
    assert windows.place(9, "e") == [(2, [(0, "d")])]


# Licences


def test_licence_scan_equals_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = "under the mit license apache version 2 cc by nc ccé x released is".split()
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(60)) for _ in range(150)]
    texts += ["cc by nc by nc cc  BY-NC", "Under the MIT-License", None, "", "İ cc\u00e9 by nc", "Apache License, Version 2.0 " * 40]
    rows = list(enumerate(texts))
    token = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    phrases = [(label, p.split()) for label, p in licenses.PHRASES]
    got = {r.doc_id: r for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        words = token.findall((t or "").translate(LOWER))
        places = [(k, label) for label, p in phrases for k in range(len(words)) if words[k : k + len(p)] == p]
        r, starts = got[i], [k for k, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_licence_templates_are_chained_over_gaps(spark):
    mit = licenses.TEMPLATES[0][1].split()
    broken = " ".join([*mit[:20], "x", "y", *mit[20:40], "z", *mit[42:]])
    half = " ".join(mit[: len(mit) // 2])
    gpl = "This work is licensed under the GNU General Public License, version 3."
    got = {r.doc_id: r for r in licenses.scan(docs_of(spark, [(1, f"a b {broken} c"), (2, half), (3, gpl), (4, "nothing here")])).collect()}
    assert got[1].labels == "mit" and got[1].n_base == 0 and 0.8 < got[1].score <= 1 and got[1].spans[0].first == 2
    assert got[2].labels == "" and 0.3 < got[2].score < 0.7
    assert got[3].labels == "gpl-3" and got[4].score == 0


def test_matching_statistics_equal_brute_force():
    rnd = random.Random(8)
    texts = [[rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randrange(1, 12))] for _ in range(6)]
    automaton = licenses.build(texts, len(texts))
    sizes = [len(t) for t in texts]
    words = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)]
    places, matches = licenses.statistics(automaton, words, sizes, 2)
    assert sorted(places) == sorted((p, k) for p, t in enumerate(texts) for k in range(len(words)) if words[k : k + len(t)] == t)
    inside = lambda part: any(part == t[k : k + len(part)] for t in texts for k in range(len(t)))
    for m in matches:
        part = words[m.end - m.size + 1 : m.end + 1]
        assert part == texts[m.text][m.place - m.size + 1 : m.place + 1]
        assert m.end + 1 == len(words) or not inside([*part, words[m.end + 1]])
        assert m.end - m.size < 0 or not inside([words[m.end - m.size], *part])


# URLs


def test_url_filter_equals_brute_force(spark):
    rnd = random.Random(2)
    hosts = ["a.net", "example.net", "www.example.net", "x.org", "org", "notorg", "Spam.Example.com", "", "net"]
    paths = ["/en/x", "/en", "/fr/", "/de/1", "", "/", "/EN/y", "/de/deep/er"]
    rows = [(i, f"https://{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', '?a=/en/', '#x'])}") for i in range(300)]
    rows += [(301, None), (302, ""), (303, "no scheme/en/"), (304, "x://y://z/"), (305, "http://a.b.c.example.com/de/?q"), (None, "http://x.net/"), (300, "http://x.net/")]
    rows += [(306, "http://" + "a." * 3000 + "net/" + "x" * 5000)]
    listed = [("net", "/", "block", True), ("example.net", "/en/", "allow", True), ("example.com", "/de/", "block", True),
              ("example.com", "/de/deep", "allow", True), ("org", "/fr/", "allow", True), ("spam.example.com", "", "block", False)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("x") for c in ["host", "path", "verdict", "rule", "html"]})
    got = urlfilter.judge_urls(pages, spark.createDataFrame(listed, "host string, path string, verdict string, rule boolean"))

    def judged(url):
        found = re.search("://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (found.group(1).translate(LOWER), found.group(2)) if found else ("", "")
        fits = [e for e in listed if (host == e[0] or host.endswith("." + e[0])) and path.startswith(e[1])]
        best = max(fits, key=lambda e: (e[3], len(e[0] + e[1]), len(e[0])), default=None)
        return host, path, best[0] + best[1] if best and best[3] else None, best[2] if best else "allow"

    assert Counter(tuple(r)[:5] for r in got.collect()) == Counter((i, *judged(u)) for i, u in rows)
    nothing = urlfilter.judge_urls(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert nothing.filter("verdict = 'allow' and rule is null").count() == len(rows)


# Language


def language_rows(n=200):
    rnd = random.Random(6)
    parts = {"en": ["th", "e", "ing", "and", "wh"], "fr": ["é", "le", "que", "eau", "ç"], "de": ["sch", "ü", "ung", "ei", "ß"]}
    rows = []
    for i in range(n):
        lang = ["en", "fr", "de"][i % 3]
        word = lambda lang=lang: "".join(rnd.choice(parts[lang]) for _ in range(rnd.randrange(1, 4)))
        rows.append((i, " ".join(word() for _ in range(rnd.randrange(4, 60))), lang))
    return rows + [(900, None, "en"), (901, "", "fr"), (902, "123 !? \U0001f600", "de"), (None, "the ingand", "en"), (903, "the thing", None), (3, "le eau", "fr")]


def test_language_of_held_out_documents(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit("x") for c in ["lang_pred", "score", "held_out"]})
    got = langid.identify(docs.repartition(4)).collect()
    assert len(got) == len(rows)
    truth = {(i, t): lang for i, t, lang in rows}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    text = {i: t for i, t, _ in rows[:200]}
    assert len(held) > 20 and np.mean([r.lang_pred == truth[r.doc_id, text[r.doc_id]] for r in held]) > 0.95
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (900, 901, 902)} == {"und"} and {by[i].score for i in (900, 901, 902)} == {0.0}
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "de", "und") for r in got)
    again = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs.repartition(2)).collect()}
    assert again == {(r.doc_id, r.lang_pred, r.score) for r in got}


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert tuple(langid.identify(docs).first())[2:] == ("und", 0.0)


def test_ftrl_leaves_useless_weights_at_zero():
    rnd = np.random.default_rng(0)
    rows = [(np.array([label, 10 + rnd.integers(500)]), np.array([0.7, 0.7]), label) for label in rnd.integers(0, 2, 300)]
    weights, _ = langid.fit_ftrl(rows, np.ones(langid.DIMENSIONS), 2, 3, 0.5, 0.5, 0.1)
    assert (weights[[0, 1]] != 0).any() and (weights[2000:] == 0).all() and (weights[10:510] == 0).mean() > 0.9
    logits = np.array([[4.0, 0.0]] * 90 + [[0.0, 4.0]] * 10)
    assert langid.fit_temperature(logits, np.zeros(100, int)) > 1


# Toxicity


def test_toxicity_of_held_out_documents(spark):
    rnd = random.Random(9)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in ("an", "er", "ing", "ou", "st")]
    rows, labels = [], []
    for i in range(1200):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(20, 120))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(max(2, len(words) // 15)):
                words[rnd.randrange(len(words))] = rnd.choice(["moron", "scum", "trash"])
        rows.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, int(toxic)))
    rows += [(5000, None), (5001, ""), (5002, "?!"), (None, "an er"), rows[0]]
    labels += [(0, 0), (7777, 1), (8, None), (None, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.judge(docs_of(spark, rows), marks).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 5000]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == (r.doc_id % 8 == 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert {r.predicted for r in got if r.doc_id in (5000, 5001, 5002)} == {0}
    none = toxicity.judge(docs_of(spark, rows[:3]), marks.filter("toxic = 0")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}


def test_shared_counts_are_of_all_documents(spark):
    docs = spark.createDataFrame([("Ab cd ab",), (None,), ("ab",)], "_text string")
    low = toxicity.letter_table()
    words = np.sort(toxicity.words_of(["ab"], low)[0])
    counts, total = toxicity.shared_counts(docs, words)
    assert (counts.tolist(), total) == ([3], 4)


def test_calibration_rises():
    ratio, toxic = np.array([0.0, 1.0, 2.0, 3.0, 4.0, 5.0]), np.array([False, True, False, True, True, True])
    knots, shares = toxicity.calibrate(ratio, toxic)
    assert (np.diff(knots) > 0).all() and (np.diff(shares) > 0).all() and shares[0] == 0 and shares[-1] == 1


# Quality


def brute_quality(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def test_quality_counts_equal_brute_force(spark, rows):
    rnd = random.Random(5)
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    rows += [(1000 + k, " ".join(rnd.choice("ab") for _ in range(60))) for k in range(40)] + [(2000, "a\x85b\u00a0c\x1fd | # é\n\x0b\na\x85b")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows], "doc_id long, quality int")
    got = quality.judge(docs_of(spark, rows), labels, trees=20, sample=64).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in got} == {i: brute_quality(t) for i, t in rows} and len(got) == len(rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_isolation_forest_rejects_what_the_labels_call_bad(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9)))
    rows = [(i, " ".join((word() + "$$$") if i % 20 == 0 else word() for _ in range(rnd.randrange(40, 200)))) for i in range(400)]
    labels = [(i, int(i % 20 > 0)) for i in range(400) if i % 3]
    got = quality.judge(docs_of(spark, rows), spark.createDataFrame([*labels, (2, 1), (999, 0)], "doc_id long, quality int"), max_loss=0.05).collect()
    assert np.mean([not r.kept for r in got if r.doc_id % 20 == 0]) > 0.9
    assert np.mean([r.kept for r in got if r.doc_id % 20 != 0]) > 0.93
    unlabelled = quality.judge(docs_of(spark, rows), spark.createDataFrame([], "doc_id long, quality int"))
    assert unlabelled.filter("not kept").count() == 0


# Mixing


def test_mixing_meets_the_targets(spark):
    rnd = random.Random(7)
    rows = [(i, " ".join("w" for _ in range(rnd.randrange(1, 50)))) for i in range(4000)] + [(5000, None), (5001, ""), (None, "a b")]
    docs = docs_of(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 5 == 0, "fr").when(F.col("doc_id") % 7 == 0, None).otherwise("en"))
    columns = {"source": F.col("source"), "lang": F.col("lang")}
    targets = {"source": {"src0": 0.3, "other": 0.7}, "lang": {"en": 0.5, "fr": 0.4, "other": 0.1, "it": 5.0}}
    got = mixing.mix(docs, columns, targets, rounds=20).toPandas()
    assert len(got) == len(rows) and got["probability"].between(0, 1).all() and got["probability"].max() == 1
    weight = got["tokens"] * got["probability"]
    for column, shares in (("source", {"src0": 0.3, "other": 0.7}), ("lang", {"en": 0.5, "fr": 0.4, "other": 0.1})):
        for value, share in shares.items():
            assert abs(weight[got[column] == value].sum() / weight.sum() - share) < 1e-6
            kept = got[got["kept"]]
            assert abs(kept["tokens"][kept[column] == value].sum() / kept["tokens"].sum() - share) < 0.06
    sampled = mixing.sample(docs, columns, targets, rounds=20)
    assert sampled.columns == docs.columns and sampled.count() == got["kept"].sum()
    with pytest.raises(ValueError):
        mixing.mix(docs, columns, {"source": {str(i): 1.0 for i in range(2000)}, "lang": {str(i): 1.0 for i in range(2000)}})


def brute_fill(ask, most, room):
    """What each key gets: its ask by one factor, found by halving, and no more than its most."""
    low, high = 0.0, 1e12
    for _ in range(300):
        factor = (low + high) / 2
        low, high = (factor, high) if sum(min(most[k], factor * ask[k]) for k in ask) < room else (low, factor)
    return {k: min(most[k], high * ask[k]) for k in ask}


def brute_budget(cells, targets, rounds, budget):
    """Probability by cell; `cells` has tokens by a tuple with one value per target column."""
    room, weight, goals = budget * sum(cells.values()), dict(cells), []
    for i, goal in enumerate(targets):
        held = Counter()
        for cell, n in cells.items():
            held[cell[i]] += n
        goals.append(brute_fill({v: goal.get(v, 0) if n else 0 for v, n in held.items()}, held, room))
    for _ in range(rounds):
        for i, goal in enumerate(goals):
            total = Counter()
            for cell, w in weight.items():
                total[cell[i]] += w
            weight = {c: min(cells[c], w * goal[c[i]] / total[c[i]]) if total[c[i]] else 0 for c, w in weight.items()}
    return {c: w / cells[c] if cells[c] else 0 for c, w in brute_fill(weight, cells, room).items()}


@pytest.mark.parametrize("budget", [0.1, 0.5, 0.9])
def test_mixing_keeps_its_budget_beside_a_rare_cell(spark, budget):
    rnd = random.Random(9)
    rows = [(i, " ".join("w" for _ in range(rnd.randrange(1, 50)))) for i in range(1, 3001, 2)] + [(2, "a b"), (4, None), (None, "c d"), (3, "e")]
    docs = docs_of(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 11 == 0, "it").when(F.col("doc_id") % 3 == 0, "fr").otherwise("en"))
    columns = {"source": F.col("source"), "lang": F.col("lang")}
    targets = {"source": {"src0": 0.3, "other": 0.7}, "lang": {"en": 0.5, "fr": 0.5}}  # src0 has two tokens
    got = mixing.mix(docs, columns, targets, rounds=20, budget=budget).toPandas()
    cells = got.groupby(["source", "lang"])["tokens"].sum().to_dict()
    want = brute_budget(cells, [targets["source"], targets["lang"]], 20, budget)
    assert all(abs(r.probability - want[r.source, r.lang]) < 1e-6 for r in got.itertuples())
    left = sum(n for (_, lang), n in cells.items() if lang != "other")  # the targets leave Italian out
    assert abs((got["tokens"] * got["probability"]).sum() - min(budget * sum(cells.values()), left)) < 0.01
    assert abs(got["tokens"][got["kept"]].sum() / sum(cells.values()) - min(budget, left / sum(cells.values()))) < 0.05
    assert mixing.sample(docs, columns, targets, rounds=20, budget=budget).count() == got["kept"].sum()
    with pytest.raises(ValueError):
        mixing.mix(docs, columns, targets, budget=0)


# All of them on empty tables


def test_empty_tables(spark):
    docs = docs_of(spark, [(1, "x")]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    results = [
        linededup.dedup_lines(docs), exactdedup.exact_copies(docs), jaccard.link_documents(docs), jaccard.representatives(docs), packing.pack(docs),
        licenses.scan(docs), langid.identify(docs), toxicity.judge(docs, labels), quality.judge(docs, labels), urlfilter.judge_urls(pages, listed),
        mixing.mix(docs, {"source": F.col("source")}, {"source": {"src0": 1.0}}),
    ]
    assert [r.count() for r in results] == [0] * len(results)
