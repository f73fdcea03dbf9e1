"""Chat formatting, vector codes and spelling groups beside brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlstrata.llm import chat, codes, spelling

CLASH = ["segment", "whole", "_conv", "_turn", "_text", "ids", "starts", "loss", "error", "code", "n", "word", "grams", "_id", "_x", "key", "form"]


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASH if c not in df.columns}).repartition(3)


# Chat formatting


def odd_text(rnd):
    parts = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "ROLE]", "TEXT]", "/TURN]", "|endoftext|>", "</s>", "[INST]", "<\\s>", "é", "😀", "é́", " ", "\n", "ok", "ß ok"]
    return "".join(rnd.choice(parts) for _ in range(rnd.randrange(12)))


def test_escaping_is_reversible_and_leaves_no_control_string():
    rnd = random.Random(3)
    seen = {}
    for _ in range(20_000):
        text = odd_text(rnd)
        out = chat.escape(text)
        assert chat.unescape(out) == text and not any(c in out for c in chat.CONTROLS)
        assert seen.setdefault(out, text) == text
    assert chat.escape("</s>[INST] ok [/INST]") == "<\\/s>[\\INST] ok [\\/INST]"


def test_rendered_turns_are_read_back():
    rnd = random.Random(4)
    for _ in range(2000):
        turns = [(rnd.choice(["user", "assistant", "system", "", odd_text(rnd)]), odd_text(rnd)) for _ in range(rnd.randrange(6))]
        formatted, spans = chat.render(turns)
        assert list(chat.read_turns(formatted)) == turns
        assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_tokens_inside_spans_equal_a_loop_over_all_spans():
    rnd = random.Random(5)
    for _ in range(300):
        cuts = sorted(rnd.sample(range(100), rnd.randrange(0, 10) * 2))
        spans = list(zip(cuts[::2], cuts[1::2], strict=True))
        at = sorted((a, a + rnd.randrange(0, 6)) for a in rnd.choices(range(100), k=30))
        starts, ends = np.array(at, np.int32).T
        want = [b > a and any(s <= a and b <= e for s, e in spans) for a, b in at]
        assert chat.inside(spans, starts, ends).tolist() == want


def chat_rows():
    rnd = random.Random(6)
    rows = [(c, t, rnd.choice(["user", "assistant", "assistant", "system", "[ROLE]"]), odd_text(rnd)) for c in range(40) for t in range(rnd.randrange(1, 7))]
    rows += [(50, 0, None, None), (50, 1, "assistant", None), (51, None, "user", "no turn"), (51, 0, "assistant", ""), (52, 0, "user", "")]
    rows += [(None, 1, "assistant", "x"), (None, 0, "user", "null id"), (53, 0, "user", "same"), (53, 0, "user", "same"), (53, 0, "assistant", "b"), (53, 0, "assistant", "a")]
    rows += [(54, 0, "assistant", " " * 30_000 + "é" * 10_000), (55, 0, "user", "q")]
    rows += [(99, t, ["user", "assistant"][t % 2], f"turn {t} {odd_text(rnd)}") for t in range(200)]
    return rows


def brute_chats(rows, digest):
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv].append((turn is not None, turn or 0, role or "", digest[text or ""], text or ""))
    out = set()
    for conv, turns in grouped.items():
        said = [(role, text) for _, _, role, _, text in sorted(turns)]
        loss = "".join(text for role, text in said if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.add((conv, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss), len(chat.render(said)[0])))
    return out


@pytest.mark.parametrize("max_chars", [1 << 20, 40, 1])
def test_chats_equal_brute_force_whole_and_in_segments(spark, max_chars):
    rows = chat_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    digest = {r.text: r.d for r in df.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("d", F.xxhash64("text")).collect()}
    made = chat.format_chats(clashing(df), max_chars=max_chars)
    assert {tuple(r) for r in chat.digests(made).collect()} == brute_chats(rows, digest)
    parts = defaultdict(dict)
    for r in made.collect():
        assert len(r.ids) == len(r.starts) == len(r.ends) == len(r.loss)
        parts[r.conv_id][r.segment] = r
    assert all(len(p) == 1 for p in parts.values()) == (max_chars == 1 << 20) and len(parts[99]) > (1 if max_chars < 100 else 0)
    encode = chat.default_encoder()
    whole = "".join(parts[99][s].formatted for s in sorted(parts[99]))
    assert [i for s in sorted(parts[99]) for i in parts[99][s].ids] == encode(whole)[0].tolist()


def test_no_conversations_make_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_chats(empty)).collect() == []


# Vector codes


def brute_codes(rows, parts, entries, rounds, scale=256):
    """(id, code, error) and the last codebooks, by loops over whole numbers."""
    import math

    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and v and len(v) % parts == 0]
    order = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(order[0][1])] if order else []
    order = [r for r in order if len(r[1]) == len(order[0][1])][:entries] if order else []
    m = len(order[0][1]) // parts if order else 0
    cut = lambda v, p: v[p * m : (p + 1) * m]
    books = [[cut(v, p) for _, v in order] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, v in good:
                held[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(held[j]) for c in zip(*held[j], strict=True)] if j in held else e for j, e in enumerate(books[p])]
    out = []
    for i, v in good:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    return out, books


def vector_rows(seed, n, size, centres=0):
    rnd = random.Random(seed)
    middle = [[rnd.uniform(-40, 40) for _ in range(size)] for _ in range(centres)]
    point = lambda: [rnd.gauss(x, 0.3) for x in rnd.choice(middle)] if middle else [rnd.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(size)]
    return [(i, point()) for i in range(n)]


@pytest.mark.parametrize("case", ["ties", "clusters", "odd", "few", "large", "empty"])
def test_codes_equal_brute_force(spark, case):
    rows = {
        "ties": vector_rows(1, 150, 12), "clusters": vector_rows(2, 200, 8, centres=12), "few": vector_rows(3, 5, 4),
        "odd": [*vector_rows(4, 60, 8), (3, [1.0] * 8), (3, [1.0] * 8), (None, [0.5] * 8), (70, None), (71, []), (72, [1.0] * 6), (73, [2.0] * 12),
                (74, [float("nan")] * 8), (75, [float("-inf"), *[0.0] * 7]), (76, [None, *[0.0] * 7])],
        "large": [(i, [x * 5000 for x in v]) for i, v in vector_rows(5, 60, 4)], "empty": [(1, None)],
    }[case]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.when(F.col("vec_id") % 3 > 0, F.col("vec_id") % 3))
    coded, history = codes.compress(clashing(df), carry=("label",), parts=4, entries=16)
    want, books = brute_codes(rows, 4, 16, 2)
    got = coded.collect()
    assert Counter((r.vec_id, r.code, r.error) for r in got) == Counter(want)
    assert history[-1].tolist() == books or not want
    label = lambda i: i % 3 or None if i is not None else None
    total = Counter()
    for i, _, error in want:
        total[label(i)] += error
    summed = codes.with_label_error(coded).collect()
    assert Counter((r.vec_id, r.label_error) for r in summed) == Counter((i, total[label(i)]) for i, *_ in want)


def test_bounds_save_scans_and_hold_over_rounds():
    """Over ten rounds, with bounds taken in different ones: the entries of a full scan, with a part of the scans."""
    rnd = np.random.default_rng(7)
    middle = rnd.integers(-4000, 4000, (20, 4))
    x = (middle[rnd.integers(0, 20, 3000)] + rnd.integers(-60, 60, (3000, 4)))[:, None, :].astype(np.int64)
    history, state, scans = [x[:24, 0][None].copy()], (None, None, None), []
    for _ in range(10):
        own, error, low, stamp, made = codes.assign(x, history, *state)
        best = codes.distances(x[:, 0], history[-1][0])
        assert (own[:, 0] == best.argmin(1)).all() and (error[:, 0] == best.min(1)).all()
        scans.append(int(made.sum()))
        state = (own, low, stamp)
        means = [x[own[:, 0] == j, 0].sum(0) // max(1, (own[:, 0] == j).sum()) if (own[:, 0] == j).any() else history[-1][0, j] for j in range(24)]
        history.append(np.array(means)[None])
    assert scans[0] == 3000 and scans[-1] < 600 and len(set(stamp[:, 0].tolist())) > 1


def test_net_moves_are_no_longer_than_summed_ones():
    rnd = np.random.default_rng(8)
    history = [rnd.integers(-50, 50, (2, 6, 3)) for _ in range(4)]
    moves = codes.net_moves(history, 1)
    for stamp in range(4):
        way = np.sqrt(((history[-1][1] - history[stamp][1]) ** 2).sum(1))
        steps = sum(np.sqrt(((history[t + 1][1] - history[t][1]) ** 2).sum(1)) for t in range(stamp, 3)) + 0 * way
        for j in range(6):
            others = [i for i in range(6) if i != j]
            assert way[others].max() <= moves[stamp, j] <= steps[others].max() + 1e-6


# Spelling groups


def near(a, b):
    """One code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_groups(counts, factor=5):
    out = {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        top = min(others, key=lambda v: (-counts[v], v), default=None)
        out[w] = (n, len(others), top if top and counts[top] >= factor * n else None)
    root = lambda w: root(out[w][2]) if out[w][2] else w
    return {(w, n, k, form, counts.get(form), root(w)) for w, (n, k, form) in out.items()}


def variants(rnd, n, letters, least, most):
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(least, most))) for _ in range(n)]
    for _ in range(3 * n):
        w = rnd.choice(words)
        i = rnd.randrange(len(w) + 1)
        words.append(rnd.choice([w[:i] + rnd.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + rnd.choice(letters) + w[i + 1 :]]))
    return sorted({w for w in words if w})


@pytest.mark.parametrize("letters, least, most", [("ab", 1, 9), ("abcé", 6, 14), ("abcdefghé\U00010400", 4, 20), ("a", 1, 30)])
def test_groups_equal_brute_force(spark, letters, least, most):
    rnd = random.Random(len(letters))
    counts = {w: int(5 ** rnd.uniform(1, 6)) for w in variants(rnd, 60, letters, least, most)}
    df = spark.createDataFrame([*counts.items()], "word string, n long")
    got = spelling.group_spellings(clashing(df))
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert {tuple(r) for r in got.collect()} == brute_groups(counts)


def test_long_words_and_chains_of_forms(spark):
    counts = {"abcdefgh"[:6] + "x" * i: 6**i for i in range(1, 13)} | {"q" * 20_000: 7, "q" * 19_999: 50}
    got = spelling.group_spellings(spark.createDataFrame([*counts.items()], "word string, n long")).collect()
    root = {r.word: r.root for r in got}
    assert root["abcdefx"] == "abcdef" + "x" * 12 and root["q" * 20_000] == "q" * 19_999


def test_pivots_are_the_cheapest_disjoint_grams():
    rnd = random.Random(9)
    for _ in range(500):
        grams = [(rnd.randrange(9), f"{at:02}", at) for at in sorted(rnd.sample(range(1, 12), rnd.randrange(1, 7)))]
        pairs = [(a, b) for a in grams for b in grams if b[2] - a[2] >= 2]
        found = spelling.pivots_of(grams)
        assert bool(found) == bool(pairs)
        if pairs:
            assert found[1][2] - found[0][2] >= 2 and sum(g[0] for g in found) == min(a[0] + b[0] for a, b in pairs)


def test_words_are_counted_like_brute_force(spark):
    rnd = random.Random(10)
    base = ["Élevage", "couleur", "Houses", "straße", "ÄRGERLICH", "short", "naïveté"]
    rows = [(i, rnd.choice([" ", "-", "7"]).join(rnd.choice(base) for _ in range(rnd.randrange(60)))) for i in range(400)]
    rows += [(None, "couleur " * 9), (1, None), (2, ""), (3, "x" * 70_000), rows[0], rows[0], (-5, "Houses couleur")]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    got = spelling.count_words(clashing(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {(r.word, r.n) for r in got.collect()} == {(w, n) for w, n in counts.items() if n >= 5}


def test_no_words_make_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_spellings(spelling.count_words(empty)).collect() == []
