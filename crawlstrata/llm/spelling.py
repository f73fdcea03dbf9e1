"""Words of a corpus and the more frequent words that they are a letter away from.

Pivotal grams: a word's bigrams are ordered from rare to common, and the rarest three are its prefix. Two of them
that do not overlap, the rarest such pair, are its pivots. One edit leaves one of two disjoint pivots whole, and
of two near words the one whose prefix ends earlier in the order has its pivots in the prefix of the other. So
pivots are looked up among prefixes only. An edit stands before or after the pivot that it spares; on the other
side the pivot has the same place and the words the same letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstrata.session import stage

# The contract's letters, and ASCII letters.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM = 2
EDITS = 1
# Grams that a task holds before it hands them on.
GRAMS_AT_ONCE = 1 << 16


def slipped(run: Column, id: Column, every: int) -> Column:
    """The run, without one code point where the crc32 of `<id>:<run>` is divided by `every`."""
    h = F.crc32(F.concat(F.coalesce(id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    cut = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.char_length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, cut).otherwise(run)


def count_words(docs: DataFrame, id: str = "doc_id", text: str = "text", least_chars: int = 6, least_count: int = 5, every: int = 199) -> DataFrame:
    """`word`, `n`: the words of at least `least_chars` code points that occur `least_count` times or more.

    Words are runs of Latin letters with A-Z lower-cased, each changed by `slipped`. A null text has none, a null
    id counts as empty in `slipped`; repeated rows count again; texts are read whole. Other columns are not read.
    Tasks count their own words before these are shuffled, so a word of any frequency is a row a task.
    """
    runs = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(RUN), F.lit(0))
    long_runs = F.filter(runs, lambda r: F.char_length(r) >= least_chars)
    each = docs.select(F.col(id).alias("_id"), F.explode(long_runs).alias("_run"))
    words = each.select(slipped(F.col("_run"), F.col("_id"), every).alias("word")).filter(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def prefix_of(grams: list[tuple[int, str, int]]) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """The first EDITS * GRAM + 1 of the (frequency, gram, position) in order; and in what places these may be met.

    The second list also has the other places of the same grams, up to GRAM * EDITS further ones: so many places
    of a gram may an edit put before one that it spares, so the ones of a repeated gram are bounded.
    """
    grams = sorted(grams)
    size = EDITS * GRAM + 1
    first = grams[:size]
    met, seen = [], dict.fromkeys((g[:2] for g in first), 0)
    for g in grams:
        if g[:2] > first[-1][:2]:
            break
        if seen[g[:2]] < size + GRAM * EDITS:
            seen[g[:2]] += 1
            met.append(g)
    return first, met


def pivots_of(prefix: list[tuple[int, str, int]], wanted: int = EDITS + 1) -> list[tuple[int, str, int]]:
    """`wanted` grams of the prefix that do not overlap, with the least sum of frequencies; none if there are not as many.

    By dynamic programming over the positions: the best choice of j grams among the first i either leaves the
    i-th out or joins it to the best j - 1 among those that end before it.
    """
    grams = sorted(prefix, key=lambda g: g[2])
    best: list[list[tuple[int, list] | None]] = [[(0, [])] + [None] * wanted]
    for i, gram in enumerate(grams):
        clear = i
        while clear and grams[clear - 1][2] + GRAM > gram[2]:
            clear -= 1
        row = list(best[i])
        for j in range(1, wanted + 1):
            before = best[clear][j - 1]
            if before and (row[j] is None or before[0] + gram[0] < row[j][0]):
                row[j] = (before[0] + gram[0], [*before[1], gram])
        best.append(row)
    found = best[-1][wanted]
    return found[1] if found else []


def near_pairs(words: DataFrame) -> DataFrame:
    """`word`, `near`: all ordered pairs of words that differ by one inserted, deleted or replaced code point.

    `words` has distinct words in `word`. Words under four code points have no two disjoint grams; each is
    looked up as a whole by what one deletion leaves of it, like every other word that is that short or one longer.
    Null and empty words are near nothing. Pairs are found through keys that one word shares with a pivot of the
    other on a whole side of it, so no key gathers words for a common gram alone.
    """
    some = stage(words.filter(F.char_length("word") > 0).select("word", F.monotonically_increasing_id().alias("number")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int32()]
        out: list[list] = [[], [], []]

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["number", "gram", "at"])
            for column in out:
                column.clear()
            return made

        for batch in batches:
            for number, word in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                places = range(len(word) - GRAM + 1)
                out[0] += [number] * len(places)
                out[1] += [word[i : i + GRAM] for i in places]
                out[2] += [i + 1 for i in places]
                if len(out[0]) >= GRAMS_AT_ONCE:
                    yield flushed()
        yield flushed()

    grams = some.select("number", "word").mapInArrow(cut, "number long, gram string, at int")
    counts = stage(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("f")))
    ranked = grams.join(counts, "gram").groupBy("number").agg(F.collect_list(F.struct("f", "gram", "at")).alias("grams"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for number, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                prefix, met = prefix_of([(g["f"], g["gram"], g["at"]) for g in found])
                out += [(number, 0, g[2]) for g in met] + [(number, 1, g[2]) for g in pivots_of(prefix)]
            columns = list(zip(*out, strict=True)) or [[]] * 3
            types = [pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["number", "role", "at"])

    chosen = ranked.mapInArrow(pick, "number long, role int, at int").join(some, "number")
    # Side 0: same letters up to and with the gram; side 1: same letters from the gram on. The place is that on the side.
    length = F.char_length("word")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("at").alias("place"), F.substring("word", F.lit(1), F.col("at") + 1).alias("part")),
        F.struct(F.lit(1).alias("side"), (length - F.col("at")).alias("place"), F.substring("word", F.col("at"), length).alias("part")),
    )
    keyed = chosen.select("word", "role", F.substring("word", F.col("at"), F.lit(GRAM)).alias("gram"), F.inline(sides))
    key = F.xxhash64("part", "gram", "side", "place")
    keyed = stage(keyed.select("role", "word", key.alias("key"), length.alias("size")).distinct())
    pivots = keyed.filter("role = 1").select(F.col("word").alias("a"), "key", F.col("size").alias("size_a"))
    prefixes = keyed.filter("role = 0").select(F.col("word").alias("b"), "key", F.col("size").alias("size_b"))
    # Short words: what is left when a code point is taken out, or none.
    tiny = some.filter(F.char_length("word") <= GRAM * (EDITS + 1))
    left = F.transform(F.sequence(F.lit(1), length), lambda i: F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, length)))
    rests = tiny.select("word", F.explode(F.array_distinct(F.concat(F.array("word"), left))).alias("rest"))
    short = rests.select(F.col("word").alias("a"), "rest").join(rests.select(F.col("word").alias("b"), "rest"), "rest").select("a", "b")
    is_near = F.expr("levenshtein(a, b, 1) = 1")
    close = F.abs(F.col("size_a") - F.col("size_b")) <= EDITS
    found = pivots.join(prefixes, "key").filter(close & (F.col("a") != F.col("b")) & is_near).select("a", "b")
    found = found.union(short.filter(is_near))
    both = found.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("p"))
    return both.select("p.word", "p.near").distinct()


def group_spellings(words: DataFrame, factor: int = 5) -> DataFrame:
    """`word`, `n`, `n_near`, `form`, `form_n`, `root` of distinct words with their counts in `word`, `n`.

    `form` is the near word of largest n (ties: the smallest in code-point order) if that is at least `factor`
    times the word's n, else null; `root` is the last word that forms lead to, or the word itself. `n_near` counts
    near words. An empty table gives no row; a word with a null count has no form and is none.

    Forms lead to ever larger counts, so there are no circles; each pass doubles the steps that are known.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2")
    words = stage(words.select("word", "n"))
    pairs = near_pairs(words)
    counted = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.when(F.col("near_n").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near")))).alias("top"),
    )
    told = words.join(best, "word", "left")
    has_form = -F.col("top.less") >= factor * F.col("n")
    told = stage(told.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("top.near")).alias("form"), F.when(has_form, -F.col("top.less")).alias("form_n"),
    ))
    steps = told.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("to"))
    while True:
        onward = steps.select(F.col("word").alias("to"), F.col("to").alias("further"))
        jumped = stage(steps.join(onward, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
        steps = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            break
    roots = steps.withColumnRenamed("to", "root")
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
