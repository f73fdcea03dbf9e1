"""Documents linked by the Jaccard similarity of their word shingles, and the groups that links make.

Candidates come from prefix filters under several global orders of the shingles. Under each order two
linked sets must share a shingle among so few of the first that their sizes allow; a pair is verified only if
that holds under all orders. Shingles that many documents have come last in every order, so what two
documents share first is rare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstrata.llm.common import ODD, mix, pieces, powers, sorted_lookup
from crawlstrata.llm.exactdedup import filter_words, plane_of, probed
from crawlstrata.session import drop_folder, scratch, stage

# ASCII white space, and A-Z in lower case.
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.array([c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)], np.uint8)
# Seeds of the orders; the first makes the candidates, the others filter them.
ORDERS = (11, 22, 33)
# A task looks for frequent shingles among so many at once.
TALLY = 1 << 21
MAX_FILTER_BYTES = 32 << 20


def shingles(texts: list[str], size: int) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its `size`-word shingles; all words as one if there are fewer."""
    data = np.frombuffer("\n".join([*texts, ""]).encode("utf-8", "surrogatepass"), np.uint8)
    lengths = [len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts]
    white = WHITE[data]
    edges = np.flatnonzero(np.diff((~white).view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edges[0::2], edges[1::2]
    spread = mix(np.arange(1, 257, dtype=np.uint64))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(spread[LOWER[data]] * powers(len(data), ODD), out=total[1:])
    back = powers(len(data), pow(ODD, -1, 1 << 64))
    words = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    places = np.concatenate(([0], np.cumsum(lengths)))
    first = np.searchsorted(starts, places)
    runs = words.copy()
    for k in range(1, size):
        runs = mix(runs[: len(words) - k] * np.uint64(ODD) + words[k:]) if len(words) > k else runs[:0]
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            h = words[a : a + 1]
            for k in range(1, b - a):
                h = mix(h * np.uint64(ODD) + words[a + k])
            out.append(mix(h + np.uint64(b - a)))
        else:
            out.append(words[:0])
    return out


def prefix_size(n: int, percent: int) -> int:
    """So many first shingles of a set of n can be the first it shares with a linked one."""
    return n + (-percent * n) // 100 + 1


def frequent_shingles(docs: DataFrame, size: int, most: int) -> np.ndarray:
    """Pairs (hash, level), sorted by hash, of about the `most` most frequent shingles.

    Tasks send those that occur twice or more among the last TALLY; the level is the logarithm of their
    sum. It only orders the shingles, so what it misses costs candidates but never a link.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: list[np.ndarray]) -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            return pa.RecordBatch.from_pydict({"shingle": pa.array(keys[n > 1].view(np.int64)), "n": pa.array(n[n > 1])})

        held, total = [], 0
        for _, texts in pieces(batches, "_text"):
            for s in shingles(texts, size):
                held.append(s)
                total += len(s)
            if total >= TALLY:
                yield counted(held)
                held, total = [], 0
        yield counted(held)

    counts = docs.mapInArrow(tally, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).filter("n >= 16")
    folder = scratch(docs.sparkSession, "frequent")
    counts = stage(counts.withColumn("level", F.floor(F.log2("n")).cast("int")), folder)
    by_level = {r.level: r.n for r in counts.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    least = total = 0
    for level in sorted(by_level, reverse=True):
        total += by_level[level]
        if least and total > most:
            break
        least = level
    found = counts.filter(F.col("level") >= least).select("shingle", "level").limit(most).toPandas()
    drop_folder(docs.sparkSession, folder)
    keys, level = found["shingle"].to_numpy().view(np.uint64), found["level"].to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    return np.stack([keys[order], level[order]])


def ordered(s: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[list[np.ndarray], int]:
    """The prefix of a set under each order, and how many shingles are not frequent.

    The first makes the candidates and is whole; the others filter pairs and are 32-bit numbers.
    """
    at, there = sorted_lookup(frequent[0], s)
    level = np.where(there, frequent[1][at] if len(frequent[0]) else 0, 0).astype(np.uint64)
    n, out = prefix_size(len(s), percent), []
    for seed in ORDERS:
        key = (level << np.uint64(58)) | (mix(s ^ np.uint64(seed)) >> np.uint64(6))
        first = s[np.argsort(key)[:n]]
        out.append((first & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32) if out else first.view(np.int64))
    return out, int((level == 0).sum())


def prefixes(docs: DataFrame, size: int, percent: int, most: int) -> DataFrame:
    """`_id`, `n` (set size), `digest` of the set, `rare` shingles, and the prefix under each order."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs.select("_text"), size, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "_text"):
            sets = shingles(texts, size)
            made = [ordered(s, frequent.value, percent) for s in sets]
            columns = [
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([digest_of(s) for s in sets], pa.binary()),
                pa.array([rare for _, rare in made], pa.int32()),
                *(pa.array([p[k] for p, _ in made], pa.list_(pa.int32() if k else pa.int64())) for k in range(len(ORDERS))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["_id", "n", "digest", "rare", *(f"p{k}" for k in range(len(ORDERS)))]
    arrays = [F.array().cast("array<int>" if k else "array<bigint>").alias(c) for k, c in enumerate(names[4:])]
    schema = docs.select("_id", F.lit(0).cast("long").alias("n"), F.lit(b"").alias("digest"), F.lit(0).alias("rare"), *arrays).schema
    return docs.select("_id", "_text").mapInArrow(run, schema)


def _may_link(percent: int) -> Column:
    """Whether the shared shingle of the rows l and r lies where their sizes allow."""
    overlap = least_overlap(F.col("l.n"), F.col("r.n"), percent)
    return (
        (F.least("l.n", "r.n") * 100 >= F.greatest("l.n", "r.n") * percent)
        & (F.col("l.pos") <= F.col("l.n") - overlap)
        & (F.col("r.pos") <= F.col("r.n") - overlap)
    )


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """The smallest intersection of sets of the sizes a and b whose similarity reaches `percent`."""
    return F.ceil((a + b) * F.lit(percent) / F.lit(100 + percent) - F.lit(1e-9)).cast("int")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def filtered(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs `a`, `b` of digests whose prefixes share a shingle under the other orders too."""
    others = [f"p{k}" for k in range(1, len(ORDERS))]
    narrow = sets.select("digest", "n", *others)
    left, right = narrow.alias("l"), narrow.alias("r")
    joined = pairs.distinct().join(left, F.col("a") == F.col("l.digest")).join(right, F.col("b") == F.col("r.digest"))
    overlap = least_overlap(F.col("l.n"), F.col("r.n"), percent)
    for p in others:
        first = [F.slice(F.col(f"{s}.{p}"), F.lit(1), (F.col(f"{s}.n") - overlap + 1).cast("int")) for s in "lr"]
        joined = joined.filter(F.arrays_overlap(*first))
    return joined.select("a", "b")


def digest_of(s: np.ndarray) -> bytes:
    from hashlib import blake2b

    return blake2b(s.tobytes(), digest_size=16).digest()


def texts_of(digests: DataFrame, sets: DataFrame, docs: DataFrame, size: int, folder: str) -> DataFrame:
    """`digest`, `_text`: one text for each of the sets; rows of the same id with another set are left out.

    A Bloom filter of the wanted ids, of at most MAX_FILTER_BYTES, keeps other documents from being shuffled. One function
    probes it and takes the sets' digests, so that a task needs one Python worker however the join after it is done.
    """
    wanted = stage(digests.join(sets.select("digest", "rep"), "digest"), folder)
    key = lambda c: F.unhex(F.md5(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")))
    words = filter_words(wanted.count(), 12, MAX_FILTER_BYTES)
    plane = docs.sparkSession.sparkContext.broadcast(plane_of(wanted.select(key("rep").alias("key")), words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(probed(batches, "_key", words, plane.value), "_text"):
            made = pa.array([digest_of(s) for s in shingles(texts, size)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], made], ["_id", "_text", "_digest"])

    read = docs.select("_id", "_text", key("_id").alias("_key"))
    found = read.mapInArrow(run, read.withColumnRenamed("_key", "_digest").schema)
    found = found.join(wanted, F.col("_id").eqNullSafe(F.col("rep")) & (F.col("_digest") == F.col("digest")))
    return found.groupBy("digest").agg(F.first("_text").alias("_text"))


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, size: int, percent: int, folder: str) -> DataFrame:
    """The pairs `a`, `b` that are linked, with the whole sets taken again from the texts of both; staged in `folder`."""
    spark = docs.sparkSession
    held = scratch(spark, "texts")
    digests = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
    texts = stage(texts_of(digests, sets, docs, size, held), held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, left in pieces(batches, "left"):
            right = [t or "" for t in batch.column(batch.schema.get_field_index("right")).to_pylist()]
            keep = []
            for x, y in zip(shingles(left, size), shingles(right, size), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (
        pairs.join(texts.select(F.col("digest").alias("a"), F.col("_text").alias("left")), "a")
        .join(texts.select(F.col("digest").alias("b"), F.col("_text").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    links = stage(joined.mapInArrow(run, pairs.schema), folder)
    drop_folder(spark, held)
    return links


def components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """`node` and `label`, the smallest node reachable over `links` (`a`, `b`), of every node but the labels.

    Rounds of two steps: every node's larger neighbours are tied to its smallest neighbour, then its smaller
    ones are. Stars are what stays the same; the number of rounds grows with the logarithm of the size of
    components, and every row is a pair, so that no component gathers in a task. The result is staged in
    `folder`; what a round staged goes when the next one's edges are written.
    """
    spark, folder = links.sparkSession, folder or scratch(links.sparkSession, "components")
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before, rounds = stage(edges, f"{folder}/round-0"), None, 0
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before, held = state, f"{folder}/round-{rounds}"
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), held)
        tied = both.filter(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tied = stage(tied.filter("u <> v").distinct(), held)
        low = tied.groupBy("u").agg(F.min("v").alias("m"))
        near = tied.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        rounds += 1
        edges = stage(near.union(low).filter("u <> v").distinct(), f"{folder}/round-{rounds}")
        drop_folder(spark, held)


def link_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90, max_frequent: int = 1 << 18
) -> DataFrame:
    """One row per row of `docs`: `id`, `n_shingles`, `component_id`.

    A document's set are the hashes of its distinct shingles of `size` words, A-Z in lower case; with fewer words the
    whole sequence is one. Documents are linked when 100 * intersection >= `percent` * union;
    `component_id` is the smallest id reachable by links. Null and empty texts have empty sets, are linked
    with nothing and form their own component. Rows with equal sets are linked, so repeated rows share a
    component, and rows of one id with different texts are told apart by their sets; a null id counts as
    larger than any other. An empty table gives no rows; other columns are not read.

    Equal sets are first replaced by one. In the group of every shared prefix shingle all members are held
    against one leader, the set with the fewest rare shingles: pairs grow with the group, not with its
    square. What has not reached the leader's component by verified links is then held against every
    other member whose positions allow a link, so that no link between components is lost. A group is never collected:
    leaders are minima, summed up before the shuffle, and joins of written tables are left to be split.
    """
    return _linked(docs, id, text, size, percent, max_frequent, scratch(docs.sparkSession, "linked"))


def _linked(docs: DataFrame, id: str, text: str, size: int, percent: int, max_frequent: int, folder: str) -> DataFrame:
    """`link_documents`; what its result reads is staged in `folder`, and all else is dropped once it has served."""
    spark = docs.sparkSession
    held = {name: scratch(spark, name) for name in ("prefixes", "leaders", "shared", "tried", "placed", "rest", "first_labels", "sets", "labels")}
    read = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    made = stage(prefixes(read, size, percent, max_frequent), held["prefixes"])
    columns = ["n", "rare", *(f"p{k}" for k in range(len(ORDERS)))]
    sets = made.filter("n > 0").groupBy("digest").agg(F.min("_id").alias("rep"), *(F.first(c).alias(c) for c in columns))
    sets = stage(sets, held["sets"])
    of_row = stage(made.select("_id", "n", "digest"), folder)
    drop_folder(spark, held["prefixes"])
    postings = sets.select(F.col("digest").alias("node"), "n", "rare", F.posexplode("p0").alias("pos", "shingle"))
    leader = F.min(F.struct("rare", "node", "n", "pos")).alias("leader")
    leaders = postings.groupBy("shingle").agg(leader, F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows")
    leaders = stage(leaders, held["leaders"])
    shared = postings.drop("rare").join(leaders, "shingle").select("shingle", "node", "n", "pos", "leader")
    shared = stage(shared, held["shared"])
    drop_folder(spark, held["leaders"])

    star = shared.select(F.struct("node", "n", "pos").alias("l"), F.col("leader").alias("r"))
    star = star.filter(F.col("l.node") != F.col("r.node")).filter(_may_link(percent)).select(*_pair("l.node", "r.node"))
    tried = stage(filtered(star, sets, percent), held["tried"])
    links = verified(tried, sets, read, size, percent, held["labels"])
    labels = components(links, held["first_labels"])

    def labelled(rows: DataFrame, node: str, name: str, labels: DataFrame) -> DataFrame:
        named = labels.select(F.col("node").alias(f"_{name}"), F.col("label").alias(name))
        return rows.join(named, F.col(node) == F.col(f"_{name}"), "left").withColumn(name, F.coalesce(name, node)).drop(f"_{name}")

    placed = labelled(shared.withColumn("head", F.col("leader.node")), "node", "part", labels)
    placed = labelled(placed, "head", "head_part", labels).select("shingle", "node", "n", "pos", "part", "head_part")
    placed = stage(placed, held["placed"])
    for name in ("shared", "first_labels"):
        drop_folder(spark, held[name])
    apart = placed.filter(F.col("part") != F.col("head_part"))
    rest = (
        apart.alias("l").join(placed.alias("r"), "shingle").filter((F.col("l.part") != F.col("r.part")) & _may_link(percent))
        .select(*_pair("l.node", "r.node"))
    )
    rest = stage(filtered(rest, sets, percent).join(tried, ["a", "b"], "left_anti"), held["rest"])
    for name in ("placed", "tried"):
        drop_folder(spark, held[name])
    links = links.unionByName(verified(rest, sets, read, size, percent, held["labels"]))
    drop_folder(spark, held["rest"])
    labels = components(links, held["labels"])
    of_set = labelled(sets.select("digest", "rep"), "digest", "part", labels)
    smallest = stage(of_set.groupBy("part").agg(F.min("rep").alias("component_id")), held["labels"])
    of_set = stage(of_set.join(smallest, "part").select("digest", "component_id"), folder)
    for name in ("sets", "labels"):
        drop_folder(spark, held[name])
    grouped = of_row.filter("n > 0").join(of_set, "digest").select("_id", "n", "component_id")
    alone = of_row.filter("n = 0").select("_id", "n", F.col("_id").alias("component_id"))
    return grouped.unionByName(alone).select(F.col("_id").alias(id), F.col("n").alias("n_shingles"), "component_id")


def representatives(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90, max_frequent: int = 1 << 18) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their component: one document of each group.

    Repeated rows (same id and text) are one document. An id is taken to name one text; rows without words
    are linked with nothing and stay. Other columns are kept, whatever their names.
    """
    folder = scratch(docs.sparkSession, "linked")
    linked = _linked(docs, id, text, size, percent, max_frequent, folder)
    kept = stage(linked.filter(F.col(id).eqNullSafe(F.col("component_id"))).select(F.col(id).alias("_kept")).distinct())
    drop_folder(docs.sparkSession, folder)
    row = F.struct(F.col(id).alias("id"), F.xxhash64(text).alias("hash"))
    wide = docs.select(F.struct(*docs.columns).alias("row"), row.alias("key"))
    wide = wide.join(kept, F.col("key.id").eqNullSafe(F.col("_kept")), "left_semi").dropDuplicates(["key"])
    return wide.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
