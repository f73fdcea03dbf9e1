"""Sources mixed to target weights: token weights raked to the marginals of several columns.

Iterative proportional fitting scales the tokens of every cell (source, language, topic) until each
column's shares are the targets. Documents are then sampled with the probability that this asks for.
All of it is DataFrame work: the cells are few by construction, and every round is a window over them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlstrata.session import stage

OTHER = "other"
#: So many cells at most go through the rounds in one task.
MAX_CELLS = 1_000_000
SCALE = 1 << 32


def words_in(text: Column) -> Column:
    """Number of runs of characters that are no ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def named(value: Column, targets: dict[str, float]) -> Column:
    """The value if it has a target, else OTHER; null is OTHER."""
    return F.when(value.isin(*[k for k in targets if k != OTHER]), value).otherwise(F.lit(OTHER))


def uniform(id_column: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of the MD5 of the id as text; 0 for a null id."""
    return F.coalesce(F.conv(F.substring(F.md5(id_column.cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / SCALE, F.lit(0.0))


def raked(cells: DataFrame, targets: dict[str, dict[str, float]], rounds: int) -> DataFrame:
    """`cells` (one column per name in `targets`, and `tokens`) with `weight`: tokens scaled to the targets.

    Targets count in proportion to one another, over the values that occur; the weights add up to 1.
    """
    dims = list(targets)
    everywhere = Window.partitionBy(F.lit(0))
    # One partition: the targets bound the number of cells, whatever the size of the documents.
    cells = cells.coalesce(1).withColumn("weight", F.col("tokens").cast("double"))
    for d in dims:
        goal = F.create_map(*[F.lit(x) for k, v in targets[d].items() for x in (k, float(v))])
        goal = F.coalesce(goal[F.col(d)], F.lit(0.0))
        first = F.row_number().over(Window.partitionBy(d).orderBy(*dims)) == 1
        cells = cells.withColumns({f"_goal_{d}": goal, f"_first_{d}": F.when(first, goal).otherwise(0.0)})
        cells = cells.withColumn(f"_goal_{d}", F.col(f"_goal_{d}") / F.sum(f"_first_{d}").over(everywhere)).drop(f"_first_{d}")
    for _ in range(rounds):
        for d in dims:
            total = F.sum("weight").over(Window.partitionBy(d))
            cells = cells.withColumn("weight", F.when(total > 0, F.col("weight") * F.col(f"_goal_{d}") / total).otherwise(0.0))
    return cells.withColumn("weight", F.col("weight") / F.sum("weight").over(everywhere)).select(*dims, "tokens", "weight")


def with_factor(cells: DataFrame, name: str, ask: Column, most: Column, room: Column, order: list[str]) -> DataFrame:
    """`cells` with `name`: the factor by which `ask` adds up to `room` where no row gets more than its `most`."""
    everywhere = Window.partitionBy(F.lit(0))
    tight = F.when(ask > 0, ask / most).otherwise(0.0)
    ahead = everywhere.orderBy(tight.desc(), *order).rowsBetween(Window.unboundedPreceding, -1)
    behind = everywhere.orderBy(tight, *[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Rows fill up in the order of `tight`; the factor rises until the first row that does not, and falls after it.
    left = F.sum(ask).over(behind)
    factor = F.when(left > 0, (room - F.coalesce(F.sum(most).over(ahead), F.lit(0.0))) / left)
    return cells.withColumn(name, factor).withColumn(name, F.coalesce(F.max(name).over(everywhere), F.lit(0.0)))


def raked_within(cells: DataFrame, targets: dict[str, dict[str, float]], rounds: int, budget: float) -> DataFrame:
    """Like `raked`, but the weights add up to `budget` times all tokens, and no cell gets more than its tokens.

    A value with fewer tokens than its target asks for gives all it has, and the others share the rest in
    proportion. Every round scales again what the limits have cut. What the rounds leave out of the budget
    is made up by one factor for all cells below their limits.
    """
    dims = list(targets)
    everywhere = Window.partitionBy(F.lit(0))
    cells = cells.coalesce(1).withColumns({"_most": F.col("tokens").cast("double"), "weight": F.col("tokens").cast("double")})
    cells = cells.withColumn("_room", F.lit(float(budget)) * F.sum("_most").over(everywhere))
    for d in dims:
        goal = F.create_map(*[F.lit(x) for k, v in targets[d].items() for x in (k, float(v))])
        goal = F.coalesce(goal[F.col(d)], F.lit(0.0))
        first = F.row_number().over(Window.partitionBy(d).orderBy(*dims)) == 1
        cells = cells.withColumns({"_held": F.sum("_most").over(Window.partitionBy(d)), "_first": first})
        ask, most = F.when(F.col("_first") & (F.col("_held") > 0), goal).otherwise(0.0), F.when(F.col("_first"), F.col("_held")).otherwise(0.0)
        cells = with_factor(cells.withColumns({"_ask": ask, "_top": most}), "_factor", F.col("_ask"), F.col("_top"), F.col("_room"), dims)
        cells = cells.withColumn(f"_goal_{d}", F.least(goal * F.col("_factor"), "_held"))
    for _ in range(rounds):
        for d in dims:
            total = F.sum("weight").over(Window.partitionBy(d))
            scaled = F.least(F.col("_most"), F.col("weight") * F.col(f"_goal_{d}") / total)
            cells = cells.withColumn("weight", F.when(total > 0, scaled).otherwise(0.0))
    cells = with_factor(cells, "_factor", F.col("weight"), F.col("_most"), F.col("_room"), dims)
    return cells.withColumn("weight", F.least(F.col("_most"), F.col("weight") * F.col("_factor"))).select(*dims, "tokens", "weight")


def _rated(
    docs: DataFrame, columns: dict[str, Column], targets: dict[str, dict[str, float]], id: str, text: str, rounds: int,
    budget: float | None = None,
) -> DataFrame:
    """`docs` with `_mix_0`, `_mix_1` ... (the values by which it is mixed), `_mix_tokens`, `_mix_p`, `_mix_kept`."""
    bound = reduce(lambda n, t: n * (len(t) + 1), targets.values(), 1)
    if bound > MAX_CELLS:
        raise ValueError(f"the targets make {bound} cells; at most {MAX_CELLS} are raked")
    if budget is not None and not 0 < budget <= 1:
        raise ValueError(f"the budget is a share of all tokens, not {budget}")
    dims = {f"_mix_{i}": d for i, d in enumerate(targets)}
    rows = docs.withColumns({k: named(columns[d], targets[d]) for k, d in dims.items()} | {"_mix_tokens": words_in(F.col(text))})
    cells = rows.groupBy(*dims).agg(F.sum("_mix_tokens").alias("tokens"))
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    highest = F.max("_ratio").over(Window.partitionBy(F.lit(0)))
    asked = {k: targets[d] for k, d in dims.items()}
    ratios = (raked(cells, asked, rounds) if budget is None else raked_within(cells, asked, rounds, budget)).withColumn("_ratio", ratio)
    p = F.when(highest > 0, F.col("_ratio") / highest).otherwise(0.0) if budget is None else F.col("_ratio")
    p = F.round(p, 9)
    ratios = stage(ratios.select(*dims, p.alias("_mix_p")))
    return rows.join(F.broadcast(ratios), list(dims)).withColumn("_mix_kept", uniform(F.col(id)) < F.col("_mix_p"))


def mix(
    docs: DataFrame, columns: dict[str, Column], targets: dict[str, dict[str, float]], id: str = "doc_id", text: str = "text",
    rounds: int = 10, budget: float | None = None,
) -> DataFrame:
    """One row per row of `docs`: `id`, the name of each target column, `tokens`, `probability`, `kept`.

    `columns` says how each name in `targets` is taken from a row. A value without a target, and null,
    belongs to OTHER; a column without a target for OTHER leaves its documents out (probability 0), as
    does a target of 0. Targets of values that do not occur are shared out among those that do. The
    probability of a cell is its raked weight by its tokens, in proportion to the largest such ratio: the
    cell most in demand is kept whole and the others are thinned. A rare cell in demand so thins all others;
    with a `budget`, a share of all tokens, the probabilities add up to it instead (`raked_within`): cells in
    demand are kept whole and the others make up the budget, so the shares come as close to the targets as the
    tokens there are allow, and fewer tokens are kept only where targets of 0 leave fewer. A document is kept when its uniform number
    from its id lies below, so repeated rows are kept or left together and a second run keeps the same. Null
    and empty texts have no tokens; a cell without tokens gets probability 0. An empty table gives no rows.
    Names that begin with `_mix_` are the operator's; others do not matter.

    Tokens are summed per cell in the tasks before the shuffle. There are at most as many cells as products
    of targets (checked to be at most MAX_CELLS), so a cell may hold any share of all rows, and the
    cells are joined back by broadcast. No document is shuffled.
    """
    rated = _rated(docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"), *(c.alias(f"_from_{d}") for d, c in columns.items())),
                   {d: F.col(f"_from_{d}") for d in columns}, targets, "_id", "_text", rounds, budget)
    names = [F.col(f"_mix_{i}").alias(d) for i, d in enumerate(targets)]
    return rated.select(
        F.col("_id").alias(id), *names, F.col("_mix_tokens").alias("tokens"), F.col("_mix_p").alias("probability"),
        F.col("_mix_kept").alias("kept"),
    )


def sample(
    docs: DataFrame, columns: dict[str, Column], targets: dict[str, dict[str, float]], id: str = "doc_id", text: str = "text",
    rounds: int = 10, budget: float | None = None,
) -> DataFrame:
    """The rows of `docs` that `mix` keeps, with their own columns."""
    return _rated(docs, columns, targets, id, text, rounds, budget).filter("_mix_kept").select(*docs.columns)
