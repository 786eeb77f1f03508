"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations.

A budget of tokens flows down a tree such as domain, language, source.  Each node's share
follows its weight among its siblings; what a node cannot hold goes to its siblings by weight
until they are full too, and since a parent never gets more than its leaves can hold, only then
to nodes above.  Shares are whole tokens: integer arithmetic with the largest remainders, so
they add up exactly.  A leaf may be read ``max_epochs`` times; each epoch has its own seeded
order, and the leaf's share is a prefix of the tokens of its epochs, the last row cut short.

Defined results: a null level value is a node of its own; rows without tokens are never
chosen; a node of weight 0 gets nothing; a budget above all capacity takes everything; rows
that tie in every column are interchangeable; no rows give no rows.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.llm.columns import _quoted
from obsengine.session import fresh_folder

_BIG = "decimal(38,0)"

#: Hex digits of a row's order that name its slice; an epoch's order is added up per slice.
SLICE_DIGITS = 3


def word_count(text: Column) -> Column:
    """Runs of characters that are no ASCII white space; a null text has none."""
    pattern = F.lit("[^ \\t\\n\\r\\f\\x0B]+")
    return F.coalesce(F.regexp_count(text, pattern), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    given = weights.get(level, {})
    value = F.lit(1)
    for name, weight in given.items():
        value = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(value)
    return value.cast(_BIG)


def _shares(nodes: DataFrame, parents: Sequence[str], child: str) -> DataFrame:
    """Divide ``budget`` (equal for siblings, not above their ``capacity``) among siblings."""
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    # Nodes that fill up first come first: capacity / weight, compared without division.
    by_need = family.orderBy((F.col("capacity") / F.col("weight")), F.col(child).asc_nulls_first())
    before = F.coalesce(
        F.sum("capacity").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    onward = F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.where("weight > 0").withColumns({"before": before, "onward": onward})
    full = F.col("capacity") * F.col("onward") <= (F.col("budget") - F.col("before")) * F.col(
        "weight"
    )
    nodes = nodes.withColumn("full", full)
    spare = F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(
        family
    )
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(family)
    nodes = nodes.withColumns({"spare": spare.cast(_BIG), "open": open_weight.cast(_BIG)})
    part = F.expr(f"cast(if(full, capacity, (spare * weight) div open) as {_BIG})")
    rest = F.expr(f"cast(if(full, -1, (spare * weight) % open) as {_BIG})")
    nodes = nodes.withColumns({"part": part, "rest": rest})
    by_rest = family.orderBy(F.desc("rest"), F.col(child).asc_nulls_first())
    left = F.col("budget") - F.sum("part").over(family)
    nodes = nodes.withColumns({"left": left, "turn": F.row_number().over(by_rest)})
    share = F.col("part") + F.when(~F.col("full") & (F.col("turn") <= F.col("left")), 1).otherwise(0)
    return nodes.select(*parents, child, share.cast(_BIG).alias("budget"))


def _plain(
    levels: Sequence[str], weights: Mapping[str, Mapping[str, int]]
) -> tuple[list[str], dict[str, Mapping[str, int]]]:
    """Names of the levels that no column made here can meet, and the weights by them."""
    names = [f"l{i}" for i in range(len(levels))]
    return names, {n: weights[level] for n, level in zip(names, levels) if level in weights}


def _distinct(names: Sequence[str]) -> None:
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns {twice} of the result would have the same name; rename them")


def leaf_budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, int]],
    budget: int,
    max_epochs: int,
) -> DataFrame:
    """``levels``, ``available`` and ``budget`` of every leaf; ``leaves`` has ``available``.

    ``weights`` gives whole numbers by level and value; values not named weigh 1.
    """
    out = [*levels, "available", "budget"]
    _distinct(out)
    names, by_name = _plain(levels, weights)
    plain = leaves.select(*(F.col(_quoted(c)).alias(n) for c, n in zip(levels, names)), "available")
    return _leaf_budgets(plain, names, by_name, budget, max_epochs).toDF(*out)


def _leaf_budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, int]],
    budget: int,
    max_epochs: int,
) -> DataFrame:
    leaves = leaves.withColumn("capacity", (F.col("available") * max_epochs).cast(_BIG))
    for level in levels:
        leaves = leaves.withColumn(f"__{level}", _weight(level, weights))
    leaves = leaves.where(" and ".join(f"`__{level}` > 0" for level in levels))
    total = leaves.agg(F.sum("capacity")).first()[0] or 0
    given = None
    parents: list[str] = []
    for level in levels:
        nodes = leaves.groupBy(*parents, level).agg(
            F.sum("capacity").cast(_BIG).alias("capacity"), F.first(f"__{level}").alias("weight")
        )
        if given is None:
            nodes = nodes.withColumn("budget", F.lit(min(int(budget), int(total))).cast(_BIG))
        else:
            nodes = _join(nodes, given, parents)
        given = _shares(nodes, parents, level)
        parents.append(level)
    return _join(leaves.select(*levels, "available"), given, parents)


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join with the ``budget`` of ``right``, in which null keys match."""
    right = right.select(*(F.col(k).alias(f"__r_{k}") for k in keys), "budget")
    on = [left[k].eqNullSafe(right[f"__r_{k}"]) for k in keys]
    return left.join(right, on).drop(*(f"__r_{k}" for k in keys))


def mix(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, int]],
    share: float,
    max_epochs: int = 1,
    seed: int = 1,
    key: str = "doc_id",
    tokens: str = "n_tokens",
) -> DataFrame:
    """``key``, ``levels``, ``tokens``, ``epoch`` and ``taken`` of every chosen row.

    The budget is ``share`` of all tokens.  ``taken`` is the length of the row's token prefix:
    all of it but for the last row of a leaf.  Rows of a leaf are ordered by a hash of seed,
    epoch and key; a leaf's running total is built from totals of slices of that order, so a
    large leaf is many tasks.  Levels and the key may have any names that the result can show.
    """
    out = [key, *levels, tokens, "epoch", "taken"]
    _distinct(out)
    names, by_name = _plain(levels, weights)
    plain = docs.select(
        F.col(_quoted(key)).alias("k"),
        *(F.col(_quoted(c)).alias(n) for c, n in zip(levels, names)),
        F.col(_quoted(tokens)).alias("n"),
    )
    return _mix(plain, names, by_name, share, max_epochs, seed, "k", "n").toDF(*out)


def _mix(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, int]],
    share: float,
    max_epochs: int,
    seed: int,
    key: str,
    tokens: str,
) -> DataFrame:
    spark = docs.sparkSession
    folder = fresh_folder(spark, "mixing")
    docs.where(F.col(tokens) > 0).select(key, *levels, F.col(tokens).cast("long")).write.parquet(
        f"{folder}/rows"
    )
    rows = spark.read.parquet(f"{folder}/rows")
    leaves = rows.groupBy(*levels).agg(F.sum(tokens).alias("available"))
    leaves.write.parquet(f"{folder}/leaves")
    leaves = spark.read.parquet(f"{folder}/leaves")
    total = leaves.agg(F.sum("available")).first()[0] or 0
    budgets = _leaf_budgets(leaves, levels, weights, int(total * share), max_epochs)
    budgets = budgets.select(
        *levels,
        F.expr("budget div available").alias("__epochs"),
        F.expr("cast(budget % available as bigint)").alias("__rest"),
    )
    right = budgets.select(
        *(F.col(k).alias(f"__r_{k}") for k in levels), "__epochs", "__rest"
    )
    on = [rows[k].eqNullSafe(right[f"__r_{k}"]) for k in levels]
    placed = rows.join(right, on).drop(*(f"__r_{k}" for k in levels))
    names = [key, *levels, tokens]
    whole = placed.where("__epochs > 0").select(
        *names,
        F.explode(F.sequence(F.lit(0), F.col("__epochs").cast("int") - 1)).alias("epoch"),
        F.col(tokens).alias("taken"),
    )
    code = F.md5(
        F.concat_ws(
            ":",
            F.lit(str(seed)),
            F.col("__epochs").cast("string"),
            F.coalesce(F.col(key).cast("string"), F.lit("")),
        )
    )
    last = placed.where("__rest > 0").withColumn("__code", code)
    last = last.withColumn("__slice", F.substring("__code", 1, SLICE_DIGITS))
    ahead = Window.partitionBy(*levels).orderBy("__slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    slices = (
        last.groupBy(*levels, "__slice")
        .agg(F.sum(tokens).alias("__n"), F.first("__rest").alias("__rest"))
        .withColumn("__ahead", F.coalesce(F.sum("__n").over(ahead), F.lit(0)))
        .where("__ahead < __rest")
        .select(*(F.col(k).alias(f"__r_{k}") for k in levels), F.col("__slice").alias("__s"), "__ahead")
    )
    on = [last[k].eqNullSafe(slices[f"__r_{k}"]) for k in levels]
    reached = last.join(slices, [*on, last["__slice"] == slices["__s"]])
    inside = (
        Window.partitionBy(*levels, "__slice")
        .orderBy("__code", key, tokens)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("__ahead") + F.coalesce(F.sum(tokens).over(inside), F.lit(0))
    partial = (
        reached.withColumn("__start", start)
        .where("__start < __rest")
        .select(
            *names,
            F.col("__epochs").cast("int").alias("epoch"),
            F.least(F.col(tokens), F.col("__rest") - F.col("__start")).alias("taken"),
        )
    )
    return whole.union(partial)
