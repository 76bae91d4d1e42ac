"""Mixing sources to target weights by hierarchical budgets.

Documents hang on a tree (domain, language, source). A token budget is spread
from the root: siblings share their parent's budget by integer weights, and a
node never gets more than its documents give in ``max_epochs`` passes. What a
node cannot take goes to its siblings by weight; only what none of them can
take stays with the parent's siblings (the parent's own capacity is the sum of
its children's). Shares are rounded down to whole tokens.

A leaf's budget is spent in epochs: whole passes first, then the *token
prefix* of one more pass, in the seeded order of that epoch (MD5 of seed, epoch
and id): documents are taken while the running sum stays within the budget.

The running sum needs no sort of a whole leaf. Levels, id and size are written
once, without the text. Tokens are added up per leaf and the next two hex digits
of the order key; a window over these 256 sums at most finds the digits where the
budget ends, and only the documents with these digits (one in 256) go to the next
step, until about ``ROWS_PER_PREFIX`` are left for a sort by the whole key. So no
task holds more of a leaf than that, however large it is. The result per leaf is
one cut-off key, so the selection itself is a filter; document texts are not
shuffled, and are read once more, for the result.

Defined cases: a null or missing level counts as ``unknown``; a node without a
weight has weight 1; nodes with weight 0 get nothing; rows that share an id
have one place in the order and are taken or left together; null ids order as
the text ``null``; null texts have 0 tokens; an empty table gives an empty
result. ``mix_epoch`` (and ``mix_tokens``) replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import quoted, unused_name
from wordmill.plans.physical import bounded_broadcast, materialize

SEED = 20240229
MAX_EPOCHS = 3
BYTES_PER_TOKEN = 4
# Hex digits of the order key by which a step narrows a leaf.
DIGITS_PER_STEP = 2
# Rows of one leaf that are left after the last step, about.
ROWS_PER_PREFIX = 256
UNKNOWN = "unknown"


def estimated_tokens(text: Column) -> Column:
    """A token estimate that needs no tokenizer: UTF-8 bytes / 4, rounded up."""
    size = F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("bigint")
    return F.floor((size + BYTES_PER_TOKEN - 1) / BYTES_PER_TOKEN).cast("bigint")


def domain_of(source: Column) -> Column:
    """The domain of a source ``<name><number>``: four domains by number."""
    number = F.try_to_number(F.regexp_extract(source, "([0-9]{1,9})$", 1), F.lit("999999999")).cast("bigint")
    return F.coalesce(F.concat(F.lit("domain"), (number % 4).cast("string")), F.lit(UNKNOWN))


def weight_of(name: Column, weights: Mapping[str, int]) -> Column:
    """The weight of a node by its name; 1 for names without one."""
    if not weights:
        return F.lit(1).cast("bigint")
    table = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
    return F.coalesce(F.try_element_at(table, name), F.lit(1)).cast("bigint")


def fill(joined: DataFrame, on: Sequence[str]) -> DataFrame:
    """Spread the parent's ``budget``, which is on every row, over the children
    ``on`` the same parent with ``cap`` and ``weight``.

    In order of ``cap / weight`` a child is filled up as long as its capacity
    is within its share of what is left; the others share the rest by weight.
    """
    order = Window.partitionBy(*(on or [F.lit(0)])).orderBy(F.col("cap") / F.col("weight"), "name")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    ranked = (
        joined.withColumn("rest_w", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero))
        .withColumn("rest_b", F.col("budget") - F.coalesce(F.sum("cap").over(before), zero))
        .withColumn("full", F.col("cap") * F.col("rest_w") <= F.col("weight") * F.col("rest_b"))
    )
    # All unfilled children share the budget and weight left at the first of them.
    left_w = F.max(F.when(~F.col("full"), F.col("rest_w"))).over(whole)
    left_b = F.max(F.when(~F.col("full"), F.col("rest_b"))).over(whole)
    share = F.when(F.col("full"), F.col("cap")).otherwise(F.expr("(weight * left_b) div left_w"))
    return ranked.withColumns({"left_w": left_w, "left_b": left_b}).withColumn("budget", share.cast("bigint"))


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], total_tokens: int, max_epochs: int
) -> DataFrame:
    """``*levels, tokens, budget`` from ``leaves(*levels, tokens)``."""
    sized = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    for level in levels:
        # A node of weight 0 takes part in nothing, whatever its leaves hold.
        sized = sized.filter(weight_of(F.col(level), weights.get(level, {})) > 0)
    capacity = sized.agg(F.sum("cap")).first()[0] or 0
    root, budget = min(int(total_tokens), capacity), None
    for depth, level in enumerate(levels):
        path = list(levels[: depth + 1])
        nodes = sized.groupBy(*path).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("weight", weight_of(F.col(level), weights.get(level, {}))).withColumn("name", F.col(level))
        nodes = nodes.join(budget, path[:-1]) if depth else nodes.withColumn("budget", F.lit(root).cast("bigint"))
        budget = fill(nodes, path[:-1]).select(*path, "budget")
    return leaves.join(budget, list(levels))


def running_tokens(rows: DataFrame, names: Sequence[str], part: Column, as_name: str) -> DataFrame:
    """Tokens of each leaf ``names`` by ``part`` of the order key, with the tokens
    ``before`` it and ``upto`` its end."""
    sums = rows.groupBy(*names, part.alias(as_name)).agg(
        F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("before").alias("start")
    )
    running = F.sum("size").over(Window.partitionBy(*names).orderBy(as_name)) + F.col("start")
    return sums.withColumn("upto", running).withColumn("before", F.col("upto") - F.col("size"))


def mix_sources(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, int]],
    total_tokens: int | None = None,
    share: float = 1.0,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """The selected rows of ``docs``, once per epoch that holds them, with
    ``mix_epoch`` and ``mix_tokens``.

    ``levels`` names the tree's levels from the root down; ``weights`` has the
    node weights of a level by name. The budget is ``total_tokens``, or
    ``share`` of all tokens.
    """
    names = [unused_name(docs, f"mix_level_{name}") for name in levels]
    level_weights = {n: weights.get(name, {}) for n, name in zip(names, levels)}
    size, place, key, epoch = (unused_name(docs, f"mix_{x}_") for x in ("size", "place", "key", "epoch"))
    n_tokens = tokens if tokens is not None else estimated_tokens(quoted(text_col))
    based = docs.withColumns(
        {n: F.coalesce(c.cast("string"), F.lit(UNKNOWN)) for n, c in zip(names, levels.values())}
        | {size: F.coalesce(n_tokens, F.lit(0)).cast("bigint"), place: F.coalesce(quoted(id_col).cast("string"), F.lit("null"))}
    )
    sizes = materialize(based.select(*names, size, place), "mix-sizes")
    leaves = sizes.groupBy(*names).agg(F.sum(size).alias("tokens"), F.count(F.lit(1)).alias("n"))
    leaves = materialize(leaves, "mix-leaves")
    totals = leaves.agg(F.sum("tokens"), F.max("n")).first()
    if total_tokens is None:
        total_tokens = int((totals[0] or 0) * share)
    plan = leaf_budgets(leaves, names, level_weights, total_tokens, max_epochs)
    plan = plan.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)))
    plan = plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    plan = materialize(plan.select(*names, "whole", "rest"), "mix-plan")

    order = F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("whole"), F.col(place)))
    keyed = sizes.join(bounded_broadcast(plan), names).select(*names, "rest", order.alias("key"), F.col(size).alias("size"))
    left = keyed.withColumn("before", F.lit(0).cast("bigint"))
    ends = plan.select(*names, F.lit("").alias("prefix"), F.lit(0).cast("bigint").alias("before"))
    digits = 0
    while 16**digits * ROWS_PER_PREFIX < (totals[1] or 0):
        digits += DIGITS_PER_STEP
        over = running_tokens(left, names, F.substring("key", 1, digits), "prefix").filter("upto > rest")
        over = over.groupBy(*names).agg(F.min(F.struct("prefix", "before")).alias("end"))
        ends = materialize(over.select(*names, "end.prefix", "end.before"), "mix-ends")
        left = left.drop("before").join(bounded_broadcast(ends), names).filter(F.col("key").startswith(F.col("prefix")))
        left = materialize(left.drop("prefix"), "mix-left")
    fitting = running_tokens(left, names, F.col("key"), "key").filter("upto <= rest")
    cuts = fitting.groupBy(*names).agg(F.max("key").alias("cut"))
    # Without a fitting document the bare prefix is the cut-off: it sorts
    # after all keys with smaller digits and before all keys that start with it.
    cuts = ends.join(cuts, names, "left").select(*names, F.coalesce("cut", "prefix").alias("cut"))
    chosen = materialize(plan.join(cuts, names, "left").select(*names, "whole", "cut"), "mix-cuts")

    joined = based.join(bounded_broadcast(chosen), names).withColumn(key, order)
    passes = F.when(F.col("whole") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    part = F.when(F.coalesce(F.col(key) <= F.col("cut"), F.lit(True)) & (F.col("whole") < max_epochs), F.array("whole"))
    epochs = F.concat(passes, F.coalesce(part, F.array().cast("array<bigint>")))
    taken = joined.withColumn(epoch, F.explode(epochs))
    out = taken.withColumns({"mix_epoch": F.col(epoch), "mix_tokens": F.col(size)})
    keep = [c for c in docs.columns if c.lower() not in ("mix_epoch", "mix_tokens")]
    return out.select(*(quoted(c) for c in keep), "mix_epoch", "mix_tokens")


# The tree and weights that the query and the pipeline use for ``documents``.
DOCUMENT_WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
}


def document_levels() -> dict[str, Column]:
    return {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
