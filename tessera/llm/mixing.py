"""Mixing sources to target weights by hierarchical budgeting.

The sources form a tree (domain, language, source). A node's budget goes to its children by
their weights, none above what it can supply (its tokens times `epochs`). What a child can't
take goes to its siblings first; only what no sibling can take goes back to the parent, whose own
siblings take it in turn. Each leaf then takes documents in a seeded order, epoch by epoch, as
long as the running sum of tokens stays within the leaf's budget: a prefix, whole documents only.

The running sum is distributed: documents fall into `SLICES` slices of their leaf by the order
key, slice sums are accumulated (leaves x slices rows, whatever the corpus size), whole slices
below the cut are taken at once, and only the slice that holds the cut is ordered by rows. So a
leaf with a third of all rows is spread over all tasks. The tree stays distributed, too: its nodes
are dealt by their parent, level by level, and shares found by windows over siblings; the driver sees
the total of tokens only.

Defined results: null text has no tokens and costs nothing, so it is taken whenever its leaf's
budget is positive and its place comes before the cut; null and empty path values are the same leaf;
repeated rows each count; an empty table gives an empty one; leaves without a weight get
`default`; columns of any name pass through; equal order keys (repeated rows) are ordered by doc_id and text;
rows without doc_id have their place by their text, so that they fall into all slices, too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._tables import materialize, read

SLICES = 4096
#: Target weights of the tree's nodes, by path; siblings are normalised among themselves.
WEIGHTS = {("web",): 0.6, ("books",): 0.3, ("code",): 0.1, ("web", "en"): 0.5, ("web", "de"): 0.2, ("web", "fr"): 0.2, ("web", "es"): 0.1}
#: Share of the corpus' tokens that the mix takes, and passes over a source at most.
SHARE, EPOCHS, SEED = 0.5, 2, 17


def domain_of(source: Column) -> Column:
    """The query's domain rule: sources 0-9 are web, 10-15 books, the rest code."""
    n = F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d+)$", 1).try_cast("int")
    return F.when(n <= 9, "web").when(n <= 15, "books").otherwise("code")


def leaf_budgets(supply: DataFrame, names: Sequence[str], budget: float, weights: Mapping[tuple, float], epochs: int = 1, default: float = 1.0) -> DataFrame:
    """supply (the names and `tokens`) with `budget`: whole tokens for every leaf. Siblings share what
    their parent got up to a common level per weight, none above its subtree's capacity, so a shortage
    goes to the siblings that share the node's parent before any ancestor's siblings see it."""
    spark = supply.sparkSession
    above = supply.agg(F.least(F.lit(float(budget)), F.coalesce(F.sum("tokens"), F.lit(0)).cast("double") * epochs).alias("given"))
    for depth in range(1, len(names) + 1):
        parent, node = list(names[: depth - 1]), list(names[:depth])
        known = [(*path, float(w)) for path, w in weights.items() if len(path) == depth]
        children = supply.groupBy(*node).agg((F.sum("tokens").cast("double") * epochs).alias("capacity"))
        given = spark.createDataFrame(known, ", ".join(f"`{n}` string" for n in node) + ", weight double")
        children = children.join(given, node, "left").withColumn("weight", F.coalesce("weight", F.lit(float(default))))
        children = children.withColumn("takes", (F.col("weight") > 0) & (F.col("capacity") > 0))
        children = children.join(above, parent) if parent else children.crossJoin(above)  # above: one row at the root
        siblings = Window.partitionBy(*parent, "takes").orderBy(F.try_divide("capacity", "weight"), names[depth - 1])
        full = siblings.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        before = F.coalesce(F.sum("capacity").over(siblings.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        rest = F.sum("weight").over(siblings.rowsBetween(0, Window.unboundedFollowing))
        left = F.least("given", F.sum("capacity").over(full))
        children = children.withColumn("level", F.when(F.col("takes"), (left - before) / rest))
        short = F.col("capacity") <= F.col("level") * F.col("weight")
        level = F.first(F.when(~short, F.col("level")), True).over(full)
        share = F.when(~F.col("takes"), 0.0).when(short, F.col("capacity")).otherwise(F.col("weight") * level)
        above = children.select(*node, share.alias("given"))
    return supply.join(above, list(names)).select(*supply.columns, F.floor(F.col("given") + 1e-6).cast("long").alias("budget"))


def choose(docs: DataFrame, path: Mapping[str, Column], *, weights: Mapping[tuple, float], share: float, epochs: int = 1, seed: int = SEED, tokens: Column | None = None) -> DataFrame:
    """doc_id, body_key, the path's columns, n_tokens and epoch (from 0) of all that the mix takes.
    path: name -> column, root first. tokens: a row's size; its words where that isn't given."""
    names = list(path)
    count = tokens if tokens is not None else F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != ""))
    units = docs.select("doc_id", F.xxhash64("text").alias("body_key"), *[F.coalesce(c.cast("string"), F.lit("")).alias(a) for a, c in path.items()], count.cast("long").alias("n_tokens"))
    units = materialize(units.groupBy("doc_id", "body_key", *names).agg(F.sum("n_tokens").alias("n_tokens")), "mix-units")
    leaves = materialize(units.groupBy(*names).agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens")), "mix-leaves")
    whole = leaves.agg(F.sum("tokens")).first()[0] or 0
    goal = leaf_budgets(leaves, names, share * whole, weights, epochs).filter(F.col("budget") > 0)
    goal = goal.select(*names, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"), "tokens", "budget")
    left = F.col("budget") - F.col("epoch") * F.col("tokens")  # what the epochs before left
    goal = goal.filter(left > 0).withColumn("budget", F.least(left, F.col("tokens"))).drop("tokens")
    goal = materialize(goal, "mix-budgets")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.col("body_key").cast("string")))).cast("binary"))  # rows without doc_id are dealt by text
    placed = units.join(goal, names).withColumn("order_key", key)  # a row per leaf and epoch; its size decides how they meet
    placed = placed.withColumn("slice", F.conv(F.substring("order_key", 1, 3), 16, 10).cast("int"))  # three hex digits: SLICES
    group = [*names, "epoch"]
    before = F.coalesce(F.sum("total").over(Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = placed.groupBy(*group, "budget", "slice").agg(F.sum("n_tokens").alias("total")).withColumn("before", before)
    slices = slices.filter(F.col("before") <= F.col("budget")).withColumn("entire", F.col("before") + F.col("total") <= F.col("budget"))
    slices = materialize(slices.select(*group, "slice", "before", "entire"), "mix-slices")
    placed = placed.join(slices, [*group, "slice"])
    running = F.sum("n_tokens").over(Window.partitionBy(*group, "slice").orderBy("order_key", "doc_id", "body_key").rowsBetween(Window.unboundedPreceding, 0))
    cut = placed.filter(~F.col("entire")).withColumn("upto", F.col("before") + running).filter(F.col("upto") <= F.col("budget")).drop("upto")
    return placed.filter("entire").unionByName(cut).select("doc_id", "body_key", *names, "n_tokens", "epoch")


def mix_sources(docs: DataFrame, path: Mapping[str, Column], **how) -> DataFrame:
    """The rows of docs that the mix takes, each once per epoch, with `epoch` as last column."""
    names = [c for c in docs.columns if c != "epoch"]
    taken = choose(docs, path, **how).select(F.col("doc_id").alias("taken_id"), F.col("body_key").alias("taken_key"), "epoch")
    rows = docs.select(F.struct(*names).alias("row"))  # one name of ours, so that none of theirs clashes
    out = rows.join(taken, F.col("row.doc_id").eqNullSafe(F.col("taken_id")) & (F.xxhash64("row.text") == F.col("taken_key")))
    return out.select(*[F.col("row")[c].alias(c) for c in names], "epoch")


def source_path() -> dict[str, Column]:
    return {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    """Chosen documents and the epochs that take them: doc_id, epoch, domain, lang, source, n_tokens."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return choose(docs, source_path(), weights=WEIGHTS, share=SHARE, epochs=EPOCHS).select("doc_id", "epoch", "domain", "lang", "source", "n_tokens")
