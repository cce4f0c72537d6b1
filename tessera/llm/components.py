"""Connected components over an edge table, by label propagation with pointer jumping.

Each round every vertex takes the least label around it, then the label of its label. Labels are
written to the shared folder after each round, so the plan stays short and a lost executor costs a
round at most. Nothing but one count a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._tables import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); label: the least node of its component."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("low"))
        taken = labels.join(around, labels["node"] == around["a"]).select("node", F.least("label", "low").alias("next"), F.col("label").alias("before"))
        above = labels.select(F.col("node").alias("up"), F.col("label").alias("up_label"))
        jumped = taken.join(above, F.col("next") == F.col("up")).select("node", F.least("next", "up_label").alias("label"), "before")
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.filter(F.col("label") < F.col("before")).isEmpty():
            return labels
