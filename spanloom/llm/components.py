"""Connected components of a graph given as edges, by spreading least labels and jumping along them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_for, written

#: Rows of one file of the tables between rounds.
TABLE_ROWS = 200_000


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges (a, b)``: the least node it reaches.

    A round takes the least label among neighbours and then the label's own label, so the number of rounds grows
    with the logarithm of the longest path. Minima are combined before the shuffle; a node with very many edges is a
    skewed join key, which adaptive execution splits. Every round is written.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    parts = parts_for(both.count(), TABLE_ROWS)  # no table has more rows; few files for few rows
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")).coalesce(parts))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("least"))
        spread = labels.join(near, labels["node"] == near["a"], "left").select("node", "root", F.least("root", "least").alias("next"))
        spread = written(spread.coalesce(parts))
        up = spread.select(F.col("node").alias("at"), F.col("next").alias("further"))
        jumped = written(spread.join(up, spread["next"] == up["at"], "left").select("node", F.least("next", "further").alias("root"), F.col("root").alias("before")).coalesce(parts))
        labels = jumped.select("node", "root")
        if jumped.filter(F.col("root") != F.col("before")).isEmpty():
            return labels
