"""Connected components of an edge table by label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (u, v); label is the smallest node reachable.

    Each round hooks every node's label to the smallest label next to it, then jumps to the
    label's own label. Star-shaped edges end in two or three rounds; nothing is collected."""
    pairs = edges.where("u <> v").distinct()
    both = written(pairs.union(pairs.select("v", "u").toDF("u", "v")).distinct())
    labels = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("label"))
    labels = written(labels)
    while True:
        near = both.join(labels.toDF("v", "near"), "v").groupBy("u").agg(F.min("near").alias("near"))
        hooked = labels.join(near, labels["node"] == near["u"], "left").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        # the label's own label, offered to it by each of its nodes, pulls whole trees together
        offers = hooked.where("label < old").groupBy(F.col("old").alias("root")).agg(F.min("label").alias("offer"))
        jumped = hooked.join(labels.toDF("label", "above"), "label", "left").join(offers, F.col("label") == F.col("root"), "left")
        new = written(jumped.select("node", F.least("label", "above", "offer").alias("label"), "old"))
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
