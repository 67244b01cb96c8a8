"""Connected components of an edge table, every node labelled with its smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import few_files
from farelens.session import ensure_checkpoint_dir


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; ``component`` is the smallest node reachable.

    Each round takes the smallest label around every node and then follows
    the label's own label (a shortcut that halves chains), until nothing
    changes.  Rounds are cut with reliable checkpoints.  A node with very
    many edges is one row on the label side and is aggregated before the
    shuffle on the edge side, so no group is collected.  ``edges`` is a stored
    table: its rows are counted first, since a round over few of them writes
    few files.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    rows = 2 * edges.count()
    one = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    both = few_files(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), rows).checkpoint()
    labels = few_files(both.groupBy("u").agg(F.min("v").alias("v")).select(
        F.col("u").alias("node"), F.least("u", "v").alias("label")), rows).checkpoint()
    while True:
        around = (both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("around")))
        nearer = labels.join(around, labels["node"] == around["u"]).select(
            "node", F.col("label").alias("old"), F.least("label", "around").alias("label"))
        target = nearer.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
        moved = few_files(nearer.join(target, nearer["label"] == target["_node"]).select(
            "node", F.col("_label").alias("label"), (F.col("_label") != F.col("old")).alias("changed")), rows).checkpoint()
        labels = moved.select("node", "label")
        if not moved.filter("changed").limit(1).count():
            return labels.select("node", F.col("label").alias("component"))
