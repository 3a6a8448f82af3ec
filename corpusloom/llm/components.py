"""Connected components of an edge table, by minimum labels and pointer jumping.

Every round is a pair of joins and partial aggregations, written to the shared folder; a node with
very many edges is only a key that sums up map-side and that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): comp is the smallest node of its component.

    Direction, repeats and loops do not matter. Rounds go on until no label changes; with pointer
    jumping their number grows with the logarithm of the longest chain in usual graphs.
    """
    both = edges.select("a", "b").filter("a <> b")
    both = materialize(both.union(both.select("b", "a")).distinct(), "edges")
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_n")).select("node", F.least("node", "_n").alias("comp")),
        "labels",
    )
    while True:
        heard = (
            both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("_n"))
        )
        # What a node hears is told to the node that it pointed at too, so that whole trees move at once.
        told = (
            labels.join(heard, "node").filter(F.col("_n") < F.col("comp"))
            .select(F.explode(F.array("node", "comp")).alias("node"), "_n").groupBy("node").agg(F.min("_n").alias("_n"))
        )
        hooked = labels.join(told, "node", "left").select(
            "node", F.least("comp", "_n").alias("comp"), (F.col("_n") < F.col("comp")).alias("_moved"),
        )
        hooked = materialize(hooked, "hooked")
        if not hooked.filter("_moved").take(1):
            return hooked.select("node", "comp")
        up = hooked.select(F.col("node").alias("comp"), F.col("comp").alias("_up"))
        labels = materialize(
            hooked.join(up, "comp", "left").select("node", F.least("comp", "_up").alias("comp")), "labels",
        )
