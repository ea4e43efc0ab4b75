"""Connected components of a distributed edge list by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .storage import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (u, v): equal labels within a component.

    Each round maps every node to its least neighbour (or itself), and the edges to the mapped nodes;
    loops and repeats vanish.  All tables stay distributed and are written, so a lost executor costs
    no more than its own tasks.  A star needs one round, a chain about the logarithm of its length.
    """
    left = written(edges.select("u", "v").where("u != v").distinct(), "edges")
    labels = left.select(F.col("u").alias("node")).union(left.select("v")).distinct().withColumn("label", F.col("node"))
    most = 2 * left.count()  # nodes; edges only become fewer
    while not left.isEmpty():
        both = left.union(left.select("v", "u"))
        parents = written(
            both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")).withColumnRenamed("u", "k"), "parents", most
        )
        labels = written(
            labels.join(parents, labels.label == parents.k, "left").select("node", F.coalesce("p", "label").alias("label")), "labels", most
        )
        as_u, as_v = parents.select(F.col("k").alias("u"), F.col("p").alias("pu")), parents.select(F.col("k").alias("v"), F.col("p").alias("pv"))
        left = written(
            left.join(as_u, "u").join(as_v, "v").select(F.col("pu").alias("u"), F.col("pv").alias("v")).where("u != v").distinct(),
            "edges", most,
        )
    return labels
