"""Hard negatives: for an anchor and each of its positives, near rows of other labels, but not too near.

Components are scaled and floored to whole numbers, so inner products are exact.  An anchor's positives are
its nearest rows of the same label.  A negative's product with the anchor lies between a low and a high share
of the positive's.  Both searches go through ``VectorTree``; a pair's window is one annulus search.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part;
vectors of unlike length are compared as if the shorter had zeros at its end; of rows with one id the
least by (label, vector) counts; a positive with a product of zero or less has negatives only at equal
shares of it (none below zero); ties go to the smaller id; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import written
from .vector_tree import NO_HIGH, NO_LOW, VectorTree

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90  # LOW and HIGH in per cent


def usable(rows: DataFrame, id_: Column, label: Column, vector: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector of whole numbers) of the rows that take part, one for each id."""
    vector = vector.cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    floored = F.transform(vector, lambda x: F.floor(x * scale).cast("double"))
    kept = rows.select(id_.cast("long").alias("vec_id"), label.cast("long").alias("label"), floored.alias("vector"), bad.alias("bad"))
    kept = kept.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT bad")
    return kept.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("one")).select("vec_id", "one.label", "one.vector")


def _share(score: Column, per_cent: int, up: int) -> Column:
    """The whole number at or below (``up`` = 0), or at or above (99), a share of a score that is not negative."""
    total = score.cast("decimal(20,0)") * per_cent + up
    return ((total - total % 100) / 100).cast("long")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, *, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows (vec_id, label, vector)."""
    rows = written(rows, "vectors")
    tree = VectorTree(rows)
    anchors = rows.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "vector")
    window = lambda slot, a, b: F.struct(slot.cast("int").alias("slot"), a.cast("long").alias("low"), b.cast("long").alias("high"))
    whole = F.array(window(F.lit(0), F.lit(NO_LOW), F.lit(NO_HIGH)))
    near = written(tree.search(anchors.withColumn("windows", whole), positives, True), "positives")
    # a window for each product: positives with the same one share it
    scores = near.where("score >= 0").groupBy("anchor_id").agg(F.array_sort(F.collect_set("score")).alias("scores"))
    windows = F.transform("scores", lambda s, i: window(i, _share(s, low, 99), _share(s, high, 0)))
    far = tree.search(anchors.join(scores, "anchor_id").withColumn("windows", windows).drop("scores"), negatives, False)
    slots = near.where("score >= 0").join(scores, "anchor_id").select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        (F.array_position("scores", F.col("score")) - 1).cast("int").alias("slot"),
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    pairs = slots.join(far.select("anchor_id", "slot", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")), ["anchor_id", "slot"])
    return pairs.select(
        "anchor_id", "positive_id", F.row_number().over(order).alias("rank"), "negative_id", "positive_score", "negative_score"
    )
