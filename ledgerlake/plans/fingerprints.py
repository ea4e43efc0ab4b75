"""Do two tables hold the same keys?  Fingerprints of buckets of keys, and a look into the buckets that differ.

Every key falls into a bucket by its hash.  A bucket's fingerprint is the number of its distinct keys, the
exclusive or of their hashes and the sum of second hashes, so that one lost key and one foreign one show even
though the counts agree.  Only fingerprints are joined; keys are compared in the buckets that differ alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import blank_to_null

BUCKETS = 4096


def _text(key: str) -> Column:
    return blank_to_null(F.col(key).cast("string"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")


def key_fingerprints(rows: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """bucket, rows, keys (distinct), xored, summed; rows without a key (NULL or blank) are in a bucket of NULL.

    Repeats are added up inside tasks first, so a key with a third of all rows sends one row per task.
    """
    keys = rows.groupBy(_text(key).alias("key")).agg(F.count("*").alias("n"))
    known = F.col("key").isNotNull()
    return keys.groupBy(F.when(known, _bucket(buckets)).alias("bucket")).agg(
        F.sum("n").alias("rows"), F.count("key").alias("keys"),
        F.bit_xor(F.when(known, F.xxhash64("key"))).alias("xored"),
        F.sum(F.when(known, F.xxhash64("key", F.lit("second"))).cast("decimal(20,0)")).alias("summed"),
    )


def compared_fingerprints(left: DataFrame, right: DataFrame) -> DataFrame:
    """bucket, left_rows, left_keys, right_rows, right_keys, agree for every bucket of either side; NULL's agrees."""
    sides = [
        f.select("bucket", *[F.col(c).alias(f"{side}_{c}") for c in ("rows", "keys", "xored", "summed")])
        for f, side in ((left, "left"), (right, "right"))
    ]
    same = F.lit(True)
    for c in ("keys", "xored", "summed"):
        same = same & F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}"))
    a, b = sides
    both = a.join(b.withColumnRenamed("bucket", "other"), F.col("bucket").eqNullSafe(F.col("other")), "full")
    bucket = F.coalesce("bucket", "other")
    return both.select(
        bucket.alias("bucket"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("left_rows", "left_keys", "right_rows", "right_keys")],
        (same | bucket.isNull()).alias("agree"),
    )


def key_differences(left: DataFrame, left_key: str, right: DataFrame, right_key: str, buckets: int = BUCKETS) -> DataFrame:
    """The keys that one side lacks: key, in_left, in_right.

    Both sides are read twice, the second time for the keys of differing buckets alone, at most ``buckets``
    of which are broadcast.
    """
    compared = compared_fingerprints(key_fingerprints(left, left_key, buckets), key_fingerprints(right, right_key, buckets))
    differing = F.broadcast(compared.where("NOT agree").select("bucket"))
    sides = [
        rows.select(_text(key).alias("key"), F.lit(is_left).alias("is_left")).where("key IS NOT NULL")
        .withColumn("bucket", _bucket(buckets)).join(differing, "bucket", "left_semi")
        for rows, key, is_left in ((left, left_key, True), (right, right_key, False))
    ]
    found = sides[0].unionByName(sides[1]).groupBy("key").agg(
        F.bool_or("is_left").alias("in_left"), F.bool_or(~F.col("is_left")).alias("in_right")
    )
    return found.where("in_left <> in_right")
