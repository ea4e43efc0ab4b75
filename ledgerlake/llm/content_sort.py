"""Exact deduplication by sorting the contents.

Rows are range-partitioned by (first 64 characters, hash, row id): sampled splitters are short, and a
text with very many copies is cut over several ranges.  Within a range the sort, which spills to
disk, also compares the texts themselves, so equals are adjacent; one pass compares each text with
the one before.  Runs that touch the edge of a range are put together by their text, two rows per
range at most.

Defined results: a null text equals the empty text; repeated rows with one id count each; of equal ids
any may be called the keeper, as they have the same id; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .storage import written

PREFIX = 64


def content_classes(docs: DataFrame, keep: str = "min", normalise=None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` is "min" or "max": which doc_id of equal texts stays.  ``normalise`` maps the text column
    to what is compared; without it texts are equal when identical.
    """
    largest = keep == "max"
    text: Column = F.coalesce(F.col("text"), F.lit(""))
    if normalise is not None:
        text = F.coalesce(normalise(text), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("body")).select(
        "doc_id", "body", F.substring("body", 1, PREFIX).alias("head"), F.xxhash64("body").alias("code")
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(partitions, "head", "code", "doc_id").sortWithinPartitions("head", "code", "body", "doc_id")
    runs = written(
        ordered.select("doc_id", "body", F.sha2("body", 256).alias("sha"), F.spark_partition_id().alias("part")).mapInArrow(
            lambda batches: _runs(batches, largest),
            "doc_id long, sha string, keep long, n long, part int, edge int, body string",
        ),
        "content-sort",
    )
    choose = F.max if largest else F.min
    # two edge runs per range at most; without their texts this is 40 bytes per range
    edges = runs.where("body is not null").select("part", "edge", "body", "keep", "n")
    whole = edges.groupBy("body").agg(choose("keep").alias("keep_all"), F.sum("n").alias("n_all"))
    known = edges.join(whole, "body").select("part", "edge", "keep_all", "n_all")
    return (
        runs.drop("body").join(F.broadcast(known), ["part", "edge"], "left")
        .select(
            "doc_id", F.coalesce("keep_all", "keep").alias("keep_id"), F.coalesce("n_all", "n").alias("group_size"),
            F.col("doc_id").eqNullSafe(F.coalesce("keep_all", "keep")).alias("kept"), F.col("sha").alias("text_sha256"),
        )
    )


def _runs(batches, largest: bool):
    """Compares neighbours of one sorted range; ``edge`` numbers the first (0) and last (1) run, others have none."""
    none = np.iinfo(np.int64).min if largest else np.iinfo(np.int64).max  # stands for a null id
    choose = np.maximum if largest else np.minimum
    ids, shas, body, part, first = np.empty(0, np.int64), pa.array([], pa.string()), None, 0, True  # the open run

    def out(ids, shas, sizes, edge, body):
        """Rows of whole runs; the edge's text is carried by its first row."""
        at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        best = np.repeat(choose.reduceat(ids, at), sizes)
        edges = np.full(len(ids), -1)
        edges[: sizes[0]] = edge
        texts = pa.concat_arrays([pa.array([body if edge >= 0 else None], pa.string()), pa.nulls(len(ids) - 1, pa.string())])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=ids == none), shas, pa.array(best, mask=best == none), pa.array(np.repeat(sizes, sizes)),
             pa.array(np.full(len(ids), part, np.int32)), pa.array(edges.astype(np.int32), mask=edges < 0), texts],
            ["doc_id", "sha", "keep", "n", "part", "edge", "body"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        bodies, part = batch.column(1), batch.column(3)[0].as_py()
        differs = np.concatenate([
            [bool(len(ids)) and bodies[0].as_py() != body],
            pc.not_equal(bodies[1:], bodies[:-1]).to_numpy(zero_copy_only=False),
        ])
        begins = np.flatnonzero(differs) + len(ids)
        ids = np.concatenate([ids, pc.fill_null(batch.column(0), none).to_numpy()])
        shas = pa.concat_arrays([shas, batch.column(2)])
        body = bodies[0].as_py() if body is None else body
        if len(begins):
            sizes = np.diff(np.concatenate([[0], begins]))
            yield out(ids[: begins[-1]], shas[: begins[-1]], sizes, 0 if first else -1, body)
            first = False
            ids, shas, body = ids[begins[-1] :], shas[begins[-1] :], bodies[len(bodies) - (len(ids) - begins[-1])].as_py()
    if len(ids):
        yield out(ids, shas, np.array([len(ids)]), 0 if first else 1, body)
