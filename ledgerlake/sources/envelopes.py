"""Keyed messages with the columns of Spark's Kafka source, from Kafka or from files."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .offset_index import refreshed_index, resume_points

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

FROM_START, EARLIEST = "earliest", -2


def kafka_options(topic: str, options: Mapping[str, str] | None, skip_lost: bool) -> dict[str, str]:
    """Options of Spark's Kafka source: from the topic's start unless the caller says otherwise.

    ``skip_lost`` goes on where the broker has dropped messages that were not read; else that fails.
    """
    return {"startingOffsets": FROM_START, "failOnDataLoss": str(not skip_lost).lower(), **dict(options or {}), "subscribe": topic}


def _load(reader, topic: str, fmt: str, path: str | None, options: Mapping[str, str] | None, skip_lost: bool):
    if fmt == "kafka":
        return reader.format("kafka").options(**kafka_options(topic, options, skip_lost)).load()
    given = dict(options or {})
    start = given.pop("startingOffsets", FROM_START)
    files = reader.schema(ENVELOPE_SCHEMA).format(fmt).options(**given).load(path).filter(F.col("topic") == topic)
    return files if start == FROM_START else files.filter(_from_offsets(json.loads(start).get(topic, {})))


def _from_offsets(starts: Mapping[str, int]) -> Column:
    """Messages at or behind the offset of their partition; partitions not named are read whole, as for Kafka's ``earliest``."""
    late = [(F.col("partition") == int(p)) & (F.col("offset") < n) for p, n in starts.items() if n != EARLIEST]
    return ~F.coalesce(reduce(or_, late, F.lit(False)), F.lit(False))


def messages_at(spark: SparkSession, topic: str, offsets: Mapping[int, int], **reading) -> DataFrame:
    """The messages of a topic at one offset of each of some partitions; offsets that are gone give none.

    ``reading`` is what ``read_envelopes`` takes.
    """
    options = dict(reading.pop("options", None) or {})
    if not offsets:
        return spark.createDataFrame([], ENVELOPE_SCHEMA)
    if reading.get("fmt", "kafka") == "kafka":
        ends = {str(p): n + 1 for p, n in offsets.items()}
        options |= {"startingOffsets": json.dumps({topic: {str(p): n for p, n in offsets.items()}}), "endingOffsets": json.dumps({topic: ends})}
        return read_envelopes(spark, topic, **{**reading, "options": options, "skip_lost": True})
    exact = reduce(or_, [(F.col("partition") == p) & (F.col("offset") == n) for p, n in offsets.items()])
    return read_envelopes(spark, topic, **reading, options=options).filter(exact)


def read_envelopes(
    spark: SparkSession,
    topic: str,
    *,
    fmt: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    skip_lost: bool = False,
) -> DataFrame:
    """All messages of a topic.  ``fmt`` is ``kafka`` (needs the connector) or a file format."""
    return _load(spark.read, topic, fmt, path, options, skip_lost)


def stream_envelopes(
    spark: SparkSession,
    topic: str,
    *,
    per_batch: int,
    fmt: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    skip_lost: bool = False,
) -> DataFrame:
    """The same as an unbounded stream of at most ``per_batch`` messages (Kafka) or files a micro-batch.

    The bound only paces a backlog; nothing is left out.
    """
    pace = "maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"
    return _load(spark.readStream, topic, fmt, path, {pace: str(per_batch), **dict(options or {})}, skip_lost)


def starting_offsets(spark: SparkSession, table: str, topic: str, *, same_topic: bool = False) -> str:
    """The ``startingOffsets`` for a further ingest of a topic into a bronze table: the topic's start.

    The ingest sorts out what is known.  Held offsets say nothing about a topic that was dropped and made
    anew, and neither do times, which producers may set.  Only a caller who knows that the topic is still the
    one that the table was read from may say ``same_topic``, which goes on by ``resume_offsets``.
    """
    return resume_offsets(spark.table(table), topic) if same_topic and spark.catalog.tableExists(table) else FROM_START


def indexed_offsets(
    spark: SparkSession, table: str, topic: str, *, partitions: Iterable[int] = (), gaps_are_final: bool = False, **reading
) -> str:
    """The ``startingOffsets`` behind what a bronze table surely holds, by its index of offsets; safe for a topic made anew.

    Each partition goes on behind the end of its first unbroken stretch (of its last, ``gaps_are_final``) if the
    topic still has there the message that the table holds, told by its time; a partition where it is
    another or none is read from its earliest message, and the ingest sorts out what is known.
    ``partitions`` names further ones, new since the last ingest.  A row per partition reaches the driver.
    """
    if not spark.catalog.tableExists(table):
        return FROM_START
    points = resume_points(refreshed_index(spark, table), topic, gaps_are_final=gaps_are_final).collect()
    ends = {r["kafka_partition"]: (r["last"], r["last_time"]) for r in points}
    there = messages_at(spark, topic, {p: last for p, (last, _) in ends.items()}, **reading).select("partition", "timestamp").collect()
    times: dict[int, set] = {}
    for r in there:
        times.setdefault(r["partition"], set()).add(r["timestamp"])
    starts = {str(p): EARLIEST for p in partitions}
    starts |= {str(p): last + 1 if times.get(p) == {time} else EARLIEST for p, (last, time) in ends.items()}
    return json.dumps({topic: starts}) if starts else FROM_START


def resume_offsets(bronze: DataFrame, topic: str) -> str:
    """A ``startingOffsets`` value that leaves out what a bronze table surely holds, if the topic was not made anew.

    A partition without gaps goes on behind its last offset; one with gaps is read from its earliest
    message, and the ingest sorts out what is known.  One row per partition reaches the driver.
    """
    offset = F.col("kafka_offset")
    held = bronze.filter(F.col("kafka_topic") == topic).groupBy("kafka_partition").agg(
        F.min(offset).alias("low"), F.max(offset).alias("high"), F.count_distinct(offset).alias("n")
    )
    starts = {
        str(r["kafka_partition"]): r["high"] + 1 if r["n"] == r["high"] - r["low"] + 1 else EARLIEST for r in held.collect()
    }
    return json.dumps({topic: starts}) if starts else FROM_START
