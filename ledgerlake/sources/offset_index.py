"""Which messages a bronze table holds, as stretches of offsets beside the table.

The index ``<table>__offsets`` has a row for every unbroken stretch of offsets in every data file: file,
topic, partition, low, high, the time of the last message, the number of messages and a digest of their
identities.  It is derived from files, which never change: whatever file it lacks is indexed before the
index is used, so a crash between a write and its index row costs nothing but that scan.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import stored

INDEX_SUFFIX = "__offsets"
INDEX_PROPERTY = "ledgerlake.offsets_of"
STRETCH = 1_000_000  # offsets looked at together: bounds the rows of a window
# Blocks by which messages meet stretches.  A stretch goes by the smallest that is not shorter than itself, so one
# file has at most 33 stretches in a block, however broken its offsets are, and a stretch lies in few blocks.
SIZES = (1 << 5, 1 << 10, 1 << 15, 1 << 20)
# A message by its bronze columns and by those of the envelope.  The time belongs to it because a topic
# that was dropped and made anew counts its offsets from zero again.
IDENTITY = {"kafka_topic": "topic", "kafka_partition": "partition", "kafka_offset": "offset", "kafka_timestamp": "timestamp"}
INDEX_SCHEMA = (
    "file string, kafka_topic string, kafka_partition int, low bigint, high bigint, high_time timestamp, messages bigint, digest bigint"
)


def index_name(table: str) -> str:
    return f"{table}{INDEX_SUFFIX}"


def is_index(spark: SparkSession, name: str) -> bool:
    return not spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == INDEX_PROPERTY).isEmpty()


def islands(messages: DataFrame, *group: str) -> DataFrame:
    """Unbroken stretches of the offsets of messages (``IDENTITY`` columns), per topic, partition and ``group``.

    First within blocks of ``STRETCH`` offsets, so that no task holds a whole partition; then neighbouring
    stretches of a block's end and the next one's beginning become one.  Repeats of an offset lie in one
    stretch.  Messages without a partition or an offset have no place in it.
    """
    place = [*group, "kafka_topic", "kafka_partition"]
    known = messages.where("kafka_partition IS NOT NULL AND kafka_offset IS NOT NULL")
    block = F.floor(F.col("kafka_offset") / STRETCH)
    offsets = known.groupBy(*place, block.alias("_block"), "kafka_offset").agg(
        F.max("kafka_timestamp").alias("_time"), F.count("*").alias("_n"), F.bit_xor(F.xxhash64(*IDENTITY)).alias("_x"),
    )
    inside = Window.partitionBy(*place, "_block").orderBy("kafka_offset")
    first = offsets.withColumn("_run", F.col("kafka_offset") - F.row_number().over(inside)).groupBy(*place, "_block", "_run").agg(
        F.min("kafka_offset").alias("low"), F.max("kafka_offset").alias("high"), F.max_by("_time", "kafka_offset").alias("high_time"),
        F.sum("_n").alias("messages"), F.bit_xor("_x").alias("digest"),
    )
    return joined_up(first, *group)


def joined_up(stretches: DataFrame, *group: str) -> DataFrame:
    """Neighbouring stretches as one; overlapping ones (a topic made anew) stay as they are."""
    place = [*group, "kafka_topic", "kafka_partition"]
    order = Window.partitionBy(*place).orderBy("low", "high")
    begins = F.coalesce((F.col("low") != F.lag("high").over(order) + 1).cast("int"), F.lit(1))
    numbered = stretches.withColumn("_begins", begins).withColumn("_run", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*place, "_run").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max_by("high_time", "high").alias("high_time"),
        F.sum("messages").alias("messages"), F.bit_xor("digest").alias("digest"),
    ).drop("_run")


def refreshed_index(spark: SparkSession, table: str) -> DataFrame:
    """The index of a bronze table, after indexing the files that it lacks; rows of files that are gone are left out."""
    name = index_name(table)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(INDEX_SCHEMA.split(", "))
        fields = spark.table(table).schema
        if any(c not in fields.names for c in IDENTITY):
            raise ValueError(f"{table} holds no messages")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet TBLPROPERTIES ('{INDEX_PROPERTY}' = '{table}')")
    spark.catalog.refreshTable(table)
    spark.catalog.refreshTable(name)
    held = spark.table(table)
    paths = {p.rsplit("/", 1)[-1]: p for p in held.inputFiles()}  # names hold the id of the job that wrote them
    present = spark.createDataFrame([(f,) for f in paths], "file string")
    new = [r["file"] for r in present.join(spark.table(name).select("file").distinct(), "file", "left_anti").collect()]
    if new:
        rows = _rows_of(held, [paths[f] for f in new]).select(F.col("_metadata.file_name").alias("file"), *IDENTITY)
        whole = spark.createDataFrame([(f,) for f in new], "file string").join(islands(rows, "file"), "file", "left")
        # a file without messages has a row without a stretch
        whole.select(*[c.split(" ")[0] for c in INDEX_SCHEMA.split(", ")]).hint("rebalance").write.mode("append").insertInto(name)
        spark.catalog.refreshTable(name)
    return spark.table(name).join(present, "file", "left_semi")


def _rows_of(held: DataFrame, paths: list[str]) -> DataFrame:
    return held.sparkSession.read.schema(held.schema).parquet(*paths)


def held_stretches(index: DataFrame) -> DataFrame:
    """What the files hold together, repeats and all: stretches per topic and partition."""
    return joined_up(index.where("low IS NOT NULL").drop("file"))


def _spread(stretches: DataFrame, *columns: str) -> DataFrame:
    """A row for every block of its size (``SIZES``) that a stretch reaches into: a key to join by."""
    size = reduce(lambda larger, n: F.when(F.col("high") - F.col("low") < n, n).otherwise(larger), SIZES[-2::-1], F.lit(SIZES[-1]))
    blocks = F.sequence(F.floor(F.col("low") / F.col("_size")), F.floor(F.col("high") / F.col("_size")))
    return stretches.withColumn("_size", size).select(
        F.col("kafka_topic").alias("_topic"), F.col("kafka_partition").alias("_partition"), "_size", F.explode(blocks).alias("_block"),
        "low", "high", *columns
    )


def _sizes(spread: DataFrame) -> list[int]:
    """The sizes of blocks that occur, largest first."""
    return sorted((r["_size"] for r in spread.select("_size").distinct().collect()), reverse=True)


def _covers(size: Column) -> Column:
    """Whether a stretch that goes by blocks of a size holds a message."""
    offset = F.col("offset")
    return (
        (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition")) & (F.col("_size") == size)
        & (F.floor(offset / size) == F.col("_block")) & offset.between(F.col("low"), F.col("high"))
    )


def _not_among(envelopes: DataFrame, rows: DataFrame) -> DataFrame:
    known = rows.select(*[F.col(c).alias(f"_{c}") for c in IDENTITY])
    same = [F.col(theirs).eqNullSafe(F.col(f"_{ours}")) for ours, theirs in IDENTITY.items()]
    return envelopes.join(known, reduce(and_, same), "left_anti")


def unseen_by_index(envelopes: DataFrame, table: str) -> DataFrame:
    """The messages that a bronze table does not hold, found mostly without reading the table.

    An offset outside every stretch is new.  A stretch is known where the batch has exactly its messages,
    by number and digest.  Only messages under other stretches (half of one that was read again, or a topic
    made anew, whose messages have other times) are compared one by one, with the rows of those files alone;
    so are messages without a partition or an offset, with the rows that have none either.
    """
    spark = envelopes.sparkSession
    index = refreshed_index(spark, table)
    held, stretches = spark.table(table), index.where("low IS NOT NULL")
    placed = F.col("partition").isNotNull() & F.col("offset").isNotNull()
    spread = _spread(stretches, "file", "messages", "digest")
    asked = envelopes.select(*IDENTITY.values(), F.explode(F.array(*[F.lit(n) for n in _sizes(spread) or SIZES[-1:]])).alias("_asked"))
    met = asked.join(spread, _covers(F.col("_asked")), "left").groupBy(
        "file", F.col("_topic").alias("kafka_topic"), F.col("_partition").alias("kafka_partition"), "low"
    ).agg(
        F.max("high").alias("high"), F.count_if(~placed).alias("unplaced"),
        ((F.count("*") == F.max("messages")) & (F.bit_xor(F.xxhash64(*IDENTITY.values())) == F.max("digest"))).alias("whole"),
    )
    judged = stored(met, "stretches")
    fresh = envelopes.where(placed)
    known = _spread(judged.where("whole"))
    for size in _sizes(known):
        fresh = fresh.join(known.where(F.col("_size") == size), _covers(F.lit(size)), "left_anti")
    odd = {r["file"] for r in judged.where("NOT whole").select("file").distinct().collect()}  # names, of files listed here anyway
    if odd:
        fresh = _not_among(fresh, _rows_of(held, [p for p in held.inputFiles() if p.rsplit("/", 1)[-1] in odd]))
    if not judged.where("unplaced > 0").isEmpty():
        lost = held.where("kafka_partition IS NULL OR kafka_offset IS NULL")
        fresh = fresh.unionByName(_not_among(envelopes.where(~placed), lost))
    return fresh


def resume_points(index: DataFrame, topic: str, *, gaps_are_final: bool = False) -> DataFrame:
    """(kafka_partition, last, last_time) of the end of the first stretch that begins a partition.

    With ``gaps_are_final`` it is the end of the last one: right where each ingest took an unfiltered stretch
    of the topic, so that an offset passed over will never have a message (a compacted topic, say).
    """
    held = held_stretches(index.where(F.col("kafka_topic") == topic))
    end = F.struct("high", "high_time")
    chosen = F.max(end) if gaps_are_final else F.min_by(end, "low")
    return held.groupBy("kafka_partition").agg(chosen.alias("end")).select(
        "kafka_partition", F.col("end.high").alias("last"), F.col("end.high_time").alias("last_time")
    )
