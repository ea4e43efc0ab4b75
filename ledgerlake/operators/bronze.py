"""Messages and extracts to bronze tables: raw strings plus where each row came from."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import is_blank
from ..session import stored
from ..sinks.publish import append
from ..sources.csv_files import read_extract
from ..sources.offset_index import IDENTITY, unseen_by_index
from ..specs import EntitySpec

MESSAGE_ID = IDENTITY


def parse_envelopes(envelopes: DataFrame, spec: EntitySpec, source: str = "kafka") -> DataFrame:
    """Expand each message's JSON into the entity's string columns; same for batch and stream.

    Missing fields are NULL, unknown ones are dropped, and a malformed message stays as a row whose
    data columns are all NULL.  Fields leave the parser through a generator, so that the optimizer meets
    columns and never the parsing itself in what is built on them.
    """
    return envelopes.select(
        F.inline(F.array(F.from_json(F.col("value").cast("string"), spec.raw_schema))),
        F.col("key").cast("string").alias("kafka_key"),
        *[F.col(theirs).alias(ours) for ours, theirs in MESSAGE_ID.items()],
    ).withColumns({"_ingestion_ts": F.current_timestamp(), "_source": F.lit(source)})


def split_messages(envelopes: DataFrame, spec: EntitySpec, source: str = "kafka") -> tuple[DataFrame, DataFrame]:
    """(good, rejected) of the same messages: rows as of ``parse_envelopes``, and what would be rows without a field.

    Rejected are messages without text (``no value``), with text that is no JSON of the entity's shape
    (``malformed``), and JSON that has none of the entity's fields (``no known field``).  They keep the
    value as it came, their key and their place.
    """
    schema = T.StructType([*spec.raw_schema.fields, T.StructField("_corrupt", T.StringType())])
    text = F.col("value").cast("string")
    parsed = envelopes.select(
        F.inline(F.array(F.from_json(text, schema, {"columnNameOfCorruptRecord": "_corrupt"}))),
        text.alias("_value"), F.col("key").cast("string").alias("kafka_key"),
        *[F.col(theirs).alias(ours) for ours, theirs in MESSAGE_ID.items()],
    ).withColumns({"_ingestion_ts": F.current_timestamp(), "_source": F.lit(source)})
    none = reduce(and_, [F.col(c).isNull() for c in spec.columns])
    judged = parsed.withColumn(
        "_reason",
        F.when(is_blank("_value"), "no value").when(F.col("_corrupt").isNotNull(), "malformed").when(none, "no known field"),
    )
    good = judged.where("_reason IS NULL").drop("_reason", "_corrupt", "_value")
    rejected = judged.where("_reason IS NOT NULL").select(
        F.col("_value").alias("value"), F.col("_reason").alias("reason"), "kafka_key", *MESSAGE_ID, "_ingestion_ts", "_source"
    )
    return good, rejected


def unseen(envelopes: DataFrame, bronze: DataFrame) -> DataFrame:
    """Messages not yet in bronze, compared one by one before anything is parsed."""
    known = bronze.select(*[F.col(ours).alias(f"_{ours}") for ours in MESSAGE_ID])
    same = [envelopes[theirs].eqNullSafe(known[f"_{ours}"]) for ours, theirs in MESSAGE_ID.items()]
    return envelopes.join(known, reduce(and_, same), "left_anti")


def _unseen_by(envelopes: DataFrame, table: str) -> DataFrame:
    spark = envelopes.sparkSession
    if not spark.catalog.tableExists(table):
        return envelopes
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if properties.get(STREAM_PROPERTY):
        raise ValueError(f"{table} is written by a stream; ingest batches into another table")
    return unseen_by_index(envelopes, table)


def ingest_batch(
    envelopes: DataFrame, spec: EntitySpec, table: str, *, source: str = "kafka", rejects: str | None = None
) -> int:
    """Append new messages to a bronze table (created on first use); returns the rows written to it.

    An empty batch changes nothing, and so does ingesting the same messages again.  What is new is found
    by the index of offsets beside the table (``sources.offset_index``).  With ``rejects``, a second table,
    messages that cannot be rows go there instead; both are written from the same messages, stored once,
    and a message that either table holds is not new.
    """
    if envelopes.isEmpty():
        return 0
    fresh = _unseen_by(envelopes, table)
    if rejects is None:
        return append(parse_envelopes(fresh, spec, source), table)
    good, rejected = split_messages(stored(_unseen_by(fresh, rejects), "messages"), spec, source)
    append(rejected, rejects)
    return append(good, table)


def ingest_extract(
    spark: SparkSession, spec: EntitySpec, path: str | list[str], table: str, *, source: str = "csv", **reading
) -> int:
    """Append all rows of a folder of CSV extracts to a bronze table; returns the rows written.

    Files have no message identity: reading them again adds their rows again, and silver keeps the
    latest of each key.  A folder without rows changes nothing.
    """
    rows = read_extract(spark, spec, path, **reading)
    if rows.isEmpty():
        return 0
    return append(rows.withColumns({"_ingestion_ts": F.current_timestamp(), "_source": F.lit(source)}), table)


# A parquet table fed by a stream lists its files in the sink's own log and would hide appended ones.
STREAM_PROPERTY = "ledgerlake.stream"
