"""Topics to bronze tables as append-only streams, one query and one checkpoint per topic."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.bronze import MESSAGE_ID, STREAM_PROPERTY, ingest_batch, parse_envelopes
from ..operators.dedup import latest_per_key
from ..sinks.publish import append
from ..specs import EntitySpec


def append_new_keys(rows: DataFrame, table: str, key: str) -> int:
    """Append the rows of a batch whose key the table does not hold yet, one per key, the latest.

    Nothing is dropped for being late: a key is new until the table has it.  Rows without a key have
    no repeats; of them, messages the table already holds are left out, so a batch that is run again
    after a failure adds nothing twice.
    """
    held = rows.sparkSession.table(table)
    keyed = latest_per_key(rows, key).join(held.select(key).filter(F.col(key).isNotNull()), key, "left_anti")
    known = held.filter(F.col(key).isNull()).select(*[F.col(c).alias(f"_{c}") for c in MESSAGE_ID])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in MESSAGE_ID])
    keyless = rows.filter(F.col(key).isNull()).join(known, same, "left_anti")
    return append(keyed.select(*rows.columns).unionByName(keyless), table)


def first_of_each_key(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a stream whose key no earlier row of it had; rows without a key once per message.

    The keys are kept as streaming state, without a watermark: nothing is late, and no table is read.  Of
    equal keys in one micro-batch the one that its task meets first stays.  The state is partitioned by
    the key into as many parts as ``spark.sql.shuffle.partitions`` says when the checkpoint begins; a key
    that fills a micro-batch costs one task no more than that batch.
    """
    message = F.when(F.col(key).isNull(), F.xxhash64(*MESSAGE_ID)), F.when(F.col(key).isNull(), F.struct(*MESSAGE_ID))
    marked = rows.withColumns({"_hash": message[0], "_message": message[1]})
    return marked.dropDuplicates([key, "_hash", "_message"]).drop("_hash", "_message")


def _ensure_table(spark: SparkSession, table: str, rows: DataFrame, fmt: str, of_stream: bool) -> None:
    if spark.catalog.tableExists(table):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    mark = f" TBLPROPERTIES ('{STREAM_PROPERTY}' = 'true')" if of_stream else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt}{mark}")


def ingest_stream(
    envelopes: DataFrame,
    spec: EntitySpec,
    table: str,
    checkpoint_dir: str,
    *,
    available_now: bool = False,
    processing_time: str | None = None,
    new_keys_only: bool = False,
    keyed_state: bool = False,
    rejects: str | None = None,
    fmt: str = "parquet",
    source: str = "kafka",
) -> StreamingQuery:
    """Start appending a stream of messages to a bronze table.

    Progress lives in the checkpoint below ``checkpoint_dir``, so a restart goes on where it stopped
    and adds nothing twice.  ``available_now`` stops after what is there at the start.  Repeats are kept
    and silver chooses among them, unless one of two options is set.  ``keyed_state`` appends the first row
    of each key and keeps the keys as state of the stream, in its checkpoint; the table is the stream's own.
    ``new_keys_only`` compares each micro-batch with the keys of the table, which costs a read of the
    table's key column each time; others may write the table too.  With ``rejects`` each micro-batch is an
    ``ingest_batch`` into two tables, good rows and messages that cannot be rows; a micro-batch that is
    run again adds nothing twice.
    """
    if keyed_state + new_keys_only + (rejects is not None) > 1:
        raise ValueError("choose one of keyed_state, new_keys_only and rejects")
    rows = envelopes if rejects else parse_envelopes(envelopes, spec, source)
    if keyed_state:
        rows = first_of_each_key(rows, spec.key)
    if not rejects:
        _ensure_table(envelopes.sparkSession, table, rows, fmt, of_stream=not new_keys_only)
    writer = rows.writeStream.outputMode("append").option(
        "checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{spec.topic or spec.name}"
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    if new_keys_only:
        return writer.foreachBatch(lambda batch, _: append_new_keys(batch, table, spec.key) and None).start()
    if rejects:
        return writer.foreachBatch(lambda batch, _: ingest_batch(batch, spec, table, source=source, rejects=rejects) and None).start()
    return writer.format(fmt).toTable(table)


def ingest_topics(
    open_stream: Callable[[str], DataFrame],
    topics: Mapping[str, EntitySpec],
    namespace: str,
    checkpoint_dir: str,
    **options,
) -> list[StreamingQuery]:
    """One running query per topic; ``open_stream`` gives the message stream of a topic."""
    return [
        ingest_stream(open_stream(topic), spec, f"{namespace}.{spec.bronze_table}", checkpoint_dir, **options)
        for topic, spec in topics.items()
    ]


def await_any(spark: SparkSession, timeout: int | None = None) -> bool | None:
    """Wait until any query stops; raises at once if one of them failed."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()
