"""Every operator as a query over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Money leaves as double and timestamps as text, so that results compare by value with another engine.
Queries of writing operators write below the shared scratch folder and read back what they wrote.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import operators as op
from ..plans import aml, bucketed, counts, customers, fingerprints, medallion, metadata, npa, partials, quality, sections, transactions
from ..rules import DEFAULT_RULES
from ..session import scratch_dir, stored
from ..sinks import (
    ContractError, Curve, append, contract_actions, create_namespace, preview, publish, replace as replace_table, to_envelopes, write_envelopes,
    write_extract, write_json_lines,
)
from ..sources import (
    ENVELOPE_SCHEMA, held_stretches, indexed_offsets, read_envelopes, read_extract, refreshed_index, stream_envelopes,
)
from ..specs import AML_ALERTS, BUREAU, CUSTOMERS, NPA_REPORT, TRANSACTIONS, route
from ..streaming import ingest_stream, ingest_topics
from . import roles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Amounts of the stand-in transactions end at about half a million, so the cash thresholds are lower.
RULES = replace(DEFAULT_RULES, cash_report_min=250_000, override_cash_above=200_000)
MONTH = "1997-05"
LAYERS = ("bronze", "silver", "gold")


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double, timestamps as text, arrays as one string."""
    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: comparable(build(spark, sf_dir))
    return build


def _namespace(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """A fresh namespace stored in a fresh scratch folder."""
    name, folder = f"{purpose}_{uuid.uuid4().hex[:8]}", scratch_dir(spark, purpose)
    create_namespace(spark, name, folder)
    return name, folder


# --- silver ---------------------------------------------------------------------------------------

@query
def silver_transactions(spark, sf_dir):
    return op.silver_transactions(roles.bronze_transactions(spark, sf_dir)).drop("ingestion_ts")


@query
def silver_customers_masked(spark, sf_dir):
    return op.silver_customers(roles.bronze_customers(spark, sf_dir, repeats=True)).drop("ingestion_ts")


@query
def silver_loans_ltv(spark, sf_dir):
    bronze = roles.bronze_npa_report(spark, sf_dir, customer=True, collateral=True)
    return op.silver_loans(bronze).drop("ingestion_ts")


@query
def silver_loans_lms(spark, sf_dir):
    return op.silver_loans(roles.bronze_lms_loans(spark, sf_dir), "lms").drop("ingestion_ts")


@query
def silver_bureau(spark, sf_dir):
    return op.silver_bureau(roles.bronze_bureau(spark, sf_dir)).drop("ingestion_ts")


@query
def silver_aml_alerts(spark, sf_dir):
    return op.silver_aml_alerts(roles.bronze_aml_alerts(spark, sf_dir)).drop("ingestion_ts")


@query
def dedup_by_key(spark, sf_dir):
    lines = roles.load(spark, sf_dir, "lineitem")
    return op.latest_per_key(
        lines,
        ["l_orderkey", "l_linenumber"],
        [F.col(c).desc() for c in (
            "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus",
        )],
    )


# --- bronze, sources and sinks --------------------------------------------------------------------

def _message_fields(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        *TRANSACTIONS.columns, "kafka_key", "kafka_topic", "kafka_partition", "kafka_offset",
        "kafka_timestamp",
    )


@query
def bronze_parse_json(spark, sf_dir):
    envelopes = roles.transaction_envelopes(spark, sf_dir, TRANSACTIONS.topic)
    return _message_fields(op.parse_envelopes(envelopes, TRANSACTIONS))


@query
def bronze_batch_ingest(spark, sf_dir):
    """Two ingests of the same messages leave each one once."""
    namespace, _ = _namespace(spark, "batch_ingest")
    table = f"{namespace}.{TRANSACTIONS.bronze_table}"
    envelopes = roles.transaction_envelopes(spark, sf_dir, TRANSACTIONS.topic)
    op.ingest_batch(envelopes, TRANSACTIONS, table)
    op.ingest_batch(envelopes, TRANSACTIONS, table)
    return _message_fields(spark.table(table))


@query
def bronze_stream_ingest(spark, sf_dir):
    """A stream over message files; the second run finds nothing new."""
    namespace, folder = _namespace(spark, "stream_ingest")
    table = f"{namespace}.{TRANSACTIONS.bronze_table}"
    messages, checkpoint = f"{folder}/_messages", f"{folder}/_checkpoints"
    roles.transaction_envelopes(spark, sf_dir, TRANSACTIONS.topic).write.partitionBy("topic").parquet(messages)
    for _ in range(2):
        stream = stream_envelopes(spark, TRANSACTIONS.topic, per_batch=100, fmt="parquet", path=messages)
        ingest_stream(stream, TRANSACTIONS, table, checkpoint, available_now=True).awaitTermination()
    return _message_fields(spark.table(table))


@query
def stream_dedup(spark, sf_dir):
    """Messages that come three times, each as many files: the second time all again and new keys of a year before, the third time those."""
    namespace, folder = _namespace(spark, "stream_dedup")
    messages, table = f"{folder}/_messages", f"{namespace}.events"
    events = roles.load(spark, sf_dir, "events")
    late = events.filter("event_id % 50 = 0").withColumns(
        {"event_id": -F.col("event_id") - 1, "ts": F.col("ts") - F.expr("INTERVAL 365 DAYS")}
    )
    for n, part in enumerate((events, events.unionByName(late), late)):
        part.select(
            F.lit(None).cast("string").alias("key"),
            F.to_json(F.struct(F.col("event_id").cast("string").alias("txn_id"), F.date_format("ts", "yyyy-MM-dd").alias("txn_date"),
                               F.col("user_id").cast("string").alias("customer_id"))).alias("value"),
            F.lit(TRANSACTIONS.topic).alias("topic"), F.lit(n).alias("partition"),
            F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
        ).write.mode("append").partitionBy("topic").parquet(messages)
        stream = stream_envelopes(spark, TRANSACTIONS.topic, per_batch=100, fmt="parquet", path=messages)
        ingest_stream(
            stream, TRANSACTIONS, table, f"{folder}/_checkpoints", available_now=True, keyed_state=True
        ).awaitTermination()
    return spark.table(table).select("txn_id", "txn_date", "customer_id")


def _numbered_messages(spark, sf_dir):
    """Events as messages of four partitions with offsets from zero; every 97th offset has none."""
    events = roles.load(spark, sf_dir, "events")
    offset = F.floor(F.col("event_id") / 4)
    return events.where(offset % 97 != 50).select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(F.col("event_id").cast("string").alias("txn_id"), F.col("user_id").cast("string").alias("customer_id"))).alias("value"),
        F.lit(TRANSACTIONS.topic).alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        offset.alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
    )


@query
def incremental_ingest(spark, sf_dir):
    """Four ingests of a growing topic that is made anew before the last: messages read and appended by each."""
    namespace, folder = _namespace(spark, "incremental")
    table = f"{namespace}.{TRANSACTIONS.bronze_table}"
    whole = _numbered_messages(spark, sf_dir)
    early = F.col("offset") < 1000
    anew = whole.where("offset < 300").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 400 DAYS"))
    runs = []
    for run, (arrived, path) in enumerate(((whole.where(early), "one"), (whole.where(~early), "one"), (None, "one"), (anew, "two")), 1):
        path = f"{folder}/_messages_{path}"
        if arrived is not None:
            arrived.write.mode("append").parquet(path)
        reading = {"fmt": "parquet", "path": path}
        start = indexed_offsets(spark, table, TRANSACTIONS.topic, gaps_are_final=True, **reading)
        messages = read_envelopes(spark, TRANSACTIONS.topic, options={"startingOffsets": start}, **reading)
        counted = messages.agg(F.lit(run).alias("run"), F.count("*").alias("messages_read"))
        runs.append(counted.withColumn("rows_added", F.lit(op.ingest_batch(messages, TRANSACTIONS, table)).cast("bigint")))
    return reduce(DataFrame.unionByName, runs)


@query
def offset_stretches(spark, sf_dir):
    """Unbroken stretches of offsets that a bronze table holds after two ingests, by its index."""
    namespace, _ = _namespace(spark, "stretches")
    table = f"{namespace}.{TRANSACTIONS.bronze_table}"
    whole = _numbered_messages(spark, sf_dir)
    for part in (whole.where("offset % 500 < 200"), whole):
        op.ingest_batch(part, TRANSACTIONS, table)
    held = held_stretches(refreshed_index(spark, table))
    return held.select("kafka_partition", "low", "high", "messages")


@query
def stream_topics(spark, sf_dir):
    """Two topics in one folder of messages, one stream and one bronze table each."""
    namespace, folder = _namespace(spark, "stream_topics")
    messages = f"{folder}/_messages"
    sources = ((TRANSACTIONS, roles.bronze_transactions(spark, sf_dir)), (CUSTOMERS, roles.bronze_customers(spark, sf_dir)))
    topics = {}
    for spec, rows in sources:
        write_envelopes(to_envelopes(rows.select(*spec.columns), spec.topic, spec.key), fmt="parquet", path=messages)
        topics |= route(spec.topic)
    for stream in ingest_topics(
        lambda topic: stream_envelopes(spark, topic, per_batch=100, fmt="parquet", path=messages),
        topics, namespace, f"{folder}/_checkpoints", available_now=True,
    ):
        stream.awaitTermination()
    parts = [
        spark.table(f"{namespace}.{spec.bronze_table}").groupBy("kafka_topic").agg(
            F.count("*").alias("row_count"), F.count_distinct(spec.key).alias("key_count")
        )
        for spec, _ in sources
    ]
    return parts[0].unionByName(parts[1])


@query
def stream_to_files(spark, sf_dir):
    """The parsed stream into JSON files instead of a table."""
    _, folder = _namespace(spark, "stream_files")
    messages, out = f"{folder}/_messages", f"{folder}/out"
    roles.transaction_envelopes(spark, sf_dir, TRANSACTIONS.topic).write.partitionBy("topic").parquet(messages)
    stream = stream_envelopes(spark, TRANSACTIONS.topic, per_batch=100, fmt="parquet", path=messages)
    parsed = op.parse_envelopes(stream, TRANSACTIONS).select("txn_id", "branch_code", "kafka_offset")
    (
        parsed.writeStream.format("json").option("path", out).option("checkpointLocation", f"{folder}/_checkpoint")
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema("txn_id string, branch_code string, kafka_offset bigint").json(out)


@query
def topic_routing(spark, sf_dir):
    """Messages of two topics, each parsed as the entity that its topic carries."""
    parts = []
    for topic, rows in ((TRANSACTIONS.topic, roles.bronze_transactions(spark, sf_dir)),
                        (CUSTOMERS.topic, roles.bronze_customers(spark, sf_dir))):
        spec = route(topic)[topic]
        sent = to_envelopes(rows.select(*spec.columns), topic, spec.key).withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in ENVELOPE_SCHEMA if f.name not in ("key", "value", "topic")}
        )
        parsed = op.parse_envelopes(sent, spec)
        parts.append(parsed.groupBy("kafka_topic").agg(
            F.count(spec.key).alias("with_key"), F.sum((F.col(spec.key) == F.col("kafka_key")).cast("bigint")).alias("key_agrees")
        ).withColumn("bronze_table", F.lit(spec.bronze_table)))
    return parts[0].unionByName(parts[1])


@query
def ingest_stamps(spark, sf_dir):
    """Source tag and ingestion time of parsed messages and of silver: one tag, one time each."""
    parsed = op.parse_envelopes(roles.transaction_envelopes(spark, sf_dir, TRANSACTIONS.topic), TRANSACTIONS, "replay")
    return parsed.groupBy(F.lit("bronze").alias("layer"), F.col("_source").alias("source")).agg(
        F.count("_ingestion_ts").alias("stamped"), F.count_distinct("_ingestion_ts").alias("stamps")
    ).unionByName(op.silver_transactions(parsed).groupBy(
        F.lit("silver").alias("layer"), F.lit(None).cast("string").alias("source")
    ).agg(F.count("ingestion_ts").alias("stamped"), F.count_distinct("ingestion_ts").alias("stamps")))


@query
def csv_extract(spark, sf_dir):
    """Raw transactions as CSV files, read back with declared types."""
    path = scratch_dir(spark, "csv_extract")
    raw = roles.bronze_transactions(spark, sf_dir).select(*TRANSACTIONS.columns)
    write_extract(raw, path)
    return read_extract(spark, TRANSACTIONS, path, typed=True)


@query
def csv_as_text(spark, sf_dir):
    """The same files as text, blanks as empty text."""
    path = scratch_dir(spark, "csv_text")
    write_extract(roles.bronze_transactions(spark, sf_dir).select(*TRANSACTIONS.columns), path)
    return read_extract(spark, TRANSACTIONS, path, blank_as_text=True)


@query
def csv_recursive(spark, sf_dir):
    """Extracts in day folders, found below their common folder."""
    path = scratch_dir(spark, "csv_days")
    raw = roles.bronze_transactions(spark, sf_dir).select(*TRANSACTIONS.columns)
    for half in (0, 1):
        write_extract(raw.filter(F.length("txn_id") % 2 == half), f"{path}/2026/04/{14 + half}")
    found = read_extract(spark, TRANSACTIONS, path, recursive=True, name_filter="*.csv")
    return found.groupBy("branch_code").agg(F.count("*").alias("row_count"), F.count("customer_id").alias("with_customer"))


@query
def csv_to_bronze(spark, sf_dir):
    """A folder of customer extracts into a bronze table; a folder without rows adds nothing."""
    namespace, folder = _namespace(spark, "csv_bronze")
    table = f"{namespace}.{CUSTOMERS.bronze_table}"
    customers_ = roles.bronze_customers(spark, sf_dir).select(*CUSTOMERS.columns)
    write_extract(customers_, f"{folder}/full")
    write_extract(customers_.filter("false"), f"{folder}/empty")
    written = [op.ingest_extract(spark, CUSTOMERS, f"{folder}/{part}", table) for part in ("full", "empty")]
    return spark.table(table).select(*CUSTOMERS.columns, "_source", F.lit(written[1]).alias("from_empty"))


@query
def publish_preview(spark, sf_dir):
    """Dry run: the first messages of one branch's richest customers, values cut."""
    rows = roles.bronze_customers(spark, sf_dir).select("customer_id", "name").orderBy(F.col("customer_id").cast("bigint"))
    return preview(to_envelopes(rows, CUSTOMERS.topic, CUSTOMERS.key), rows=3, chars=30)


@query
def publish_envelope(spark, sf_dir):
    """Customers as keyed JSON messages in files, read back and parsed."""
    path = scratch_dir(spark, "publish_envelope")
    rows = roles.bronze_customers(spark, sf_dir)
    write_envelopes(to_envelopes(rows, CUSTOMERS.topic, CUSTOMERS.key), fmt="parquet", path=path)
    messages = read_envelopes(spark, CUSTOMERS.topic, fmt="parquet", path=path)
    return op.parse_envelopes(messages, CUSTOMERS).select("kafka_key", "kafka_topic", *CUSTOMERS.columns)


@query
def json_lines(spark, sf_dir):
    """Raw alerts as JSON lines, read back."""
    path = scratch_dir(spark, "json_lines")
    write_json_lines(roles.bronze_aml_alerts(spark, sf_dir), path)
    return spark.read.schema(AML_ALERTS.raw_schema).json(path)


# --- gold -----------------------------------------------------------------------------------------

@query
def branch_txn_summary(spark, sf_dir):
    return op.branch_txn_summary(roles.silver_transactions(spark, sf_dir))


@query
def npa_classification_summary(spark, sf_dir):
    return op.npa_classification_summary(roles.silver_loans(spark, sf_dir))


def _customer_360(spark, sf_dir, **options):
    return op.customer_360(
        roles.silver_customers(spark, sf_dir),
        roles.silver_transactions(spark, sf_dir),
        roles.silver_loans(spark, sf_dir, customer=True),
        **options,
    )


@query
def customer_360(spark, sf_dir):
    return _customer_360(spark, sf_dir)


@query
def customer_360_lexical(spark, sf_dir):
    return _customer_360(spark, sf_dir, worst_by="lexical")


# --- reports on bronze ----------------------------------------------------------------------------

@query
def row_counts(spark, sf_dir):
    return counts.row_counts({
        "finacle_transactions": roles.bronze_transactions(spark, sf_dir),
        "finacle_customers": roles.bronze_customers(spark, sf_dir),
        "aml_alerts": roles.bronze_aml_alerts(spark, sf_dir),
        "cibil_bureau": roles.bronze_bureau(spark, sf_dir),
        "npa_report": roles.bronze_npa_report(spark, sf_dir),
    })


@query
def ingestion_freshness(spark, sf_dir):
    bronze = roles.bronze_transactions(spark, sf_dir)
    return counts.ingestion_freshness(bronze.withColumn("_ingestion_ts", F.col("kafka_timestamp")))


@query
def channel_distribution_raw(spark, sf_dir):
    return transactions.channel_distribution_raw(roles.bronze_transactions(spark, sf_dir))


@query
def branch_type_top15(spark, sf_dir):
    return transactions.branch_type_top_raw(roles.bronze_transactions(spark, sf_dir))


@query
def hourly_pattern_raw(spark, sf_dir):
    return transactions.hourly_pattern_raw(roles.bronze_transactions(spark, sf_dir))


@query
def data_quality_counters(spark, sf_dir):
    return transactions.data_quality(roles.bronze_transactions(spark, sf_dir))


@query
def high_value_cash_left(spark, sf_dir):
    return aml.high_value_cash_raw(
        roles.bronze_transactions(spark, sf_dir), roles.bronze_customers(spark, sf_dir), RULES
    )


@query
def open_alerts_top20(spark, sf_dir):
    return aml.open_alerts(
        roles.bronze_aml_alerts(spark, sf_dir), customers=roles.bronze_customers(spark, sf_dir)
    )


@query
def npa_from_raw(spark, sf_dir):
    return npa.npa_from_raw(roles.bronze_npa_report(spark, sf_dir))


@query
def low_score_top20(spark, sf_dir):
    return customers.low_scores(roles.bronze_bureau(spark, sf_dir))


# --- reports on silver and gold -------------------------------------------------------------------

ENTITIES = (TRANSACTIONS, CUSTOMERS, NPA_REPORT, BUREAU, AML_ALERTS)


def _bronze(spark, sf_dir, entities=ENTITIES):
    """The bronze tables of some entities, written."""
    namespace, _ = _namespace(spark, "layers")
    names = medallion.Namespaces(*[f"{namespace}_{layer}" for layer in LAYERS])
    for name in (names.bronze, names.silver, names.gold):
        create_namespace(spark, name, scratch_dir(spark, name))
    rows = {
        TRANSACTIONS.name: lambda: roles.bronze_transactions(spark, sf_dir),
        CUSTOMERS.name: lambda: roles.bronze_customers(spark, sf_dir, repeats=True),
        NPA_REPORT.name: lambda: roles.bronze_npa_report(spark, sf_dir, customer=True, collateral=True),
        BUREAU.name: lambda: roles.bronze_bureau(spark, sf_dir),
        AML_ALERTS.name: lambda: roles.bronze_aml_alerts(spark, sf_dir),
    }
    for spec in entities:
        append(rows[spec.name](), f"{names.bronze}.{spec.bronze_table}")
    return names


def _published_silver(spark, sf_dir, entities=ENTITIES):
    names = _bronze(spark, sf_dir, entities)
    medallion.build_silver(spark, names)
    return names


@query
def layer_reconciliation(spark, sf_dir):
    """Rows of bronze and of the silver tables published from it."""
    names = _published_silver(spark, sf_dir, ENTITIES[:3])
    return counts.row_counts({
        f"{layer}.{name}": spark.table(f"{namespace}.{name}")
        for layer, namespace, tables in (
            ("bronze", names.bronze, [s.bronze_table for s in ENTITIES[:3]]),
            ("silver", names.silver, [s.silver_table for s in ENTITIES[:3]]),
        )
        for name in tables
    }, "table_name", "row_count")


@query
def key_reconciliation(spark, sf_dir):
    """All entities against their published silver, of which the customers' was damaged."""
    names = _published_silver(spark, sf_dir)
    damaged = f"{names.silver}.{CUSTOMERS.silver_table}"
    publish(spark.table(damaged).filter("customer_id % 7 != 0"), damaged)
    return quality.reconciliation({
        spec.name: (spark.table(f"{names.bronze}.{spec.bronze_table}"), spark.table(f"{names.silver}.{spec.silver_table}"), spec.key)
        for spec in ENTITIES
    })


@query
def exchanged_key(spark, sf_dir):
    """Silver customers of whom one was replaced by a stranger: the counts agree, the keys do not, and both are named."""
    bronze = roles.bronze_customers(spark, sf_dir, repeats=True)
    least = F.broadcast(bronze.agg(F.min(F.col("customer_id").cast("bigint")).alias("_least")))
    silver = stored(op.silver_customers(bronze), "silver").join(least, F.col("customer_id").cast("bigint") == F.col("_least"), "left").withColumn(
        "customer_id", F.when(F.col("_least").isNotNull(), F.concat(F.lit("X"), F.col("customer_id"))).otherwise(F.col("customer_id"))
    )
    checked = quality.reconciliation({"customers": (bronze, silver, "customer_id")})
    named = fingerprints.key_differences(bronze, "customer_id", silver, "customer_id")
    verdict = checked.select((F.col("bronze_keys") == F.col("silver_rows")).alias("counts_agree"), "matches")
    # one row of verdict beside each key found
    return named.withColumn("_one", F.lit(1)).join(verdict.withColumn("_one", F.lit(1)), "_one").drop("_one").select(
        "key", F.col("in_left").alias("in_bronze"), F.col("in_right").alias("in_silver"), "counts_agree", "matches"
    )


@query
def required_tables(spark, sf_dir):
    """Of the required bronze tables one is there, one is empty, one is absent."""
    namespace, _ = _namespace(spark, "required")
    append(roles.bronze_customers(spark, sf_dir), f"{namespace}.{CUSTOMERS.bronze_table}")
    append(roles.bronze_npa_report(spark, sf_dir).filter("false"), f"{namespace}.{NPA_REPORT.bronze_table}")
    checks = quality.required_tables(spark, namespace)
    return checks.withColumn("table_name", F.substring_index("table_name", ".", -1))


@query
def silver_contract(spark, sf_dir):
    """Columns of published silver customers and transactions against a contract with one other type and one more column."""
    namespace, _ = _namespace(spark, "contract")
    publish(op.silver_customers(roles.bronze_customers(spark, sf_dir)).select("customer_id", "name", "annual_income"), f"{namespace}.customers")
    contract = T.StructType.fromDDL("customer_id string, name string, annual_income double, segment string")
    return quality.layer_columns(spark, namespace, {"customers": contract}).withColumn("layer", F.lit("silver"))


@query
def contract_gate(spark, sf_dir):
    """Customers appended under a contract: one type widened, one column filled; then with an unknown column and a narrower type, refused."""
    namespace, _ = _namespace(spark, "gate")
    table = f"{namespace}.customers"
    rows = op.silver_customers(roles.bronze_customers(spark, sf_dir)).select("customer_id", "annual_income", F.length("name").alias("name_length"))
    contract = T.StructType.fromDDL("customer_id string, annual_income decimal(24,4), name_length bigint, segment string")
    added = append(rows, table, contract=contract)
    spoilt = rows.withColumn("annual_income", F.col("annual_income").cast("double")).withColumn("nickname", F.lit("x"))
    try:
        append(spoilt, table, contract=contract)
        refused = []
    except ContractError as problem:
        refused = [name for name, _, _ in problem.refused]
    listed = spark.createDataFrame(contract_actions(rows, contract), "column_name string, expected_type string, found_type string, action string")
    return listed.select(
        "*", F.lit(",".join(refused)).alias("then_refused"), F.lit(added).cast("bigint").alias("rows_added"),
        spark.table(table).agg(F.count("*")).scalar().alias("rows_held"), spark.table(table).agg(F.sum("annual_income")).scalar().alias("income"),
    )


@query
def rejected_messages(spark, sf_dir):
    """Messages into two tables by a stream in two runs: good rows, and per reason those that cannot be rows."""
    namespace, folder = _namespace(spark, "rejects")
    table, rejects, messages = f"{namespace}.good", f"{namespace}.rejected", f"{folder}/_messages"
    n = F.col("offset")
    spoilt = _numbered_messages(spark, sf_dir).withColumn(
        "value", F.when(n % 10 == 1, F.substring("value", 1, 20)).when(n % 10 == 2, "").when(n % 10 == 3, '{"other": 1}').otherwise(F.col("value"))
    )
    for half in (0, 1):
        spoilt.where((n % 2 == half) | (n % 3 == half)).write.mode("append").parquet(messages)  # some messages come twice
        stream = stream_envelopes(spark, TRANSACTIONS.topic, per_batch=100, fmt="parquet", path=messages)
        ingest_stream(stream, TRANSACTIONS, table, f"{folder}/_checkpoints", available_now=True, rejects=rejects).awaitTermination()
    place = F.count_distinct("kafka_partition", "kafka_offset").alias("messages")
    good = spark.table(table).groupBy(F.lit("good").alias("reason")).agg(F.count("*").alias("row_count"), place, F.lit(None).cast("bigint").alias("raw_length"))
    return good.unionByName(
        spark.table(rejects).groupBy("reason").agg(F.count("*").alias("row_count"), place, F.sum(F.length("value")).cast("bigint").alias("raw_length"))
    )


@query
def reports_without_alerts(spark, sf_dir):
    """The reports that remain, and their rows, when the optional tables are absent."""
    namespace, _ = _namespace(spark, "partial")
    for spec, df in ((TRANSACTIONS, roles.bronze_transactions(spark, sf_dir).withColumn("_ingestion_ts", F.col("kafka_timestamp"))),
                     (CUSTOMERS, roles.bronze_customers(spark, sf_dir)), (NPA_REPORT, roles.bronze_npa_report(spark, sf_dir))):
        append(df, f"{namespace}.{spec.bronze_table}")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        reports = sections.bronze_reports(spark, namespace=namespace)
    return counts.row_counts(reports, "report", "row_count")


def _silver_of(spark, sf_dir):
    """Silver as built from bronze, without arrival columns of its own."""
    return (
        op.silver_transactions(roles.bronze_transactions(spark, sf_dir)),
        op.silver_customers(roles.bronze_customers(spark, sf_dir, repeats=True)),
        op.silver_loans(roles.bronze_npa_report(spark, sf_dir, customer=True, collateral=True)),
    )


@query
def gold_branch_from_silver(spark, sf_dir):
    return op.branch_txn_summary(_silver_of(spark, sf_dir)[0])


@query
def gold_npa_from_silver(spark, sf_dir):
    return op.npa_classification_summary(_silver_of(spark, sf_dir)[2])


@query
def gold_customer_360_from_silver(spark, sf_dir):
    silver = _silver_of(spark, sf_dir)
    return op.customer_360(silver[1], silver[0], silver[2])


@query
def branch_summary_order(spark, sf_dir):
    ordered = op.with_position(transactions.branch_summary(roles.silver_transactions(spark, sf_dir)))
    return ordered.select("position", "branch_code", "txn_type")


@query
def hourly_pattern_order(spark, sf_dir):
    ordered = op.with_position(transactions.hourly_pattern(roles.silver_transactions(spark, sf_dir)))
    return ordered.select("position", "txn_hour")


@query
def npa_regulatory_positions(spark, sf_dir):
    ordered = op.with_position(npa.npa_regulatory(roles.silver_loans(spark, sf_dir)))
    return ordered.select("position", "npa_status")


@query
def flagged_detail_order(spark, sf_dir):
    ordered = op.with_position(aml.flagged_detail(
        roles.silver_transactions(spark, sf_dir), roles.silver_customers(spark, sf_dir)
    ))
    return ordered.select("position", "txn_id")


@query
def provision_reported(spark, sf_dir):
    """The provision by rule beside the sum of the report's own figures."""
    loans = op.silver_loans(roles.bronze_npa_report(spark, sf_dir, collateral=True))
    return npa.provision_requirement(loans, with_reported=True)


@query
def branch_summary(spark, sf_dir):
    return transactions.branch_summary(roles.silver_transactions(spark, sf_dir))


@query
def channel_share_pct(spark, sf_dir):
    return transactions.channel_share(roles.silver_transactions(spark, sf_dir))


@query
def hourly_pattern(spark, sf_dir):
    return transactions.hourly_pattern(roles.silver_transactions(spark, sf_dir))


@query
def flagged_detail(spark, sf_dir):
    return aml.flagged_detail(
        roles.silver_transactions(spark, sf_dir), roles.silver_customers(spark, sf_dir)
    )


@query
def structuring_detection(spark, sf_dir):
    return aml.structuring(
        roles.silver_transactions(spark, sf_dir), roles.silver_customers(spark, sf_dir)
    )


@query
def structuring_ids(spark, sf_dir):
    return aml.structuring_ids(
        roles.silver_transactions(spark, sf_dir), roles.silver_customers(spark, sf_dir)
    )


@query
def high_value_cash(spark, sf_dir):
    return aml.high_value_cash(
        roles.silver_transactions(spark, sf_dir), roles.silver_customers(spark, sf_dir), RULES
    )


@query
def npa_regulatory_order(spark, sf_dir):
    return npa.npa_regulatory(roles.silver_loans(spark, sf_dir))


@query
def approaching_npa(spark, sf_dir):
    return npa.approaching_npa(roles.silver_loans(spark, sf_dir, customer=True, collateral=True))


@query
def provision_requirement(spark, sf_dir):
    return npa.provision_requirement(roles.silver_loans(spark, sf_dir))


@query
def customer_360_listing(spark, sf_dir):
    return customers.customer_360_listing(_customer_360(spark, sf_dir))


@query
def high_risk_customers(spark, sf_dir):
    return customers.high_risk_customers(
        roles.silver_customers(spark, sf_dir),
        roles.silver_bureau(spark, sf_dir),
        roles.silver_loans(spark, sf_dir, customer=True),
        roles.silver_transactions(spark, sf_dir),
    )


@query
def monthly_partition_summary(spark, sf_dir):
    return transactions.monthly_summary(roles.monthly_transactions(spark, sf_dir), MONTH)


# --- published tables -----------------------------------------------------------------------------

def _published_months(spark, sf_dir):
    namespace, _ = _namespace(spark, "published")
    table = f"{namespace}.transactions"
    result = publish(
        roles.monthly_transactions(spark, sf_dir), table, partition_by=("txn_month",), run_id="first"
    )
    return namespace, table, result


@query
def partition_pruned_total(spark, sf_dir):
    _, table, _ = _published_months(spark, sf_dir)
    return transactions.month_total(spark.table(table), MONTH)


def _files(spark, table):
    """Files of a table by its partition folder, as the file system lists them."""
    location = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return reader.load(location).select("path", "length")


@query
def partition_profile(spark, sf_dir):
    """Rows and files of every month; files compared with what the file system lists."""
    _, _, result = _published_months(spark, sf_dir)
    profile = metadata.partition_profile(spark.table(result.run_table), "txn_month")
    listed = _files(spark, result.run_table).groupBy(
        F.regexp_extract("path", "txn_month=([^/]+)", 1).alias("month")
    ).agg(F.count("*").alias("listed"))
    joined = profile.join(listed, F.col("txn_month") == F.col("month"), "left")
    return joined.select("txn_month", "row_count", (F.col("file_count") == F.col("listed")).alias("files_agree"))


@query
def file_profile(spark, sf_dir):
    """Rows of every file; bytes compared with what the file system lists."""
    files = metadata.file_profile(roles.load(spark, sf_dir, "lineitem"))
    listed = spark.read.format("binaryFile").load(f"{sf_dir}/lineitem.parquet").select(
        F.substring_index("path", "/", -1).alias("file_name"), "length"
    )
    named = files.withColumn("file_name", F.substring_index("file_path", "/", -1))
    return named.join(listed, "file_name").select(
        "file_name", "row_count", (F.col("file_bytes") == F.col("length")).alias("bytes_agree")
    )


@query
def publish_refresh(spark, sf_dir):
    """After a second run replaced the table, readers see its rows alone."""
    _, table, _ = _published_months(spark, sf_dir)
    publish(roles.monthly_transactions(spark, sf_dir).withColumn("amount", (F.col("amount") * 2).cast(roles.MONEY)),
            table, partition_by=("txn_month",), run_id="second")
    return spark.table(table).groupBy("txn_month").agg(F.count("*").alias("row_count"), F.sum("amount").alias("total_amount"))


@query
def replaced_table(spark, sf_dir):
    """A plain table written twice holds the second content."""
    namespace, _ = _namespace(spark, "replaced")
    table = f"{namespace}.customers"
    rows = roles.silver_customers(spark, sf_dir)
    replace_table(rows.unionByName(rows), table)
    replace_table(rows, table)
    return spark.table(table)


@query
def layer_counts(spark, sf_dir):
    """Bronze tables written, silver and gold built and published from them, every table counted.

    One bronze table has a name with two underscores.
    """
    names = _bronze(spark, sf_dir)
    append(roles.load(spark, sf_dir, "region"), f"{names.bronze}.region__daily")
    medallion.build_layers(spark, names)
    counted = quality.layer_counts(spark, (names.bronze, names.silver, names.gold))
    return counted.withColumn("layer", F.substring_index("layer", "_", -1))


CURVE_CUSTOMER, CURVE_AMOUNT = 7, 100_000


@query
def curve_layout(spark, sf_dir):
    """What filters on a customer, an amount and both find, and whether ranges leave them at most half the files.

    The same transactions lie in 64 files as they come and in 64 along a curve of customer and amount.
    """
    namespace, _ = _namespace(spark, "curve")
    rows = roles.silver_transactions(spark, sf_dir)
    plain = publish(rows.repartition(64, "txn_id"), f"{namespace}.plain", run_id="run").run_table
    narrow = publish(rows, f"{namespace}.narrow", run_id="run", curve=Curve(("customer_id", "amount"), files=64)).run_table
    wanted = {"customer_id": (CURVE_CUSTOMER, CURVE_CUSTOMER), "amount": (CURVE_AMOUNT, None)}
    found, read = [], []
    for layout, table in (("plain", plain), ("curve", narrow)):
        profile = stored(metadata.range_profile(spark.table(table), *wanted), "file-ranges")
        for columns in (["customer_id"], ["amount"], ["customer_id", "amount"]):
            names = [F.lit(layout).alias("layout"), F.lit(" ".join(columns)).alias("filtered_by")]
            bounds = [F.col(c) >= wanted[c][0] for c in columns] + [F.col(c) <= wanted[c][1] for c in columns if wanted[c][1] is not None]
            kept = spark.table(table).where(reduce(Column.__and__, bounds))
            found.append(kept.agg(F.count("*").alias("row_count"), F.sum("amount").alias("total_amount")).select(*names, "row_count", "total_amount"))
            half = (2 * F.col("files_met") <= F.col("files")).alias("half_left_out")
            read.append(metadata.files_met(profile, **{c: wanted[c] for c in columns}).select(*names, half))
    found, read = (reduce(DataFrame.unionByName, rows) for rows in (found, read))
    return found.join(read, ["layout", "filtered_by"])


def _bucketed(spark, sf_dir):
    namespace, _ = _namespace(spark, "bucketed")
    table = f"{namespace}.transactions"
    # the busiest customers of the stand-ins are few thousand rows, so a task's share is set low enough to salt some
    bucketed.publish_bucketed(roles.silver_transactions(spark, sf_dir), table, "customer_id", buckets=16, spread_by=["txn_id"], task_rows=60)
    return table


@query
def customer_360_bucketed(spark, sf_dir):
    """The customer view over transactions in buckets."""
    return bucketed.customer_360(
        spark, _bucketed(spark, sf_dir), roles.silver_customers(spark, sf_dir), roles.silver_loans(spark, sf_dir, customer=True)
    )


@query
def flagged_detail_bucketed(spark, sf_dir):
    return bucketed.flagged_detail(spark, _bucketed(spark, sf_dir), roles.silver_customers(spark, sf_dir))


@query
def month_refreshed_gold(spark, sf_dir):
    """Customers' measures from parts by month, of which one was wrong, one absent and one too many until they were refreshed."""
    namespace, _ = _namespace(spark, "parts")
    table = f"{namespace}.customer_parts"
    rows = roles.monthly_transactions(spark, sf_dir).withColumn("is_flagged", F.col("txn_type") == "DEBIT")
    wrong = rows.withColumn("amount", F.when(F.col("txn_month") == MONTH, F.col("amount") * 2).otherwise(F.col("amount")).cast(roles.MONEY))
    foreign = rows.where(F.col("txn_month") == "1996-01").withColumn("txn_month", F.lit("2031-01"))
    partials.refresh_parts(partials.customer_parts(wrong.where("txn_month <> '1996-02'").unionByName(foreign), "txn_month"), table)
    return partials.refresh_customer_parts(spark, rows, table, [MONTH, "1996-02", "2031-01"])


# --- alerts ---------------------------------------------------------------------------------------

@query
def status_override(spark, sf_dir):
    return op.override_cash_status(roles.silver_transactions(spark, sf_dir), RULES).select(
        "txn_id", "channel", "amount", "status"
    )


@query
def alert_derivation(spark, sf_dir):
    return op.alert_base(op.override_cash_status(roles.silver_transactions(spark, sf_dir), RULES))
