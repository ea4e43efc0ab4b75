import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake import operators as op
from ledgerlake.session import scan_bytes, scratch_dir, shuffle_partitions
from ledgerlake.sinks import append, preview, to_envelopes, write_envelopes, write_extract, write_json_lines
from ledgerlake.sources import (
    ENVELOPE_SCHEMA, held_stretches, indexed_offsets, messages_at, offset_index, read_envelopes, read_extract, refreshed_index,
    resume_offsets, starting_offsets, stream_envelopes,
)
from ledgerlake.sources.envelopes import kafka_options
from ledgerlake.specs import AML_ALERTS, CUSTOMERS, SPECS, TOPICS, TRANSACTIONS, route
from ledgerlake.streaming import await_any, ingest_stream, ingest_topics
from ledgerlake.workload import queries

from data import by_key, rows, txn

TOPIC = TRANSACTIONS.topic


def envelopes(spark, *values, topic=TOPIC, start=0):
    data = [
        (f"K{start + i}", v if isinstance(v, str) else json.dumps(v), topic, (start + i) % 2, start + i,
         datetime(2026, 4, 14, 9, i % 60))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(data, ENVELOPE_SCHEMA)


def test_routing():
    assert len(TOPICS) == 5 and set(route(TOPIC)) == {TOPIC} and len(route()) == 5
    assert route("aml-alerts")["aml-alerts"].key == "alert_id"
    with pytest.raises(KeyError):
        route("nothing")
    assert all(spec.key in spec.columns for spec in SPECS.values())


def test_parse_partial_malformed_and_numeric(spark):
    env = envelopes(
        spark, txn(1),
        {"txn_id": "TXN1001", "customer_id": "CUST001", "amount": 5000, "channel": "UPI", "extra": 1},
        "{bad", {"txn_id": "TXN3", "amount": 12345678.9},
    )
    got = by_key(op.parse_envelopes(env, TRANSACTIONS), "kafka_offset")
    assert got[0]["narration"] == "SALARY" and got[0]["_source"] == "kafka" and got[0]["_ingestion_ts"]
    assert (got[1]["amount"], got[1]["status"], got[1]["kafka_key"]) == ("5000", None, "K1")
    assert all(got[2][c] is None for c in TRANSACTIONS.columns) and got[2]["kafka_topic"] == TOPIC
    assert got[3]["amount"] == "1.23456789E7"
    silver = by_key(op.silver_transactions(op.parse_envelopes(env, TRANSACTIONS)), "txn_id")
    assert set(silver) == {"TXN000001", "TXN1001", "TXN3"}
    assert str(silver["TXN3"]["amount"]) == "12345678.90"


def test_binary_envelopes_parse_alike(spark):
    env = envelopes(spark, txn(1))
    binary = env.withColumns({c: F.col(c).cast("binary") for c in ("key", "value")})
    skip = "_ingestion_ts"
    assert (
        op.parse_envelopes(binary, TRANSACTIONS).drop(skip).collect()
        == op.parse_envelopes(env, TRANSACTIONS).drop(skip).collect()
    )


def test_ingest_is_idempotent(spark, namespace):
    table = f"{namespace}.txn"
    first = envelopes(spark, txn(1), txn(2), txn(3))
    assert op.ingest_batch(first, TRANSACTIONS, table) == 3
    assert op.ingest_batch(first, TRANSACTIONS, table) == 0
    more = first.unionByName(envelopes(spark, txn(4), txn(5), start=3))
    assert op.ingest_batch(more, TRANSACTIONS, table) == 2
    assert spark.table(table).count() == 5
    assert spark.table(table).select("kafka_offset").distinct().count() == 5


def test_exact_ingest_fills_gaps(spark, namespace):
    table = f"{namespace}.txn"
    op.ingest_batch(envelopes(spark, txn(8), txn(9), start=8), TRANSACTIONS, table)
    assert op.ingest_batch(envelopes(spark, txn(1), txn(2)), TRANSACTIONS, table) == 2


def test_a_topic_made_anew_counts_from_zero_again(spark, namespace):
    table = f"{namespace}.txn"
    op.ingest_batch(envelopes(spark, txn(1), txn(2)), TRANSACTIONS, table)
    later = envelopes(spark, txn(3), txn(4)).withColumn("timestamp", F.expr("timestamp + INTERVAL 1 DAY"))
    assert op.ingest_batch(later, TRANSACTIONS, table) == 2
    assert op.ingest_batch(later, TRANSACTIONS, table) == 0
    unstamped = envelopes(spark, txn(5)).withColumn("timestamp", F.lit(None).cast("timestamp"))
    assert [op.ingest_batch(unstamped, TRANSACTIONS, table) for _ in range(2)] == [1, 0]


def test_known_messages_are_left_out_before_parsing(spark, namespace):
    env = envelopes(spark, txn(1))
    op.ingest_batch(env, TRANSACTIONS, f"{namespace}.txn")
    plan = op.parse_envelopes(op.unseen(env, spark.table(f"{namespace}.txn")), TRANSACTIONS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("from_json") < plan.index("LeftAnti")  # plans are printed from the top


def test_resume_offsets(spark):
    held = op.parse_envelopes(envelopes(spark, txn(1), txn(2), txn(3), txn(4)), TRANSACTIONS)  # partition 0: 0, 2; 1: 1, 3
    assert json.loads(resume_offsets(held, TOPIC)) == {TOPIC: {"0": -2, "1": -2}}
    whole = held.withColumns({"kafka_partition": F.lit(0), "kafka_offset": F.col("kafka_offset") + 5})
    assert json.loads(resume_offsets(whole, TOPIC)) == {TOPIC: {"0": 9}}
    assert resume_offsets(held, "another") == "earliest"


def test_a_topic_made_anew_is_read_whole(spark, namespace):
    table = f"{namespace}.bronze"
    assert starting_offsets(spark, table, TOPIC, same_topic=True) == starting_offsets(spark, table, TOPIC) == "earliest"
    one_partition = lambda df: df.withColumn("partition", F.lit(0))
    assert op.ingest_batch(one_partition(envelopes(spark, *(txn(i) for i in range(4)))), TRANSACTIONS, table) == 4
    anew = one_partition(envelopes(spark, *(txn(i) for i in range(10, 16)))).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))

    def messages(start):
        return anew if start == "earliest" else anew.where(F.col("offset") >= json.loads(start)[TOPIC]["0"])

    assert messages(starting_offsets(spark, table, TOPIC, same_topic=True)).count() == 2  # the caller was wrong
    assert op.ingest_batch(messages(starting_offsets(spark, table, TOPIC)), TRANSACTIONS, table) == 6
    assert op.ingest_batch(messages(starting_offsets(spark, table, TOPIC)), TRANSACTIONS, table) == 0


class Reader:
    """Records what a reader is asked for."""

    def format(self, name):
        self.name = name
        return self

    def options(self, **given):
        self.given = given
        return self

    def load(self):
        return self


def test_kafka_options():
    session = type("Session", (), {"read": Reader(), "readStream": Reader()})()
    batch = read_envelopes(session, "t", options={"kafka.bootstrap.servers": "b:1", "startingOffsets": "latest"}, skip_lost=True)
    assert batch.name == "kafka" and batch.given == {
        "kafka.bootstrap.servers": "b:1", "startingOffsets": "latest", "failOnDataLoss": "false", "subscribe": "t",
    }
    stream = stream_envelopes(session, "t", per_batch=7)
    assert stream.given == {
        "startingOffsets": "earliest", "failOnDataLoss": "true", "subscribe": "t", "maxOffsetsPerTrigger": "7",
    }
    assert kafka_options("t", {"subscribe": "u"}, False)["subscribe"] == "t"
    with pytest.raises(TypeError):
        stream_envelopes(session, "t")


def numbered(spark, offsets, partition=0, days=0):
    """Messages of one partition with the given offsets, and times that only ``days`` moves."""
    made = [(f"K{n}", json.dumps(txn(n)), TOPIC, partition, n, datetime(2026, 4, 14 + days, 9, n % 60)) for n in offsets]
    return spark.createDataFrame(made, ENVELOPE_SCHEMA).coalesce(1)


def scans_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stretches_join_over_blocks_and_keep_gaps(spark, namespace, monkeypatch):
    monkeypatch.setattr(offset_index, "STRETCH", 10)
    table = f"{namespace}.txn"
    op.ingest_batch(numbered(spark, [*range(3, 35), *range(40, 42)]).unionByName(numbered(spark, [7], partition=1)), TRANSACTIONS, table)
    op.ingest_batch(numbered(spark, range(35, 40)), TRANSACTIONS, table)
    held = held_stretches(refreshed_index(spark, table)).collect()
    assert {(r["kafka_partition"], r["low"], r["high"], r["messages"]) for r in held} == {(0, 3, 41, 39), (1, 7, 7, 1)}
    assert spark.table(table).count() == 40


def test_a_known_stretch_costs_no_read_of_the_table(spark, namespace):
    table = f"{namespace}.txn"
    op.ingest_batch(numbered(spark, range(20)), TRANSACTIONS, table)
    again, further = offset_index.unseen_by_index(numbered(spark, range(30)), table), offset_index.unseen_by_index(numbered(spark, range(20, 30)), table)
    assert [again.count(), further.count()] == [10, 10]
    assert all("txn_id" not in scans_of(df) and "kafka_offset#" not in scans_of(df) for df in (again, further))
    half = offset_index.unseen_by_index(numbered(spark, range(10, 25)), table)  # compared one by one
    assert "kafka_offset#" in scans_of(half) and sorted(r["offset"] for r in half.collect()) == list(range(20, 25))


def test_mixed_batches_lose_and_repeat_nothing(spark, namespace):
    """Halves, repeats, a topic made anew and messages without a place, against a plain set of identities."""
    table, held = f"{namespace}.txn", set()
    lost = numbered(spark, range(3)).withColumn("offset", F.lit(None).cast("long"))
    old, anew = numbered(spark, range(40)), numbered(spark, range(25), days=5)
    for batch in (
        old.where("offset < 10 OR offset > 30"), old, anew.where("offset % 2 = 0"), old.unionByName(anew).unionByName(lost), lost.unionByName(anew),
        numbered(spark, range(60), partition=1), numbered(spark, range(0, 80, 3), partition=1).unionByName(old), old.limit(0),
    ):
        new = {(r["partition"], r["offset"], r["timestamp"]) for r in batch.collect()} - held
        assert op.ingest_batch(batch, TRANSACTIONS, table) == len(new)
        held |= new
    found = [(r["kafka_partition"], r["kafka_offset"], r["kafka_timestamp"]) for r in spark.table(table).collect()]
    assert set(found) == held and len(found) == len(held)


def test_broken_offsets_meet_few_stretches(spark, namespace):
    """However broken the offsets of a file are, few of its stretches share a key to join by, and a long one has few keys."""
    ends = spark.range(5000).select(
        F.lit(TOPIC).alias("kafka_topic"), F.lit(0).alias("kafka_partition"), (F.col("id") * 4).alias("low"), (F.col("id") * 4 + F.col("id") % 3).alias("high")
    ).unionByName(spark.sql(f"SELECT '{TOPIC}' AS kafka_topic, 0 AS kafka_partition, 30000L AS low, 1030000L AS high"))
    spread = offset_index._spread(ends)
    assert spread.groupBy("_topic", "_partition", "_size", "_block").count().agg(F.max("count")).first()[0] <= 33
    assert spread.where("low = 30000").count() <= 2

    table = f"{namespace}.txn"
    offsets = [*range(0, 2000, 4), *range(3000, 3040), *range(4000, 7000)]
    assert op.ingest_batch(numbered(spark, offsets), TRANSACTIONS, table) == len(offsets)
    assert op.ingest_batch(numbered(spark, offsets), TRANSACTIONS, table) == 0
    assert op.ingest_batch(numbered(spark, range(7100)), TRANSACTIONS, table) == 7100 - len(offsets)
    assert spark.table(table).select("kafka_offset").distinct().count() == spark.table(table).count() == 7100


def test_a_crash_before_the_index_is_written_repeats_nothing(spark, namespace):
    table = f"{namespace}.txn"
    op.ingest_batch(numbered(spark, range(5)), TRANSACTIONS, table)
    op.ingest_batch(numbered(spark, range(5)), TRANSACTIONS, table)  # the index exists now
    append(op.parse_envelopes(numbered(spark, range(5, 9)), TRANSACTIONS), table)  # and knows nothing of this
    assert op.ingest_batch(numbered(spark, range(12)), TRANSACTIONS, table) == 3


def test_indexed_offsets_resume_and_notice_a_topic_made_anew(spark, namespace, tmp_path):
    table, path = f"{namespace}.txn", str(tmp_path / "messages")
    reading = {"fmt": "parquet", "path": path}
    numbered(spark, [*range(10), *range(12, 15)]).write.parquet(path)
    start = lambda **more: indexed_offsets(spark, table, TOPIC, **reading, **more)
    read = lambda **more: read_envelopes(spark, TOPIC, options={"startingOffsets": start(**more)}, **reading)
    assert start() == "earliest" and op.ingest_batch(read(), TRANSACTIONS, table) == 13
    assert json.loads(start()) == {TOPIC: {"0": 10}} and json.loads(start(gaps_are_final=True)) == {TOPIC: {"0": 15}}
    numbered(spark, range(15, 18)).unionByName(numbered(spark, range(4), partition=1)).write.mode("append").parquet(path)
    assert sorted(r["offset"] for r in read(gaps_are_final=True).where("partition = 0").collect()) == [15, 16, 17]
    assert op.ingest_batch(read(gaps_are_final=True), TRANSACTIONS, table) == 7
    assert read(gaps_are_final=True).count() == 0 and op.ingest_batch(read(), TRANSACTIONS, table) == 0
    numbered(spark, range(30), days=3).write.mode("overwrite").parquet(path)  # made anew, and longer than before
    assert json.loads(start(partitions=[0, 1, 5])) == {TOPIC: {"0": -2, "1": -2, "5": -2}}
    assert op.ingest_batch(read(), TRANSACTIONS, table) == 30 and spark.table(table).count() == 50
    # two incarnations overlap now; the later one's message is where the stretches end
    assert op.ingest_batch(read(gaps_are_final=True), TRANSACTIONS, table) == 0


def test_probe_options_for_kafka():
    session = type("Session", (), {"read": Reader(), "readStream": Reader()})()
    found = messages_at(session, "t", {0: 5, 3: 9}, options={"kafka.bootstrap.servers": "b:1"})
    assert json.loads(found.given["startingOffsets"]) == {"t": {"0": 5, "3": 9}} and found.given["failOnDataLoss"] == "false"
    assert json.loads(found.given["endingOffsets"]) == {"t": {"0": 6, "3": 10}}


def test_keyed_state_keeps_each_key_once(spark, namespace, tmp_path, capfd):
    """Restarts, late rows, rows without a key; no micro-batch reads the table."""
    messages, table = str(tmp_path / "messages"), f"{namespace}.txn"

    def run():
        stream = stream_envelopes(spark, TOPIC, per_batch=1, fmt="parquet", path=messages)
        query = ingest_stream(stream, TRANSACTIONS, table, str(tmp_path / "c"), available_now=True, keyed_state=True)
        query.awaitTermination()
        return query

    late = envelopes(spark, txn(9), start=50).withColumn("timestamp", F.expr("timestamp - INTERVAL 300 DAYS"))
    for part in (envelopes(spark, txn(1), txn(2), txn(1), "{bad"), late, envelopes(spark, txn(2), txn(3), "{bad", start=20)):
        part.coalesce(1).write.mode("append").parquet(messages)
        run()
    run()
    ids = [r["txn_id"] for r in spark.table(table).collect()]
    assert sorted(i for i in ids if i) == ["TXN000001", "TXN000002", "TXN000003", "TXN000009"] and ids.count(None) == 2
    envelopes(spark, txn(9), txn(4), start=90).unionByName(envelopes(spark, txn(1), txn(2), txn(1), "{bad")).coalesce(1).write.mode("append").parquet(messages)
    query = run()
    query.explain()
    plan = capfd.readouterr().out
    assert "StreamingDeduplicate" in plan and "Join" not in plan and plan.count("Scan") == 1
    ids = [r["txn_id"] for r in spark.table(table).collect()]
    assert len(ids) == 7 and ids.count(None) == 2  # the malformed message came again
    with pytest.raises(ValueError, match="written by a stream"):
        op.ingest_batch(late, TRANSACTIONS, table)
    with pytest.raises(ValueError, match="choose one"):
        ingest_stream(None, TRANSACTIONS, table, "c", keyed_state=True, new_keys_only=True)


def test_empty_batch_changes_nothing(spark, namespace):
    table = f"{namespace}.txn"
    empty = spark.createDataFrame([], ENVELOPE_SCHEMA)
    assert op.ingest_batch(empty, TRANSACTIONS, table) == 0
    assert not spark.catalog.tableExists(table)


def test_stream_equals_batch_and_restarts(spark, namespace, tmp_path):
    messages, checkpoint = str(tmp_path / "messages"), str(tmp_path / "checkpoint")
    env = envelopes(spark, txn(1), "{bad", txn(2, amount="abc"))
    env.write.parquet(messages)
    envelopes(spark, {"alert_id": "A1"}, topic="aml-alerts").write.mode("append").parquet(messages)

    def run(table):
        stream = stream_envelopes(spark, TOPIC, per_batch=5, fmt="parquet", path=messages)
        ingest_stream(stream, TRANSACTIONS, table, checkpoint, available_now=True).awaitTermination()

    streamed, batch = f"{namespace}.streamed", f"{namespace}.batch"
    run(streamed)
    op.ingest_batch(read_envelopes(spark, TOPIC, fmt="parquet", path=messages), TRANSACTIONS, batch)
    drop = "_ingestion_ts"
    by_offset = lambda t: spark.table(t).drop(drop).orderBy("kafka_offset").collect()
    assert by_offset(streamed) == by_offset(batch) and len(by_offset(streamed)) == 3
    run(streamed)
    assert spark.table(streamed).count() == 3
    envelopes(spark, txn(7), start=10).write.mode("append").parquet(messages)
    run(streamed)
    assert spark.table(streamed).count() == 4
    with pytest.raises(ValueError, match="written by a stream"):
        op.ingest_batch(env, TRANSACTIONS, streamed)


def test_several_topics(spark, namespace, tmp_path):
    messages = str(tmp_path / "messages")
    envelopes(spark, txn(1), txn(2)).write.parquet(messages)
    envelopes(spark, {"alert_id": "A1", "risk_score": 77}, topic="aml-alerts").write.mode("append").parquet(messages)
    topics = {t: TOPICS[t] for t in (TOPIC, "aml-alerts")}
    queries = ingest_topics(
        lambda t: stream_envelopes(spark, t, per_batch=5, fmt="parquet", path=messages), topics, namespace,
        str(tmp_path / "checkpoints"), available_now=True,
    )
    await_any(spark, 60)
    for q in queries:
        q.awaitTermination()
    assert spark.table(f"{namespace}.{TRANSACTIONS.bronze_table}").count() == 2
    assert spark.table(f"{namespace}.{AML_ALERTS.bronze_table}").first()["risk_score"] == "77"
    assert {p.name for p in (tmp_path / "checkpoints").iterdir()} == set(topics)


def test_stream_dedup_writes_its_messages_by_many_tasks(spark, namespace, tmp_path, monkeypatch):
    folder, shared = str(tmp_path / "tables"), str(tmp_path / "shared")
    spark.range(400).selectExpr(
        "id AS event_id", "timestamp_ntz'2026-04-14 09:00:00' AS ts", "id % 7 AS user_id"
    ).repartition(4).write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(queries, "_namespace", lambda spark, purpose: (namespace, shared))
    found = queries.QUERIES["stream_dedup"](spark, folder)
    assert found.count() == found.select("txn_id").distinct().count() == 408
    assert spark.read.parquet(f"{shared}/_messages").where("partition = 0").select("_metadata.file_name").distinct().count() > 1


def test_stream_of_new_keys_loses_nothing(spark, namespace, tmp_path):
    messages, table = str(tmp_path / "messages"), f"{namespace}.txn"
    late = envelopes(spark, txn(9), start=50).withColumn("timestamp", F.expr("timestamp - INTERVAL 300 DAYS"))
    for part in (
        envelopes(spark, txn(1), txn(2), txn(1), "{bad"), envelopes(spark, txn(2), txn(3), start=20),
        late.unionByName(envelopes(spark, txn(1), "{bad", start=30)),
    ):
        part.coalesce(1).write.mode("append").parquet(messages)

    def run():
        stream = stream_envelopes(spark, TOPIC, per_batch=1, fmt="parquet", path=messages)
        ingest_stream(
            stream, TRANSACTIONS, table, str(tmp_path / "c"), available_now=True, new_keys_only=True
        ).awaitTermination()

    run()
    run()
    ids = [r["txn_id"] for r in spark.table(table).collect()]
    assert sorted(i for i in ids if i) == ["TXN000001", "TXN000002", "TXN000003", "TXN000009"]
    assert ids.count(None) == 2  # malformed messages are all kept
    assert op.ingest_batch(envelopes(spark, txn(7), start=70), TRANSACTIONS, table) == 1


def test_parsed_stream_to_another_sink(spark, tmp_path):
    messages = str(tmp_path / "messages")
    envelopes(spark, txn(1), txn(2)).write.parquet(messages)
    parsed = op.parse_envelopes(stream_envelopes(spark, TOPIC, per_batch=5, fmt="parquet", path=messages), TRANSACTIONS)
    query = parsed.writeStream.format("memory").queryName("shown").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("shown").count() == 2


def test_envelope_files_round_trip(spark, tmp_path):
    path = str(tmp_path / "envelopes")
    df = rows(spark, CUSTOMERS, {"customer_id": "C1", "name": 'A "quoted", name'}, {"customer_id": "C2", "email": ""})
    env = to_envelopes(df, CUSTOMERS.topic, CUSTOMERS.key)
    assert json.loads(env.filter("key = 'C2'").first()["value"])["nominee_name"] is None
    write_envelopes(env, fmt="parquet", path=path)
    write_envelopes(env, fmt="parquet", path=path)
    back = read_envelopes(spark, CUSTOMERS.topic, fmt="parquet", path=path)
    assert back.count() == 4
    assert back.select("topic", "partition", "offset").distinct().count() == 4
    parsed = op.parse_envelopes(back, CUSTOMERS).select(*CUSTOMERS.columns).distinct()
    assert {tuple(r) for r in parsed.collect()} == {tuple(r) for r in df.collect()}
    assert read_envelopes(spark, TOPIC, fmt="parquet", path=path).count() == 0


def test_missing_key_column_and_preview(spark):
    df = spark.createDataFrame([("x" * 500,), ("y",), ("z",), ("w",)], "v string").coalesce(1)
    env = to_envelopes(df, "t", "no_such_column")
    assert [r["key"] for r in env.collect()] == ["row_0", "row_1", "row_2", "row_3"]
    shown = preview(env).collect()
    assert len(shown) == 3 and max(len(r["value"]) for r in shown) == 200


def test_csv_extract(spark, tmp_path):
    path = str(tmp_path / "raw" / "2026" / "04" / "14")
    df = rows(spark, AML_ALERTS,
              {"alert_id": "A1", "transaction_ids": "T1,T2", "risk_score": "92", "description": ' said "no" '},
              {"alert_id": "A2", "risk_score": "high", "total_amount": "5"})
    write_extract(df, path)
    raw = by_key(read_extract(spark, AML_ALERTS, path), "alert_id")
    assert raw["A1"]["transaction_ids"] == "T1,T2" and raw["A1"]["description"] == ' said "no" '
    assert raw["A2"]["sar_reference"] is None
    text = by_key(read_extract(spark, AML_ALERTS, path, blank_as_text=True), "alert_id")
    assert text["A2"]["sar_reference"] == ""
    typed = by_key(read_extract(spark, AML_ALERTS, path, typed=True), "alert_id")
    assert (typed["A1"]["risk_score"], typed["A2"]["risk_score"]) == (92, None)
    assert str(typed["A2"]["total_amount"]) == "5.00"
    deep = read_extract(spark, AML_ALERTS, str(tmp_path / "raw"), recursive=True, name_filter="*.csv")
    assert deep.count() == 2


def test_csv_with_line_ends_in_values(spark, tmp_path, namespace):
    path = str(tmp_path / "lines")
    given = rows(spark, AML_ALERTS, {"alert_id": "A1", "description": "one\ntwo"}, {"alert_id": "A2", "risk_score": "7"})
    write_extract(given, path)
    back = by_key(read_extract(spark, AML_ALERTS, path), "alert_id")
    assert set(back) == {"A1", "A2"} and back["A1"]["description"] == "one\ntwo"
    with pytest.raises(Exception, match="(?i)malformed"):
        read_extract(spark, AML_ALERTS, path, multiline=False).collect()
    table = f"{namespace}.alerts"
    assert op.ingest_extract(spark, AML_ALERTS, path, table) == 2
    empty = str(tmp_path / "empty")
    write_extract(given.filter("false"), empty)
    assert op.ingest_extract(spark, AML_ALERTS, empty, f"{namespace}.none") == 0
    assert not spark.catalog.tableExists(f"{namespace}.none")
    assert {r["_source"] for r in spark.table(table).collect()} == {"csv"}


def test_csv_with_other_header_fails(spark, tmp_path):
    path = tmp_path / "other.csv"
    header = ",".join(reversed(AML_ALERTS.columns))
    path.write_text(header + "\n" + ",".join("x" for _ in AML_ALERTS.columns) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_extract(spark, AML_ALERTS, str(path)).collect()


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    write_json_lines(rows(spark, AML_ALERTS, {"alert_id": "A1"}), path)
    line = spark.read.text(path).first()[0]
    assert json.loads(line)["alert_id"] == "A1" and "sar_filed" in json.loads(line)


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(base) and scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_sizing():
    assert [shuffle_partitions(n) for n in (0, 100 << 30, 100 << 40)] == [200, 400, 50_000]
    assert [scan_bytes(n) for n in (0, 10 << 40, 200 << 40)] == [128 << 20, 128 << 20, 1 << 30]
    assert 100_000 <= (100 << 40) / scan_bytes(100 << 40) < 110_000
