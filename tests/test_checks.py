"""Fingerprints, contracts, rejected messages, publishes that stop half-way, counts of writes, planning time."""

import time

import pytest
from pyspark.sql import functions as F, types as T

from ledgerlake import operators as op
from ledgerlake.plans import fingerprints as fp, quality
from ledgerlake.sinks import ContractError, append, conforming, contract_actions, publish
from ledgerlake.sinks.publish import LOG_TABLE, RUN_PROPERTY
from ledgerlake.specs import TRANSACTIONS

from data import txn
from test_bronze_and_streams import TOPIC, envelopes, numbered


def keyed(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_an_exchanged_key_is_named(spark, buckets):
    left = keyed(spark, [f"K{i}" for i in range(500)] + ["K3"] * 200 + [None, " "])
    right = keyed(spark, [f"K{i}" for i in range(500) if i != 77] + ["stranger"])
    found = {tuple(r) for r in fp.key_differences(left, "k", right, "k", buckets).collect()}
    assert found == {("K77", True, False), ("stranger", False, True)}
    row = quality.reconciliation({"e": (left, right, "k")}).first()
    assert (row["bronze_rows"], row["bronze_keys"], row["silver_rows"], row["matches"]) == (702, 500, 500, False)


def test_equal_and_repeated_and_empty_keys(spark):
    left, right = keyed(spark, ["a", "b", "b", None]), keyed(spark, ["b", "a"])
    assert quality.reconciliation({"e": (left, right, "k")}).first()["matches"]
    assert not quality.reconciliation({"e": (left, keyed(spark, ["a", "b", "b"]), "k")}).first()["matches"]  # silver repeats a key
    none = keyed(spark, [])
    assert tuple(quality.reconciliation({"e": (none, none, "k")}).first()) == ("e", 0, 0, 0, True)
    assert fp.key_differences(none, "k", right, "k").count() == 2 and fp.key_differences(left, "k", right, "k").count() == 0


def test_only_differing_buckets_are_looked_into(spark):
    left, right = keyed(spark, [f"K{i}" for i in range(300)]), keyed(spark, [f"K{i}" for i in range(299)])
    compared = fp.compared_fingerprints(fp.key_fingerprints(left, "k", 64), fp.key_fingerprints(right, "k", 64))
    assert compared.where("NOT agree").count() == 1 and compared.where("agree").count() >= 60


CONTRACT = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("amount", T.DecimalType(20, 4)),
    T.StructField("day", T.TimestampNTZType()), T.StructField("note", T.StringType()),
])


def test_contract_widens_fills_and_orders(spark):
    given = spark.range(3).select(F.lit("2026-01-02").cast("date").alias("day"), F.col("id").cast("int"), F.lit("1.50").cast("decimal(10,2)").alias("amount"))
    assert [a for *_, a in contract_actions(given, CONTRACT)] == ["widened", "widened", "widened", "filled"]
    out = conforming(given, CONTRACT)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in CONTRACT.fields] and out.columns == CONTRACT.names
    assert str(out.first()["amount"]) == "1.5000" and out.first()["note"] is None


@pytest.mark.parametrize("change", [
    lambda df: df.withColumn("more", F.lit(1)), lambda df: df.drop("id"), lambda df: df.withColumn("amount", F.lit(1.5)),
    lambda df: df.withColumn("amount", F.lit("1").cast("decimal(30,4)")), lambda df: df.withColumn("id", F.col("id").cast("string")),
])
def test_contract_refuses_before_anything_is_written(spark, namespace, change):
    good = spark.range(3).select("id", F.lit("1").cast("decimal(20,4)").alias("amount"))
    append(good, f"{namespace}.t", contract=CONTRACT)
    publish(good, f"{namespace}.p", contract=CONTRACT)
    tables = {t.name for t in spark.catalog.listTables(namespace)}
    for write in (lambda: append(change(good), f"{namespace}.t", contract=CONTRACT), lambda: publish(change(good), f"{namespace}.p", contract=CONTRACT)):
        with pytest.raises(ContractError):
            write()
    assert spark.table(f"{namespace}.t").count() == 3 and {t.name for t in spark.catalog.listTables(namespace)} == tables


def test_a_null_that_the_contract_forbids_fails_the_write(spark, namespace):
    rows = spark.range(3).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))
    with pytest.raises(Exception, match="id is NULL"):
        append(rows, f"{namespace}.t", contract=CONTRACT)


def test_counts_come_from_the_files(spark, namespace):
    table = f"{namespace}.t"
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("m"))
    assert append(df, table, ["m"]) == 1000 and append(df.limit(0), table, ["m"]) == 0
    assert append(df.where("m = 3"), table, ["m"]) == 143 and spark.table(table).count() == 1143
    assert append(df, f"{namespace}.j", fmt="json") == 1000 and append(df, f"{namespace}.j", fmt="json") == 1000
    assert publish(df, f"{namespace}.p", partition_by=["m"]).rows == 1000
    # whatever else an evaluation counted, the files say what is there
    twice = df.unionByName(df).dropDuplicates(["id"])
    assert append(twice, f"{namespace}.d") == spark.table(f"{namespace}.d").count() == 1000


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["_create_run_table", "rows_in", "_logged"])
def test_a_publish_that_stops_leaves_nothing_behind(spark, namespace, monkeypatch, step):
    """Stopped before the write, between the write and the switch, and between the switch and the log."""
    import sys

    module = sys.modules["ledgerlake.sinks.publish"]
    table = f"{namespace}.t"
    publish(spark.range(3), table, run_id="one")
    real = getattr(module, step)

    def stop(*given, **more):
        if step == "_create_run_table":
            real(*given, **more)
        raise Stop

    with monkeypatch.context() as m:
        m.setattr(module, step, stop)
        with pytest.raises(Stop):
            publish(spark.range(5), table, run_id="two")
    assert spark.table(table).count() == (5 if step == "_logged" else 3)
    assert quality.layer_tables(spark, namespace) == ["t"]  # no table of a run is taken for a user's
    publish(spark.range(7), table, run_id="three")
    publish(spark.range(9), table, run_id="four")
    assert spark.table(table).count() == 9
    log = {r["run_id"]: r["row_count"] for r in spark.table(f"{namespace}.{LOG_TABLE}").collect()}
    assert log == {"one": 3, "three": 7, "four": 9} | ({"two": 5} if step == "_logged" else {})
    runs = {t.name for t in spark.catalog.listTables(namespace, "t__*")}
    assert runs == {"t__three", "t__four"}
    assert spark.sql(f"SHOW TBLPROPERTIES {namespace}.t__four ('{RUN_PROPERTY}')").first()["value"] == "t"


def test_rejected_messages_keep_their_value_and_go_once(spark, namespace):
    good, bad = f"{namespace}.good", f"{namespace}.bad"
    batch = envelopes(spark, txn(1), "{bad", "", "  ", '{"other": 1}', "[1, 2]", txn(2, amount="abc"), '"text"', "null").unionByName(
        envelopes(spark, txn(9)).select(*[F.lit(None).cast("string").alias("value") if c == "value" else F.col(c) for c in ("key", "value", "topic")],
                                        "partition", (F.col("offset") + 90).alias("offset"), "timestamp"))
    assert op.ingest_batch(batch, TRANSACTIONS, good, rejects=bad) == 2
    found = {r["kafka_offset"]: (r["value"], r["reason"]) for r in spark.table(bad).collect()}
    assert found[1] == ("{bad", "malformed") and found[2] == ("", "no value") and found[90] == (None, "no value")
    assert found[4] == ('{"other": 1}', "no known field") and len(found) == 8 and found[7][0] == '"text"'
    assert op.ingest_batch(batch, TRANSACTIONS, good, rejects=bad) == 0 and spark.table(bad).count() == 8
    assert {r["txn_id"] for r in spark.table(good).collect()} == {"TXN000001", "TXN000002"}


def test_a_crash_between_the_two_tables_repeats_nothing(spark, namespace, monkeypatch):
    import sys

    module = sys.modules["ledgerlake.operators.bronze"]
    good, bad = f"{namespace}.good", f"{namespace}.bad"
    real = module.append

    def only_rejects(df, table, *more):
        if table == good:
            raise Stop
        return real(df, table, *more)

    batch = envelopes(spark, txn(1), "{bad", txn(2))
    with monkeypatch.context() as m:
        m.setattr(module, "append", only_rejects)
        with pytest.raises(Stop):
            op.ingest_batch(batch, TRANSACTIONS, good, rejects=bad)
    assert op.ingest_batch(batch, TRANSACTIONS, good, rejects=bad) == 2
    assert spark.table(bad).count() == 1 and spark.table(good).count() == 2


def test_silver_over_parsed_messages_is_planned_quickly(spark):
    started = time.perf_counter()
    silver = op.silver_transactions(op.parse_envelopes(envelopes(spark, txn(1)), TRANSACTIONS))
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - started < 15  # it took 40 s and a gigabyte where fields were expressions
    assert plan.count("from_json") == 1


def test_numbered_messages_of_another_topic(spark, namespace):
    table = f"{namespace}.t"
    other = numbered(spark, range(4)).withColumn("topic", F.lit("another"))
    assert [op.ingest_batch(b, TRANSACTIONS, table) for b in (numbered(spark, range(4)), other, other)] == [4, 4, 0]
    assert spark.table(table).where(F.col("kafka_topic") == TOPIC).count() == 4
