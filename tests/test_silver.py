import re
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import operators as op
from ledgerlake.operators.dedup import as_one_text, texts_of
from ledgerlake.plans.quality import contract_differences
from ledgerlake.rules import Rules
from ledgerlake.specs import AML_ALERTS, BUREAU, CUSTOMERS, LMS_LOANS, NPA_REPORT, TRANSACTIONS

from data import by_key, rows, txn


def silver(spark, *records, **options):
    return by_key(op.silver_transactions(rows(spark, TRANSACTIONS, *records), **options), "txn_id")


def test_types_and_derived_columns(spark):
    r = silver(spark, txn(1, amount="250000.00", status="FLAGGED"))["TXN000001"]
    assert r["amount"] == Decimal("250000.00") and r["balance_after"] == Decimal("5000.00")
    assert r["txn_date"] == datetime(2026, 4, 14, 9, 15, 30)
    assert (r["txn_month"], r["txn_hour"]) == ("2026-04", 9)
    assert r["is_high_value"] is True and r["is_flagged"] is True
    assert r["ingestion_ts"] is not None


def test_high_value_boundary(spark):
    got = silver(spark, txn(1, amount="199999.99"), txn(2, amount="200000.00"), txn(3, amount="abc"))
    assert [got[f"TXN00000{i}"]["is_high_value"] for i in (1, 2, 3)] == [False, True, False]
    raised = silver(spark, txn(1, amount="200000.00"), rules=Rules(high_value_min=300_000))
    assert raised["TXN000001"]["is_high_value"] is False


def test_unknown_status_is_neither_flagged_nor_not(spark):
    got = silver(spark, txn(1, status=None), txn(2, status=" "), txn(3))
    assert [got[f"TXN00000{i}"]["is_flagged"] for i in (1, 2, 3)] == [None, None, False]


def test_bad_values_become_null(spark):
    r = silver(spark, txn(1, amount="", txn_date="xx", customer_id="  "))["TXN000001"]
    assert [r[c] for c in ("amount", "txn_date", "txn_month", "txn_hour", "customer_id")] == [None] * 5


def test_rows_without_key_are_dropped(spark):
    assert set(silver(spark, txn(1), txn(2, txn_id=None), txn(3, txn_id=" "))) == {"TXN000001"}


def test_latest_duplicate_survives(spark):
    early, late = datetime(2026, 4, 14), datetime(2026, 4, 15)
    records = [
        txn(1, status="SUCCESS", _ingestion_ts=early, kafka_offset=9),
        txn(1, status="FLAGGED", _ingestion_ts=late, kafka_offset=3),
        txn(1, status="FAILED", _ingestion_ts=late, kafka_offset=2),
    ]
    for order in (records, records[::-1], records[1:] + records[:1]):
        bronze = rows(spark, TRANSACTIONS, *order, extra="_ingestion_ts timestamp, kafka_offset bigint")
        assert op.silver_transactions(bronze.repartition(3)).first()["status"] == "FLAGGED"


def test_ties_are_decided_by_the_other_columns(spark):
    records = [txn(1, narration=text) for text in ("b", "c", "a")]
    for order in (records, records[::-1]):
        bronze = rows(spark, TRANSACTIONS, *order).repartition(3)
        assert op.silver_transactions(bronze).first()["narration"] == "c"


def test_hot_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    kept = op.latest_per_key(hot, "k", [F.col("v").desc()])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning") > plan.index("Final")
    assert kept.count() == 20_001
    assert kept.filter("k = 'HOT'").first()["v"] == 29_997


def test_customers_are_masked(spark):
    base = {"pan": "ABCPK1234A", "mobile": "9876543210", "annual_income": "1200000"}
    got = by_key(op.silver_customers(rows(
        spark, CUSTOMERS,
        {**base, "customer_id": "C1", "email": "a@b.example"},
        {**base, "customer_id": "C2", "email": "noat", "annual_income": "n/a"},
        {**base, "customer_id": "C3", "email": "", "pan": "AB"},
    )), "customer_id")
    assert (got["C1"]["pan"], got["C1"]["mobile"]) == ("XXXXX1234A", "XXXXXX3210")
    assert [got[c]["email"] for c in ("C1", "C2", "C3")] == ["***@b.example", "***", None]
    assert got["C3"]["pan"] == "XXXXX"
    assert [got[c]["annual_income"] for c in ("C1", "C2")] == [Decimal("1200000.00"), None]


def test_loans_from_the_npa_report(spark):
    def loan(n, **f):
        return {
            "loan_id": f"L{n}", "outstanding_principal": "4500000.00", "dpd": "45",
            "collateral_value": "7500000.00", "provision_required_pct": "0.40", **f,
        }

    got = by_key(op.silver_loans(rows(
        spark, NPA_REPORT, loan(1), loan(2, collateral_value="0.00"), loan(3, collateral_value=None),
        loan(4, outstanding_principal="abc"), loan(5, outstanding_principal="8000000", collateral_value="15000000"),
    )), "loan_id")
    assert [got[f"L{i}"]["ltv_ratio"] for i in range(1, 6)] == [
        Decimal("60.00"), None, None, None, Decimal("53.33"),
    ]
    assert got["L1"]["interest_rate"] == Decimal("0.40") and got["L1"]["dpd"] == 45


def test_loans_from_the_loan_system(spark):
    r = op.silver_loans(rows(spark, LMS_LOANS, {
        "loan_id": "L1", "interest_rate": "8.50", "outstanding_principal": "100", "collateral_value": "95.24",
        "last_payment_date": "2026-04-01", "next_due_date": "2026-05-01",
    }), "lms").first()
    assert r["interest_rate"] == Decimal("8.50") and r["ltv_ratio"] == Decimal("105.00")
    assert (r["last_payment_date"], r["next_due_date"]) == ("2026-04-01", "2026-05-01")
    with pytest.raises(ValueError):
        op.silver_loans(rows(spark, LMS_LOANS), "other")


def test_bureau_and_alerts(spark):
    b = op.silver_bureau(rows(spark, BUREAU, {
        "report_id": "R1", "pan": "ABCPK1234A", "cibil_score": "782", "total_outstanding": "4520000.00",
        "credit_utilization_pct": "x",
    })).first()
    assert (b["cibil_score"], b["pan"], b["credit_utilization_pct"]) == (782, "XXXXX1234A", None)
    a = op.silver_aml_alerts(rows(spark, AML_ALERTS, {
        "alert_id": "A1", "risk_score": "92", "total_amount": "2200000.00", "assigned_to": "",
    })).first()
    assert (a["risk_score"], a["total_amount"], a["assigned_to"]) == (92, Decimal("2200000.00"), None)


def test_every_entity_is_deduplicated(spark):
    for spec, build in (
        (CUSTOMERS, op.silver_customers), (NPA_REPORT, op.silver_loans), (BUREAU, op.silver_bureau),
        (AML_ALERTS, op.silver_aml_alerts),
    ):
        twice = rows(spark, spec, {spec.key: "K1"}, {spec.key: "K1"}, {spec.key: "K2"}, {spec.key: None})
        assert build(twice).count() == 2


def test_transaction_contract(spark):
    df = op.silver_transactions(rows(spark, TRANSACTIONS))
    expected = T.StructType(TRANSACTIONS.typed_schema.fields + T.StructType.fromDDL(
        "ingestion_ts timestamp, txn_month string, txn_hour int, is_high_value boolean, is_flagged boolean"
    ).fields)
    differing = lambda given: [
        tuple(r)[:3] for r in contract_differences(given, expected).filter("not agrees").collect()
    ]
    assert differing(df) == []
    assert differing(df.withColumn("amount", F.lit("1"))) == [("amount", "decimal(18,2)", "string")]
    assert differing(df.drop("status").withColumn("new", F.lit(1))) == [("status", "string", None), ("new", None, "int")]


def test_one_text_sorts_and_ends_as_its_columns(spark):
    odd = [None, "a", "ab", "a\0", "a\1", "a\1\1", "a\1\2", "a\2", "\0", "\1", "\0\0b", "é", "\U0001f600", "b \t"]
    values = spark.createDataFrame([(x,) for x in odd], "v string").unionByName(
        spark.range(1).selectExpr("cast(unhex('61FF00') as string) v")  # no UTF-8
    )
    pairs = values.selectExpr("v x").crossJoin(values.selectExpr("v y")).withColumn("k", F.lit("k"))
    bytes_of = lambda df: [tuple(r) for r in df.select(*[F.hex(c) for c in ("x", "y")]).collect()]
    one = pairs.select(as_one_text(["x", "y"]).alias("t"))
    wanted = bytes_of(pairs.orderBy(F.col("x").desc_nulls_last(), F.col("y").desc_nulls_last()))
    assert len(set(wanted)) == 15 ** 2
    assert bytes_of(texts_of(one.orderBy(F.col("t").desc()), "t", ["x", "y"])) == wanted


def test_columns_of_an_entity_are_shuffled_as_one_text(spark):
    bronze = rows(spark, NPA_REPORT, {"loan_id": "L1"}, extra="kafka_offset bigint")
    plan = spark._jvm.PythonSQLUtils.explainString(op.silver_loans(bronze)._jdf.queryExecution(), "formatted")
    widths = [int(n) for n in re.findall(r"\) Exchange\nInput \[(\d+)\]", plan)]
    assert widths == [4]  # the hash, the key, the offset and the text
