from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import skew
from ledgerlake.plans import aml, counts, customers, npa, transactions
from ledgerlake.rules import Rules
from ledgerlake.specs import AML_ALERTS, BUREAU, CUSTOMERS, NPA_REPORT, TRANSACTIONS

from data import rows, txn

SILVER = (
    "txn_id string, customer_id string, amount decimal(18,2), channel string, narration string, "
    "txn_date timestamp, is_flagged boolean, branch_code string, txn_type string, txn_hour int, txn_month string"
)
PEOPLE = "customer_id string, name string, risk_category string, kyc_status string"


def silver(spark, *records):
    return spark.createDataFrame([(
        r.get("id", f"T{i}"), r.get("c", "C1"), Decimal(r.get("a", "1.00")), r.get("ch", "CASH"), "n",
        r.get("d", datetime(2026, 4, 14, 9)), r.get("f", False), "BR001", "CREDIT", 9, r.get("m", "2026-04"),
    ) for i, r in enumerate(records)], SILVER)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(f"C{i}", f"N{i}", "LOW", "VERIFIED") for i in range(1, 6)], PEOPLE)


def test_data_quality(spark):
    bronze = rows(
        spark, TRANSACTIONS, txn(1), txn(2, amount=""), txn(3, amount="abc", txn_date="xx"),
        txn(4, customer_id=None), txn(5, customer_id=""),
    )
    assert tuple(transactions.data_quality(bronze).first()) == (5, 2, 1, 2)
    assert transactions.data_quality(bronze, blank_is_missing=False).first()["missing_customer"] == 1
    assert tuple(transactions.data_quality(bronze.limit(0)).first()) == (0, None, None, None)


def test_raw_reports_skip_bad_values_and_normalise(spark):
    bronze = rows(
        spark, TRANSACTIONS, txn(1, channel=" cash "), txn(2, channel="CASH", customer_id="C2"),
        txn(3, channel="CASH", amount="abc"), txn(4, channel="UPI", amount="9000", txn_date="xx"),
    )
    assert [tuple(r) for r in transactions.channel_distribution_raw(bronze).collect()] == [
        ("UPI", 1, Decimal("9000.00"), Decimal("9000.00"), 1),
        ("CASH", 2, Decimal("2000.00"), Decimal("1000.00"), 2),
    ]
    assert [tuple(r) for r in transactions.hourly_pattern_raw(bronze).collect()] == [(9, 2, Decimal("2000.00"))]
    top = transactions.branch_type_top_raw(bronze, k=1).collect()
    assert [tuple(r) for r in top] == [("BR001", "CREDIT", 3, Decimal("11000.00"), Decimal("9000.00"))]


def test_channel_share_sums_to_one(spark):
    got = transactions.channel_share(silver(spark, {"ch": "A"}, {"ch": "A"}, {"ch": "B"})).collect()
    assert [(r["channel"], r["pct_of_total"]) for r in got] == [("A", Decimal("66.67")), ("B", Decimal("33.33"))]


def test_month_bounds(spark):
    df = silver(
        spark, {"d": datetime(2026, 12, 1), "m": "2026-12"}, {"d": datetime(2026, 12, 31, 23, 59, 59), "m": "2026-12"},
        {"d": datetime(2027, 1, 1), "m": "2027-01"}, {"d": datetime(2026, 11, 30, 23), "m": "2026-11"},
    )
    assert tuple(transactions.month_total(df, "2026-12").first()) == (2, Decimal("2.00"))
    assert transactions.monthly_summary(df, "2026-12").first()["txn_count"] == 2


def test_flagged_detail_and_cash(spark, people):
    df = silver(spark, {"a": "5", "f": True}, {"a": "9", "f": True, "c": "C2"}, {"a": "7", "f": True, "c": "C9"},
                {"a": "1000000.00"}, {"a": "999999.99"}, {"a": "2000000", "ch": "NEFT"})
    assert [r["txn_id"] for r in aml.flagged_detail(df, people).collect()] == ["T1", "T0"]
    assert [r["txn_id"] for r in aml.high_value_cash(df, people).collect()] == ["T3"]
    lower = aml.high_value_cash(df, people, Rules(cash_report_min=900_000))
    assert [r["txn_id"] for r in lower.collect()] == ["T3", "T4"]


def test_structuring(spark, people):
    df = silver(spark, {"f": True, "a": "2"}, {"f": True, "a": "3"}, {"f": True, "c": "C2"}, {"c": "C2"})
    assert [tuple(r) for r in aml.structuring(df, people).collect()] == [("C1", "N1", "LOW", 2, Decimal("5.00"))]
    assert sorted(tuple(r) for r in aml.structuring_ids(df, people).collect()) == [("C1", "T0"), ("C1", "T1")]


def test_structuring_has_one_row_a_customer(spark, people):
    df = silver(spark, *[{"f": True, "c": "C1" if i % 3 else "C2"} for i in range(900)])
    assert [r["flagged_count"] for r in aml.structuring(df, people).collect()] == [600, 300]
    wanted = sorted((r["customer_id"], r["txn_id"]) for r in df.collect())
    for task_rows in (50, 400, 599, 600, 10_000):
        got = aml.structuring_ids(df, people, task_rows=task_rows).collect()
        assert sorted(tuple(r) for r in got) == wanted


def test_salts_follow_the_rows_of_a_key(spark):
    counts = spark.createDataFrame([("a", 99), ("b", 100), ("c", 101), ("d", 1000)], "k string, n bigint")
    heavy = {r["k"]: r["_salts"] for r in skew.heavy_keys(counts, "k", "n", F.lit(1300), 100).collect()}
    assert heavy == {"c": 2, "d": 10}
    # a hundred-thousandth of very many rows is more than the least size
    many = counts.withColumn("n", F.col("n") * 1_000_000_000)
    assert {r["k"]: r["_salts"] for r in skew.heavy_keys(many, "k", "n", F.lit(13 * 10**11), 100).collect()}["d"] == 76924


def test_raw_cash_keeps_unknown_customers(spark):
    bronze = rows(
        spark, TRANSACTIONS, txn(1, channel=" cash ", amount="1000000"), txn(2, channel="CASH", amount="3000000", customer_id="C404"),
        txn(3, channel="CASH", amount="2000000"), txn(4, channel="CASH", amount="abc"), txn(5, channel="UPI", amount="9000000"),
    )
    who = rows(spark, CUSTOMERS, {"customer_id": "CUST000001", "name": "A"}, {"customer_id": "CUST000001", "name": "B"})
    got = [(r["txn_id"], r["name"]) for r in aml.high_value_cash_raw(bronze, who).collect()]
    assert got == [("TXN000002", None), ("TXN000003", "A"), ("TXN000003", "B"), ("TXN000001", "A"), ("TXN000001", "B")]
    assert [r["txn_id"] for r in aml.high_value_cash_raw(bronze, who, k=2).collect()] == ["TXN000002", "TXN000003"]


def test_open_alerts(spark):
    alerts = rows(
        spark, AML_ALERTS, {"alert_id": "A1", "status": " open ", "risk_score": "80", "customer_id": "C1"},
        {"alert_id": "A2", "status": "OPEN", "risk_score": "high", "customer_name": "Given", "customer_id": "C1"},
        {"alert_id": "A3", "status": "CLOSED", "risk_score": "99"}, {"alert_id": "A4", "status": "OPEN", "risk_score": "95"},
    )
    assert [(r["alert_id"], r["risk_score"]) for r in aml.open_alerts(alerts).collect()] == [("A4", 95), ("A1", 80), ("A2", None)]
    named = aml.open_alerts(alerts, customers=rows(spark, CUSTOMERS, {"customer_id": "C1", "name": "N"}))
    assert [r["customer_name"] for r in named.collect()] == [None, "N", "Given"]
    assert aml.open_alerts(alerts, k=1).count() == 1


LOAN = "loan_id string, npa_status string, outstanding_principal decimal(18,2), sanctioned_amount decimal(18,2), interest_rate decimal(5,2), dpd int, provision_amount decimal(18,2)"


def test_regulatory_reports(spark):
    loans = spark.createDataFrame([
        ("L1", "NPA", Decimal("9500000.00"), Decimal("12000000.00"), Decimal("10.00"), 140, Decimal("1.00")),
        ("L2", "STANDARD", Decimal("25680000.00"), Decimal("27400000.00"), Decimal("8.70"), 0, Decimal("2.00")),
        ("L3", "SMA-1", Decimal("100.00"), Decimal("1.00"), Decimal("12.00"), 32, None),
        ("L4", "SMA-1", Decimal("200.01"), Decimal("1.00"), Decimal("12.01"), 45, Decimal("3.00")),
        ("L5", "XYZ", Decimal("10.00"), Decimal("1.00"), None, None, None),
    ], LOAN)
    got = npa.npa_regulatory(loans).collect()
    assert [r["npa_status"] for r in got] == ["STANDARD", "SMA-1", "NPA", "XYZ"]
    assert (got[1]["avg_dpd"], got[1]["avg_rate"]) == (39, Decimal("12.01"))
    assert (got[3]["avg_dpd"], got[3]["avg_rate"]) == (None, None)
    provision = {r["npa_status"]: r for r in npa.provision_requirement(loans, with_reported=True).collect()}
    assert provision["STANDARD"]["provision_amount"] == Decimal("102720.00")
    assert provision["NPA"]["provision_amount"] == Decimal("2375000.00")
    assert provision["SMA-1"]["provision_amount"] == Decimal("15.00")
    assert provision["XYZ"]["provision_amount"] == Decimal("0.00") and provision["XYZ"]["provision_pct"] == 0
    assert provision["SMA-1"]["reported_provision"] == Decimal("3.00")


def test_npa_from_raw(spark):
    bronze = rows(
        spark, NPA_REPORT, {"loan_id": "1", "npa_status": " npa", "outstanding_principal": "10", "dpd": "95"},
        {"loan_id": "2", "npa_status": "NPA", "outstanding_principal": "20", "dpd": "bad"},
        {"loan_id": "3", "npa_status": "NPA", "outstanding_principal": "bad", "dpd": "1"},
    )
    assert [tuple(r) for r in npa.npa_from_raw(bronze).collect()] == [("NPA", 2, Decimal("30.00"), 95)]


def test_low_scores(spark):
    bureau = rows(spark, BUREAU, *[
        {"report_id": f"R{i}", "customer_id": f"C{i}", "cibil_score": s} for i, s in enumerate(("599", "600", "NA", "490", ""))
    ])
    assert [(r["customer_id"], r["cibil_score"]) for r in customers.low_scores(bureau).collect()] == [("C3", 490), ("C0", 599)]


def test_high_risk_customers(spark, people):
    bureau = spark.createDataFrame([("C1", 700), ("C2", 500), ("C3", 650), ("C4", 800)], "customer_id string, cibil_score int")
    loans = spark.createDataFrame(
        [("C1", "STANDARD", 0, Decimal("1")), ("C1", "STANDARD", 0, Decimal("2")), ("C3", "NPA", 95, Decimal("3")),
         ("C3", "STANDARD", 0, Decimal("4")), ("C5", "SMA-2", 62, Decimal("5")), ("C5", "SMA-2", 62, Decimal("5"))],
        "customer_id string, npa_status string, dpd int, outstanding_principal decimal(18,2)",
    )
    df = silver(spark, *[{"c": "C1", "f": True}] * 3, {"c": "C4"})
    got = [(r["customer_id"], r["cibil_score"], r["worst_loan_status"], r["flagged_txns"])
           for r in customers.high_risk_customers(people, bureau, loans, df).collect()]
    assert got == [
        ("C2", 500, None, 0), ("C3", 650, "NPA", 0), ("C1", 700, "STANDARD", 3), ("C1", 700, "STANDARD", 3),
        ("C5", None, "SMA-2", 0),
    ]


def test_high_risk_is_the_same_with_and_without_salting(spark):
    n = spark.range(6_000)
    who = F.when(F.col("id") % 3 == 0, "C1").otherwise(F.concat(F.lit("C"), (F.col("id") % 97).cast("string")))
    loans = n.select(
        who.alias("customer_id"), F.when(F.col("id") % 5 == 0, "NPA").otherwise("STANDARD").alias("npa_status"),
        (F.col("id") % 7).cast("int").alias("dpd"), (F.col("id") % 1500).cast("decimal(18,2)").alias("outstanding_principal"),
    )
    everyone = spark.range(150).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id"), F.lit("N").alias("name"),
        F.lit("LOW").alias("risk_category"), F.lit("OK").alias("kyc_status"),
    )
    bureau = everyone.select("customer_id", (F.crc32("customer_id") % 400 + 450).cast("int").alias("cibil_score"))
    flagged = silver(spark, {"c": "C1", "f": True}, {"c": "C120", "f": True}, {"c": "C2"})
    results = [
        {tuple(r) for r in customers.high_risk_customers(everyone, bureau, loans, flagged, task_rows=limit).collect()}
        for limit in (100, 1_000_000)
    ]
    assert results[0] == results[1]
    assert {r[0] for r in results[0] if r[5] is None} >= {"C120"}
    assert any(r[0] == "C1" and r[5] == "STANDARD" for r in results[0])
    expected = everyone.join(bureau, "customer_id", "left").join(loans, "customer_id", "left").join(
        flagged.filter("is_flagged").select("customer_id", "txn_id"), "customer_id", "left"
    ).groupBy("customer_id", "cibil_score", "npa_status", "dpd", "outstanding_principal").agg(
        F.count_distinct("txn_id").alias("f")
    ).filter("cibil_score < 600 OR npa_status IN ('NPA', 'SMA-2') OR f > 0")
    assert {(r[0], r[4], r[5], r[6], r[7], r[8]) for r in results[0]} == {tuple(r) for r in expected.collect()}



def test_counts_and_freshness(spark):
    bronze = rows(spark, TRANSACTIONS, *[
        txn(i, kafka_topic="t", kafka_timestamp=datetime(2026, 4, 14, i), _ingestion_ts=datetime(2026, 4, 15)) for i in (3, 1, 2)
    ], extra="kafka_topic string, kafka_timestamp timestamp, _ingestion_ts timestamp")
    assert tuple(counts.ingestion_freshness(bronze).first()) == (
        "t", 3, datetime(2026, 4, 14, 1), datetime(2026, 4, 14, 3), datetime(2026, 4, 15),
    )
    assert [tuple(r) for r in counts.row_counts({"b": bronze, "a": bronze.limit(0)}).collect()] == [("a", 0), ("b", 3)]


def test_customer_360_listing(spark):
    gold = spark.createDataFrame([("A", None), ("B", 1), ("C", 5)], "customer_id string, total_txn_amount int")
    assert [r[0] for r in customers.customer_360_listing(gold).collect()] == ["C", "B", "A"]
    assert gold.filter(F.lit(False)).count() == 0
