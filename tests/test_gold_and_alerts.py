from datetime import datetime
from decimal import Decimal

import pytest

from ledgerlake import operators as op
from ledgerlake.rules import Rules

CUSTOMER = "customer_id string, name string, risk_category string, kyc_status string, branch_code string"
TXN = (
    "txn_id string, customer_id string, txn_type string, amount decimal(18,2), txn_date timestamp, "
    "branch_code string, channel string, txn_month string, is_flagged boolean, status string"
)
LOAN = "customer_id string, outstanding_principal decimal(18,2), dpd int, npa_status string"


def transactions(spark, *records):
    full = [(
        f"T{i}", r.get("c", "C1"), r.get("type", "CREDIT"),
        None if r.get("a") is None else Decimal(r["a"]), r.get("d", datetime(2026, 4, 14, 9)),
        r.get("b", "BR001"), r.get("ch", "NEFT"), "2026-04", r.get("f", False), r.get("s", "SUCCESS"),
    ) for i, r in enumerate(records)]
    return spark.createDataFrame(full, TXN)


def test_branch_summary(spark):
    got = op.branch_txn_summary(transactions(
        spark, {"a": "10.00"}, {"a": "20.01", "c": "C2", "f": True}, {"a": None, "f": None},
        {"a": "5.00", "b": "BR002"},
    ))
    assert got.columns == [
        "branch_code", "txn_type", "channel", "txn_month", "txn_count", "total_amount", "avg_amount",
        "max_amount", "unique_customers", "flagged_count",
    ]
    r = got.filter("branch_code = 'BR001'").first()
    assert (r["txn_count"], r["total_amount"], r["avg_amount"]) == (3, Decimal("30.01"), Decimal("15.005000"))
    assert (r["max_amount"], r["unique_customers"], r["flagged_count"]) == (Decimal("20.01"), 2, 1)


def test_customer_360(spark):
    customers = spark.createDataFrame([
        ("C1", "A", "LOW", "VERIFIED", "BR001"), ("C2", "B", "HIGH", "PENDING", "BR002"),
    ], CUSTOMER)
    txn = transactions(spark, {"a": "10.00", "f": True}, {"a": "20.00", "d": datetime(2026, 4, 15)}, {"c": "C9", "a": "1"})
    loans = spark.createDataFrame([
        ("C1", Decimal("100.00"), 0, "STANDARD"), ("C1", Decimal("50.00"), 95, "NPA"),
    ], LOAN)
    got = {r["customer_id"]: r for r in op.customer_360(customers, txn, loans).collect()}
    assert set(got) == {"C1", "C2"}
    assert tuple(got["C1"])[5:] == (
        2, Decimal("30.00"), datetime(2026, 4, 15), 1, 2, Decimal("150.00"), 95, "NPA",
    )
    assert tuple(got["C2"])[5:] == (None,) * 8
    lexical = op.customer_360(customers, txn, loans, worst_by="lexical").filter("customer_id = 'C1'").first()
    assert lexical["worst_npa_status"] == "STANDARD"


def test_npa_summary(spark):
    loans = spark.createDataFrame(
        [("NPA", "HOME", "BR1", Decimal("10"), Decimal("20"), Decimal("8.50"), 95),
         ("NPA", "HOME", "BR1", Decimal("30"), Decimal("40"), Decimal("9.00"), 96)],
        "npa_status string, loan_type string, branch_code string, outstanding_principal decimal(18,2), "
        "sanctioned_amount decimal(18,2), interest_rate decimal(5,2), dpd int",
    )
    r = op.npa_classification_summary(loans).first()
    assert (r["account_count"], r["total_outstanding"], r["total_sanctioned"]) == (2, Decimal("40.00"), Decimal("60.00"))
    assert (r["avg_interest_rate"], r["avg_dpd"]) == (Decimal("8.750000"), 95.5)


@pytest.mark.parametrize("channel, amount, expected", [
    ("CASH", "500000.00", "SUCCESS"), ("CASH", "500000.01", "FLAGGED"), ("NEFT", "900000.00", "SUCCESS"),
    ("CASH", None, "SUCCESS"),
])
def test_status_override(spark, channel, amount, expected):
    txn = transactions(spark, {"ch": channel, "a": amount})
    assert op.override_cash_status(txn).first()["status"] == expected


def test_alert_base(spark):
    txn = transactions(spark, *[{"a": f"{i}.00", "s": "FLAGGED" if i % 2 else "SUCCESS"} for i in range(400)], {"s": "FLAGGED", "d": None})
    first = op.alert_base(txn).collect()
    assert {tuple(r) for r in first} == {tuple(r) for r in op.alert_base(txn.repartition(5)).collect()}
    assert len(first) == len({r["alert_id"] for r in first}) == 201
    by_id = {r["alert_id"]: r for r in first}
    assert tuple(by_id["AML20260414-T7"]) == ("AML20260414-T7", "C1", "2026-04-14", "T7", Decimal("7.00"))
    assert by_id["AML00000000-T400"]["alert_date"] is None


def test_flag_status_is_a_rule(spark):
    txn = transactions(spark, {"a": "1.00", "s": "HELD"})
    assert op.alert_base(txn, Rules(flagged_status="HELD")).count() == 1
