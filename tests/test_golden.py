"""A small bank with known results, written out by hand: every report over silver built from raw rows."""

from decimal import Decimal as D

import pytest

from ledgerlake import operators as op
from ledgerlake.plans import aml, customers, npa, transactions
from ledgerlake.specs import BUREAU, CUSTOMERS, LMS_LOANS, TRANSACTIONS

from data import rows, txn

# channel: (amounts, customers in turn)
PAYMENTS = {
    "RTGS": (["400000.00", "600000.00", "250000.00", "150000.00"], ["C1", "C2"]),
    "NEFT": (["1000.00", "2000.00", "3000.01", "4000.00", "90000.00", "100.00"], ["C1", "C2", "C3"]),
    "CASH": (["1000000.00", "999999.99"], ["C3"]),
    "UPI": (["50.00", "n/a", "70.00"], ["C4"]),
}
FLAGGED = {"400000.00", "250000.00", "1000000.00", "999999.99", "50.00"}
# loan: customer, principal, sanctioned, rate, days past due, status, collateral
LOANS = {
    "L1": ("C1", "100000.00", "150000.00", "8.50", "0", "STANDARD", "200000.00"),
    "L2": ("C2", "30000.00", "30000.00", "12.00", "32", "SMA-1", "0.00"),
    "L3": ("C2", "45000.00", "60000.00", "12.25", "45", "SMA-1", ""),
    "L4": ("C3", "700000.00", "900000.00", "11.00", "62", "SMA-2", "650000.00"),
    "L5": ("C1", "80000.00", "90000.00", "10.00", "95", "NPA", "70000.00"),
}
SCORES = {"C1": "615", "C2": "580", "C3": "701", "C4": "n.a."}


@pytest.fixture(scope="module")
def raw(spark):
    paid, n = [], 0
    for channel, (amounts, who) in PAYMENTS.items():
        for i, amount in enumerate(amounts):
            n += 1
            paid.append(txn(
                n, channel=channel, amount=amount, customer_id=who[i % len(who)], txn_date=f"2026-04-{10 + n:02} {9 + i:02}:00:00",
                txn_type="DEBIT" if i % 2 else "CREDIT", status="FLAGGED" if amount in FLAGGED else "SUCCESS",
            ))
    names = ("customer_id", "outstanding_principal", "sanctioned_amount", "interest_rate", "dpd", "npa_status", "collateral_value")
    return {
        "txn": rows(spark, TRANSACTIONS, *paid),
        "cust": rows(spark, CUSTOMERS, *[{"customer_id": c, "name": f"N{c}", "risk_category": "LOW"} for c in SCORES]),
        "loans": rows(spark, LMS_LOANS, *[{"loan_id": k, **dict(zip(names, v, strict=True))} for k, v in LOANS.items()]),
        "bureau": rows(spark, BUREAU, *[{"report_id": f"R{c}", "customer_id": c, "cibil_score": s} for c, s in SCORES.items()]),
    }


@pytest.fixture(scope="module")
def silver(raw):
    return {
        "txn": op.silver_transactions(raw["txn"]).cache(), "cust": op.silver_customers(raw["cust"]).cache(),
        "loans": op.silver_loans(raw["loans"], "lms").cache(), "bureau": op.silver_bureau(raw["bureau"]).cache(),
    }


def table(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_transactions(silver):
    txns = silver["txn"]
    assert (txns.count(), txns.filter("is_high_value").count(), txns.filter("is_flagged").count()) == (15, 5, 5)


def test_channels(silver, raw):
    assert table(transactions.channel_share(silver["txn"]), "channel", "txn_count", "total_amount", "pct_of_total") == [
        ("NEFT", 6, D("100100.01"), D("40.00")), ("RTGS", 4, D("1400000.00"), D("26.67")),
        ("UPI", 3, D("120.00"), D("20.00")), ("CASH", 2, D("1999999.99"), D("13.33")),
    ]
    assert table(transactions.channel_distribution_raw(raw["txn"]), "channel", "txn_count", "avg_amount", "unique_customers") == [
        ("CASH", 2, D("1000000.00"), 1), ("RTGS", 4, D("350000.00"), 2), ("NEFT", 6, D("16683.34"), 3), ("UPI", 2, D("60.00"), 1),
    ]


def test_hours(silver):
    assert table(transactions.hourly_pattern(silver["txn"]), "txn_hour", "txn_count", "total_amount") == [
        (9, 4, D("1401050.00")), (10, 4, D("1601999.99")), (11, 3, D("253070.01")), (12, 2, D("154000.00")),
        (13, 1, D("90000.00")), (14, 1, D("100.00")),
    ]


def test_aml(silver):
    assert table(aml.high_value_cash(silver["txn"], silver["cust"]), "txn_id") == [("TXN000011",)]
    got = table(aml.structuring(silver["txn"], silver["cust"]), "customer_id", "flagged_count", "total_flagged_amount")
    assert got == [("C1", 2, D("650000.00")), ("C3", 2, D("1999999.99"))]
    assert sorted(table(aml.structuring_ids(silver["txn"], silver["cust"]), "customer_id", "txn_id")) == [
        ("C1", "TXN000001"), ("C1", "TXN000003"), ("C3", "TXN000011"), ("C3", "TXN000012"),
    ]


def test_loans(silver):
    columns = ("npa_status", "account_count", "total_outstanding", "total_sanctioned", "avg_rate", "avg_dpd")
    assert table(npa.npa_regulatory(silver["loans"]), *columns) == [
        ("STANDARD", 1, D("100000.00"), D("150000.00"), D("8.50"), 0),
        ("SMA-1", 2, D("75000.00"), D("90000.00"), D("12.13"), 39),
        ("SMA-2", 1, D("700000.00"), D("900000.00"), D("11.00"), 62),
        ("NPA", 1, D("80000.00"), D("90000.00"), D("10.00"), 95),
    ]
    assert table(npa.provision_requirement(silver["loans"]), "npa_status", "provision_amount") == [
        ("STANDARD", D("400.00")), ("SMA-1", D("3750.00")), ("SMA-2", D("105000.00")), ("NPA", D("20000.00")),
    ]
    assert table(npa.approaching_npa(silver["loans"]), "loan_id", "dpd") == [("L4", 62), ("L3", 45), ("L2", 32)]
    assert dict(table(silver["loans"], "loan_id", "ltv_ratio")) == {
        "L1": D("50.00"), "L2": None, "L3": None, "L4": D("107.69"), "L5": D("114.29"),
    }


def test_customers(silver, raw):
    assert table(customers.low_scores(raw["bureau"]), "customer_id", "cibil_score") == [("C2", 580)]
    risk = customers.high_risk_customers(silver["cust"], silver["bureau"], silver["loans"], silver["txn"])
    assert table(risk, "customer_id", "cibil_score", "worst_loan_status", "flagged_txns") == [
        ("C2", 580, "SMA-1", 0), ("C2", 580, "SMA-1", 0), ("C1", 615, "NPA", 2), ("C1", 615, "STANDARD", 2),
        ("C3", 701, "SMA-2", 2), ("C4", None, None, 1),
    ]
    view = {r["customer_id"]: r for r in op.customer_360(silver["cust"], silver["txn"], silver["loans"]).collect()}
    assert {c: (r["total_loans"], r["worst_npa_status"]) for c, r in view.items()} == {
        "C1": (2, "NPA"), "C2": (2, "SMA-1"), "C3": (1, "SMA-2"), "C4": (None, None),
    }


def test_gold_sizes(silver):
    assert op.branch_txn_summary(silver["txn"]).count() == 8
    assert op.npa_classification_summary(silver["loans"]).count() == 4
