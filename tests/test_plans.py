"""Physical plans hold what the design relies on."""

import os

import pytest

from ledgerlake.workload import roles
from ledgerlake.workload.queries import QUERIES

from conftest import DATA

SF = os.path.join(DATA, "sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plan joins as for tables too big to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


# They write and read back while they are built, which takes long and leaves a plain scan.
WRITING = {
    "customer_360_bucketed", "flagged_detail_bucketed", "month_refreshed_gold", "contract_gate", "rejected_messages", "exchanged_key", "incremental_ingest", "offset_stretches", "bronze_batch_ingest", "bronze_stream_ingest", "stream_dedup", "stream_topics", "stream_to_files", "csv_extract",
    "csv_as_text", "csv_recursive", "csv_to_bronze", "publish_envelope", "json_lines", "partition_pruned_total",
    "partition_profile", "publish_refresh", "replaced_table", "layer_counts", "layer_reconciliation",
    "key_reconciliation", "required_tables", "silver_contract", "reports_without_alerts",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_no_cartesian_product(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


@pytest.mark.parametrize("name", [
    "branch_txn_summary", "npa_classification_summary", "customer_360", "branch_summary", "npa_regulatory_order",
    "channel_distribution_raw", "structuring_detection", "high_risk_customers",
])
def test_groups_are_hashed_not_sorted(spark, name):
    assert "SortAggregate" not in plan_of(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["branch_type_top15", "open_alerts_top20", "low_score_top20", "high_value_cash_left"])
def test_top_k_does_not_sort_everything(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("name", ["silver_transactions", "silver_loans_ltv", "dedup_by_key"])
def test_dedup_limits_groups_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert plan.count("WindowGroupLimit") == 2


def test_flagged_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["flagged_detail"](spark, SF))
    assert "EqualTo(event_type,error)" in plan


def test_month_range_reaches_the_scan(spark):
    plan = plan_of(QUERIES["monthly_partition_summary"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["hourly_pattern"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan


def test_loans_are_joined_only_where_needed(spark):
    assert "Join" not in plan_of(roles.silver_loans(spark, SF))


def test_loans_are_read_once_for_high_risk_customers(spark):
    plan = plan_of(QUERIES["high_risk_customers"](spark, SF))
    assert "l_extendedprice" not in plan and "ReadSchema: struct<customer_id:bigint,worst_loan_status:string" in plan


def test_flagged_facts_are_read_once_for_structuring(spark):
    assert plan_of(QUERIES["structuring_detection"](spark, SF)).count("FileScan parquet") == 2  # events and customer


def test_bucketed_facts_are_not_shuffled(spark, no_broadcast):
    """Exchanges carry the dimension, the loans and one row per customer and salt, never the facts."""
    import re

    from ledgerlake.workload.queries import _bucketed
    from ledgerlake.plans import bucketed

    table = _bucketed(spark, SF)
    customers, loans = roles.silver_customers(spark, SF), roles.silver_loans(spark, SF, customer=True)
    for df in (bucketed.flagged_detail(spark, table, customers), bucketed.customer_360(spark, table, customers, loans)):
        lines = plan_of(df).splitlines()
        at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        depth = lambda line: len(re.match(r"[ :+\-|]*", line)[0])
        above, level = [], depth(lines[at])
        for line in reversed(lines[:at]):  # the operators above the scan, nearest first
            if depth(line) < level:
                level = depth(line)
                above.append(line)
        kinds = [re.sub(r"^[ :+\-|*()\d]*", "", line).split("(")[0].split(" ")[0] for line in above]
        first = kinds.index("Exchange") if "Exchange" in kinds else len(kinds)
        assert any(k in ("SortMergeJoin", "HashAggregate") for k in kinds[:first])
        if "SortMergeJoin" in kinds[:first]:
            continue
        assert kinds[:first].count("HashAggregate") >= 3  # partial and final by (customer, salt), partial by customer
    heavy = spark.table(f"{table}_heavy")
    assert heavy.count() > 0 and spark.table(table).groupBy("customer_id").agg({"_salt": "max"}).where("`max(_salt)` > 0").count() > 0
