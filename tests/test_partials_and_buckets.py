"""Gold from parts by month, and facts in buckets."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import gold
from ledgerlake.plans import bucketed, partials

SCHEMA = "txn_id string, customer_id string, amount decimal(18,2), txn_date timestamp, txn_month string, is_flagged boolean, channel string, narration string"


def facts(spark, n=600, hot=200):
    rows = [
        (f"T{i}", None if i % 50 == 0 else "HOT" if i < hot else f"C{i % 37}", None if i % 31 == 0 else f"{i % 90}.50",
         datetime(2026, 1 + i % 4, 1 + i % 28), f"2026-0{1 + i % 4}", None if i % 41 == 0 else i % 3 == 0, "NEFT", f"N{i}")
        for i in range(n)
    ]
    return spark.createDataFrame([(*r[:2], r[2], *r[3:]) for r in rows], SCHEMA.replace("decimal(18,2)", "string")).withColumn(
        "amount", F.col("amount").cast("decimal(18,2)")
    )


def as_set(df):
    return sorted(map(repr, df.collect()))


def test_merged_parts_equal_the_whole(spark, namespace):
    df, table = facts(spark), f"{namespace}.parts"
    want = gold.transactions_per_customer(df)
    got = partials.refresh_customer_parts(spark, df, table)
    assert got.schema.simpleString() == want.schema.simpleString() and as_set(got) == as_set(want)


def test_a_month_is_replaced_alone(spark, namespace):
    df, table = facts(spark), f"{namespace}.parts"
    partials.refresh_customer_parts(spark, df, table)
    files = {f for f in spark.table(table).inputFiles() if "2026-02" not in f}
    later = df.where("txn_month <> '2026-02'").unionByName(df.where("txn_month = '2026-02' AND customer_id = 'HOT'"))
    got = partials.refresh_customer_parts(spark, later, table, ["2026-02"])
    assert as_set(got) == as_set(gold.transactions_per_customer(later))
    assert files <= set(spark.table(table).inputFiles())  # other months' files are the same
    gone = df.where("txn_month <> '2026-03'")
    partials.refresh_customer_parts(spark, later, table, ["2026-02", "2026-02"])
    got = partials.refresh_customer_parts(spark, gone.where("txn_month <> '2026-02'"), table, ["2026-03", "2026-02"])
    assert as_set(got) == as_set(gold.transactions_per_customer(df.where("txn_month IN ('2026-01', '2026-04')")))


def test_the_refresh_of_a_month_reads_that_month(spark):
    plan = partials.customer_parts(facts(spark), "txn_month").where(F.col("txn_month") == "2026-02")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("2026-02")  # the filter is below the grouping


@pytest.mark.parametrize("task_rows", [10, 1_000_000])
def test_buckets_hold_heavy_keys_apart(spark, namespace, task_rows):
    df, table = facts(spark), f"{namespace}.t"
    result = bucketed.publish_bucketed(df, table, "customer_id", buckets=8, spread_by=["txn_id"], task_rows=task_rows)
    held = spark.table(table)
    assert result.rows == 600 and as_set(held.drop("_salt")) == as_set(df)
    sizes = {r[0]: r[1] for r in held.where("customer_id = 'HOT'").groupBy("_salt").count().collect()}
    assert (len(sizes) > 10 and max(sizes.values()) < 40) if task_rows == 10 else set(sizes) == {0}
    assert held.where("customer_id IS NULL").select("_salt").distinct().count() > 1  # rows without a key lie anywhere
    customers = spark.createDataFrame(
        [(c, f"name {c}", "HIGH", "OK", "BR1") for c in ["HOT", *[f"C{i}" for i in range(30)], "nobody"]],
        "customer_id string, name string, risk_category string, kyc_status string, branch_code string",
    )
    loans = spark.createDataFrame([], "customer_id string, outstanding_principal decimal(18,2), dpd int, npa_status string")
    assert as_set(bucketed.customer_360(spark, table, customers, loans)) == as_set(gold.customer_360(customers, df, loans))
    from ledgerlake.plans import aml

    assert as_set(bucketed.flagged_detail(spark, table, customers)) == as_set(aml.flagged_detail(df, customers))
    left = bucketed.join_bucketed(spark, held, table, customers.select("customer_id", "name"), "customer_id", "left")
    assert as_set(left.select("txn_id", "name")) == as_set(df.join(customers, "customer_id", "left").select("txn_id", "name"))


def test_a_bucketed_table_is_published_anew(spark, namespace):
    table = f"{namespace}.t"
    for n in (100, 300):
        bucketed.publish_bucketed(facts(spark, n, 80), table, "customer_id", buckets=4, spread_by=["txn_id"], partition_by=["txn_month"], task_rows=20)
        assert spark.table(table).count() == n
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {spark.sql(f'SHOW TBLPROPERTIES {table}').where(F.col('key') == 'ledgerlake.run_of').first()['value']}").collect()}
    assert described["Num Buckets"] == "4" and described["Bucket Columns"] == "[`customer_id`, `_salt`]"
