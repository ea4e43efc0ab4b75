import pytest
from pyspark.sql import functions as F, types as T

from ledgerlake.plans import medallion, metadata, quality, sections
from ledgerlake.sinks import append, create_namespace, publish, replace
from ledgerlake.sinks.publish import LOG_TABLE
from ledgerlake.specs import AML_ALERTS, BUREAU, CUSTOMERS, NPA_REPORT, TRANSACTIONS

from data import rows, txn


def numbers(spark, n, months=2):
    return spark.range(n).select("id", F.concat(F.lit("2026-0"), (F.col("id") % months + 1).cast("string")).alias("m"))


def test_append_creates_then_adds(spark, namespace):
    assert append(numbers(spark, 3), f"{namespace}.t") == 3
    assert append(numbers(spark, 2), f"{namespace}.t") == 2
    assert spark.table(f"{namespace}.t").count() == 5


def test_replace(spark, namespace):
    replace(numbers(spark, 3), f"{namespace}.t")
    assert replace(numbers(spark, 2), f"{namespace}.t", partition_by=("m",)) == 2
    assert spark.table(f"{namespace}.t").count() == 2


def logged(spark, namespace):
    return [(r["run_id"], r["row_count"]) for r in spark.table(f"{namespace}.{LOG_TABLE}").orderBy("published_at").collect()]


def test_publish_switches_and_keeps_one_run_back(spark, namespace):
    table = f"{namespace}.t"
    runs = [publish(numbers(spark, n), table, partition_by=("m",)) for n in (10, 4, 7)]
    assert [r.rows for r in runs] == [10, 4, 7] and spark.table(table).count() == 7
    assert logged(spark, namespace) == [(r.run_id, r.rows) for r in runs]
    assert [spark.catalog.tableExists(r.run_table) for r in runs] == [False, True, True]
    with pytest.raises(ValueError):
        publish(numbers(spark, 1), "no_namespace")


def test_publish_refuses_a_plain_table_before_it_writes(spark, namespace):
    table = f"{namespace}.t"
    replace(numbers(spark, 5), table)
    with pytest.raises(ValueError, match="plain table"):
        publish(numbers(spark, 7), table)
    assert spark.table(table).count() == 5
    assert [t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary] == ["t"]


def test_failed_run_keeps_the_previous_one(spark, namespace):
    table = f"{namespace}.t"
    publish(numbers(spark, 5), table)
    broken = numbers(spark, 5).withColumn("id", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        publish(broken, table)
    assert spark.table(table).count() == 5
    assert len(logged(spark, namespace)) == 1


def test_names_with_underscores_are_tables_like_others(spark, namespace):
    append(numbers(spark, 5), f"{namespace}.acct__daily")
    publish(numbers(spark, 3), f"{namespace}.acct")
    publish(numbers(spark, 4), f"{namespace}.acct")
    publish(numbers(spark, 2), f"{namespace}.ok")
    assert [(r["table_name"], r["row_count"]) for r in quality.layer_counts(spark, (namespace,)).collect()] == [
        ("acct", 4), ("acct__daily", 5), ("ok", 2),
    ]


def test_contract(spark, namespace):
    append(numbers(spark, 1), f"{namespace}.t")
    contract = T.StructType.fromDDL("id int, m string, more date")
    got = {r["column_name"]: tuple(r)[3:] for r in quality.layer_columns(spark, namespace, {"t": contract}).collect()}
    assert got == {"id": ("int", "bigint", False), "m": ("string", "string", True), "more": ("date", None, False)}
    assert quality.layer_columns(spark, namespace, {}).filter("not agrees").count() == 0


def test_partition_pruning_and_profiles(spark, namespace):
    table = f"{namespace}.t"
    run = publish(numbers(spark, 1000), table, partition_by=("m",))
    pruned = spark.table(table).filter("m = '2026-01'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan and "= 2026-01)]" in plan
    assert len(pruned.inputFiles()) < len(spark.table(table).inputFiles())
    stored = spark.table(run.run_table)
    profile = {r["m"]: r for r in metadata.partition_profile(stored, "m").collect()}
    assert {m: r["row_count"] for m, r in profile.items()} == {"2026-01": 500, "2026-02": 500}
    files = metadata.file_profile(stored).collect()
    assert sum(r["row_count"] for r in files) == 1000 and all(r["file_bytes"] > 0 for r in files)
    assert sum(r["file_count"] for r in profile.values()) == len(files)


@pytest.fixture
def layers(spark, namespace):
    names = medallion.Namespaces(f"{namespace}_b", f"{namespace}_s", f"{namespace}_g")
    create_namespace(spark, names.bronze)

    def bronze(spec, *records):
        append(rows(spark, spec, *records, extra="kafka_topic string, kafka_timestamp timestamp, _ingestion_ts timestamp"
                    if spec is TRANSACTIONS else ""), f"{names.bronze}.{spec.bronze_table}")

    bronze(TRANSACTIONS, txn(1, amount="250000.00", status="FLAGGED", kafka_topic="t"), txn(1), txn(2, txn_date="2026-05-01T00:00:01"))
    bronze(CUSTOMERS, {"customer_id": "CUST000001", "name": "A"}, {"customer_id": "CUST000002", "name": "B"})
    bronze(NPA_REPORT, {"loan_id": "L1", "customer_id": "CUST000001", "npa_status": "NPA", "outstanding_principal": "10", "dpd": "95"})
    return names, bronze


def test_all_layers(spark, layers):
    names, bronze = layers
    checks = {r["table_name"].split(".")[1]: (r["present"], r["has_rows"])
              for r in quality.required_tables(spark, names.bronze).collect()}
    assert checks == {"finacle_transactions": (True, True), "finacle_customers": (True, True), "npa_report": (True, True)}

    silver_only = medallion.build_layers(spark, names, skip_gold=True)
    assert [r.table.split(".")[1] for r in silver_only] == ["finacle_transactions", "finacle_customers", "lms_loans"]
    bronze(BUREAU, {"report_id": "R1", "customer_id": "CUST000001", "cibil_score": "500"})
    bronze(AML_ALERTS, {"alert_id": "A1", "customer_id": "CUST000001", "status": "OPEN", "risk_score": "80"})
    results = {r.table.split(".")[1]: r.rows for r in medallion.build_layers(spark, names)}
    assert results == {
        "finacle_transactions": 2, "finacle_customers": 2, "lms_loans": 1, "cibil_bureau": 1, "aml_alerts": 1,
        "branch_txn_summary": 2, "npa_classification_summary": 1, "customer_360": 2,
    }
    gold = spark.table(f"{names.gold}.branch_txn_summary")
    assert gold.agg(F.sum("txn_count")).first()[0] == spark.table(f"{names.silver}.finacle_transactions").count()

    counted = {(r["layer"], r["table_name"]): r["row_count"]
               for r in quality.layer_counts(spark, (names.bronze, names.silver, names.gold)).collect()}
    assert counted[(names.bronze, "finacle_transactions")] == 3
    assert counted[(names.silver, "finacle_transactions")] == 2
    assert len(counted) == 13
    reconciled = quality.reconciliation({"transactions": (
        spark.table(f"{names.bronze}.finacle_transactions"), spark.table(f"{names.silver}.finacle_transactions"), "txn_id",
    )}).first()
    assert tuple(reconciled) == ("transactions", 3, 2, 2, True)

    reports = sections.bronze_reports(spark, namespace=names.bronze)
    spark.sql(f"DROP TABLE {names.bronze}.aml_alerts")
    with pytest.warns(UserWarning, match="open_alerts"):
        fewer = sections.bronze_reports(spark, namespace=names.bronze)
    assert set(reports) - set(fewer) == {"open_alerts"}
    assert [r["tbl"] for r in fewer["row_counts"].collect()] == [
        "cibil_bureau", "finacle_customers", "finacle_transactions", "npa_report",
    ]
    bronze(AML_ALERTS, {"alert_id": "A1", "customer_id": "CUST000001", "status": "OPEN", "risk_score": "80"})
    reports = sections.bronze_reports(spark, namespace=names.bronze)
    assert set(reports) == {
        "row_counts", "ingestion_freshness", "channel_distribution", "branch_type_top", "hourly_pattern",
        "data_quality", "high_value_cash", "open_alerts", "npa_classification", "low_scores",
    }
    assert reports["open_alerts"].first()["customer_name"] == "A"
    assert [r["rows"] for r in reports["row_counts"].collect()] == [1, 1, 2, 3, 1]
    assert set(sections.bronze_reports(spark, "txn", names.bronze)) == {
        "channel_distribution", "branch_type_top", "hourly_pattern", "data_quality",
    }


def test_missing_bronze(spark, namespace):
    names = medallion.Namespaces(namespace, f"{namespace}_s", f"{namespace}_g")
    with pytest.raises(ValueError, match="finacle_transactions"):
        medallion.build_layers(spark, names)
    checks = quality.required_tables(spark, namespace).collect()
    assert {(r["present"], r["has_rows"]) for r in checks} == {(False, False)}
    with pytest.raises(ValueError):
        sections.bronze_reports(spark, namespace="nowhere_at_all")
    assert quality.layer_counts(spark, ("nowhere_at_all",)).count() == 0
