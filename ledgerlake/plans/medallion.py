"""Bronze tables to published silver and gold tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..operators import gold as g
from ..operators import silver as s
from ..rules import DEFAULT_RULES, Rules
from ..sinks.publish import PublishResult, create_namespace, new_run_id, publish
from ..specs import AML_ALERTS, BUREAU, CUSTOMERS, LMS_LOANS, NPA_REPORT, TRANSACTIONS


@dataclass(frozen=True)
class Namespaces:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"


def build_silver(
    spark: SparkSession,
    names: Namespaces = Namespaces(),
    *,
    loans_source: str = "npa",
    rules: Rules = DEFAULT_RULES,
    run_id: str | None = None,
) -> list[PublishResult]:
    """Publish all silver tables.  Bureau and alerts are optional and skipped when bronze lacks them;
    any other problem surfaces as an error."""
    run_id = run_id or new_run_id()
    loans_spec = {"npa": NPA_REPORT, "lms": LMS_LOANS}[loans_source]

    def bronze(spec):
        return spark.table(f"{names.bronze}.{spec.bronze_table}")

    missing = [
        spec.bronze_table for spec in (TRANSACTIONS, CUSTOMERS, loans_spec)
        if not spark.catalog.tableExists(f"{names.bronze}.{spec.bronze_table}")
    ]
    if missing:
        raise ValueError(f"bronze tables missing: {', '.join(missing)}")

    create_namespace(spark, names.silver)
    built = [
        (TRANSACTIONS, s.silver_transactions(bronze(TRANSACTIONS), rules), ("txn_month",)),
        (CUSTOMERS, s.silver_customers(bronze(CUSTOMERS)), ()),
        (loans_spec, s.silver_loans(bronze(loans_spec), loans_source), ()),
    ]
    for spec, build in ((BUREAU, s.silver_bureau), (AML_ALERTS, s.silver_aml_alerts)):
        if spark.catalog.tableExists(f"{names.bronze}.{spec.bronze_table}"):
            built.append((spec, build(bronze(spec)), ()))
    return [
        publish(df, f"{names.silver}.{spec.silver_table}", partition_by=partition_by, run_id=run_id)
        for spec, df, partition_by in built
    ]


def build_gold(
    spark: SparkSession,
    names: Namespaces = Namespaces(),
    *,
    worst_by: str = "severity",
    run_id: str | None = None,
) -> list[PublishResult]:
    """Publish the gold tables from the published silver ones, so that the two always agree."""
    run_id = run_id or new_run_id()
    create_namespace(spark, names.gold)

    def silver(spec):
        return spark.table(f"{names.silver}.{spec.silver_table}")

    transactions, loans = silver(TRANSACTIONS), silver(NPA_REPORT)
    built = {
        "branch_txn_summary": g.branch_txn_summary(transactions),
        "npa_classification_summary": g.npa_classification_summary(loans),
        "customer_360": g.customer_360(silver(CUSTOMERS), transactions, loans, worst_by),
    }
    return [publish(df, f"{names.gold}.{name}", run_id=run_id) for name, df in built.items()]


def build_layers(
    spark: SparkSession, names: Namespaces = Namespaces(), *, skip_gold: bool = False, **silver_options
) -> list[PublishResult]:
    results = build_silver(spark, names, **silver_options)
    return results if skip_gold else results + build_gold(spark, names)
