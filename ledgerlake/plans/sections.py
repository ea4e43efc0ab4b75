"""The bronze reports by section, for callers who want all of one kind."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..specs import AML_ALERTS, BUREAU, CUSTOMERS, NPA_REPORT, TRANSACTIONS
from . import aml, counts, customers, npa, transactions

BRONZE_SPECS = (TRANSACTIONS, CUSTOMERS, AML_ALERTS, BUREAU, NPA_REPORT)
Tables = Callable[[str], DataFrame]
Reports = dict[str, Callable[[], DataFrame]]


class MissingTable(LookupError):
    """A report's table is not there."""


def _counts(table: Tables, present: Callable[[str], bool]) -> Reports:
    names = [s.bronze_table for s in BRONZE_SPECS]
    return {
        "row_counts": lambda: counts.row_counts({n: table(n) for n in names if present(n)}),
        "ingestion_freshness": lambda: counts.ingestion_freshness(table(TRANSACTIONS.bronze_table)),
    }


def _transactions(table: Tables, present: Callable[[str], bool]) -> Reports:
    name = TRANSACTIONS.bronze_table
    return {
        "channel_distribution": lambda: transactions.channel_distribution_raw(table(name)),
        "branch_type_top": lambda: transactions.branch_type_top_raw(table(name)),
        "hourly_pattern": lambda: transactions.hourly_pattern_raw(table(name)),
        "data_quality": lambda: transactions.data_quality(table(name)),
    }


def _risk(table: Tables, present: Callable[[str], bool]) -> Reports:
    who = CUSTOMERS.bronze_table
    return {
        "high_value_cash": lambda: aml.high_value_cash_raw(table(TRANSACTIONS.bronze_table), table(who)),
        "open_alerts": lambda: aml.open_alerts(table(AML_ALERTS.bronze_table), customers=table(who)),
        "npa_classification": lambda: npa.npa_from_raw(table(NPA_REPORT.bronze_table)),
        "low_scores": lambda: customers.low_scores(table(BUREAU.bronze_table)),
    }


SECTIONS: dict[str, Callable[[Tables, Callable[[str], bool]], Reports]] = {
    "counts": _counts, "txn": _transactions, "risk": _risk,
}


def bronze_reports(
    spark: SparkSession, section: str | None = None, namespace: str = "bronze"
) -> dict[str, DataFrame]:
    """Reports of one section, or of all, unevaluated.

    A report whose table is absent is left out with a warning; the others go on.
    """
    if not spark.catalog.databaseExists(namespace):
        raise ValueError(f"namespace {namespace} does not exist; ingest into bronze first")

    def present(name: str) -> bool:
        return spark.catalog.tableExists(f"{namespace}.{name}")

    def table(name: str) -> DataFrame:
        if not present(name):
            raise MissingTable(f"{namespace}.{name}")
        return spark.table(f"{namespace}.{name}")

    reports: dict[str, DataFrame] = {}
    for build in (SECTIONS if section is None else {section: SECTIONS[section]}).values():
        for name, report in build(table, present).items():
            try:
                reports[name] = report()
            except MissingTable as missing:
                warnings.warn(f"no report {name}: table {missing} is absent", stacklevel=2)
    return reports
