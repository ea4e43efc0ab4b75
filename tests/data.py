"""Small hand-made rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from ledgerlake.specs import EntitySpec


def rows(spark: SparkSession, spec: EntitySpec, *records: dict, extra: str = "") -> DataFrame:
    """Text rows of an entity; columns not given are NULL.  ``extra`` adds columns as DDL."""
    schema = spec.raw_schema
    if extra:
        schema = T.StructType(schema.fields + T.StructType.fromDDL(extra).fields)
    data = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(data, schema)


def txn(n: int, **fields) -> dict:
    """A clean transaction with the number ``n`` in its id."""
    return {
        "txn_id": f"TXN{n:06d}", "account_id": "ACCT000001", "customer_id": "CUST000001",
        "txn_type": "CREDIT", "amount": "1000.00", "currency": "INR",
        "txn_date": "2026-04-14 09:15:30", "value_date": "2026-04-14", "branch_code": "BR001",
        "channel": "NEFT", "narration": "SALARY", "balance_after": "5000.00", "status": "SUCCESS",
        "ref_number": f"REF{n}", **fields,
    }


def by_key(df: DataFrame, key: str) -> dict:
    return {r[key]: r for r in df.collect()}
