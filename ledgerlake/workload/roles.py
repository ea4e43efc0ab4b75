"""Driver tables seen as banking tables.

Bronze roles are all text and contain what bronze contains: blanks, values that do not parse, messy
spelling, two timestamp forms, repeated keys.  Silver roles are typed and keep the tables' own keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHANNELS = ("NEFT", "RTGS", "UPI", "ATM", "POS", "CASH")
LOAN_TYPES = ("HOME_LOAN", "PERSONAL_LOAN", "CAR_LOAN", "BUSINESS_LOAN")
MONEY = "decimal(18,2)"
MICROS = "HH:mm:ss.SSSSSS"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _choice(index: Column, options: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def _branch(number: Column) -> Column:
    return F.concat(F.lit("BR00"), _text(number % 5 + 1))


def _amount() -> Column:
    return (F.col("value").cast(MONEY) * 1000).cast(MONEY)


def _spoken(channel: Column, n: Column) -> Column:
    """Text as people type it: lower case in spaces, or between a tab and a line end."""
    messy = F.when(n % 7 == 0, F.concat(F.lit(" "), F.lower(channel), F.lit(" ")))
    return messy.when(n % 7 == 1, F.concat(F.lit("\t"), channel, F.lit("\n"))).otherwise(channel)


def _event_status() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "error", "FLAGGED").when(kind == "signup", "FAILED").otherwise("SUCCESS")


def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as silver transactions."""
    events = load(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").alias("txn_id"),
        F.concat(F.lit("ACCT"), _text("user_id")).alias("account_id"),
        F.col("user_id").alias("customer_id"),
        F.when(F.col("event_id") % 2 == 0, "CREDIT").otherwise("DEBIT").alias("txn_type"),
        _amount().alias("amount"),
        F.col("ts").alias("txn_date"),
        _branch(F.get_json_object("props", "$.k").cast("int")).alias("branch_code"),
        _choice(F.col("event_id") % 6, CHANNELS).alias("channel"),
        F.concat(F.lit("REF "), _text("event_id")).alias("narration"),
        _event_status().alias("status"),
        F.date_format("ts", "yyyy-MM").alias("txn_month"),
        F.hour("ts").alias("txn_hour"),
        (F.col("event_type") == "error").alias("is_flagged"),
    )


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw transactions with their message columns.

    Every 20th comes again, with a later offset and another amount.
    """
    first = load(spark, sf_dir, "events").withColumn("again", F.lit(0).cast("bigint"))
    events = first.unionByName(first.filter("event_id % 20 = 0").withColumn("again", F.lit(1).cast("bigint")))
    paid = (_amount() + F.col("again")).cast(MONEY)
    n = F.col("event_id")
    channel = _choice(n % 6, CHANNELS)
    stamp = F.when(n % 2 == 0, F.date_format("ts", f"yyyy-MM-dd'T'{MICROS}")).otherwise(
        F.date_format("ts", f"yyyy-MM-dd {MICROS}")
    )
    return events.select(
        _text(n).alias("txn_id"),
        F.concat(F.lit("ACCT"), _text("user_id")).alias("account_id"),
        F.when(n % 101 == 0, "").when(n % 107 == 0, "\t\n").when(n % 103 != 0, _text("user_id")).alias("customer_id"),
        F.when(n % 2 == 0, "CREDIT").otherwise("DEBIT").alias("txn_type"),
        F.when(n % 97 == 0, "N/A").when(n % 89 == 0, "").otherwise(_text(paid)).alias("amount"),
        F.lit("INR").alias("currency"),
        F.when(n % 83 == 0, "not-a-date").otherwise(stamp).alias("txn_date"),
        F.date_format("ts", "yyyy-MM-dd").alias("value_date"),
        _branch(F.get_json_object("props", "$.k").cast("int")).alias("branch_code"),
        _spoken(channel, n).alias("channel"),
        F.concat(F.lit("REF "), _text(n), F.when(n % 113 == 0, "\nline two").otherwise("")).alias("narration"),
        _text((_amount() * 2).cast(MONEY)).alias("balance_after"),
        F.when(n % 61 != 0, _event_status()).alias("status"),
        F.concat(channel, _text(n)).alias("ref_number"),
        F.col("event_type").alias("kafka_topic"),
        (n % 4).cast("int").alias("kafka_partition"),
        (n + F.col("again") * 1_000_000_000).alias("kafka_offset"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
    )


def monthly_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as silver transactions spread over many months."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "O", "CREDIT").otherwise("DEBIT").alias("txn_type"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderdate").alias("txn_date"),
        _branch(F.col("o_custkey")).alias("branch_code"),
        F.col("o_orderpriority").alias("channel"),
        F.date_format("o_orderdate", "yyyy-MM").alias("txn_month"),
    )


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as silver customers."""
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("risk_category"),
        F.when(F.col("c_acctbal") < 0, "PENDING").otherwise("VERIFIED").alias("kyc_status"),
        _branch(F.col("c_nationkey")).alias("branch_code"),
    )


def bronze_customers(spark: SparkSession, sf_dir: str, *, repeats: bool = False) -> DataFrame:
    """``customer`` as raw customers with personal data; with ``repeats`` every 25th moved and came again."""
    if repeats:
        first = bronze_customers(spark, sf_dir).withColumn("kafka_offset", F.lit(1).cast("bigint"))
        moved = first.filter("customer_id % 25 = 0").withColumns(
            {"address_city": F.lit("moved"), "kafka_offset": F.lit(2).cast("bigint")}
        )
        return first.unionByName(moved)
    n, nothing = F.col("c_custkey"), F.lit(None).cast("string")
    pan = F.concat(F.lit("PANXX"), F.lpad(_text(n), 4, "0"), F.lit("Z"))
    email = F.when(n % 17 == 0, F.col("c_name")).when(n % 11 == 0, "").when(
        n % 13 != 0, F.concat(F.lower("c_name"), F.lit("@bank.example"))
    )
    return load(spark, sf_dir, "customer").select(
        _text(n).alias("customer_id"),
        F.col("c_name").alias("name"),
        pan.alias("pan"),
        nothing.alias("aadhaar_masked"),
        _text(n + 9_000_000_000).alias("mobile"),
        email.alias("email"),
        F.lit("1985-03-15").alias("dob"),
        F.when(n % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(F.col("c_acctbal") < 0, "PENDING").otherwise("VERIFIED").alias("kyc_status"),
        F.lit(" ").alias("kyc_date"),
        F.col("c_mktsegment").alias("risk_category"),
        _branch(F.col("c_nationkey")).alias("branch_code"),
        F.lit("SAVINGS").alias("account_type"),
        F.concat(F.lit("ACCT"), _text(n)).alias("account_number"),
        F.lit("2020-01-10").alias("account_open_date"),
        F.col("c_mktsegment").alias("occupation"),
        F.when(n % 19 == 0, "unknown").otherwise(
            _text((F.col("c_acctbal").cast(MONEY) * 100).cast(MONEY))
        ).alias("annual_income"),
        _text("c_nationkey").alias("address_city"),
        nothing.alias("address_state"),
        nothing.alias("nominee_name"),
    )


def _npa_status() -> Column:
    flag, state = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when(flag == "N", "STANDARD")
        .when((flag == "A") & (state == "F"), "SMA-1")
        .when((flag == "A") & (state == "O"), "SMA-2")
        .when(flag == "R", "NPA")
    )


def _loan_lines(spark: SparkSession, sf_dir: str, customer: bool, collateral: bool) -> DataFrame:
    """Line items, joined only with the tables the report at hand needs."""
    lines = load(spark, sf_dir, "lineitem")
    if customer:
        orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        lines = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    else:
        lines = lines.withColumn("o_custkey", F.lit(None).cast("bigint"))
    if collateral:
        parts = load(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
        return lines.join(parts, lines["l_partkey"] == parts["p_partkey"], "left")
    return lines.withColumns({
        "p_retailprice": F.lit(None).cast("double"), "p_size": F.lit(None).cast("int"),
    })


def _loan_columns() -> dict[str, Column]:
    """Typed loan columns, shared by the silver role and (as text) by the bronze roles."""
    # Narrow decimals keep the products below 19 digits, which Spark computes on longs.
    principal = F.col("l_extendedprice").cast("decimal(9,2)")
    rate = (F.col("l_tax") * 100).cast("decimal(5,2)")
    percent = F.lit("0.01").cast("decimal(2,2)")
    return {
        "loan_id": F.concat(_text("l_orderkey"), F.lit("-"), _text("l_linenumber")),
        "customer_id": F.col("o_custkey"),
        "customer_name": F.concat(F.lit("Customer#"), _text("o_custkey")),
        "loan_type": _choice(F.col("l_linenumber") % 4, LOAN_TYPES),
        "branch_code": _branch(F.col("l_suppkey")),
        "sanctioned_amount": (principal * F.lit("1.25").cast("decimal(3,2)")).cast(MONEY),
        "outstanding_principal": principal.cast(MONEY),
        "outstanding_interest": (principal * rate * percent).cast(MONEY),
        "dpd": (F.col("l_quantity") * 4 - 4).cast("int"),
        "npa_status": _npa_status(),
        "interest_rate": rate,
        "last_payment_date": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "next_due_date": F.date_format(F.col("l_shipdate") + F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd"),
        "collateral_type": F.when(F.col("l_linenumber") % 4 == 1, "UNSECURED").otherwise("PROPERTY"),
        "collateral_value": F.when(F.col("p_size") % 10 == 0, F.lit(0).cast(MONEY)).when(
            F.col("p_size") % 11 != 0, (F.col("p_retailprice").cast(MONEY) * 50).cast(MONEY)
        ),
    }


def silver_loans(
    spark: SparkSession, sf_dir: str, *, customer: bool = False, collateral: bool = False
) -> DataFrame:
    """``lineitem`` as silver loans of the loan system."""
    columns = _loan_columns()
    lines = _loan_lines(spark, sf_dir, customer, collateral)
    loans = lines.select(*[c.alias(name) for name, c in columns.items()])
    value = F.col("collateral_value")
    ltv = F.round(F.col("outstanding_principal") * 100 / F.when(value > 0, value), 2).cast(MONEY)
    return loans.withColumn("ltv_ratio", ltv)


def bronze_npa_report(
    spark: SparkSession, sf_dir: str, *, customer: bool = False, collateral: bool = False
) -> DataFrame:
    """``lineitem`` as raw NPA report lines; loan ids repeat."""
    c = _loan_columns()
    nothing = F.lit(None).cast("string")
    total = (c["outstanding_principal"] + c["outstanding_interest"]).cast("decimal(9,2)")
    provision = total * c["interest_rate"] * F.lit("0.01").cast("decimal(2,2)")
    dirty = F.when(F.col("l_partkey") % 53 == 0, "N/A").otherwise(_text(c["outstanding_principal"]))
    status = c["npa_status"]
    messy = F.when(F.col("l_partkey") % 9 == 0, F.concat(F.lower(status), F.lit(" "))).otherwise(status)
    return _loan_lines(spark, sf_dir, customer, collateral).select(
        F.lit("2026-04-14").alias("report_date"),
        c["loan_id"].alias("loan_id"),
        _text(c["customer_id"]).alias("customer_id"),
        c["customer_name"].alias("customer_name"),
        c["loan_type"].alias("loan_type"),
        c["branch_code"].alias("branch_code"),
        _text(c["sanctioned_amount"]).alias("sanctioned_amount"),
        dirty.alias("outstanding_principal"),
        _text(c["outstanding_interest"]).alias("outstanding_interest"),
        _text(total.cast(MONEY)).alias("total_outstanding"),
        F.when(F.col("l_partkey") % 59 != 0, _text(c["dpd"])).otherwise("n.a.").alias("dpd"),
        status.alias("asset_classification"),
        messy.alias("npa_status"),
        F.when(status == "NPA", F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise("").alias("npa_date"),
        _text(c["interest_rate"]).alias("provision_required_pct"),
        _text(provision.cast(MONEY)).alias("provision_amount"),
        c["collateral_type"].alias("collateral_type"),
        F.coalesce(_text(c["collateral_value"]), F.lit("")).alias("collateral_value"),
        *[nothing.alias(name) for name in (
            "net_npa_exposure", "recovery_action", "recovery_amount", "last_review_date",
            "next_review_date", "relationship_manager", "remarks",
        )],
    )


def bronze_lms_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as raw loans of the loan system; loan ids repeat."""
    c = _loan_columns()
    nothing = F.lit(None).cast("string")
    given = {name: _text(column).alias(name) for name, column in c.items()}
    empty = (
        "product_code", "disbursed_amount", "emi_amount", "tenure_months", "remaining_tenure",
        "disbursement_date", "maturity_date", "asset_classification", "provision_percent",
        "last_payment_amount", "relationship_manager",
    )
    return _loan_lines(spark, sf_dir, True, True).select(
        *given.values(), *[nothing.alias(name) for name in empty]
    )


def bronze_bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as raw bureau reports."""
    n, nothing = F.col("c_custkey"), F.lit(None).cast("string")
    score = F.floor(300 + (F.col("c_acctbal") + 1000) / 11000 * 600)
    owed = (F.col("c_acctbal").cast(MONEY) + 1000).cast(MONEY)
    return load(spark, sf_dir, "customer").select(
        F.concat(F.lit("CBR"), _text(n)).alias("report_id"),
        _text(n).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("PANXX"), F.lpad(_text(n), 4, "0"), F.lit("Z")).alias("pan"),
        F.when(n % 31 == 0, "NA").when(n % 37 == 0, "").otherwise(_text(score)).alias("cibil_score"),
        F.lit("2026-04-01").alias("score_date"),
        *[_text(n % 9).alias(name) for name in (
            "total_accounts", "active_accounts", "closed_accounts", "overdue_accounts",
        )],
        _text(owed).alias("total_outstanding"),
        _text(owed).alias("secured_outstanding"),
        F.lit("0.00").alias("unsecured_outstanding"),
        _text(n % 100).alias("credit_utilization_pct"),
        *[nothing.alias(name) for name in ("enquiry_count_6m", "enquiry_count_12m")],
        *[_text(n % 4).alias(name) for name in ("dpd_30_count", "dpd_60_count", "dpd_90_count")],
        F.lit("0.00").alias("written_off_amount"),
        nothing.alias("suit_filed_count"),
        F.when(n % 50 == 0, "YES").otherwise("NO").alias("wilful_defaulter"),
        F.lit("2026-04-14").alias("report_pull_date"),
        F.lit("BUREAU").alias("report_source"),
    )


def silver_bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.floor(300 + (F.col("c_acctbal") + 1000) / 11000 * 600).cast("int")
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), score.alias("cibil_score")
    )


def bronze_aml_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw alerts without a customer name."""
    n, nothing = F.col("event_id"), F.lit(None).cast("string")
    status = _choice(n % 4, ("OPEN", "\topen\n", "UNDER_REVIEW", "CLOSED"))
    return load(spark, sf_dir, "events").select(
        F.concat(F.lit("AML"), _text(n)).alias("alert_id"),
        _text("user_id").alias("customer_id"),
        nothing.alias("customer_name"),
        F.date_format("ts", "yyyy-MM-dd").alias("alert_date"),
        F.lit("VELOCITY").alias("alert_type"),
        F.when(n % 43 == 0, "high").otherwise(_text(n % 40 + 60)).alias("risk_score"),
        F.lit("RULE_HIGH_VELOCITY").alias("rule_triggered"),
        _text(n).alias("transaction_ids"),
        _text(_amount()).alias("total_amount"),
        F.lit("INR").alias("currency"),
        F.lit("").alias("description"),
        status.alias("status"),
        nothing.alias("assigned_to"),
        F.lit("HIGH").alias("priority"),
        *[nothing.alias(name) for name in (
            "due_date", "resolution", "resolution_date", "sar_filed", "sar_reference",
        )],
    )


def transaction_envelopes(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Raw transactions as messages, some of them malformed."""
    raw = bronze_transactions(spark, sf_dir)
    fields = [c for c in raw.columns if not c.startswith("kafka_")]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return raw.select(
        F.col("txn_id").alias("key"),
        F.when(F.col("kafka_offset") % 71 == 0, "{bad").otherwise(value).alias("value"),
        F.lit(topic).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )
