from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake import functions as fn


def one(spark, value, expression, type_="string"):
    df = spark.createDataFrame([(value,)], f"x {type_}")
    return df.select(expression.alias("y")).first()["y"]


@pytest.mark.parametrize("text, expected", [
    ("ABCPK1234A", "XXXXX1234A"), ("AB", "XXXXX"), (None, None),
])
def test_mask_pan(spark, text, expected):
    assert one(spark, text, fn.mask_pan("x")) == expected


@pytest.mark.parametrize("text, expected", [
    ("9876543210", "XXXXXX3210"), ("98", "XXXXXX"), (None, None),
])
def test_mask_mobile(spark, text, expected):
    assert one(spark, text, fn.mask_mobile("x")) == expected


@pytest.mark.parametrize("text, expected", [
    ("a.b@mail.example", "***@mail.example"), ("noat", "***"), ("a@b@c", "***@c"), (None, None),
])
def test_mask_email(spark, text, expected):
    assert one(spark, text, fn.mask_email("x")) == expected


@pytest.mark.parametrize("text, expected", [
    ("1000.5", Decimal("1000.50")), ("1.23456789E7", Decimal("12345678.90")), ("abc", None),
    ("", None), ("12.345", Decimal("12.35")), (None, None), ("99999999999999999999", None),
])
def test_to_money(spark, text, expected):
    assert one(spark, text, fn.to_money("x")) == expected


@pytest.mark.parametrize("text, whole, strict", [
    ("12", 12, 12), ("12.7", 12, None), ("abc", None, None), ("", None, None), (" 7 ", 7, 7),
    ("-3", -3, -3), ("99999999999", None, None), (None, None, None),
])
def test_ints(spark, text, whole, strict):
    assert one(spark, text, fn.to_int("x")) == whole
    assert one(spark, text, fn.strict_int("x")) == strict


def test_both_timestamp_spellings(spark):
    spaced = one(spark, "2026-04-14 09:15:30", fn.to_timestamp("x"))
    assert spaced == one(spark, "2026-04-14T09:15:30", fn.to_timestamp("x"))
    assert (spaced.hour, spaced.minute) == (9, 15)
    assert one(spark, "xx", fn.to_timestamp("x")) is None


@pytest.mark.parametrize("text, blank", [(None, True), ("", True), ("  ", True), ("\t\r\n", True), (" a", False)])
def test_blank(spark, text, blank):
    assert one(spark, text, fn.is_blank("x")) is blank
    assert one(spark, text, fn.blank_to_null("x")) == (None if blank else text)


@pytest.mark.parametrize("text", ["!", "a", " a", "\x00", "\x1f", "\x7f", "é", "\u00a0", "\u2003", "\ta", "\x0b", "\f\r\n "])
def test_blank_by_its_first_character_or_by_trimming(spark, text):
    assert one(spark, text, fn.blank_to_null("x")) == (text if text.strip(" \t\n\x0b\f\r") else None)


def test_text_that_is_not_blank_is_not_trimmed(spark):
    """Trimming by a set of characters costs many times a comparison, so a comparison goes first."""
    plan = spark.createDataFrame([("a",)], "x string").select(fn.blank_to_null("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index(">= !") < plan.index("trim(")


def test_normalised(spark):
    assert one(spark, " cash ", fn.normalised("x")) == "CASH"


def test_severity_and_provision(spark):
    ranks = [one(spark, s, fn.severity_rank("x")) for s in ("STANDARD", "SMA-1", "SMA-2", "NPA", "XYZ", None)]
    assert ranks == [1, 2, 3, 4, None, None]
    pcts = [one(spark, s, fn.provision_pct("x")) for s in ("STANDARD", "SMA-1", "SMA-2", "NPA", "XYZ")]
    assert pcts == [Decimal(p) for p in ("0.40", "5.00", "15.00", "25.00", "0.00")]


@pytest.mark.parametrize("statuses, worst, lexical", [
    (["NPA", "SMA-1", "STANDARD"], "NPA", "STANDARD"),
    (["STANDARD", "XYZ"], "STANDARD", "XYZ"),
    (["XYZ", None], None, "XYZ"),
    ([None], None, None),
])
def test_worst_status(spark, statuses, worst, lexical):
    df = spark.createDataFrame([(s,) for s in statuses], "x string")
    got = df.agg(fn.worst_status("x").alias("w"), fn.worst_status("x", "lexical").alias("l")).first()
    assert (got["w"], got["l"]) == (worst, lexical)
    with pytest.raises(ValueError):
        fn.worst_status("x", "other")


def test_money_avg_rounds_once(spark):
    # The mean is 0.00499999..., which six digits would show as 0.005000 and round up to 0.01.
    n = 20_000_001
    df = spark.range(n).select(F.when(F.col("id") < 9_999_999, 1).otherwise(0).alias("c"))
    exact = df.select((F.col("c") / 100).cast("decimal(18,2)").alias("x"))
    assert exact.agg(fn.money_avg("x")).first()[0] == Decimal("0.00")
    assert exact.agg(F.round(F.avg("x"), 2)).first()[0] == Decimal("0.01")


def test_money_avg_half_up_and_null(spark):
    df = spark.createDataFrame([("a", "0.01"), ("a", "0.02"), ("a", None), ("b", None)], "k string, v string")
    got = df.groupBy("k").agg(fn.money_avg(fn.to_money("v")).alias("m")).collect()
    assert {r["k"]: r["m"] for r in got} == {"a": Decimal("0.02"), "b": None}


def test_conditional_count_is_null_over_no_rows(spark):
    df = spark.createDataFrame([(1,), (5,)], "x int")
    assert df.agg(fn.conditional_count(F.col("x") > 3)).first()[0] == 1
    assert df.filter("x > 9").agg(fn.conditional_count(F.col("x") > 3)).first()[0] is None


def test_percent_of(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (0, 5), (1, 0)], "p bigint, t bigint")
    got = [r[0] for r in df.select(fn.percent_of(F.col("p"), F.col("t"))).collect()]
    assert got == [Decimal("12.50"), Decimal("33.33"), Decimal("0.00"), None]
