"""Column helpers: order cleaning (G1), numeric text (G2), week number (G9), ratios."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from stockpulse.functions import (
    clean_order, money, norm_key, ratio_half_up, to_decimal_or_zero, trunc_ratio, try_date, us_week)


def _one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("y")).first()["y"]


def test_clean_order_g1(spark):
    assert _one(spark, clean_order(F.col("x")), "MO-00 12/3.4#") == "001234"
    assert _one(spark, clean_order(F.col("x")), "M-O12") == "MO12"  # ordered chain
    assert _one(spark, clean_order(F.col("x")), "mo12") == "12"     # case-insensitive default
    assert _one(spark, clean_order(F.col("x"), case_insensitive=False), "mo12") == "MO12"
    assert _one(spark, clean_order(F.col("x")), "Beg Bal") == "BEGBAL"


def test_numeric_text_g2(spark):
    f = to_decimal_or_zero(F.col("x"), 18, 5)
    assert _one(spark, f, " 12.5 ") == Decimal("12.50000")
    for v in ("N/A", "", None, "$5", "1,000"):
        assert _one(spark, f, v) == Decimal("0.00000")
    assert _one(spark, f, "-3") == Decimal("-3.00000")


def test_us_week_g9(spark):
    cases = {dt.date(2024, 1, 6): 1, dt.date(2024, 1, 7): 2, dt.date(2024, 12, 31): 53,
             dt.date(2025, 1, 5): 2, dt.date(2025, 1, 4): 1}
    for d, wk in cases.items():
        assert _one(spark, us_week(F.col("x")), d, "x date") == wk, d


def test_try_date(spark):
    day = dt.date(2026, 1, 5)
    shapes = ["2026-01-05", "2026-1-5", "2026/01/05", "2026.1.5", "1/5/2026", "01-05-2026", "1.5.2026", "1/5/26", "20260105", "260105",
              "5 Jan 2026", "05-JAN-2026", "5January2026", "Jan 5, 2026", "january 5 2026", "Jan. 5, 26", "2026 Jan 5"]
    times = ["", " 00:00:00", " 10:30", "T10:00:00", " 23:59:59.997", " 9:05 AM", " 11:59:59pm", "T10:00:00Z", "T10:00:00+05:30"]
    rows = [(s + t, day) for s in shapes for t in times]
    rows += [(x, None) for x in ("N/A", "", None, "2026-02-30", "13/1/2026", "2026-13-01", "20260230", "5 Foo 2026", "5 Janu 2026",
                                 "2026-01-05 25:00", "2026-01-05 10:61", "2026-01/05", "1/5", "2026", "0000-01-05", "123456789", "2026-01-05x")]
    rows += [("  2026-01-05 ", day), ("2/29/2024", dt.date(2024, 2, 29)), ("1/1/50", dt.date(1950, 1, 1)), ("1/1/49", dt.date(2049, 1, 1)), ("1/2/2026", dt.date(2026, 1, 2))]
    df = spark.createDataFrame(rows, "x string, day date").withColumn("got", try_date(F.col("x")))
    assert [tuple(r) for r in df.where("NOT (got <=> day)").collect()] == []
    assert _one(spark, try_date(F.col("x"), ("yyyy_DDD",)), "2026_005") == day  # a pattern of one's own


def test_ratio_half_up_exact(spark):
    df = spark.createDataFrame([(Decimal("1417.5"), 7), (Decimal("0.0001"), 200), (Decimal("-1"), 3),
                                (Decimal("5"), 0)], "n decimal(20,5), d int")
    got = [r["q"] for r in df.select(ratio_half_up("n", "d", 6).alias("q")).collect()]
    assert got == [Decimal("202.500000"), Decimal("0.000001"), Decimal("-0.333333"), None]


def test_ratio_half_up_of_wide_numbers(spark):
    """Sums of 1e18 and more, where an integer quotient leaves 64 bits."""
    D = Decimal
    cases = [("1e18", "1", "1000000000000000000.000000"), ("1e27", "1e5", "1e22"), ("123456789012345678901234567.1234567891", "1", "123456789012345678901234567.123457"),
             ("999999999999999999999999999", "7", "142857142857142857142857142.714286"), ("-1e24", "3", "-333333333333333333333333.333333"),
             ("5", "999999999999999999999999999", "0"), ("1e26", "2e26", "0.5"), ("0.0000005", "1", "0.000001"), ("-0.0000005", "1", "-0.000001"),
             ("1e20", "0.0000000001", "1e30"), ("1", "0", None)]
    df = spark.createDataFrame([(D(n), D(d)) for n, d, _ in cases], "n decimal(38,10), d decimal(38,10)")
    got = [r["q"] for r in df.select(ratio_half_up("n", "d", 6).alias("q")).collect()]
    assert got == [None if q is None else D(q) for _, _, q in cases]
    # out of range: NULL, and the other rows still come
    far = spark.createDataFrame([(D("9e30"), D("1")), (D("3"), D("2"))], "n decimal(38,5), d decimal(38,5)")
    assert [r["q"] for r in far.select(ratio_half_up("n", "d", 6).alias("q")).collect()] == [None, D("1.500000")]


def test_ratio_half_up_on_random_numbers(spark):
    import random
    from decimal import ROUND_HALF_UP, localcontext
    rnd = random.Random(1)
    rows = [(Decimal(rnd.randint(-10 ** rnd.randint(1, 36), 10 ** rnd.randint(1, 36))).scaleb(-10),
             Decimal(rnd.choice([1, -1]) * rnd.randint(1, 10 ** rnd.randint(1, 30))).scaleb(-5)) for _ in range(300)]
    df = spark.createDataFrame(rows, "n decimal(38,10), d decimal(38,5)").select("n", "d", ratio_half_up("n", "d", 6).alias("q"))
    with localcontext() as ctx:
        ctx.prec = 90
        for n, d, q in df.collect():
            want = (n / d).quantize(Decimal("0.000001"), ROUND_HALF_UP)
            assert q == (want if abs(want) < Decimal("1e31") else None), (n, d)


def test_trunc_ratio_truncates(spark):
    df = spark.createDataFrame([(45,), (60,), (100,)], "l int")
    got = [r["q"] for r in df.select(trunc_ratio("l", 7, 6).alias("q")).collect()]
    assert got == [Decimal("6.428571"), Decimal("8.571428"), Decimal("14.285714")]


def test_money_rounds_on_decimal_form(spark):
    assert _one(spark, money(F.col("x")), 1.005, "x double") == Decimal("1.01")
    assert _one(spark, money(F.col("x")), 450.615, "x double") == Decimal("450.62")


def test_norm_key(spark):
    assert _one(spark, norm_key(F.col("x")), "ab  ") == "AB"
    assert _one(spark, norm_key(F.col("x"), False), "ab  ") == "ab"
