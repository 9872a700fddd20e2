"""Tolerant text -> decimal parsing (N3, N3b) and float -> money rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Plain signed decimal literal.  The source's numeric test also accepts
# currency signs, thousands separators and exponents, after which its CAST
# fails; such inputs are treated as not numeric (-> default).
NUMERIC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def to_decimal_or_zero(c: Column, precision: int, scale: int) -> Column:
    """CASE WHEN numeric(trim(c)) THEN CAST(trim(c) AS decimal(p,s)) ELSE 0."""
    t = F.trim(c)
    dec = DecimalType(precision, scale)
    zero = F.lit(0).cast(dec)
    return F.coalesce(F.when(t.rlike(NUMERIC_RE), t.try_cast(dec)), zero)


def try_decimal(c: Column, precision: int, scale: int) -> Column:
    """TRY_CAST(c AS decimal(p,s)); NULL when not parseable.

    The source's decimal parsing takes no exponent, so ``1e3`` is NULL."""
    t = F.trim(c)
    return F.when(t.rlike(NUMERIC_RE), t.try_cast(DecimalType(precision, scale)))


def money(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """CAST(float AS decimal(p,s)) through decimal(38,10).

    Going through a wide decimal first rounds on the shortest decimal form of
    the float, so a value printed as 450.615 becomes 450.62 however the
    float's binary expansion falls.
    """
    return c.cast(DecimalType(38, 10)).cast(DecimalType(precision, scale))


def ratio_half_up(num: str, den: str, scale: int) -> Column:
    """ROUND(num / den, scale), half away from zero, computed exactly.

    ``num`` and ``den`` are SQL expressions over named columns, read at 10 decimal
    places.  Both become whole numbers of 10^-10 (integer and fractional part apart,
    so no product is rounded); the quotient's integer part comes from the exact
    remainder, its decimals by long division of what is left.  Takes numbers below
    10^27; beyond that, and where den = 0, the result is NULL, not an error.  Where the
    scaled quotient fits into 64 bits, one integral division gives the same."""
    whole = DecimalType(38, 0)

    def units(text: str) -> Column:
        """The number in units of 10^-10."""
        v = F.expr(text).try_cast(DecimalType(38, 10))
        full = F.try_multiply((v - v % 1).try_cast(DecimalType(28, 0)), F.lit(10 ** 10))
        return F.try_add(full, (v % 1 * F.lit(10 ** 10)).cast(DecimalType(10, 0))).try_cast(whole)

    def size(v: Column) -> Column:  # abs() and unary minus round to 34 digits
        return F.when(v < 0, (F.lit(0) - v).cast(whole)).otherwise(v)

    def divide(x: Column) -> Column:
        n, d = x["n"], F.nullif(x["d"], F.lit(0).cast(whole))

        def digit(acc: Column, _: Column) -> Column:
            left = F.try_multiply(acc["left"], F.lit(10)).try_cast(whole)
            return F.struct((acc["digits"] * 10 + F.try_divide(left - left % d, d).cast("long")).alias("digits"),
                            (left % d).cast(whole).alias("left"))

        start = F.struct(F.lit(0).cast("long").alias("digits"), (n % d).cast(whole).alias("left"))
        tail = F.aggregate(F.sequence(F.lit(1), F.lit(scale)), start, digit, lambda acc: F.when(
            acc["left"] >= d - acc["left"], acc["digits"] + 1).otherwise(acc["digits"]))
        integer = F.try_divide(n - n % d, d).try_cast(DecimalType(37 - scale, 0))
        integer = F.when(x["below"], F.lit(0) - integer).otherwise(integer).cast(DecimalType(37 - scale, 0))
        tail = F.when(x["below"], -tail).otherwise(tail).cast(DecimalType(scale + 1, 0))
        return (integer + tail * F.lit(10.0 ** -scale).cast(DecimalType(scale + 1, scale))).cast(DecimalType(38, scale))

    # one-element arrays hand a value on by name, so that no expression is repeated
    pair = F.array(F.struct(units(num).alias("n"), units(den).alias("d")))
    pair = F.transform(pair, lambda x: F.struct(size(x["n"]).alias("n"), size(x["d"]).alias("d"),
                                                ((x["n"] < 0) != (x["d"] < 0)).alias("below")))
    wide = F.get(F.transform(pair, divide), F.lit(0))
    a, b = f"try_cast({num} AS DECIMAL(24,10))", f"try_cast({den} AS DECIMAL(24,10))"
    short = F.expr(f"(abs({a}) * {2 * 10 ** scale} + abs({b})) div (abs({b}) * 2)").cast(DecimalType(20, 0))
    short = F.when((F.expr(num) < 0) != (F.expr(den) < 0), -short).otherwise(short)
    unit = F.lit(10.0 ** -scale).cast(DecimalType(scale + 1, scale))
    small = (F.abs(F.expr(num)) < 10 ** 9) & F.abs(F.expr(den)).between(0.001, 10 ** 9)
    return F.when(small, (short * unit).cast(DecimalType(38, scale))).otherwise(wide)


def trunc_ratio(num: str, den: int, scale: int) -> Column:
    """Decimal division that truncates at ``scale`` (the source engine's
    decimal quotient), for a non-negative integer numerator expression."""
    unit = f"CAST({10.0 ** -scale!r} AS DECIMAL({scale + 1},{scale}))"
    return F.expr(f"CAST(({num} * {10 ** scale}) div {den} AS DECIMAL(20,0)) * {unit}")
