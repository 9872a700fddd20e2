"""Text keys and cleaning (operators N1, N2, N5).

Text comparison in the source system ignores trailing blanks and, under its
usual collation, case.  Keys are therefore compared through ``norm_key``:
``rtrim`` always, ``upper`` when ``case_insensitive``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: order-number noise removed by N1, in this order.
ORDER_NOISE = ("MO", "-", " ", "/", ".", "#")


def norm_key(c: Column, case_insensitive: bool = True) -> Column:
    """Key as the source collation compares it."""
    k = F.rtrim(c)
    return F.upper(k) if case_insensitive else k


def collated(c: Column, collation: str | None) -> Column:
    """Text that compares and sorts by a collation of Spark (``UNICODE_CI``, ``de_CI_AI``, ...);
    without one as it is, by code points."""
    return F.collate(c, collation) if collation else c


def text_max(c: str, collation: str | None) -> Column:
    """MAX of a text column under the collation, as plain text.  Of spellings that the
    collation takes as equal, the greatest by code points."""
    if not collation:
        return F.max(c)
    return F.max(F.struct(collated(F.col(c), collation).alias("o"), F.col(c).alias("t")))["t"]


def group_by_keys(df: DataFrame, keys: dict[str, Column], plain: list[str], aggs: list[Column],
                  case_insensitive: bool = True) -> DataFrame:
    """GROUP BY text keys as the source collation compares them.

    Each of ``keys`` (output name -> text) is grouped by its ``norm_key`` and shown
    by its least spelling in the group; ``plain`` columns group by value.  Output:
    keys, plain columns, aggregates."""
    d = df.withColumns({f"_g{i}": c for i, c in enumerate(keys.values())})
    by = [norm_key(F.col(f"_g{i}"), case_insensitive).alias(f"_k{i}") for i in range(len(keys))]
    shown = [F.min(f"_g{i}").alias(f"_s{i}") for i in range(len(keys))]
    out = d.groupBy(*by, *[F.col(c).alias(f"_p{i}") for i, c in enumerate(plain)]).agg(*shown, *aggs)
    drop = {f"_{t}{i}" for t in "ksgp" for i in range(len(keys) + len(plain))}
    return out.select(*[F.col(f"_s{i}").alias(n) for i, n in enumerate(keys)],
                      *[F.col(f"_p{i}").alias(n) for i, n in enumerate(plain)],
                      *[c for c in out.columns if c not in drop])


def str_eq(c: Column, value: str, case_insensitive: bool = True) -> Column:
    """`c = 'value'` with collation semantics (NULL stays NULL)."""
    v = value.rstrip()
    return norm_key(c, case_insensitive) == F.lit(v.upper() if case_insensitive else v)


def not_like_prefix(c: Column, prefix: str, case_insensitive: bool = True) -> Column:
    """`c NOT LIKE 'prefix%'` (NULL stays NULL)."""
    if case_insensitive:
        return ~F.upper(c).startswith(prefix.upper())
    return ~c.startswith(prefix)


def varchar(c: Column, n: int) -> Column:
    """Explicit CAST(... AS varchar(n)): truncate to n characters."""
    return F.substring(c.cast("string"), 1, n)


def clean_order(c: Column, case_insensitive: bool = True) -> Column:
    """Strip MO, '-', ' ', '/', '.', '#' in that order; varchar(255), trim, upper.

    The chain is ordered, so ``M-O12`` becomes ``MO12``.  With a
    case-insensitive collation the replace also matches ``mo``; upper-casing
    first gives the same result because the output is upper-cased anyway.
    """
    x = F.upper(c) if case_insensitive else c
    for tok in ORDER_NOISE:
        x = F.replace(x, F.lit(tok), F.lit(""))
    return F.upper(F.trim(varchar(x, 255)))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def first_non_blank(*cols: Column) -> Column:
    """COALESCE(NULLIF(TRIM(a), ''), NULLIF(TRIM(b), ''), ...)."""
    return F.coalesce(*[blank_to_null(c) for c in cols])
