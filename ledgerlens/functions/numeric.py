"""Exact decimal arithmetic helpers (rounding policy).

* money stays DECIMAL before any SUM, so sums are exact and order independent;
* an average is one division SUM/COUNT, never avg() of a rounded value;
* a quotient is computed in DECIMAL with a high result scale and rounded HALF_UP
  (``round`` on decimals), matching PostgreSQL numeric rounding, not binary half-even;
* report outputs are cast to DOUBLE (rounded values) or BIGINT (counts, 0-dp money).

Spark's division result scale is ``max(38 - (int_digits(num) + scale(den)), 6)`` once
precision would exceed 38, so operands are first cast to the narrowest decimal that
holds them: 20 integer digits (any BIGINT count, money sums up to 10^20).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

INT_DIGITS = 20


def dec(c: Column, frac: int = 0) -> Column:
    """Cast to DECIMAL(INT_DIGITS + frac, frac)."""
    return c.cast(DecimalType(INT_DIGITS + frac, frac))


def dlit(text: str) -> Column:
    """Exact decimal literal (``F.lit(0.8)`` would be DOUBLE and poison the expression)."""
    return F.lit(Decimal(text))


def quotient(num: Column, den: Column, scale: int, mult: int = 1,
             num_frac: int = 0, den_frac: int = 0) -> Column:
    """round(mult * num / nullif(den, 0), scale), exact decimal, HALF_UP.

    ``num_frac`` / ``den_frac`` are the decimal scales of the operands (0 for counts,
    2 for money, 3 for ratios). A zero or NULL denominator gives NULL.
    """
    n = dec(num, num_frac)
    if mult != 1:
        n = n * F.lit(mult)
    d = dec(den, den_frac)
    return F.round(n / F.nullif(d, F.lit(0)), scale)


def pct(num: Column, den: Column, scale: int = 2, num_frac: int = 0, den_frac: int = 0) -> Column:
    """100 * num / den rounded HALF_UP at ``scale``, as DOUBLE."""
    return quotient(num, den, scale, 100, num_frac, den_frac).cast("double")


def mean(x: Column, scale: int, mult: int = 1, frac: int = 0) -> Column:
    """Aggregate: round(mult * AVG(x), scale) as DOUBLE; NULLs skipped, empty -> NULL."""
    return quotient(F.sum(x), F.count(x), scale, mult, frac, 0).cast("double")


def mean_int(x: Column, frac: int = 0) -> Column:
    """Aggregate: ROUND(AVG(x), 0) as BIGINT."""
    return quotient(F.sum(x), F.count(x), 0, 1, frac, 0).cast("bigint")


def round_money(total: Column, scale: int = 0) -> Column:
    """ROUND(money, scale): BIGINT for scale 0, DOUBLE otherwise."""
    r = F.round(total, scale)
    return r.cast("bigint") if scale == 0 else r.cast("double")


def sum_skip_null(cols: list[Column]) -> Column:
    """Row-wise SUM over columns with SQL aggregate semantics: NULLs skipped, all NULL -> NULL."""
    total = None
    for c in cols:
        term = F.coalesce(c, F.lit(0))
        total = term if total is None else total + term
    return F.when(F.coalesce(*cols).isNull(), F.lit(None)).otherwise(total)


def fit_decimal(c: Column, precision: int, scale: int, lenient: bool) -> Column:
    """Store into DECIMAL(p, s): ANSI cast errors on overflow (strict, like the DDL);
    lenient mode yields NULL, which the domain/not-null audits then report."""
    t = DecimalType(precision, scale)
    return c.try_cast(t) if lenient else c.cast(t)
