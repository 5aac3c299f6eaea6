"""Unpivot the six monthly columns into rows.

``stack`` is one Generate over a single scan. A six-branch UNION ALL would scan
the source six times, and Catalyst does not merge those branches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import encodings as enc
from ..schema import MONTHS


def _stack(groups: list[list[str]], names: list[str]) -> str:
    args = ", ".join(", ".join(g) for g in groups)
    return f"stack({len(groups)}, {args}) AS ({', '.join(names)})"


def repayment_history(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """fact_repayment_history (customer_id, statement_month, timeliness_code, dpd).

    NULL codes are kept (one row per customer and month), their dpd is 0."""
    expr = _stack([[f"{i}", f"timeliness_{i}"] for i in MONTHS], ["statement_month", "timeliness_code"])
    long = raw.select("customer_id", F.expr(expr))
    return long.select(
        "customer_id",
        F.col("statement_month").cast("smallint").alias("statement_month"),
        "timeliness_code",
        enc.dpd(F.col("timeliness_code"), lenient).cast("smallint").alias("dpd"),
    )


def statements(raw: DataFrame) -> DataFrame:
    """fact_statements (customer_id, statement_month, bill_amount, payment_amount).

    Paired unpivot (two value columns per month), so ``DataFrame.unpivot`` with its
    single value column does not fit; ``stack`` does."""
    expr = _stack([[f"{i}", f"balance_{i}", f"payment_{i}"] for i in MONTHS],
                  ["statement_month", "bill_amount", "payment_amount"])
    long = raw.select("customer_id", F.expr(expr))
    return long.select(
        "customer_id",
        F.col("statement_month").cast("smallint").alias("statement_month"),
        "bill_amount",
        "payment_amount",
    )
