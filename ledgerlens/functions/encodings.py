"""Domain encodings as native Column expressions (no Python UDFs).

Each builder takes and returns a Column, so the whole feature pass stays inside
whole-stage codegen. Labels and cut points come from ``ledgerlens.schema``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (
    AGE_BAND_EDGES, AGE_BAND_LABELS, DEFAULT_YES, EDUCATION_MAP, GRADE_EDGES, GRADE_LABELS,
    LIMIT_BAND_EDGES, LIMIT_BAND_LABELS, MARITAL_MAP, SCORE_MONTHS_WEIGHT, SCORE_RATIO_CAP,
    SCORE_RATIO_WEIGHT, SCORE_UTIL_FLOOR, SCORE_UTIL_WEIGHT, SCORE_WORST_DPD_WEIGHT,
    STAGE_EDGES, STAGE_LABELS, UNKNOWN,
)
from .numeric import dlit


def _left_closed_bands(x: Column, edges, labels) -> Column:
    """CASE WHEN x < e1 THEN l1 ... ELSE last END (NULL x falls through to the last label)."""
    expr = None
    for edge, label in zip(edges, labels):
        expr = F.when(x < F.lit(edge), F.lit(label)) if expr is None else expr.when(x < F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def limit_band(limit: Column) -> Column:
    """Credit-limit band, left-closed bins; 50,000 belongs to '50K-100K'."""
    return _left_closed_bands(limit, LIMIT_BAND_EDGES, LIMIT_BAND_LABELS)


def limit_band_right_closed(limit: Column) -> Column:
    """Right-closed bins (0,50000], (50000,100000], ..., (500000, inf); <= 0 or NULL -> NULL."""
    expr = F.when(limit.isNull() | (limit <= F.lit(0)), F.lit(None).cast("string"))
    for edge, label in zip(LIMIT_BAND_EDGES, LIMIT_BAND_LABELS):
        expr = expr.when(limit <= F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(LIMIT_BAND_LABELS[-1]))


def limit_band_order(band: Column) -> Column:
    """Sort key for a band label (1..6), unknown labels last."""
    expr = None
    for i, label in enumerate(LIMIT_BAND_LABELS, start=1):
        expr = F.when(band == F.lit(label), F.lit(i)) if expr is None else expr.when(band == F.lit(label), F.lit(i))
    return expr.otherwise(F.lit(len(LIMIT_BAND_LABELS)))


def age_band(age: Column) -> Column:
    """Age band; NULL age falls through to '65+' exactly like the SQL CASE."""
    return _left_closed_bands(age, AGE_BAND_EDGES, AGE_BAND_LABELS)


def age_band_order(band: Column) -> Column:
    expr = None
    for i, label in enumerate(AGE_BAND_LABELS, start=1):
        expr = F.when(band == F.lit(label), F.lit(i)) if expr is None else expr.when(band == F.lit(label), F.lit(i))
    return expr.otherwise(F.lit(len(AGE_BAND_LABELS)))


def gender_label(g: Column) -> Column:
    """INITCAP(TRIM(gender))."""
    return F.initcap(F.trim(g))


def _code_map(x: Column, mapping: dict) -> Column:
    key = F.trim(F.lower(x))
    expr = None
    for code, label in mapping.items():
        expr = F.when(key == F.lit(code), F.lit(label)) if expr is None else expr.when(key == F.lit(code), F.lit(label))
    return expr.otherwise(F.lit(UNKNOWN))


def education_label(x: Column) -> Column:
    """Trimmed, lower-cased code -> label, else 'Unknown' (NULL included)."""
    return _code_map(x, EDUCATION_MAP)


def marital_label(x: Column) -> Column:
    """P5."""
    return _code_map(x, MARITAL_MAP)


def dpd(code: Column, lenient: bool = False) -> Column:
    """P7: 'm-2'..'m+8' -> months past due: strip 'm', cast to int, clamp at 0.

    NULL code -> 0 (GREATEST skips NULL). A malformed code raises in strict mode
    (ANSI cast), and becomes 0 in lenient mode (the category audit reports it).
    """
    digits = F.replace(code, F.lit("m"), F.lit(""))
    n = digits.try_cast("int") if lenient else digits.cast("int")
    return F.greatest(n, F.lit(0))


def stage(d: Column) -> Column:
    """Collections stage from a DPD value."""
    return _upper_closed_stage(d)


def _upper_closed_stage(d: Column) -> Column:
    expr = None
    for edge, label in zip(STAGE_EDGES, STAGE_LABELS):
        expr = F.when(d <= F.lit(edge), F.lit(label)) if expr is None else expr.when(d <= F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(STAGE_LABELS[-1]))


def risk_grade(score: Column) -> Column:
    """P16."""
    return _left_closed_bands(score, GRADE_EDGES, GRADE_LABELS)


def default_flag(raw: Column) -> Column:
    """LOWER(default_raw) = 'yes' -> 1 else 0 (NULL -> 0)."""
    return F.when(F.lower(raw) == F.lit(DEFAULT_YES), F.lit(1)).otherwise(F.lit(0))


def risk_score_raw(worst: Column, months: Column, util: Column, ratio: Column) -> Column:
    """P15 before rounding, exact decimal. NULL utilization contributes 0 (GREATEST skips NULL)."""
    util_term = F.greatest(util - dlit(SCORE_UTIL_FLOOR), F.lit(0)) * F.lit(SCORE_UTIL_WEIGHT)
    ratio_term = F.greatest(dlit(SCORE_RATIO_CAP) - ratio, F.lit(0)) * F.lit(SCORE_RATIO_WEIGHT)
    return (worst * F.lit(SCORE_WORST_DPD_WEIGHT) + months * F.lit(SCORE_MONTHS_WEIGHT)
            + util_term + ratio_term)


def dpd_bucket(d: Column) -> Column:
    """P20: '0 months'..'7 months', '8+ months'."""
    return F.when(d >= F.lit(8), F.lit("8+ months")).otherwise(F.concat(d.cast("string"), F.lit(" months")))


def dpd_bucket_order(d: Column) -> Column:
    return F.when(d >= F.lit(8), F.lit(999)).otherwise(d)


def clip(x: Column, lo, hi) -> Column:
    """clip(lo, hi)."""
    return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))
