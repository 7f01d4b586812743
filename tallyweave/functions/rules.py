"""The business rules as column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import MONEY

# The names of the outcomes.
MISSING_IN_GL = "MISSING_IN_GL"
MISSING_IN_BANK = "MISSING_IN_BANK"
MULTI_SYSTEM_VARIANCE = "MULTI_SYSTEM_VARIANCE"
GL_VARIANCE = "GL_VARIANCE"
BANK_VARIANCE = "BANK_VARIANCE"
TIMING_DIFFERENCE = "TIMING_DIFFERENCE"
MATCHED = "MATCHED"
ANOMALY, NORMAL = "ANOMALY", "NORMAL"
HIGH, MEDIUM, NONE = "HIGH", "MEDIUM", "NONE"
GREEN, AMBER, RED = "GREEN", "AMBER", "RED"


def gap(left: str, right: str) -> Column:
    """``left`` minus ``right``, a missing amount counting as zero."""
    zero = F.lit(0).cast(MONEY)
    return F.coalesce(F.col(left), zero) - F.coalesce(F.col(right), zero)


def reconciliation_status(
    in_gl: Column,
    in_bank: Column,
    gl_gap: Column,
    bank_gap: Column,
    days_to_post: Column,
    tolerance: Decimal,
    late_after_days: int,
) -> Column:
    """One status per row; the first rule that holds decides. A gap equal to the tolerance is none."""
    off_gl = F.abs(gl_gap) > F.lit(tolerance)
    off_bank = F.abs(bank_gap) > F.lit(tolerance)
    rules = [
        (~in_gl, MISSING_IN_GL),
        (~in_bank, MISSING_IN_BANK),
        (off_gl & off_bank, MULTI_SYSTEM_VARIANCE),
        (off_gl, GL_VARIANCE),
        (off_bank, BANK_VARIANCE),
        (days_to_post > F.lit(late_after_days), TIMING_DIFFERENCE),
    ]
    (test, name), *rest = rules
    status = F.when(test, F.lit(name))
    for test, name in rest:
        status = status.when(test, F.lit(name))
    return status.otherwise(F.lit(MATCHED))


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    """Distance from the mean in deviations, to 3 places; a zero deviation counts as one."""
    unit = F.when(deviation == 0, F.lit(1.0)).otherwise(deviation)
    return F.round((value.cast("double") - mean) / unit, 3)


def rag_rating(rate: Column, green_from: float = 99.0, amber_from: float = 95.0) -> Column:
    """Traffic light of a percentage; no percentage is RED."""
    return (
        F.when(rate >= green_from, F.lit(GREEN))
        .when(rate >= amber_from, F.lit(AMBER))
        .otherwise(F.lit(RED))
    )
