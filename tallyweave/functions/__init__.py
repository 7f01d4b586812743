"""Column expressions shared by the operators. Built-in Spark functions only."""

from .columns import clean_text, col, money, outside_range
from .dates import as_date, in_year, month_of, outside_dates
from .rules import gap, rag_rating, reconciliation_status, z_score

__all__ = [
    "as_date", "clean_text", "col", "gap", "in_year", "money", "month_of", "outside_dates",
    "outside_range", "rag_rating", "reconciliation_status", "z_score",
]
