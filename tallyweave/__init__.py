"""Reconciliation of financial ledgers on PySpark, and checks on the data that goes in."""

from .config import BankColumns, GlColumns, JobConfig, SalesColumns
from .plans import JobResult, run

__all__ = ["BankColumns", "GlColumns", "JobConfig", "JobResult", "SalesColumns", "run"]
