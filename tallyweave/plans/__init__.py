"""Whole jobs composed of the operators."""

from .reconciliation import JobResult, cleanse_all, gate_all, process, reconcile, run, write_outputs

__all__ = ["JobResult", "cleanse_all", "gate_all", "process", "reconcile", "run", "write_outputs"]
