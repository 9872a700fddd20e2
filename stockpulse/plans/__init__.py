"""Composed outputs (V1-V7, VS), report queries (P1-P7) and checks."""

from stockpulse.plans.views import LedgerRun, checkpoint_dir

__all__ = ["LedgerRun", "checkpoint_dir"]
