"""Whole-table runs composed of the operators."""

from siftwell.plans.config import RunConfig
from siftwell.plans.quality_run import QualityRun, QualityRunModel

__all__ = ["QualityRun", "QualityRunModel", "RunConfig"]
