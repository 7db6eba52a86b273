"""Configuration of a full quality run."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql import Column

from siftwell.operators.cleaning import TableCleaner
from siftwell.operators.outliers import OutlierDetector


@dataclass(frozen=True)
class RunConfig:
    """Settings of :class:`siftwell.plans.quality_run.QualityRun`.

    ``null_representations``: None for the default markers, empty for none.
    ``pre_profile_output`` / ``post_profile_output``: folders for the profile reports.
    ``validate_after``: check the contract on the cleaned table too, so that the scores before
    and after can be compared. ``materialize``: store the cleaned table in the shared folder
    instead of deduplicating again in every later pass. ``distinct``: ``exact``, or ``approx`` for
    estimated distinct counts with a standard error of ``approx_rsd``.
    """

    expected_schema: Any = None
    pre_profile_output: str | None = None
    post_profile_output: str | None = None
    null_representations: Sequence[str] | None = None
    drop_col_threshold: float = 0.80
    drop_row_threshold: int | None = None
    imputation_strategies: Mapping[str, str] = field(default_factory=dict)
    fill_values: Mapping[str, Any] = field(default_factory=dict)
    dedup_subset_cols: Sequence[str] | None = None
    dedup_order_by: Sequence[str | Column] | None = None
    outlier_cols: Sequence[str] | None = None
    outlier_method: str = "iqr"
    outlier_action: str = "flag"
    iqr_multiplier: float = 1.5
    zscore_threshold: float = 3.0
    relative_error: float = 0.01
    nan_is_null: bool = False
    keep_null_rows: bool = False
    uniqueness: str = "nonempty"
    validate_after: bool = False
    materialize: bool = True
    distinct: str = "exact"
    approx_rsd: float = 0.05

    def __post_init__(self):
        if self.distinct not in ("exact", "approx"):
            raise ValueError(f"distinct must be 'exact' or 'approx', not {self.distinct!r}")

    @staticmethod
    def from_dict(settings: Mapping[str, Any]) -> RunConfig:
        """From a flat dictionary; unknown keys are ignored with a warning."""
        known = {f.name for f in fields(RunConfig)}
        unknown = sorted(set(settings) - known)
        if unknown:
            warnings.warn(f"ignored settings: {unknown}", stacklevel=2)
        return RunConfig(**{k: v for k, v in settings.items() if k in known})

    def cleaner(self) -> TableCleaner:
        return TableCleaner(
            null_markers=self.null_representations,
            drop_col_threshold=self.drop_col_threshold,
            drop_row_threshold=self.drop_row_threshold,
            strategies=self.imputation_strategies,
            fill_values=self.fill_values,
            keys=self.dedup_subset_cols,
            order_by=self.dedup_order_by,
            relative_error=self.relative_error,
            nan_is_null=self.nan_is_null,
        )

    def detector(self) -> OutlierDetector:
        return OutlierDetector(
            columns=self.outlier_cols,
            method=self.outlier_method,
            action=self.outlier_action,
            iqr_multiplier=self.iqr_multiplier,
            zscore_threshold=self.zscore_threshold,
            relative_error=self.relative_error,
            keep_nulls=self.keep_null_rows,
        )
