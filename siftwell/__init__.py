"""Data cleaning and data quality on Spark DataFrames."""

from siftwell.operators.analytics import (
    domain_reports,
    group_counts,
    hour_histogram,
    top_k,
    totals,
)
from siftwell.operators.cleaning import CleaningModel, TableCleaner
from siftwell.operators.contract import Contract, validate
from siftwell.operators.dedup import drop_duplicate_rows, drop_duplicate_rows_late, duplicate_count
from siftwell.operators.impute import Imputer, ImputeModel
from siftwell.operators.nulls import (
    DEFAULT_NULL_MARKERS,
    drop_sparse_columns,
    drop_sparse_rows,
    normalize_nulls,
    null_audit,
    sparse_columns,
)
from siftwell.operators.outliers import OutlierDetector, OutlierModel
from siftwell.operators.profile import ProfileResult, profile
from siftwell.operators.score import quality_score
from siftwell.operators.states import column_states, profile_states
from siftwell.plans.config import RunConfig
from siftwell.plans.quality_run import QualityRun, QualityRunModel
from siftwell.sources import (
    cast_columns,
    cast_failures,
    read_text_csv,
    write_csv,
    write_parquet,
    write_report,
    write_reports,
)

__all__ = [
    "DEFAULT_NULL_MARKERS",
    "CleaningModel",
    "Contract",
    "ImputeModel",
    "Imputer",
    "OutlierDetector",
    "OutlierModel",
    "ProfileResult",
    "QualityRun",
    "QualityRunModel",
    "RunConfig",
    "TableCleaner",
    "cast_columns",
    "cast_failures",
    "column_states",
    "domain_reports",
    "drop_duplicate_rows",
    "drop_duplicate_rows_late",
    "drop_sparse_columns",
    "drop_sparse_rows",
    "duplicate_count",
    "group_counts",
    "hour_histogram",
    "normalize_nulls",
    "null_audit",
    "profile",
    "profile_states",
    "quality_score",
    "read_text_csv",
    "sparse_columns",
    "top_k",
    "totals",
    "validate",
    "write_csv",
    "write_parquet",
    "write_report",
    "write_reports",
]
