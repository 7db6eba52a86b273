"""Null handling, imputation and deduplication as one fit / transform step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siftwell.functions.columns import col, find_fields
from siftwell.operators.dedup import drop_duplicate_rows, drop_duplicate_rows_late, rows_and_keys
from siftwell.operators.impute import Imputer, ImputeModel, count_nulls
from siftwell.operators.nulls import drop_sparse_rows, normalize_nulls, null_audit


@dataclass(frozen=True)
class CleaningModel:
    """Everything learned by :class:`TableCleaner`, as literals. ``transform`` is lazy.

    Only with ``late_dedup`` it first runs a pass over the keys.
    """

    cleaner: TableCleaner
    row_count: int
    kept_columns: tuple[str, ...]
    dropped_columns: tuple[str, ...]
    imputation: ImputeModel

    def normalized(self, df: DataFrame) -> DataFrame:
        return normalize_nulls(df, self.cleaner.null_markers, self.cleaner.nan_is_null)

    def prepared(self, df: DataFrame) -> DataFrame:
        """All steps but the deduplication: no shuffle."""
        return self.imputation.transform(self.cleaner.usable_rows(self.normalized(df), self.kept_columns))

    def transform(self, df: DataFrame, seen: Observation | None = None) -> DataFrame:
        """The cleaned table; ``seen`` observes ``row_count``, the rows before deduplication."""
        rows = self.prepared(df)
        if seen is not None:
            rows = rows.observe(seen, F.count(F.lit(1)).alias("row_count"))
        elif self.cleaner.late_dedup:
            return drop_duplicate_rows_late(rows, self.cleaner.keys, self.cleaner.order_by)
        return drop_duplicate_rows(rows, self.cleaner.keys, self.cleaner.order_by)

    def null_audit_before(self, df: DataFrame) -> DataFrame:
        return null_audit(self.normalized(df))

    def null_audit_after(self, df: DataFrame) -> DataFrame:
        return null_audit(self.transform(df))

    def imputation_plan(self, df: DataFrame) -> DataFrame:
        """The fill of every column with nulls; fills of deduplication keys are marked, since
        they turn rows without a key into duplicates of each other."""
        keys = [f.name for f in find_fields(df, self.cleaner.keys or ())[0]]
        filled_key = F.col("column_name").isin(keys) & (F.col("status") == "filled")
        plan = self.imputation.plan(df.sparkSession)
        return plan.withColumn(
            "status", F.when(filled_key, F.lit("filled: deduplication key")).otherwise(F.col("status"))
        )

    def summary(self, df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
        """``cleaning_summary`` report for the table the model was fitted on.

        Sparse rows are counted apart from duplicates. ``counts`` may hold ``row_count`` and
        ``distinct_count`` of the prepared table if they are known already.
        """
        if counts is None:
            counts = rows_and_keys(self.prepared(df), self.cleaner.keys)
        dropped = F.array(*[F.lit(c) for c in self.dropped_columns]).cast("array<string>")
        return counts.select(
            F.lit(self.row_count).cast("bigint").alias("row_count_before"),
            F.col("distinct_count").alias("row_count_after"),
            (F.col("row_count") - F.col("distinct_count")).alias("duplicate_rows_removed"),
            (F.lit(self.row_count) - F.col("row_count")).cast("bigint").alias("sparse_rows_removed"),
            dropped.alias("dropped_columns"),
        )


@dataclass(frozen=True)
class TableCleaner:
    """Normalise null markers, drop sparse columns and rows, impute, deduplicate.

    ``null_markers``: None for the default list, empty to switch off. ``drop_col_threshold``:
    null fraction above which a column goes (deduplication keys stay). ``drop_row_threshold``:
    most null cells a row may have, None to keep all. ``keys`` / ``order_by``: see
    :func:`siftwell.operators.dedup.drop_duplicate_rows`. ``late_dedup`` shuffles rows with repeated
    keys only (observed rows need a single scan and so the plain form), ``nominate_modes`` finds modes
    without shuffling values; both give the same rows.
    """

    null_markers: Sequence[str] | None = None
    drop_col_threshold: float = 0.80
    drop_row_threshold: int | None = None
    strategies: Mapping[str, str] | None = None
    fill_values: Mapping[str, Any] | None = None
    keys: Sequence[str] | None = None
    order_by: Sequence[str | Column] | None = None
    relative_error: float = 0.01
    nan_is_null: bool = False
    late_dedup: bool = False
    nominate_modes: bool = False

    def usable_rows(self, normalized: DataFrame, kept: Sequence[str]) -> DataFrame:
        kept_columns = normalized.select(*[col(c) for c in kept])
        if self.drop_row_threshold is None:
            return kept_columns
        return drop_sparse_rows(kept_columns, self.drop_row_threshold)

    def fit(
        self,
        df: DataFrame,
        null_counts: Mapping[str, int] | None = None,
        row_count: int | None = None,
        modes: Mapping[str, Column | None] | None = None,
        sketched: Mapping[str, list] | None = None,
    ) -> CleaningModel:
        """Learn dropped columns and fill values.

        ``null_counts``, ``row_count`` (after marker normalisation), ``modes`` and ``sketched``
        medians may be handed in. The last two are ignored when sparse rows are dropped, as they
        must be taken afterwards.
        """
        imputer = Imputer(self.strategies, self.fill_values, self.relative_error, self.nominate_modes)
        normalized = normalize_nulls(df, self.null_markers, self.nan_is_null)
        if null_counts is None or row_count is None:
            audit = null_audit(normalized).collect()
            null_counts = {r["column_name"]: r["null_count"] for r in audit}
            row_count = audit[0]["row_count"] if audit else 0
        keys = {f.name for f in find_fields(df, self.keys or ())[0]}
        dropped = tuple(
            c
            for c in df.columns
            if c not in keys and row_count and null_counts[c] / row_count > self.drop_col_threshold
        )
        kept = tuple(c for c in df.columns if c not in dropped)
        usable = self.usable_rows(normalized, kept)
        if self.drop_row_threshold is not None:
            null_counts, modes, sketched = count_nulls(usable), None, None
        return CleaningModel(
            self, row_count, kept, dropped, imputer.fit(usable, null_counts, modes, sketched)
        )

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
