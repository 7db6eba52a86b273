"""Outlier fences by quartiles or z-score, and the flag, cap and remove actions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.functions.columns import (
    COLUMNS_PER_PASS,
    find_fields,
    is_numeric,
    literal_rows,
    one_row_per_column,
    sql_double,
    sql_name,
    sql_text,
)
from siftwell.functions.quantiles import quantiles

METHODS = ("iqr", "zscore")
ACTIONS = ("flag", "cap", "remove")
FLAG_SUFFIX = "_is_outlier"

BOUNDS_SCHEMA = (
    "column_name string, method string, lower_bound double, upper_bound double, "
    "degenerate boolean, status string"
)
SUMMARY_SCHEMA = (
    "column_name string, method string, action string, lower_bound double, upper_bound double, "
    "outlier_count bigint, degenerate boolean, status string"
)


@dataclass(frozen=True)
class Fence:
    """Bounds outside of which a value is an outlier; no bounds if the column is skipped."""

    column: str
    lower: float | None
    upper: float | None
    status: str = "checked"

    @property
    def is_outlier(self) -> str:
        """SQL; null for null values. NaN sorts above every number, so it is an outlier."""
        value = sql_name(self.column)
        return f"({value} < {sql_double(self.lower)} OR {value} > {sql_double(self.upper)})"

    @property
    def clipped(self) -> str:
        value = sql_name(self.column)
        raised = f"greatest(CAST({value} AS DOUBLE), {sql_double(self.lower)})"
        return f"CASE WHEN {value} IS NOT NULL THEN least({raised}, {sql_double(self.upper)}) END"

    @property
    def limits(self) -> str:
        """SQL fields that describe the fence in reports."""
        return (
            f"{str(self.lower is not None and self.lower == self.upper).lower()} AS degenerate, "
            f"{sql_text(self.status)} AS status"
        )


@dataclass(frozen=True)
class OutlierModel:
    method: str
    action: str
    fences: tuple[Fence, ...]
    keep_nulls: bool = False

    @property
    def checked(self) -> list[Fence]:
        return [f for f in self.fences if f.lower is not None]

    @property
    def kept_sql(self) -> str:
        """Rows that ``remove`` keeps: no checked value may be an outlier or, by default, null."""
        keep = str(self.keep_nulls).lower()
        tests = [f"coalesce(NOT {f.is_outlier}, {keep})" for f in self.checked]
        return " AND ".join(tests or ["true"])

    def _kept(self) -> Column:
        return F.expr(self.kept_sql)

    def transform(self, df: DataFrame) -> DataFrame:
        """Apply the action: one projection or one filter, lazy, no shuffle."""
        if self.action == "remove":
            return df.where(self._kept())
        if self.action == "flag":
            flags = {f.column + FLAG_SUFFIX: F.expr(f.is_outlier) for f in self.checked}
            return df.withColumns(flags)
        clipped = {f.column: f.clipped for f in self.checked}
        names = [(c, sql_name(c)) for c in df.columns]
        return df.selectExpr(*[f"{clipped.get(c, quoted)} AS {quoted}" for c, quoted in names])

    def bounds(self, spark: SparkSession) -> DataFrame:
        """Unrounded fences. ``degenerate`` marks fences that allow one single value."""
        records = [
            F.expr(
                f"struct({sql_text(f.column)} AS column_name, '{self.method}' AS method, "
                f"{sql_double(f.lower)} AS lower_bound, {sql_double(f.upper)} AS upper_bound, "
                f"{f.limits})"
            )
            for f in self.fences
        ]
        return literal_rows(spark, records, BOUNDS_SCHEMA)

    def _record(self, fence: Fence, count: str) -> str:
        return (
            f"struct({sql_text(fence.column)} AS column_name, '{self.method}' AS method, "
            f"'{self.action}' AS action, round({sql_double(fence.lower)}, 4) AS lower_bound, "
            f"round({sql_double(fence.upper)}, 4) AS upper_bound, CAST({count} AS BIGINT) AS outlier_count, "
            f"{fence.limits})"
        )

    def summary(self, df: DataFrame) -> DataFrame:
        """``outlier_summary`` report: rounded fences and outlier counts, from one aggregate."""
        if not self.fences:
            return df.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
        counts = ["NULL" if f.lower is None else f"count_if({f.is_outlier})" for f in self.fences]
        return one_row_per_column(df, [self._record(f, c) for f, c in zip(self.fences, counts)])

    def counted_summary(self, spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
        """The same report from outlier counts by column that are known already."""
        known = [F.expr(self._record(f, str(counts.get(f.column, "NULL")))) for f in self.fences]
        return literal_rows(spark, known, SUMMARY_SCHEMA)

    def outcome(self, df: DataFrame) -> list[tuple[str, str, str]]:
        """Name, SQL over ``df`` and outlier test (SQL or empty) of every column of the result.

        After ``remove``, values of removed rows are null.
        """
        fences = {f.column: f for f in self.checked}
        test = {c: f.is_outlier for c, f in fences.items()}
        kept = self.kept_sql
        out = []
        for name in df.columns:
            value = sql_name(name)
            if self.action == "cap" and name in fences:
                value = fences[name].clipped
            if self.action == "remove":
                value = f"CASE WHEN {kept} THEN {value} END"
            out.append((name, value, test.get(name, "")))
        if self.action == "flag":
            out += [(f.column + FLAG_SUFFIX, f.is_outlier, "") for f in self.checked]
        return out

    def removal_counts(self, df: DataFrame) -> DataFrame:
        """One row: rows before, after and removed by the ``remove`` action."""
        return df.agg(
            F.count("*").alias("rows_before"), F.count_if(self._kept()).alias("rows_after")
        ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


@dataclass(frozen=True)
class OutlierDetector:
    """Learns fences for numeric columns.

    ``columns`` limits the check (absent names are ignored, empty means all numeric columns).
    ``method`` is ``iqr`` (quartiles plus or minus ``iqr_multiplier`` times their distance) or
    ``zscore`` (mean plus or minus ``zscore_threshold`` sample standard deviations). ``action``
    is ``flag``, ``cap`` or ``remove``; ``remove`` also drops rows with a null in a checked
    column unless ``keep_nulls``.
    """

    columns: Sequence[str] | None = None
    method: str = "iqr"
    action: str = "flag"
    iqr_multiplier: float = 1.5
    zscore_threshold: float = 3.0
    relative_error: float = 0.01
    keep_nulls: bool = False

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}, not {self.method!r}")
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}, not {self.action!r}")

    def fit(self, df: DataFrame) -> OutlierModel:
        fields = find_fields(df, self.columns)[0] if self.columns else [
            f for f in df.schema.fields if is_numeric(f.dataType)
        ]
        names = [f.name for f in fields if is_numeric(f.dataType)]
        find = self._quartile_fences if self.method == "iqr" else self._zscore_fences
        found = find(df, names) if names else {}
        fences = tuple(
            found.get(f.name) or Fence(f.name, None, None, "skipped: not numeric") for f in fields
        )
        return OutlierModel(self.method, self.action, fences, self.keep_nulls)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def _quartile_fences(self, df: DataFrame, names: list[str]) -> dict[str, Fence]:
        fences = {}
        for name, found in quantiles(df, names, [0.25, 0.75], self.relative_error).items():
            if not found:
                fences[name] = Fence(name, None, None, "skipped: no values")
                continue
            q1, q3 = map(float, found)
            reach = self.iqr_multiplier * (q3 - q1)
            lower, upper = q1 - reach, q3 + reach
            if math.isnan(lower) or math.isnan(upper):
                # Both quartiles are the same infinity, so no distance is defined.
                fences[name] = Fence(name, None, None, "skipped: infinite quartiles")
            else:
                fences[name] = Fence(name, lower, upper)
        return fences

    def _zscore_fences(self, df: DataFrame, names: list[str]) -> dict[str, Fence]:
        fences = {}
        for start in range(0, len(names), COLUMNS_PER_PASS):
            chunk = names[start : start + COLUMNS_PER_PASS]
            row = df.agg(
                *[
                    F.expr(f"CAST({f}({sql_name(n)}) AS DOUBLE) AS {f[0]}{i}")
                    for i, n in enumerate(chunk)
                    for f in ("avg", "stddev_samp")
                ]
            ).first()
            for i, name in enumerate(chunk):
                mean, spread = row[f"a{i}"], row[f"s{i}"]
                if not spread or not math.isfinite(spread):
                    fences[name] = Fence(name, None, None, "skipped: no spread")
                else:
                    reach = self.zscore_threshold * spread
                    fences[name] = Fence(name, mean - reach, mean + reach)
        return fences
