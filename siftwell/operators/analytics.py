"""Summary reports over a cleaned table: group counts, top values, totals, hours of day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.columns import col


def group_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value (null included), most frequent first."""
    counts = df.groupBy(col(column)).agg(F.count("*").alias("count"))
    return counts.orderBy(F.col("count").desc(), col(column).asc_nulls_first())


def top_k(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent non-null values, ties by value ascending."""
    return group_counts(df.where(col(column).isNotNull()), column).limit(k)


def totals(df: DataFrame, sums: Sequence[str] = (), averages: Sequence[str] = ()) -> DataFrame:
    """One row: ``total_<column>`` and ``avg_<column>`` (four decimals), 0 where all is null."""
    return df.agg(
        *[F.coalesce(F.sum(col(c)), F.lit(0)).alias(f"total_{c}") for c in sums],
        *[F.coalesce(F.round(F.avg(col(c)), 4), F.lit(0.0)).alias(f"avg_{c}") for c in averages],
    )


def hour_of(text: Column) -> Column:
    """Hour of a clock text such as ``9:05``; null if it has none."""
    return F.split(text, ":")[0].try_cast("int")


def hour_histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows per hour of day of a clock-text column, by hour; texts without an hour under null."""
    return (
        df.groupBy(hour_of(col(column)).alias("hour"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("hour").asc_nulls_first())
    )


def domain_reports(
    df: DataFrame,
    group_column: str,
    top_columns: Sequence[str],
    sum_columns: Sequence[str],
    average_columns: Sequence[str],
    time_column: str,
    k: int = 10,
) -> dict[str, DataFrame]:
    """The standard set of summary reports, ready for :func:`siftwell.sources.write_reports`."""
    reports = {f"counts_by_{group_column}": group_counts(df, group_column)}
    reports.update({f"top_{c}": top_k(df, c, k) for c in top_columns})
    reports["totals"] = totals(df, sum_columns, average_columns)
    reports[f"hours_of_{time_column}"] = hour_histogram(df, time_column)
    return reports
