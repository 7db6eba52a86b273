"""Distributed writers for cleaned tables and report frames."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame


ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def _balanced(df: DataFrame, file_bytes: int | None) -> Iterator[DataFrame]:
    """The table in partitions of about ``file_bytes``, whatever their keys; as it is without."""
    if file_bytes is None:
        yield df
        return
    conf = df.sparkSession.conf
    before = conf.get(ADVISORY_BYTES, None)
    conf.set(ADVISORY_BYTES, str(file_bytes))
    try:
        yield df.hint("rebalance")
    finally:
        if before is None:
            conf.unset(ADVISORY_BYTES)
        else:
            conf.set(ADVISORY_BYTES, before)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", file_bytes: int | None = None) -> None:
    """Write a folder of CSV files with header, one per task.

    ``file_bytes`` adds a shuffle that splits large partitions and joins small ones to about that
    many bytes (as shuffled) for each file, so that skewed keys do not make skewed files.
    """
    with _balanced(df, file_bytes) as rows:
        rows.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", file_bytes: int | None = None) -> None:
    """Write a folder of Parquet files, one per task; ``file_bytes`` as in :func:`write_csv`."""
    with _balanced(df, file_bytes) as rows:
        rows.write.mode(mode).parquet(path)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write one report frame as a JSON-lines folder; nulls are kept as explicit fields."""
    report.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_reports(reports: Mapping[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """Write each report frame to its own folder below ``path``."""
    for name, report in reports.items():
        write_report(report, f"{path.rstrip('/')}/{name}", mode)
