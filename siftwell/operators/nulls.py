"""Null markers, null audit, sparse columns and sparse rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import (
    COLUMNS_PER_PASS,
    col,
    find_fields,
    is_float,
    is_nested,
    is_numeric,
    is_text,
    one_row_per_column,
    sql_name,
    sql_text,
)

# Texts that stand for a missing value unless the caller gives others.
DEFAULT_NULL_MARKERS = ("N/A", "null", "None", "", "Unknown", "n/a", "NA", "NaN")


def markers_for(dtype: T.DataType, markers: Iterable[str]) -> list[str]:
    """The markers that the text form of a type can equal at all.

    Leaving out the others spares a cast of every value: a date never reads ``N/A`` and an
    array always starts with a bracket.
    """
    markers = list(markers)
    if is_text(dtype):
        return markers
    if is_numeric(dtype):
        return []
    if isinstance(dtype, T.BooleanType):
        return [m for m in markers if m in ("true", "false")]
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return [m for m in markers if m[:1] in tuple("0123456789+-")]
    if is_nested(dtype) and not isinstance(dtype, T.VariantType):
        return [m for m in markers if m[:1] in ("[", "{")]
    return markers


def without_markers(
    field: T.StructField, markers: Sequence[str] | None = None, nan_is_null: bool = False
) -> str:
    """SQL of a column with its null markers (and NaN if asked) turned into null."""
    markers = DEFAULT_NULL_MARKERS if markers is None else markers
    value = sql_name(field.name)
    if nan_is_null and is_float(field.dataType):
        return f"CASE WHEN NOT isnan({value}) THEN {value} END"
    hits = markers_for(field.dataType, markers)
    if not hits:
        return value
    text = value if is_text(field.dataType) else f"CAST({value} AS STRING)"
    return f"CASE WHEN {text} NOT IN ({', '.join(map(sql_text, hits))}) THEN {value} END"


def normalize_nulls(
    df: DataFrame, markers: Sequence[str] | None = None, nan_is_null: bool = False
) -> DataFrame:
    """Turn null markers into nulls in every non-numeric column.

    Markers match exactly, without trimming. ``None`` means :data:`DEFAULT_NULL_MARKERS`, an
    empty list switches the step off. Numeric columns pass through; with ``nan_is_null`` a
    float NaN counts as missing too.
    """
    return df.selectExpr(
        *[
            f"{without_markers(f, markers, nan_is_null)} AS {sql_name(f.name)}"
            for f in df.schema.fields
        ]
    )


def percent(part: str, whole: str) -> str:
    """SQL of a share in percent to two decimals, 0 for an empty whole."""
    return f"coalesce(round(try_divide(({part}) * 100, {whole}), 2), 0.0D)"


def null_audit(df: DataFrame) -> DataFrame:
    """``column_name, null_count, null_pct, row_count`` per column, from one aggregate."""
    records = []
    for name in df.columns:
        nulls = f"count(*) - count({sql_name(name)})"
        records.append(
            f"struct({sql_text(name)} AS column_name, {nulls} AS null_count, "
            f"{percent(nulls, 'count(*)')} AS null_pct, count(*) AS row_count)"
        )
    return one_row_per_column(df, records)


def is_sparse(null_count: Column, row_count: Column, threshold: float) -> Column:
    """True when the null fraction is strictly above the threshold; an empty table never is."""
    return F.coalesce(F.try_divide(null_count, row_count) > F.lit(threshold), F.lit(False))


def sparse_columns(df: DataFrame, threshold: float = 0.80, keep: Iterable[str] = ()) -> DataFrame:
    """The audit rows of columns whose null fraction exceeds ``threshold``."""
    kept = [f.name for f in find_fields(df, keep)[0]]
    return null_audit(df).where(
        is_sparse(F.col("null_count"), F.col("row_count"), threshold)
        & ~F.col("column_name").isin(kept)
    )


def drop_sparse_columns(
    df: DataFrame, threshold: float = 0.80, keep: Iterable[str] = ()
) -> DataFrame:
    """Drop columns whose null fraction exceeds ``threshold``. Runs one aggregate to decide."""
    sparse = [r["column_name"] for r in sparse_columns(df, threshold, keep).collect()]
    return df.select(*[col(c) for c in df.columns if c not in sparse])


def nulls_per_row(names: Sequence[str]) -> Column:
    """Number of null cells of a row; sums in chunks so that wide rows do not nest deeply."""
    cells = [f"CAST({sql_name(n)} IS NULL AS INT)" for n in names]
    chunks = [cells[i : i + COLUMNS_PER_PASS] for i in range(0, len(cells), COLUMNS_PER_PASS)]
    return F.expr(" + ".join(["0"] + [f"({' + '.join(chunk)})" for chunk in chunks]))


def drop_sparse_rows(df: DataFrame, max_nulls: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at most ``max_nulls`` null cells. NaN is a value here."""
    names = df.columns if columns is None else [f.name for f in find_fields(df, columns)[0]]
    return df.where(nulls_per_row(names) <= max_nulls)
