"""Column lookup and type predicates shared by every operator.

Expressions that repeat per column are written as SQL text: a table of a thousand columns then
takes one call into the JVM per expression instead of one per operator in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns aggregated per job: keeps one aggregate's generated code and result row moderate
# on tables with thousands of columns. Wider tables run one column-pruned scan per chunk.
COLUMNS_PER_PASS = 200

# First-level groups when the sketches of all tasks are merged in two levels: with n tasks no
# task merges more than the larger of 512 and n / 512 sketches.
MERGE_GROUPS = 512


def sql_name(name: str) -> str:
    """SQL for a top-level column literally called ``name`` (dots and back-ticks included)."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str | None) -> str:
    """SQL string literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_double(value: float | None) -> str:
    """SQL double literal, infinities and NaN included."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    return f"{value!r}D" if math.isfinite(value) else f"CAST('{value}' AS DOUBLE)"


def col(name: str) -> Column:
    return F.col(sql_name(name))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def is_orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return is_orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(is_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def merge_group() -> Column:
    """Grouping key that spreads the partial results of tasks over the first merge level."""
    return (F.spark_partition_id() % MERGE_GROUPS).alias("merge_group")


def stacked_sketches(per_group: DataFrame, ids: Iterable[int]) -> DataFrame:
    """``col_id, sketch`` rows of a first merge level that holds a sketch ``s<id>`` for each column.

    Merged by ``col_id``, the sketches of different columns go to different tasks.
    """
    ids = list(ids)
    cells = ", ".join(f"{i}, s{i}" for i in ids)
    stacked = per_group.selectExpr(f"stack({len(ids)}, {cells}) AS (col_id, sketch)")
    return stacked.where(F.col("sketch").isNotNull())


def _same_name(df: DataFrame):
    if df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true":
        return lambda name: name
    return str.lower


class FieldLookup:
    """Fields of a table by name, matched the way Spark resolves names.

    That is by ``spark.sql.caseSensitive``, asked once for all look-ups.
    """

    def __init__(self, df: DataFrame):
        self._fold = _same_name(df)
        self._fields = {self._fold(f.name): f for f in df.schema.fields}

    def __call__(self, name: str) -> T.StructField | None:
        return self._fields.get(self._fold(name))


def find_fields(df: DataFrame, names: Iterable[str]) -> tuple[list[T.StructField], list[str]]:
    """Split requested names into the table's fields (in request order) and absent names."""
    lookup = FieldLookup(df)
    present, absent, seen = [], [], set()
    for name in names:
        field = lookup(name)
        if field is None:
            absent.append(name)
        elif field.name not in seen:
            seen.add(field.name)
            present.append(field)
    return present, absent


def by_field(df: DataFrame, settings: dict) -> dict:
    """Re-key a ``{column: setting}`` mapping by the table's own spelling; drop absent columns."""
    lookup = FieldLookup(df)
    found = ((lookup(name), setting) for name, setting in settings.items())
    return {field.name: setting for field, setting in found if field is not None}


def one_row_per_column(df: DataFrame, records: Sequence[str]) -> DataFrame:
    """Evaluate one aggregate struct (SQL) per column and return them as rows.

    All structs of a chunk share a single aggregation, so the number of scans does not
    grow with the number of columns (up to ``COLUMNS_PER_PASS``).
    """
    chunks = [
        records[i : i + COLUMNS_PER_PASS] for i in range(0, len(records), COLUMNS_PER_PASS)
    ]
    parts = [
        df.agg(F.expr(f"array({', '.join(chunk)})").alias("records")).select(F.inline("records"))
        for chunk in chunks
    ]
    return reduce(DataFrame.unionByName, parts)


def literal_rows(spark, records: Sequence[Column], empty_schema: str) -> DataFrame:
    """Rows made of literal structs, evaluated by Spark so that texts follow Spark's casts."""
    if not records:
        return spark.createDataFrame([], empty_schema)
    return spark.range(1).select(F.inline(F.array(*records)))


def pin(df: DataFrame) -> DataFrame:
    """Freeze a report: run it once and keep its rows as a local relation.

    Only for reports whose size is bounded by the number of columns of a table.
    """
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)
