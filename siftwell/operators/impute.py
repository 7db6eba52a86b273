"""Fill missing values with a mean, median, mode or constant per column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import (
    by_field,
    col,
    is_float,
    is_nested,
    is_numeric,
    literal_rows,
    sql_name,
)
from siftwell.functions.frequency import (
    decode_row,
    top_values,
    value_frequencies,
    with_full_texts,
)
from siftwell.functions.heavy import settled_top_values
from siftwell.functions.quantiles import quantiles
from siftwell.operators.nulls import null_audit

STRATEGIES = ("mean", "median", "mode", "constant")

PLAN_SCHEMA = (
    "column_name string, strategy string, fill_value string, null_count bigint, status string"
)


@dataclass(frozen=True)
class Fill:
    """What happens to one column with nulls. ``literal`` is None when nothing is filled."""

    column: str
    strategy: str
    null_count: int
    literal: Column | None
    status: str


@dataclass(frozen=True)
class ImputeModel:
    fills: tuple[Fill, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill nulls, and NaN in filled float columns. Lazy and without a shuffle."""
        literals = {f.column: f.literal for f in self.fills if f.literal is not None}
        out = []
        for field in df.schema.fields:
            value = sql_name(field.name)
            if field.name in literals:
                if is_float(field.dataType):
                    value = f"CASE WHEN NOT isnan({value}) THEN {value} END"
                out.append(F.coalesce(F.expr(value), literals[field.name]).alias(field.name))
            else:
                out.append(value)
        return df.select(*out)

    def plan(self, spark: SparkSession) -> DataFrame:
        """``imputation_plan`` report: one row per column that had nulls."""
        records = [
            F.struct(
                F.lit(f.column).alias("column_name"),
                F.lit(f.strategy).alias("strategy"),
                (F.lit(None) if f.literal is None else f.literal).cast("string").alias("fill_value"),
                F.lit(f.null_count).cast("bigint").alias("null_count"),
                F.lit(f.status).alias("status"),
            )
            for f in self.fills
        ]
        return literal_rows(spark, records, PLAN_SCHEMA)


@dataclass(frozen=True)
class Imputer:
    """Learns fill values.

    ``strategies`` maps columns to one of :data:`STRATEGIES`; other columns take the median if
    numeric, else the mode. ``fill_values`` holds the constants. Columns without nulls are left
    alone. Statistics of all columns come from one aggregate, one frequency table and one set of
    quantile sketches; exact medians (``relative_error=0``) add an aggregate and, for each type of
    number, a ranking of few rows. ``nominate_modes`` finds the same modes by the passes of
    :mod:`siftwell.functions.heavy`, for columns of very many values.
    """

    strategies: Mapping[str, str] | None = None
    fill_values: Mapping[str, Any] | None = None
    relative_error: float = 0.01
    nominate_modes: bool = False

    def __post_init__(self):
        unknown = {s for s in (self.strategies or {}).values() if s not in STRATEGIES}
        if unknown:
            raise ValueError(f"unknown imputation strategies {sorted(unknown)}, use {STRATEGIES}")

    def strategy_of(self, df: DataFrame) -> dict[str, str]:
        chosen = by_field(df, dict(self.strategies or {}))
        return {
            f.name: chosen.get(f.name, "median" if is_numeric(f.dataType) else "mode")
            for f in df.schema.fields
        }

    def fit(
        self,
        df: DataFrame,
        null_counts: Mapping[str, int] | None = None,
        modes: Mapping[str, Column | None] | None = None,
        sketched: Mapping[str, list] | None = None,
    ) -> ImputeModel:
        """Compute fill values.

        ``null_counts``, ``modes`` and what sketches gave for the medians (``sketched``, see
        :func:`siftwell.functions.quantiles.quantiles`) may be handed in by a caller that has them.
        """
        strategy = self.strategy_of(df)
        if null_counts is None:
            null_counts = count_nulls(df)
        fields = [f for f in df.schema.fields if null_counts[f.name] > 0]
        nested = {f.name for f in fields if is_nested(f.dataType)}
        numeric = {f.name for f in fields if is_numeric(f.dataType)}

        def wanting(name: str) -> list[T.StructField]:
            return [f for f in fields if strategy[f.name] == name and f.name not in nested]

        found: dict[str, Column | None] = {}
        found.update(self._means(df, [f for f in wanting("mean") if f.name in numeric]))
        found.update(self._medians(df, [f for f in wanting("median") if f.name in numeric], sketched))
        given = modes or {}
        found.update({f.name: given[f.name] for f in wanting("mode") if f.name in given})
        found.update(find_modes(df, [f for f in wanting("mode") if f.name not in given], self.nominate_modes))
        constants, bad = self._constants(df, wanting("constant"))
        found.update(constants)

        fills = []
        for f in fields:
            literal = found.get(f.name)
            how = strategy[f.name]
            if literal is not None:
                status = "filled"
            elif f.name in nested:
                status = "skipped: nested type"
            elif how in ("mean", "median") and f.name not in numeric:
                status = "skipped: needs a numeric column"
            elif f.name in bad:
                status = bad[f.name]
            else:
                status = "skipped: no values"
            fills.append(Fill(f.name, how, null_counts[f.name], literal, status))
        return ImputeModel(tuple(fills))

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def _means(self, df: DataFrame, fields: list[T.StructField]) -> dict[str, Column | None]:
        if not fields:
            return {}
        row = df.agg(*[F.avg(col(f.name)).alias(f"m{i}") for i, f in enumerate(fields)]).first()
        return {
            f.name: None if row[i] is None else _number(row[i], f.dataType)
            for i, f in enumerate(fields)
        }

    def _medians(self, df: DataFrame, fields: list[T.StructField], sketched) -> dict[str, Column | None]:
        found = quantiles(df, [f.name for f in fields], [0.5], self.relative_error, sketched)
        return {
            f.name: _number(found[f.name][0], f.dataType) if found[f.name] else None
            for f in fields
        }

    def _constants(self, df: DataFrame, fields: list[T.StructField]):
        """Typed literals, and the reason for each constant that does not fit its column."""
        values = by_field(df, dict(self.fill_values or {}))
        literals, bad, tests = {}, {}, []
        one = df.sparkSession.range(1)
        for f in fields:
            value = values.get(f.name)
            if value is None:
                bad[f.name] = "skipped: no constant given"
                continue
            bad[f.name] = f"skipped: constant does not fit {f.dataType.simpleString()}"
            try:
                # Checked by the analyser only; all casts are evaluated together below.
                test = F.lit(value).try_cast(f.dataType).isNotNull().alias(f"c{len(tests)}")
                one.select(test)
            except AnalysisException:
                continue
            tests.append((f, test))
        if tests:
            fits = one.select(*[test for _, test in tests]).first()
            for (f, _), fit in zip(tests, fits):
                if fit:
                    del bad[f.name]
                    literals[f.name] = F.lit(values[f.name]).cast(f.dataType)
        return literals, bad


def _number(value, dtype: T.DataType) -> Column:
    """Literal of a numeric type; integer types take the value truncated."""
    return F.lit(int(value) if isinstance(dtype, T.IntegralType) else value).cast(dtype)


def count_nulls(df: DataFrame) -> dict[str, int]:
    return {r["column_name"]: r["null_count"] for r in null_audit(df).collect()}


def find_modes(
    df: DataFrame, fields: list[T.StructField], nominate: bool = False
) -> dict[str, Column | None]:
    """Most frequent value per column as a typed literal, lowest on ties, None if all null."""
    if not fields:
        return {}
    if nominate:
        ranked = settled_top_values(df, fields, range(len(fields)), 1)
    else:
        ranked = top_values(value_frequencies(df, fields), 1)
    top = with_full_texts(ranked, df, fields).collect()
    modes: dict[str, Column | None] = {f.name: None for f in fields}
    for row in top:
        f = fields[row["col_id"]]
        modes[f.name] = decode_row(row, f.dataType)
    return modes
