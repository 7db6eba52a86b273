"""Mergeable column states: counts, ranges, moments and sketches of a whole table from one scan.

``column_states`` aggregates all columns at once into one row per column and merge group: row
counts, ranges, means with their squared deviations, KLL sketches for quantiles and HyperLogLog
sketches for distinct counts. ``merged`` combines such rows, whichever tables they come from, into
one row per column. States can be stored; a table that grows by a partition then costs a scan of
that partition only, and the merged states are those of the whole table: counts, ranges and
distinct estimates exactly, moments to rounding, quantiles within the error of the sketches.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import (
    COLUMNS_PER_PASS,
    is_numeric,
    merge_group,
    sql_double,
    sql_name,
    sql_text,
)
from siftwell.functions.frequency import hll_size, hll_value
from siftwell.functions.quantiles import is_whole, ranked_value, sketch_size
from siftwell.operators.nulls import percent

STATES = (
    "col_id int, column_name string, data_type string, nullable boolean, row_count bigint, "
    "present bigint, usable bigint, least double, most double, least_text string, most_text string, "
    "mean double, squares double, whole binary, real binary, hll binary"
)
SLOTS = [f.split()[0] for f in STATES.split(", ")]
KLL_KINDS = {"whole": "bigint", "real": "double"}


def _exact(dtype: T.DataType) -> bool:
    """Whether doubles hold too few digits of a type."""
    return isinstance(dtype, (T.IntegralType, T.DecimalType))


def _cells(i: int, f: T.StructField, usable: str | None, k: int | None, log_k: int | None) -> list[str]:
    """SQL of the first-level aggregates of a column, in the order of ``STATES``."""
    value, numeric = sql_name(f.name), is_numeric(f.dataType)

    def moment(sql: str) -> str:
        return f"CAST({sql} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"

    def exact(sql: str) -> str:
        return f"CAST({sql} AS STRING)" if _exact(f.dataType) else "CAST(NULL AS STRING)"

    sketches = {slot: "CAST(NULL AS BINARY)" for slot in KLL_KINDS}
    if k is not None and numeric:
        slot = "whole" if is_whole(f.dataType) else "real"
        kind = KLL_KINDS[slot]
        ranked = ranked_value(f.name, f.dataType)
        if isinstance(f.dataType, T.DecimalType):
            ranked = f"CAST({ranked} AS DOUBLE)"
        sketches[slot] = f"kll_sketch_agg_{kind}({ranked}, {k})"
    hll = "CAST(NULL AS BINARY)"
    if log_k is not None:
        hll = f"hll_sketch_agg({hll_value(f)}, {log_k})"
    return [
        str(i),
        sql_text(f.name),
        sql_text(str(f.dataType)),
        str(f.nullable).lower(),
        "count(*)",
        f"count({value})",
        f"count({usable or value})",
        moment(f"min({value})"),
        moment(f"max({value})"),
        exact(f"min({value})"),
        exact(f"max({value})"),
        moment(f"avg({value})"),
        moment(f"var_pop({value}) * count({value})"),
        *sketches.values(),
        hll,
    ]


def column_states(
    df: DataFrame,
    usable: Mapping[str, str] | None = None,
    quantiles_of: Collection[str] | None = None,
    quantile_error: float = 0.01,
    distinct_error: float | None = 0.05,
) -> DataFrame:
    """One row of states per column and merge group, from one scan (per ``COLUMNS_PER_PASS``).

    ``usable`` is SQL of another form of each column whose non-null values are counted too.
    ``quantiles_of`` limits KLL sketches to some numeric columns, ``distinct_error=None`` leaves
    HyperLogLog sketches out.
    """
    k = sketch_size(quantile_error)
    if k is None:
        raise ValueError(f"no sketch has a rank error of {quantile_error}")
    log_k = None if distinct_error is None else hll_size(distinct_error)
    fields = df.schema.fields
    parts = []
    for start in range(0, max(1, len(fields)), COLUMNS_PER_PASS):
        chunk = list(enumerate(fields))[start : start + COLUMNS_PER_PASS]
        names, cells = [], []
        for i, f in chunk:
            wanted = quantiles_of is None or f.name in quantiles_of
            for slot, sql in zip(
                SLOTS, _cells(i, f, (usable or {}).get(f.name), k if wanted else None, log_k)
            ):
                names.append(f"{slot}_{i}")
                cells.append(f"{sql} AS {slot}_{i}")
        grouped = df.groupBy(merge_group()).agg(*[F.expr(c) for c in cells])
        stacked = f"stack({len(chunk)}, {', '.join(names)}) AS ({', '.join(SLOTS)})"
        parts.append(grouped.selectExpr(stacked) if chunk else _no_states(df))
    return reduce(DataFrame.unionByName, parts)


def _no_states(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], STATES)


def _as_stored(value: str, fields: Sequence[T.StructField], best: str) -> str:
    """SQL of the least or greatest of texts of numbers, compared in their columns' own types."""
    by_type: dict[str, list[int]] = {}
    for i, f in enumerate(fields):
        if _exact(f.dataType):
            name = f.dataType.simpleString() if isinstance(f.dataType, T.DecimalType) else "bigint"
            by_type.setdefault(name, []).append(i)
    cases = [
        f"CAST({best}(CASE WHEN col_id IN ({', '.join(map(str, ids))}) THEN CAST({value} AS {name}) END) AS STRING)"
        for name, ids in by_type.items()
    ]
    return f"coalesce({', '.join([*cases, 'CAST(NULL AS STRING)'])})"


def merged(
    states: DataFrame,
    fields: Sequence[T.StructField],
    quantile_error: float = 0.01,
    distinct_error: float | None = 0.05,
) -> DataFrame:
    """One row of states per column; ``fields`` are those of the table."""
    k = sketch_size(quantile_error)
    # Chan's rule: squared deviations from the joint mean, without differences of large sums.
    parts = "collect_list(CASE WHEN present > 0 THEN struct(present, mean, squares) END)"
    joint = (
        f"aggregate({parts}, struct(0L AS n, 0D AS mean, 0D AS squares), (a, p) -> struct("
        "a.n + p.present AS n, "
        "a.mean + (p.mean - a.mean) * p.present / (a.n + p.present) AS mean, "
        "a.squares + p.squares + (p.mean - a.mean) * (p.mean - a.mean) * a.n * p.present "
        "/ (a.n + p.present) AS squares))"
    )
    found = states.groupBy("col_id", "column_name", "data_type").agg(
        F.max("nullable").alias("nullable"),
        F.sum("row_count").alias("row_count"),
        F.sum("present").alias("present"),
        F.sum("usable").alias("usable"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.expr(_as_stored("least_text", fields, "min")).alias("least_text"),
        F.expr(_as_stored("most_text", fields, "max")).alias("most_text"),
        F.expr(joint).alias("joint"),
        *[F.expr(f"kll_merge_agg_{kind}({slot}, {k})").alias(slot) for slot, kind in KLL_KINDS.items()],
        (F.lit(None).cast("binary") if distinct_error is None else F.expr("hll_union_agg(hll)")).alias("hll"),
    )
    numeric = F.col("least").isNotNull()
    return found.select(
        *SLOTS[:11],
        F.when(numeric, F.col("joint.mean")).alias("mean"),
        F.when(numeric, F.col("joint.squares")).alias("squares"),
        *SLOTS[13:],
    )


def as_stats(states: DataFrame, *more: Column | str) -> DataFrame:
    """Rows of ``column_stats``, with usable counts and ``more`` columns, from merged states."""
    return states.select(
        "col_id",
        "column_name",
        "data_type",
        "nullable",
        "row_count",
        (F.col("row_count") - F.col("present")).alias("null_count"),
        F.col("least").alias("min"),
        F.col("most").alias("max"),
        F.col("least_text").alias("min_text"),
        F.col("most_text").alias("max_text"),
        "mean",
        F.when(F.col("present") > 1, F.sqrt(F.col("squares") / (F.col("present") - 1))).alias("stddev"),
        F.col("usable").alias("usable_count"),
        *more,
    )


def sketched_quantiles(probabilities: Sequence[float]):
    """Columns ``whole_q`` and ``real_q``: quantiles of merged states, null without values."""
    ranks = f"array({', '.join(map(sql_double, probabilities))})"
    return [
        F.expr(
            f"CASE WHEN kll_sketch_get_n_{kind}({slot}) > 0 "
            f"THEN kll_sketch_get_quantile_{kind}({slot}, {ranks}) END"
        ).alias(f"{slot}_q")
        for slot, kind in KLL_KINDS.items()
    ]


def profile_states(
    states: DataFrame,
    fields: Sequence[T.StructField],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    quantile_error: float = 0.01,
    distinct_error: float = 0.05,
) -> DataFrame:
    """Profile rows, without top values, of all tables whose states are given.

    Distinct counts are estimates; ``quantiles`` are those at ``probabilities``, as doubles.
    """
    found = merged(states, fields, quantile_error, distinct_error)
    quantiles = F.coalesce(F.col("whole_q").cast("array<double>"), F.col("real_q")).alias("quantiles")
    estimated = F.expr("hll_sketch_estimate(hll)").alias("distinct_count")
    extra = found.select("col_id", estimated, *sketched_quantiles(probabilities))
    return (
        as_stats(found)
        .join(extra.select("col_id", "distinct_count", quantiles), "col_id")
        .select(
            "col_id",
            "column_name",
            "data_type",
            "row_count",
            "null_count",
            F.expr(percent("row_count - null_count", "row_count")).alias("completeness_pct"),
            "distinct_count",
            "min",
            "max",
            "min_text",
            "max_text",
            F.round("mean", 4).alias("mean"),
            F.round("stddev", 4).alias("stddev"),
            "quantiles",
        )
    )
