"""Column profiles: nulls, distinct counts, moments and top values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import (
    is_numeric,
    one_row_per_column,
    pin,
    sql_name,
    sql_text,
)
from siftwell.functions.frequency import (
    approx_distinct_counts,
    counts_by_words,
    distinct_counts,
    top_values,
    value_frequencies,
    value_text,
    with_full_texts,
    word_counts,
)
from siftwell.functions.heavy import settle
from siftwell.functions.long_ties import ranked_by_value
from siftwell.operators.contract import Contract, validate
from siftwell.operators.nulls import percent
from siftwell.operators.score import quality_score

TOP_VALUES = 3


def stats_record(
    i: int, f: T.StructField, value: str, rows: str = "count(*)", more: Sequence[str] = ()
) -> str:
    """SQL of the aggregate struct of a column: counts, range and moments of ``value``.

    ``min_text`` and ``max_text`` have all digits of integers and decimals. ``rows`` is SQL of the
    number of rows, ``more`` further fields.
    """
    moment = lambda f_: f"CAST({f_}({value}) AS DOUBLE)"
    if not is_numeric(f.dataType):
        moment = lambda f_: "CAST(NULL AS DOUBLE)"
    # Doubles hold no more than 15 digits of these.
    exact = lambda f_: f"CAST({f_}({value}) AS STRING)"
    if not isinstance(f.dataType, (T.IntegralType, T.DecimalType)):
        exact = lambda f_: "CAST(NULL AS STRING)"
    record = [
        f"{i} AS col_id",
        f"{sql_text(f.name)} AS column_name",
        f"{sql_text(str(f.dataType))} AS data_type",
        f"{str(f.nullable).lower()} AS nullable",
        f"{rows} AS row_count",
        f"{rows} - count({value}) AS null_count",
        f"{moment('min')} AS min",
        f"{moment('max')} AS max",
        f"{exact('min')} AS min_text",
        f"{exact('max')} AS max_text",
        f"{moment('avg')} AS mean",
        f"{moment('stddev_samp')} AS stddev",
        *more,
    ]
    return f"struct({', '.join(record)})"


def column_stats(df: DataFrame, usable: Mapping[str, str] | None = None) -> DataFrame:
    """Counts, range and moments of every column from one aggregate, one row per column.

    ``usable`` adds ``usable_count``, the non-null count of another form (SQL) of each column,
    such as the one without null markers.
    """
    records = []
    for i, f in enumerate(df.schema.fields):
        more = [] if usable is None else [f"count({usable[f.name]}) AS usable_count"]
        records.append(stats_record(i, f, sql_name(f.name), more=more))
    return one_row_per_column(df, records)


def top_value_rows(top: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """``column_name, rank, value, count`` of ranked frequency rows, values as text."""
    names = F.expr(f"array({', '.join(sql_text(f.name) for f in fields)})")
    return top.select(
        F.element_at(names, F.col("col_id") + 1).alias("column_name"),
        "rank",
        value_text(fields).alias("value"),
        F.col("freq").alias("count"),
    )


@dataclass(frozen=True)
class ProfileResult:
    """Report frames of one table.

    ``columns`` one row per column, ``top_values`` up to three rows per non-numeric column,
    ``issues`` one row per contract violation, ``shape`` one row, ``score`` one row.
    """

    columns: DataFrame
    top_values: DataFrame
    issues: DataFrame
    shape: DataFrame
    uniqueness: str = "nonempty"

    @property
    def score(self) -> DataFrame:
        return quality_score(self.columns, self.issues, self.uniqueness)

    def pinned(self) -> ProfileResult:
        """Run the reports once. Their size depends on the number of columns only."""
        return pinned_profile(pin(self.columns), pin(self.issues), self.uniqueness)


def pinned_profile(columns: DataFrame, issues: DataFrame, uniqueness: str) -> ProfileResult:
    """All reports of a profile from its pinned column rows and issues."""
    ranked = columns.select("column_name", F.posexplode("top_values").alias("pos", "top"))
    shape = columns.agg(
        F.coalesce(F.max("row_count"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("total_columns"),
    )
    top = ranked.select("column_name", (F.col("pos") + 1).alias("rank"), "top.*")
    return ProfileResult(columns, top, issues, shape, uniqueness)


def build_columns(stats: DataFrame, distinct: DataFrame, top: DataFrame) -> DataFrame:
    """Assemble ``column_profile`` rows from the partial reports.

    All inputs have at most a few rows per column of the profiled table, which bounds the
    broadcast sides.
    """
    lists = top.groupBy("column_name").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "value", "count"))),
            lambda t: F.struct(t["value"].alias("value"), t["count"].alias("count")),
        ).alias("top_values")
    )
    counts = F.broadcast(distinct.select("col_id", "distinct_count"))
    full = stats.join(counts, "col_id", "left").join(F.broadcast(lists), "column_name", "left")
    return full.select(
        "col_id",
        "column_name",
        "data_type",
        "nullable",
        "row_count",
        "null_count",
        F.expr(percent("null_count", "row_count")).alias("null_pct"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        F.expr(percent("row_count - null_count", "row_count")).alias("completeness_pct"),
        "min",
        "max",
        "min_text",
        "max_text",
        F.round("mean", 4).alias("mean"),
        F.round("stddev", 4).alias("stddev"),
        "top_values",
    )


def profile(
    df: DataFrame,
    contract=None,
    distinct: str = "exact",
    approx_rsd: float = 0.05,
    uniqueness: str = "nonempty",
    stats: DataFrame | None = None,
    top: str = "counted",
    long_ties: str = "digest",
) -> ProfileResult:
    """Profile a table in few scans whatever its width; every report stays lazy.

    ``stats`` may hold the rows of :func:`column_stats` of this table, if they are known.

    ``distinct="approx"`` estimates distinct counts by HyperLogLog with a standard error of
    ``approx_rsd``. Then only the values of non-numeric columns are shuffled, for the top values.

    ``top="nominated"`` first runs the passes of :mod:`siftwell.functions.heavy`, which find the same
    top values of skewed, narrow and unique columns without shuffling values. It costs two scans, a
    third where a column may be unique, and pays where most columns have very many values.

    ``long_ties="value"`` orders top values by value at any length. It finds the top values at once, and
    reads the table again where long texts of equal count and equal start compete.
    """
    if distinct not in ("exact", "approx"):
        raise ValueError("distinct must be 'exact' or 'approx'")
    if top not in ("counted", "nominated"):
        raise ValueError("top must be 'counted' or 'nominated'")
    if long_ties not in ("digest", "value"):
        raise ValueError("long_ties must be 'digest' or 'value'")
    places = TOP_VALUES + (long_ties == "value")
    fields = df.schema.fields
    other = [i for i, f in enumerate(fields) if not is_numeric(f.dataType)]
    settled = settle(df, fields, other, places) if top == "nominated" else None
    ranked = other if settled is None else settled.left
    if distinct == "approx":
        counts = approx_distinct_counts(df, fields, approx_rsd)
        counted = ranked
    else:
        known = {} if settled is None else settled.distinct
        by_words = [i for i, f in enumerate(fields) if counts_by_words(f)]
        counts = word_counts(df, fields, by_words)
        if known:
            rows = df.sparkSession.createDataFrame(list(known.items()), "col_id int, distinct_count bigint")
            counts = counts.unionByName(rows)
        counted = [i for i in range(len(fields)) if i not in by_words and i not in known]
    chosen = [] if settled is None else [top_values(settled.freq, places)]
    if counted:
        freq = value_frequencies(df, fields, counted)
        if distinct == "exact":
            own = distinct_counts(freq)
            counts = own.unionByName(counts) if by_words or known else own
        chosen.append(top_values(freq, places, only=ranked))
    if chosen:
        best = reduce(DataFrame.unionByName, chosen)
        if long_ties == "value":
            best = ranked_by_value(best, TOP_VALUES, df, fields)
        top_rows = top_value_rows(with_full_texts(best, df, fields), fields)
    else:
        top_rows = df.sparkSession.createDataFrame(
            [], "column_name string, rank int, value string, count bigint"
        )
    return ProfileResult(
        columns=build_columns(column_stats(df) if stats is None else stats, counts, top_rows),
        top_values=top_rows,
        issues=validate(df, Contract.of(contract)),
        shape=df.agg(F.count("*").alias("total_rows")).withColumn(
            "total_columns", F.lit(len(fields)).cast("bigint")
        ),
        uniqueness=uniqueness,
    )
