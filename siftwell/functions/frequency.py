"""Value frequencies of many columns from one scan and one shuffle.

Every value is stacked into a narrow row ``(col_id, num, real, txt)``, with the value in the
slot that suits its type, and counted. Spark combines equal values before the shuffle, so a
value that fills a third of a column travels as one row per task. A text of more than
``LONG_BYTES`` bytes is represented by its first characters and its SHA-256, so the shuffle never
carries whole documents; the few that end up in a report are looked up afterwards. Distinct
counts, modes and top values are all small aggregates of this one table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import (
    COLUMNS_PER_PASS,
    is_float,
    is_nested,
    merge_group,
    sql_name,
    sql_text,
    stacked_sketches,
)

# Standard error of the largest HyperLogLog sketch, of 2^21 registers.
LEAST_SKETCH_ERROR = 1.04 / 2**10.5

KEYS = ("col_id", "num", "real", "txt")


# A text that needs more bytes is keyed by its start and its digest. The key is longer than any
# text that stands for itself, so the two never meet.
LONG_BYTES = 120
START_CHARACTERS = 64

# Times inside nested values, to the microsecond.
JSON_OPTIONS = (
    "map('ignoreNullFields', 'false', "
    "'timestampFormat', 'yyyy-MM-dd HH:mm:ss.SSSSSSXXX', "
    "'timestampNTZFormat', 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
)


def _has_float(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_float(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_float(dtype.keyType) or _has_float(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_has_float(f.dataType) for f in dtype.fields)
    return is_float(dtype)


def _without_minus_zero(value: str, dtype: T.DataType, depth: int = 0) -> str:
    """SQL of a value whose negative zeros, at any depth, are zeros."""
    if not _has_float(dtype):
        return value
    inner = f"x{depth}"
    if isinstance(dtype, T.ArrayType):
        return f"transform({value}, {inner} -> {_without_minus_zero(inner, dtype.elementType, depth + 1)})"
    if isinstance(dtype, T.MapType):
        # Keys are normalised by Spark itself.
        changed = _without_minus_zero(inner, dtype.valueType, depth + 1)
        return f"transform_values({value}, (k{depth}, {inner}) -> {changed})"
    if isinstance(dtype, T.StructType):
        parts = [
            f"{sql_text(f.name)}, {_without_minus_zero(f'{value}.{sql_name(f.name)}', f.dataType, depth)}"
            for f in dtype.fields
        ]
        return f"CASE WHEN {value} IS NOT NULL THEN named_struct({', '.join(parts)}) END"
    return f"({value} + 0)"


def _json(value: str, dtype: T.DataType) -> str:
    entries = _without_minus_zero(value, dtype)
    if isinstance(dtype, T.MapType):
        entries = f"map_from_entries(array_sort(map_entries({entries})))"
    text = f"to_json({entries}, {JSON_OPTIONS})"
    return f"CASE WHEN {value} IS NOT NULL THEN {text} END"


def full_text(value: str, dtype: T.DataType) -> str:
    """SQL of the text of a value of a type that is kept in the ``txt`` slot."""
    if isinstance(dtype, T.BinaryType):
        return f"hex({value})"
    if is_nested(dtype):
        return _json(value, dtype)
    return f"CAST({value} AS STRING)"


def key_text(text: str) -> str:
    """SQL of the key of a text: itself, or its start and digest."""
    key = f"concat(substring({text}, 1, {START_CHARACTERS}), sha2({text}, 256))"
    return f"CASE WHEN octet_length({text}) > {LONG_BYTES} THEN {key} ELSE {text} END"


def is_long(txt: Column) -> Column:
    """Whether a ``txt`` slot stands for a longer text."""
    return F.octet_length(txt) > LONG_BYTES


def may_be_long(dtype: T.DataType) -> bool:
    return encode("x", dtype)[2] is not None and not isinstance(dtype, T.DecimalType)


def encode(value: str, dtype: T.DataType) -> tuple[str | None, str | None, str | None]:
    """SQL of the ``(num, real, txt)`` slots of a value; equal slots mean equal values."""
    if isinstance(dtype, T.BooleanType):
        return f"CAST(CAST({value} AS INT) AS BIGINT)", None, None
    if isinstance(dtype, T.IntegralType):
        return f"CAST({value} AS BIGINT)", None, None
    if isinstance(dtype, T.DateType):
        return f"CAST(unix_date({value}) AS BIGINT)", None, None
    if isinstance(dtype, T.TimestampType):
        return f"unix_micros({value})", None, None
    if is_float(dtype):
        return None, f"CAST({value} AS DOUBLE)", None
    if isinstance(dtype, T.DecimalType):
        # The text is exact, the double in front of it makes ties order by size.
        return None, f"CAST({value} AS DOUBLE)", f"CAST({value} AS STRING)"
    return None, None, key_text(full_text(value, dtype))


def decode(num: Column, real: Column, txt: Column, dtype: T.DataType) -> Column:
    """Inverse of :func:`encode` for every non-nested type, given whole texts."""
    if isinstance(dtype, T.BooleanType):
        return num.cast("boolean")
    if isinstance(dtype, T.IntegralType):
        return num.cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(num.cast("int"))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(num)
    if is_float(dtype):
        return real.cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.unhex(txt)
    if is_nested(dtype):
        return txt
    return txt.cast(dtype)


def decode_row(row: Row, dtype: T.DataType) -> Column:
    """Literal of the type ``dtype`` for one collected frequency row."""
    return decode(F.lit(row["num"]), F.lit(row["real"]), F.lit(row["txt"]), dtype)


def stacked_values(
    df: DataFrame, fields: Sequence[T.StructField], only: Sequence[int] | None = None
) -> DataFrame:
    """``(col_id, num, real, txt)``: a row for each non-null value of the columns."""
    nothing = [f"CAST(NULL AS {t})" for t in ("BIGINT", "DOUBLE", "STRING")]
    counted = list(range(len(fields)) if only is None else only)
    cells: list[str] = []
    for i in counted:
        slots = encode(sql_name(fields[i].name), fields[i].dataType)
        cells += [str(i), *[slot or null for slot, null in zip(slots, nothing)]]
    if not counted:
        cells, df = ["0", *nothing], df.limit(0)
    return (
        df.selectExpr(f"stack({max(1, len(counted))}, {', '.join(cells)}) AS ({', '.join(KEYS)})")
        # Known not to be null, or joins on it would add a filter and spoil the shared shuffle.
        .withColumn("col_id", F.coalesce("col_id", F.lit(-1)))
        .where(F.col("num").isNotNull() | F.col("real").isNotNull() | F.col("txt").isNotNull())
    )


def value_frequencies(
    df: DataFrame, fields: Sequence[T.StructField], only: Sequence[int] | None = None
) -> DataFrame:
    """``(col_id, num, real, txt, freq)``: how often each non-null value occurs.

    ``col_id`` is the position in ``fields``; ``only`` names the positions to count.
    """
    return stacked_values(df, fields, only).groupBy(*KEYS).agg(F.count("*").alias("freq"))


def distinct_counts(freq: DataFrame) -> DataFrame:
    """``(col_id, distinct_count)``, the distinct non-null values per column.

    Counting by ``freq`` keeps that column in the plan, as in :func:`top_values`, so that Spark
    shuffles once when both are taken from one frequency table.
    """
    return freq.groupBy("col_id").agg(F.count_if(F.col("freq") > 0).alias("distinct_count"))


def counts_by_words(field: T.StructField) -> bool:
    """Whether distinct values of a column that is not ranked are counted by words of bits."""
    return isinstance(field.dataType, T.IntegralType)


def word_counts(df: DataFrame, fields: Sequence[T.StructField], only: Sequence[int]) -> DataFrame:
    """``(col_id, distinct_count)`` of integer columns, without shuffling single values.

    A value is a bit in a word of 64 neighbouring values; tasks send the words they met. Of a dense
    column that is one row for up to 64 values, of a scattered one no more than its values.
    """
    if not only:
        return df.sparkSession.createDataFrame([], "col_id int, distinct_count bigint")
    cells = ", ".join(f"{i}, CAST({sql_name(fields[i].name)} AS BIGINT)" for i in only)
    words = (
        df.selectExpr(f"stack({len(only)}, {cells}) AS (col_id, num)")
        .where(F.col("num").isNotNull())
        .groupBy(F.coalesce("col_id", F.lit(-1)).alias("col_id"), F.expr("shiftright(num, 6)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(num & 63L AS INT)))").alias("bits"))
    )
    return words.groupBy("col_id").agg(F.sum(F.bit_count("bits")).cast("bigint").alias("distinct_count"))


def hll_size(relative_error: float) -> int:
    """Logarithm of the registers of HyperLogLog sketches with a standard error."""
    if not relative_error >= LEAST_SKETCH_ERROR:
        raise ValueError(
            f"no sketch has a standard error of {relative_error}; the least is "
            f"{LEAST_SKETCH_ERROR:.2g}, count exactly below it"
        )
    return max(4, math.ceil(math.log2((1.04 / relative_error) ** 2)))


def hll_value(field: T.StructField) -> str:
    """SQL of what a sketch gets of a value: equal values have equal hashes, null stays null."""
    value = sql_name(field.name)
    plain = _json if isinstance(field.dataType, (T.MapType, T.VariantType)) else _without_minus_zero
    return f"CASE WHEN {value} IS NOT NULL THEN xxhash64({plain(value, field.dataType)}) END"


def approx_distinct_counts(
    df: DataFrame, fields: Sequence[T.StructField], relative_error: float
) -> DataFrame:
    """``(col_id, distinct_count)`` estimated by HyperLogLog sketches, without shuffling values.

    ``relative_error`` is the standard error, at least ``LEAST_SKETCH_ERROR``. Sketches are merged
    in two levels, so that no task merges those of all tasks.
    """
    log_k = hll_size(relative_error)
    parts = []
    for start in range(0, len(fields), COLUMNS_PER_PASS):
        chunk = range(start, min(start + COLUMNS_PER_PASS, len(fields)))
        sketches = [F.expr(f"hll_sketch_agg({hll_value(fields[i])}, {log_k}) AS s{i}") for i in chunk]
        merged = stacked_sketches(df.groupBy(merge_group()).agg(*sketches), chunk)
        parts.append(merged.groupBy("col_id").agg(F.expr("hll_union_agg(sketch)").alias("sketch")))
    every = reduce(DataFrame.unionByName, parts)
    return every.select("col_id", F.expr("hll_sketch_estimate(sketch)").alias("distinct_count"))


def top_values(
    freq: DataFrame, k: int, only: Sequence[int] | None = None, within: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` most frequent values per column, ties by value ascending, with ``rank``.

    Long texts are ordered by their first characters, then by digest (see
    :mod:`siftwell.functions.long_ties` for an order by value).

    Spark limits each task to ``k`` rows per column before the shuffle (``WindowGroupLimit``),
    so a column with billions of distinct values sends only ``k`` rows per task. ``only`` names
    the columns to rank, ``within`` splits each column's ranking further.
    """
    if only is not None:
        # Put as a test on the count, the filter stays above the aggregation, and the shuffle
        # below is the one that distinct_counts reads.
        never = F.lit(2**63 - 1)
        freq = freq.where(F.col("freq") >= F.when(F.col("col_id").isin(list(only)), 1).otherwise(never))
    order = [F.col("freq").desc()] + [F.col(c).asc_nulls_first() for c in KEYS[1:]]
    window = Window.partitionBy("col_id", *within).orderBy(*order)
    return freq.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def with_full_texts(rows: DataFrame, df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """Frequency rows, a few for each column, with whole texts in place of their keys.

    Costs a scan only if one of them is long; else the join has nothing to look up and is dropped.
    """
    ids = [i for i, f in enumerate(fields) if may_be_long(f.dataType)]
    if not ids:
        return rows
    cells = []
    for i in ids:
        text = full_text(sql_name(fields[i].name), fields[i].dataType)
        cells.append(f"{i}, {text}")
    texts = df.selectExpr(f"stack({len(ids)}, {', '.join(cells)}) AS (id, full)")
    texts = texts.where(is_long(F.col("full"))).withColumn("key", F.expr(key_text("full")))
    # At most as many rows as the report has.
    wanted = rows.where(is_long(F.col("txt"))).select(F.col("col_id").alias("w_id"), F.col("txt").alias("w_txt"))
    found = (
        texts.join(F.broadcast(wanted), (F.col("id") == F.col("w_id")) & (F.col("key") == F.col("w_txt")))
        .groupBy("id", "key")
        .agg(F.min("full").alias("full"))
    )
    same = (F.col("col_id") == F.col("id")) & (F.col("txt") == F.col("key"))
    joined = rows.join(F.broadcast(found), same, "left").drop("id", "key")
    return joined.withColumn("txt", F.coalesce("full", "txt")).drop("full")


def value_text(fields: Sequence[T.StructField]) -> Column:
    """Spark's text of the value in a frequency row, whatever its column's type."""
    num, real, txt = F.col("num"), F.col("real"), F.col("txt")
    special: dict[str, tuple[Column, list[int]]] = {}
    for i, field in enumerate(fields):
        dtype = field.dataType
        if isinstance(dtype, (T.BooleanType, T.DateType, T.TimestampType, T.BinaryType, T.FloatType)):
            text = decode(num, real, txt, dtype).cast("string")
            special.setdefault(dtype.typeName(), (text, []))[1].append(i)
    text = F.coalesce(txt, num.cast("string"), real.cast("string"))
    for special_text, ids in special.values():
        text = F.when(F.col("col_id").isin(ids), special_text).otherwise(text)
    return text
