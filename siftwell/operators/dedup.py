"""Whole-row and keyed duplicate removal, and duplicate counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import col, find_fields, is_orderable, pin
from siftwell.sources.workspace import discard, materialize

#: Repeated keys up to which the late form broadcasts them: 16 bytes each, so 16 MB.
REPEATED_KEYS = 1 << 20
HASHES = ("__key_hash_1", "__key_hash_2")


def _key_names(df: DataFrame, keys: Sequence[str] | None) -> list[str]:
    if not keys:
        return df.columns
    fields, absent = find_fields(df, keys)
    if absent:
        raise ValueError(f"deduplication keys not in the table: {absent}")
    return [f.name for f in fields]


def drop_duplicate_rows(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep one row per key; without keys, one of each set of identical rows.

    Nulls equal each other in keys. Of the rows sharing a key the first by ``order_by``
    survives, remaining ties by the other columns ascending, so a rerun or a retried task
    keeps the same rows. Both forms shrink groups before the shuffle, so a key that many
    rows share sends at most one row per task.
    """
    if not keys:
        return _distinct_rows(df)
    names = _key_names(df, keys)
    order = [col(c) if isinstance(c, str) else c for c in order_by or ()]
    order += [
        col(f.name).asc_nulls_first()
        for f in df.schema.fields
        if f.name not in names and is_orderable(f.dataType)
    ]
    if not order:
        return df.dropDuplicates(names)
    window = Window.partitionBy(*[col(n) for n in names]).orderBy(*order)
    taken = "__row_in_key"
    return df.withColumn(taken, F.row_number().over(window)).where(col(taken) == 1).drop(taken)


def drop_duplicate_rows_late(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str | Column] | None = None,
    most: int = REPEATED_KEYS,
) -> DataFrame:
    """The rows of :func:`drop_duplicate_rows`, of which only those with repeated keys are shuffled.

    A first pass, run at once, reads the key columns alone and counts them by two 64-bit hashes; what
    occurs more than once is stored and counted. If that is at most ``most`` hashes, they are
    broadcast: rows without a repeated key pass through where they are read, and only the others are
    ranked. A table without repeated keys is returned as it is. Equal hashes of different keys merely
    rank more rows. Beyond ``most`` the plain form runs.

    Worth it for wide tables of few duplicates: three scans in place of a shuffle of every column. The
    table is read again, so it should be stored and stable. Nulls equal each other; an empty table stays
    empty; columns may have any names but the two in ``HASHES``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    compared = [_comparable(n, types[n]) for n in _key_names(df, keys)]
    # Two places for each hash of a key: the second starts from another value.
    hashed = {HASHES[0]: F.xxhash64(*compared), HASHES[1]: F.xxhash64(F.lit(1), *compared)}
    per_key = df.select(*[h.alias(n) for n, h in hashed.items()]).groupBy(*HASHES).agg(F.count("*").alias("n"))
    stored, path = materialize(per_key.where(F.col("n") > 1).select(*HASHES), "repeated-keys")
    try:
        found = stored.count()
        if not found:
            return df
        if found > most:
            return drop_duplicate_rows(df, keys, order_by)
        repeated = F.broadcast(pin(stored))
    finally:
        discard(df.sparkSession, path)
    marked = df.withColumns(hashed)
    once = marked.join(repeated, list(HASHES), "left_anti").drop(*HASHES)
    more = marked.join(repeated, list(HASHES), "left_semi").drop(*HASHES)
    return once.unionByName(drop_duplicate_rows(more, keys, order_by))


def _comparable(name: str, dtype: T.DataType) -> Column:
    """A column that Spark can group by: maps become their entries, ordered by key."""
    if isinstance(dtype, T.MapType) and is_orderable(dtype.keyType) and is_orderable(dtype.valueType):
        return F.array_sort(F.map_entries(col(name)))
    return col(name)


def _distinct_rows(df: DataFrame) -> DataFrame:
    """One of each set of identical rows; maps are equal if their entries are, in any order."""
    if all(is_orderable(f.dataType) for f in df.schema.fields):
        return df.dropDuplicates()
    plain = df.select(*[_comparable(f.name, f.dataType).alias(f.name) for f in df.schema.fields])
    return plain.dropDuplicates().select(
        *[
            (F.map_from_entries(col(f.name)) if isinstance(f.dataType, T.MapType) else col(f.name))
            .alias(f.name)
            for f in df.schema.fields
        ]
    )


def rows_and_keys(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: ``row_count`` and ``distinct_count`` of the keys (nulls count as one key)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    names = [_comparable(n, types[n]).alias(n) for n in _key_names(df, keys)]
    per_key = df.groupBy(*names).agg(F.count("*").alias("__n"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_count"),
    )


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: ``row_count``, ``distinct_count``, ``duplicate_rows``."""
    return rows_and_keys(df, keys).withColumn(
        "duplicate_rows", F.col("row_count") - F.col("distinct_count")
    )
