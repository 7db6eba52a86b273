"""Top values without shuffling the values of columns that are skewed, narrow or unique.

Three passes settle what they can; a column that none of them settles is counted whole, as in
:mod:`siftwell.functions.frequency`.

1. **Nominate.** Frequent-items sketches of all columns, merged in two levels, name the most
   frequent values. They are hints only: nothing below trusts their counts.
2. **Certify.** One scan counts the nominated values exactly and all other values by ``BUCKETS``
   hash buckets. A bucket's rows bound the count of each of its values, so if the ``k``-th nominated
   count exceeds the fullest bucket, no other value can reach or tie with the top ``k``. Without
   other values, the column is known whole. Tasks send at most a row per bucket.
3. **Unique columns.** Where nothing occurs twice among the nominated, rows are counted by two 64-bit
   hashes. If no pair of hashes occurs twice, neither does a value; then the top values are the ``k``
   least, which each task cuts to ``k`` before the shuffle. Equal hashes of two different values
   only make this test fail.

All results are exact, and equal to those of counting every value. The driver holds ``NOMINATED``
short keys a column. Nulls are not values; a column of nulls has no top values and an empty table none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import merge_group
from siftwell.functions.frequency import stacked_values, top_values, value_frequencies

#: Values named for each column, at least ``k``, and those that a sketch tracks.
NOMINATED, TRACKED = 16, 4096
#: Hash buckets that bound the counts of all other values of a column.
BUCKETS = 4096
#: Columns sketched in one scan; an aggregate of more groups would sort its input in every task.
SKETCHED_AT_ONCE = 100

FREQUENCIES = "col_id int, num bigint, real double, txt string, freq bigint"
#: One text for each value of a column. Adding zero makes negative zeros equal to others.
KEY = "coalesce(txt, CAST(num AS STRING), CAST(real + 0 AS STRING))"


@dataclass(frozen=True)
class Settled:
    """What is known without a count of every value.

    ``freq`` has rows of a frequency table, of settled columns only, among them all that can be in a
    top ``k``; ``distinct`` the exact distinct counts found on the way; ``left`` the other columns.
    """

    freq: DataFrame
    distinct: dict[int, int]
    left: list[int]


def nominated(
    df: DataFrame, fields: Sequence[T.StructField], only: Sequence[int], most: int = NOMINATED
) -> list[tuple[int, str]]:
    """``(col_id, key)`` of at most ``most`` values a column that sketches take for frequent."""
    parts = []
    for start in range(0, len(only), SKETCHED_AT_ONCE):
        cells = stacked_values(df, fields, only[start : start + SKETCHED_AT_ONCE])
        first = cells.groupBy("col_id", merge_group()).agg(
            F.expr(f"approx_top_k_accumulate({KEY}, {TRACKED})").alias("state")
        )
        whole = first.groupBy("col_id").agg(F.expr(f"approx_top_k_combine(state, {TRACKED})").alias("state"))
        parts.append(whole.select("col_id", F.expr(f"inline(approx_top_k_estimate(state, {most}))")))
    if not parts:
        return []
    rows = reduce(DataFrame.unionByName, parts).select("col_id", "item").collect()
    return [(r["col_id"], r["item"]) for r in rows]


def certified(
    df: DataFrame, fields: Sequence[T.StructField], only: Sequence[int], names: Sequence[tuple[int, str]]
) -> DataFrame:
    """One row per column with values: ``counts`` of the named values and a ``bound`` on all others.

    ``bound`` is null if there are no others.
    """
    # At most NOMINATED rows a column.
    listed = F.broadcast(df.sparkSession.createDataFrame(list(names), "named_id int, name string"))
    cells = stacked_values(df, fields, only).withColumn("key", F.expr(KEY))
    met = cells.join(listed, (F.col("col_id") == F.col("named_id")) & (F.col("key") == F.col("name")), "left")
    known = F.col("name").isNotNull()

    def of_named(column: str) -> Column:
        return F.when(known, F.col(column)).alias(column)

    bucket = F.when(~known, F.pmod(F.xxhash64("key"), F.lit(BUCKETS))).alias("bucket")
    counted = met.groupBy("col_id", bucket, of_named("num"), of_named("real"), of_named("txt")).agg(
        F.count("*").alias("freq")
    )
    named = F.col("bucket").isNull()
    return counted.groupBy("col_id").agg(
        F.max(F.when(~named, F.col("freq"))).alias("bound"),
        F.collect_list(F.when(named, F.struct("num", "real", "txt", "freq"))).alias("counts"),
    )


def unique_counts(df: DataFrame, fields: Sequence[T.StructField], only: Sequence[int]) -> dict[int, int]:
    """Number of values of the columns in which every value is proved to occur once."""
    if not only:
        return {}
    pair = [F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")]
    hashes = stacked_values(df, fields, only).withColumn("key", F.expr(KEY)).select("col_id", *pair)
    per_value = hashes.groupBy("col_id", "h1", "h2").agg(F.count("*").alias("n"))
    found = per_value.groupBy("col_id").agg(F.max("n").alias("most"), F.count("*").alias("values"))
    return {r["col_id"]: r["values"] for r in found.collect() if r["most"] == 1}


def settle(df: DataFrame, fields: Sequence[T.StructField], only: Sequence[int], k: int) -> Settled:
    """Find the top ``k`` values of the columns at positions ``only``, as far as that is cheap."""
    session = df.sparkSession
    names = nominated(df, fields, only, max(k, NOMINATED)) if only else []
    found = {r["col_id"]: r for r in certified(df, fields, only, names).collect()} if only else {}
    rows, distinct, unsure, left = [], {}, [], []
    for i in only:
        counts = found[i]["counts"] if i in found else []
        bound = found[i]["bound"] if i in found else None
        best = sorted((c["freq"] for c in counts), reverse=True)
        if bound is None:
            distinct[i] = len(counts)
        elif len(best) < k or best[k - 1] <= bound:
            (unsure if max(best, default=1) == 1 else left).append(i)
            continue
        rows += [(i, c["num"], c["real"], c["txt"], c["freq"]) for c in counts]
    unique = unique_counts(df, fields, unsure)
    distinct.update(unique)
    freq = session.createDataFrame(rows, FREQUENCIES)
    if unique:
        once = stacked_values(df, fields, list(unique)).withColumn("freq", F.lit(1).cast("bigint"))
        freq = freq.unionByName(once)
    return Settled(freq, distinct, sorted([*left, *(i for i in unsure if i not in unique)]))


def settled_top_values(
    df: DataFrame, fields: Sequence[T.StructField], only: Sequence[int], k: int
) -> DataFrame:
    """Rows of :func:`siftwell.functions.frequency.top_values`, by :func:`settle` where possible."""
    settled = settle(df, fields, only, k)
    freq = settled.freq
    if settled.left:
        freq = freq.unionByName(value_frequencies(df, fields, settled.left))
    return top_values(freq, k)
