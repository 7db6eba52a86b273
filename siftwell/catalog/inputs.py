"""Input tables of the registered queries.

The given tables hold no nulls, null markers or whole-row duplicates, so two views add some to
every row range: ``dirty_orders`` and ``dirty_events``. Both keep all rows of their table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with nulls, markers, huge prices, a sparse column, and every 50th row doubled."""
    key = F.col("o_orderkey")
    every = lambda n: key % n == 0
    copies = F.array_repeat(F.lit(1), F.when(every(50), 2).otherwise(1))
    price = F.col("o_totalprice")
    return (
        table(spark, folder, "orders")
        .select(
            "o_orderkey",
            "o_custkey",
            F.when(every(19), None).when(every(11), "N/A").otherwise(F.col("o_orderstatus"))
            .alias("o_orderstatus"),
            F.when(every(7), None).when(every(101), price * 50).otherwise(price)
            .alias("o_totalprice"),
            F.when(every(13), "").when(every(17), "Unknown").otherwise(F.col("o_orderpriority"))
            .alias("o_orderpriority"),
            F.when(every(20), "rush").alias("o_note"),
            "o_orderdate",
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


DIRTY_ORDERS = """
base AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'N/A'
         ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN o_totalprice * 50
         ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN 'Unknown'
         ELSE o_orderpriority END AS o_orderpriority,
    CASE WHEN o_orderkey % 20 = 0 THEN 'rush' ELSE NULL END AS o_note,
    o_orderdate
  FROM orders),
dirty AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE o_orderkey % 50 = 0)"""

MARKERS = "('N/A', 'null', 'None', '', 'Unknown', 'n/a', 'NA', 'NaN')"

NORMAL_ORDERS = (
    DIRTY_ORDERS
    + f""",
normal AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderstatus IN {MARKERS} THEN NULL ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice,
    CASE WHEN o_orderpriority IN {MARKERS} THEN NULL ELSE o_orderpriority END AS o_orderpriority,
    CASE WHEN o_note IN {MARKERS} THEN NULL ELSE o_note END AS o_note,
    o_orderdate
  FROM dirty)"""
)


def mode_sql(column: str, source: str) -> str:
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count(*) DESC, {column} ASC LIMIT 1)"
    )


FILLED_ORDERS = (
    NORMAL_ORDERS
    + f""",
filled AS (
  SELECT o_orderkey, o_custkey,
    coalesce(o_orderstatus, {mode_sql("o_orderstatus", "normal")}) AS o_orderstatus,
    coalesce(o_totalprice, (SELECT quantile_disc(o_totalprice, 0.5) FROM normal)) AS o_totalprice,
    coalesce(o_orderpriority, {mode_sql("o_orderpriority", "normal")}) AS o_orderpriority,
    o_orderdate
  FROM normal),
clean AS (SELECT DISTINCT * FROM filled)"""
)


def wide_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Keys shifted beyond the precision of doubles, as long and as decimal."""
    key = F.col("o_orderkey")
    shift = F.lit("12345678901234567890.12").cast("decimal(38,2)")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        (key + F.lit(1 << 60)).alias("big"),
        (key.cast("decimal(38,2)") + shift).cast("decimal(38,2)").alias("amount"),
    )


def dirty_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with nulls in a long, a boolean, a date and a text column, and a clock text."""
    key = F.col("event_id")
    every = lambda n: key % n == 0
    clock = F.substring(F.col("ts").cast("string"), 12, 5)
    return table(spark, folder, "events").select(
        "event_id",
        F.when(~every(9), F.col("user_id")).alias("user_id"),
        F.when(every(14), "Unknown").when(~every(15), F.col("event_type")).alias("event_type"),
        F.when(~every(17), F.col("value")).alias("value"),
        F.when(~every(23), F.col("value") > 50).alias("is_high"),
        F.when(~every(29), F.col("ts").cast("date")).alias("event_date"),
        F.when(every(31), "").when(every(37), "x:1").otherwise(clock).alias("clock"),
    )


DIRTY_EVENTS = """
dirty AS (
  SELECT event_id,
    CASE WHEN event_id % 9 <> 0 THEN user_id END AS user_id,
    CASE WHEN event_id % 14 = 0 THEN 'Unknown' WHEN event_id % 15 <> 0 THEN event_type END
      AS event_type,
    CASE WHEN event_id % 17 <> 0 THEN value END AS value,
    CASE WHEN event_id % 23 <> 0 THEN value > 50 END AS is_high,
    CASE WHEN event_id % 29 <> 0 THEN CAST(ts AS DATE) END AS event_date,
    CASE WHEN event_id % 31 = 0 THEN '' WHEN event_id % 37 = 0 THEN 'x:1'
         ELSE substr(CAST(ts AS VARCHAR), 12, 5) END AS clock
  FROM events)"""


def per_column_sql(columns: list[str], select: str) -> str:
    """One SELECT per column, joined by UNION ALL; ``{c}`` is the column."""
    return " UNION ALL ".join(select.replace("{c}", c) for c in columns)
