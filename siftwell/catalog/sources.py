"""Queries over scans, casts and writers."""

from siftwell.catalog.inputs import (
    DIRTY_ORDERS,
    FILLED_ORDERS,
    NORMAL_ORDERS,
    dirty_orders,
    per_column_sql,
    table,
)
from siftwell.catalog.registry import query
from siftwell.operators.cleaning import TableCleaner
from siftwell.operators.nulls import normalize_nulls, null_audit
from siftwell.sources import (
    cast_columns,
    cast_failures,
    read_text_csv,
    work_path,
    write_csv,
    write_parquet,
    write_report,
)
from pyspark.sql import functions as F

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("csv_scan_cast", "SELECT * FROM orders")
def csv_scan_cast(spark, folder):
    orders = table(spark, folder, "orders")
    path = work_path(spark, "orders-csv")
    write_csv(orders, path)
    types = {f.name: f.dataType for f in orders.schema.fields}
    return cast_columns(read_text_csv(spark, path), {**types, "absent": "bigint"})


@query(
    "cast_invalid_to_null",
    f"""WITH {DIRTY_ORDERS}
    SELECT o_orderkey, TRY_CAST(o_orderstatus AS BIGINT) AS status_number,
      TRY_CAST(concat(CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE '' END)
        AS BIGINT) AS code
    FROM dirty""",
)
def cast_invalid_to_null(spark, folder):
    suffix = F.when(F.col("o_orderkey") % 10 == 0, "x").otherwise("")
    texts = dirty_orders(spark, folder).select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status_number"),
        F.concat(F.col("o_orderkey").cast("string"), suffix).alias("code"),
    )
    return cast_columns(texts, {"status_number": "bigint", "code": "bigint"})


def _cleaned(spark, folder):
    cleaner = TableCleaner(keys=["o_orderkey"], relative_error=0.0)
    return cleaner.fit_transform(dirty_orders(spark, folder))


@query("sink_csv_roundtrip", f"WITH {FILLED_ORDERS} SELECT * FROM clean")
def sink_csv_roundtrip(spark, folder):
    cleaned = _cleaned(spark, folder)
    path = work_path(spark, "cleaned-csv")
    write_csv(cleaned, path)
    return cast_columns(
        read_text_csv(spark, path), {f.name: f.dataType for f in cleaned.schema.fields}
    )


@query("sink_parquet_roundtrip", f"WITH {FILLED_ORDERS} SELECT * FROM clean")
def sink_parquet_roundtrip(spark, folder):
    path = work_path(spark, "cleaned-parquet")
    write_parquet(_cleaned(spark, folder), path)
    return spark.read.parquet(path)


@query(
    "report_json_roundtrip",
    f"WITH {NORMAL_ORDERS} "
    + per_column_sql(
        [*ORDER_COLUMNS, "o_note", "o_orderdate"],
        "SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        "round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct, "
        "count(*) AS row_count FROM normal",
    ),
)
def report_json_roundtrip(spark, folder):
    report = null_audit(normalize_nulls(dirty_orders(spark, folder)))
    path = work_path(spark, "null-audit")
    write_report(report, path)
    return spark.read.schema(report.schema).json(path)


def _broken_csv(spark, folder):
    """Orders as CSV lines; prices with a stray letter, days that do not exist, missing and extra fields."""
    every = lambda n: F.col("o_orderkey") % n == 0
    price = F.concat(F.col("o_totalprice").cast("string"), F.when(every(10), "x").otherwise(""))
    day = F.when(every(12), "2024-02-31").when(every(5), "").otherwise("2024-02-28")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", price, day)
    line = F.when(every(21), F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus")).when(
        every(22), F.concat(line, F.lit(",more"))
    ).otherwise(line)
    path = work_path(spark, "broken-csv")
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    return path


BROKEN_TYPES = {"key": "bigint", "price": "double", "day": "date"}
BROKEN_COLUMNS = ["key", "status", "price", "day"]
BROKEN = """lines AS (
  SELECT o_orderkey AS key, CASE WHEN o_orderkey % 21 = 0 THEN NULL
      ELSE CAST(o_totalprice AS VARCHAR) || CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE '' END END AS price,
    CASE WHEN o_orderkey % 21 = 0 THEN NULL WHEN o_orderkey % 12 = 0 THEN '2024-02-31'
      WHEN o_orderkey % 5 = 0 THEN NULL ELSE '2024-02-28' END AS day,
    o_orderkey % 21 = 0 OR o_orderkey % 22 = 0 AS broken
  FROM orders)"""


@query(
    "csv_cast_failures",
    f"""WITH {BROKEN}
    SELECT 'key' AS column_name, 'bigint' AS data_type, count(*) AS value_count, 0 AS failed_count FROM lines
    UNION ALL SELECT 'price', 'double', count(price), count(*) FILTER (price LIKE '%x') FROM lines
    UNION ALL SELECT 'day', 'date', count(day), count(*) FILTER (day = '2024-02-31') FROM lines""",
)
def csv_cast_failures(spark, folder):
    """Values that a cast of the scanned text cannot read, by column."""
    rows = read_text_csv(spark, _broken_csv(spark, folder), "line", BROKEN_COLUMNS)
    return cast_failures(rows, BROKEN_TYPES).drop("least_failed")


@query(
    "csv_corrupt_records",
    f"WITH {BROKEN} SELECT key, CASE WHEN broken THEN key END AS line_key FROM lines",
)
def csv_corrupt_records(spark, folder):
    """Records with too few or too many fields keep their line; the others have none."""
    rows = read_text_csv(spark, _broken_csv(spark, folder), "line", BROKEN_COLUMNS)
    line_key = F.split_part("line", F.lit(","), F.lit(1)).cast("bigint")
    return rows.select(F.col("key").cast("bigint"), line_key.alias("line_key"))


@query("sink_balanced_roundtrip", f"WITH {FILLED_ORDERS} SELECT * FROM clean")
def sink_balanced_roundtrip(spark, folder):
    path = work_path(spark, "cleaned-balanced")
    write_parquet(_cleaned(spark, folder), path, file_bytes=1 << 20)
    return spark.read.parquet(path)
