"""Queries over null handling, imputation and deduplication."""

from pyspark.sql import functions as F

from siftwell.catalog.inputs import (
    DIRTY_EVENTS,
    DIRTY_ORDERS,
    FILLED_ORDERS,
    MARKERS,
    NORMAL_ORDERS,
    dirty_events,
    dirty_orders,
    mode_sql,
    per_column_sql,
    table,
    wide_numbers,
)
from siftwell.catalog.registry import query
from siftwell.operators.cleaning import TableCleaner
from siftwell.operators.dedup import (
    drop_duplicate_rows,
    drop_duplicate_rows_late,
    duplicate_count,
)
from siftwell.operators.impute import Imputer
from siftwell.operators.nulls import (
    drop_sparse_columns,
    drop_sparse_rows,
    normalize_nulls,
    null_audit,
    sparse_columns,
)

CLEAN_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate",
]
ALL_COLUMNS = [*CLEAN_COLUMNS, "o_note"]


def _normal(spark, folder):
    return normalize_nulls(dirty_orders(spark, folder))


def _audit_sql(columns, source):
    return per_column_sql(
        columns,
        "SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        "round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct, "
        f"count(*) AS row_count FROM {source}",
    )


@query("null_normalize", f"WITH {NORMAL_ORDERS} SELECT * FROM normal")
def null_normalize(spark, folder):
    return _normal(spark, folder)


@query(
    "null_normalize_typed",
    f"""WITH {DIRTY_EVENTS}
    SELECT event_id, user_id,
      CASE WHEN event_type IN ('false', 'Unknown', '2024-01-01') THEN NULL ELSE event_type END
        AS event_type,
      value,
      CASE WHEN CAST(is_high AS VARCHAR) = 'false' THEN NULL ELSE is_high END AS is_high,
      CASE WHEN CAST(event_date AS VARCHAR) = '2024-01-01' THEN NULL ELSE event_date END
        AS event_date,
      clock
    FROM dirty""",
)
def null_normalize_typed(spark, folder):
    markers = ["false", "Unknown", "2024-01-01"]
    return normalize_nulls(dirty_events(spark, folder), markers)


@query("null_audit", f"WITH {NORMAL_ORDERS} {_audit_sql(ALL_COLUMNS, 'normal')}")
def null_audit_query(spark, folder):
    return null_audit(_normal(spark, folder))


@query("null_audit_after", f"WITH {FILLED_ORDERS} {_audit_sql(CLEAN_COLUMNS, 'clean')}")
def null_audit_after(spark, folder):
    dirty = dirty_orders(spark, folder)
    return _cleaner().fit(dirty).null_audit_after(dirty)


@query(
    "drop_sparse_columns",
    f"WITH {NORMAL_ORDERS} SELECT {', '.join(CLEAN_COLUMNS)} FROM normal",
)
def drop_sparse_columns_query(spark, folder):
    return drop_sparse_columns(_normal(spark, folder), 0.80)


@query(
    "dropped_columns_report",
    f"WITH {NORMAL_ORDERS}, audit AS ({_audit_sql(ALL_COLUMNS, 'normal')}) "
    "SELECT * FROM audit WHERE null_count / row_count > 0.80",
)
def dropped_columns_report(spark, folder):
    return sparse_columns(_normal(spark, folder), 0.80)


@query(
    "drop_sparse_rows",
    f"WITH {NORMAL_ORDERS} SELECT {', '.join(CLEAN_COLUMNS)} FROM normal WHERE "
    + " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in CLEAN_COLUMNS)
    + " <= 1",
)
def drop_sparse_rows_query(spark, folder):
    return drop_sparse_rows(_normal(spark, folder).drop("o_note"), 1)


def _filled_sql(price: str) -> str:
    return f"""WITH {NORMAL_ORDERS}
    SELECT o_orderkey, o_custkey,
      coalesce(o_orderstatus, {mode_sql("o_orderstatus", "normal")}) AS o_orderstatus,
      {price} AS o_totalprice,
      coalesce(o_orderpriority, {mode_sql("o_orderpriority", "normal")}) AS o_orderpriority,
      coalesce(o_note, 'rush') AS o_note, o_orderdate
    FROM normal"""


@query(
    "impute_mean",
    _filled_sql("round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM normal)), 4)"),
)
def impute_mean(spark, folder):
    filled = Imputer({"o_totalprice": "mean"}).fit_transform(_normal(spark, folder))
    return filled.withColumn("o_totalprice", F.round("o_totalprice", 4))


MEDIAN_SQL = _filled_sql(
    "coalesce(o_totalprice, (SELECT quantile_disc(o_totalprice, 0.5) FROM normal))"
)


@query("impute_median", MEDIAN_SQL)
def impute_median(spark, folder):
    imputer = Imputer({"o_totalprice": "median"}, relative_error=0.0)
    return imputer.fit_transform(_normal(spark, folder))


@query("impute_default", MEDIAN_SQL)
def impute_default(spark, folder):
    return Imputer(relative_error=0.0).fit_transform(_normal(spark, folder))


@query(
    "impute_mode",
    _filled_sql(f"coalesce(o_totalprice, {mode_sql('o_totalprice', 'normal')})"),
)
def impute_mode(spark, folder):
    columns = ["o_orderstatus", "o_totalprice", "o_orderpriority", "o_note"]
    return Imputer(dict.fromkeys(columns, "mode")).fit_transform(_normal(spark, folder))


@query(
    "impute_mode_nominated",
    _filled_sql(f"coalesce(o_totalprice, {mode_sql('o_totalprice', 'normal')})"),
)
def impute_mode_nominated(spark, folder):
    """The same modes from nominated values, counted exactly and certified."""
    columns = ["o_orderstatus", "o_totalprice", "o_orderpriority", "o_note"]
    imputer = Imputer(dict.fromkeys(columns, "mode"), nominate_modes=True)
    return imputer.fit_transform(_normal(spark, folder))


@query(
    "impute_constant",
    f"""WITH {NORMAL_ORDERS}
    SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, '?') AS o_orderstatus,
      coalesce(o_totalprice, 0.5) AS o_totalprice,
      coalesce(o_orderpriority, 'none') AS o_orderpriority,
      o_note, o_orderdate
    FROM normal""",
)
def impute_constant(spark, folder):
    values = {"o_orderstatus": "?", "o_totalprice": 0.5, "o_orderpriority": "none"}
    columns = [*values, "o_note"]
    imputer = Imputer(dict.fromkeys(columns, "constant"), values)
    return imputer.fit_transform(_normal(spark, folder))


@query(
    "impute_typed",
    f"""WITH {DIRTY_EVENTS},
    normal AS (SELECT * REPLACE (CASE WHEN event_type IN {MARKERS} THEN NULL ELSE event_type END
      AS event_type, CASE WHEN clock IN {MARKERS} THEN NULL ELSE clock END AS clock) FROM dirty)
    SELECT event_id,
      coalesce(user_id, CAST(trunc((SELECT avg(user_id) FROM normal)) AS BIGINT)) AS user_id,
      coalesce(event_type, 'other') AS event_type,
      coalesce(value, (SELECT quantile_disc(value, 0.5) FROM normal)) AS value,
      coalesce(is_high, {mode_sql("is_high", "normal")}) AS is_high,
      coalesce(event_date, {mode_sql("event_date", "normal")}) AS event_date,
      coalesce(clock, {mode_sql("clock", "normal")}) AS clock
    FROM normal""",
)
def impute_typed(spark, folder):
    imputer = Imputer(
        {"user_id": "mean", "event_type": "constant"}, {"event_type": "other"}, relative_error=0.0
    )
    return imputer.fit_transform(normalize_nulls(dirty_events(spark, folder)))


def _plan_sql(column, strategy, fill):
    return (
        f"SELECT '{column}' AS column_name, '{strategy}' AS strategy, "
        f"CAST({fill} AS VARCHAR) AS fill_value, count(*) - count({column}) AS null_count, "
        "'filled' AS status FROM normal"
    )


WITH_NULLS = ["o_orderstatus", "o_totalprice", "o_orderpriority", "o_note"]


@query(
    "impute_median_fit",
    f"WITH {NORMAL_ORDERS} "
    + " UNION ALL ".join(
        _plan_sql(c, "median", "(SELECT quantile_disc(o_totalprice, 0.5) FROM normal)")
        if c == "o_totalprice"
        else _plan_sql(c, "mode", mode_sql(c, "normal"))
        for c in WITH_NULLS
    ),
)
def impute_median_fit(spark, folder):
    """The whole plan: medians of numbers, modes of the rest."""
    return Imputer(relative_error=0.0).fit(_normal(spark, folder)).plan(spark)


@query(
    "impute_mode_fit",
    f"WITH {NORMAL_ORDERS} "
    + " UNION ALL ".join(_plan_sql(c, "mode", mode_sql(c, "normal")) for c in WITH_NULLS),
)
def impute_mode_fit(spark, folder):
    return Imputer(dict.fromkeys(WITH_NULLS, "mode")).fit(_normal(spark, folder)).plan(spark)


@query(
    "impute_wide_numbers",
    """WITH wide AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey + 1152921504606846976 END AS big,
        CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey AS DECIMAL(38, 2))
          + CAST('12345678901234567890.12' AS DECIMAL(38, 2)) END AS amount FROM orders)
    SELECT o_orderkey,
      CAST(coalesce(big, (SELECT quantile_disc(big, 0.5) FROM wide)) AS VARCHAR) AS big,
      CAST(coalesce(amount, (SELECT quantile_disc(amount, 0.5) FROM wide)) AS VARCHAR) AS amount
    FROM wide""",
)
def impute_wide_numbers(spark, folder):
    """Exact medians keep all digits of integers and decimals."""
    wide = wide_numbers(spark, folder).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("big")).alias("big"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("amount")).alias("amount"),
    )
    filled = Imputer(relative_error=0.0).fit_transform(wide)
    return filled.select("o_orderkey", F.col("big").cast("string"), F.col("amount").cast("string"))


@query("dedup_full_row", f"WITH {DIRTY_ORDERS} SELECT DISTINCT * FROM dirty")
def dedup_full_row(spark, folder):
    return drop_duplicate_rows(dirty_orders(spark, folder))


@query(
    "dedup_by_key",
    f"""WITH {DIRTY_ORDERS}
    SELECT * EXCLUDE (n) FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n
      FROM dirty) WHERE n = 1""",
)
def dedup_by_key(spark, folder):
    dirty = dirty_orders(spark, folder)
    return drop_duplicate_rows(dirty, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "dedup_documents_text",
    """SELECT * EXCLUDE (n) FROM (
      SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents)
    WHERE n = 1""",
)
def dedup_documents_text(spark, folder):
    return drop_duplicate_rows(table(spark, folder, "documents"), ["text"], ["doc_id"])


@query("dedup_full_row_late", f"WITH {DIRTY_ORDERS} SELECT DISTINCT * FROM dirty")
def dedup_full_row_late(spark, folder):
    """Only rows whose hash occurs again are shuffled."""
    return drop_duplicate_rows_late(dirty_orders(spark, folder))


@query(
    "dedup_documents_text_late",
    """SELECT * EXCLUDE (n) FROM (
      SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents)
    WHERE n = 1""",
)
def dedup_documents_text_late(spark, folder):
    """Documents without a copy pass through where they are read."""
    return drop_duplicate_rows_late(table(spark, folder, "documents"), ["text"], ["doc_id"])


@query(
    "dedup_lines_by_key_late",
    """SELECT * EXCLUDE (n) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate
        ORDER BY l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_tax) AS n FROM lineitem)
    WHERE n = 1""",
)
def dedup_lines_by_key_late(spark, folder):
    keys = ["l_orderkey", "l_linenumber", "l_shipdate"]
    order = ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]
    return drop_duplicate_rows_late(table(spark, folder, "lineitem"), keys, order)


@query(
    "duplicate_count",
    f"""WITH {DIRTY_ORDERS}
    SELECT 'o_orderkey' AS keys, count(*) AS row_count,
      count(DISTINCT o_orderkey) AS distinct_count,
      count(*) - count(DISTINCT o_orderkey) AS duplicate_rows FROM dirty
    UNION ALL
    SELECT 'all columns', (SELECT count(*) FROM dirty),
      (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)),
      (SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty))""",
)
def duplicate_count_query(spark, folder):
    dirty = dirty_orders(spark, folder)
    by_key = duplicate_count(dirty, ["o_orderkey"]).withColumn("keys", F.lit("o_orderkey"))
    by_row = duplicate_count(dirty).withColumn("keys", F.lit("all columns"))
    return by_key.unionByName(by_row)


def _cleaner(**settings):
    return TableCleaner(keys=["o_orderkey"], relative_error=0.0, **settings)


@query("clean_table", f"WITH {FILLED_ORDERS} SELECT * FROM clean")
def clean_table(spark, folder):
    return _cleaner().fit_transform(dirty_orders(spark, folder))


@query("clean_table_late", f"WITH {FILLED_ORDERS} SELECT * FROM clean")
def clean_table_late(spark, folder):
    """The same table, with modes from nominated values and only repeated keys shuffled."""
    return _cleaner(late_dedup=True, nominate_modes=True).fit_transform(dirty_orders(spark, folder))


@query(
    "cleaning_summary",
    f"""WITH {NORMAL_ORDERS},
    usable AS (SELECT * FROM normal WHERE {
        " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in CLEAN_COLUMNS)
    } <= 1)
    SELECT (SELECT count(*) FROM normal) AS row_count_before,
      count(DISTINCT o_orderkey) AS row_count_after,
      count(*) - count(DISTINCT o_orderkey) AS duplicate_rows_removed,
      (SELECT count(*) FROM normal) - count(*) AS sparse_rows_removed,
      'o_note' AS dropped_columns
    FROM usable""",
)
def cleaning_summary(spark, folder):
    dirty = dirty_orders(spark, folder)
    summary = _cleaner(drop_row_threshold=1).fit(dirty).summary(dirty)
    return summary.withColumn("dropped_columns", F.array_join("dropped_columns", ","))
