"""CSV scan as text and typed casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import by_field, col, one_row_per_column, sql_name, sql_text


def read_text_csv(
    spark: SparkSession,
    path: str | list[str],
    corrupt_column: str | None = None,
    columns: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Scan CSV files, every column as string. Empty fields are null.

    Names come from the header, or from ``columns`` where files have none. Files stay splittable:
    quoted line breaks need ``multiLine=True`` in ``options``. ``corrupt_column`` names a further
    column with the whole line of records that have too few or too many fields, null for all others;
    the fields of such a record are kept as far as they go.
    """
    settings = {"header": columns is None, "inferSchema": False, **options}
    reader = spark.read.options(**settings)
    if columns is None and corrupt_column is None:
        return reader.csv(path)
    names = reader.csv(path).columns if columns is None else columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if corrupt_column is not None:
        schema = schema.add(corrupt_column, T.StringType())
        # A scan that skips fields could not tell how many there are.
        reader = reader.options(columnNameOfCorruptRecord=corrupt_column, columnPruning=False)
    return reader.schema(schema).csv(path)


def _failed(name: str, dtype: str | T.DataType) -> Column:
    return col(name).isNotNull() & col(name).try_cast(dtype).isNull()


def cast_columns(
    df: DataFrame, types: Mapping[str, str | T.DataType], seen: Observation | None = None
) -> DataFrame:
    """Cast the given columns in one projection; unreadable values become null.

    Columns the table lacks are skipped. ``seen`` observes, in the scan that the first action on the
    result makes, how many values of each cast column were unreadable.
    """
    present = by_field(df, dict(types))
    if seen is not None and present:
        df = df.observe(seen, *[F.count_if(_failed(name, t)).alias(name) for name, t in present.items()])
    return df.withColumns({name: col(name).try_cast(t) for name, t in present.items()})


def cast_failures(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """One row per cast column: its non-null values, those that the cast cannot read, and the least.

    All columns share one aggregate, which is combined before its shuffle.
    """
    present = by_field(df, dict(types))
    records = []
    for name, dtype in present.items():
        kind = dtype if isinstance(dtype, str) else dtype.simpleString()
        value = sql_name(name)
        failed = f"{value} IS NOT NULL AND try_cast({value} AS {kind}) IS NULL"
        records.append(
            f"struct({sql_text(name)} AS column_name, {sql_text(kind)} AS data_type, "
            f"count({value}) AS value_count, count_if({failed}) AS failed_count, "
            f"CAST(min(CASE WHEN {failed} THEN {value} END) AS STRING) AS least_failed)"
        )
    if not records:
        schema = "column_name string, data_type string, value_count bigint, failed_count bigint, least_failed string"
        return df.sparkSession.createDataFrame([], schema)
    return one_row_per_column(df, records)
