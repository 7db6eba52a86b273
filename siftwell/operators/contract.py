"""Check a table against an expected schema."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import FieldLookup, sql_name, sql_text

ISSUE = (
    "struct<kind:string,column_name:string,expected:string,actual:string,"
    "null_count:bigint,message:string>"
)


@dataclass(frozen=True)
class Contract:
    """Expected columns (name to type text) and, per column, whether nulls are allowed."""

    columns: Mapping[str, str] = field(default_factory=dict)
    nullable: Mapping[str, bool] = field(default_factory=dict)

    @staticmethod
    def of(spec: Contract | T.StructType | Mapping | None) -> Contract:
        """From a contract, a ``StructType`` or ``{"columns": {...}, "nullable": {...}}``."""
        if isinstance(spec, Contract):
            return spec
        if isinstance(spec, T.StructType):
            return Contract(
                {f.name: f.dataType.simpleString() for f in spec.fields},
                {f.name: f.nullable for f in spec.fields},
            )
        spec = spec or {}
        return Contract(dict(spec.get("columns") or {}), dict(spec.get("nullable") or {}))


def type_matches(expected: str, actual: T.DataType) -> bool:
    """Whether a type text (``LongType``, ``LongType()`` or DDL such as ``bigint``) names a type.

    A name without parameters (``DecimalType``, ``decimal``, ``ArrayType``) accepts any.
    """
    wanted = expected.replace(" ", "").lower()
    cls = type(actual).__name__.lower()
    if wanted in (cls, cls + "()", cls.removesuffix("type")):
        return True
    if wanted in (str(actual).replace(" ", "").lower(), actual.simpleString().lower()):
        return True
    try:
        parsed = T.StructType.fromDDL(f"c {expected}").fields[0].dataType
    except PySparkException:
        return False
    return parsed.simpleString() == actual.simpleString()


def _issue(kind: str, name: str, message: str, expected=None, actual=None, nulls="NULL") -> str:
    """SQL of one issue; ``message`` and ``nulls`` are SQL themselves."""
    return (
        f"struct({sql_text(kind)} AS kind, {sql_text(name)} AS column_name, "
        f"{sql_text(expected)} AS expected, {sql_text(actual)} AS actual, "
        f"CAST({nulls} AS BIGINT) AS null_count, {message} AS message)"
    )


def validate(
    df: DataFrame, contract, null_counts: Mapping[str, int] | None = None
) -> DataFrame:
    """``schema_issues`` report: one row per violation, numbered by ``seq``.

    Missing columns and type mismatches come first in contract order, then nulls found in
    columns that must have none, then unexpected columns in table order. Types are compared on
    the schema alone; the null checks share one aggregate, or use ``null_counts`` if given.
    """
    contract = Contract.of(contract)
    lookup = FieldLookup(df)

    # The message formats.
    before, rules, after = [], [], []
    for name, expected in contract.columns.items():
        field = lookup(name)
        if field is None:
            message = f"MISSING column: '{name}' (expected type={expected})"
            before.append(_issue("missing", name, sql_text(message), expected))
        elif not type_matches(expected, field.dataType):
            actual = str(field.dataType)
            message = f"TYPE MISMATCH '{name}': expected={expected}, got={actual}"
            before.append(_issue("type_mismatch", name, sql_text(message), expected, actual))
    for name, allowed in contract.nullable.items():
        field = lookup(name)
        if field is not None and not allowed:
            actual_name = field.name
            if null_counts is None:
                nulls = f"count(*) - count({sql_name(actual_name)})"
            else:
                nulls = str(null_counts[actual_name])
            head = sql_text(f"NON-NULLABLE VIOLATION '{name}': ")
            message = f"concat({head}, format_number({nulls}, 0), ' null values found')"
            rules.append(_issue("null_violation", name, message, nulls=nulls))
    if contract.columns:
        known = {field.name for field in map(lookup, contract.columns) if field is not None}
        for name in df.columns:
            if name not in known:
                message = f"UNEXPECTED column: '{name}' (not in expected schema)"
                after.append(_issue("unexpected", name, sql_text(message)))

    as_array = lambda issues: f"CAST(array({', '.join(issues)}) AS array<{ISSUE}>)"
    broken = f"filter({as_array(rules)}, issue -> issue.null_count > 0)"
    issues = F.expr(f"concat({as_array(before)}, {broken}, {as_array(after)})").alias("issues")
    scan = rules and null_counts is None
    found = df.agg(issues) if scan else df.sparkSession.range(1).select(issues)
    return found.select(F.posexplode("issues").alias("pos", "issue")).select(
        (F.col("pos") + 1).alias("seq"), "issue.*"
    )
