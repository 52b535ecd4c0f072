"""Schema drift: the columns and value types that arrived against the contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.contracts import EXPECTED_TYPES
from reelspark.operators.quality import source_columns


def _declared_type(kind: T.DataType) -> str | None:
    """Dtype family of a typed column; text columns are judged by their values."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int64"
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float64"
    if isinstance(kind, T.BooleanType):
        return "bool"
    if isinstance(kind, T.StringType):
        return None
    return "datetime64[ns]" if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else "object"


# Everything that a cast to double can read, tested first: a cast that fails costs some
# microseconds, a pattern that fails a fraction of one.
_NUMBER = (
    r"(?i)^[\\x00-\\x20]*[+-]?(?:(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:e[+-]?[0-9]+)?[fd]?"
    r"|0x[0-9a-f]*[.]?[0-9a-f]*p[+-]?[0-9]+[fd]?|nan|inf|infinity)[\\x00-\\x20]*$"
)

# One bit per kind of value: whole number 1, other number 2, truth value 4, text 8.
_KINDS = """coalesce(bit_or(CASE
    WHEN `{c}` RLIKE '^[ \\t]*[+-]?[0-9]+[ \\t]*$' THEN 1
    WHEN `{c}` RLIKE '{number}' AND nullif(try_cast(`{c}` AS DOUBLE), double('NaN')) IS NOT NULL THEN 2
    WHEN lower(`{c}`) IN ('true', 'false') THEN 4
    WHEN `{c}` IS NOT NULL THEN 8 END), 0)"""


def _inferred_type(column: str) -> Column:
    """What a reader would infer from the text values of a whole column: all whole
    numbers, all numbers (or numbers with gaps), all booleans, otherwise text. The
    kinds that occur are gathered as bits, one aggregate per column."""
    kinds = _KINDS.format(c=column, number=_NUMBER)
    complete = f"count(*) = count(`{column}`)"
    return F.expr(
        f"""CASE WHEN {kinds} = 0 THEN 'float64'
            WHEN {kinds} = 1 AND {complete} THEN 'int64'
            WHEN {kinds} = 4 AND {complete} THEN 'bool'
            WHEN {kinds} <= 3 THEN 'float64'
            ELSE 'object' END"""
    )


def column_types(df: DataFrame) -> DataFrame:
    """One row with the dtype family of every column, inferred in a single pass."""
    families = []
    for name in source_columns(df):
        declared = _declared_type(df.schema[name].dataType)
        family = _inferred_type(name) if declared is None else F.max(F.lit(declared))
        families.append(F.coalesce(family, F.lit(declared or "object")).alias(name))
    return df.agg(*families)


def compatible(expected: str, actual: str) -> str:
    """SQL condition: values of the ``actual`` dtype fit where ``expected`` is declared."""
    fits = [f"{actual} = '{expected}'"]
    if "int" in expected:
        fits.append(f"contains({actual}, 'int')")
    if "float" in expected:
        fits.append(f"contains({actual}, 'float') OR contains({actual}, 'int')")
    if expected == "object":
        fits.append(f"contains({actual}, 'str')")
    return " OR ".join(fits)


def _entry(column: str, kind: str, expected: str, actual: str, warning: str) -> str:
    """SQL struct of one finding; the last three arguments are SQL expressions."""
    return (
        f"named_struct('column_name', '{column}', 'kind', '{kind}', 'expected', {expected},"
        f" 'actual', {actual}, 'warning', {warning})"
    )


_NOTHING = "CAST(NULL AS STRING)"


def check_drift(df: DataFrame, dataset: str) -> DataFrame:
    """Drift report, one row per finding, with the severity of the dataset."""
    name = F.lit(dataset).alias("dataset")
    contract = EXPECTED_TYPES.get(dataset)
    if contract is None:
        warning = f"\"No baseline schema registered for '{dataset}'.\""
        entry = _entry("", "unregistered", _NOTHING, _NOTHING, warning)
        return df.agg(F.expr(f"array({entry})").alias("_e")).select(
            name, F.inline("_e"), F.lit("None").alias("severity")
        )
    arrived = source_columns(df)
    added = sorted(set(arrived) - set(contract))
    missing = sorted(set(contract) - set(arrived))
    common = sorted(set(contract) & set(arrived))
    entries = [
        _entry(c, "added", _NOTHING, f"`{c}`",
               f"\"WARNING: New column detected: '{c}' (Potential Schema Expansion)\"")
        for c in added
    ]
    entries += [
        _entry(c, "missing", f"'{contract[c]}'", _NOTHING, f"\"CRITICAL: Missing expected column: '{c}'\"")
        for c in missing
    ]
    for c in common:
        warning = f"concat(\"WARNING: Column '{c}' expected {contract[c]}, got \", `{c}`)"
        entry = _entry(c, "type_mismatch", f"'{contract[c]}'", f"`{c}`", warning)
        entries.append(f"CASE WHEN NOT ({compatible(contract[c], f'`{c}`')}) THEN {entry} END")
    severity = "'High'" if missing else (
        f"CASE WHEN exists(_e, e -> e.kind = 'type_mismatch') THEN 'Medium' ELSE '{'Low' if added else 'None'}' END"
    )
    found = F.expr(f"array_compact(array({', '.join(entries)}))").alias("_e")
    return (
        column_types(df)
        .select(found)
        .withColumn("severity", F.expr(severity))
        .select(name, F.inline_outer("_e"), "severity")
        .where("column_name IS NOT NULL")
    )


def check_all(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [check_drift(df, name) for name, df in frames.items()])
