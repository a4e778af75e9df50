"""Predicates and cleaners over single column values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for "no value", compared in upper case.
PLACEHOLDERS = ("NULL", "UNKNOWN", "", "NA", "N/A")

# Fixed value: the characters a number text may keep, as a negated class.
NOT_NUMERIC = r"[^\d.E-]"


def improper(column: str, dtype: T.DataType, min_length: int = 1) -> Column:
    """True where a value is missing, shorter than ``min_length`` or a placeholder.

    Values are not trimmed, so ``' '`` is proper at length 1. Never NULL.
    Arrays and maps are improper when missing or empty; structs have no text
    form to judge and are refused.
    """
    return F.expr(improper_sql(column, dtype, min_length))


def improper_sql(column: str, dtype: T.DataType, min_length: int = 1) -> str:
    """The improper-value test as an expression.

    Upper-casing never shortens a text, so a text can only equal a placeholder
    that is at least as long: texts longer than every placeholder are not
    upper-cased, and placeholders under ``min_length`` need no test of their own.
    """
    name = identifier(column)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return f"({name} IS NULL OR size({name}) = 0)"
    if isinstance(dtype, (T.StructType, T.VariantType)):
        raise ValueError(f"cannot judge values of type {dtype.simpleString()}")
    text = name if isinstance(dtype, T.StringType) else f"CAST({name} AS string)"
    length = int(min_length)
    test = f"{name} IS NULL OR length({text}) < {length}"
    listed = [p for p in PLACEHOLDERS if len(p) >= length]
    if listed:
        longest = max(map(len, listed))
        options = ", ".join(quoted(p) for p in listed)
        test += f" OR (length({text}) <= {longest} AND upper({text}) IN ({options}))"
    return f"({test})"


def identifier(column: str) -> str:
    """A column name as SQL text, whatever characters it holds."""
    return "`" + column.replace("`", "``") + "`"


def improper_text(column: str, min_length: int = 1) -> str:
    """The same test as SQL text, for the query log."""
    listed = ", ".join(quoted(p) for p in PLACEHOLDERS)
    return f"({column} IS NULL OR length({column}) < {min_length} OR upper({column}) IN ({listed}))"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def clean_int(text: Column) -> Column:
    """Number text to int after dropping stray characters; nothing left is 0, no number is NULL."""
    kept = F.regexp_replace(text, NOT_NUMERIC, "")
    return F.when(kept == "", F.lit(0)).otherwise(kept.try_cast("int"))


def clean_decimal_text(text: Column) -> Column:
    """Number text to two-decimal text after dropping stray characters; nothing left is ``"0"``."""
    kept = F.regexp_replace(text, NOT_NUMERIC, "")
    number = kept.try_cast("double")
    return F.when(kept == "", F.lit("0")).when(
        number.isNotNull(), F.format_string("%1.2f", number)
    )
