"""Logical SQL types and what they are in Spark."""

from __future__ import annotations

import datetime as dt
import decimal
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Logical:
    """``spark``: type text; ``low``/``high``: bounds where Spark's type is wider."""

    spark: str
    low: int | None = None
    high: int | None = None


TYPES: dict[str, Logical] = {
    "BOOLEAN": Logical("boolean"),
    "TINYINT": Logical("tinyint"),
    "UTINYINT": Logical("smallint", 0, 2**8 - 1),
    "SMALLINT": Logical("smallint"),
    "USMALLINT": Logical("int", 0, 2**16 - 1),
    "INTEGER": Logical("int"),
    "UINTEGER": Logical("bigint", 0, 2**32 - 1),
    "BIGINT": Logical("bigint"),
    "UBIGINT": Logical("decimal(20,0)", 0, 2**64 - 1),
    "REAL": Logical("float"),
    "FLOAT": Logical("float"),
    "DOUBLE": Logical("double"),
    "DECIMAL": Logical("decimal(19,4)"),
    "CHAR": Logical("string"),
    "VARCHAR": Logical("string"),
    "VARBINARY": Logical("binary"),
    "DATE": Logical("date"),
    "TIME": Logical("time(6)"),
    "TIMESTAMP": Logical("timestamp_ntz"),
    "TIMESTAMP_TZ": Logical("timestamp"),
    "INTERVAL_DAY_TIME": Logical("interval day to second"),
    "INTERVAL_YEAR_MONTH": Logical("interval year to month"),
    "UUID": Logical("string"),
    "JSON": Logical("string"),
}
ALIASES = {
    "INT": "INTEGER",
    "STRING": "VARCHAR",
    "BOOL": "BOOLEAN",
    "BYTE": "TINYINT",
    "SHORT": "SMALLINT",
    "LONG": "BIGINT",
    "NUMERIC": "DECIMAL",
    "BINARY": "VARBINARY",
    "TINYINT UNSIGNED": "UTINYINT",
    "SMALLINT UNSIGNED": "USMALLINT",
    "INTEGER UNSIGNED": "UINTEGER",
    "BIGINT UNSIGNED": "UBIGINT",
    "TIMESTAMP WITH TIME ZONE": "TIMESTAMP_TZ",
}
#: Numeric types in the order in which operands are widened.
RANK = ("TINYINT", "UTINYINT", "SMALLINT", "USMALLINT", "INTEGER", "UINTEGER", "BIGINT", "UBIGINT", "REAL", "DOUBLE", "DECIMAL")


def logical(name: str) -> tuple[str, Logical]:
    """A type by name, such as ``varchar(20)`` or ``DECIMAL(12, 2)``; unknown names are VARCHAR."""
    text = " ".join(name.upper().split())
    head, _, rest = text.partition("(")
    head = head.strip()
    head = ALIASES.get(text, ALIASES.get(head, head))
    kind = TYPES.get(head)
    if kind is None:
        return "VARCHAR", TYPES["VARCHAR"]
    if head == "DECIMAL" and rest:
        return head, Logical(f"decimal({rest.rstrip(')').replace(' ', '')})")
    return head, kind


def spark_type(name: str) -> str:
    return logical(name)[1].spark


def widen(*names: str) -> str:
    """The type to which numeric operands are brought."""
    return max((logical(n)[0] for n in names), key=RANK.index)


def checked(col: Column, name: str) -> Column:
    """``col`` as the type ``name``; values that the type cannot hold raise an error."""
    _, kind = logical(name)
    cast = col.cast(kind.spark)
    if kind.low is None:
        return cast
    fits = col.isNull() | ((cast >= F.lit(kind.low)) & (cast <= F.lit(decimal.Decimal(kind.high))))
    return F.when(fits, cast).otherwise(F.raise_error(F.concat(F.lit(f"value out of range of {name}: "), col.cast("string"))))


def milliseconds(col: Column) -> Column:
    """A timestamp cut to the precision of stored values."""
    return F.date_trunc("millisecond", col).cast("timestamp_ntz")


def literal(value: Any) -> str:
    """SQL text of a Python value."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D" if value == value and abs(value) != float("inf") else f"CAST('{value}' AS DOUBLE)"
    if isinstance(value, decimal.Decimal):
        return f"{value:f}BD"
    if isinstance(value, bytes):
        return f"X'{value.hex().upper()}'"
    if isinstance(value, dt.datetime):
        if value.tzinfo:
            return f"TIMESTAMP '{value.astimezone(dt.timezone.utc):%Y-%m-%d %H:%M:%S.%f}+00:00'"
        return f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, dt.time):
        return f"TIME '{value:%H:%M:%S.%f}'"
    if isinstance(value, dt.timedelta):
        return f"INTERVAL '{value.total_seconds():.6f}' SECOND"
    if isinstance(value, uuid.UUID):
        return f"'{value}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
