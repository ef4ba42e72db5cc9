"""Functions whose accepted semantics are not those of one Spark function.

String positions of the fluent surface count from 0; SQL text counts from 1
and never passes through here.
"""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Any) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def plain(x: Any) -> Any:
    """The Python value of an argument that must be one."""
    if isinstance(x, Column):
        raise TypeError("this argument must be a plain value, not a column")
    return x


def quoted(x: str) -> str:
    return "\\Q" + plain(x).replace("\\E", "\\E\\\\E\\Q") + "\\E"


# strings


def concat_null(*parts: Any) -> Column:
    """Null if any part is."""
    return F.concat(*map(col, parts))


def concat2(*parts: Any) -> Column:
    """Nulls count as empty."""
    return F.concat(*[F.coalesce(col(p), F.lit("")) for p in parts])


def concat_ws_blank(sep: str, *parts: Any) -> Column:
    return F.concat_ws(sep, *[F.coalesce(col(p), F.lit("")) for p in parts])


def position(needle: Any, text: Column, start: Any = 1) -> Column:
    """From 1; 0 if absent."""
    return F.call_function("locate", col(needle), text, col(start))


def index_of(text: Column, needle: Any, start: Any = 0) -> Column:
    """From 0; -1 if absent."""
    return position(needle, text, col(start) + 1) - 1


def substring0(text: Column, start: Any, length: Any = None) -> Column:
    """From position 0 on."""
    n = F.char_length(text) if length is None else col(length)
    return F.substring(text, col(start) + 1, n)


def trim_chars(text: Column, chars: str = " ", side: str = "BOTH") -> Column:
    trim = {"BOTH": F.trim, "LEADING": F.ltrim, "TRAILING": F.rtrim}[side.upper()]
    return trim(text, F.lit(plain(chars)))


def is_null_or_empty(text: Column) -> Column:
    return text.isNull() | (F.char_length(text) == 0)


def is_null_or_white_space(text: Column) -> Column:
    return text.isNull() | ~text.rlike(r"\S")


def first_char(text: Column) -> Column:
    return F.when(F.char_length(text) > 0, F.substring(text, 1, 1))


def last_char(text: Column) -> Column:
    return F.when(F.char_length(text) > 0, F.right(text, F.lit(1)))


def similar(text: Column, pattern: str) -> Column:
    from ..plans.dialect import _similar

    return text.rlike(_similar(f"'{plain(pattern)}'")[1:-1].replace("\\\\", "\\"))


# numbers


def greatest_null(*args: Any) -> Column:
    """Null if any argument is."""
    cs = [col(a) for a in args]
    missing = cs[0].isNull()
    for c in cs[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, F.greatest(*cs))


def least_null(*args: Any) -> Column:
    cs = [col(a) for a in args]
    missing = cs[0].isNull()
    for c in cs[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, F.least(*cs))


def truncate(x: Column, digits: int = 0) -> Column:
    """Towards zero."""
    unit = 10.0 ** plain(digits)
    cut = F.floor(F.abs(x) * unit) if digits else F.floor(F.abs(x))
    return F.signum(x) * cut / unit if digits else F.signum(x) * cut


def sign(x: Column) -> Column:
    return F.signum(x).cast("int")


def divide(a: Any, b: Any, integer: bool = True) -> Column:
    """Whole numbers are divided towards zero."""
    return F.call_function("div", col(a), col(b)) if integer else col(a) / col(b)


def shift_left(x: Column, n: int) -> Column:
    return F.shiftleft(x, plain(n))


def shift_right(x: Column, n: int) -> Column:
    return F.shiftright(x, plain(n))


# conditions and casts


def decode(x: Column, *pairs: Any) -> Column:
    """The value after the first equal key (null equals null), else the last argument if one is left."""
    default = col(pairs[-1]) if len(pairs) % 2 else F.lit(None)
    out = default
    for k, v in reversed(list(zip(pairs[0::2], pairs[1::2]))):
        out = F.when(x.eqNullSafe(col(k)), col(v)).otherwise(out)
    return out


def cast_not_null(x: Column, kind: str) -> Column:
    cast = x.cast(plain(kind))
    return F.when(cast.isNotNull(), cast).otherwise(F.raise_error(F.lit("null where none may be")))


def convert(x: Column, kind: str) -> Column:
    """Convert.To*: a boolean becomes 1 or 0."""
    return x.cast(plain(kind))


def intersection(x: Column) -> Column:
    """Of the arrays of a group: what all of them hold."""
    lists = F.collect_list(x)
    return F.aggregate(F.slice(lists, 2, F.greatest(F.size(lists) - 1, F.lit(0))), F.coalesce(F.try_element_at(lists, F.lit(1)), F.slice(F.flatten(lists), 1, 0)), lambda a, y: F.array_intersect(a, y))


def percentile_disc(x: Column | str, p: float) -> Column:
    """The smallest value whose cumulative share reaches ``p``."""
    of = f"`{x}`" if isinstance(x, str) else x._jc.toString()
    return F.expr(f"percentile_disc({float(plain(p))}D) WITHIN GROUP (ORDER BY {of})")


def single_value(x: Column) -> Column:
    """The value of a group of at most one row."""
    return F.when(F.count(F.lit(1)) <= 1, F.first(x)).otherwise(F.raise_error(F.lit("more than one value")))


# JSON


def json_path(path: str) -> str:
    """A path without its mode word."""
    return re.sub(r"^(?:strict|lax)\s+", "", plain(path).strip())


def json_value(document: Column, path: str, kind: str = "string") -> Column:
    got = F.get_json_object(document, json_path(path))
    return got if kind == "string" else got.cast(kind)


# date and time


def part(x: Column, name: str) -> Column:
    """A part of a date or time by its .NET name."""
    n = name.lower()
    if n == "dayofweek":
        return F.dayofweek(x) - 1
    if n == "dayofyear":
        return F.dayofyear(x)
    if n == "date":
        return F.to_date(x)
    if n in ("millisecond", "microsecond", "nanosecond"):
        micros = F.pmod(F.unix_micros(x.cast("timestamp")), F.lit(1_000_000))
        return {"millisecond": F.floor(micros / 1000), "microsecond": micros % 1000, "nanosecond": F.lit(0)}[n].cast("int")
    if n == "timeofday":
        return F.pmod(F.unix_micros(x.cast("timestamp")), F.lit(86_400_000_000))
    return F.date_part(F.lit(n), x).cast("int")


def day_number(x: Column) -> Column:
    """Days since 0001-01-01."""
    return F.datediff(x, F.lit("0001-01-01").cast("date"))


def time_between(t: Column, low: Column, high: Column) -> Column:
    """In [low, high), over midnight if high is before low; micros of the day."""
    return F.when(low <= high, (t >= low) & (t < high)).otherwise((t >= low) | (t < high))
