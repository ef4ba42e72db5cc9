"""Scalar and aggregate functions by their SQL names, as Column builders.

Most names of the accepted dialect are, in lower case, names of Spark's own
functions; ``EXCEPTIONS`` lists the others, ``COMPOSED`` those that are more
than one function. A registry starts from these and takes further ones, or
replacements, from its users.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import compat

Builder = Callable[..., Column]

#: Names whose function is called otherwise in Spark.
EXCEPTIONS = {
    "CHARACTER_LENGTH": "char_length",
    "CEILING": "ceil",
    "POW": "power",
    "LN": "ln",
    "ITEM": "element_at",
    "ARRAY_LENGTH": "size",
    "ARRAY_CONCAT": "concat",
    "ARRAY_REVERSE": "reverse",
    "ARRAY_SLICE": "slice",
    "ARRAY_TO_STRING": "array_join",
    "ARRAY_AGG": "collect_list",
    "ARG_MAX": "max_by",
    "ARG_MIN": "min_by",
    "ANY_VALUE": "any_value",
    "COLLECT": "collect_list",
    "CONCAT_WS_SPARK": "concat_ws",
    "CONCAT_WS_POSTGRESQL": "concat_ws",
    "COUNTIF": "count_if",
    "GREATEST_PG": "greatest",
    "GROUP_CONCAT": "listagg",
    "LEAST_PG": "least",
    "MAP_FROM_ARRAYS": "map_from_arrays",
    "REVERSE_SPARK": "reverse",
    "SOUNDEX_SPARK": "soundex",
    "STARTS_WITH": "startswith",
    "ENDS_WITH": "endswith",
    "CONTAINS_SUBSTR": "contains",
    "SUBSTR_BIG_QUERY": "substr",
    "SUBSTR_MYSQL": "substr",
    "SUBSTR_ORACLE": "substr",
    "SUBSTR_POSTGRESQL": "substr",
    "TIMESTAMP_ADD": "timestamp_add",
    "TIMESTAMP_DIFF": "timestamp_diff",
    "UNNEST": "explode",
    "ROW": "struct",
    "NEW_SPECIFICATION": "struct",
    "MAP_VALUE_CONSTRUCTOR": "create_map",
    "ARRAY_VALUE_CONSTRUCTOR": "array",
    "MULTISET_VALUE_CONSTRUCTOR": "array",
    "MULTISET_QUERY_CONSTRUCTOR": "collect_list",
    "ARRAY_QUERY_CONSTRUCTOR": "collect_list",
    "TUMBLE": "window",
    "HOP": "window",
    "SESSION": "session_window",
    "SIGN": "signum",
}
#: Names that are compositions, in :mod:`compat`.
COMPOSED = {
    "CONCAT2": compat.concat2,
    "CONCAT_WITH_NULL": compat.concat2,
    "||": compat.concat_null,
    "CONCAT_WS_MSSQL": compat.concat_ws_blank,
    "GREATEST": compat.greatest_null,
    "LEAST": compat.least_null,
    "TRUNCATE": compat.truncate,
    "SIGN": compat.sign,
    "DIVIDE": compat.divide,
    "BITAND": lambda a, b: a.bitwiseAND(b),
    "BITOR": lambda a, b: a.bitwiseOR(b),
    "BITXOR": lambda a, b: a.bitwiseXOR(b),
    "BITNOT": lambda a: F.bitwise_not(a),
    "XOR": lambda a, b: a != b,
    "SHIFT_LEFT": compat.shift_left,
    "SHIFT_RIGHT": compat.shift_right,
    "POSITION": compat.position,
    "INDEX_OF": compat.index_of,
    "SUBSTRING0": compat.substring0,
    "TRIM_CHARS": compat.trim_chars,
    "IS_NULL_OR_EMPTY": compat.is_null_or_empty,
    "IS_NULL_OR_WHITE_SPACE": compat.is_null_or_white_space,
    "FIRST_CHAR": compat.first_char,
    "LAST_CHAR": compat.last_char,
    "IF": lambda c, a, b: F.when(c, a).otherwise(b),
    "NVL": lambda a, b: F.coalesce(a, b),
    "NVL2": lambda a, b, c: F.when(a.isNotNull(), b).otherwise(c),
    "DECODE": compat.decode,
    "CAST_NOT_NULL": compat.cast_not_null,
    "SAFE_CAST": lambda a, kind: a.try_cast(compat.plain(kind)),
    "SUM0": lambda a: F.coalesce(F.sum(a), F.lit(0)),
    "ARRAY_CONCAT_AGG": lambda a: F.flatten(F.collect_list(a)),
    "FUSION": lambda a: F.flatten(F.collect_list(a)),
    "INTERSECTION": compat.intersection,
    "JSON_ARRAYAGG": lambda a: F.to_json(F.collect_list(a)),
    "JSON_OBJECTAGG": lambda k, v: F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v))))),
    "JSON_VALUE": compat.json_value,
    "JSON_QUERY": compat.json_value,
    "IS_DISTINCT_FROM": lambda a, b: ~a.eqNullSafe(b),
    "IS_NOT_DISTINCT_FROM": lambda a, b: a.eqNullSafe(b),
    "IS_TRUE": lambda a: F.coalesce(a, F.lit(False)),
    "IS_NOT_TRUE": lambda a: ~F.coalesce(a, F.lit(False)),
    "IS_FALSE": lambda a: F.coalesce(~a, F.lit(False)),
    "IS_NOT_FALSE": lambda a: ~F.coalesce(~a, F.lit(False)),
    "IS_UNKNOWN": lambda a: a.isNull(),
    "SIMILAR": compat.similar,
    "POSIX_REGEX_CASE_SENSITIVE": lambda a, p: a.rlike(compat.plain(p)),
    "POSIX_REGEX_CASE_INSENSITIVE": lambda a, p: a.rlike("(?i)" + compat.plain(p)),
    "OVERLAPS": lambda s1, e1, s2, e2: (s1 < e2) & (s2 < e1),
    "PRECEDES": lambda s1, e1, s2, e2: e1 <= s2,
    "IMMEDIATELY_PRECEDES": lambda s1, e1, s2, e2: e1 == s2,
    "SUCCEEDS": lambda s1, e1, s2, e2: s1 >= e2,
    "IMMEDIATELY_SUCCEEDS": lambda s1, e1, s2, e2: s1 == e2,
    "PERIOD_EQUALS": lambda s1, e1, s2, e2: (s1 == s2) & (e1 == e2),
    "PERIOD_CONTAINS": lambda s1, e1, s2, e2: (s1 <= s2) & (e1 >= e2),
    "CONVERT": lambda a, charset: F.decode(F.encode(a, compat.plain(charset)), compat.plain(charset)),
    "STRING_TO_ARRAY": lambda a, sep: F.split(a, compat.quoted(sep)),
    "DOT": lambda a, name: a.getField(compat.plain(name)),
    "HAS_FLAG": lambda a, f: a.bitwiseAND(f) == f,
    "TO_STRING": lambda a: a.cast("string"),
    "TIME_ADD": lambda t, i: t + i,
    "TIME_SUB": lambda t, i: t - i,
    "TIMESTAMP_SUB": lambda t, i: t - i,
    "CONVERT_ORACLE": lambda a, charset: F.decode(F.encode(a, compat.plain(charset)), compat.plain(charset)),
    "IN": lambda a, *values: a.isin(*values),
    "NOT_IN": lambda a, *values: ~a.isin(*values),
    "DRUID_IN": lambda a, *values: a.isin(*values),
    "DRUID_NOT_IN": lambda a, *values: ~a.isin(*values),
    "SOME": lambda a, test: F.exists(a, test),
    "ALL": lambda a, test: F.forall(a, test),
    "PREV": lambda a, n=1: F.lag(a, n),
    "NEXT": lambda a, n=1: F.lead(a, n),
    "INTERVAL": lambda days=0, hours=0, minutes=0, seconds=0: F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(seconds)),
    "LITERAL_AGG": lambda value: compat.col(value),
    "LITERAL_CHAIN": compat.concat_null,
    "REINTERPRET": lambda a, kind: a.cast(compat.plain(kind)),
    "MAP_QUERY_CONSTRUCTOR": lambda k, v: F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v)))),
    "PERCENTILE_CONT": lambda a, p: F.percentile(a, p),
    "PERCENTILE_DISC": compat.percentile_disc,
    "SINGLE_VALUE": compat.single_value,
    "JSON_TYPE": lambda a: F.schema_of_variant(F.parse_json(a)),
    "JSON_VALUE_EXPRESSION": lambda a: F.parse_json(a),
    "TUMBLE_START": lambda ts, size: F.window(ts, size)["start"],
    "TUMBLE_END": lambda ts, size: F.window(ts, size)["end"],
    "HOP_START": lambda ts, size, slide: F.window(ts, size, slide)["start"],
    "HOP_END": lambda ts, size, slide: F.window(ts, size, slide)["end"],
    "SESSION_START": lambda w: w["start"],
    "SESSION_END": lambda w: w["end"],
    "EXTRACT": lambda part, a: compat.part(a, part),
    "UNIX_MILLIS": lambda t: F.unix_millis(t.cast("timestamp")),
}


class Registry:
    """Builders by name, without regard to case."""

    def __init__(self) -> None:
        self._own: dict[str, Builder] = {}

    def register(self, name: str, builder: Builder) -> None:
        """Add a function, or replace one of this name."""
        self._own[name.upper()] = builder

    def find(self, name: str) -> Builder:
        upper = name.upper()
        for where in (self._own, COMPOSED):
            if upper in where:
                return where[upper]
        spark = EXCEPTIONS.get(upper, upper.lower())
        fn = getattr(F, spark, None)
        if fn is None:
            return lambda *args: F.call_function(spark, *args)
        return fn

    def __contains__(self, name: str) -> bool:
        upper = name.upper()
        return upper in self._own or upper in COMPOSED or hasattr(F, EXCEPTIONS.get(upper, upper.lower()))

    def call(self, name: str, *args: Any) -> Column:
        return self.find(name)(*args)

    def __getattr__(self, name: str) -> Builder:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.find(name)
