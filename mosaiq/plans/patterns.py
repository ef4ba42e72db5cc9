"""MATCH_RECOGNIZE in SQL text: each clause becomes a view of what the fluent matcher gives.

``FROM t MATCH_RECOGNIZE (PARTITION BY ... ORDER BY ... MEASURES ... ONE ROW |
ALL ROWS PER MATCH AFTER MATCH SKIP ... PATTERN (...) DEFINE ...)``. Conditions
see their row and, by PREV and NEXT, its neighbours. Measures are expressions
over FIRST, LAST, COUNT, SUM, AVG, MIN and MAX of a symbol's rows (``X.c``) or
of all, CLASSIFIER and MATCH_NUMBER; RUNNING, the default of ALL ROWS, sees the
match up to the row, FINAL, the default of ONE ROW, all of it.
"""

from __future__ import annotations

import re
import uuid
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.matching import match_recognize, parse, symbols
from .dialect import Sql, join

if TYPE_CHECKING:
    from ..session import Engine

_CLAUSES = ("PARTITION", "ORDER", "MEASURES", "ONE", "ALL", "AFTER", "PATTERN", "DEFINE")
_AGGREGATES = frozenset("COUNT SUM AVG MIN MAX".split())


def expand(engine: Engine, text: str) -> str:
    """``text`` with a view's name for each table that is matched."""
    if "MATCH_RECOGNIZE" not in text.upper():
        return text
    s = Sql(text)
    i = 0
    while i < len(s.tokens):
        if s.is_word(i, "MATCH_RECOGNIZE") and s.is_op(i + 1, "("):
            begin, end = s.operand_before(i), s.close(i + 1)
            source = engine.spark.sql(engine.translated(f"SELECT * FROM {join(s.tokens[begin:i])}"))
            inside = Sql(join(s.tokens[i + 2 : end]))
            view = f"matched_{uuid.uuid4().hex}"
            _matched(engine, source, inside).createOrReplaceTempView(view)
            s.put(begin, end + 1, view)
            i = begin
        i += 1
    return join(s.tokens)


def _clauses(s: Sql) -> dict[str, tuple[int, int]]:
    """Where each clause begins and ends, by its first word."""
    begins, depth = [], 0
    for k in range(len(s.tokens)):
        if not depth and s.is_word(k, *_CLAUSES) and not (s.is_word(k, "ALL") and not s.is_word(k + 1, "ROWS")):
            begins.append(k)
        depth += s.is_op(k, "(", "[") - s.is_op(k, ")", "]")
    return {s.tokens[a].upper(): (a, b) for a, b in zip(begins, [*begins[1:], len(s.tokens)])}


def _listed(s: Sql, a: int, b: int) -> list[list[str]]:
    """Tokens from ``a`` to ``b`` by top-level commas."""
    out, depth = [[]], 0
    for k in range(a, b):
        depth += s.is_op(k, "(", "[") - s.is_op(k, ")", "]")
        if not depth and s.is_op(k, ","):
            out.append([])
        else:
            out[-1].append(s.tokens[k])
    return [x for x in out if x]


def _matched(engine: Engine, source: DataFrame, s: Sql) -> DataFrame:
    at = _clauses(s)
    if "PATTERN" not in at or "ORDER" not in at:
        raise ValueError("MATCH_RECOGNIZE needs ORDER BY and PATTERN")
    names = lambda clause: [join(t).strip('"`') for t in _listed(s, at[clause][0] + 2, at[clause][1])] if clause in at else []
    partition, order = names("PARTITION"), names("ORDER")
    a, b = at["PATTERN"]
    pattern = " ".join(s.tokens[a + 2 : b - 1])
    pattern = re.sub(r"\{\s*(\d*)\s*(,?)\s*(\d*)\s*\}", r"{\1\2\3}", pattern).replace("{ -", "{-").replace("- }", "-}")
    known = symbols(parse(pattern))
    over = f"OVER ({'PARTITION BY ' + ', '.join(partition) if partition else ''} ORDER BY {', '.join(order)})"
    define = {}
    if "DEFINE" in at:
        for t in _listed(s, at["DEFINE"][0] + 1, at["DEFINE"][1]):
            define[t[0]] = F.expr(engine.translated(_condition(Sql(join(t[2:])), t[0], known, over)))
    after = "past last row"
    if "AFTER" in at:
        after = " ".join(s.tokens[at["AFTER"][0] + 3 : at["AFTER"][1]])
        after = after.lower() if after.split()[-1].lower() == "row" else f"to {after.split()[1].lower()} {after.split()[2]}"
    every = "ALL" in at
    rows = match_recognize(source, partition=partition, order=order, pattern=pattern, define=define, after=after, all_rows=True)
    measures = []
    for t in _listed(s, at["MEASURES"][0] + 1, at["MEASURES"][1]) if "MEASURES" in at else []:
        if len(t) < 3 or t[-2].upper() != "AS":
            raise ValueError(f"a measure needs a name: {join(t)}")
        measures.append(f"{engine.translated(_measure(Sql(join(t[:-2])), known, partition, order, every))} AS {t[-1]}")
    if every:
        kept = ", ".join(f"`{c}`" for c in source.columns)
        return rows.selectExpr(*[x for x in (kept.split(", ") + measures)])
    group = ", ".join([*partition, "match_number"])
    next_one = f"lead(1) OVER (PARTITION BY {group} ORDER BY {', '.join(order)}) AS __next"
    return rows.selectExpr(*partition, *measures, next_one).where("__next IS NULL").drop("__next")


def _condition(s: Sql, own: str, known: list[str], over: str) -> str:
    """A DEFINE condition over one row and its neighbours."""
    i = 0
    while i < len(s.tokens):
        if s.is_word(i, *(k.upper() for k in known)) and s.is_op(i + 1, "."):
            if s.tokens[i].upper() != own.upper():
                raise ValueError(f"the condition of {own} looks at rows of {s.tokens[i]}")
            s.put(i, i + 2, "")
        elif s.is_word(i, "PREV", "NEXT") and s.is_op(i + 1, "("):
            args, end = s.arguments(i + 1)
            args = [re.sub(rf"(?i)\b{re.escape(own)}\.", "", x) for x in args]
            call = f"{'lag' if s.tokens[i].upper() == 'PREV' else 'lead'}({', '.join(args)}) {over}"
            s.put(i, end + 1, call)
            i += len(Sql(call).tokens)
            continue
        elif s.is_word(i, "FIRST", "LAST", "CLASSIFIER") and s.is_op(i + 1, "("):
            raise ValueError(f"{s.tokens[i]} in a condition is not supported")
        i += 1
    return join(s.tokens)


def _measure(s: Sql, known: list[str], partition: list[str], order: list[str], every: bool) -> str:
    """A measure as window functions over the rows of a match."""
    upper = {k.upper(): k for k in known}
    by = f"PARTITION BY {', '.join([*partition, 'match_number'])} ORDER BY {', '.join(order)}"

    def frame(final: bool) -> str:
        return f"OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND {'UNBOUNDED FOLLOWING' if final else 'CURRENT ROW'})"

    def of(arg: str) -> str:
        """A symbol's values, null on other rows; ``X.*`` is 1."""
        t = Sql(arg)
        if t.is_word(0, *upper) and t.is_op(1, "."):
            value = "1" if t.is_op(2, "*") else join(t.tokens[2:])
            return f"CASE WHEN classifier = '{upper[t.tokens[0].upper()]}' THEN {value} END"
        return arg

    i = 0
    while i < len(s.tokens):
        final, start = not every, i
        if s.is_word(i, "FINAL", "RUNNING"):
            final, i = s.is_word(i, "FINAL"), i + 1
        new = None
        if s.is_word(i, "CLASSIFIER", "MATCH_NUMBER") and s.is_op(i + 1, "("):
            end = s.close(i + 1)
            new = "match_number" if s.is_word(i, "MATCH_NUMBER") else f"last(classifier) {frame(final)}"
        elif s.is_word(i, "FIRST", "LAST") and s.is_op(i + 1, "("):
            args, end = s.arguments(i + 1)
            new = f"{s.tokens[i].lower()}({of(args[0])}, true) {frame(final)}"
        elif s.is_word(i, *_AGGREGATES) and s.is_op(i + 1, "("):
            args, end = s.arguments(i + 1)
            new = f"{s.tokens[i].lower()}({of(args[0])}) {frame(final)}"
        elif s.is_word(i, *upper) and s.is_op(i + 1, "."):
            end = i + 2
            new = f"last({of(join(s.tokens[i : i + 3]))}, true) {frame(final)}"
        if new is None:
            i = start + 1
            continue
        s.put(start, end + 1, new)
        i = start + len(Sql(new).tokens)
    return join(s.tokens)
