"""Row pattern matching: patterns over ordered rows of a partition.

A pattern has symbols, concatenation, ``|``, groups, the quantifiers ``* + ?
{n,m}`` (reluctant with ``?`` behind), ``PERMUTE(A, B)`` and exclusion
``{- A -}``. Symbols are defined by conditions over the row and its
neighbours (``lag`` and ``lead`` in the partition's order), evaluated by Spark
before matching; a symbol without a condition is always true. The rows are
shuffled once.

Two kinds of patterns are matched by Spark's window functions alone: those of
a few rows where the next match may begin at the next row (``LEAD`` sees
whether one begins at a row), and runs of one symbol (``A{n,}``), past which
matching goes on. Any other pattern is matched in Python, over booleans, in
the tasks and the order in which Spark has sorted the partitions.

There, a partition falls into stretches at rows where no symbol holds, as no match
goes across them. A task holds a batch of rows and the stretch that is not
ended yet, however many partitions it has; short stretches of the same
booleans are matched once.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"\s*(\{-|-\}|\{\s*\d*\s*,?\s*\d*\s*\}|PERMUTE|[A-Za-z_]\w*|[()|*+?,])", re.I)


@dataclass(frozen=True)
class Part:
    """``kind``: symbol, concat, alter, repeat or exclude."""

    kind: str
    name: str = ""
    parts: tuple[Part, ...] = ()
    least: int = 1
    most: int | None = 1
    greedy: bool = True


def parse(pattern: str) -> Part:
    tokens, at = [], 0
    text = pattern.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"pattern fault at {text[at:at + 10]!r}")
        tokens.append(m[1])
        at = m.end()
    tokens.append("")
    i = 0

    def alter() -> Part:
        nonlocal i
        options = [concat()]
        while tokens[i] == "|":
            i += 1
            options.append(concat())
        return options[0] if len(options) == 1 else Part("alter", parts=tuple(options))

    def concat() -> Part:
        parts = []
        while tokens[i] not in ("", "|", ")", "-}", ","):
            parts.append(repeat())
        return parts[0] if len(parts) == 1 else Part("concat", parts=tuple(parts))

    def expect(t: str) -> None:
        nonlocal i
        if tokens[i] != t:
            raise ValueError(f"expected {t!r}, found {tokens[i]!r}")
        i += 1

    def atom() -> Part:
        nonlocal i
        t = tokens[i]
        i += 1
        if t == "(":
            inner = alter()
            expect(")")
            return inner
        if t == "{-":
            inner = alter()
            expect("-}")
            return Part("exclude", parts=(inner,))
        if t.upper() == "PERMUTE":
            expect("(")
            members = [alter()]
            while tokens[i] == ",":
                i += 1
                members.append(alter())
            expect(")")
            return Part("alter", parts=tuple(Part("concat", parts=p) for p in itertools.permutations(members)))
        if not re.match(r"[A-Za-z_]", t):
            raise ValueError(f"pattern fault at {t!r}")
        return Part("symbol", name=t)

    def repeat() -> Part:
        nonlocal i
        part, t = atom(), tokens[i]
        if t in ("*", "+", "?"):
            least, most = {"*": (0, None), "+": (1, None), "?": (0, 1)}[t]
        elif t.startswith("{") and t != "{-":
            low, comma, high = t[1:-1].replace(" ", "").partition(",")
            least = int(low or 0)
            most = (int(high) if high else None) if comma else least
        else:
            return part
        i += 1
        greedy = tokens[i] != "?"
        i += not greedy
        return Part("repeat", parts=(part,), least=least, most=most, greedy=greedy)

    out = alter()
    if tokens[i] != "":
        raise ValueError(f"pattern fault at {tokens[i]!r}")
    return out


def symbols(part: Part) -> list[str]:
    return [part.name] if part.kind == "symbol" else list(dict.fromkeys(s for p in part.parts for s in symbols(p)))


#: The symbols of a match, last first: (what came before, symbol, whether kept).
Path = tuple[Any, str, bool] | None


def listed(path: Path) -> list[tuple[str, bool]]:
    out = []
    while path is not None:
        path, name, kept = path
        out.append((name, kept))
    return out[::-1]


def matches(part: Part, rows: dict[str, Sequence[bool]], at: int, n: int, kept: bool = True, path: Path = None) -> Iterator[tuple[int, Path]]:
    """Ends and paths, behind ``path``, of the matches that begin at a row, preferred first."""
    if part.kind == "symbol":
        if at < n and rows[part.name][at]:
            yield at + 1, (path, part.name, kept)
    elif part.kind == "alter":
        for p in part.parts:
            yield from matches(p, rows, at, n, kept, path)
    elif part.kind == "exclude":
        yield from matches(part.parts[0], rows, at, n, False, path)
    elif part.kind == "concat":
        yield from _sequence(part.parts, rows, at, n, kept, path)
    else:
        yield from _repeated(part, rows, at, n, kept, path)


def _sequence(parts: tuple[Part, ...], rows: dict, at: int, n: int, kept: bool, path: Path) -> Iterator[tuple[int, Path]]:
    if not parts:
        yield at, path
        return
    for end, so_far in matches(parts[0], rows, at, n, kept, path):
        yield from _sequence(parts[1:], rows, end, n, kept, so_far)


def _repeated(part: Part, rows: dict, at: int, n: int, kept: bool, path: Path) -> Iterator[tuple[int, Path]]:
    """Depth-first by an explicit stack of half-done repetitions, so long runs don't recurse."""
    inner = part.parts[0]
    enough = lambda count: count >= part.least
    more = lambda count: part.most is None or count < part.most
    stack: list[tuple[int, Path, int, Iterator | None]] = [(at, path, 0, None)]
    while stack:
        pos, so_far, count, tries = stack.pop()
        if tries is None:
            if not part.greedy and enough(count):
                yield pos, so_far
            tries = matches(inner, rows, pos, n, kept, so_far) if more(count) else iter(())
        step = next(((e, p) for e, p in tries if e > pos), None)
        if step is not None:
            stack.append((pos, so_far, count, tries))
            stack.append((step[0], step[1], count + 1, None))
        elif part.greedy and enough(count):
            yield pos, so_far


def longest(part: Part) -> float:
    """The most rows that a match can take."""
    inner = [longest(p) for p in part.parts]
    if part.kind == "symbol":
        return 1
    if part.kind == "repeat":
        return float("inf") if part.most is None else part.most * inner[0]
    return max(inner, default=0) if part.kind == "alter" else sum(inner)


#: A pattern is left to LEAD if a match takes no more rows than this, in no more ways.
WIDE, WAYS = 8, 64


def ways(part: Part) -> list[list[tuple[str, bool]]] | None:
    """The symbols, and whether they are kept, that a match can consist of, preferred first; None if these are too many."""
    if longest(part) > WIDE:
        return None
    found = list(itertools.islice(matches(part, dict.fromkeys(symbols(part), [True] * WIDE), 0, WIDE), WAYS + 1))
    return [listed(path) for end, path in found if end] if len(found) <= WAYS else None


def rows_on(path: list[tuple[str, bool]], clause: str, side: str, target: str | None) -> int:
    """How many rows behind a match's first one the next match may begin."""
    if clause:
        return len(path) if clause == "past last row" else 1
    places = [k for k, (s, _) in enumerate(path) if s == target]
    return max(1, (places[0] if side == "first" else places[-1]) if places else 1)


#: Rows of a stretch whose matches are remembered, and how many such stretches.
SHORT, REMEMBERED = 64, 100_000


def matched(part: Part, known: Sequence[str], flags: np.ndarray, clause: str, side: str, target: str | None) -> list[tuple[list[int], list[str]]]:
    """The kept rows and their symbols of each match in a stretch, in order; a
    match of which nothing is kept is left out. ``flags``: a column for each symbol."""
    rows, n = dict(zip(known, flags.T.tolist())), len(flags)
    at, out = 0, []
    while at < n:
        found = next(((e, p) for e, p in matches(part, rows, at, n) if e > at), None)
        if found is None:
            at += 1
            continue
        path = listed(found[1])
        kept = [k for k, (_, keep) in enumerate(path) if keep]
        if kept:
            out.append(([at + k for k in kept], [path[k][0] for k in kept]))
        at += rows_on(path, clause, side, target)
    return out


def _by_lead(rows: DataFrame, partition: list[str], order: list[str], w: Any, taken: list[list[tuple[str, bool]]]) -> DataFrame:
    """One row for each match, where one may begin at any row: ``taken`` are the ways, preferred first."""
    keeps = [[k for k, (_, keep) in enumerate(way) if keep] for way in taken]
    seen = {(f"__is_{s}", k): False for way in taken for k, (s, _) in enumerate(way)}
    seen |= {(c, k): None for kept in keeps if kept for c in order for k in (kept[0], kept[-1])}
    ahead = {(c, k): f"__{k}_{c}" for c, k in seen}
    near = rows.select(*partition, *order, *[F.lead(c, k, seen[c, k]).over(w).alias(name) if k else F.col(c).alias(name) for (c, k), name in ahead.items()])
    holds = [reduce(and_, [F.col(ahead[f"__is_{s}", k]) for k, (s, _) in enumerate(way)]) for way in taken]
    near = near.withColumn("__way", F.coalesce(*[F.when(h, F.lit(i)) for i, h in enumerate(holds)], F.lit(-1)))

    def of(value: Any) -> Column:
        return F.coalesce(*[F.when(F.col("__way") == i, value(i)) for i, kept in enumerate(keeps) if kept])

    shown = F.col("__way").isin([i for i, kept in enumerate(keeps) if kept])
    number = F.sum(shown.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")
    return near.withColumn("match_number", number).where(shown).select(
        *partition, "match_number",
        *[of(lambda i, c=c: F.col(ahead[c, keeps[i][0]])).alias(f"first_{c}") for c in order],
        *[of(lambda i, c=c: F.col(ahead[c, keeps[i][-1]])).alias(f"last_{c}") for c in order],
        of(lambda i: F.lit(len(keeps[i])).cast("long")).alias("length"),
        of(lambda i: F.lit("".join(taken[i][k][0] for k in keeps[i]))).alias("classifiers"),
    )


def _by_runs(rows: DataFrame, partition: list[str], order: list[str], carried: list[str], w: Any, symbol: str, least: int, all_rows: bool) -> DataFrame:
    """Matches that are whole runs of a symbol, of ``least`` rows or more."""
    so_far, is_ = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), F.col(f"__is_{symbol}")
    near = rows.withColumns({"__before": F.lag(is_, 1, False).over(w), "__row": F.row_number().over(w), **{f"__{k}": F.lead(is_, k, False).over(w) for k in range(1, max(least, 2))}})
    begins = is_ & ~F.col("__before")
    long = reduce(and_, [F.col(f"__{k}") for k in range(1, least)], F.lit(True))
    near = near.withColumns({
        "match_number": F.sum((begins & long).cast("int")).over(so_far).cast("int"),
        "__long": F.last(F.when(begins, long), True).over(so_far),
        "__first": F.last(F.when(begins, F.struct("__row", *order)), True).over(so_far),
    })
    if all_rows:
        return near.where(is_ & F.col("__long")).select(*carried, "match_number", F.lit(symbol).alias("classifier"))
    length = F.col("__row") - F.col("__first").getField("__row") + 1
    return near.where(is_ & ~F.col("__1") & F.col("__long")).select(
        *partition, "match_number", *[F.col("__first").getField(c).alias(f"first_{c}") for c in order], *[F.col(c).alias(f"last_{c}") for c in order],
        length.cast("long").alias("length"), F.repeat(F.lit(symbol), length).alias("classifiers"),
    )


def match_recognize(
    df: DataFrame, *, partition: Sequence[str], order: Sequence[str], pattern: str, define: dict[str, Column], after: str = "past last row", all_rows: bool = False
) -> DataFrame:
    """``df``'s rows that belong to matches, with ``match_number`` and
    ``classifier`` (``all_rows``: every row of each match but excluded ones),
    or one row for each match: partition, ``match_number``, ``first_*`` and
    ``last_*`` of the order columns, ``length`` and ``classifiers``.

    ``after``: ``past last row``, ``to next row``, ``to first X`` or ``to
    last X``. Order columns are to be unique in a partition; nulls of the
    partition's columns are a partition like any other."""
    part = parse(pattern)
    known = symbols(part)
    w = Window.partitionBy(*partition).orderBy(*order)
    flags = {f"__is_{s}": F.coalesce(define[s], F.lit(False)) if s in define else F.lit(True) for s in known}
    m = re.fullmatch(r"(past last row|to next row)|to (first|last) (\w+)", after.strip(), re.I)
    if not m:
        raise ValueError(f"unknown after-match clause {after!r}")
    clause, side, target = (m[1] or "").lower(), (m[2] or "").lower(), m[3]
    partition, order, marks = list(partition), list(order), list(flags)
    carried = list(dict.fromkeys([*partition, *(df.columns if all_rows else order)]))
    marked = df.withColumns(flags).select(*carried, *marks)
    taken = None if all_rows else ways(part)
    if taken and any(keep for way in taken for _, keep in way) and all(rows_on(way, clause, side, target) == 1 for way in taken):
        return _by_lead(marked, partition, order, w, taken)
    if part.kind == "repeat" and part.parts[0].kind == "symbol" and part.most is None and part.greedy and part.least <= WIDE and clause == "past last row":
        return _by_runs(marked, partition, order, carried, w, part.parts[0].name, part.least, all_rows)
    numbered = df.withColumns({**flags, "__begins": F.row_number().over(w) == 1}).select(*carried, *marks, "__begins")

    def found_in(stretch: np.ndarray) -> tuple:
        """How many matches; of each of their rows, or of each of them as a whole, what goes out."""
        found = matched(part, known, stretch, clause, side, target)
        number = np.arange(1, len(found) + 1)
        if all_rows:
            return len(found), np.array([r for rows, _ in found for r in rows], np.int64), np.repeat(number, [len(rows) for rows, _ in found]), [s for _, names in found for s in names]
        ends = np.array([(rows[0], rows[-1], len(rows)) for rows, _ in found], np.int64).reshape(-1, 3)
        return len(found), ends, number, ["".join(names) for _, names in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered: dict[bytes, tuple] = {}
        before = 0  # matches so far in the partition that goes on

        def flush(pieces: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal before
            rows = pa.Table.from_batches(pieces)
            is_ = np.column_stack([rows.column(f).to_numpy() for f in marks])
            begins = rows.column("__begins").to_numpy()
            live = is_.any(1)
            cuts = np.flatnonzero(~live | begins)
            starts = np.flatnonzero(live & (begins | ~np.concatenate(([False], live[:-1]))))
            ends = np.append(cuts, len(live))[np.searchsorted(cuts, starts, "right")]
            got = []
            for a, b in zip(starts.tolist(), ends.tolist()):
                if b - a > SHORT:
                    got.append(found_in(is_[a:b]))
                    continue
                key = is_[a:b].tobytes()
                if key not in remembered:
                    if len(remembered) >= REMEMBERED:
                        remembered.clear()
                    remembered[key] = found_in(is_[a:b])
                got.append(remembered[key])
            place = np.cumsum(begins)  # 0: the partition that goes on
            of, many = place[starts], np.array([g[0] for g in got], np.int64)
            base = np.cumsum(many) - many
            base = base - base[np.searchsorted(of, of)] + before * (of == 0) if len(got) else base
            before = int(many[of == place[-1]].sum()) + before * int(place[-1] == 0)
            if not many.any():
                return
            each = [len(g[2]) for g in got]
            at = np.concatenate([g[1] for g in got])
            number = pa.array(np.concatenate([g[2] for g in got]) + np.repeat(base, each), pa.int32())
            names = pa.array([s for g in got for s in g[3]], pa.string())
            moved = np.repeat(starts, each)
            if all_rows:
                taken = rows.select(carried).take(pa.array(at + moved))
                out = pa.table([*taken.columns, number, names], [*carried, "match_number", "classifier"])
            else:
                first, last = rows.select(carried).take(pa.array(at[:, 0] + moved)), rows.select(order).take(pa.array(at[:, 1] + moved))
                out = pa.table(
                    [*first.select(partition).columns, number, *first.select(order).columns, *last.columns, pa.array(at[:, 2]), names],
                    [*partition, "match_number", *[f"first_{c}" for c in order], *[f"last_{c}" for c in order], "length", "classifiers"],
                )
            yield from out.to_batches(10_000)

        pending: list[pa.RecordBatch] = []
        for batch in batches:
            live = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in marks]).any(1)
            cuts = np.flatnonzero(~live | batch.column("__begins").to_numpy(zero_copy_only=False))
            if not len(cuts):
                pending.append(batch)
                continue
            last = int(cuts[-1])
            if pending or last:
                yield from flush([*pending, batch.slice(0, last)])
            pending = [batch.slice(last)]
        if pending:
            yield from flush(pending)

    kinds = {f.name: f for f in numbered.schema}
    name = T.StructField("match_number", T.IntegerType())
    if all_rows:
        fields = [*[kinds[c] for c in carried], name, T.StructField("classifier", T.StringType())]
    else:
        ends = [T.StructField(f"{end}_{c}", kinds[c].dataType) for end in ("first", "last") for c in order]
        fields = [*[kinds[c] for c in partition], name, *ends, T.StructField("length", T.LongType()), T.StructField("classifiers", T.StringType())]
    return numbered.mapInArrow(run, T.StructType(fields))
