"""The accepted SQL dialect, brought to what Spark parses.

Works on tokens, so nothing inside string literals, quoted names or comments
changes. Each rule looks at one place and gives its replacement.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_TOKEN = re.compile(
    r"(?P<space>\s+|--[^\n]*|/\*.*?\*/)|(?P<str>'(?:[^'\\]|''|\\.)*')|(?P<name>\"(?:[^\"]|\"\")*\"|`(?:[^`]|``)*`)"
    r"|(?P<num>\d+(?:\.\d*)?(?:[eE][+-]?\d+)?|\.\d+)|(?P<word>[^\W\d]\w*)|(?P<op><=>|<>|!=|<=|>=|\|\||::|->|[^\w\s])",
    re.S,
)
COMPARE = ("=", "<>", "!=", "<", "<=", ">", ">=")
#: Type names by what Spark calls them.
TYPE_NAMES = {"VARCHAR": "STRING", "VARBINARY": "BINARY", "TEXT": "STRING", "CHARACTER": "STRING"}
UNSIGNED = {"TINYINT": "SMALLINT", "SMALLINT": "INT", "INT": "BIGINT", "INTEGER": "BIGINT", "BIGINT": "DECIMAL(20,0)"}
RENAMED = {
    "STARTS_WITH": "startswith",
    "ENDS_WITH": "endswith",
    "CONTAINS_SUBSTR": "contains",
    "SAFE_CAST": "try_cast",
    "UNNEST": "explode",
    "ROW": "struct",
    "ARRAY_TO_STRING": "array_join",
    "ARRAY_LENGTH": "size",
    "STRING_TO_ARRAY": "split",
    "CHARACTER_LENGTH": "char_length",
    "COUNTIF": "count_if",
    "GROUP_CONCAT": "listagg",
    "ARG_MAX": "max_by",
    "ARG_MIN": "min_by",
    "COLLECT": "collect_list",
}
UNITS = frozenset("YEAR QUARTER MONTH WEEK DAY HOUR MINUTE SECOND".split())


_BOUNDS = frozenset("SELECT DISTINCT WHERE AND OR NOT ON HAVING WHEN THEN ELSE CASE BY SET IS BETWEEN LIKE RLIKE QUALIFY FILTER USING RETURN".split())


class Sql:
    """Tokens without white space; ``kinds`` beside them."""

    def __init__(self, text: str) -> None:
        self.tokens: list[str] = []
        self.kinds: list[str] = []
        for m in _TOKEN.finditer(text):
            if m.lastgroup != "space":
                self.tokens.append(m.group())
                self.kinds.append(str(m.lastgroup))

    def is_word(self, i: int, *words: str) -> bool:
        """Whether there is a word at ``i``, one of ``words`` if any are given."""
        return 0 <= i < len(self.tokens) and self.kinds[i] == "word" and (not words or self.tokens[i].upper() in words)

    def is_op(self, i: int, *ops: str) -> bool:
        return 0 <= i < len(self.tokens) and self.kinds[i] == "op" and self.tokens[i] in ops

    def close(self, i: int) -> int:
        """Where the bracket opened at ``i`` closes."""
        depth = 0
        for k in range(i, len(self.tokens)):
            if self.is_op(k, "(", "["):
                depth += 1
            elif self.is_op(k, ")", "]"):
                depth -= 1
                if not depth:
                    return k
        raise ValueError(f"unbalanced brackets after {' '.join(self.tokens[max(0, i - 3): i + 1])}")

    def open(self, i: int) -> int:
        """Where the bracket closed at ``i`` opens."""
        depth = 0
        for k in range(i, -1, -1):
            if self.is_op(k, ")", "]"):
                depth += 1
            elif self.is_op(k, "(", "["):
                depth -= 1
                if not depth:
                    return k
        raise ValueError("unbalanced brackets")

    def arguments(self, i: int) -> tuple[list[str], int]:
        """Texts of the arguments in the bracket opened at ``i``, and where it closes."""
        end, depth, parts, now = self.close(i), 0, [], []
        for k in range(i + 1, end):
            if self.is_op(k, "(", "["):
                depth += 1
            elif self.is_op(k, ")", "]"):
                depth -= 1
            if not depth and self.is_op(k, ","):
                parts.append(now)
                now = []
            else:
                now.append(self.tokens[k])
        if now or parts:
            parts.append(now)
        return [join(p) for p in parts], end

    def operand_before(self, i: int) -> int:
        """Where the primary expression that ends before ``i`` begins."""
        k = i - 1
        if self.is_op(k, ")", "]"):
            k = self.open(k)
            if self.is_word(k - 1) or (k > 0 and self.kinds[k - 1] in ("word", "name")):
                k -= 1
        while self.is_op(k - 1, "."):
            k -= 2
        return k

    def comparand_before(self, i: int) -> int:
        """Where the operand of a comparison that ends before ``i`` begins: back
        to a comma, an open bracket, another comparison, or a word that no
        expression goes across."""
        k = i
        while k > 0:
            if self.is_op(k - 1, ")", "]"):
                k = self.open(k - 1)
            elif self.is_word(k - 1, "END"):
                depth = 0
                while k > 0:
                    k -= 1
                    depth += self.is_word(k, "END") - self.is_word(k, "CASE")
                    if not depth:
                        break
            elif self.is_op(k - 1, ",", "(", "[", ";", *COMPARE, "<=>") or self.is_word(k - 1, *_BOUNDS):
                break
            else:
                k -= 1
        return k

    def put(self, a: int, b: int, text: str) -> None:
        """``text`` in place of the tokens from ``a`` up to, not including, ``b``."""
        new = Sql(text)
        self.tokens[a:b] = new.tokens
        self.kinds[a:b] = new.kinds


#: Words that no bracket belongs to.
_BLANK_AFTER = frozenset("IN AND OR NOT ON FROM JOIN SELECT WHERE AS BY THEN ELSE WHEN USING OVER UNION ALL EXCEPT INTERSECT HAVING VALUES LATERAL SET".split())


def join(tokens: list[str]) -> str:
    """Token texts with blanks where they are needed or harmless."""
    out = ""
    for t in tokens:
        tight = t in (",", ")", "]", ".", "(", "[", "::") or out.endswith(("(", "[", ".", "::")) or out == ""
        word_before_bracket = t == "(" and out and (out[-1].isalnum() or out[-1] in "_`\"") and out.rsplit(" ", 1)[-1].rsplit("(", 1)[-1].upper() not in _BLANK_AFTER
        out += t if tight and (t not in ("(", "[") or word_before_bracket or out.endswith(("(", "[")) or out == "" or t == "[") else " " + t
    return out


def literal(value: object) -> str:
    """A Python value as SQL text."""
    import datetime
    import decimal

    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP_NTZ '{value.isoformat(' ')}'" if value.tzinfo is None else f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    raise TypeError(f"no literal for {type(value).__name__}")


def _similar(pattern: str) -> str:
    """A SIMILAR TO pattern as a Java one."""
    body, out, i = pattern[1:-1], "", 0
    while i < len(body):
        c = body[i]
        if c == "%":
            out += ".*"
        elif c == "_":
            out += "."
        elif c in ".^$\\":
            out += "\\\\" + c
        else:
            out += c
        i += 1
    return f"'^(?:{out})$'"


def _json(args: list[str]) -> str:
    first, path = args[0], args[1]
    returning = re.search(r"\s+RETURNING\s+(.+)$", path, re.I)
    if returning:
        path = path[: returning.start()]
    path = re.sub(r"^'(?:strict|lax)\s+", "'", path)
    got = f"get_json_object({first}, {path})"
    return f"CAST({got} AS {returning[1]})" if returning else got


def _object_agg(args: list[str]) -> str:
    """JSON_OBJECTAGG of ``KEY k VALUE v``, ``k VALUE v``, ``k: v`` or ``k, v``."""
    whole = ", ".join(args)
    m = re.match(r"(?:KEY\s+)?(.+?)(?:\s+VALUE\s+|\s*:\s*|,\s*)(.+?)(?:\s+(?:NULL|ABSENT)\s+ON\s+NULL)?$", whole, re.I | re.S)
    if m is None:
        raise ValueError(f"JSON_OBJECTAGG takes a key and a value: {whole}")
    return f"to_json(map_from_entries(array_sort(collect_list(struct({m[1]}, {m[2]})))))"


def _periods(word: str, a: str, b: str) -> str:
    """A period predicate of two ``(start, end)`` pairs."""
    (s1, e1), (s2, e2) = (Sql(x).arguments(0)[0] for x in (a, b))
    return {
        "OVERLAPS": f"({s1} < {e2} AND {s2} < {e1})",
        "CONTAINS": f"({s1} <= {s2} AND {e1} >= {e2})",
        "EQUALS": f"({s1} = {s2} AND {e1} = {e2})",
        "PRECEDES": f"({e1} <= {s2})",
        "SUCCEEDS": f"({s1} >= {e2})",
        "IMMEDIATELY PRECEDES": f"({e1} = {s2})",
        "IMMEDIATELY SUCCEEDS": f"({s1} = {e2})",
    }[word]


#: Elements of a cast format by Spark's pattern letters.
FORMAT_PARTS = {"YYYY": "yyyy", "YY": "yy", "MM": "MM", "MON": "MMM", "MONTH": "MMMM", "DDD": "DDD", "DD": "dd", "HH24": "HH", "HH12": "hh", "HH": "hh", "MI": "mm", "SS": "ss", "AM": "a", "PM": "a", "DY": "EEE", "DAY": "EEEE", "FF1": "S", "FF2": "SS", "FF3": "SSS", "FF6": "SSSSSS"}
_FORMAT = re.compile("|".join(sorted(FORMAT_PARTS, key=len, reverse=True)) + r"|[A-Za-z]+", re.I)


def _pattern(text: str) -> str:
    """The Spark pattern of a cast format; letters that are no element stand for themselves."""
    return _FORMAT.sub(lambda m: FORMAT_PARTS.get(m[0].upper(), f"''{m[0]}''"), text[1:-1])


def _cast_format(value: str, kind: str, pattern: str) -> str:
    kind = kind.upper()
    if kind in ("DATE", "TIMESTAMP", "TIME"):
        made = f"to_timestamp({value}, '{_pattern(pattern)}')"
        return {"DATE": f"to_date({value}, '{_pattern(pattern)}')", "TIMESTAMP": f"CAST({made} AS TIMESTAMP_NTZ)", "TIME": f"CAST(date_format({made}, 'HH:mm:ss.SSSSSS') AS TIME)"}[kind]
    return f"date_format({value}, '{_pattern(pattern)}')"


CALLS: dict[str, Callable[[list[str]], str]] = {
    "JSON_VALUE": _json,
    "JSON_QUERY": _json,
    "BITAND": lambda a: f"(({a[0]}) & ({a[1]}))",
    "BITOR": lambda a: f"(({a[0]}) | ({a[1]}))",
    "BITXOR": lambda a: f"(({a[0]}) ^ ({a[1]}))",
    "BITNOT": lambda a: f"(~({a[0]}))",
    "CONCAT2": lambda a: f"concat(coalesce({a[0]}, ''), coalesce({a[1]}, ''))",
    "TRUNCATE": lambda a: f"(sign({a[0]}) * floor(abs({a[0]}) * pow(10, {a[1] if len(a) > 1 else 0})) / pow(10, {a[1] if len(a) > 1 else 0}))",
    "SUM0": lambda a: f"coalesce(sum({a[0]}), 0)",
    "FUSION": lambda a: f"flatten(collect_list({a[0]}))",
    "ARRAY_CONCAT_AGG": lambda a: f"flatten(collect_list({a[0]}))",
    "ARRAY_CONCAT": lambda a: f"concat({', '.join(a)})",
    "JSON_ARRAYAGG": lambda a: f"to_json(collect_list({a[0]}))",
    "JSON_OBJECTAGG": _object_agg,
    "JSON_TYPE": lambda a: f"schema_of_variant(parse_json({a[0]}))",
    "MULTISET_UNION": lambda a: f"concat({', '.join(a)})",
}


class Translator:
    """Translation that users change: ``calls`` maps a function's upper-case
    name to what stands for its call, given the texts of its arguments; in a
    subclass ``rule`` sees every token and may replace what begins there."""

    def __init__(self, calls: dict[str, Callable[[list[str]], str]] | None = None) -> None:
        self.calls = CALLS | (calls or {})

    def rule(self, s: Sql, i: int) -> int | None:
        """The place to go on from, or None to leave the token to the built-in rules."""
        return None

    def __call__(self, text: str, names: Callable[[list[str]], str | None] | None = None, periods: Callable[[list[str]], tuple[str, str] | None] | None = None) -> str:
        return translate(text, names, periods, self)


def translate(text: str, names: Callable[[list[str]], str | None] | None = None, periods: Callable[[list[str]], tuple[str, str] | None] | None = None, translator: Translator | None = None) -> str:
    """Spark SQL for ``text``. ``names`` maps the parts of a dotted table name
    to a view's name, or None where it knows none; ``periods`` maps them to the
    columns that say from when to when a row is valid."""
    s = Sql(text)
    _escapes(s)
    i = 0
    while i < len(s.tokens):
        own = translator.rule(s, i) if translator else None
        i = _rule(s, i, translator.calls if translator else CALLS) if own is None else own
    _group_id(s)
    _system_time(s, periods)
    if names is not None:
        _tables(s, names)
    return join(s.tokens)


def _quantified(left: str, op: str, every: bool, query: str) -> str:
    """``left op ALL|SOME (query)`` in three-valued logic, by the query's
    extremes: a comparison holds for all values if it does for the one that is
    hardest to meet, for some if it does for the easiest. Nulls leave open what
    the values do not decide; without values ALL holds and SOME does not."""
    of = lambda what: f"(SELECT {what} FROM ({query}) AS each_of(v))"
    low, high = of("min(each_of.v)"), of("max(each_of.v)")
    if op in ("=", "<>", "!="):
        decided = f"{left} {op} {low} {'AND' if every else 'OR'} {left} {op} {high}"
    else:
        decided = f"{left} {op} {high if (op in ('>', '>=')) == every else low}"
    settled = f"NOT ({decided}) THEN false" if every else f"({decided}) THEN true"
    empty = str(every).lower()
    return f"(CASE WHEN {of('count(*)')} = 0 THEN {empty} WHEN {settled} WHEN {of('count(*) - count(each_of.v)')} > 0 THEN NULL ELSE ({decided}) END)"


def _rule(s: Sql, i: int, calls: dict[str, Callable[[list[str]], str]]) -> int:
    if s.kinds[i] != "word":
        return i + 1
    word = s.tokens[i].upper()
    called = s.is_op(i + 1, "(")
    if word in calls and called:
        args, end = s.arguments(i + 1)
        s.put(i, end + 1, calls[word](args))
    elif word == "POSITION" and called:
        args, end = s.arguments(i + 1)
        m = re.match(r"(.+?)\s+IN\s+(.+?)(?:\s+FROM\s+(.+))?$", ", ".join(args), re.I | re.S)
        if m:
            s.put(i, end + 1, f"locate({m[1]}, {m[2]}, {m[3] or 1})")
    elif word in ("FLOOR", "CEIL") and called:
        args, end = s.arguments(i + 1)
        m = re.match(r"(.+)\s+TO\s+(\w+)$", args[0], re.I | re.S) if len(args) == 1 else None
        if m and m[2].upper() in UNITS:
            trunc = f"date_trunc('{m[2].upper()}', {m[1]})"
            s.put(i, end + 1, trunc if word == "FLOOR" else f"CASE WHEN {trunc} = {m[1]} THEN {trunc} ELSE {trunc} + INTERVAL 1 {m[2].upper()} END")
    elif word in RENAMED and called and RENAMED[word].upper() != word:
        s.tokens[i] = RENAMED[word]
    elif word in ("ARRAY", "MULTISET") and s.is_op(i + 1, "["):
        args, end = s.arguments(i + 1)
        s.put(i, end + 1, f"array({', '.join(args)})")
    elif word in TYPE_NAMES and not called and (s.is_word(i - 1, "AS") or s.is_op(i - 1, "::") or s.is_word(i - 1, "RETURNING")):
        s.tokens[i] = TYPE_NAMES[word]
    elif word in UNSIGNED and s.is_word(i + 1, "UNSIGNED"):
        s.put(i, i + 2, UNSIGNED[word])
    elif word == "TIMESTAMP" and s.is_word(i + 1, "WITH") and s.is_word(i + 3, "ZONE"):
        literal = i + 4 < len(s.tokens) and s.kinds[i + 4] == "str"
        if literal:
            value = re.sub(r"\s*(?:GMT|UTC)?\s*([+-]\d\d:\d\d)'$", r"\1'", s.tokens[i + 4])
            s.put(i, i + 5, f"TIMESTAMP {value}")
            return i + 2
        s.put(i, i + 4, "TIMESTAMP_LTZ")
    elif word in ("ARRAY", "MULTISET") and called and s.is_word(i + 2, "SELECT", "WITH"):
        end = s.close(i + 1)
        s.put(i, end + 1, f"(SELECT collect_list(each_of.v) FROM ({join(s.tokens[i + 2 : end])}) AS each_of(v))")
    elif word == "MAP" and called and s.is_word(i + 2, "SELECT", "WITH"):
        end = s.close(i + 1)
        s.put(i, end + 1, f"(SELECT map_from_entries(collect_list(struct(each_of.k, each_of.v))) FROM ({join(s.tokens[i + 2 : end])}) AS each_of(k, v))")
    elif word == "CAST" and called and (end := s.close(i + 1)) and s.is_word(end - 2, "FORMAT"):
        inner = [k for k in range(i + 2, end) if s.is_word(k, "AS")]
        s.put(i, end + 1, _cast_format(join(s.tokens[i + 2 : inner[-1]]), s.tokens[inner[-1] + 1], s.tokens[end - 1]))
    elif word == "TABLE" and called and s.is_word(i + 2, "TUMBLE", "HOP", "SESSION") and s.is_op(i + 3, "("):
        args, _ = s.arguments(i + 3)
        s.put(i, s.close(i + 1) + 1, _windowed(s.tokens[i + 2].upper(), args))
    elif word == "TABLE" and called and s.is_word(i + 2) and s.is_op(i + 3, "(") and s.close(i + 3) == s.close(i + 1) - 1 and s.is_word(i - 1, "FROM", "JOIN", "LATERAL", "APPLY"):
        s.put(i, s.close(i + 1) + 1, join(s.tokens[i + 2 : s.close(i + 1)]))
    elif word in _PERIOD_WORDS and s.is_op(i - 1, ")") and (gap := 1 + (word == "IMMEDIATELY")) and s.is_op(i + gap, "("):
        start, end = s.open(i - 1), s.close(i + gap)
        if len(s.arguments(start)[0]) == 2 and len(s.arguments(i + gap)[0]) == 2 and not (s.is_word(start - 1) and not s.is_word(start - 1, *_BLANK_AFTER, "DISTINCT")):
            name = " ".join(t.upper() for t in s.tokens[i : i + gap])
            s.put(start, end + 1, _periods(name, join(s.tokens[start:i]), join(s.tokens[i + gap : end + 1])))
            return start + 1
    elif word == "WITHIN" and s.is_word(i + 1, "DISTINCT") and s.is_op(i - 1, ")"):
        start, (keys, end) = s.open(i - 1), s.arguments(i + 2)
        fn, (args, _) = s.tokens[start - 1], s.arguments(start)
        one = f"collect_set(struct({', '.join(keys)}, {args[0]} AS v))"
        summed = {"SUM": "aggregate({}, CAST(NULL AS DOUBLE), (a, x) -> coalesce(a, 0) + x.v)", "COUNT": "size(filter({}, x -> x.v IS NOT NULL))", "MIN": "array_min(transform({}, x -> x.v))", "MAX": "array_max(transform({}, x -> x.v))"}
        if fn.upper() not in summed:
            raise ValueError(f"WITHIN DISTINCT of {fn}")
        s.put(start - 1, end + 1, summed[fn.upper()].format(one))
    elif word == "CROSS" and s.is_word(i + 1, "APPLY"):
        s.put(i, i + 2, "CROSS JOIN LATERAL")
    elif word == "OUTER" and s.is_word(i + 1, "APPLY"):
        end = s.close(i + 2)
        after = end + 1 + s.is_word(end + 1, "AS") + 1
        if s.is_op(after, "("):
            after = s.close(after) + 1
        s.put(after, after, "ON true")
        s.put(i, i + 2, "LEFT JOIN LATERAL")
    elif word == "SIMILAR" and s.is_word(i + 1, "TO") and i + 2 < len(s.tokens) and s.kinds[i + 2] == "str":
        s.put(i, i + 3, f"RLIKE {_similar(s.tokens[i + 2])}")
    elif word in ("ANY", "SOME", "ALL") and called and s.is_op(i - 1, *COMPARE) and s.is_word(i + 2, "SELECT", "VALUES", "WITH"):
        op, start, end = s.tokens[i - 1], s.comparand_before(i - 1), s.close(i + 1)
        left, query = join(s.tokens[start : i - 1]), join(s.tokens[i + 2 : end])
        if op == "=" and word != "ALL":
            new = f"{left} IN ({query})"
        elif op in ("<>", "!=") and word == "ALL":
            new = f"{left} NOT IN ({query})"
        else:
            new = _quantified(left, op, word == "ALL", query)
        s.put(start, end + 1, new)
        return start + 1
    elif word == "OFFSET" and i + 1 < len(s.tokens) and s.is_word(i + 2, "ROW", "ROWS"):
        skip = s.tokens[i + 1]
        if s.is_word(i + 3, "FETCH"):
            take, end = _fetch(s, i + 3)
            s.put(i, end, f"LIMIT {take} OFFSET {skip}")
        else:
            s.put(i, i + 3, f"OFFSET {skip}")
        return i + 2
    elif word == "FETCH" and s.is_word(i + 1, "FIRST", "NEXT"):
        take, end = _fetch(s, i)
        s.put(i, end, f"LIMIT {take}")
    return i + 1


_PERIOD_WORDS = frozenset("OVERLAPS CONTAINS EQUALS PRECEDES SUCCEEDS IMMEDIATELY".split())


def _windowed(kind: str, args: list[str]) -> str:
    """A table with the windows of its rows as ``window_start`` and
    ``window_end``: TUMBLE(TABLE t, DESCRIPTOR(ts), size), HOP(TABLE t,
    DESCRIPTOR(ts), slide, size), SESSION(TABLE t, DESCRIPTOR(ts)[, DESCRIPTOR(keys)], gap)."""
    source = re.sub(r"^TABLE\s+", "", args[0], flags=re.I)
    source = f"({source})" if source.upper().startswith("SELECT") else source
    inside = lambda text: re.sub(r"^DESCRIPTOR\s*\((.*)\)$", r"\1", text.strip(), flags=re.I | re.S)
    span = lambda text: "'" + " ".join(t.strip("'") for t in Sql(text).tokens[1:]) + "'"
    ts = inside(args[1])
    if kind == "SESSION":
        keys, gap = (inside(args[2]), args[3]) if len(args) > 3 else ("", args[2])
        by = f"PARTITION BY {keys} " if keys else ""
        begun = f"SELECT *, CASE WHEN {ts} < lag({ts}) OVER ({by}ORDER BY {ts}) + {gap} THEN 0 ELSE 1 END AS __begins FROM {source}"
        numbered = f"SELECT *, sum(__begins) OVER ({by}ORDER BY {ts} ROWS UNBOUNDED PRECEDING) AS __session FROM ({begun}) AS begun"
        group = f"PARTITION BY {keys + ', ' if keys else ''}__session"
        return f"(SELECT * EXCEPT (__begins, __session), min({ts}) OVER ({group}) AS window_start, max({ts}) OVER ({group}) + {gap} AS window_end FROM ({numbered}) AS numbered)"
    sizes = [span(args[2])] if kind == "TUMBLE" else [span(args[3]), span(args[2])]
    return f"(SELECT * EXCEPT (__w), __w.start AS window_start, __w.end AS window_end FROM (SELECT *, window({ts}, {', '.join(sizes)}) AS __w FROM {source}) AS windowed)"


def _escapes(s: Sql) -> None:
    """``{fn f(x)}``, ``{d '...'}``, ``{t '...'}`` and ``{ts '...'}`` without their braces."""
    i = 0
    while i < len(s.tokens):
        if s.is_op(i, "{") and s.is_word(i + 1, "FN", "D", "T", "TS"):
            depth, end = 0, i
            while end < len(s.tokens):
                depth += s.is_op(end, "{") - s.is_op(end, "}")
                if not depth:
                    break
                end += 1
            kind = {"FN": "", "D": "DATE ", "T": "TIME ", "TS": "TIMESTAMP_NTZ "}[s.tokens[i + 1].upper()]
            s.put(i, end + 1, kind + join(s.tokens[i + 2 : end]))
            continue
        i += 1


def _group_id(s: Sql) -> None:
    """GROUP_ID() numbers the repeated groups of GROUPING SETS; each set of ours
    is there once, as repeats are refused, so it is 0."""
    i = 0
    while i < len(s.tokens):
        if s.is_word(i, "GROUP_ID") and s.is_op(i + 1, "(") and s.is_op(i + 2, ")"):
            s.put(i, i + 3, "CAST(0 AS BIGINT)")
        i += 1


def _system_time(s: Sql, periods: Callable[[list[str]], tuple[str, str] | None] | None) -> None:
    """``t FOR SYSTEM_TIME AS OF x`` as the rows of ``t`` that were valid at ``x``."""
    i = 0
    while i < len(s.tokens):
        if s.is_word(i, "FOR") and s.is_word(i + 1, "SYSTEM_TIME") and s.is_word(i + 2, "AS") and s.is_word(i + 3, "OF"):
            begin = i - 1
            while s.is_op(begin - 1, "."):
                begin -= 2
            parts = [t[1:-1].replace('""', '"') if t[0] in '"`' else t for t in s.tokens[begin:i] if t != "."]
            bounds = periods(parts) if periods else None
            if bounds is None:
                raise ValueError(f"{'.'.join(parts)} does not say from when to when its rows are valid")
            end = i + 4
            while end < len(s.tokens) and not (s.is_op(end, ",", ")", ";") or s.is_word(end, "AS", *_ENDS)):
                end = s.close(end) + 1 if s.is_op(end, "(") else end + 1
            table, at = join(s.tokens[begin:i]), join(s.tokens[i + 4 : end])
            alias = "" if s.is_word(end, "AS") else f" AS `{parts[-1]}`"
            s.put(begin, end, f"(SELECT * FROM {table} WHERE {bounds[0]} <= {at} AND ({bounds[1]} IS NULL OR {bounds[1]} > {at})){alias}")
        i += 1


def _fetch(s: Sql, i: int) -> tuple[str, int]:
    """The count of FETCH FIRST|NEXT n ROW|ROWS ONLY at ``i``, 1 without one, and its end."""
    k, take = i + 2, "1"
    if not s.is_word(k, "ROW", "ROWS"):
        take, k = s.tokens[k], k + 1
    return take, k + 2


def _tables(s: Sql, names: Callable[[list[str]], str | None]) -> None:
    plain = lambda t: t[1:-1].replace('""', '"') if t[0] in "\"`" else t
    i = 0
    while i < len(s.tokens):
        if (s.is_word(i, "FROM", "JOIN", "INTO", "UPDATE", "TABLE") and not _of_call(s, i)) or (s.is_op(i, ",") and _in_from(s, i)):
            k = i + 1
            parts: list[str] = []
            while k < len(s.tokens) and s.kinds[k] in ("word", "name"):
                parts.append(plain(s.tokens[k]))
                if not s.is_op(k + 1, "."):
                    break
                k += 2
            view = names(parts) if parts and not s.is_op(k + 1, "(") else None
            if view:
                quoted = f"`{view}`"
                alias = s.is_word(k + 1, "AS") or (k + 1 < len(s.tokens) and s.kinds[k + 1] in ("word", "name") and s.tokens[k + 1].upper() not in _ENDS)
                s.put(i + 1, k + 1, quoted if alias else f"{quoted} AS `{parts[-1]}`")
        i += 1


def _of_call(s: Sql, i: int) -> bool:
    """Whether the FROM at ``i`` is part of a call or of IS DISTINCT FROM."""
    if not s.is_word(i, "FROM"):
        return False
    if s.is_word(i - 1, "DISTINCT") and (s.is_word(i - 2, "IS") or s.is_word(i - 3, "IS")):
        return True
    depth = 0
    for k in range(i - 1, -1, -1):
        if s.is_op(k, ")", "]"):
            depth += 1
        elif s.is_op(k, "(", "["):
            if not depth:
                return s.is_word(k - 1, "EXTRACT", "TRIM", "SUBSTRING", "SUBSTR", "OVERLAY", "POSITION")
            depth -= 1
        elif not depth and s.is_word(k, "SELECT"):
            return False
    return False


_ENDS = frozenset(
    "WHERE GROUP HAVING ORDER LIMIT OFFSET FETCH UNION INTERSECT EXCEPT MINUS JOIN INNER LEFT RIGHT FULL CROSS ON USING NATURAL LATERAL WINDOW SET VALUES SELECT TABLESAMPLE PIVOT UNPIVOT OUTER SEMI ANTI QUALIFY".split()
)


def _in_from(s: Sql, i: int) -> bool:
    """Whether the comma at ``i`` separates tables."""
    depth = 0
    for k in range(i - 1, -1, -1):
        if s.is_op(k, ")", "]"):
            depth += 1
        elif s.is_op(k, "(", "["):
            if not depth:
                return False
            depth -= 1
        elif not depth and s.is_word(k, "FROM"):
            return not s.is_op(k - 1, "(")
        elif not depth and s.is_word(k, "SELECT", "WHERE", "BY", "HAVING", "ON", "VALUES", "SET"):
            return False
    return False
