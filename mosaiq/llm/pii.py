"""Personal data in whole texts: base patterns and boosted candidates
(DataFrame functions only on the data; the driver fits trees to a table of counts).

Base spans come from strict patterns and always stay. Generators of high
recall propose further spans, which may overlap each other and the base:
e-mail addresses and IP numbers in disguise, IPv6, cards with other separators,
telephone numbers without a plus sign, keys and tokens. A proposal has features
of its format (digits, separators, letters, grouping, whether its check holds
once the disguise is off) and of its context (characters and words at its sides).

The trees learn from the corpus itself. Positive are proposals that overlap a
base span, those whose check holds, tokens that are assigned to a name such as
``password``, and proposals in disguised copies of the base spans: each is
rewritten, in its context, in forms that the base does not know. All others
are negative. Margins are calibrated, and for each kind a threshold chosen, on
a fold of the examples that the fit has not seen.

Scale: all patterns are evaluated in one narrow pass; positions are running
sums of the lengths of matches and of what lies between them, inside each row.
What is gathered for the fit is one row for each feature vector that occurs;
there are at most ``VECTORS`` of them whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import fresh, materialize

KINDS = ("email", "ip", "card", "phone")
#: Kinds of added spans, in the order of results.
ALL_KINDS = (*KINDS, "secret")

# Possessive and guarded forms of the contract's patterns: what they match is
# the same, in time that grows with the text's length only.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9](?:[\x20().-]*+[0-9]){7,14}+(?![\x20().-]*+[0-9])"
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)"

_DOT = r"(?:\.|\[\.\]|\(\.\))"
#: (kind, pattern) of the proposals.
GENERATORS = (
    ("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}{{1,64}}+(?:@|\x20?[(\[]at[)\]]\x20?){_LABEL}{{1,63}}+(?:(?:\.|\x20?[(\[]dot[)\]]\x20?){_LABEL}{{1,63}}+){{1,8}}+"),
    ("ip", rf"(?<![0-9A-Fa-f:.])(?:[0-9]{{1,5}}+(?:{_DOT}[0-9]{{1,5}}+){{3}}+|[0-9A-Fa-f]{{1,4}}+(?::[0-9A-Fa-f]{{0,4}}+){{4,7}}+)(?![0-9A-Fa-f:])"),
    ("card", r"(?<![0-9])(?<![0-9][\x20.-])[0-9](?:[\x20.-]?[0-9]){11,19}+(?![\x20.-]?[0-9])"),
    ("phone", r"(?<![0-9])(?<![0-9][\x20().-])\(?[0-9](?:[\x20().-]{0,2}+[0-9]){6,14}+(?![\x20().-]{0,2}+[0-9])"),
    ("secret", r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{16,}+"),
)
#: Words before a span that tell of its kind.
CUES = (
    r"phone|tel|mobile|fax|call|contact",
    r"e-?mail|write|reach|address",
    r"card|visa|mastercard|credit|account|payment",
    r"ip|host|server|login|from",
    r"token|secret|password|key",
)
#: What assigns a value to a secret's name, up to the value.
ASSIGNED = r"(?i)(?:token|secret|passwd|password|pwd|key)[\"']?[\x20\t]*[=:][\x20\t]*[\"']?$"
#: Values of each feature; their product bounds the table that is gathered.
LEVELS = {"generator": 5, "digits": 8, "marks": 6, "letters": 4, "cue": 6, "left": 4, "right": 4, "groups": 3, "valid": 2}
VECTORS = int(np.prod(list(LEVELS.values())))
#: Characters before a span in which cues are looked for.
BEFORE = 24
#: Share of right redactions that a threshold must reach on the calibration fold.
PRECISION = 0.8
#: Calibrated probability that a redacted proposal has at least.
LEAST = 0.5


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(lengths: Column) -> Column:
    """Sums of all lengths before each, by blocks: time near-linear in their number."""
    step = 64
    zero = F.array(F.lit(0))
    sums = lambda block: F.aggregate(block, zero, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / step).cast("int")), lambda b: sums(F.slice(lengths, b * step + 1, step)))

    def place(inner: Column) -> Column:
        totals = F.aggregate(inner, zero, lambda a, w: F.concat(a, F.array(F.element_at(a, -1) + F.element_at(w, -1))))
        return F.flatten(F.zip_with(inner, F.slice(totals, 1, F.size(inner)), lambda w, t: F.transform(F.slice(w, 1, F.size(w) - 1), lambda x: x + t)))

    return let(blocks, place)


def located(text: Column, pattern: str) -> Column:
    """Array of (``start``, ``end``, ``value``) of a pattern's matches, in code points."""

    def place(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        lengths = F.zip_with(F.transform(F.slice(gaps, 1, F.size(found)), lambda g: F.char_length(g)), found, lambda g, m: g + F.char_length(m))
        gap = F.transform(gaps, lambda g: F.char_length(g))
        starts = let(lengths, lambda n: let(gap, lambda g: F.zip_with(_running(n), F.slice(g, 1, F.size(n)), lambda a, b: a + b)))
        return F.zip_with(starts, found, lambda s, m: F.struct(s.alias("start"), (s + F.char_length(m)).alias("end"), m.alias("value")))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, place(found)).otherwise(none))


def luhn(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    even = F.char_length(digits) % 2

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 != even, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _span_of(kind: str):
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))


def _fixed(make, *first):
    return lambda m: make(*first, m)


def base_spans(text: Column) -> Column:
    """Array of (``kind``, ``start``, ``end``), by kind as in ``KINDS``, then start."""
    octets = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
    keep = {"email": lambda m: F.lit(True), "ip": lambda m: m["value"].rlike(octets), "card": lambda m: luhn(m["value"]), "phone": lambda m: F.lit(True)}
    hint = {"email": F.contains(text, F.lit("@")), "ip": text.rlike("[0-9]"), "card": text.rlike("[0-9]"), "phone": F.contains(text, F.lit("+"))}
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    parts = []
    for kind, pattern in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
        good = F.filter(located(text, pattern), keep[kind])
        parts.append(F.when(hint[kind], F.transform(good, _span_of(kind))).otherwise(none))
    return F.concat(*parts)


def _check(kind: str, value: Column, before: Column) -> Column:
    """Whether the value is what it seems, once its disguise is off."""
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(value, r"\x20?[(\[]at[)\]]\x20?", "@"), r"\x20?[(\[]dot[)\]]\x20?", ".")
        return plain.rlike(rf"^{_LOCAL}+@{_LABEL}+(?:\.{_LABEL}+)*\.[A-Za-z]{{2,}}$")
    if kind == "ip":
        plain = F.regexp_replace(value, r"[\[\]()]", "")
        six = value.rlike(r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$") | (value.rlike("::") & ~value.rlike("::.*::|:::"))
        return plain.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$") | (F.contains(value, F.lit(":")) & six)
    if kind == "card":
        return F.char_length(F.regexp_replace(value, "[^0-9]", "")).between(16, 19) & luhn(value)
    if kind == "secret":
        return before.rlike(ASSIGNED)
    return F.lit(False)


def proposals(text: Column) -> Column:
    """Array of proposed spans: ``kind``, ``start``, ``end`` and their features."""

    def features(g: int, kind: str, m: Column) -> Column:
        value = m["value"]
        digits = F.char_length(F.regexp_replace(value, "[^0-9]", ""))
        n = F.when(digits < 7, 0)
        for i, most in enumerate((9, 11, 12, 15, 16, 19), 1):
            n = n.when(digits <= most, i)
        marks = (
            F.when(value.rlike(r"[(\[]"), 5)
            .when(value.rlike(r"[0-9]\x20") & value.rlike("[.-]"), 4)
            .when(F.contains(value, F.lit(" ")), 1)
            .when(F.contains(value, F.lit(".")), 3)
            .when(F.contains(value, F.lit("-")), 2)
            .otherwise(0)
        )
        letters = F.when(~value.rlike("[A-Za-z]"), 0).when(~value.rlike("[G-Zg-z]"), 1).when(value.rlike("[0-9]"), 2).otherwise(3)
        start = m["start"]
        before = F.substring(text, F.greatest(F.lit(1), start - BEFORE + 1), F.least(start, F.lit(BEFORE)))
        cue = F.lit(0)
        for i, words in enumerate(CUES, 1):
            cue = F.when(before.rlike(rf"(?i)(?<!\p{{L}})(?:{words})(?!\p{{L}})"), i).otherwise(cue)
        side = lambda c: F.when((c == "") | c.rlike(r"^[\x20\x09-\x0D]"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).otherwise(3)
        left = side(F.when(start > 0, F.substring(text, start, F.lit(1))).otherwise(F.lit("")))
        right = side(F.substring(text, m["end"] + 1, F.lit(1)))
        groups = F.when(value.rlike(r"(?:^|[^0-9])[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$"), 1).when(value.rlike(r"[0-9]{3}[\x20).-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$"), 2).otherwise(0)
        found = {"generator": F.lit(g), "digits": n.otherwise(7), "marks": marks, "letters": letters, "cue": cue, "left": left, "right": right, "groups": groups}
        found["valid"] = F.coalesce(_check(kind, value, before), F.lit(False))
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), m["end"].alias("end"), *[c.cast("int").alias(k) for k, c in found.items()])

    hints = (r"@|(?i)[(\[]at[)\]]", r"[0-9A-Fa-f]{1,4}[.:\[(][.:0-9A-Fa-f]", "[0-9]", "[0-9]", "[0-9]")
    parts = []
    for g, (kind, pattern) in enumerate(GENERATORS):
        found = F.transform(located(text, pattern), _fixed(features, g, kind))
        parts.append(F.when(text.rlike(hints[g]), found))
    fields = ",".join(f"{k}:int" for k in ("start", "end", *LEVELS))
    none = F.array().cast(f"array<struct<kind:string,{fields}>>")
    return F.concat(*[F.coalesce(p, none) for p in parts])


def disguised(text: Column, base: Column) -> Column:
    """Array of (``snippet``, ``start``, ``end``): every base span in its
    context, rewritten in each form of its kind that the base does not know."""

    def forms(s: Column) -> Column:
        value = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        swap = lambda pattern, to, v=value: F.regexp_replace(v, pattern, to)
        bare = swap(r"^\+", "")
        local = swap(r"^\+[0-9]{1,3}[\x20.-]?(?=\(?[0-9])", "")
        groups = F.transform(F.array(F.lit(r"$1.$2.$3.$4"), F.lit(r"$1 $2.$3 $4")), lambda to: F.regexp_replace(swap("[^0-9]", ""), F.lit(r"^([0-9]{4})([0-9]{4})([0-9]{4})([0-9]{4,7})$"), to))
        made = (
            F.when(s["kind"] == "email", F.array(swap("@", " [at] "), swap("@", "(at)"), swap(r"\.(?=[^@]*$)", " (dot) ", swap("@", " (at) "))))
            .when(s["kind"] == "ip", F.array(swap(r"\.", "[.]"), swap(r"\.", "(.)")))
            .when(s["kind"] == "card", groups)
            .otherwise(F.array(bare, local))
        )
        before = F.substring(text, F.greatest(F.lit(1), s["start"] - BEFORE + 1), F.least(s["start"], F.lit(BEFORE)))
        after = F.substring(text, s["end"] + 1, F.lit(8))
        n = F.char_length(before)
        return F.transform(F.filter(made, lambda v: v != value), lambda v: F.struct(F.concat(before, v, after).alias("snippet"), n.alias("start"), (n + F.char_length(v)).alias("end")))

    none = F.array().cast("array<struct<snippet:string,start:int,end:int>>")
    return F.when(F.size(base) > 0, F.flatten(F.transform(base, forms))).otherwise(none)


def with_candidates(docs: DataFrame, *, text: str = "text", base: str = "base", proposed: str = "proposed", taught: str = "taught") -> DataFrame:
    """``docs`` with its base spans, proposals and disguised base spans (null texts: empty arrays)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumns({base: base_spans(whole), proposed: proposals(whole)})
    return found.withColumn(taught, disguised(whole, F.col(base)))


@dataclass
class Model:
    trees: boosting.Boosted
    limits: dict[str, float]


def fit(candidates: DataFrame, *, base: str = "base", proposed: str = "proposed", taught: str = "taught", precision: float = PRECISION) -> Model:
    """Fit to the counts of feature vectors over all rows of ``candidates``. A
    fifth of the examples, by hash, calibrates. Without positive or without
    negative examples nothing is added to the base."""
    names = list(LEVELS)
    rows = candidates.select((F.pmod(F.hash(base, proposed), F.lit(5)) == 0).alias("held"), base, F.explode(proposed).alias("p"))
    meets = lambda b: (b["start"] < F.col("p.end")) & (b["end"] > F.col("p.start"))
    natural = rows.select("held", "p", (F.exists(base, meets) | (F.col("p.valid") == 1)).alias("true"))
    copies = candidates.select(F.explode(taught).alias("t"))
    copies = copies.select((F.pmod(F.hash("t.snippet"), F.lit(5)) == 0).alias("held"), "t", F.explode(proposals(F.col("t.snippet"))).alias("p"))
    copies = copies.where((F.col("t.start") < F.col("p.end")) & (F.col("t.end") > F.col("p.start"))).select("held", "p", F.lit(True).alias("true"))
    examples = natural.unionByName(copies)
    counts = examples.groupBy("held", *[F.col(f"p.{n}").alias(n) for n in names]).agg(F.count_if("true").alias("pos"), F.count_if(~F.col("true")).alias("neg")).collect()
    if not counts:
        return Model(boosting.Boosted(-30.0, []), {})
    counts.sort(key=lambda r: tuple(r))
    x = np.array([[r[n] for n in names] for r in counts])
    pos, neg, held = (np.array([r[n] for r in counts], float) for n in ("pos", "neg", "held"))
    fresh, test = held == 0, held == 1
    if not pos[fresh].sum() or not neg[fresh].sum() or not test.any():
        return Model(boosting.Boosted(-30.0, []), {})
    trees = boosting.calibrate(boosting.fit(x[fresh], pos[fresh], neg[fresh]), x[test], pos[test], neg[test])
    p = trees.probability(x)
    limits = {}
    for g, (kind, _) in enumerate(GENERATORS):
        of = test & (x[:, 0] == g)
        # right in that share of all that is redacted, and each more likely right than not
        limits[kind] = max(LEAST, boosting.threshold(p[of], pos[of], neg[of], precision)) if of.any() else 1.1
    return Model(trees, limits)


def select_spans(candidates: DataFrame, model: Model, *, base: str = "base", proposed: str = "proposed", to: str = "spans") -> DataFrame:
    """``candidates`` with ``to``: all base spans, and proposals from their
    threshold on that overlap no base span and no proposal of a higher
    score (then: earlier, longer); by kind as in ``ALL_KINDS``, then start."""
    names = list(LEVELS)
    scored = F.transform(
        F.filter(proposed, lambda p: ~F.exists(base, lambda b: (b["start"] < p["end"]) & (b["end"] > p["start"]))),
        lambda p: F.struct(model.trees.column([p[n] for n in names]).alias("score"), p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")),
    )
    limit = lambda p: F.coalesce(*[F.when(p["kind"] == k, F.lit(v)) for k, v in model.limits.items()], F.lit(1.1))
    better = lambda q, p: (q["score"] > p["score"]) | (
        (q["score"] == p["score"]) & ((q["start"] < p["start"]) | ((q["start"] == p["start"]) & ((q["end"] > p["end"]) | ((q["end"] == p["end"]) & (q["kind"] < p["kind"]))))))
    alone = let(
        F.filter(scored, lambda p: p["score"] >= limit(p)),
        lambda ps: F.filter(ps, lambda p: ~F.exists(ps, lambda q: (q["start"] < p["end"]) & (q["end"] > p["start"]) & better(q, p))),
    )
    added = F.transform(alone, lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in ALL_KINDS]), s["kind"])
    ordered = let(F.concat(F.col(base), added), lambda all_: F.transform(F.sort_array(F.transform(all_, lambda s: F.struct(rank(s).alias("r"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    return candidates.withColumn(to, ordered)


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with ``[KIND]`` in place of each span; of overlapping spans the first stands for all."""

    def step(a: Column, s: Column) -> Column:
        until = a["until"]
        out = F.when(s["start"] >= until, F.concat(a["out"], F.substring(text, until + 1, s["start"] - until), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(a["out"])
        return F.struct(out.alias("out"), F.greatest(until, s["end"]).alias("until"))

    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(by_start, F.struct(F.lit("").alias("out"), F.lit(0).alias("until")), step, lambda a: F.concat(a["out"], F.substring(text, a["until"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact_documents(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in ``text``, all columns as they are
    whatever their names.

    Null texts stay null, empty ones empty; very long ones are searched whole.
    Repeated rows stay, an empty table gives an empty one. Texts go to the
    shared folder once, with what was found in them."""
    columns = docs.columns
    base, proposed, taught, spans = fresh(docs, "base", "proposed", "taught", "spans")
    found = materialize(with_candidates(docs, text=text, base=base, proposed=proposed, taught=taught), "candidates")
    model = fit(found, base=base, proposed=proposed, taught=taught)
    found = select_spans(found, model, base=base, proposed=proposed, to=spans)
    return found.withColumn(text, redact(F.col(text), F.col(spans))).select(*columns)
