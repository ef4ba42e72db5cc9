"""Scalar functions: strings, numbers, conditions, casts, date and time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import compat
from . import query, same

N, P, C, Q = (lambda e: e.set("nation")), (lambda e: e.set("part")), (lambda e: e.set("customer")), (lambda e: e.set("orders"))
c = F.col

# strings
same("str_case", "SELECT n_nationkey, UPPER(n_name) AS u, LOWER(n_name) AS l FROM nation")
query("str_length", "SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS n FROM part")(lambda e: e.sql("SELECT p_partkey, CHARACTER_LENGTH(p_name) AS n FROM part"))
same("str_replace", "SELECT p_partkey, REPLACE(p_name, 'a', '_') AS r FROM part")
query("str_position", "SELECT p_partkey, CAST(POSITION('e' IN p_name) AS INTEGER) AS p, CAST(CASE WHEN strpos(p_name[3:], 'e') > 0 THEN strpos(p_name[3:], 'e') + 2 ELSE 0 END AS INTEGER) AS p3 FROM part")(
    lambda e: e.sql("SELECT p_partkey, POSITION('e' IN p_name) AS p, POSITION('e' IN p_name FROM 3) AS p3 FROM part")
)
query("str_index_of", "SELECT p_partkey, CAST(strpos(p_name, 'a') - 1 AS INTEGER) AS i FROM part")(lambda e: P(e).select("p_partkey", i=e.functions.index_of(c("p_name"), "a")))
query("str_substring", "SELECT p_partkey, SUBSTRING(p_name, 2, 3) AS a, SUBSTRING(p_name, 4) AS b FROM part")(lambda e: P(e).select("p_partkey", a=compat.substring0(c("p_name"), 1, 3), b=compat.substring0(c("p_name"), 3)))
same("str_trim", "SELECT r_regionkey, TRIM(s) AS t, LTRIM(s) AS l, RTRIM(s) AS r FROM (SELECT r_regionkey, '  ' || r_name || '  ' AS s FROM region) x")
query("str_trim_char", "SELECT r_regionkey, TRIM(s, 'x') AS b, LTRIM(s, 'x') AS l, RTRIM(s, 'x') AS r FROM (SELECT r_regionkey, 'xx' || r_name || 'x' AS s FROM region) t")(
    lambda e: e.sql("SELECT r_regionkey, TRIM(BOTH 'x' FROM s) AS b, TRIM(LEADING 'x' FROM s) AS l, TRIM(TRAILING 'x' FROM s) AS r FROM (SELECT r_regionkey, 'xx' || r_name || 'x' AS s FROM region) t")
)
same("str_concat", "SELECT n_nationkey, n_name || '-' || CAST(n_regionkey AS VARCHAR(10)) AS s FROM nation")
query("str_concat2", "SELECT c_custkey, COALESCE(o, '') || COALESCE(c_name, '') AS s FROM (SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN 'rich ' END AS o FROM customer) t")(
    lambda e: e.sql("SELECT c_custkey, CONCAT2(o, c_name) AS s FROM (SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN 'rich ' END AS o FROM customer) t")
)


def _predicate(name: str, call: str, sql: str) -> None:
    query(name, f"SELECT n_nationkey, {sql} AS yes FROM nation")(lambda e: e.sql(f"SELECT n_nationkey, {call} AS yes FROM nation"))


_predicate("str_starts", "STARTS_WITH(n_name, 'A')", "starts_with(n_name, 'A')")
_predicate("str_ends", "ENDS_WITH(n_name, 'A')", "ends_with(n_name, 'A')")
_predicate("str_contains", "CONTAINS_SUBSTR(n_name, 'I_')", "contains(n_name, 'I_')")
same("str_reverse", "SELECT n_nationkey, REVERSE(n_name) AS r FROM nation")
query("str_null_or_empty", "SELECT c_custkey FROM (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_name WHEN c_acctbal > 0 THEN '' END AS s FROM customer) t WHERE s IS NULL OR length(s) = 0")(
    lambda e: C(e).extend(s=F.when(c("c_acctbal") > 5000, c("c_name")).when(c("c_acctbal") > 0, F.lit(""))).where(compat.is_null_or_empty(c("s"))).select("c_custkey")
)
query("str_null_or_ws", "SELECT c_custkey FROM (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_name WHEN c_acctbal > 0 THEN '  ' END AS s FROM customer) t WHERE s IS NULL OR length(trim(s)) = 0")(
    lambda e: C(e).extend(s=F.when(c("c_acctbal") > 5000, c("c_name")).when(c("c_acctbal") > 0, F.lit("  "))).where(compat.is_null_or_white_space(c("s"))).select("c_custkey")
)
query("str_first_last_char", "SELECT n_nationkey, n_name[1] AS f, n_name[-1] AS l FROM nation")(lambda e: N(e).select("n_nationkey", f=compat.first_char(c("n_name")), l=compat.last_char(c("n_name"))))
query("cast_to_string", "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS l, CAST(p_size AS VARCHAR) AS i, CAST(p_size > 10 AS VARCHAR) AS b, CAST(CAST(p_retailprice AS DECIMAL(19,4)) AS VARCHAR) AS m FROM part")(
    lambda e: e.sql("SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS l, CAST(p_size AS VARCHAR) AS i, CAST(p_size > 10 AS VARCHAR) AS b, CAST(CAST(p_retailprice AS DECIMAL(19,4)) AS VARCHAR) AS m FROM part")
)
query("regex_match", "SELECT p_partkey, regexp_matches(p_name, '^[a-m].*e') AS yes FROM part")(lambda e: P(e).select("p_partkey", yes=c("p_name").rlike("^[a-m].*e")))
query("str_similar", "SELECT n_nationkey, regexp_full_match(n_name, '(?:A|B).*') AS yes FROM nation")(lambda e: e.sql("SELECT n_nationkey, n_name SIMILAR TO '(A|B)%' AS yes FROM nation"))
query("str_join", "SELECT n_regionkey, string_agg(n_name, '; ' ORDER BY n_name) AS s FROM nation GROUP BY n_regionkey")(lambda e: N(e).group_by("n_regionkey").agg(s=F.concat_ws("; ", F.sort_array(F.collect_list("n_name")))))
query("str_misc", "SELECT n_nationkey, translate(n_name, 'AEI', 'aei') AS t, split_part(n_name, 'A', 1) AS sp, lpad(n_name, 12, '*') AS lp, rpad(n_name, 12, '*') AS rp, repeat(substr(n_name, 1, 1), 3) AS rep, ascii(n_name) AS a FROM nation")(
    lambda e: N(e).select("n_nationkey", t=e.functions.translate("n_name", "AEI", "aei"), sp=F.substring_index("n_name", "A", 1), lp=F.lpad("n_name", 12, "*"), rp=F.rpad("n_name", 12, "*"), rep=F.repeat(F.substring("n_name", 1, 1), 3), a=F.ascii("n_name"))
)
query("str_overlay", "SELECT n_nationkey, substr(n_name, 1, 1) || 'ZZ' || substr(n_name, 4) AS o, substr(n_name, 2, 2) AS f FROM nation")(lambda e: e.sql("SELECT n_nationkey, OVERLAY(n_name PLACING 'ZZ' FROM 2 FOR 2) AS o, SUBSTRING(n_name FROM 2 FOR 2) AS f FROM nation"))
query("str_ws_blank", "SELECT c_custkey, COALESCE(o, '') || '/' || c_name AS s FROM (SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN 'x' END AS o FROM customer) t")(
    lambda e: C(e).extend(o=F.when(c("c_acctbal") > 0, F.lit("x"))).select("c_custkey", s=e.functions.concat_ws_mssql("/", c("o"), c("c_name")))
)

# numbers
same("math_abs", "SELECT c_custkey, ABS(c_acctbal) AS a FROM customer")
query("math_ceil_floor", "SELECT c_custkey, CAST(CEIL(c_acctbal) AS BIGINT) AS u, CAST(FLOOR(c_acctbal) AS BIGINT) AS d FROM customer")(lambda e: e.sql("SELECT c_custkey, CEILING(c_acctbal) AS u, FLOOR(c_acctbal) AS d FROM customer"))
query("math_logs", "SELECT p_partkey, ROUND(EXP(p_size / 10.0), 9) AS e, ROUND(LN(p_size), 9) AS n, ROUND(LOG10(p_size), 9) AS t, ROUND(LOG2(p_size), 9) AS w, ROUND(LOG(3, p_size), 9) AS b FROM part")(
    lambda e: P(e).select("p_partkey", e=F.round(F.exp(c("p_size") / 10.0), 9), n=F.round(F.ln("p_size"), 9), t=F.round(F.log10("p_size"), 9), w=F.round(F.log2("p_size"), 9), b=F.round(F.log(3.0, c("p_size")), 9))
)
same("math_roots", "SELECT p_partkey, ROUND(SQRT(p_size), 9) AS s, ROUND(CBRT(p_size), 9) AS cb, ROUND(POWER(p_size, 1.5), 6) AS p FROM part")
same("math_round", "SELECT p_partkey, ROUND(p_retailprice, 1) AS a, ROUND(p_retailprice) AS b FROM part")
query("math_bround", "SELECT p_partkey, CAST(CASE WHEN abs(x * 10 - trunc(x * 10)) = 0.5 THEN CAST(trunc(x * 10) + CASE WHEN CAST(trunc(x * 10) AS BIGINT) % 2 = 0 THEN 0 ELSE sign(x) END AS DECIMAL(19,4)) / 10 ELSE round(x, 1) END AS DECIMAL(17,1)) AS r FROM (SELECT p_partkey, CAST(p_retailprice AS DECIMAL(19,4)) AS x FROM part) t")(lambda e: P(e).select("p_partkey", r=F.bround(c("p_retailprice").cast("decimal(19,4)"), 1)))
query("math_trunc", "SELECT c_custkey, CAST(trunc(c_acctbal) AS DOUBLE) AS t FROM customer")(lambda e: C(e).select("c_custkey", t=compat.truncate(c("c_acctbal"))))
query("math_sign", "SELECT c_custkey, CAST(SIGN(c_acctbal) AS INTEGER) AS s FROM customer")(lambda e: C(e).select("c_custkey", s=e.functions.sign(c("c_acctbal"))))
same("math_trig", "SELECT p_partkey, ROUND(SIN(p_size), 9) AS s, ROUND(COS(p_size), 9) AS co, ROUND(TAN(p_size), 6) AS t, ROUND(ASIN(p_size / 100.0), 9) AS sa, ROUND(ACOS(p_size / 100.0), 9) AS ca, ROUND(ATAN(p_size), 9) AS ta, ROUND(ATAN2(p_size, 3), 9) AS t2 FROM part")
same("math_hyper", "SELECT p_partkey, ROUND(SINH(p_size / 50.0), 9) AS s, ROUND(COSH(p_size / 50.0), 9) AS co, ROUND(TANH(p_size / 50.0), 9) AS t, ROUND(ASINH(p_size), 9) AS sa, ROUND(ACOSH(p_size + 1), 9) AS ca, ROUND(ATANH(p_size / 100.0), 9) AS ta FROM part")
same("math_angle", "SELECT p_partkey, ROUND(DEGREES(p_size), 6) AS d, ROUND(RADIANS(p_size), 9) AS r FROM part")
query("arith_basic", "SELECT p_partkey, p_size + 7 AS a, p_size - 7 AS s, p_size * 3 AS m, CAST(p_size // 7 AS BIGINT) AS d, ROUND(p_retailprice / 7, 6) AS f FROM part")(
    lambda e: P(e).select("p_partkey", a=c("p_size") + 7, s=c("p_size") - 7, m=c("p_size") * 3, d=e.functions.divide(c("p_size"), 7), f=F.round(c("p_retailprice") / 7, 6))
)
same("arith_mod", "SELECT p_partkey, MOD(p_size, 7) AS m, (0 - p_size) % 7 AS n FROM part")
same("arith_unary", "SELECT c_custkey, -c_acctbal AS n, +c_acctbal AS p FROM customer")
query("bit_ops", "SELECT p_partkey, p_size & 12 AS a, p_size | 12 AS o, xor(p_size, 12) AS x, ~p_size AS n FROM part")(lambda e: e.sql("SELECT p_partkey, BITAND(p_size, 12) AS a, BITOR(p_size, 12) AS o, BITXOR(p_size, 12) AS x, BITNOT(p_size) AS n FROM part"))
query("bool_xor", "SELECT p_partkey, (p_size > 10) <> (p_retailprice > 1000) AS x FROM part")(lambda e: P(e).select("p_partkey", x=e.functions.xor(c("p_size") > 10, c("p_retailprice") > 1000)))
query("bit_shift", "SELECT p_partkey, CAST(p_size * 8 AS INTEGER) AS l, CAST(p_size // 4 AS INTEGER) AS r FROM part")(lambda e: P(e).select("p_partkey", l=compat.shift_left(c("p_size"), 3), r=compat.shift_right(c("p_size"), 2)))
query("greatest_least", "SELECT c_custkey, CASE WHEN x IS NOT NULL THEN GREATEST(x, c_nationkey, 5) END AS g, CASE WHEN x IS NOT NULL THEN LEAST(x, c_nationkey, 5) END AS l, GREATEST(x, c_nationkey) AS pg FROM (SELECT *, CASE WHEN c_acctbal > 0 THEN 12 END AS x FROM customer) t")(
    lambda e: C(e).extend(x=F.when(c("c_acctbal") > 0, F.lit(12))).select("c_custkey", g=e.functions.greatest(c("x"), c("c_nationkey"), 5), l=e.functions.least(c("x"), c("c_nationkey"), 5), pg=e.functions.greatest_pg(c("x"), c("c_nationkey")))
)

# conditions and casts
same("case_when", "SELECT p_partkey, CASE WHEN p_retailprice < 950 THEN 'Cheap' WHEN p_retailprice < 1300 THEN 'Mid' ELSE 'Expensive' END AS label FROM part")
query("cond_if", "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS s FROM part")(lambda e: e.sql("SELECT p_partkey, IF(p_size > 25, 'big', 'small') AS s FROM part"))
query("null_nvl", "SELECT c_custkey, COALESCE(x, -1) AS a, CASE WHEN x IS NOT NULL THEN 1 ELSE 0 END AS b FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_nationkey END AS x FROM customer) t")(
    lambda e: e.sql("SELECT c_custkey, NVL(x, -1) AS a, NVL2(x, 1, 0) AS b FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_nationkey END AS x FROM customer) t")
)
same("null_nullif", "SELECT n_nationkey, NULLIF(n_regionkey, 2) AS r FROM nation")
same("null_coalesce", "SELECT c_custkey, COALESCE(CASE WHEN c_acctbal > 9000 THEN 'top' END, CASE WHEN c_acctbal > 0 THEN 'plus' END, 'rest') AS s FROM customer")
query("cast_numeric", "SELECT c_custkey, CAST(trunc(c_acctbal) AS INTEGER) AS i, CAST(c_nationkey AS DOUBLE) AS d, CAST(c_acctbal AS DECIMAL(19,4)) AS m FROM customer")(lambda e: C(e).select("c_custkey", i=c("c_acctbal").cast("int"), d=c("c_nationkey").cast("double"), m=c("c_acctbal").cast("decimal(19,4)")))
query("cast_string_num", "SELECT p_partkey, CAST(CAST(p_size AS VARCHAR) AS INTEGER) AS i, CAST('12.5' AS DOUBLE) AS d, CAST('true' AS BOOLEAN) AS b FROM part")(lambda e: e.sql("SELECT p_partkey, CAST(CAST(p_size AS VARCHAR) AS INTEGER) AS i, CAST('12.5' AS DOUBLE) AS d, CAST('true' AS BOOLEAN) AS b FROM part"))
query("cast_string_date", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS d FROM orders")(lambda e: Q(e).select("o_orderkey", d=F.date_format("o_orderdate", "yyyy-MM-dd").cast("date")))
query("safe_cast", "SELECT p_partkey, TRY_CAST(CASE WHEN p_size > 25 THEN 'x' ELSE CAST(p_size AS VARCHAR) END AS INTEGER) AS i FROM part")(lambda e: e.sql("SELECT p_partkey, SAFE_CAST(CASE WHEN p_size > 25 THEN 'x' ELSE CAST(p_size AS VARCHAR) END AS INTEGER) AS i FROM part"))
query("convert_all", "SELECT p_partkey, CAST(p_size > 25 AS INTEGER) AS i, CAST(p_size AS BIGINT) AS l, CAST(p_size AS DOUBLE) AS d, CAST(p_size AS VARCHAR) AS s, p_size <> 0 AS b, CAST(p_size AS DECIMAL(19,4)) AS m FROM part")(
    lambda e: P(e).select("p_partkey", i=compat.convert(c("p_size") > 25, "int"), l=compat.convert(c("p_size"), "bigint"), d=compat.convert(c("p_size"), "double"), s=compat.convert(c("p_size"), "string"), b=compat.convert(c("p_size"), "boolean"), m=compat.convert(c("p_size"), "decimal(19,4)"))
)
query("decode_pairs", "SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE 'more' END AS d FROM nation")(lambda e: N(e).select("n_nationkey", d=e.functions.decode(c("n_regionkey"), 0, "zero", 1, "one", "more")))
query("enum_has_flag", "SELECT p_partkey, (p_size & 6) = 6 AS yes FROM part")(lambda e: P(e).select("p_partkey", yes=e.functions.has_flag(c("p_size"), F.lit(6))))
query("period_overlaps", "SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.o_orderdate < b.o_orderdate + INTERVAL 30 DAY AND b.o_orderdate < a.o_orderdate + INTERVAL 30 DAY")(lambda e: _overlaps(e))


def _overlaps(e):
    span = F.expr("INTERVAL '30' DAY")
    b = Q(e).df.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("b"), F.col("o_orderdate").alias("s2"))
    pairs = Q(e).join_on(b, (c("o_custkey") == c("k")) & (c("o_orderkey") < c("b")) & e.functions.overlaps(c("o_orderdate"), c("o_orderdate") + span, c("s2"), c("s2") + span))
    return pairs.select("b", a=c("o_orderkey"))


# date and time
same("tmp_compare", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1995-07-01 00:00:00'")
query("tmp_parts", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS d, CAST(dayofyear(o_orderdate) AS INTEGER) AS dy, CAST(dayofweek(o_orderdate) AS INTEGER) AS dw, CAST(hour(o_orderdate) AS INTEGER) AS h, CAST(o_orderdate AS DATE) AS dt FROM orders")(
    lambda e: Q(e).select("o_orderkey", y=compat.part(c("o_orderdate"), "Year"), m=compat.part(c("o_orderdate"), "Month"), d=compat.part(c("o_orderdate"), "Day"), dy=compat.part(c("o_orderdate"), "DayOfYear"), dw=compat.part(c("o_orderdate"), "DayOfWeek"), h=compat.part(c("o_orderdate"), "Hour"), dt=compat.part(c("o_orderdate"), "Date"))
)
query("tmp_time_parts", "SELECT event_id, CAST(minute(ts) AS INTEGER) AS mi, CAST(second(ts) AS INTEGER) AS s, CAST(epoch_us(ts) % 1000000 // 1000 AS INTEGER) AS ms, CAST(epoch_us(ts) % 86400000000 AS BIGINT) AS tod FROM events")(
    lambda e: e.set("events").select("event_id", mi=compat.part(c("ts"), "Minute"), s=compat.part(c("ts"), "Second"), ms=compat.part(c("ts"), "Millisecond"), tod=compat.part(c("ts"), "TimeOfDay"))
)
query("tmp_add", "SELECT o_orderkey, o_orderdate + INTERVAL 3 DAY AS d, o_orderdate + INTERVAL 2 MONTH AS m, o_orderdate + INTERVAL 1 YEAR AS y, o_orderdate + INTERVAL 5 HOUR AS h FROM orders")(
    lambda e: Q(e).select("o_orderkey", d=c("o_orderdate") + F.expr("INTERVAL '3' DAY"), m=c("o_orderdate") + F.expr("INTERVAL '2' MONTH"), y=c("o_orderdate") + F.expr("INTERVAL '1' YEAR"), h=c("o_orderdate") + F.expr("INTERVAL '5' HOUR"))
)
query("tmp_diff", "SELECT l_orderkey, l_linenumber, CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey")(
    lambda e: e.set("lineitem").join(e.set("orders"), "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber", days=F.datediff("l_shipdate", "o_orderdate"))
)
query("tmp_unix", "SELECT event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS s FROM events")(lambda e: e.set("events").select("event_id", ms=e.functions.unix_millis(c("ts")), s=F.unix_seconds(c("ts").cast("timestamp"))))
query("tmp_day_number", "SELECT o_orderkey, CAST(date_diff('day', DATE '0001-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS n FROM orders")(lambda e: Q(e).select("o_orderkey", n=compat.day_number(F.to_date("o_orderdate"))))
query("tmp_timespan", "SELECT l_orderkey, l_linenumber, CAST(date_part('day', l_shipdate - o_orderdate) AS INTEGER) AS d, CAST(date_part('hour', l_shipdate - o_orderdate) AS INTEGER) AS h FROM lineitem JOIN orders ON l_orderkey = o_orderkey")(lambda e: e.set("lineitem").join(e.set("orders"), "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber", d=F.expr("CAST(extract(DAY FROM l_shipdate - o_orderdate) AS INT)"), h=F.expr("CAST(extract(HOUR FROM l_shipdate - o_orderdate) AS INT)")))
query("tmp_time_between", "SELECT event_id FROM events WHERE epoch_us(ts) % 86400000000 >= 79200000000 OR epoch_us(ts) % 86400000000 < 21600000000")(lambda e: e.set("events").where(compat.time_between(compat.part(c("ts"), "TimeOfDay"), F.lit(22 * 3600 * 10**6), F.lit(6 * 3600 * 10**6))).select("event_id"))
query("tmp_now", "SELECT TRUE AS ok")(lambda e: e.sql("SELECT CURRENT_TIMESTAMP >= TIMESTAMP '2020-01-01' AND CURRENT_DATE >= DATE '2020-01-01' AS ok"))
query("date_trunc_month", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS m, CAST(date_trunc('hour', o_orderdate) AS TIMESTAMP) AS h FROM orders")(
    lambda e: e.sql("SELECT o_orderkey, CAST(FLOOR(o_orderdate TO MONTH) AS TIMESTAMP_NTZ) AS m, CAST(FLOOR(o_orderdate TO HOUR) AS TIMESTAMP_NTZ) AS h FROM orders")
)
query("tmp_timestampdiff", "SELECT o_orderkey, CAST(date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) AS BIGINT) AS d FROM orders")(lambda e: e.sql("SELECT o_orderkey, TIMESTAMPDIFF(DAY, TIMESTAMP_NTZ '1992-01-01 00:00:00', o_orderdate) AS d FROM orders"))
query("guid_new", "SELECT COUNT(*) AS n, COUNT(*) AS distinct_keys, TRUE AS well_formed FROM nation")(
    lambda e: N(e).extend(g=F.expr("uuid()")).agg(n=F.count("g"), distinct_keys=F.countDistinct("g"), well_formed=F.bool_and(c("g").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")))
)
query("bytes_ops", "SELECT n_nationkey, CAST(octet_length(encode(n_name)) AS INTEGER) AS n, upper(hex(encode(n_name[1]))) AS first_byte, contains(n_name, 'A') AS has, upper(hex(encode(n_name))) AS whole FROM nation")(
    lambda e: N(e).select("n_nationkey", n=F.octet_length(c("n_name").cast("binary")), first_byte=F.hex(F.substring(c("n_name").cast("binary"), 1, 1)), has=F.contains(c("n_name").cast("binary"), F.lit(b"A")), whole=F.hex(c("n_name").cast("binary")))
)
query("ext_registered", "SELECT n_nationkey, length(n_name) * 2 AS n FROM nation")(lambda e: (e.functions.register("TWICE_LENGTH", lambda x: (F.length(x) * 2).cast("bigint")), N(e).select("n_nationkey", n=e.functions.twice_length(c("n_name"))))[1])
