"""Window functions, time windows over batches, row patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.matching import match_recognize
from ...operators.windows import UNBOUNDED_AFTER, UNBOUNDED_BEFORE, hop, match_runs, over, session, snapshot, tumble
from ...streaming.windows import windowed
from . import query

_BY = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"


def _orders(e):
    return over(["o_custkey"], ["o_orderdate", "o_orderkey"])


query("win_row_number", f"SELECT o_orderkey, CAST(ROW_NUMBER() {_BY} AS INTEGER) AS n FROM orders")(lambda e: e.set("orders").select("o_orderkey", n=F.row_number().over(_orders(e))))
query("win_rank", "SELECT p_partkey, CAST(RANK() OVER (PARTITION BY p_brand ORDER BY p_size) AS INTEGER) AS r, CAST(DENSE_RANK() OVER (PARTITION BY p_brand ORDER BY p_size) AS INTEGER) AS d FROM part")(
    lambda e: e.set("part").select("p_partkey", r=F.rank().over(over(["p_brand"], ["p_size"])), d=F.dense_rank().over(over(["p_brand"], ["p_size"])))
)
query("win_dist", "SELECT p_partkey, ROUND(PERCENT_RANK() OVER (PARTITION BY p_brand ORDER BY p_size), 9) AS pr, ROUND(CUME_DIST() OVER (PARTITION BY p_brand ORDER BY p_size), 9) AS cd FROM part")(
    lambda e: e.set("part").select("p_partkey", pr=F.round(F.percent_rank().over(over(["p_brand"], ["p_size"])), 9), cd=F.round(F.cume_dist().over(over(["p_brand"], ["p_size"])), 9))
)
query("win_ntile", "SELECT p_partkey, CAST(NTILE(4) OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS INTEGER) AS q FROM part")(lambda e: e.set("part").select("p_partkey", q=F.ntile(4).over(over(["p_brand"], ["p_size", "p_partkey"]))))
query("win_lead_lag", f"SELECT o_orderkey, LEAD(o_totalprice) {_BY} AS nx, LAG(o_totalprice, 2, -1.0) {_BY} AS pv FROM orders")(
    lambda e: e.set("orders").select("o_orderkey", nx=F.lead("o_totalprice").over(_orders(e)), pv=F.lag("o_totalprice", 2, -1.0).over(_orders(e)))
)
_WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
query("win_first_last", f"SELECT o_orderkey, FIRST_VALUE(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey {_WHOLE}) AS f, LAST_VALUE(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey {_WHOLE}) AS l FROM orders")(
    lambda e: (lambda w: e.set("orders").select("o_orderkey", f=F.first("o_orderkey").over(w), l=F.last("o_orderkey").over(w)))(over(["o_custkey"], ["o_orderdate", "o_orderkey"], rows=(UNBOUNDED_BEFORE, UNBOUNDED_AFTER)))
)
query("win_nth", f"SELECT o_orderkey, NTH_VALUE(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey {_WHOLE}) AS n2 FROM orders")(
    lambda e: e.set("orders").select("o_orderkey", n2=F.nth_value("o_orderkey", 2).over(over(["o_custkey"], ["o_orderdate", "o_orderkey"], rows=(UNBOUNDED_BEFORE, UNBOUNDED_AFTER))))
)
query("win_ignore_nulls", "SELECT o_orderkey, LAST_VALUE(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_f FROM orders")(
    lambda e: e.sql("SELECT o_orderkey, LAST_VALUE(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) IGNORE NULLS OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_f FROM orders")
)
query("win_sum_rows", "SELECT o_orderkey, ROUND(SUM(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS s FROM orders")(
    lambda e: e.set("orders").select("o_orderkey", s=F.round(F.sum("o_totalprice").over(over(["o_custkey"], ["o_orderdate", "o_orderkey"], rows=(-2, 0))), 2))
)
query("win_avg_range", "SELECT p_partkey, ROUND(AVG(p_retailprice) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING), 4) AS a FROM part")(
    lambda e: e.set("part").select("p_partkey", a=F.round(F.avg("p_retailprice").over(over(["p_brand"], ["p_size"], range_=(-2, 2))), 4))
)
query("win_topn_group", "SELECT n_nationkey, c_custkey FROM (SELECT c_nationkey AS n_nationkey, c_custkey, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) t WHERE r <= 3")(
    lambda e: e.set("customer").take_by(3, ["c_nationkey"], F.desc("c_acctbal"), F.asc("c_custkey")).select("c_custkey", n_nationkey=F.col("c_nationkey"))
)
query("win_over_group", "SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total FROM customer GROUP BY c_mktsegment")(
    lambda e: e.sql("SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total FROM customer GROUP BY c_mktsegment")
)

_TUMBLE = "SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2, 3"
query("tumble_events", _TUMBLE)(lambda e: windowed(e.set("events").df, "ts", tumble("ts", "1 hour"), ["event_type"], n=F.count(F.lit(1))))
query("hop_events", """
SELECT s AS window_start, s + INTERVAL '1 hour' AS window_end, COUNT(*) AS n
FROM (SELECT time_bucket(INTERVAL '30 minutes', ts, TIMESTAMP '1970-01-01') - INTERVAL '30 minutes' * k AS s FROM events, (VALUES (0), (1)) t(k)) x GROUP BY s""")(
    lambda e: windowed(e.set("events").df, "ts", hop("ts", "1 hour", "30 minutes"), [], n=F.count(F.lit(1)))
)
query("session_events", """
WITH m AS (SELECT user_id, ts, CASE WHEN ts < LAG(ts) OVER w + INTERVAL '30 minutes' THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, SUM(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT user_id, MIN(ts) AS window_start, MAX(ts) + INTERVAL '30 minutes' AS window_end, COUNT(*) AS n FROM s GROUP BY user_id, g""")(
    lambda e: windowed(e.set("events").df, "ts", session("ts", "30 minutes"), ["user_id"], n=F.count(F.lit(1)))
)
query("snapshot_rows", "SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate <= TIMESTAMP '1997-01-01' AND (l_shipdate IS NULL OR l_shipdate > TIMESTAMP '1997-01-01')")(
    lambda e: snapshot(e.set("lineitem").join(e.set("orders"), "l_orderkey", "o_orderkey").df, F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"), "o_orderdate", "l_shipdate").select("l_orderkey", "l_linenumber")
)
query("match_simple", """
WITH m AS (SELECT o_custkey, o_orderdate, o_orderkey, coalesce(o_totalprice > LAG(o_totalprice) OVER w, FALSE) AS up FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
b AS (SELECT *, up AND NOT coalesce(LAG(up) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), FALSE) AS begins FROM m),
r AS (SELECT *, SUM(CAST(begins AS INTEGER)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS g FROM b),
k AS (SELECT o_custkey, g, MIN(o_orderdate) AS first_at, MAX(o_orderdate) AS last_at, COUNT(*) AS length FROM r WHERE up GROUP BY o_custkey, g HAVING COUNT(*) >= 2)
SELECT o_custkey, first_at, last_at, length, CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY first_at, g) AS INTEGER) AS match_number FROM k""")(
    lambda e: match_runs(e.set("orders").df, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_totalprice") > F.lag("o_totalprice").over(_orders(e)), least=2)
)


_UP = "FROM (SELECT o_custkey, o_orderdate, o_orderkey, coalesce(o_totalprice > LAG(o_totalprice) OVER w, FALSE) AS up, ROW_NUMBER() OVER w AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) t"
query("match_pattern", f"""
WITH m AS (SELECT *, n - ROW_NUMBER() OVER (PARTITION BY o_custkey, up ORDER BY n) AS g {_UP}),
r AS (SELECT o_custkey, MIN(n) AS b, MAX(n) AS e, arg_min(o_orderkey, n) AS first_o_orderkey, arg_max(o_orderkey, n) AS last_o_orderkey, COUNT(*) AS length FROM m WHERE up GROUP BY o_custkey, g HAVING COUNT(*) >= 2)
SELECT o_custkey, first_o_orderkey, last_o_orderkey, length, CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY b) AS INTEGER) AS match_number, repeat('UP', CAST(length AS INTEGER)) AS classifiers FROM r""")(
    lambda e: match_recognize(
        e.set("orders").df.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), partition=["o_custkey"], order=["o_orderdate", "o_orderkey"], pattern="UP{2,}",
        define={"UP": F.col("o_totalprice") > F.lag("o_totalprice").over(_orders(e))},
    ).drop("first_o_orderdate", "last_o_orderdate")
)
