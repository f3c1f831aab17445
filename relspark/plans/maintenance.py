"""Incremental maintenance: upserts, change detection, cursors, retention, session counters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import maintenance as mt
from .registry import query, table


@query("""WITH n AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_orderkey + 100000000, o_custkey, 'Y', 1.0 FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM n UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.o_orderkey = o.o_orderkey)""")
def upsert_replace(spark, sf_dir):
    """Staged rows replace or extend a table."""
    old = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    new = old.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("X")).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    more = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), "o_custkey", F.lit("Y").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"))
    return mt.upsert(old, new.union(more), ["o_orderkey"]).withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("""WITH a AS (SELECT o_custkey, max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END) AS v, count(*) AS n, max(o_orderdate) AS t FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey, max(CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END) AS v, count(*) AS n, max(o_orderdate) AS t FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT o_custkey, coalesce(b.v, a.v) AS v, CAST(coalesce(a.n, 0) + coalesce(b.n, 0) AS BIGINT) AS evidence FROM a FULL JOIN b USING (o_custkey)""")
def upsert_accumulate(spark, sf_dir):
    """Evidence adds up, known values stand unless a newer one is known."""
    part = lambda k, odd: table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == k).groupBy("o_custkey").agg(F.max(F.when(F.col("o_orderkey") % 2 == odd, F.col("o_orderpriority"))).alias("v"), F.count("*").alias("evidence"), F.max("o_orderdate").alias("at"))
    return mt.accumulate(part("F", 0), part("O", 1), ["o_custkey"], "evidence", "at", ["v"]).select("o_custkey", "v", "evidence")


@query("SELECT o_orderkey + 5 AS o_orderkey FROM orders WHERE (o_orderkey + 5) NOT IN (SELECT o_orderkey FROM orders)")
def insert_absent(spark, sf_dir):
    """Insert if absent."""
    old = table(spark, sf_dir, "orders").select("o_orderkey")
    return mt.insert_absent(old, old.select((F.col("o_orderkey") + 5).alias("o_orderkey")), ["o_orderkey"])


@query("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS a, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END AS b FROM orders), s AS (SELECT o_orderkey, 'S' AS a, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'P' END AS b FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, coalesce(o.a, s.a) AS a, coalesce(o.b, s.b) AS b, CAST(CASE WHEN o.a IS NULL AND s.a IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN o.b IS NULL AND s.b IS NOT NULL THEN 1 ELSE 0 END AS INT) AS filled FROM o LEFT JOIN s USING (o_orderkey)""")
def fill_only_update(spark, sf_dir):
    """Only nulls are filled."""
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    old = orders.select("o_orderkey", F.when(k % 4 != 0, F.col("o_orderstatus")).alias("a"), F.when(k % 6 != 0, F.col("o_orderpriority")).alias("b"))
    staged = orders.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("S").alias("a"), F.when(k % 5 != 0, "P").alias("b"))
    return mt.fill_only(old, staged, "o_orderkey", ["a", "b"])


@query("""WITH n AS (SELECT o_orderkey + CASE WHEN o_orderkey % 50 = 0 THEN 900000 ELSE 0 END AS o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders)
SELECT n.o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderstatus IS NOT DISTINCT FROM o.o_orderstatus AND n.o_totalprice IS NOT DISTINCT FROM o.o_totalprice THEN 'noop' ELSE 'update' END AS action FROM n LEFT JOIN orders o ON n.o_orderkey = o.o_orderkey""")
def change_detect(spark, sf_dir):
    """Insert, update or noop by null-safe comparison."""
    old = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey")
    new = old.select((k + F.when(k % 50 == 0, 900000).otherwise(0)).alias("o_orderkey"), "o_orderstatus", F.when(k % 9 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return mt.changes(old, new, "o_orderkey", ["o_orderstatus", "o_totalprice"]).select("o_orderkey", "action")


@query("SELECT event_id, user_id FROM events WHERE (ts, event_id) > (TIMESTAMP '2024-01-10 00:00:00', 0) ORDER BY ts, event_id LIMIT 500")
def keyset_page(spark, sf_dir):
    """A page behind a cursor."""
    return mt.page_after(table(spark, sf_dir, "events"), ["ts", "event_id"], [F.expr("timestamp_ntz'2024-01-10 00:00:00'"), F.lit(0).cast("long")], 500).select("event_id", "user_id")


@query("SELECT CAST(floor(date_diff('second', TIMESTAMP '2024-01-01', ts) / 1800) AS BIGINT) AS slice, CAST(count(*) AS BIGINT) AS scanned, CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS eligible FROM events GROUP BY 1")
def slice_drain(spark, sf_dir):
    """Half-hour slices with their eligible rows."""
    second = F.floor(F.col("ts").cast("timestamp").cast("double") - F.lit("2024-01-01").cast("timestamp").cast("double"))
    return table(spark, sf_dir, "events").groupBy(F.floor(second / 1800).alias("slice")).agg(F.count("*").alias("scanned"), F.count_if(F.col("event_type") == "purchase").alias("eligible"))


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS doomed FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type IN ('view', 'click') GROUP BY 1")
def retention_counts(spark, sf_dir):
    """What a retention rule would remove."""
    _, gone = mt.doomed(table(spark, sf_dir, "events"), (F.col("ts") < F.expr("timestamp_ntz'2024-01-20 00:00:00'")) & F.col("event_type").isin("view", "click"))
    return gone.groupBy("event_type").agg(F.count("*").alias("doomed"))


@query("""WITH g AS (SELECT *, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) <= 7200 THEN 0 ELSE 1 END AS cut FROM events), s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts) AS ses FROM g), n AS (SELECT *, row_number() OVER (PARTITION BY user_id, ses ORDER BY ts) AS n FROM s)
SELECT event_id, CAST((n - 1) % 3 + 1 AS INT) AS "count", (n - 1) % 3 + 1 = 3 AS fires FROM n""")
def autoplay_counter(spark, sf_dir):
    """A counter that fires at its threshold and restarts after a gap."""
    return mt.session_counter(table(spark, sf_dir, "events"), ["user_id"], "ts", 7200, 3).select("event_id", "count", "fires")


@query("""WITH b AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY d) AS total FROM b), x AS (SELECT *, coalesce(max(CASE WHEN total >= 10 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM r) SELECT user_id, CAST(d AS VARCHAR) AS d, CAST(n AS BIGINT) AS n FROM x WHERE done = 0""")
def early_exit(spark, sf_dir):
    """Batches in order of arrival until the running total is enough."""
    b = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").cast("string").alias("d")).agg(F.count("*").alias("n"))
    b = b.withColumn("total", F.sum("n").over(Window.partitionBy("user_id").orderBy("d")))
    return mt.early_exit(b, "user_id", "d", F.col("total") >= 10).select("user_id", "d", "n")


@query("""SELECT event_type, CAST(count(*) FILTER (value <= 60) AS BIGINT) AS arrived, CAST(count(*) FILTER (value > 60) AS BIGINT) AS pending FROM events GROUP BY 1""")
def deadline_collect(spark, sf_dir):
    """Results before a deadline, and how many are still pending."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(F.col("value") <= 60).alias("arrived"), F.count_if(F.col("value") > 60).alias("pending"))


@query("""SELECT c_custkey, coalesce(TRY_CAST(CASE WHEN c_custkey % 4 = 0 THEN 'bad' ELSE CAST(c_nationkey AS VARCHAR) END AS INT), -1) AS nation FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 10 < 7)""")
def salvage_rows(spark, sf_dir):
    """Rows that the live table lacks, cast or defaulted."""
    old = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, "bad").otherwise(F.col("c_nationkey").cast("string")).alias("nation"))
    live = table(spark, sf_dir, "orders").where(F.col("o_custkey") % 10 < 7).select(F.col("o_custkey").alias("c_custkey")).distinct()
    return mt.salvage(old, live, "c_custkey", {"nation": ("int", -1)})
