"""Tables and indexes that are kept current by batches of changes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.postings import PostingIndex
from ..sources.shared import shared_dir
from ..streaming import answers as ans
from .registry import query, table

_KEEPS = "p_partkey % 7 > 0 OR p_partkey % 14 = 7"
_TEXT = """CASE WHEN p_partkey % 14 = 7 THEN concat('back ', p_name) WHEN p_partkey % 5 = 1 THEN concat(p_brand, ' ', p_type, ' ', p_brand) WHEN p_partkey % 10 = 9 THEN concat('new ', p_name)
    ELSE concat(p_name, ' ', p_brand) END"""


@query(f"""WITH t AS (SELECT p_partkey AS key, unnest(list_distinct(list_filter(regexp_split_to_array(lower({_TEXT}), '[^a-z0-9]+'), lambda w: w <> ''))) AS token FROM part WHERE {_KEEPS}),
s AS (SELECT key FROM t GROUP BY key HAVING count(*) FILTER (token = 'ring') > 0 AND count(*) FILTER (starts_with(token, 'brand')) > 0)
SELECT t.key, token, s.key IS NOT NULL AS found FROM t LEFT JOIN s ON s.key = t.key""")
def index_upkeep(spark, sf_dir):
    """A token index after batches that insert, replace, delete and bring back, compacted between them: as if built anew."""
    part = table(spark, sf_dir, "part")
    index = PostingIndex(spark, f"{shared_dir(spark)}/postings-{uuid.uuid4().hex}")
    k = F.col("p_partkey")
    keyed = lambda rows, text: rows.select(k.alias("key"), text.alias("text"))
    index.apply(keyed(part.where(k % 10 != 9), F.concat("p_name", F.lit(" "), "p_brand")))
    gone, other = part.where(k % 7 == 0), part.where((k % 7 > 0) & (k % 5 == 1))
    index.apply(keyed(gone, F.lit(None).cast("string")).unionByName(keyed(other, F.concat_ws(" ", "p_brand", "p_type", "p_brand"))))
    index.compact()
    new, back = part.where((k % 10 == 9) & (k % 7 > 0)), part.where(k % 14 == 7)
    index.apply(keyed(new, F.concat(F.lit("new "), "p_name")).unionByName(keyed(back, F.concat(F.lit("back "), "p_name"))))
    found = index.search(["ring"], ["Brand"]).withColumn("found", F.lit(True))
    return index.live().join(found, "key", "left").withColumn("found", F.coalesce("found", F.lit(False)))


_WALK = """e AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS sec, CASE WHEN event_type = 'purchase' THEN CASE WHEN value < 20 THEN '' ELSE 'a' || CAST(event_id AS VARCHAR) END END AS answer FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sec, (answer IS NULL), event_id) AS n FROM e),
walk(user_id, n, event_id, ask, hit, shown, held, ends, touched, touched_ends, touched_hit) AS (
    SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(-1 AS BIGINT), false, false, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(0 AS DOUBLE), CAST(NULL AS VARCHAR), CAST(0 AS DOUBLE), false FROM e
    UNION ALL SELECT w.user_id, n.n, n.event_id, n.answer IS NULL, n.answer IS NULL AND held IS NOT NULL AND sec < ends, CASE WHEN n.answer IS NULL AND held IS NOT NULL AND sec < ends THEN held END,
        CASE WHEN n.answer <> '' THEN n.answer ELSE held END, CASE WHEN n.answer <> '' THEN sec + 90000 ELSE ends END,
        CASE WHEN n.answer <> '' THEN n.answer ELSE touched END, CASE WHEN n.answer <> '' OR (n.answer IS NULL AND touched IS NOT NULL AND sec < touched_ends) THEN sec + 90000 ELSE touched_ends END,
        n.answer IS NULL AND touched IS NOT NULL AND sec < touched_ends FROM walk w JOIN n ON n.user_id = w.user_id AND n.n = w.n + 1)"""


@query(f"WITH RECURSIVE {_WALK} SELECT event_id, hit, shown AS remembered, touched_hit FROM walk WHERE ask")
def expiring_answers(spark, sf_dir):
    """Asks that an answer of the last 25 hours serves, and those that it serves if every hit renews it."""
    answer = F.when(F.col("event_type") == "purchase", F.when(F.col("value") < 20, "").otherwise(F.concat(F.lit("a"), F.col("event_id").cast("string"))))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", answer.alias("answer"))
    plain = ans.expiring_answers(events, "user_id", "ts", "answer", 90_000, order="event_id").select("event_id", "hit", "remembered")
    touched = ans.expiring_answers(events, "user_id", "ts", "answer", 90_000, True, "event_id")
    return plain.join(touched.select("event_id", F.col("hit").alias("touched_hit")), "event_id")


@query("""WITH p AS (SELECT o_orderkey, CASE WHEN o_custkey % 41 > 0 THEN 'title ' || CAST(o_custkey % 40 AS VARCHAR) END AS title, CAST(year(o_orderdate) AS INT) AS year, o_custkey % 40 AS n FROM orders),
d AS (SELECT title, year, any_value(n) AS n, min(o_orderkey) AS first FROM p WHERE title IS NOT NULL GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (ORDER BY first, title, year) - 1 AS place FROM d WHERE n % 3 <> 0)
SELECT o_orderkey, title, year, CASE WHEN p.title IS NULL THEN NULL WHEN p.n % 3 = 0 THEN p.n * 10 WHEN p.n % 4 <> 2 THEN p.n * 10 + 1 END AS found,
    CASE WHEN p.title IS NULL THEN NULL WHEN p.n % 3 = 0 THEN 'known' WHEN p.n % 4 <> 2 THEN 'lookup' END AS resolver,
    CAST(CASE WHEN p.title IS NULL THEN NULL WHEN p.n % 3 = 0 THEN 1 WHEN p.n % 4 <> 2 THEN place // 60 + 1 END AS INT) AS cycle FROM p LEFT JOIN k USING (title, year)""")
def enrichment_loop(spark, sf_dir):
    """Cycles of sixty lookups until nothing is left to ask; answers are written back, batches without one too."""
    n = F.col("o_custkey") % 40
    title = F.when(F.col("o_custkey") % 41 > 0, F.concat(F.lit("title "), n.cast("string")))
    pending = table(spark, sf_dir, "orders").select("o_orderkey", title.alias("title"), F.year("o_orderdate").alias("year"))
    number = F.substring("title", 7, 10).cast("long")
    known = pending.select("title", "year").dropna().distinct().where(number % 3 == 0).withColumn("found", number * 10)
    lookup = lambda asked: asked.where(number % 4 != 2).withColumn("found", number * 10 + 1)
    return ans.enrich(pending, known, lookup, ["title", "year"], "o_orderkey", most=60)
