"""W-rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyframe.functions.numbers import money
from tallyframe.operators import intervals, scans
from tallyframe.operators.latest import attach_group, latest_by, latest_flag
from tallyframe.operators.lookups import word_match
from tallyframe.plans import derived
from tallyframe.plans.joins import NAME_LABELS
from tallyframe.plans.registry import query
from tallyframe.sources.registry import Tables
from tallyframe.sources.seeds import seed


@query("W1_latest_per_key", "SELECT * FROM li", uses="li")
def w1(t: Tables) -> DataFrame:
    return derived.li(t)


@query("W2_preference_ranking", """
SELECT c_nationkey, c_mktsegment, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment
  ORDER BY CASE WHEN c_acctbal < 0 THEN 2 WHEN c_acctbal > 9000 THEN 0 ELSE 1 END, c_acctbal DESC, c_custkey) = 1""")
def w2(t: Tables) -> DataFrame:
    b = F.col("c_acctbal")
    preference = F.when(b < 0, 2).when(b > 9000, 0).otherwise(1)
    return latest_by(t.customer, ["c_nationkey", "c_mktsegment"], [preference.asc(), b.desc(), F.asc("c_custkey")]).select(
        "c_nationkey", "c_mktsegment", "c_custkey", "c_acctbal")


@query("W3_dense_rank", """
SELECT n_regionkey, n_name, customers, CAST(dense_rank() OVER (PARTITION BY n_regionkey ORDER BY customers DESC) AS INTEGER) AS rnk
FROM (SELECT n_regionkey, n_name, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2)""")
def w3(t: Tables) -> DataFrame:
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    named = counts.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    w = Window.partitionBy("n_regionkey").orderBy(F.desc("customers"))
    return named.select("n_regionkey", "n_name", "customers", F.dense_rank().over(w).alias("rnk"))


@query("W4_lead_range_end", """
SELECT custkey, valid_from, lead(valid_from) OVER (PARTITION BY custkey ORDER BY valid_from) AS next_start,
  date_diff('day', valid_from, lead(valid_from) OVER (PARTITION BY custkey ORDER BY valid_from)) AS days_to_next
FROM (SELECT DISTINCT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS valid_from FROM orders)""")
def w4(t: Tables) -> DataFrame:
    days = t.orders.select(F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("valid_from")).distinct()
    nxt = F.lead("valid_from").over(Window.partitionBy("custkey").orderBy("valid_from"))
    return days.withColumn("next_start", nxt).withColumn(
        "days_to_next", F.datediff("next_start", "valid_from").cast("bigint"))


@query("W5_running_max_before", """
SELECT custkey, d_from, d_to, max(d_to) OVER (PARTITION BY custkey ORDER BY d_from ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max_end
FROM (SELECT custkey, d_from, max(d_to) AS d_to FROM win GROUP BY 1, 2)""", uses="win")
def w5(t: Tables) -> DataFrame:
    return intervals.previous_max_end(derived.win(t), ["custkey"], "d_from", "d_to").drop("interval_count")


@query("W6_running_break_sum", """
SELECT custkey, d_from, island_id FROM (
 SELECT custkey, d_from, CAST(sum(CASE WHEN p IS NULL OR d_from > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY custkey ORDER BY d_from) AS BIGINT) AS island_id FROM (
  SELECT custkey, d_from, max(d_to) OVER (PARTITION BY custkey ORDER BY d_from ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
  FROM (SELECT custkey, d_from, max(d_to) AS d_to FROM win GROUP BY 1, 2)))""", uses="win")
def w6(t: Tables) -> DataFrame:
    return intervals.island_ids(derived.win(t), ["custkey"], "d_from", "d_to").select("custkey", "d_from", "island_id")


@query("W5_running_max_of_moments", """
SELECT event_type, ts, max(value) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest_before
FROM (SELECT event_type, ts, max(value) AS value FROM events GROUP BY 1, 2)""")
def w5_moments(t: Tables) -> DataFrame:
    # a handful of keys with a moment per event: nothing bounds a key by the calendar
    at = t.events.groupBy("event_type", "ts").agg(F.max("value").alias("value"))
    return scans.running(at, ["event_type"], "ts", {"highest_before": ("max", "value")}, before=True).drop("value")


@query("W6_running_sum_of_moments", """
SELECT event_id, event_type, ts, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY ts) AS DOUBLE) AS running_value FROM events""")
def w6_moments(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "event_type", "ts", money("value").alias("v"))
    out = scans.running_sum(events, ["event_type"], "ts", "v", "s")
    return out.select("event_id", "event_type", "ts", F.col("s").cast("double").alias("running_value"))


@query("W7_count_over_partition", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey) AS lines_in_order FROM lineitem""")
def w7(t: Tables) -> DataFrame:
    return attach_group(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey"],
                        F.count(F.lit(1)).alias("lines_in_order"))


@query("W8_distinct_count_filter", """
SELECT p_partkey, min(label) AS label FROM part
JOIN (VALUES ('red'), ('ring'), ('cold'), ('old'), ('hot gear'), ('gold')) l(label)
ON regexp_matches(lower(p_name), '(^|[^a-z0-9])' || label || '($|[^a-z0-9])') GROUP BY 1 HAVING count(DISTINCT label) = 1""")
def w8(t: Tables) -> DataFrame:
    m = word_match(t.part.select("p_partkey", "p_name"), "p_name", seed(t.spark, NAME_LABELS, "label string"), "label")
    # min = max says "one distinct label" without a distinct window
    return m.groupBy("p_partkey").agg(F.min("label").alias("label"), F.max("label").alias("_hi")).filter(
        F.col("label") == F.col("_hi")).drop("_hi")


@query("W9_is_latest_flag", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS is_latest FROM orders""")
def w9(t: Tables) -> DataFrame:
    return latest_flag(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"],
                       ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_custkey", "is_latest")


@query("W10_global_rank_cutoff", """
SELECT c_custkey, c_name, c_acctbal, CAST(row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS rnk FROM customer
QUALIFY rnk <= 20""")
def w10(t: Tables) -> DataFrame:
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    top = t.customer.select("c_custkey", "c_name", "c_acctbal").orderBy(*order).limit(20)
    # only the 20 rows of the cut-off reach the unpartitioned window
    return top.withColumn("rnk", F.row_number().over(Window.orderBy(*order)))
