"""A-rows, O-rows and U-rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.numbers import money, strict_greatest, sum_money
from tallyframe.operators import aggregates as agg, sets
from tallyframe.operators.latest import top_k_by
from tallyframe.plans.registry import query
from tallyframe.sources.registry import Tables

def row_count():
    return F.count(F.lit(1))


@query("A1_group_by", """
SELECT l_returnflag, l_linestatus, count(*) AS line_count, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue,
  min(CAST(l_shipdate AS DATE)) AS first_ship, max(CAST(l_shipdate AS DATE)) AS last_ship FROM lineitem GROUP BY 1, 2""")
def a1(t: Tables) -> DataFrame:
    net = money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        row_count().alias("line_count"), sum_money("l_quantity", "sum_qty"), F.sum(net).cast("double").alias("revenue"),
        F.to_date(F.min("l_shipdate")).alias("first_ship"), F.to_date(F.max("l_shipdate")).alias("last_ship"))


@query("A2_conditional_count", """
SELECT o_custkey, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS closed, count(*) FILTER (o_orderstatus = 'O') AS open,
  count(*) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice > 250000) AS urgent_large FROM orders GROUP BY 1""")
def a2(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return t.orders.groupBy("o_custkey").agg(
        row_count().alias("orders"), F.count_if(s == "F").alias("closed"), F.count_if(s == "O").alias("open"),
        F.count_if((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 250000)).alias("urgent_large"))


@query("A3_distinct_count", """
SELECT p_brand, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned_parts,
  count(DISTINCT CAST(l_suppkey AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR)) AS pairs
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def a3(t: Tables) -> DataFrame:
    # one row per (brand, part, supplier) first: the distinct counts then work on pairs, not lines
    pairs = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(
        F.max(F.col("l_returnflag") == "R").alias("was_returned"))
    j = pairs.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    return j.groupBy("p_brand").agg(
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct(F.when(F.col("was_returned"), F.col("l_partkey"))).alias("returned_parts"),
        F.count(F.lit(1)).alias("pairs"))


@query("A4_having", """
SELECT o_custkey, count(*) AS order_count, max(o_totalprice) AS largest FROM orders GROUP BY 1
HAVING order_count > 10 AND largest > 300000""")
def a4(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(row_count().alias("order_count"), F.max("o_totalprice").alias("largest")).filter(
        (F.col("order_count") > 10) & (F.col("largest") > 300000))


@query("A5_any_value", """
SELECT c_nationkey, min(c_mktsegment) AS a_segment, count(*) AS customers FROM customer GROUP BY 1""")
def a5(t: Tables) -> DataFrame:
    # a fixed choice (the smallest) so that reruns agree
    return t.customer.groupBy("c_nationkey").agg(F.min("c_mktsegment").alias("a_segment"), row_count().alias("customers"))


@query("A6_bounded_distinct_list", """
SELECT p_type, string_agg(p_name, ' | ' ORDER BY p_name) AS sample_names FROM (
  SELECT p_type, p_name, row_number() OVER (PARTITION BY p_type ORDER BY p_name) AS rn FROM (SELECT DISTINCT p_type, p_name FROM part))
WHERE rn <= 8 GROUP BY 1""")
def a6(t: Tables) -> DataFrame:
    return agg.distinct_samples(t.part, ["p_type"], "p_name", 8, "sample_names")


@query("A7_distinct_ordered_array", """
SELECT o_custkey, len(list_distinct(list(o_orderpriority))) AS priority_count,
  list_extract(list_sort(list_distinct(list(o_orderpriority))), 1) AS first_priority,
  list_extract(list_sort(list_distinct(list(o_orderpriority))), 4) AS fourth_priority FROM orders GROUP BY 1""")
def a7(t: Tables) -> DataFrame:
    # the array holds codes of a closed list, so it cannot grow with the group
    a = F.array_sort(F.collect_set("o_orderpriority"))
    return t.orders.groupBy("o_custkey").agg(a.alias("a")).select(
        "o_custkey", F.size("a").cast("bigint").alias("priority_count"), F.try_element_at("a", F.lit(1)).alias("first_priority"),
        F.try_element_at("a", F.lit(4)).alias("fourth_priority"))


@query("A8_arg_max_non_null", """
SELECT o_custkey, arg_max(p, (o_orderdate, o_orderkey)) FILTER (p IS NOT NULL) AS latest_priority FROM (
  SELECT *, nullif(o_orderpriority, '4-NOT SPECIFIED') AS p FROM orders) GROUP BY 1""")
def a8(t: Tables) -> DataFrame:
    o = t.orders.withColumn("p", F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")))
    return o.groupBy("o_custkey").agg(agg.first_non_null("p", "o_orderdate", "o_orderkey").alias("latest_priority"))


@query("A9_conditional_sum_pivot", """
SELECT l_suppkey, CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN x END), 0) AS DOUBLE) AS debit,
  CAST(coalesce(sum(CASE WHEN l_returnflag = 'A' THEN x END), 0) AS DOUBLE) AS credit,
  CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN x END), 0) - coalesce(sum(CASE WHEN l_returnflag = 'A' THEN x END), 0) AS DOUBLE) AS net
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS x FROM lineitem) GROUP BY 1""")
def a9(t: Tables) -> DataFrame:
    x, zero = money("l_extendedprice"), F.lit(0).cast("decimal(28,2)")
    d = F.coalesce(agg.sum_when(F.col("l_returnflag") == "R", x), zero)
    c = F.coalesce(agg.sum_when(F.col("l_returnflag") == "A", x), zero)
    return t.lineitem.groupBy("l_suppkey").agg(d.alias("d"), c.alias("c")).select(
        "l_suppkey", F.col("d").cast("double").alias("debit"), F.col("c").cast("double").alias("credit"),
        (F.col("d") - F.col("c")).cast("double").alias("net"))


@query("A10_signed_sum", """
SELECT l_partkey, CAST(sum(CASE WHEN l_linestatus = 'O' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS signed_amount
FROM lineitem GROUP BY 1""")
def a10(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_partkey").agg(
        agg.signed_sum(money("l_extendedprice"), F.col("l_linestatus") == "O").cast("double").alias("signed_amount"))


@query("A12_distinct", """
SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m') AS order_month FROM orders""")
def a12(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("order_month")).distinct()


@query("A13_scalar_bounds", """
SELECT s_suppkey, greatest(o.d, l.d) AS last_date, least(o.m, l.m) AS first_date
FROM supplier, (SELECT max(CAST(o_orderdate AS DATE)) AS d, min(CAST(o_orderdate AS DATE)) AS m FROM orders) o,
  (SELECT max(CAST(l_shipdate AS DATE)) AS d, min(CAST(l_shipdate AS DATE)) AS m FROM lineitem) l""")
def a13(t: Tables) -> DataFrame:
    o = t.orders.agg(F.struct(F.max("o_orderdate").alias("hi"), F.min("o_orderdate").alias("lo")).alias("b")).scalar()
    l = t.lineitem.agg(F.struct(F.max("l_shipdate").alias("hi"), F.min("l_shipdate").alias("lo")).alias("b")).scalar()
    return t.supplier.select("s_suppkey", F.to_date(strict_greatest(o["hi"], l["hi"])).alias("last_date"),
                             F.to_date(F.least(o["lo"], l["lo"])).alias("first_date"))


@query("A14_uniqueness_gate", """
SELECT p_type, p_name, CASE WHEN count(DISTINCT p_brand) = 1 THEN min(p_brand) END AS only_brand, count(*) AS parts
FROM part GROUP BY 1, 2""")
def a14(t: Tables) -> DataFrame:
    return t.part.groupBy("p_type", "p_name").agg(agg.only_value("p_brand").alias("only_brand"), row_count().alias("parts"))


@query("A15_child_rows_to_columns", """
SELECT conv_id, max(CASE WHEN role = 'system' THEN length(text) END) AS system_chars,
  max(CASE WHEN role = 'user' THEN length(text) END) AS user_chars,
  max(CASE WHEN role = 'assistant' THEN length(text) END) AS assistant_chars FROM conversations GROUP BY 1""")
def a15(t: Tables) -> DataFrame:
    return agg.wide_by_type(t.conversations, ["conv_id"], "role", ["system", "user", "assistant"],
                            F.length("text").cast("bigint"), "chars")


@query("O1_multi_key_sort", """
SELECT p_partkey, p_name, CASE WHEN p_size >= 40 THEN 1 WHEN p_size >= 20 THEN 2 ELSE 3 END AS bucket,
  TRY_CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS brand_no FROM part ORDER BY bucket, brand_no DESC NULLS LAST, p_partkey""")
def o1(t: Tables) -> DataFrame:
    s = F.col("p_size")
    return t.part.select(
        "p_partkey", "p_name", F.when(s >= 40, 1).when(s >= 20, 2).otherwise(3).alias("bucket"),
        F.regexp_extract("p_brand", r"(\d+)$", 1).try_cast("int").alias("brand_no"),
    ).orderBy("bucket", F.desc_nulls_last("brand_no"), "p_partkey")


@query("O2_bounded_aggregation", """
SELECT c_nationkey, string_agg(c_name, ', ' ORDER BY c_acctbal DESC, c_custkey) AS top_customers, count(*) AS listed FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= 15 GROUP BY 1""")
def o2(t: Tables) -> DataFrame:
    few = top_k_by(t.customer, ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")], 15, rank="rn")
    listed = F.array_sort(F.collect_list(F.struct("rn", "c_name")))
    return few.groupBy("c_nationkey").agg(listed.alias("l")).select(
        "c_nationkey", F.array_join(F.col("l.c_name"), ", ").alias("top_customers"),
        F.size("l").cast("bigint").alias("listed"))


@query("O3_top_k_per_group", """
SELECT l_partkey, l_suppkey, CAST(amount AS DOUBLE) AS amount, CAST(rn AS INTEGER) AS rn FROM (
  SELECT l_partkey, l_suppkey, amount, row_number() OVER (PARTITION BY l_partkey ORDER BY amount DESC, l_suppkey) AS rn
  FROM (SELECT l_partkey, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount FROM lineitem GROUP BY 1, 2)) WHERE rn <= 3""")
def o3(t: Tables) -> DataFrame:
    sums = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum(money("l_extendedprice")).alias("amount"))
    top = top_k_by(sums, ["l_partkey"], [F.desc("amount"), F.asc("l_suppkey")], 3, rank="rn")
    return top.withColumn("amount", F.col("amount").cast("double"))


@query("O4_nulls_last", """
SELECT source, doc_id, quality FROM (SELECT source, doc_id, quality, row_number() OVER (PARTITION BY source
  ORDER BY quality DESC NULLS LAST, doc_id) AS rn FROM documents LEFT JOIN labels USING (doc_id)) WHERE rn <= 2""")
def o4(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return top_k_by(d, ["source"], [F.desc_nulls_last("quality"), F.asc("doc_id")], 2).select("source", "doc_id", "quality")


@query("U1_union_all", """
SELECT c_nationkey AS nationkey, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""")
def u1(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("balance"))
    return c.unionByName(t.supplier.select(F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("balance")))


@query("U2_union_distinct", """
SELECT c_nationkey AS nationkey, c_acctbal < 0 AS in_debt FROM customer UNION SELECT s_nationkey, s_acctbal < 0 FROM supplier""")
def u2(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_nationkey").alias("nationkey"), (F.col("c_acctbal") < 0).alias("in_debt"))
    s = t.supplier.select(F.col("s_nationkey").alias("nationkey"), (F.col("s_acctbal") < 0).alias("in_debt"))
    return c.unionByName(s).distinct()


@query("U3_tagged_union", """
SELECT event_id, user_id, value, CASE event_type WHEN 'purchase' THEN 'sale' WHEN 'signup' THEN 'lead' WHEN 'error' THEN 'fault'
  WHEN 'view' THEN 'visit' ELSE 'visit' END AS tag FROM events""")
def u3(t: Tables) -> DataFrame:
    base = t.events.select("event_id", "user_id", "value", "event_type")
    parts = {
        "sale": base.filter(F.col("event_type") == "purchase"), "lead": base.filter(F.col("event_type") == "signup"),
        "fault": base.filter(F.col("event_type") == "error"), "visit": base.filter(F.col("event_type").isin("view", "click"))}
    return sets.tagged_union({k: d.drop("event_type") for k, d in parts.items()}, "tag")


@query("U4_priority_union", """
SELECT l_orderkey AS orderkey, count(*) AS line_count, 'lines' AS origin FROM lineitem GROUP BY 1
UNION ALL SELECT o_orderkey, 0, 'default' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def u4(t: Tables) -> DataFrame:
    primary = t.lineitem.groupBy(F.col("l_orderkey").alias("orderkey")).agg(row_count().alias("line_count")).withColumn(
        "origin", F.lit("lines"))
    fallback = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.lit(0).cast("bigint").alias("line_count"),
                               F.lit("default").alias("origin"))
    return sets.priority_union(primary, fallback, ["orderkey"])


@query("U5_unpivot_signed", """
SELECT l_orderkey, l_linenumber, 'part' AS side, l_partkey AS account, l_extendedprice AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'supplier', l_suppkey, -l_extendedprice FROM lineitem""")
def u5(t: Tables) -> DataFrame:
    return sets.unpivot_pairs(
        t.lineitem, ["l_orderkey", "l_linenumber"],
        {"part": (F.col("l_partkey"), F.col("l_extendedprice")), "supplier": (F.col("l_suppkey"), -F.col("l_extendedprice"))},
        "side", "account", "amount")
