"""J-rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.numbers import money, sum_money
from tallyframe.operators import lookups, scans
from tallyframe.operators.asof import asof_join
from tallyframe.plans import derived
from tallyframe.plans.registry import query
from tallyframe.sources.registry import Tables
from tallyframe.sources.seeds import seed


@query("J1_inner_composite", """
SELECT o_orderkey, o_orderstatus, CAST(l_linenumber AS BIGINT) AS line_no, l_linestatus, l_partkey, l_suppkey, l_quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus""")
def j1(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, (F.col("l_orderkey") == F.col("o_orderkey"))
                         & (F.col("l_linestatus") == F.col("o_orderstatus"))).select(
        "o_orderkey", "o_orderstatus", F.col("l_linenumber").cast("bigint").alias("line_no"), "l_linestatus",
        "l_partkey", "l_suppkey", "l_quantity")


@query("J2_star_lookup", """
SELECT l_orderkey, l_linenumber, l_extendedprice, p_name, p_brand, s_name, n_name, r_name
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def j2(t: Tables) -> DataFrame:
    return lookups.star_lookup(t.lineitem, [
        (t.part, F.col("p_partkey") == F.col("l_partkey")),
        (t.supplier, F.col("s_suppkey") == F.col("l_suppkey")),
        (F.broadcast(t.nation), F.col("n_nationkey") == F.col("s_nationkey")),
        (F.broadcast(t.region), F.col("r_regionkey") == F.col("n_regionkey")),
    ]).select("l_orderkey", "l_linenumber", "l_extendedprice", "p_name", "p_brand", "s_name", "n_name", "r_name")


@query("J3_full_outer_coalesced", """
SELECT coalesce(c.nk, s.nk) AS nationkey, coalesce(customer_balance, 0) AS customer_balance,
  coalesce(supplier_balance, 0) AS supplier_balance
FROM (SELECT c_nationkey AS nk, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS customer_balance FROM customer
      WHERE c_mktsegment = 'MACHINERY' GROUP BY 1) c
FULL JOIN (SELECT s_nationkey AS nk, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS supplier_balance FROM supplier
      GROUP BY 1) s ON c.nk = s.nk""")
def j3(t: Tables) -> DataFrame:
    c = (t.customer.filter(F.col("c_mktsegment") == "MACHINERY").groupBy(F.col("c_nationkey").alias("nationkey"))
         .agg(sum_money("c_acctbal", "customer_balance")))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(sum_money("s_acctbal", "supplier_balance"))
    return c.join(s, "nationkey", "full_outer").select(
        "nationkey", *[F.coalesce(x, F.lit(0.0)).alias(x) for x in ("customer_balance", "supplier_balance")])


@query("J4_cross_join_spine", """
SELECT d.day, y.event_type, count(e.event_id) AS event_count
FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day
      FROM (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events)) d
CROSS JOIN (SELECT DISTINCT event_type FROM events) y
LEFT JOIN events e ON CAST(e.ts AS DATE) = d.day AND e.event_type = y.event_type GROUP BY 1, 2""")
def j4(t: Tables) -> DataFrame:
    # a calendar per code from a one-row bound; events are counted before they meet the grid
    counts = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    ends = counts.agg(F.struct(F.min("day").alias("a"), F.max("day").alias("b")).alias("e")).scalar()
    grid = counts.select("event_type").distinct().select("event_type", ends.alias("e")).select(
        F.explode(F.sequence("e.a", "e.b")).alias("day"), "event_type")
    return grid.join(counts, ["day", "event_type"], "left").select(
        "day", "event_type", F.coalesce("n", F.lit(0)).alias("event_count"))


@query("J5_anti_join", """
SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1999) o
ON o_custkey = c_custkey WHERE o_custkey IS NULL""")
def j5(t: Tables) -> DataFrame:
    in_1999 = F.col("o_orderdate").between(F.lit("1999-01-01").cast("timestamp_ntz"),
                                           F.lit("1999-12-31").cast("timestamp_ntz"))
    return t.customer.join(t.orders.filter(in_1999), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(
        "c_custkey", "c_name")


@query("J6_in_not_in_subquery", """
SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_discount = 0.1) AS is_returned
FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)
UNION ALL
SELECT p_partkey, NULL FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)""")
def j6(t: Tables) -> DataFrame:
    # keys are never NULL, so NOT IN is an anti join and needs no single-node null-aware form
    parts = t.part.select("p_partkey")
    full = t.lineitem.filter(F.col("l_quantity") == 50).select(F.col("l_partkey").alias("p_partkey"))
    back = (t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_discount") == 0.1))
            .select(F.col("l_partkey").alias("p_partkey")).distinct().withColumn("hit", F.lit(True)))
    outside = parts.join(full, "p_partkey", "left_anti").join(back, "p_partkey", "left").select(
        "p_partkey", F.coalesce("hit", F.lit(False)).alias("is_returned"))
    inside = parts.join(full, "p_partkey", "left_semi").select(
        "p_partkey", F.lit(None).cast("boolean").alias("is_returned"))
    return outside.unionByName(inside)


@query("J7_validity_range_join", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, class, valid_from, valid_to
FROM orders JOIN scd ON custkey = o_custkey
 AND CAST(o_orderdate AS DATE) BETWEEN valid_from AND coalesce(valid_to, DATE '9999-12-31')""", uses="scd")
def j7(t: Tables) -> DataFrame:
    facts = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("order_date"))
    return lookups.validity_join(facts, derived.scd(t), ["custkey"], "order_date", "valid_from", "valid_to").select(
        "o_orderkey", F.col("custkey").alias("o_custkey"), "order_date", "class", "valid_from", "valid_to")


@query("J8_asof_rate", f"""
SELECT o_orderkey, currency, posted, rate_date, CAST(exchange_rate AS DOUBLE) AS exchange_rate FROM (
  SELECT o_orderkey, o.currency, posted, rate_date, exchange_rate,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY rate_date DESC NULLS LAST) AS rn
  FROM (SELECT o_orderkey, {derived.SQL_CURRENCY.format(k='o_orderkey')} AS currency,
               {derived.SQL_POSTING.format(k='o_orderkey')} - 2 AS posted FROM orders) o
  LEFT JOIN fx ON fx.currency = o.currency AND fx.rate_date <= o.posted) WHERE rn = 1""", uses="fx")
def j8(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    facts = t.orders.select("o_orderkey", derived.currency_of(key).alias("currency"),
                            F.date_sub(derived.posting_date(key), 2).alias("posted"))
    return asof_join(facts, derived.fx(t), ["currency"], "posted", "rate_date", ["exchange_rate"]).select(
        "o_orderkey", "currency", "posted", F.col("held_since").alias("rate_date"),
        F.col("exchange_rate").cast("double").alias("exchange_rate"))


@query("J9_wildcard_rule", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, category FROM (
SELECT p_partkey, category, row_number() OVER (PARTITION BY p_partkey ORDER BY
   CASE WHEN r.type IS NULL THEN 0 ELSE 1 END + CASE WHEN r.size_band IS NULL THEN 0 ELSE 1 END DESC,
   CASE WHEN r.type IS NULL THEN 0 ELSE 1 END DESC, category) AS rn
FROM (SELECT *, CASE WHEN p_size <= 15 THEN 'S' WHEN p_size <= 35 THEN 'M' ELSE 'L' END AS band FROM part) p
LEFT JOIN rules r ON r.brand = p.p_brand AND (r.type IS NULL OR r.type = p.p_type) AND (r.size_band IS NULL OR r.size_band = p.band)) m
JOIN lineitem ON l_partkey = p_partkey WHERE rn = 1""", uses="rules")
def j9(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_brand", "p_type", derived.size_band(F.col("p_size")).alias("band"))
    hit = lookups.wildcard_lookup(parts, derived.rules(t), {"brand": "p_brand"},
                                  {"type": "p_type", "size_band": "band"}, ["category"])
    return t.lineitem.join(hit, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "category")


@query("J10_disjunctive_key", """
SELECT ref, n_nationkey, matched_on FROM (
 SELECT ref, n_nationkey, CASE WHEN ref = CAST(n_nationkey AS VARCHAR) THEN 'n_nationkey' WHEN ref = n_name THEN 'n_name' END AS matched_on,
   row_number() OVER (PARTITION BY rid ORDER BY CASE WHEN ref = CAST(n_nationkey AS VARCHAR) THEN 0 ELSE 1 END) AS rn
 FROM (SELECT c_custkey AS rid, CASE WHEN c_acctbal < 0 THEN 'unknown' WHEN c_mktsegment IN ('MACHINERY', 'BUILDING')
         THEN CAST(c_nationkey AS VARCHAR) ELSE 'NATION_' || c_nationkey END AS ref FROM customer) x
 LEFT JOIN nation ON ref = CAST(n_nationkey AS VARCHAR) OR ref = n_name) WHERE rn = 1""")
def j10(t: Tables) -> DataFrame:
    nk = F.col("c_nationkey").cast("string")
    ref = (F.when(F.col("c_acctbal") < 0, "unknown")
           .when(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"), nk).otherwise(F.concat(F.lit("NATION_"), nk)))
    return lookups.either_key_lookup(
        t.customer.select("c_custkey", ref.alias("ref")), t.nation.withColumnRenamed("n_regionkey", "_r"),
        "ref", ["n_nationkey", "n_name"], ["n_nationkey"], "matched_on").drop("c_custkey")


@query("J11_strict_then_loose", """
SELECT c_custkey, nationkey, acct_class, coalesce(st, lo) AS supplier FROM (
 SELECT c_custkey, c_nationkey AS nationkey, CASE WHEN c_acctbal >= 9000 THEN 'rich' WHEN c_acctbal < 0 THEN 'debt' ELSE 'plain' END AS acct_class FROM customer)
LEFT JOIN (SELECT s_nationkey AS n1, CASE WHEN s_acctbal >= 9000 THEN 'rich' WHEN s_acctbal < 0 THEN 'debt' ELSE 'plain' END AS a1, min(s_name) AS st FROM supplier GROUP BY 1, 2)
 ON n1 = nationkey AND a1 = acct_class
LEFT JOIN (SELECT s_nationkey AS n2, min(s_name) AS lo FROM supplier GROUP BY 1) ON n2 = nationkey""")
def j11(t: Tables) -> DataFrame:
    def klass(c):
        return F.when(F.col(c) >= 9000, "rich").when(F.col(c) < 0, "debt").otherwise("plain").alias("acct_class")
    facts = t.customer.select("c_custkey", F.col("c_nationkey").alias("nationkey"), klass("c_acctbal"))
    sup = t.supplier.select(F.col("s_nationkey").alias("nationkey"), klass("s_acctbal"), "s_name")
    return lookups.strict_then_loose(facts, sup, ["nationkey", "acct_class"], ["nationkey"], "s_name", "supplier")


# Labels looked for in names, one of them with two words.
NAME_LABELS = [("red",), ("ring",), ("cold",), ("old",), ("hot gear",), ("gold",)]


@query("J12_word_boundary_match", """
SELECT p_partkey, p_name, label FROM part
JOIN (VALUES ('red'), ('ring'), ('cold'), ('old'), ('hot gear'), ('gold')) l(label)
ON regexp_matches(lower(p_name), '(^|[^a-z0-9])' || label || '($|[^a-z0-9])')""")
def j12(t: Tables) -> DataFrame:
    return lookups.word_match(t.part.select("p_partkey", "p_name"), "p_name",
                              seed(t.spark, NAME_LABELS, "label string"), "label")


@query("J13_price_with_optional_bounds", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(l.unit_price AS DOUBLE) AS unit_price, p.price_class
FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) / CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(18,0)) AS unit_price FROM li) l
JOIN (SELECT l_partkey AS partkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) / CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(18,0)) AS price,
        l_returnflag AS price_class,
        CASE WHEN l_returnflag = 'N' THEN NULL ELSE min(CAST(l_shipdate AS DATE)) END AS eff,
        CASE WHEN l_returnflag = 'R' THEN NULL ELSE min(CAST(l_shipdate AS DATE)) + 700 END AS exp
      FROM li GROUP BY 1, 2, 3) p
ON p.partkey = l.l_partkey AND p.price = l.unit_price
 AND (p.eff IS NULL OR p.eff <= CAST(l.l_shipdate AS DATE)) AND (p.exp IS NULL OR CAST(l.l_shipdate AS DATE) <= p.exp)""", uses="li")
def j13(t: Tables) -> DataFrame:
    price = (money("l_extendedprice") / money("l_quantity")).cast("decimal(18,0)")
    lines = derived.li(t).select("l_orderkey", "l_linenumber", "l_partkey", price.alias("unit_price"),
                                 F.to_date("l_shipdate").alias("day"), "l_returnflag")
    lst = lines.groupBy(F.col("l_partkey").alias("partkey"), F.col("unit_price").alias("price"),
                        F.col("l_returnflag").alias("price_class")).agg(F.min("day").alias("d0"))
    lst = lst.select("partkey", "price", "price_class", F.when(F.col("price_class") != "N", F.col("d0")).alias("eff"),
                     F.when(F.col("price_class") != "R", F.date_add("d0", 700)).alias("exp"))
    on = ((F.col("partkey") == F.col("l_partkey")) & (F.col("price") == F.col("unit_price"))
          & (F.col("eff").isNull() | (F.col("eff") <= F.col("day")))
          & (F.col("exp").isNull() | (F.col("day") <= F.col("exp"))))
    return lines.join(lst, on).select("l_orderkey", "l_linenumber", "l_partkey",
                                      F.col("unit_price").cast("double").alias("unit_price"), "price_class")


# Bands per digit count of the code.
SIZE_BANDS = [(1, 1, 4, "tiny"), (1, 5, 9, "small"), (2, 10, 25, "medium"), (2, 26, 40, "large")]


@query("J14_numeric_band", """
SELECT p_partkey, p_size, band FROM part
LEFT JOIN (VALUES (1, 1, 4, 'tiny'), (1, 5, 9, 'small'), (2, 10, 25, 'medium'), (2, 26, 40, 'large')) b(digits, lo, hi, band)
ON length(CAST(p_size AS VARCHAR)) = digits AND p_size BETWEEN lo AND hi""")
def j14(t: Tables) -> DataFrame:
    bands = seed(t.spark, SIZE_BANDS, "digits int, lo int, hi int, band string")
    return lookups.band_lookup(t.part, F.broadcast(bands), F.col("p_size"), F.length(F.col("p_size").cast("string")),
                               "digits", "lo", "hi").select("p_partkey", "p_size", "band")


@query("J14_many_bands", """
SELECT l_orderkey, l_linenumber, o_orderkey AS band_order FROM lineitem
LEFT JOIN orders ON o_custkey % 3 = l_suppkey % 3 AND l_orderkey * 10 + l_linenumber * 2 BETWEEN o_orderkey * 10 AND o_orderkey * 10 + 8""")
def j14_many(t: Tables) -> DataFrame:
    """As many bands as orders in three buckets, so that every band meets every row of a third of the table if joined as such."""
    bands = t.orders.select((F.col("o_custkey") % 3).alias("b"), (F.col("o_orderkey") * 10).alias("lo"), (F.col("o_orderkey") * 10 + 8).alias("hi"), F.col("o_orderkey").alias("band_order"))
    facts = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 3).alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber") * 2).alias("v"))
    return scans.predecessor_lookup(facts, bands, "k", "v", "b", "lo", "hi").select("l_orderkey", "l_linenumber", "band_order")


# Mapping by brand and type, then by type.
BRAND_TYPE_MAP = [("Brand#1", "PROMO", "A1"), ("Brand#2", "SMALL", "A2"), ("Brand#3", "LARGE", "A3")]
TYPE_MAP = [("PROMO", "T1"), ("SMALL", "T2"), ("ECONOMY", "T3")]


@query("J15_chained_lookup", """
SELECT p_partkey, coalesce(a.code, b.code, c.code) AS mapped, CASE WHEN a.code IS NOT NULL THEN 'brand_type'
  WHEN b.code IS NOT NULL THEN 'type' WHEN c.code IS NOT NULL THEN 'size_nation' ELSE 'unmapped' END AS method
FROM part LEFT JOIN (VALUES ('Brand#1', 'PROMO', 'A1'), ('Brand#2', 'SMALL', 'A2'), ('Brand#3', 'LARGE', 'A3')) a(brand, type, code)
  ON a.brand = p_brand AND a.type = p_type
LEFT JOIN (VALUES ('PROMO', 'T1'), ('SMALL', 'T2'), ('ECONOMY', 'T3')) b(type, code) ON a.code IS NULL AND b.type = p_type
LEFT JOIN (SELECT n_nationkey, n_name AS code FROM nation) c
  ON a.code IS NULL AND b.code IS NULL AND c.n_nationkey = p_size""")
def j15(t: Tables) -> DataFrame:
    a = seed(t.spark, BRAND_TYPE_MAP, "brand string, type string, code string")
    b = seed(t.spark, TYPE_MAP, "type string, code string")
    c = t.nation.select("n_nationkey", F.col("n_name").alias("code"))
    return lookups.chained_lookup(
        t.part.select("p_partkey", "p_brand", "p_type", "p_size"),
        [("brand_type", a, {"brand": F.col("p_brand"), "type": F.col("p_type")}),
         ("type", b, {"type": F.col("p_type")}),
         ("size_nation", c, {"n_nationkey": F.col("p_size")})],
        "code", "mapped", "method").select("p_partkey", "mapped", "method")


@query("J16_prefix_key", """
SELECT c_custkey, c_name, group_id, members FROM customer
JOIN (SELECT substr(c_name, 1, 16) AS pre, min(c_custkey) AS group_id, count(*) AS members FROM customer GROUP BY 1)
ON substr(c_name, 1, 16) = pre""")
def j16(t: Tables) -> DataFrame:
    groups = t.customer.groupBy(F.substring("c_name", 1, 16).alias("pre")).agg(
        F.min("c_custkey").alias("group_id"), F.count(F.lit(1)).alias("members"))
    return t.customer.join(groups, F.substring("c_name", 1, 16) == F.col("pre")).select(
        "c_custkey", "c_name", "group_id", "members")


@query("J17_using", "SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)")
def j17(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, on="doc_id")
