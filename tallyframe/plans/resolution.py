"""D-rows that resolve attributes: hierarchies, units, evidence, entities, members."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions import jsonx, text
from tallyframe.functions.numbers import money
from tallyframe.operators import aggregates as agg, intervals, lookups, resolve
from tallyframe.operators.latest import attach_group, latest_by
from tallyframe.operators.partitions import dealt
from tallyframe.operators.quality import classify
from tallyframe.plans import derived
from tallyframe.operators.documents import flatten_child
from tallyframe.plans.documents import ORDER_DOCUMENT, order_records, tenants
from tallyframe.plans.registry import query
from tallyframe.sinks.tables import stored
from tallyframe.sources.registry import Tables
from tallyframe.sources.seeds import seed


def values_sql(rows: list[tuple], columns: str) -> str:
    def lit(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + f") v({columns})"


# -- D12 ------------------------------------------------------------------------------
# Chart of accounts, company mapping and range breakpoints.
CHART = [(10, "BS", "Assets"), (20, "BS", "Liabilities"), (30, "P&L", "Income"), (40, "P&L", "Expense"),
         (17, "BS", "Prepaid assets"), (45, "P&L", "Other expense")]
COMPANY_MAP = [("Brand#1", 7, 45), ("Brand#2", 12, 30), ("Brand#3", 33, 17)]
RANGE_STARTS = [(1, 1, 10), (1, 5, 20), (2, 10, 30), (2, 20, 40), (2, 35, 10)]
FAMILY_ROOTS = [10, 20, 30, 40]


@query("D12_account_hierarchy_cascade", f"""
WITH prof AS (SELECT p_brand AS brand, CASE WHEN count(*) FILTER (length(CAST(p_size AS VARCHAR)) = 2) / count(*) >= 0.8 THEN 'two_digit_chart' ELSE 'mixed_chart' END AS profile FROM part GROUP BY 1),
chart AS (SELECT * FROM {values_sql(CHART, 'code, bs_pl, label')}),
cm AS (SELECT * FROM {values_sql(COMPANY_MAP, 'brand, local_code, mapped')}),
rg AS (SELECT digits, s, coalesce(lead(s) OVER (PARTITION BY digits ORDER BY s) - 1, CASE digits WHEN 1 THEN 9 ELSE 99 END) AS e, mapped FROM {values_sql(RANGE_STARTS, 'digits, s, mapped')})
SELECT p_partkey, profile, coalesce(em.code, gm.code, c.code, r.code) AS account_code,
  coalesce(em.bs_pl, gm.bs_pl, c.bs_pl, r.bs_pl, CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'P&L' WHEN p_type = 'LARGE' THEN 'BS' END) AS bs_pl,
  CASE WHEN em.code IS NOT NULL THEN 'company_exact' WHEN gm.code IS NOT NULL AND p_size = rg.s THEN 'range_start_exact' WHEN gm.code IS NOT NULL THEN 'range_fallback'
   WHEN c.code IS NOT NULL THEN 'exact_code' WHEN r.code IS NOT NULL THEN 'family_root' WHEN p_type IN ('PROMO', 'ECONOMY', 'LARGE') THEN 'native_type' ELSE 'unmapped' END AS method
FROM part JOIN prof ON prof.brand = p_brand
LEFT JOIN cm ON cm.brand = p_brand AND cm.local_code = p_size LEFT JOIN chart em ON em.code = cm.mapped
LEFT JOIN rg ON profile = 'two_digit_chart' AND em.code IS NULL AND length(CAST(p_size AS VARCHAR)) = rg.digits AND p_size BETWEEN rg.s AND rg.e
LEFT JOIN chart gm ON gm.code = rg.mapped
LEFT JOIN chart c ON gm.code IS NULL AND em.code IS NULL AND c.code = p_size
LEFT JOIN (SELECT * FROM chart WHERE code IN (10, 20, 30, 40)) r ON em.code IS NULL AND gm.code IS NULL AND c.code IS NULL AND p_size BETWEEN 10 AND 49 AND p_size // 10 * 10 = r.code""")
def d12(t: Tables) -> DataFrame:
    s = t.spark
    digits = F.length(F.col("p_size").cast("string"))
    profile = t.part.groupBy(F.col("p_brand").alias("brand")).agg(
        F.when(F.try_divide(F.count_if(digits == 2), F.count(F.lit(1))) >= 0.8, "two_digit_chart")
        .otherwise("mixed_chart").alias("profile"))
    chart = seed(s, CHART, "code int, bs_pl string, label string")
    ranges = intervals.breakpoint_ranges(seed(s, RANGE_STARTS, "digits int, s int, mapped int"), ["digits"], "s", "e",
                                         F.when(F.col("digits") == 1, 9).otherwise(99))
    company = seed(s, COMPANY_MAP, "brand string, local_code int, mapped int")
    def mapped(rel, code, tag):
        """Relation with the chart row its mapped code stands for."""
        c = chart.select(F.col("code").alias("_code"), F.struct("code", "bs_pl").alias(tag))
        return rel.join(c, F.col(code) == F.col("_code")).drop("_code", code)
    p = t.part.join(profile, F.col("p_brand") == F.col("brand")).drop("brand")
    em = mapped(company, "mapped", "em")
    p = p.join(em, (F.col("p_brand") == F.col("brand")) & (F.col("p_size") == F.col("local_code")), "left").drop("brand", "local_code")
    gm = mapped(ranges, "mapped", "gm")
    p = p.join(gm, (F.col("profile") == "two_digit_chart") & F.col("em").isNull() & (digits == F.col("digits"))
               & F.col("p_size").between(F.col("s"), F.col("e")), "left")
    c = chart.select(F.col("code").alias("_c"), F.struct("code", "bs_pl").alias("ex"))
    p = p.join(c, F.col("em").isNull() & F.col("gm").isNull() & (F.col("p_size") == F.col("_c")), "left").drop("_c")
    roots = chart.filter(F.col("code").isin(FAMILY_ROOTS)).select(F.col("code").alias("_r"), F.struct("code", "bs_pl").alias("rt"))
    root = (F.floor(F.col("p_size") / 10) * 10).cast("int")
    p = p.join(roots, F.col("em").isNull() & F.col("gm").isNull() & F.col("ex").isNull() & F.col("p_size").between(10, 49)
               & (root == F.col("_r")), "left")
    native = F.when(F.col("p_type").isin("PROMO", "ECONOMY"), "P&L").when(F.col("p_type") == "LARGE", "BS")
    hit = F.coalesce("em", "gm", "ex", "rt")
    method = classify([
        (F.col("em").isNotNull(), "company_exact"), (F.col("gm").isNotNull() & (F.col("p_size") == F.col("s")), "range_start_exact"),
        (F.col("gm").isNotNull(), "range_fallback"), (F.col("ex").isNotNull(), "exact_code"),
        (F.col("rt").isNotNull(), "family_root"), (native.isNotNull(), "native_type")], "unmapped")
    return p.withColumn("h", hit).select("p_partkey", "profile", F.col("h.code").alias("account_code"),
                                         F.coalesce("h.bs_pl", native).alias("bs_pl"), method.alias("method"))


# -- D14 ------------------------------------------------------------------------------
@query("D14_reference_reconciliation", """
WITH src AS (SELECT md5(text) AS code, doc_id, n_chars FROM documents WHERE nullif(trim(text, ' '), '') IS NOT NULL),
seeds AS (SELECT code, min(doc_id) AS doc_id FROM src JOIN labels USING (doc_id) WHERE quality = 1 GROUP BY 1),
dup AS (SELECT code FROM src GROUP BY 1 HAVING count(*) > 1),
low AS (SELECT DISTINCT code FROM src WHERE n_chars < 300),
resolved AS (
 SELECT code, doc_id, 'source' AS origin FROM src WHERE code NOT IN (SELECT code FROM dup) AND NOT (code IN (SELECT code FROM low) AND code IN (SELECT code FROM seeds))
 UNION ALL SELECT code, doc_id, 'source_duplicate' FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY n_chars DESC, doc_id) AS rn FROM src
   WHERE code IN (SELECT code FROM dup) AND code NOT IN (SELECT code FROM seeds)) WHERE rn = 1)
SELECT * FROM resolved UNION ALL SELECT code, doc_id, 'seed' FROM seeds WHERE code NOT IN (SELECT code FROM resolved)""")
def d14(t: Tables) -> DataFrame:
    src = t.documents.filter(text.blank_to_null("text").isNotNull()).select(F.md5("text").alias("code"), "doc_id", "n_chars")
    curated = t.labels.filter("quality = 1").select("doc_id", F.lit(True).alias("curated"))
    # all gates of a code come from one grouping, so a code with very many copies is folded map-side
    g = src.join(curated, "doc_id", "left").groupBy("code").agg(
        F.count(F.lit(1)).alias("copies"), F.min("n_chars").alias("shortest"),
        F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("best"),
        F.min(F.when(F.col("curated"), F.col("doc_id"))).alias("seed_doc"))
    has_seed, low = F.col("seed_doc").isNotNull(), F.col("shortest") < 300
    origin = (F.when((F.col("copies") == 1) & ~(low & has_seed), "source")
              .when((F.col("copies") > 1) & ~has_seed, "source_duplicate").when(has_seed, "seed"))
    return g.withColumn("origin", origin).select(
        "code", F.when(F.col("origin") == "seed", F.col("seed_doc")).otherwise(F.col("best")).alias("doc_id"), "origin")


# -- D15 ------------------------------------------------------------------------------
derived.SQL["unit_map"] = (["scd"], """
SELECT custkey, CAST(NULL AS VARCHAR) AS segment, valid_from, valid_to, class AS unit FROM scd
UNION ALL SELECT custkey, 'R', valid_from, CAST(NULL AS DATE), 'returns ' || class FROM scd WHERE class = '1-URGENT'""")


def unit_map(t: Tables) -> DataFrame:
    s = derived.scd(t)
    default = s.select("custkey", F.lit(None).cast("string").alias("segment"), "valid_from", "valid_to", F.col("class").alias("unit"))
    special = s.filter("class = '1-URGENT'").select(
        "custkey", F.lit("R").alias("segment"), "valid_from", F.lit(None).cast("date").alias("valid_to"),
        F.concat(F.lit("returns "), "class").alias("unit"))
    return default.unionByName(special)


@query("D15_unit_per_line", """
SELECT o_orderkey, CAST(line_no AS BIGINT) AS line_no, l_returnflag AS line_segment, unit FROM (
 SELECT ln.*, m.unit, row_number() OVER (PARTITION BY o_orderkey, line_no ORDER BY CASE WHEN segment IS NOT NULL THEN 0 ELSE 1 END, valid_from DESC, unit) AS rn
 FROM ln LEFT JOIN unit_map m ON custkey = o_custkey AND order_date BETWEEN valid_from AND coalesce(valid_to, DATE '9999-12-31')
  AND (segment IS NULL OR segment = l_returnflag)) WHERE rn = 1""", uses="ln unit_map")
def d15(t: Tables) -> DataFrame:
    lines = derived.ln(t).select("o_orderkey", F.col("line_no").cast("bigint").alias("line_no"), F.col("o_custkey").alias("custkey"),
                                 F.col("l_returnflag").alias("line_segment"), "order_date")
    return resolve.resolve_by_window(lines, unit_map(t), ["custkey"], "line_segment", "order_date", "valid_from", "valid_to",
                                     "segment", ["unit"]).select("o_orderkey", "line_no", "line_segment", "unit")


# -- D16-D18 --------------------------------------------------------------------------
derived.SQL["bl"] = (["ln"], """
SELECT o_orderkey, line_no, supp_id, amount, quantity, CASE WHEN p_brand <> 'Brand#25' THEN p_brand END AS unit, p_type = 'PROMO' AS ancillary, quantity >= 5 AS material
FROM ln JOIN part ON p_partkey = part_id""")


def brand_lines(t: Tables) -> DataFrame:
    p = t.part.select("p_partkey", F.when(F.col("p_brand") != "Brand#25", F.col("p_brand")).alias("unit"),
                      (F.col("p_type") == "PROMO").alias("ancillary"))
    rows = t.lineitem.count()
    lines = dealt(derived.ln(t), rows, "part_id").join(p, F.col("p_partkey") == F.col("part_id")).select(
        "o_orderkey", "line_no", "supp_id", "amount", "quantity", "unit", "ancillary", (F.col("quantity") >= 5).alias("material"))
    return dealt(lines, rows, "o_orderkey")


def held_by_order(df: DataFrame, name: str) -> DataFrame:
    """Stored rows of orders, dealt by order."""
    held = stored(df, name)
    return dealt(held, held.count(), "o_orderkey")


@query("D16_header_value_from_lines", """
WITH goods AS (SELECT o_orderkey, unit FROM (SELECT o_orderkey, unit, row_number() OVER (PARTITION BY o_orderkey ORDER BY sum(amount) DESC, count(*) DESC, min(line_no), unit) AS rn
   FROM bl WHERE material AND NOT ancillary AND unit IS NOT NULL GROUP BY 1, 2) WHERE rn = 1),
eff AS (SELECT bl.o_orderkey, bl.amount, bl.line_no, CASE WHEN ancillary AND goods.unit IS NOT NULL THEN goods.unit ELSE bl.unit END AS e FROM bl LEFT JOIN goods USING (o_orderkey) WHERE material),
st AS (SELECT o_orderkey, count(*) AS material_lines, count(*) FILTER (e IS NULL) AS unresolved_lines, count(DISTINCT e) AS value_count FROM eff GROUP BY 1),
top AS (SELECT o_orderkey, e FROM (SELECT o_orderkey, e, row_number() OVER (PARTITION BY o_orderkey ORDER BY sum(amount) DESC, count(*) DESC, min(line_no), e) AS rn FROM eff WHERE e IS NOT NULL GROUP BY 1, 2) WHERE rn = 1)
SELECT o_orderkey, coalesce(material_lines, 0) AS material_lines, coalesce(unresolved_lines, 0) AS unresolved_lines, coalesce(value_count, 0) AS value_count, e AS representative,
  CASE WHEN unresolved_lines = 0 AND value_count = 1 THEN e END AS agreed_value,
  CASE WHEN material_lines IS NULL THEN 'no_material_lines' WHEN unresolved_lines > 0 THEN 'unresolved_lines' WHEN value_count = 1 THEN 'unanimous' ELSE 'multiple_values' END AS selection_method
FROM (SELECT DISTINCT o_orderkey FROM bl) h LEFT JOIN st USING (o_orderkey) LEFT JOIN top USING (o_orderkey)""", uses="bl")
def d16(t: Tables) -> DataFrame:
    return resolve.header_value(brand_lines(t), "o_orderkey", "unit", "amount", "line_no", F.col("material"), F.col("ancillary"),
                                hold=lambda df: held_by_order(df, "brand-rollup"))


@query("D17_dominant_from_lines", """
WITH m AS (SELECT o_orderkey, supp_id FROM (SELECT o_orderkey, supp_id, row_number() OVER (PARTITION BY o_orderkey ORDER BY sum(amount) DESC, count(*) DESC, min(line_no), supp_id) AS rn
  FROM bl WHERE quantity >= 30 GROUP BY 1, 2) WHERE rn = 1),
a AS (SELECT o_orderkey, supp_id FROM (SELECT o_orderkey, supp_id, row_number() OVER (PARTITION BY o_orderkey ORDER BY sum(amount) DESC, count(*) DESC, min(line_no), supp_id) AS rn
  FROM bl GROUP BY 1, 2) WHERE rn = 1)
SELECT a.o_orderkey, coalesce(m.supp_id, a.supp_id) AS supplier, m.supp_id IS NOT NULL AS from_material_lines FROM a LEFT JOIN m USING (o_orderkey)""", uses="bl")
def d17(t: Tables) -> DataFrame:
    lines = derived.ln(t).select("o_orderkey", "supp_id", "amount", "line_no", (F.col("quantity") >= 30).alias("material"))
    # both rollups in one grouping: material measures are conditional sums
    hit = F.col("material")
    roll = lines.groupBy("o_orderkey", "supp_id").agg(
        F.sum("amount").alias("a"), F.count(F.lit(1)).alias("n"), F.min("line_no").alias("f"),
        F.sum(F.when(hit, F.col("amount"))).alias("ma"), F.count_if(hit).alias("mn"), F.min(F.when(hit, F.col("line_no"))).alias("mf"))
    # material lines decide when the order has any, all lines otherwise
    best = latest_by(roll, ["o_orderkey"], [
        (F.col("mn") > 0).desc(), F.desc(F.when(F.col("mn") > 0, F.col("ma")).otherwise(F.col("a"))),
        F.desc(F.when(F.col("mn") > 0, F.col("mn")).otherwise(F.col("n"))),
        F.asc(F.when(F.col("mn") > 0, F.col("mf")).otherwise(F.col("f"))), F.asc("supp_id")])
    return best.select("o_orderkey", F.col("supp_id").alias("supplier"), (F.col("mn") > 0).alias("from_material_lines"))


@query("D18_order_split_by_unit", """
SELECT o_orderkey, supp_id, count(*) AS line_count, count(*) FILTER (material) AS material_lines, count(*) FILTER (ancillary) AS ancillary_lines,
  CAST(sum(quantity) AS DOUBLE) AS quantity, CAST(sum(amount) AS DOUBLE) AS amount, units > 1 AS has_multiple_units
FROM bl JOIN (SELECT o_orderkey, count(DISTINCT supp_id) AS units FROM bl GROUP BY 1) USING (o_orderkey) GROUP BY ALL""", uses="bl")
def d18(t: Tables) -> DataFrame:
    split = held_by_order(brand_lines(t).groupBy("o_orderkey", "supp_id").agg(
        F.count(F.lit(1)).alias("line_count"), F.count_if("material").alias("material_lines"),
        F.count_if("ancillary").alias("ancillary_lines"), F.sum("quantity").cast("double").alias("quantity"),
        F.sum("amount").cast("double").alias("amount")), "order-split")
    return attach_group(split, ["o_orderkey"], (F.count(F.lit(1)) > 1).alias("has_multiple_units"))


# -- D19, D20 ---------------------------------------------------------------------------
derived.SQL["evidence"] = (["li"], """
SELECT o_custkey AS customer_id, l_returnflag AS class_id, o_orderpriority AS location_id, count(*) AS evidence_count, 'direct' AS method
FROM li JOIN orders ON o_orderkey = l_orderkey WHERE l_quantity = 50 GROUP BY 1, 2, 3
UNION ALL
SELECT customer_id, class_id, NULL, sum(n), 'price_signature' FROM (
 SELECT o_custkey AS customer_id, p.cls AS class_id, count(*) AS n FROM (
   SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) / CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(18,0)) AS up FROM li WHERE l_discount = 0) l
 JOIN orders ON o_orderkey = l_orderkey
 JOIN (SELECT l_partkey AS part, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) / CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(18,0)) AS price, l_returnflag AS cls,
        min(CAST(l_shipdate AS DATE)) AS eff FROM li WHERE l_tax < 0.03 GROUP BY 1, 2, 3) p
  ON p.part = l.l_partkey AND p.price = l.up AND p.eff <= CAST(l.l_shipdate AS DATE) GROUP BY 1, 2)
WHERE customer_id NOT IN (SELECT o_custkey FROM li JOIN orders ON o_orderkey = l_orderkey WHERE l_quantity = 50)
  AND customer_id IN (SELECT o_custkey FROM (
   SELECT o_custkey, p.cls FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) / CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(18,0)) AS up FROM li WHERE l_discount = 0) l
   JOIN orders ON o_orderkey = l_orderkey
   JOIN (SELECT l_partkey AS part, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) / CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(18,0)) AS price, l_returnflag AS cls,
        min(CAST(l_shipdate AS DATE)) AS eff FROM li WHERE l_tax < 0.03 GROUP BY 1, 2, 3) p
    ON p.part = l.l_partkey AND p.price = l.up AND p.eff <= CAST(l.l_shipdate AS DATE)) GROUP BY 1 HAVING count(DISTINCT cls) = 1)
GROUP BY 1, 2""")


def class_evidence(t: Tables) -> DataFrame:
    """Evidence rows (customer, class, location, count, method): direct, else a unique price signature."""
    lines = derived.li(t).join(t.orders.select("o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("location_id")),
                               F.col("l_orderkey") == F.col("o_orderkey"))
    direct = lines.filter("l_quantity = 50").groupBy("customer_id", F.col("l_returnflag").alias("class_id"), "location_id").agg(
        F.count(F.lit(1)).alias("evidence_count")).withColumn("method", F.lit("direct"))
    price = (money("l_extendedprice") / money("l_quantity")).cast("decimal(18,0)")
    listed = derived.li(t).filter("l_tax < 0.03").groupBy(
        F.col("l_partkey").alias("part"), price.alias("price"), F.col("l_returnflag").alias("class_id")).agg(
        F.to_date(F.min("l_shipdate")).alias("eff"))
    clean = lines.filter("l_discount = 0").select("customer_id", "l_partkey", price.alias("up"), F.to_date("l_shipdate").alias("day"))
    hits = clean.join(listed, (F.col("part") == F.col("l_partkey")) & (F.col("price") == F.col("up")) & (F.col("eff") <= F.col("day")))
    per_class = hits.groupBy("customer_id", "class_id").agg(F.count(F.lit(1)).alias("evidence_count"))
    unique = per_class.groupBy("customer_id").agg(F.count(F.lit(1)).alias("classes"), F.min("class_id").alias("class_id"),
                                                  F.sum("evidence_count").alias("evidence_count")).filter("classes = 1")
    inferred = unique.join(direct.select("customer_id"), "customer_id", "left_anti").select(
        "customer_id", "class_id", F.lit(None).cast("string").alias("location_id"), "evidence_count", F.lit("price_signature").alias("method"))
    return direct.unionByName(inferred)


@query("D19_evidence_based_class", """
SELECT e.customer_id, class_id, method, CAST(sum(evidence_count) AS BIGINT) AS evidence_count, count(DISTINCT location_id) AS location_count,
  string_agg(DISTINCT location_id, ' | ' ORDER BY location_id) AS sample_locations, n.classes AS distinct_classes, n.classes > 1 AS has_conflict
FROM evidence e JOIN (SELECT customer_id, count(DISTINCT class_id) AS classes FROM evidence GROUP BY 1) n USING (customer_id) GROUP BY ALL""", uses="evidence")
def d19(t: Tables) -> DataFrame:
    e = stored(class_evidence(t), "class-evidence")
    # evidence has one row per (customer, class, location): counts of rows are distinct counts
    rows = e.groupBy("customer_id", "class_id", "method").agg(
        F.sum("evidence_count").alias("evidence_count"), F.count("location_id").alias("location_count"))
    few = agg.distinct_samples(e, ["customer_id", "class_id"], "location_id", 10, "sample_locations")
    conflict = e.groupBy("customer_id").agg(F.count_distinct("class_id").alias("distinct_classes"))
    return rows.join(few, ["customer_id", "class_id"], "left").join(conflict, "customer_id").withColumn(
        "has_conflict", F.col("distinct_classes") > 1)


@query("D20_period_evidence", """
WITH e AS (SELECT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS day, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS pr FROM orders WHERE o_orderstatus <> 'P' OR o_totalprice > 300000)
SELECT custkey, d_from AS valid_from, d_to AS valid_to, n AS evidence_count, f AS first_date, l AS last_date, CASE pr WHEN 1 THEN 'closed' WHEN 2 THEN 'open' ELSE 'large_pending' END AS source FROM (
 SELECT m.custkey, d_from, d_to, pr, count(*) AS n, min(day) AS f, max(day) AS l, row_number() OVER (PARTITION BY m.custkey, d_from, d_to ORDER BY pr, count(*) DESC) AS rn
 FROM merged m JOIN e ON e.custkey = m.custkey AND day BETWEEN d_from AND d_to GROUP BY 1, 2, 3, 4) WHERE rn = 1""", uses="merged")
def d20(t: Tables) -> DataFrame:
    windows = intervals.merge_intervals(derived.win(t), ["custkey"], "d_from", "d_to").select("custkey", "d_from", "d_to")
    s = F.col("o_orderstatus")
    pr = F.when(s == "F", 1).when(s == "O", 2).otherwise(3)
    # evidence is counted per day before it meets the windows
    days = t.orders.filter((s != "P") | (F.col("o_totalprice") > 300000)).groupBy(
        F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("day"), pr.alias("pr")).agg(F.count(F.lit(1)).alias("n"))
    j = lookups.validity_join(days, windows, ["custkey"], "day", "d_from", "d_to")
    per = j.groupBy("custkey", "d_from", "d_to", "pr").agg(
        F.sum("n").alias("evidence_count"), F.min("day").alias("first_date"), F.max("day").alias("last_date"))
    best = latest_by(per, ["custkey", "d_from", "d_to"], [F.asc("pr"), F.desc("evidence_count")])
    label = F.when(F.col("pr") == 1, "closed").when(F.col("pr") == 2, "open").otherwise("large_pending")
    return best.select("custkey", F.col("d_from").alias("valid_from"), F.col("d_to").alias("valid_to"), "evidence_count",
                       "first_date", "last_date", label.alias("source"))


# -- D21, D22 ---------------------------------------------------------------------------
derived.SQL["parties"] = ([], """
SELECT *, CASE WHEN corp IN ('000000000', '999999999') THEN NULL ELSE corp END AS corporate_id,
 nullif(regexp_replace(upper(trim(raw_name)), '[^A-Z0-9]', '', 'g'), '') AS name_norm FROM (
 SELECT 'C' || c_custkey AS member, r_name AS tenant, n_name AS country, c_mktsegment || ' co.' AS raw_name,
  CASE WHEN c_acctbal < 0 THEN '000000000' WHEN c_acctbal < 4000 THEN 'ORG' || (c_custkey // 3) WHEN c_acctbal < 4500 THEN '999999999' END AS corp,
  CASE WHEN c_acctbal > 9000 THEN NULL WHEN c_acctbal < 2500 THEN 'P' || (c_custkey % 2) END AS price_class, c_mktsegment = 'MACHINERY' AS no_country
 FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
 UNION ALL SELECT 'S' || s_suppkey, r_name, n_name, 'Supplies', CASE WHEN s_acctbal < 4000 THEN 'ORG' || (s_suppkey // 3) END, CASE WHEN s_acctbal > 7000 THEN 'P1' END, FALSE
 FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)""")
derived.SQL["keyed_parties"] = (["parties"], """
SELECT *, CASE WHEN corporate_id IS NOT NULL THEN 'corporate_id' WHEN name_norm IS NOT NULL AND NOT no_country THEN 'name_country' ELSE 'tenant_customer' END AS match_method,
 CASE WHEN corporate_id IS NOT NULL THEN corporate_id WHEN name_norm IS NOT NULL AND NOT no_country THEN country || '|' || name_norm ELSE tenant || '|' || member END AS match_value FROM parties""")


def parties(t: Tables) -> DataFrame:
    geo = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    c = t.customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    s = t.supplier.join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey"))
    cb, sb = F.col("c_acctbal"), F.col("s_acctbal")
    def org(key):
        return F.concat(F.lit("ORG"), F.floor(F.col(key) / 3).cast("string"))
    cust = c.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("member"), F.col("r_name").alias("tenant"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("n_name")).alias("country"),
        F.concat("c_mktsegment", F.lit(" co.")).alias("raw_name"),
        F.when(cb < 0, "000000000").when(cb < 4000, org("c_custkey")).when(cb < 4500, "999999999").alias("corp"),
        F.when(cb < 2500, F.concat(F.lit("P"), (F.col("c_custkey") % 2).cast("string"))).alias("price_class"))
    sup = s.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("member"), F.col("r_name").alias("tenant"),
        F.col("n_name").alias("country"), F.lit("Supplies").alias("raw_name"), F.when(sb < 4000, org("s_suppkey")).alias("corp"),
        F.when(sb > 7000, "P1").alias("price_class"))
    p = cust.unionByName(sup).select(
        "*", text.real_identifier("corp", upper_first=True).alias("corporate_id"),
        text.normalize_identifier("raw_name", upper_first=True).alias("name_norm"))
    method, value = resolve.match_key(F.col("corporate_id"), F.col("name_norm"), F.col("country"),
                                      F.concat("tenant", F.lit("|"), "member"))
    return p.select("*", method.alias("match_method"), value.alias("match_value"))


def party_groups(members: DataFrame) -> DataFrame:
    return resolve.group_entities(
        members, ["match_method", "match_value"], "tenant", "price_class", "member", "member",
        [F.col("price_class").isNull(), F.col("tenant"), F.col("member")])


@query("D21_entity_groups", """
SELECT match_method, match_value, count(*) AS member_count, count(DISTINCT tenant) AS tenant_count, count(price_class) AS attribute_count,
 count(DISTINCT price_class) AS distinct_attributes, CASE WHEN count(DISTINCT price_class) = 1 THEN min(price_class) END AS unified_attribute,
 arg_min(member, (CASE WHEN price_class IS NULL THEN 1 ELSE 0 END, tenant, member)) AS representative,
 array_to_string(list_slice(list_sort(list(member)), 1, 8), ' | ') AS sample_names, count(DISTINCT tenant) > 1 AS is_cross_tenant,
 count(DISTINCT tenant) > 1 AND count(DISTINCT price_class) = 1 AS has_safe_attribute FROM keyed_parties GROUP BY 1, 2""", uses="keyed_parties")
def d21(t: Tables) -> DataFrame:
    return party_groups(parties(t))


@query("D21_entity_bridge", """
SELECT member, tenant, match_method || '|' || match_value AS group_key, CASE match_method WHEN 'corporate_id' THEN 'high' WHEN 'name_country' THEN 'medium' ELSE 'low' END AS confidence,
 tenants AS group_tenants FROM keyed_parties JOIN (SELECT match_method, match_value, count(DISTINCT tenant) AS tenants FROM keyed_parties GROUP BY 1, 2) USING (match_method, match_value)""", uses="keyed_parties")
def d21_bridge(t: Tables) -> DataFrame:
    p = parties(t)
    g = p.groupBy("match_method", "match_value").agg(F.count_distinct("tenant").alias("group_tenants"))
    return p.join(g, ["match_method", "match_value"]).select(
        "member", "tenant", F.concat("match_method", F.lit("|"), "match_value").alias("group_key"),
        resolve.match_confidence(F.col("match_method")).alias("confidence"), "group_tenants")


@query("D22_safe_group_propagation", """
WITH g AS (SELECT corporate_id, count(DISTINCT tenant) AS group_tenants, count(price_class) AS supporting_members, min(price_class) AS candidate FROM parties WHERE corporate_id IS NOT NULL
  GROUP BY 1 HAVING count(DISTINCT tenant) > 1 AND count(price_class) > 0 AND count(DISTINCT price_class) = 1)
SELECT member, tenant, corporate_id, candidate, group_tenants, supporting_members FROM parties p JOIN g USING (corporate_id)
WHERE price_class IS NULL AND EXISTS (SELECT 1 FROM parties b WHERE b.tenant = p.tenant AND b.price_class = g.candidate)""", uses="parties")
def d22(t: Tables) -> DataFrame:
    p = parties(t)
    codebook = p.filter("price_class IS NOT NULL").select("tenant", "price_class").distinct()
    return resolve.propagate(p, "corporate_id", "tenant", "price_class", codebook).select(
        "member", "tenant", "corporate_id", "candidate", "group_tenants", "supporting_members")


# -- D23, D24 ---------------------------------------------------------------------------
@query("D23_inferred_members", """
WITH m AS (SELECT c_custkey AS custkey FROM customer WHERE c_acctbal >= 0),
r AS (SELECT o_custkey AS custkey, 1 AS source_priority, max(CAST(o_orderdate AS DATE)) AS updated_on, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS hint FROM orders GROUP BY 1
 UNION ALL SELECT user_id, 2, max(CAST(ts AS DATE)), arg_max(event_type, (ts, event_id)) FROM events GROUP BY 1)
SELECT custkey, 'master' AS member_source, CAST(NULL AS DATE) AS updated_on, CAST(NULL AS VARCHAR) AS hint FROM m
UNION ALL SELECT custkey, CASE source_priority WHEN 1 THEN 'orders' ELSE 'events' END, updated_on, hint FROM (
 SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY source_priority, updated_on DESC) AS rn FROM r WHERE custkey NOT IN (SELECT custkey FROM m)) WHERE rn = 1""")
def d23(t: Tables) -> DataFrame:
    # customers in debt are missing from the master; facts still mention them
    master = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("custkey"))
    orders = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.to_date(F.max("o_orderdate")).alias("updated_on"), agg.first_non_null("o_orderpriority", "o_orderdate", "o_orderkey").alias("hint"),
    ).withColumn("source_priority", F.lit(1))
    events = t.events.groupBy(F.col("user_id").alias("custkey")).agg(
        F.to_date(F.max("ts")).alias("updated_on"), agg.first_non_null("event_type", "ts", "event_id").alias("hint"),
    ).withColumn("source_priority", F.lit(2))
    inferred = resolve.infer_members(master, [orders, events], ["custkey"], "updated_on")
    known = master.select("custkey", F.lit("master").alias("member_source"), F.lit(None).cast("date").alias("updated_on"),
                          F.lit(None).cast("string").alias("hint"))
    return known.unionByName(inferred.select(
        "custkey", F.when(F.col("source_priority") == 1, "orders").otherwise("events").alias("member_source"), "updated_on", "hint"))


@query("D24_sentinel_members", """
SELECT DISTINCT p_brand AS tenant_id, lpad(CAST(p_size AS VARCHAR), 3, '0') AS code, 'Size ' || p_size AS name, FALSE AS is_sentinel FROM part
UNION ALL SELECT DISTINCT p_brand, lpad(CAST(l_linenumber - 1 AS VARCHAR), 3, '0'), 'Unspecified', TRUE FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber = 1""")
def d24(t: Tables) -> DataFrame:
    master = t.part.select(F.col("p_brand").alias("tenant_id"), F.lpad(F.col("p_size").cast("string"), 3, "0").alias("code"),
                           F.concat(F.lit("Size "), F.col("p_size").cast("string")).alias("name")).distinct()
    used = t.lineitem.select("l_partkey", F.lpad((F.col("l_linenumber") - 1).cast("string"), 3, "0").alias("code")).distinct()
    codes = used.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(F.col("p_brand").alias("tenant_id"), "code")
    extra = resolve.zero_sentinels(codes, master, ["tenant_id", "code"], "code")
    return master.withColumn("is_sentinel", F.lit(False)).unionByName(
        extra.select("tenant_id", "code", F.lit("Unspecified").alias("name"), F.lit(True).alias("is_sentinel")))


# -- D30 --------------------------------------------------------------------------------
# Reviewed mapping seed, label books per tenant and across tenants.
MAPPING_SEED = [
    ("PROMO", "red ring", "C9", "approved", True), ("PROMO", "blue bolt", "C8", "pending", False),
    ("SMALL", "hot gear", "C7", "approved", True), ("LARGE", "old rod", "C6", "approved", False),
]
TENANT_BOOK = [("PROMO", "C1", "red"), ("PROMO", "C2", "hot gear"), ("SMALL", "C1", "ring"), ("LARGE", "C3", "cold"), ("LARGE", "C1", "red")]
GLOBAL_BOOK = [("G1", "blue"), ("G2", "widget"), ("G3", "old"), ("G4", "new gizmo")]
WORD = "'(^|[^a-z0-9])' || label || '($|[^a-z0-9])'"


@query("D30_mapping_consolidation", f"""
WITH u AS (SELECT DISTINCT p_type AS tenant, p_name AS name FROM part),
tm AS (SELECT u.tenant, u.name, min(class_id) AS class_id FROM u JOIN (SELECT * FROM {values_sql(TENANT_BOOK, 'tenant, class_id, label')}) b ON b.tenant = u.tenant AND regexp_matches(lower(name), {WORD}) GROUP BY 1, 2 HAVING count(DISTINCT class_id) = 1),
gm AS (SELECT u.tenant, u.name, min(class_id) AS class_id FROM u JOIN (SELECT * FROM {values_sql(GLOBAL_BOOK, 'class_id, label')}) b ON regexp_matches(lower(name), {WORD})
  WHERE (u.tenant, u.name) NOT IN (SELECT (tenant, name) FROM tm) GROUP BY 1, 2 HAVING count(DISTINCT class_id) = 1),
x AS (SELECT tenant, name, class_id, 'approved_seed' AS lookup_source, 1 AS pr FROM {values_sql(MAPPING_SEED, 'tenant, name, class_id, status, include')} WHERE status = 'approved' AND include
 UNION ALL SELECT DISTINCT p_type, p_brand, b.class_id, 'source_codebook', 2 FROM part JOIN (SELECT * FROM {values_sql(TENANT_BOOK, 'tenant, class_id, label')}) b ON b.tenant = p_type AND b.class_id = replace(p_brand, 'Brand#', 'C')
 UNION ALL SELECT *, 'tenant_name_match', 3 FROM tm UNION ALL SELECT *, 'global_name_match', 4 FROM gm)
SELECT tenant, name AS source_code, class_id, lookup_source FROM x QUALIFY row_number() OVER (PARTITION BY tenant, name ORDER BY pr, class_id) = 1""")
def d30(t: Tables) -> DataFrame:
    s = t.spark
    approved = seed(s, MAPPING_SEED, "tenant string, source_code string, class_id string, status string, include boolean").filter(
        "status = 'approved' AND include").select("tenant", "source_code", "class_id", F.lit("approved_seed").alias("lookup_source"), F.lit(1).alias("pr"))
    book = seed(s, TENANT_BOOK, "tenant string, class_id string, label string")
    world = seed(s, GLOBAL_BOOK, "class_id string, label string")
    universe = t.part.select(F.col("p_type").alias("tenant"), F.col("p_name").alias("source_code")).distinct()
    observed = t.part.select(F.col("p_type").alias("tenant"), F.col("p_brand").alias("source_code"),
                             F.regexp_replace("p_brand", "^Brand#", "C").alias("class_id")).distinct()
    backed = observed.join(book.select("tenant", "class_id").distinct(), ["tenant", "class_id"], "left_semi").select(
        "tenant", "source_code", "class_id", F.lit("source_codebook").alias("lookup_source"), F.lit(2).alias("pr"))
    def unique_match(names, labels, source, pr):
        hits = lookups.word_match(names, "source_code", labels, "label")
        return hits.groupBy("tenant", "source_code").agg(agg.only_value("class_id").alias("class_id")).filter(
            F.col("class_id").isNotNull()).select("tenant", "source_code", "class_id", F.lit(source).alias("lookup_source"), F.lit(pr).alias("pr"))
    own_labels = book.withColumnRenamed("tenant", "_bt")
    own_hits = lookups.word_match(universe, "source_code", own_labels, "label").filter(F.col("_bt") == F.col("tenant"))
    own = own_hits.groupBy("tenant", "source_code").agg(agg.only_value("class_id").alias("class_id")).filter(
        F.col("class_id").isNotNull()).select("tenant", "source_code", "class_id", F.lit("tenant_name_match").alias("lookup_source"), F.lit(3).alias("pr"))
    rest = universe.join(own.select("tenant", "source_code"), ["tenant", "source_code"], "left_anti")
    wide = unique_match(rest, world, "global_name_match", 4)
    rows = approved.unionByName(backed).unionByName(own).unionByName(wide)
    return latest_by(rows, ["tenant", "source_code"], [F.asc("pr"), F.asc("class_id")]).drop("pr")


# -- D41-D44, D46 -------------------------------------------------------------------------
@query("D41_membership_merge", """
SELECT part_id, supplier_id, max(part_name) AS part_name, max(supplier_name) AS supplier_name FROM (
 SELECT part_id, supp_id AS supplier_id, p_name AS part_name, CAST(NULL AS VARCHAR) AS supplier_name FROM ln JOIN part ON p_partkey = part_id WHERE o_orderstatus = 'F'
 UNION ALL SELECT l_partkey, l_suppkey, NULL, s_name FROM li JOIN supplier ON s_suppkey = l_suppkey) GROUP BY 1, 2""", uses="ln li")
def d41(t: Tables) -> DataFrame:
    # one direction comes from the lines inside closed documents, the other from the line table
    closed = order_records(t).filter(jsonx.json_scalar("_doc", "$.Type") == "F")
    lines = flatten_child(closed, ORDER_DOCUMENT, "lines", []).select("part_id", "supplier_id").distinct()
    side_a = lines.join(t.part, F.col("p_partkey") == F.col("part_id")).select(
        "part_id", "supplier_id", F.col("p_name").alias("part_name"), F.lit(None).cast("string").alias("supplier_name"))
    pairs = derived.li(t).select(F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id")).distinct()
    side_b = pairs.join(t.supplier, F.col("s_suppkey") == F.col("supplier_id")).select(
        "part_id", "supplier_id", F.lit(None).cast("string").alias("part_name"), F.col("s_name").alias("supplier_name"))
    return side_a.unionByName(side_b).groupBy("part_id", "supplier_id").agg(
        F.max("part_name").alias("part_name"), F.max("supplier_name").alias("supplier_name"))


# Native segments and their group vocabulary.
SEGMENT_VOCABULARY = [("AUTOMOBILE", "MOBILITY"), ("BUILDING", "CONSTRUCTION"), ("FURNITURE", "HOME"), ("HOUSEHOLD", "HOME"), ("MACHINERY", "INDUSTRY")]


@query("D42_harmonized_vocabulary", f"""
SELECT 'C' || c_custkey AS party_key, c_name AS party_name, coalesce(g, 'OTHER') AS group_segment, CASE WHEN c_acctbal < 0 THEN 'payable' ELSE 'receivable' END AS balance_side,
 abs(c_acctbal) AS balance_amount, CAST(NULL AS VARCHAR) AS supplier_grade, 'customer' AS source_relation FROM customer LEFT JOIN (SELECT * FROM {values_sql(SEGMENT_VOCABULARY, 'n, g')}) m ON m.n = c_mktsegment
UNION ALL SELECT 'S' || s_suppkey, s_name, 'SUPPLY', CASE WHEN s_acctbal < 0 THEN 'receivable' ELSE 'payable' END, abs(s_acctbal), CASE WHEN s_acctbal >= 5000 THEN 'A' ELSE 'B' END, 'supplier' FROM supplier""")
def d42(t: Tables) -> DataFrame:
    voc = seed(t.spark, SEGMENT_VOCABULARY, "native string, group_segment string")
    c = t.customer.join(F.broadcast(voc), F.col("native") == F.col("c_mktsegment"), "left").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("party_key"), F.col("c_name").alias("party_name"),
        F.coalesce("group_segment", F.lit("OTHER")).alias("group_segment"),
        F.when(F.col("c_acctbal") < 0, "payable").otherwise("receivable").alias("balance_side"),
        F.abs("c_acctbal").alias("balance_amount"), F.lit("customer").alias("source_relation"))
    s = t.supplier.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("party_key"), F.col("s_name").alias("party_name"),
        F.lit("SUPPLY").alias("group_segment"), F.when(F.col("s_acctbal") < 0, "receivable").otherwise("payable").alias("balance_side"),
        F.abs("s_acctbal").alias("balance_amount"), F.when(F.col("s_acctbal") >= 5000, "A").otherwise("B").alias("supplier_grade"),
        F.lit("supplier").alias("source_relation"))
    return c.unionByName(s, allowMissingColumns=True)


@query("D43_conformed_company", """
WITH n AS (SELECT n_regionkey, n_nationkey, n_name, count(c_custkey) AS customers, min(c_mktsegment) AS any_segment FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)
SELECT r_name AS tenant_id, n_name AS main_branch, customers AS main_branch_customers, any_segment, base_currency FROM n JOIN region ON r_regionkey = n_regionkey LEFT JOIN tenants ON tenant_id = r_name
QUALIFY row_number() OVER (PARTITION BY r_name ORDER BY customers DESC, n_nationkey) = 1""", uses="tenants")
def d43(t: Tables) -> DataFrame:
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.min("c_mktsegment").alias("any_segment"))
    branches = t.nation.join(counts, F.col("n_nationkey") == F.col("c_nationkey"), "left").withColumn(
        "main_branch_customers", F.coalesce("n", F.lit(0)))
    main = latest_by(branches, ["n_regionkey"], [F.desc("main_branch_customers"), F.asc("n_nationkey")])
    return main.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).join(
        F.broadcast(tenants(t)), F.col("tenant_id") == F.col("r_name"), "left").select(
        F.col("r_name").alias("tenant_id"), F.col("n_name").alias("main_branch"), "main_branch_customers", "any_segment", "base_currency")


@query("D43_conformed_currency", """
WITH a AS (SELECT DISTINCT currency AS currency_id FROM fx), b AS (SELECT DISTINCT base_currency AS currency_id FROM tenants)
SELECT currency_id, currency_id IN (SELECT currency_id FROM a) AS has_market_rate, currency_id IN (SELECT currency_id FROM b) AS is_functional FROM (SELECT * FROM a UNION SELECT * FROM b)""", uses="fx tenants")
def d43_currency(t: Tables) -> DataFrame:
    a = derived.fx(t).select(F.col("currency").alias("currency_id"), F.lit(True).alias("m"), F.lit(False).alias("f"))
    b = tenants(t).select(F.col("base_currency").alias("currency_id"), F.lit(False).alias("m"), F.lit(True).alias("f"))
    return a.unionByName(b).groupBy("currency_id").agg(F.bool_or("m").alias("has_market_rate"), F.bool_or("f").alias("is_functional"))


@query("D44_current_member_as_of", """
SELECT custkey, class, valid_from FROM scd WHERE valid_from <= DATE '1999-12-31' AND coalesce(valid_to, DATE '9999-12-31') >= DATE '1999-12-31'
QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY CASE WHEN class = '1-URGENT' THEN 0 ELSE 1 END, valid_from DESC) = 1""", uses="scd")
def d44(t: Tables) -> DataFrame:
    return resolve.current_member(derived.scd(t), ["custkey"], F.lit("1999-12-31").cast("date"), "valid_from", "valid_to",
                                  [F.when(F.col("class") == "1-URGENT", 0).otherwise(1).asc()]).select("custkey", "class", "valid_from")


@query("D46_first_line_representative", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, supp_id AS supplier_id, n_name AS supplier_nation FROM (
 SELECT o_orderkey, supp_id, row_number() OVER (PARTITION BY o_orderkey ORDER BY line_no) AS rn FROM ln)
LEFT JOIN supplier ON s_suppkey = supp_id LEFT JOIN nation ON n_nationkey = s_nationkey WHERE rn = 1""", uses="ln")
def d46(t: Tables) -> DataFrame:
    # first line by number, then array position; the supplier sits under one of several paths
    lines = order_records(t).select(jsonx.json_scalar("_doc", "$.OrderID").alias("order_id"),
                                    F.posexplode(jsonx.json_array("_doc", "$.LineItems")).alias("pos", "e"))
    ref = F.coalesce(jsonx.json_scalar("e", "$.Supplier.ID"), jsonx.json_scalar("e", "$.Supplier.Number"), jsonx.json_scalar("e", "$.SupplierID"))
    rows = lines.select("order_id", "pos", jsonx.json_number("e", "$.LineNo", "int").alias("line_no"), ref.alias("ref"))
    first = latest_by(rows, ["order_id"], [F.asc("line_no"), F.asc("pos")])
    sup = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return first.join(sup, F.col("ref").try_cast("bigint") == F.col("s_suppkey"), "left").select(
        "order_id", F.col("ref").cast("bigint").alias("supplier_id"), F.col("n_name").alias("supplier_nation"))
