"""D-rows for reports, facts, BI tables, reconciliations and assertions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyframe.functions import dates, jsonx, keys, text
from tallyframe.functions.numbers import converted, money
from tallyframe.operators import aggregates as agg, lookups, quality, sets
from tallyframe.operators.documents import flatten_child
from tallyframe.operators.latest import latest_by
from tallyframe.plans import derived
from tallyframe.plans.documents import ORDER_DOCUMENT, gl_rated, group_amount, net_amount, order_records, tenants
from tallyframe.plans.registry import query
from tallyframe.plans.resolution import values_sql
from tallyframe.sinks.tables import stored
from tallyframe.sources.registry import Tables
from tallyframe.sources.seeds import seed


# -- D25 ------------------------------------------------------------------------------
@query("D25_master_vs_fact_coverage", """
SELECT p_partkey, p_name, p_partkey IN (SELECT l_partkey FROM lineitem WHERE year(l_shipdate) = 1995) AS has_sales,
 CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE year(l_shipdate) = 1995) THEN 'sold_but_never_returned' ELSE 'not_sold_in_period' END AS missing_reason
FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE year(l_shipdate) = 1995 AND l_returnflag = 'R')""")
def d25(t: Tables) -> DataFrame:
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("1995-01-01", "1996-01-01"))
    in_1995 = t.lineitem.filter((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi))
    # one grouping answers both "sold" and "returned"
    seen = in_1995.groupBy("l_partkey").agg(F.max(F.col("l_returnflag") == "R").alias("returned"))
    j = t.part.select("p_partkey", "p_name").join(seen, F.col("p_partkey") == F.col("l_partkey"), "left")
    sold = F.col("l_partkey").isNotNull()
    return j.filter(~F.coalesce("returned", F.lit(False))).select(
        "p_partkey", "p_name", sold.alias("has_sales"),
        F.when(sold, "sold_but_never_returned").otherwise("not_sold_in_period").alias("missing_reason"))


# -- D26-D28 ----------------------------------------------------------------------------
# Words that mark an expected charge line.
CHARGE_PATTERN = r"(TOTAL|LICEN[SC]E|COPYRIGHT|GEBYR|FRAKT)"
derived.SQL["gaps"] = ([], f"""
SELECT doc_id, source, lang, n_chars, quality, toxic, quality IS NULL AS missing_id, n_chars < 200 AS missing_description, toxic IS NULL AND lang = 'de' AS missing_amount, charge,
 CASE WHEN toxic IS NULL AND lang = 'de' THEN 'missing_amount' WHEN quality IS NULL AND n_chars < 200 THEN 'missing_id_and_description'
  WHEN quality IS NULL AND charge THEN 'missing_id_expected_charge' WHEN quality IS NULL THEN 'missing_id_unexpected' WHEN n_chars < 200 THEN 'missing_description' ELSE 'ok' END AS gap_reason,
 CASE WHEN toxic IS NULL AND lang = 'de' THEN 'high' WHEN quality IS NULL AND NOT charge THEN 'medium' ELSE 'low' END AS gap_severity
FROM (SELECT d.*, quality, toxic, regexp_matches(upper(trim(text, ' ')), '{CHARGE_PATTERN}') AS charge FROM documents d LEFT JOIN labels USING (doc_id))
WHERE quality IS NULL OR n_chars < 200 OR (toxic IS NULL AND lang = 'de')""")


def gaps(t: Tables) -> DataFrame:
    d = t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", "source", "lang", "n_chars", "quality", "toxic", F.col("quality").isNull().alias("missing_id"),
        (F.col("n_chars") < 200).alias("missing_description"),
        (F.col("toxic").isNull() & (F.col("lang") == "de")).alias("missing_amount"),
        F.upper(F.trim(F.coalesce("text", F.lit("")))).rlike(CHARGE_PATTERN).alias("charge"))
    mid, mde, mam, chg = (F.col(c) for c in ("missing_id", "missing_description", "missing_amount", "charge"))
    reason = quality.classify([
        (mam, "missing_amount"), (mid & mde, "missing_id_and_description"), (mid & chg, "missing_id_expected_charge"),
        (mid, "missing_id_unexpected"), (mde, "missing_description")], "ok")
    severity = quality.classify([(mam, "high"), (mid & ~chg, "medium")], "low")
    return d.filter(mid | mde | mam).select("*", reason.alias("gap_reason"), severity.alias("gap_severity"))


@query("D26_line_gap_classification", "SELECT doc_id, missing_id, missing_description, missing_amount, charge, gap_reason, gap_severity FROM gaps", uses="gaps")
def d26(t: Tables) -> DataFrame:
    return gaps(t).select("doc_id", "missing_id", "missing_description", "missing_amount", "charge", "gap_reason", "gap_severity")


BACKLOG_SQL = """CASE WHEN high_gaps > 10 THEN '{0}' WHEN unexpected_gaps >= 250 THEN '{1}' WHEN unexpected_gaps >= 18 THEN '{2}' WHEN total_chars >= 100000 THEN '{3}' WHEN gap_rows >= 20 THEN '{4}' ELSE '{5}' END"""
PRIORITIES = ["critical", "critical", "high", "high", "medium", "low"]
REASONS = ["missing_amount_present", "large_unexpected_volume", "high_unexpected_volume", "high_gap_amount", "moderate_total_volume", "small_backlog"]


@query("D27_gap_backlog", f"""
SELECT *, {BACKLOG_SQL.format(*PRIORITIES)} AS backlog_priority, {BACKLOG_SQL.format(*REASONS)} AS backlog_reason FROM (
SELECT source, count(*) AS gap_rows, count(DISTINCT doc_id) AS distinct_documents, CAST(sum(n_chars) AS BIGINT) AS total_chars, count(*) FILTER (gap_severity = 'high') AS high_gaps,
 count(*) FILTER (gap_severity = 'medium') AS medium_gaps, count(*) FILTER (gap_severity = 'low') AS low_gaps, count(*) FILTER (gap_reason = 'missing_id_unexpected') AS unexpected_gaps,
 array_to_string(list_slice(list_sort(list_distinct(list(lang || ':' || gap_reason))), 1, 8), ' | ') AS samples FROM gaps GROUP BY 1)""", uses="gaps")
def d27(t: Tables) -> DataFrame:
    g = stored(gaps(t), "gap-rows")
    sev = F.col("gap_severity")
    a = g.groupBy("source").agg(
        F.count(F.lit(1)).alias("gap_rows"), F.count_distinct("doc_id").alias("distinct_documents"), F.sum("n_chars").alias("total_chars"),
        F.count_if(sev == "high").alias("high_gaps"), F.count_if(sev == "medium").alias("medium_gaps"), F.count_if(sev == "low").alias("low_gaps"),
        F.count_if(F.col("gap_reason") == "missing_id_unexpected").alias("unexpected_gaps"))
    few = agg.distinct_samples(g.withColumn("s", F.concat("lang", F.lit(":"), "gap_reason")), ["source"], "s", 8, "samples")
    steps = [F.col("high_gaps") > 10, F.col("unexpected_gaps") >= 250, F.col("unexpected_gaps") >= 18,
             F.col("total_chars") >= 100000, F.col("gap_rows") >= 20]
    def ladder(labels):
        return quality.classify(list(zip(steps, labels)), labels[-1])
    return a.join(few, "source", "left").select("*", ladder(PRIORITIES).alias("backlog_priority"), ladder(REASONS).alias("backlog_reason"))


@query("D27_gap_summary", """
SELECT lang, gap_reason, gap_severity, count(*) AS gap_rows, count(DISTINCT source) AS sources, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY lang) AS DOUBLE) AS share
FROM gaps GROUP BY 1, 2, 3""", uses="gaps")
def d27_summary(t: Tables) -> DataFrame:
    s = gaps(t).groupBy("lang", "gap_reason", "gap_severity").agg(F.count(F.lit(1)).alias("gap_rows"), F.count_distinct("source").alias("sources"))
    # the window runs over the handful of aggregated rows of a language
    total = F.sum("gap_rows").over(Window.partitionBy("lang"))
    return s.withColumn("share", F.col("gap_rows").cast("double") / total.cast("double"))


ACTIONS = {
    "not_in_use": "Keep NULL unless the member becomes active.",
    "conflict": "Keep NULL; several values apply.",
    "no_evidence": "Populate the attribute in the source.",
    "other": "Review manually.",
}
derived.SQL["unlabelled"] = ([], """
SELECT d.doc_id, lang, source, n_chars, CASE WHEN n_chars < 200 THEN 'not_in_use' WHEN copies > 1 AND labelled > 1 THEN 'conflict' WHEN copies = 1 THEN 'no_evidence' ELSE 'other' END AS gap_reason
FROM documents d JOIN (SELECT md5(text) AS h, count(*) AS copies, count(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1) g ON g.h = md5(d.text)
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")


def unlabelled(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("h")).join(
        t.labels.select("doc_id", "quality"), "doc_id", "left")
    copies = docs.groupBy("h").agg(F.count(F.lit(1)).alias("copies"), F.count("quality").alias("labelled"))
    reason = quality.classify([
        (F.col("n_chars") < 200, "not_in_use"), ((F.col("copies") > 1) & (F.col("labelled") > 1), "conflict"),
        (F.col("copies") == 1, "no_evidence")], "other")
    return docs.filter(F.col("quality").isNull()).join(copies, "h").select("doc_id", "lang", "source", "n_chars", reason.alias("gap_reason"))


def action_of(reason):
    return F.element_at(F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv]), reason)


ACTION_SQL = "CASE gap_reason " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ACTIONS.items()) + " END"


@query("D28_attribute_gap_report", f"SELECT *, {ACTION_SQL} AS recommended_action FROM unlabelled", uses="unlabelled")
def d28(t: Tables) -> DataFrame:
    return unlabelled(t).withColumn("recommended_action", action_of(F.col("gap_reason")))


@query("D28_attribute_gap_summary", f"""
SELECT lang, gap_reason, {ACTION_SQL} AS recommended_action, count(*) AS documents, count(*) FILTER (n_chars >= 1000) AS long_documents, CAST(sum(n_chars) AS BIGINT) AS total_chars,
 array_to_string(list_slice(list_sort(list_distinct(list(source))), 1, 8), ' | ') AS sample_sources FROM unlabelled GROUP BY 1, 2, 3""", uses="unlabelled")
def d28_summary(t: Tables) -> DataFrame:
    u = stored(unlabelled(t), "unlabelled")
    s = u.groupBy("lang", "gap_reason").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("n_chars") >= 1000).alias("long_documents"),
                                            F.sum("n_chars").alias("total_chars"))
    few = agg.distinct_samples(u, ["lang", "gap_reason"], "source", 8, "sample_sources")
    return s.join(few, ["lang", "gap_reason"]).withColumn("recommended_action", action_of(F.col("gap_reason")))


# -- D29 --------------------------------------------------------------------------------
# Labels under review and the approved ones among them.
REVIEW_LABELS = [("red",), ("ring",), ("hot gear",), ("widget",), ("gizmo",), ("old rod",), ("gold",), ("77",), ("plate blue",)]
APPROVED_LABELS = [("ring",)]
derived.SQL["label_review"] = ([], f"""
SELECT label, count(name) AS matched_names, count(DISTINCT p_type) AS matched_types, array_to_string(list_slice(list_sort(list_distinct(list(name) FILTER (name IS NOT NULL))), 1, 10), ' | ') AS sample_names,
 regexp_matches(label, '[a-z]') AS has_letters,
 CASE WHEN count(name) >= 20 THEN 'safe_name_match' WHEN count(name) > 0 THEN 'limited_name_match' WHEN regexp_matches(label, '[a-z]') THEN 'readable_code' ELSE 'needs_manual_lookup' END AS review_signal
FROM {values_sql(REVIEW_LABELS, 'label')} LEFT JOIN (SELECT DISTINCT p_type, p_name AS name FROM part) ON regexp_matches(lower(name), '(^|[^a-z0-9])' || label || '($|[^a-z0-9])')
WHERE label NOT IN (SELECT label FROM {values_sql(APPROVED_LABELS, 'label')}) GROUP BY label""")


def label_review(t: Tables) -> DataFrame:
    labels = seed(t.spark, REVIEW_LABELS, "label string").join(seed(t.spark, APPROVED_LABELS, "label string"), "label", "left_anti")
    names = t.part.select("p_type", F.col("p_name").alias("name")).distinct()
    hits = lookups.word_match(names, "name", labels, "label")
    counted = hits.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p_type").alias("ty"))
    few = agg.distinct_samples(hits, ["label"], "name", 10, "sample_names")
    r = labels.join(counted, "label", "left").join(few, "label", "left").select(
        "label", F.coalesce("n", F.lit(0)).alias("matched_names"), F.coalesce("ty", F.lit(0)).alias("matched_types"),
        "sample_names", F.col("label").rlike("[a-z]").alias("has_letters"))
    signal = quality.classify([
        (F.col("matched_names") >= 20, "safe_name_match"), (F.col("matched_names") > 0, "limited_name_match"),
        (F.col("has_letters"), "readable_code")], "needs_manual_lookup")
    return r.withColumn("review_signal", signal)


@query("D29_label_review", "SELECT label, matched_names, matched_types, nullif(sample_names, '') AS sample_names, has_letters, review_signal FROM label_review", uses="label_review")
def d29(t: Tables) -> DataFrame:
    return label_review(t)


@query("D29_review_shortlist", """
SELECT label, matched_names, review_signal, CAST(row_number() OVER (ORDER BY matched_names DESC, label) AS INTEGER) AS review_rank,
 CAST(dense_rank() OVER (PARTITION BY review_signal ORDER BY matched_types DESC) AS INTEGER) AS rank_in_signal FROM label_review QUALIFY review_rank <= 20""", uses="label_review")
def d29_shortlist(t: Tables) -> DataFrame:
    order = [F.desc("matched_names"), F.asc("label")]
    ranked = label_review(t).withColumn("rank_in_signal", F.dense_rank().over(Window.partitionBy("review_signal").orderBy(F.desc("matched_types"))))
    top = ranked.orderBy(*order).limit(20)
    return top.withColumn("review_rank", F.row_number().over(Window.orderBy(*order))).select(
        "label", "matched_names", "review_signal", "review_rank", "rank_in_signal")


# -- D31 --------------------------------------------------------------------------------
# Event types read as inventory documents, sign and owning unit.
MOVEMENTS = {"view": ("adjustment", 1, "U1"), "purchase": ("issue", -1, "U2"), "signup": ("receipt", 1, "U3"), "click": ("transfer", 1, "U1")}


@query("D31_inventory_movements", """
SELECT 'M' || event_id AS movement_key, event_id AS document_no, m.kind AS movement_type, CAST(k AS BIGINT) AS line_no, CAST(ts AS DATE) AS movement_date,
 m.sign * CASE k WHEN 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE 1 END AS quantity, m.unit AS business_unit
FROM events JOIN (VALUES ('view', 'adjustment', 1, 'U1'), ('purchase', 'issue', -1, 'U2'), ('signup', 'receipt', 1, 'U3'), ('click', 'transfer', 1, 'U1')) m(et, kind, sign, unit) ON et = event_type
CROSS JOIN (VALUES (0), (1)) v(k) WHERE k = 0 OR event_type = 'click'""")
def d31(t: Tables) -> DataFrame:
    # each source keeps its lines under its own array; transfers carry a second, counting line
    def source(event_type):
        kind, sign, unit = MOVEMENTS[event_type]
        e = t.events.filter(F.col("event_type") == event_type)
        qty = F.get_json_object("props", "$.k")
        items = F.concat(F.lit('{"lines":[{"qty":'), qty, F.lit("}"), F.lit(',{"qty":1}' if kind == "transfer" else ""), F.lit("]}"))
        rows = e.select("event_id", "ts", F.posexplode(jsonx.json_array(jsonx.parsed(items), "$.lines")).alias("pos", "l"))
        return rows.select(
            F.concat(F.lit("M"), F.col("event_id").cast("string")).alias("movement_key"), F.col("event_id").alias("document_no"),
            F.col("pos").cast("bigint").alias("line_no"), F.to_date("ts").alias("movement_date"),
            (F.lit(sign) * jsonx.json_number("l", "$.qty", "bigint")).alias("quantity"), F.lit(unit).alias("business_unit"))
    return sets.tagged_union({MOVEMENTS[e][0]: source(e) for e in MOVEMENTS}, "movement_type")


# -- D32, D33 ---------------------------------------------------------------------------
@query("D32_ledger_fact", """
SELECT tenant_id, journal_id, CAST(line_no AS BIGINT) AS line_no, side, tenant_id || '|' || account_id AS account_key, CAST(strftime(posting_date, '%Y%m%d') AS INTEGER) AS date_key,
 base_currency, s.class AS unit, CAST(CASE WHEN side = 'D' THEN amount ELSE 0 END AS DOUBLE) AS debit_amount, CAST(CASE WHEN side = 'C' THEN -amount ELSE 0 END AS DOUBLE) AS credit_amount,
 CAST(doc_rate AS DOUBLE) AS doc_rate, CAST(base_rate AS DOUBLE) AS base_rate, doc_rate IS NOT NULL AS has_market_rate,
 CAST(CAST(amount * doc_rate AS DECIMAL(20,2)) AS DOUBLE) AS market_amount
FROM gl_rated g LEFT JOIN scd s ON s.custkey = g.customer_id AND posting_date BETWEEN valid_from AND coalesce(valid_to, DATE '9999-12-31')""", uses="gl_rated scd")
def d32(t: Tables) -> DataFrame:
    g = gl_rated(t).withColumn("custkey", F.col("customer_id"))
    # every posting has the customer and the day of its order
    pairs = t.orders.select(F.col("o_custkey").alias("custkey"), derived.posting_date(F.col("o_orderkey")).alias("posting_date"))
    g = lookups.validity_join(g, derived.scd(t), ["custkey"], "posting_date", "valid_from", "valid_to", "left", pairs)
    zero = F.lit(0).cast("decimal(18,2)")
    return g.select(
        "tenant_id", "journal_id", F.col("line_no").cast("bigint").alias("line_no"), "side",
        keys.readable_key("tenant_id", "account_id").alias("account_key"), dates.date_key("posting_date").alias("date_key"),
        "base_currency", F.col("class").alias("unit"),
        F.when(F.col("side") == "D", F.col("amount")).otherwise(zero).cast("double").alias("debit_amount"),
        F.when(F.col("side") == "C", -F.col("amount")).otherwise(zero).cast("double").alias("credit_amount"),
        F.col("doc_rate").cast("double").alias("doc_rate"), F.col("base_rate").cast("double").alias("base_rate"),
        F.col("doc_rate").isNotNull().alias("has_market_rate"), converted("amount", "doc_rate").cast("double").alias("market_amount"))


@query("D32_ledger_balances", """
SELECT tenant_id, account_id, posting_date, CAST(sum(s) OVER (PARTITION BY tenant_id, account_id ORDER BY posting_date) - s AS DOUBLE) AS beginning_balance,
 CAST(s AS DOUBLE) AS movement, CAST(sum(s) OVER (PARTITION BY tenant_id, account_id ORDER BY posting_date) AS DOUBLE) AS ending_balance
FROM (SELECT tenant_id, account_id, posting_date, sum(amount) AS s FROM gl GROUP BY 1, 2, 3)""", uses="gl")
def d32_balances(t: Tables) -> DataFrame:
    # postings fold to one row per account and day before the running sum
    day = derived.gl(t).groupBy("tenant_id", "account_id", "posting_date").agg(F.sum("amount").alias("s"))
    w = Window.partitionBy("tenant_id", "account_id").orderBy("posting_date").rowsBetween(Window.unboundedPreceding, 0)
    return day.withColumn("e", F.sum("s").over(w)).select(
        "tenant_id", "account_id", "posting_date", (F.col("e") - F.col("s")).cast("double").alias("beginning_balance"),
        F.col("s").cast("double").alias("movement"), F.col("e").cast("double").alias("ending_balance"))


@query("D33_bi_finance", """
SELECT tenant_id, journal_id, CAST(line_no AS BIGINT) AS line_no, side, year(posting_date) AS year, month(posting_date) AS month,
 account_id || ' - ' || coalesce(s_name, 'Parts ' || substr(account_id, 2)) AS account_label, CASE WHEN side = 'D' THEN 'Expense' ELSE 'Revenue' END AS account_class,
 CAST(coalesce(CASE WHEN base_currency = 'NOK' THEN CAST(amount AS DECIMAL(20,2)) ELSE CAST(amount * base_rate AS DECIMAL(20,2)) END, CAST(amount * doc_rate AS DECIMAL(20,2)), CAST(amount AS DECIMAL(20,2))) AS DOUBLE) AS amount_group, c_name AS customer_name
FROM gl_rated LEFT JOIN supplier ON side = 'C' AND account_id = 'S' || CAST(s_suppkey AS VARCHAR) LEFT JOIN customer ON c_custkey = customer_id""", uses="gl_rated")
def d33_finance(t: Tables) -> DataFrame:
    g = gl_rated(t)
    sup = t.supplier.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("_acc"), "s_name")
    g = g.join(sup, (F.col("side") == "C") & (F.col("account_id") == F.col("_acc")), "left")
    g = g.join(t.customer.select("c_custkey", F.col("c_name").alias("customer_name")), F.col("c_custkey") == F.col("customer_id"), "left")
    name = F.coalesce("s_name", F.concat(F.lit("Parts "), F.substring("account_id", 2, 100)))
    return g.select(
        "tenant_id", "journal_id", F.col("line_no").cast("bigint").alias("line_no"), "side",
        F.year("posting_date").cast("bigint").alias("year"), F.month("posting_date").cast("bigint").alias("month"),
        text.code_label(F.col("account_id"), name).alias("account_label"),
        F.when(F.col("side") == "D", "Expense").otherwise("Revenue").alias("account_class"),
        group_amount(F.col("amount")).cast("double").alias("amount_group"), "customer_name")


@query("D33_bi_sales", """
SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS order_date, c_name || ' - ' || cn.n_name AS customer_label, p_brand || ' - ' || p_name AS part_label, s_name AS supplier_name, sn.n_name AS supplier_nation,
 r_name AS customer_region, o_orderstatus AS status, l_quantity AS quantity, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS DOUBLE) AS net_amount,
 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, l_linenumber) = 1 AS is_latest_line
FROM li JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = cn.n_regionkey
LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey""", uses="li")
def d33_sales(t: Tables) -> DataFrame:
    cust = derived.customer_region(t).select("c_custkey", "c_name", F.col("n_name").alias("cust_nation"), F.col("r_name").alias("customer_region"))
    sup = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        "s_suppkey", F.col("s_name").alias("supplier_name"), F.col("n_name").alias("supplier_nation"))
    part = t.part.select("p_partkey", text.code_label("p_brand", "p_name").alias("part_label"))
    net = (money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)")
    lines = derived.li(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("quantity"), net.alias("net"))
    sold = lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    # greatest (date, order, -line) per customer: a combined maximum instead of ranking each customer's lines
    best = sold.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey", (-F.col("l_linenumber")).alias("n"))).alias("_b")).select(
        F.col("o_custkey").alias("_bc"), "_b")
    wide = lookups.star_lookup(sold, [
        (best, F.col("_bc") == F.col("o_custkey")), (cust, F.col("c_custkey") == F.col("o_custkey")),
        (part, F.col("p_partkey") == F.col("l_partkey")), (sup, F.col("s_suppkey") == F.col("l_suppkey"))])
    return wide.select(
        "l_orderkey", "l_linenumber", F.to_date("o_orderdate").alias("order_date"), text.code_label("c_name", "cust_nation").alias("customer_label"),
        "part_label", "supplier_name", "supplier_nation", "customer_region", F.col("o_orderstatus").alias("status"), "quantity",
        F.col("net").cast("double").alias("net_amount"),
        (F.struct("o_orderdate", "o_orderkey", (-F.col("l_linenumber")).alias("n")) == F.col("_b")).alias("is_latest_line"))


# -- D34 --------------------------------------------------------------------------------
# Manual access overrides.
RLS_OVERRIDES = [
    (" Boss@Example.com ", "ASIA", "Supplier#000000001", "all", None, "sees everything"),
    ("supplier#000000002@example.com", "EUROPE", "Supplier#000000002", None, False, "left the company"),
    (None, "EUROPE", "Supplier#000000003", None, None, "no principal"),
]


@query("D34_row_level_security", f"""
WITH man AS (SELECT lower(trim(u)) AS principal, ten AS tenant_id, person, coalesce(scope, 'sales_person') AS access_scope, coalesce(act, TRUE) AS is_active, 'manual_seed' AS mapping_source, 1 AS pr
  FROM {values_sql([(a, b, c, d, e) for a, b, c, d, e, _ in RLS_OVERRIDES], 'u, ten, person, scope, act').replace('False', 'FALSE')} WHERE u IS NOT NULL),
dir AS (SELECT lower(s_name) || '@example.com' AS principal, r_name AS tenant_id, s_name AS person, 'sales_person' AS access_scope, TRUE AS is_active, 'directory' AS mapping_source, 2 AS pr, s_acctbal >= 0 AS act
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
m AS (SELECT * FROM (SELECT * FROM man UNION ALL SELECT * EXCLUDE (act) FROM dir WHERE act) QUALIFY row_number() OVER (PARTITION BY principal, tenant_id, person ORDER BY pr) = 1)
SELECT m.principal, m.tenant_id, m.person, m.access_scope, m.is_active, m.mapping_source, coalesce(d.act, FALSE) AS has_active_match FROM m LEFT JOIN dir d ON d.tenant_id = m.tenant_id AND d.person = m.person""")
def d34(t: Tables) -> DataFrame:
    geo = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    directory = t.supplier.join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lower("s_name"), F.lit("@example.com")).alias("principal"), F.col("r_name").alias("tenant_id"), F.col("s_name").alias("person"),
        (F.col("s_acctbal") >= 0).alias("act"))
    manual = seed(t.spark, RLS_OVERRIDES, "principal string, tenant_id string, person string, scope string, active boolean, notes string").filter(
        "principal IS NOT NULL AND tenant_id IS NOT NULL AND person IS NOT NULL").select(
        F.lower(F.trim("principal")).alias("principal"), "tenant_id", "person", F.coalesce("scope", F.lit("sales_person")).alias("access_scope"),
        F.coalesce("active", F.lit(True)).alias("is_active"), F.lit("manual_seed").alias("mapping_source"), F.lit(1).alias("pr"))
    auto = directory.filter("act").select("principal", "tenant_id", "person", F.lit("sales_person").alias("access_scope"),
                                          F.lit(True).alias("is_active"), F.lit("directory").alias("mapping_source"), F.lit(2).alias("pr"))
    m = latest_by(manual.unionByName(auto), ["principal", "tenant_id", "person"], [F.asc("pr")]).drop("pr")
    return m.join(directory.select("tenant_id", "person", "act"), ["tenant_id", "person"], "left").select(
        "principal", "tenant_id", "person", "access_scope", "is_active", "mapping_source", F.coalesce("act", F.lit(False)).alias("has_active_match"))


# -- D35-D37 ----------------------------------------------------------------------------
FY = """CASE WHEN report_date <= least(make_date(year(report_date), fy_end_month, 1) + fy_end_day - 1, last_day(make_date(year(report_date), fy_end_month, 1)))
 THEN least(make_date(year(report_date) - 1, fy_end_month, 1) + fy_end_day - 1, last_day(make_date(year(report_date) - 1, fy_end_month, 1)))
 ELSE least(make_date(year(report_date), fy_end_month, 1) + fy_end_day - 1, last_day(make_date(year(report_date), fy_end_month, 1))) END + 1"""


@query("D35_trial_balance_reconciliation", f"""
WITH rep AS (SELECT tenant_id, max(posting_date) AS report_date FROM gl GROUP BY 1),
fy AS (SELECT rep.*, CAST({FY} AS DATE) AS fiscal_year_start FROM rep JOIN tenants USING (tenant_id)),
ours AS (SELECT gl.tenant_id, account_id, sum(amount) AS s FROM gl JOIN fy USING (tenant_id) WHERE posting_date BETWEEN fiscal_year_start AND report_date GROUP BY 1, 2)
SELECT coalesce(snap.tenant_id, ours.tenant_id) AS tenant_id, coalesce(snap.account_id, ours.account_id) AS account_id, fy.report_date, fiscal_year_start,
 CAST(coalesce(reported, 0) AS DOUBLE) AS reported, CAST(coalesce(s, 0) AS DOUBLE) AS ours, CAST(coalesce(s, 0) - coalesce(reported, 0) AS DOUBLE) AS diff
FROM snap FULL JOIN ours ON ours.tenant_id = snap.tenant_id AND ours.account_id = snap.account_id LEFT JOIN fy ON fy.tenant_id = coalesce(snap.tenant_id, ours.tenant_id)""", uses="gl snap tenants")
def d35(t: Tables) -> DataFrame:
    # postings fold to account and day once; snapshot, report date and year-to-date sums read that
    day = stored(derived.gl(t).groupBy("tenant_id", "account_id", "posting_date").agg(
        F.sum("amount").cast("decimal(20,2)").alias("amount")), "ledger-days")
    fy = day.groupBy("tenant_id").agg(F.max("posting_date").alias("report_date")).join(F.broadcast(tenants(t)), "tenant_id").select(
        "tenant_id", "report_date", dates.fiscal_year_start("report_date", "fy_end_month", "fy_end_day").alias("fiscal_year_start"))
    ours = day.join(fy, "tenant_id").filter(F.col("posting_date").between(F.col("fiscal_year_start"), F.col("report_date"))).groupBy(
        "tenant_id", "account_id").agg(F.sum("amount").alias("ours"))
    rec = quality.reconcile(derived.snap(t, day), ours, ["tenant_id", "account_id"], "reported", "ours").join(fy, "tenant_id", "left")
    zero = F.lit(0).cast("decimal(18,2)")
    return rec.select("tenant_id", "account_id", "report_date", "fiscal_year_start", F.coalesce("reported", zero).cast("double").alias("reported"),
                      F.coalesce("ours", zero).cast("double").alias("ours"), F.col("diff").cast("double").alias("diff"))


@query("D36_profit_and_loss_reconciliation", """
WITH p AS (SELECT * FROM gl WHERE posting_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'),
x AS (SELECT tenant_id, account_id, CASE WHEN side = 'C' THEN 'REVENUE' ELSE 'EXPENSE' END AS account_class, sum(CASE WHEN side = 'C' THEN -amount ELSE amount END) + CASE WHEN account_id LIKE '%3' THEN 0.50 ELSE 0 END AS reported
  FROM p WHERE account_id <> 'P7' GROUP BY 1, 2, 3),
o AS (SELECT tenant_id, account_id, CASE WHEN side = 'C' THEN 'REVENUE' ELSE 'EXPENSE' END AS account_class, sum(amount) AS ours FROM p WHERE account_id <> 'S9' GROUP BY 1, 2, 3)
SELECT coalesce(x.tenant_id, o.tenant_id) AS tenant_id, coalesce(x.account_id, o.account_id) AS account_id, coalesce(x.account_class, o.account_class) AS account_class,
 CAST(CASE WHEN x.account_class = 'REVENUE' THEN -reported ELSE reported END AS DOUBLE) AS reported_signed, CAST(ours AS DOUBLE) AS ours,
 CAST(coalesce(ours, 0) - coalesce(CASE WHEN x.account_class = 'REVENUE' THEN -reported ELSE reported END, 0) AS DOUBLE) AS diff
FROM x FULL JOIN o ON o.tenant_id = x.tenant_id AND o.account_id = x.account_id AND o.account_class = x.account_class""", uses="gl")
def d36(t: Tables) -> DataFrame:
    period = derived.gl(t).filter(F.col("posting_date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date")))
    klass = F.when(F.col("side") == "C", "REVENUE").otherwise("EXPENSE")
    sums = stored(period.groupBy("tenant_id", "account_id", klass.alias("account_class")).agg(F.sum("amount").alias("ours")), "period-sums")
    # the external report shows revenue as positive, deviates on some accounts and lacks one; so does the ledger
    off = F.when(F.col("account_id").endswith("3"), F.lit("0.50")).otherwise(F.lit("0.00")).cast("decimal(18,2)")
    sign = F.when(F.col("account_class") == "REVENUE", F.lit(-1)).otherwise(F.lit(1))
    report = sums.filter("account_id <> 'P7'").select("tenant_id", "account_id", "account_class", (F.col("ours") * sign + off).alias("reported"))
    signed = report.withColumn("reported_signed", F.col("reported") * sign).drop("reported")
    rec = quality.reconcile(signed, sums.filter("account_id <> 'S9'"), ["tenant_id", "account_id", "account_class"], "reported_signed", "ours")
    return rec.select("tenant_id", "account_id", "account_class", *[F.col(c).cast("double").alias(c) for c in ("reported_signed", "ours", "diff")])


@query("D37_document_vs_ledger", """
WITH d AS (SELECT r_name AS tenant_id, account_id, CASE side WHEN 'D' THEN 'purchase' ELSE 'sale' END AS document_type, sum(amt) AS doc_amount FROM (
  SELECT o_custkey, 'P' || CAST(part_id % 50 AS VARCHAR) AS account_id, 'D' AS side, amount AS amt FROM ln WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_custkey, 'S' || CAST(supp_id AS VARCHAR), 'C', -amount FROM ln WHERE o_orderstatus <> 'P')
 JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3),
g AS (SELECT tenant_id, account_id, CASE side WHEN 'D' THEN 'purchase' ELSE 'sale' END AS document_type, sum(amount) AS gl_amount FROM gl GROUP BY 1, 2, 3)
SELECT coalesce(d.tenant_id, g.tenant_id) AS tenant_id, coalesce(d.account_id, g.account_id) AS account_id, coalesce(d.document_type, g.document_type) AS document_type,
 CAST(doc_amount AS DOUBLE) AS doc_amount, CAST(gl_amount AS DOUBLE) AS gl_amount, CAST(coalesce(doc_amount, 0) - coalesce(gl_amount, 0) AS DOUBLE) AS diff
FROM d FULL JOIN g ON g.tenant_id = d.tenant_id AND g.account_id = d.account_id AND g.document_type = d.document_type""", uses="ln gl")
def d37(t: Tables) -> DataFrame:
    open_lines = derived.ln(t).filter("o_orderstatus <> 'P'")
    sides = sets.unpivot_pairs(open_lines, ["o_custkey"], {
        "purchase": (F.concat(F.lit("P"), (F.col("part_id") % 50).cast("string")), F.col("amount")),
        "sale": (F.concat(F.lit("S"), F.col("supp_id").cast("string")), -F.col("amount"))}, "document_type", "account_id", "amount")
    # fold per customer and account before the tenant is looked up
    part = sides.groupBy("o_custkey", "account_id", "document_type").agg(F.sum("amount").alias("s"))
    cust = derived.customer_region(t).select("c_custkey", F.col("r_name").alias("tenant_id"))
    docs = part.join(cust, F.col("c_custkey") == F.col("o_custkey")).groupBy("tenant_id", "account_id", "document_type").agg(
        F.sum("s").cast("decimal(28,2)").alias("doc_amount"))
    kind = F.when(F.col("side") == "D", "purchase").otherwise("sale")
    ledger = derived.gl(t).groupBy("tenant_id", "account_id", kind.alias("document_type")).agg(F.sum("amount").alias("gl_amount"))
    rec = quality.reconcile(ledger, docs, ["tenant_id", "account_id", "document_type"], "gl_amount", "doc_amount")
    return rec.select("tenant_id", "account_id", "document_type", *[F.col(c).cast("double").alias(c) for c in ("doc_amount", "gl_amount", "diff")])


# -- D38-D40 ----------------------------------------------------------------------------
TABLE_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
    "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}


@query("D38_key_assertions", "\nUNION ALL ".join(
    [f"SELECT '{n}' AS relation, 'non_null' AS assertion, '{k}' AS subject, count(*) FILTER ({k} IS NULL) AS failures FROM {n}" for n, ks in TABLE_KEYS.items() for k in ks]
    + [f"SELECT '{n}', 'unique_key', '{','.join(ks)}', count(*) FROM (SELECT {','.join(ks)} FROM {n} GROUP BY {','.join(ks)} HAVING count(*) > 1)" for n, ks in TABLE_KEYS.items()]))
def d38(t: Tables) -> DataFrame:
    return quality.union_all([quality.key_constraints(getattr(t, n), ks, n) for n, ks in TABLE_KEYS.items()])


@query("D39_lines_tie_to_header", """
SELECT CAST(o_orderkey AS VARCHAR) AS record_id, CAST(line_total AS DOUBLE) AS line_total, CAST(header AS DOUBLE) AS header_total, CAST(line_total - header AS DOUBLE) AS diff FROM (
 SELECT o.o_orderkey, sum(CASE WHEN amount_types = 'Inclusive' THEN amount - tax ELSE amount END) AS line_total, any_value(CAST(o_totalprice AS DECIMAL(18,2))) AS header
 FROM ln JOIN orders o USING (o_orderkey) GROUP BY 1) WHERE abs(line_total - header) > 0.02 + 0.001 * abs(header)""", uses="ln")
def d39(t: Tables) -> DataFrame:
    docs = order_records(t)
    base = docs.select("*", jsonx.json_scalar("_doc", "$.LineAmountTypes").alias("line_amount_types"))
    lines = flatten_child(base, ORDER_DOCUMENT, "lines", ["line_amount_types"]).select(
        "record_id", net_amount(F.col("line_amount_types"), F.col("line_amount"), F.col("tax_amount")).cast("decimal(18,2)").alias("net"))
    headers = t.orders.select(F.col("o_orderkey").cast("string").alias("record_id"), money("o_totalprice").alias("header"))
    return quality.tie_out(lines, headers, ["record_id"], "net", "header")


@query("D40_unbalanced_journals", """
SELECT tenant_id, journal_id, CAST(sum(amount) AS DOUBLE) AS balance FROM gl GROUP BY 1, 2 HAVING abs(sum(amount)) > 0.02""", uses="gl")
def d40(t: Tables) -> DataFrame:
    return quality.unbalanced(derived.gl(t), ["tenant_id", "journal_id"], "amount").withColumn("balance", F.col("balance").cast("double"))


@query("D40_balance_assertion", """
SELECT count(*) AS unbalanced_journals FROM (SELECT journal_id FROM gl GROUP BY tenant_id, journal_id HAVING abs(sum(amount)) > 0.02) HAVING count(*) > 5""", uses="gl")
def d40_assertion(t: Tables) -> DataFrame:
    return quality.fails_above(quality.unbalanced(derived.gl(t), ["tenant_id", "journal_id"], "amount"), 5, "unbalanced_journals")
