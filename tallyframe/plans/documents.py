"""D-rows on documents, currency and intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.numbers import converted, money
from tallyframe.operators import documents as dm, fx as rates, intervals
from tallyframe.operators.latest import latest_by
from tallyframe.operators.documents import ChildSpec, DocumentSpec
from tallyframe.plans import derived
from tallyframe.plans.derived import BASE_CURRENCY
from tallyframe.plans.registry import query
from tallyframe.sources.registry import Tables
from tallyframe.sources.seeds import seed

ORDER_DOCUMENT = DocumentSpec(
    record_id="OrderID",
    header=[
        ("customer_id", "Customer.ID", "bigint"), ("status", "Type", "string"),
        ("order_date", "Date", "epoch_date"), ("line_amount_types", "LineAmountTypes", "string"),
    ],
    children={"lines": ChildSpec("LineItems", [
        ("line_no", "LineNo", "bigint"), ("part_id", "PartID", "bigint"), ("supplier_id", "SupplierID", "bigint"),
        ("quantity", "Quantity", "money"), ("line_amount", "LineAmount", "money"), ("tax_amount", "TaxAmount", "money"),
    ])},
    counts={"line_item_count": "LineItems"},
)


def order_records(t: Tables) -> DataFrame:
    return dm.parse_records(derived.doc(t))


@query("D1_document_header", """
SELECT CAST(o_orderkey AS VARCHAR) AS record_id, o_custkey AS customer_id, o_orderstatus AS status, order_date, amount_types AS line_amount_types,
  count(*) AS line_item_count FROM ln GROUP BY ALL""", uses="ln")
def d1_header(t: Tables) -> DataFrame:
    pages = dm.flatten_header(order_records(t), ORDER_DOCUMENT, ["page_key"])
    return pages.groupBy("record_id", "customer_id", "status", "order_date", "line_amount_types").agg(
        F.sum("line_item_count").alias("line_item_count"))


@query("D1_document_lines", """
SELECT CAST(o_orderkey AS VARCHAR) AS record_id, CAST(line_no AS BIGINT) AS line_no, part_id, supp_id AS supplier_id, CAST(quantity AS DOUBLE) AS quantity,
  CAST(amount AS DOUBLE) AS line_amount, CAST(tax AS DOUBLE) AS tax_amount FROM ln""", uses="ln")
def d1_lines(t: Tables) -> DataFrame:
    lines = dm.flatten_child(order_records(t), ORDER_DOCUMENT, "lines", [])
    for c in ("quantity", "line_amount", "tax_amount"):
        lines = lines.withColumn(c, F.col(c).cast("double"))
    return lines


@query("D2_line_position_identity", """
SELECT CAST(o_orderkey AS VARCHAR) || '/' || CAST(page_no AS VARCHAR) AS page_key, row_number() OVER (PARTITION BY o_orderkey, page_no ORDER BY line_no) - 1 AS line_position,
  part_id, CAST(amount AS DOUBLE) AS line_amount FROM ln WHERE quantity >= 5""", uses="ln")
def d2(t: Tables) -> DataFrame:
    # lines of small quantity are marked blank; positions count the remaining ones
    line = F.struct(F.col("line_no").alias("LineNo"), F.col("part_id").alias("PartID"), F.col("amount").alias("LineAmount"),
                    (F.col("quantity") < 5).alias("IsBlank"))
    pages = derived.ln(t).groupBy("o_orderkey", "page_no").agg(F.sort_array(F.collect_list(line)).alias("l"))
    docs = pages.select(
        F.concat_ws("/", F.col("o_orderkey").cast("string"), F.col("page_no").cast("string")).alias("page_key"),
        F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("ID"), F.col("l").alias("JournalLines"))).alias("payload"))
    spec = DocumentSpec("ID", [], {"lines": ChildSpec(
        "JournalLines", [("part_id", "PartID", "bigint"), ("line_amount", "LineAmount", "money")],
        position="line_position", blank_flag="IsBlank")})
    return dm.flatten_child(dm.parse_records(docs), spec, "lines", ["page_key"]).select(
        "page_key", "line_position", "part_id", F.col("line_amount").cast("double").alias("line_amount"))


def region_reports(t: Tables) -> DataFrame:
    """Report tree per region: header, a section per nation with a row per segment, a total.

    Sections and rows are bounded by the nations of a region and the segment list.
    """
    counts = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    geo = counts.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    no_attr = F.lit(None).cast("array<struct<Id:string,Value:string>>")
    def cell(v, attr=no_attr):
        return F.struct(v.cast("string").alias("Value"), attr.alias("Attributes"))
    link = F.array(F.struct(F.lit("account").alias("Id"), F.col("c_mktsegment").alias("Value")))
    row = F.struct(F.col("c_mktsegment").alias("_sort"), F.lit("Row").alias("RowType"), F.lit(None).cast("string").alias("Title"),
                   F.array(cell(F.col("c_mktsegment"), link), cell(F.col("n"), link)).alias("Cells"))
    rows_of = F.transform(F.sort_array(F.collect_list(row)), lambda r: F.struct(
        r["RowType"].alias("RowType"), r["Title"].alias("Title"), r["Cells"].alias("Cells")))
    no_cells = F.lit(None).cast(f"array<{dm.CELL}>")
    section = F.struct(F.col("n_nationkey").alias("_sort"), F.lit("Section").alias("RowType"), F.col("n_name").alias("Title"),
                       no_cells.alias("Cells"), F.col("rows").alias("Rows"))
    sections = geo.groupBy("n_regionkey", "n_nationkey", "n_name").agg(rows_of.alias("rows"), F.sum("n").alias("n"))
    per_region = sections.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(section)).alias("s"), F.sum("n").alias("total"))
    no_rows = F.lit(None).cast(f"array<{dm.ROW}>")
    def flat(kind, *cells):
        return F.struct(F.lit(kind).alias("RowType"), F.lit(None).cast("string").alias("Title"), F.array(*cells).alias("Cells"),
                        no_rows.alias("Rows"))
    body = F.transform("s", lambda s: F.struct(s["RowType"].alias("RowType"), s["Title"].alias("Title"),
                                               s["Cells"].alias("Cells"), s["Rows"].alias("Rows")))
    tree = F.concat(F.array(flat("Header", cell(F.lit("Account")), cell(F.lit("Customers")))), body,
                    F.array(flat("SummaryRow", cell(F.lit("Total")), cell(F.col("total")))))
    return per_region.select(F.col("n_regionkey").alias("regionkey"), F.to_json(F.struct(
        F.lit("Customers").alias("ReportID"), tree.alias("Rows"))).alias("payload"))


@query("D3_report_tree_cells", """
WITH c AS (SELECT n_regionkey AS regionkey, n_nationkey, n_name, c_mktsegment AS seg, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL),
r AS (SELECT *, dense_rank() OVER (PARTITION BY regionkey ORDER BY n_nationkey) AS si, row_number() OVER (PARTITION BY n_nationkey ORDER BY seg) - 1 AS ri FROM c)
SELECT regionkey, si AS section_index, n_name AS section_title, ri AS row_index, 'Row' AS row_type, CAST(k AS BIGINT) AS cell_index, seg AS row_label,
  CASE k WHEN 0 THEN 'Account' ELSE 'Customers' END AS column_header, CASE k WHEN 0 THEN seg ELSE CAST(n AS VARCHAR) END AS cell_value,
  'account' AS attribute_id, seg AS attribute_value FROM r CROSS JOIN (VALUES (0), (1)) v(k)
UNION ALL
SELECT regionkey, 1 + count(DISTINCT n_nationkey), NULL, -1, 'SummaryRow', k, 'Total', CASE k WHEN 0 THEN 'Account' ELSE 'Customers' END,
  CASE k WHEN 0 THEN 'Total' ELSE CAST(CAST(sum(n) AS BIGINT) AS VARCHAR) END, NULL, NULL FROM c CROSS JOIN (VALUES (0), (1)) v(k) GROUP BY regionkey, k""")
def d3(t: Tables) -> DataFrame:
    return dm.report_cells(region_reports(t), "payload", ["regionkey"]).drop("report_index", "attributes_json")


@query("D4_header_context_on_lines", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date
FROM li LEFT JOIN orders ON o_orderkey = l_orderkey""", uses="li")
def d4(t: Tables) -> DataFrame:
    head = latest_by(t.orders, ["o_orderkey"], [F.desc("o_orderdate")]).select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_date"))
    return derived.li(t).join(head, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "o_custkey", "o_orderstatus", "order_date")


def net_amount(amount_types, amount, tax):
    """Tax-exclusive amount."""
    return F.when(amount_types == "Inclusive", amount - F.coalesce(tax, F.lit(0).cast("decimal(18,2)"))).otherwise(amount)


@query("D5_net_of_tax", """
SELECT o_orderkey, CAST(line_no AS BIGINT) AS line_no, amount_types, CAST(CASE WHEN amount_types = 'Inclusive' THEN amount - tax ELSE amount END AS DOUBLE) AS net_amount FROM ln""", uses="ln")
def d5(t: Tables) -> DataFrame:
    return derived.ln(t).select("o_orderkey", F.col("line_no").cast("bigint").alias("line_no"), "amount_types", net_amount(
        F.col("amount_types"), F.col("amount"), F.col("tax")).cast("double").alias("net_amount"))


SQL_DAILY = f"""
SELECT currency, d AS calendar_date, rate_date, exchange_rate, 'feed' AS rate_source, FALSE AS is_same_currency,
  rate_date IS NOT NULL AS has_market_rate, coalesce(rate_date < d, FALSE) AS is_rate_filled_forward FROM (
  SELECT c.currency, s.d, fx.rate_date, fx.exchange_rate, row_number() OVER (PARTITION BY c.currency, s.d ORDER BY fx.rate_date DESC NULLS LAST) AS rn
  FROM (SELECT DISTINCT currency FROM fx) c CROSS JOIN spine s LEFT JOIN fx ON fx.currency = c.currency AND fx.rate_date <= s.d) WHERE rn = 1
UNION ALL SELECT '{BASE_CURRENCY}', d, d, CAST(1 AS DECIMAL(18,6)), 'self', TRUE, TRUE, FALSE FROM spine"""
derived.SQL["spine"] = (["fx"], f"""
SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM (
  SELECT min(rate_date) AS a, greatest(max(rate_date), (SELECT max({derived.SQL_POSTING.format(k='o_orderkey')}) FROM orders)) AS b FROM fx)""")
derived.SQL["daily"] = (["fx", "spine"], SQL_DAILY)


def daily(t: Tables) -> DataFrame:
    last = t.orders.agg(F.max(derived.posting_date(F.col("o_orderkey"))).alias("max_date"))
    return rates.daily_rates(derived.fx(t), BASE_CURRENCY, last)


@query("D6_base_currency_amount", f"""
SELECT o_orderkey, o.currency, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * coalesce(exchange_rate, 1) AS DECIMAL(20,2)) AS DOUBLE) AS base_amount
FROM (SELECT *, {derived.SQL_CURRENCY.format(k='o_orderkey')} AS currency, {derived.SQL_POSTING.format(k='o_orderkey')} - 2 AS posted FROM orders) o
LEFT JOIN daily ON daily.currency = o.currency AND calendar_date = posted""", uses="daily")
def d6(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    o = t.orders.select("o_orderkey", "o_totalprice", derived.currency_of(k).alias("currency"),
                        F.date_sub(derived.posting_date(k), 2).alias("posted"))
    o = rates.attach_rate(o, daily(t), F.col("currency"), F.col("posted"), "r")
    return o.select("o_orderkey", "currency", converted("o_totalprice", F.coalesce("r", F.lit(1).cast("decimal(18,6)"))).cast(
        "double").alias("base_amount"))


@query("D7_guarded_dimension_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, p.p_name, k.part_key FROM li JOIN part p ON p_partkey = l_partkey
JOIN (SELECT p_name, min(p_partkey) AS part_key FROM part GROUP BY 1) k ON k.p_name = p.p_name""", uses="li")
def d7(t: Tables) -> DataFrame:
    # names repeat: fold the lookup to one row per name first, or every line would multiply
    named = t.part.select("p_partkey", "p_name")
    by_name = t.part.groupBy("p_name").agg(F.min("p_partkey").alias("part_key"))
    resolved = named.join(by_name, "p_name")
    return derived.li(t).select("l_orderkey", "l_linenumber", "l_partkey").join(
        resolved, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


@query("D8_rate_normalization", f"""
WITH q AS (SELECT currency, rate_date, CAST(exchange_rate AS DOUBLE) AS quoted, currency IN ('SEK', 'DKK') AS div FROM fx),
d AS (SELECT currency, rate_date, CASE WHEN div THEN 1.0::DOUBLE / quoted ELSE quoted END AS r FROM q)
SELECT from_currency, to_currency, rate_date, exchange_rate, is_inverse_rate,
  rate_date = max(rate_date) OVER (PARTITION BY from_currency, to_currency) AS is_latest FROM (
SELECT currency AS from_currency, '{BASE_CURRENCY}' AS to_currency, rate_date, r AS exchange_rate, FALSE AS is_inverse_rate FROM d
UNION ALL SELECT '{BASE_CURRENCY}', currency, rate_date, 1.0::DOUBLE / r, TRUE FROM d)""", uses="fx")
def d8(t: Tables) -> DataFrame:
    quotes = derived.fx(t).select(
        "currency", "rate_date", F.col("exchange_rate").cast("double").alias("quoted"),
        F.when(F.col("currency").isin("SEK", "DKK"), "divide").otherwise("multiply").alias("method"))
    return rates.normalize_quotes(quotes, BASE_CURRENCY)


@query("D9_daily_rates", """
SELECT currency, calendar_date, rate_date, CAST(exchange_rate AS DOUBLE) AS exchange_rate, 1.0::DOUBLE / CAST(exchange_rate AS DOUBLE) AS inverse_rate,
  rate_source, is_same_currency, has_market_rate, is_rate_filled_forward FROM daily""", uses="daily")
def d9(t: Tables) -> DataFrame:
    r = daily(t).withColumn("exchange_rate", F.col("exchange_rate").cast("double"))
    return r.withColumn("inverse_rate", F.try_divide(F.lit(1.0), F.col("exchange_rate")))


# Books currency and fiscal year end (month, day) per tenant.
TENANTS = [
    ("AFRICA", "NOK", 12, 31), ("AMERICA", "USD", 1, 15), ("ASIA", "NOK", 2, 29), ("EUROPE", "EUR", 6, 30), ("MIDDLE EAST", "SEK", 1, 10),
]
TENANT_SCHEMA = "tenant_id string, base_currency string, fy_end_month int, fy_end_day int"
derived.SQL["tenants"] = ([], "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{c}', {m}, {d})" for n, c, m, d in TENANTS) + ") v(tenant_id, base_currency, fy_end_month, fy_end_day)")


def tenants(t: Tables) -> DataFrame:
    return seed(t.spark, TENANTS, TENANT_SCHEMA)


derived.SQL["gl_rated"] = (["gl", "tenants", "daily"], """
SELECT gl.*, base_currency, x.exchange_rate AS doc_rate, b.exchange_rate AS base_rate FROM gl
JOIN tenants USING (tenant_id)
LEFT JOIN daily x ON x.currency = gl.currency AND x.calendar_date = posting_date - 2
LEFT JOIN daily b ON b.currency = base_currency AND b.calendar_date = posting_date - 2""")


def gl_rated(t: Tables) -> DataFrame:
    """Postings with the rates of their document and books currency two days before."""
    d = daily(t)
    g = derived.gl(t).join(F.broadcast(tenants(t)), "tenant_id")
    day = F.date_sub("posting_date", 2)
    g = rates.attach_rate(g, d, F.col("currency"), day, "doc_rate")
    return rates.attach_rate(g, d, F.col("base_currency"), day, "base_rate")


def group_amount(books_amount):
    return rates.group_amount(F.col("base_currency"), BASE_CURRENCY, books_amount, F.col("base_rate"), F.col("amount"), F.col("doc_rate"))


@query("D10_group_currency_amount", """
SELECT tenant_id, journal_id, CAST(line_no AS BIGINT) AS line_no, side, CAST(coalesce(
  CASE WHEN base_currency = 'NOK' AND l_linestatus = 'F' THEN CAST(amount AS DECIMAL(20,2))
       WHEN l_linestatus = 'F' THEN CAST(amount * base_rate AS DECIMAL(20,2)) END,
  CAST(amount * doc_rate AS DECIMAL(20,2)), CAST(amount AS DECIMAL(20,2))) AS DOUBLE) AS group_amount FROM gl_rated""", uses="gl_rated")
def d10(t: Tables) -> DataFrame:
    books = F.when(F.col("l_linestatus") == "F", F.col("amount"))
    return gl_rated(t).select("tenant_id", "journal_id", F.col("line_no").cast("bigint").alias("line_no"), "side",
                              group_amount(books).cast("double").alias("group_amount"))


derived.SQL["merged"] = (["win"], """
SELECT custkey, min(d_from) AS d_from, max(d_to) AS d_to, count(*) AS interval_count FROM (
 SELECT *, sum(CASE WHEN p IS NULL OR d_from > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY custkey ORDER BY d_from, d_to ROWS UNBOUNDED PRECEDING) AS g FROM (
  SELECT custkey, d_from, d_to, max(d_to) OVER (PARTITION BY custkey ORDER BY d_from, d_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM win))
GROUP BY custkey, g""")


@query("D11_interval_merging", "SELECT * FROM merged", uses="merged")
def d11(t: Tables) -> DataFrame:
    return intervals.merge_intervals(derived.win(t), ["custkey"], "d_from", "d_to").drop("island_id")


@query("D13_breakpoints_to_ranges", """
SELECT p_brand, p_type, range_start, coalesce(lead(range_start) OVER (PARTITION BY p_brand, p_type ORDER BY range_start) - 1, CASE WHEN range_start < 10 THEN 9 ELSE 99 END) AS range_end
FROM (SELECT DISTINCT p_brand, p_type, p_size AS range_start FROM part)""")
def d13(t: Tables) -> DataFrame:
    points = t.part.select("p_brand", "p_type", F.col("p_size").alias("range_start")).distinct()
    cap = F.when(F.col("range_start") < 10, 9).otherwise(99)
    return intervals.breakpoint_ranges(points, ["p_brand", "p_type"], "range_start", "range_end", cap)


@query("D45_lines_at_market_rate", f"""
SELECT l_orderkey, l_linenumber, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * exchange_rate AS DECIMAL(20,2)) AS DOUBLE) AS market_amount,
  CAST(CAST(CAST(l_quantity AS DECIMAL(12,2)) * CAST(CAST(p_retailprice AS DECIMAL(12,2)) * exchange_rate AS DECIMAL(20,2)) AS DECIMAL(24,2)) AS DOUBLE) AS market_cost
FROM (SELECT *, {derived.SQL_CURRENCY.format(k='l_orderkey')} AS currency, {derived.SQL_POSTING.format(k='l_orderkey')} - 2 AS posted FROM li) l
LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN daily ON daily.currency = l.currency AND calendar_date = posted""", uses="li daily")
def d45(t: Tables) -> DataFrame:
    k = F.col("l_orderkey")
    l = derived.li(t).join(t.part.select("p_partkey", "p_retailprice"), F.col("p_partkey") == F.col("l_partkey"), "left")
    l = rates.attach_rate(l, daily(t), derived.currency_of(k), F.date_sub(derived.posting_date(k), 2), "r")
    cost = F.try_multiply(money("l_quantity", 12), converted(money("p_retailprice", 12), "r")).cast("decimal(24,2)")
    return l.select("l_orderkey", "l_linenumber", converted("l_extendedprice", "r").cast("double").alias("market_amount"),
                    cost.cast("double").alias("market_cost"))
