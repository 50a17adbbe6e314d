"""P-rows (projection and predicates) and F-rows (scalar functions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions import dates, jsonx, keys, numbers, text
from tallyframe.operators.sets import pad_union
from tallyframe.plans.registry import query
from tallyframe.sources.registry import Tables


@query("P1_project_rename", """
SELECT c_custkey AS party_id, c_name AS party_name, CAST(c_nationkey AS BIGINT) AS country_id,
       c_acctbal AS balance, lower(c_mktsegment) AS segment, 'customer' AS source_system
FROM customer""")
def p1(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("party_name"),
        F.col("c_nationkey").cast("bigint").alias("country_id"), F.col("c_acctbal").alias("balance"),
        F.lower("c_mktsegment").alias("segment"), F.lit("customer").alias("source_system"))


@query("P2_safe_cast", """
SELECT p_partkey, TRY_CAST(p_name AS INTEGER) AS name_as_int,
       TRY_CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS brand_no,
       TRY_CAST(p_type AS DOUBLE) AS type_as_double
FROM part""")
def p2(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.col("p_name").try_cast("int").alias("name_as_int"),
        F.regexp_extract("p_brand", r"(\d+)$", 1).try_cast("int").alias("brand_no"),
        F.col("p_type").try_cast("double").alias("type_as_double"))


@query("P3_soft_delete_filter", """
SELECT doc_id, lang, source, 'distinct_from_true' AS spelling
FROM documents LEFT JOIN (SELECT doc_id, toxic = 1 AS is_deleted FROM labels) USING (doc_id)
WHERE is_deleted IS DISTINCT FROM TRUE
UNION ALL
SELECT doc_id, lang, source, 'false_or_null'
FROM documents LEFT JOIN (SELECT doc_id, toxic = 1 AS is_deleted FROM labels) USING (doc_id)
WHERE is_deleted = FALSE OR is_deleted IS NULL""")
def p3(t: Tables) -> DataFrame:
    flags = t.labels.select("doc_id", (F.col("toxic") == 1).alias("is_deleted"))
    d = t.documents.select("doc_id", "lang", "source").join(flags, "doc_id", "left")
    gone = F.col("is_deleted")
    spellings = F.array_compact(F.array(
        F.when(~gone.eqNullSafe(True), "distinct_from_true"),
        F.when((gone == F.lit(False)) | gone.isNull(), "false_or_null")))
    return d.select("doc_id", "lang", "source", F.explode(spellings).alias("spelling"))


@query("P4_multi_format_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed_date, form FROM (
SELECT o_orderkey, o_orderdate, CASE o_orderpriority WHEN '1-URGENT' THEN 'date' WHEN '2-HIGH' THEN 'datetime'
  WHEN '3-MEDIUM' THEN 'timestamp' WHEN '4-NOT SPECIFIED' THEN 'period' ELSE 'bad' END AS form FROM orders)
WHERE form IN ('date', 'datetime', 'timestamp')
UNION ALL
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE), 'period' FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
UNION ALL
SELECT o_orderkey, CAST(NULL AS DATE), 'bad' FROM orders WHERE o_orderpriority = '5-LOW'""")
def p4(t: Tables) -> DataFrame:
    p, d = F.col("o_orderpriority"), F.col("o_orderdate")
    form = (F.when(p == "1-URGENT", "date").when(p == "2-HIGH", "datetime").when(p == "3-MEDIUM", "timestamp")
            .when(p == "4-NOT SPECIFIED", "period").otherwise("bad"))
    raw = (F.when(p == "1-URGENT", F.date_format(d, "yyyy-MM-dd"))
           .when(p == "2-HIGH", F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
           .when(p == "3-MEDIUM", F.date_format(d, "yyyy-MM-dd HH:mm:ss.SSSSSS'000Z'"))
           .when(p == "4-NOT SPECIFIED", F.date_format(d, "yyyyMM"))
           .otherwise(F.date_format(d, "'n/a' yyyy")))
    return t.orders.select("o_orderkey", dates.any_date(raw).alias("parsed_date"), form.alias("form"))


@query("P5_alternate_path_cascade", """
SELECT event_id, json_extract_string(props, '$.k') AS code FROM events""")
def p5(t: Tables) -> DataFrame:
    # the key sits under another name per event type; objects under a tried name must not win
    alt = (F.when(F.col("event_type") == "view", F.regexp_replace("props", '"k"', '"code"'))
           .when(F.col("event_type") == "click", F.regexp_replace("props", r'\{"k": (\d+)\}',
                                                                  '{"code": {"id": 0}, "item": {"id": $1}}'))
           .otherwise(F.col("props")))
    v = t.events.select("event_id", jsonx.parsed(alt).alias("v"))
    return v.select("event_id", jsonx.first_scalar("v", "$.code", "$.item.id", "$.k").alias("code"))


@query("P6_blank_to_null", """
SELECT doc_id, nullif(trim(text, ' '), '') IS NULL AS is_blank,
       CAST(length(nullif(trim(text, ' '), '')) AS INTEGER) AS trimmed_chars FROM documents""")
def p6(t: Tables) -> DataFrame:
    v = text.blank_to_null("text")
    return t.documents.select("doc_id", v.isNull().alias("is_blank"), F.length(v).alias("trimmed_chars"))


@query("P7_star_minus_columns", "SELECT * EXCLUDE (l_tax, l_discount, l_shipdate) FROM lineitem")
def p7(t: Tables) -> DataFrame:
    return t.lineitem.drop("l_tax", "l_discount", "l_shipdate")


@query("P8_typed_null_padding", """
SELECT c_custkey AS party_id, c_name AS party_name, c_nationkey AS nationkey, c_acctbal AS balance,
       c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS supplier_group, 'customer' AS party_type FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, CASE WHEN s_acctbal < 0 THEN 'debtor' ELSE 'creditor' END, 'supplier'
FROM supplier""")
def p8(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("party_id"), F.col("c_name").alias("party_name"),
                          F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("balance"),
                          F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("party_type"))
    s = t.supplier.select(F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("party_name"),
                          F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("balance"),
                          F.when(F.col("s_acctbal") < 0, "debtor").otherwise("creditor").alias("supplier_group"),
                          F.lit("supplier").alias("party_type"))
    return pad_union([c, s], {
        "party_id": "bigint", "party_name": "string", "nationkey": "int", "balance": "double",
        "segment": "string", "supplier_group": "string", "party_type": "string"})


@query("P9_classify_with_rule", """
SELECT o_orderkey,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high' WHEN o_totalprice >= 400000 THEN 'high'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'normal' WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'low' END AS priority_class,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'priority_code' WHEN o_totalprice >= 400000 THEN 'large_amount'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'priority_code' WHEN o_orderstatus = 'F' THEN 'status' ELSE 'default' END AS priority_rule
FROM orders""")
def p9(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    hit = (F.when(p.isin("1-URGENT", "2-HIGH"), F.struct(F.lit("high").alias("c"), F.lit("priority_code").alias("r")))
           .when(F.col("o_totalprice") >= 400000, F.struct(F.lit("high").alias("c"), F.lit("large_amount").alias("r")))
           .when(p == "3-MEDIUM", F.struct(F.lit("normal").alias("c"), F.lit("priority_code").alias("r")))
           .when(F.col("o_orderstatus") == "F", F.struct(F.lit("closed").alias("c"), F.lit("status").alias("r")))
           .otherwise(F.struct(F.lit("low").alias("c"), F.lit("default").alias("r"))))
    return t.orders.select("o_orderkey", hit.alias("h")).select(
        "o_orderkey", F.col("h.c").alias("priority_class"), F.col("h.r").alias("priority_rule"))


@query("P10_flag_parsing", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_returnflag IN ('R', 'A') AS flag FROM lineitem""")
def p10(t: Tables) -> DataFrame:
    r = F.col("l_returnflag")
    raw = F.when(r == "R", " x ").when(r == "A", "True").otherwise("no")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", text.is_true_word(raw).alias("flag"))


@query("P11_placeholder_to_null", """
SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
  CASE WHEN o_orderstatus = 'O' THEN DATE '9999-12-31' ELSE CAST(o_orderdate AS DATE) END AS valid_to,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS closed_on FROM orders""")
def p11(t: Tables) -> DataFrame:
    far = F.lit(dates.OPEN_END).cast("date")
    valid_to = F.when(F.col("o_orderstatus") == "O", far).otherwise(F.to_date("o_orderdate"))
    return t.orders.select(
        "o_orderkey", text.placeholder_to_null("o_orderpriority", ["4-NOT SPECIFIED"]).alias("priority"),
        valid_to.alias("valid_to"),
        text.placeholder_to_null(valid_to, [far]).alias("closed_on"))


@query("P12_code_name_label", """
SELECT n_nationkey, coalesce(r_name || ' - ' || n_name, r_name, n_name) AS label,
  coalesce(CASE WHEN n_nationkey < 5 THEN NULL ELSE r_name END || ' - ' || CASE WHEN n_regionkey = 1 THEN NULL ELSE n_name END,
           CASE WHEN n_nationkey < 5 THEN NULL ELSE r_name END, CASE WHEN n_regionkey = 1 THEN NULL ELSE n_name END) AS partial_label
FROM nation JOIN region ON r_regionkey = n_regionkey""")
def p12(t: Tables) -> DataFrame:
    j = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    code = F.when(F.col("n_nationkey") >= 5, F.col("r_name"))
    name = F.when(F.col("n_regionkey") != 1, F.col("n_name"))
    return j.select("n_nationkey", text.code_label("r_name", "n_name").alias("label"),
                    text.code_label(code, name).alias("partial_label"))


@query("F1_string_functions", """
SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, length(p_name) AS len, substr(p_name, 1, 3) AS pre,
  lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, starts_with(p_name, 'red') AS is_red,
  printf('%03d', p_size) AS fmt, p_brand || '/' || p_type AS joined, trim('  ' || p_name || ' ') AS trimmed FROM part""")
def f1(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"),
        F.length("p_name").cast("bigint").alias("len"), F.substring("p_name", 1, 3).alias("pre"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
        F.col("p_name").startswith("red").alias("is_red"), F.format_string("%03d", "p_size").alias("fmt"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"))


@query("F2_regex_functions", r"""
SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host,
  regexp_matches(url, '[?&]utm_source=') AS has_utm, regexp_replace(url, '^https?://(www\.|m\.|blog\.)?', '') AS bare,
  TRY_CAST(regexp_extract(url, '/(\d+)', 1) AS BIGINT) AS page_no FROM pages""")
def f2(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("host"),
        F.col("url").rlike(r"[?&]utm_source=").alias("has_utm"),
        F.regexp_replace("url", r"^https?://(www\.|m\.|blog\.)?", "").alias("bare"),
        F.regexp_extract("url", r"/(\d+)", 1).try_cast("bigint").alias("page_no"))


@query("F3_normalize_identifier", """
SELECT 'part' AS kind, p_partkey AS id, nullif(upper(regexp_replace(trim(p_name), '[^A-Z0-9]', '', 'g')), '') AS norm_strict,
  nullif(regexp_replace(upper(trim(p_name)), '[^A-Z0-9]', '', 'g'), '') AS norm_folded FROM part
UNION ALL
SELECT 'customer', c_custkey, nullif(upper(regexp_replace(trim(c_name), '[^A-Z0-9]', '', 'g')), ''),
  nullif(regexp_replace(upper(trim(c_name)), '[^A-Z0-9]', '', 'g'), '') FROM customer""")
def f3(t: Tables) -> DataFrame:
    def both(df, kind, key, name):
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"),
                         text.normalize_identifier(name).alias("norm_strict"),
                         text.normalize_identifier(name, upper_first=True).alias("norm_folded"))
    return both(t.part, "part", "p_partkey", "p_name").unionByName(
        both(t.customer, "customer", "c_custkey", "c_name"))


@query("F4_epoch_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS decoded FROM orders""")
def f4(t: Tables) -> DataFrame:
    ms = (F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400000).cast("string")
    s = F.col("o_orderstatus")
    raw = (F.when(s == "O", F.concat(F.lit("/Date("), ms, F.lit("+1000)/")))
           .when(s == "F", F.concat(F.lit("/Date("), ms, F.lit(")/"))).otherwise(F.concat(F.lit("Date "), ms)))
    return t.orders.select("o_orderkey", dates.epoch_date(raw).alias("decoded"))


@query("F5_iso_prefix", """
SELECT event_id, CAST(ts AS DATE) AS day_part, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text FROM events""")
def f5(t: Tables) -> DataFrame:
    raw = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'789Z'")
    back = dates.iso_datetime(raw)
    return t.events.select("event_id", dates.iso_date(raw).alias("day_part"),
                           F.date_format(back, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"))


@query("F6_date_functions", """
SELECT o_orderkey, try_strptime(strftime(o_orderdate, '%d.%m.%Y'), '%d.%m.%Y')::DATE AS parsed,
  strftime(o_orderdate, '%Y-%m') AS ym, extract(year FROM o_orderdate) AS y, extract(quarter FROM o_orderdate) AS q,
  extract(week FROM o_orderdate) AS iso_week, extract(dow FROM o_orderdate) + 1 AS weekday,
  CAST(o_orderdate AS DATE) + 30 AS due, make_date(year(o_orderdate), 12, 31) AS year_end,
  date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS age_days FROM orders""")
def f6(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.try_to_date(F.date_format(d, "dd.MM.yyyy"), "dd.MM.yyyy").alias("parsed"),
        F.date_format(d, "yyyy-MM").alias("ym"), F.year(d).cast("bigint").alias("y"),
        F.quarter(d).cast("bigint").alias("q"), F.weekofyear(d).cast("bigint").alias("iso_week"),
        F.dayofweek(d).cast("bigint").alias("weekday"), F.date_add(d, 30).alias("due"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("year_end"),
        F.datediff(d, F.lit("1995-01-01").cast("date")).cast("bigint").alias("age_days"))


@query("F7_date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders")
def f7(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.date_key("o_orderdate").alias("date_key"))


@query("F8_math_functions", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(floor(l_extendedprice / 100) AS BIGINT) AS hundreds,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 0) AS DOUBLE) AS rounded, abs(-l_quantity) AS qty,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END AS ratio,
  greatest(l_discount, l_tax) AS larger,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE greatest(l_discount, l_tax) END AS strict_larger,
  CAST(l_linenumber AS BIGINT) * l_partkey AS product FROM lineitem""")
def f8(t: Tables) -> DataFrame:
    gated = F.when(F.col("l_returnflag") != "N", F.col("l_tax"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.floor(F.col("l_extendedprice") / 100).alias("hundreds"),
        F.round(numbers.money("l_extendedprice"), 0).cast("double").alias("rounded"),
        F.abs(-F.col("l_quantity")).alias("qty"), numbers.safe_divide("l_discount", "l_tax").alias("ratio"),
        F.greatest("l_discount", "l_tax").alias("larger"),
        numbers.strict_greatest(F.col("l_discount"), gated).alias("strict_larger"),
        F.try_multiply(F.col("l_linenumber").cast("bigint"), F.col("l_partkey")).alias("product"))


@query("F9_surrogate_key", """
SELECT o_orderkey, CAST(CAST(u AS HUGEINT) - CASE WHEN u >= 9223372036854775808 THEN 18446744073709551616 ELSE 0 END AS BIGINT) AS order_hash
FROM (SELECT o_orderkey, CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || nullif(o_orderpriority, '4-NOT SPECIFIED')), 1, 16)) AS UBIGINT) AS u
      FROM orders) k""")
def f9(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", keys.surrogate_key(
        "o_orderkey", text.placeholder_to_null("o_orderpriority", ["4-NOT SPECIFIED"])).alias("order_hash"))


@query("F10_readable_key", "SELECT n_nationkey, n_regionkey || '|' || n_name AS nation_key FROM nation")
def f10(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", keys.readable_key("n_regionkey", "n_name").alias("nation_key"))


@query("F11_query_string_map", r"""
SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
  nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref,
  nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source FROM pages""")
def f11(t: Tables) -> DataFrame:
    q = text.query_map(F.regexp_extract("url", r"\?([^#]*)", 1))
    return t.pages.select("page_id", q.alias("q")).select(
        "page_id", *[F.col("q").getItem(k).alias(k) for k in ("page", "ref", "utm_source")])


@query("F12_null_functions", """
SELECT doc_id, coalesce(quality, -1) AS quality_or_default, nullif(quality, 0) AS nonzero_quality,
  CASE WHEN toxic IS NULL THEN 'unknown' WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS toxic_label,
  ifnull(toxic, 9) AS toxic_or_nine FROM documents LEFT JOIN labels USING (doc_id)""")
def f12(t: Tables) -> DataFrame:
    j = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return j.select(
        "doc_id", F.coalesce("quality", F.lit(-1)).alias("quality_or_default"),
        F.nullif("quality", F.lit(0)).alias("nonzero_quality"),
        F.when(F.col("toxic").isNull(), "unknown").when(F.col("toxic") == 1, "yes").otherwise("no").alias("toxic_label"),
        F.ifnull("toxic", F.lit(9)).alias("toxic_or_nine"))
