"""Relations derived from the given tables, each in Spark and in SQL.

They stand in for the feeds of an accounting system: line versions, market rates,
validity-windowed mappings, nested documents and a double-entry ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.numbers import money
from tallyframe.operators.latest import latest_by
from tallyframe.operators.intervals import windows_from_dates
from tallyframe.operators.partitions import dealt
from tallyframe.sources.registry import Tables
from tallyframe.sources.seeds import seed

# Currencies by position and the reporting currency.
CURRENCIES = ["EUR", "USD", "SEK", "DKK"]
BASE_CURRENCY = "NOK"
LINES_PER_PAGE = 50

# Wildcard rules, NULL matches everything.
RULES = [
    ("Brand#1", None, None, "any brand 1"),
    ("Brand#1", "PROMO", None, "promo brand 1"),
    ("Brand#1", "PROMO", "S", "small promo brand 1"),
    ("Brand#2", None, "L", "large brand 2"),
    ("Brand#2", "ECONOMY", None, "economy brand 2"),
    ("Brand#3", "SMALL", "M", "mid small brand 3"),
    ("Brand#3", None, None, "any brand 3"),
    ("Brand#4", "LARGE", "L", "large brand 4"),
    ("Brand#5", None, "S", "small brand 5"),
    ("Brand#5", "STANDARD", "S", "small standard brand 5"),
]
RULES_SCHEMA = "brand string, type string, size_band string, category string"

SQL: dict[str, tuple[list[str], str]] = {}


def with_relations(names: list[str], body: str) -> str:
    """Prefix ``body`` with the common table expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in SQL[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({SQL[n][1].strip()})" for n in order)
    text = body.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {ctes},\n{text[5:]}"
    return f"WITH {ctes}\n{text}"


def currency_of(key):
    """Currency assigned to a numeric key by position."""
    pos = F.pmod(key, F.lit(len(CURRENCIES)))
    return F.elt((pos + 1).cast("int"), *[F.lit(c) for c in CURRENCIES])


SQL_CURRENCY = "list_extract(['EUR','USD','SEK','DKK'], CAST({k} % 4 + 1 AS INT))"


def size_band(size):
    return F.when(size <= 15, "S").when(size <= 35, "M").otherwise("L")


def posting_date(key):
    """Posting day inside the month covered by the rate feed."""
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(key, F.lit(30)).cast("int"))


SQL_POSTING = "(DATE '2024-01-01' + CAST({k} % 30 AS INT))"


# -- li: latest version of a line ------------------------------------------------
SQL["li"] = ([], """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey, l_suppkey) = 1
""")


def li(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return latest_by(
        dealt(t.lineitem, t.lineitem.count(), *keys), keys,
        [F.desc("l_shipdate"), F.desc("l_extendedprice"), F.asc("l_partkey"), F.asc("l_suppkey")],
    )


# -- fx: market-rate feed, published on weekdays only -----------------------------
SQL["fx"] = ([], f"""
SELECT currency, rate_date, exchange_rate FROM (
  SELECT {SQL_CURRENCY.format(k='user_id')} AS currency, CAST(ts AS DATE) AS rate_date,
         CAST(1 + CAST(value AS DECIMAL(18,6)) / 100 AS DECIMAL(18,6)) AS exchange_rate,
         row_number() OVER (PARTITION BY user_id % 4, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type = 'purchase')
WHERE rn = 1 AND dayofweek(rate_date) NOT IN (0, 6)
""")


def fx(t: Tables) -> DataFrame:
    quotes = (
        t.events.filter(F.col("event_type") == "purchase")
        .select(
            currency_of(F.col("user_id")).alias("currency"),
            F.to_date("ts").alias("rate_date"),
            ((F.lit(1) + F.col("value").cast("decimal(18,6)") / F.lit(100)).cast("decimal(18,6)")).alias("exchange_rate"),
            "ts", "event_id",
        )
        .filter(~F.dayofweek("rate_date").isin(1, 7))
    )
    return (
        quotes.groupBy("currency", "rate_date")
        .agg(F.max_by("exchange_rate", F.struct("ts", "event_id")).alias("exchange_rate"))
    )


# -- scd: validity-windowed class per customer ------------------------------------
SQL["scd"] = ([], """
SELECT custkey, valid_from,
       CAST(lead(valid_from) OVER (PARTITION BY custkey ORDER BY valid_from) - INTERVAL 1 DAY AS DATE) AS valid_to,
       class
FROM (SELECT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS valid_from,
             arg_min(o_orderpriority, o_orderkey) AS class
      FROM orders GROUP BY 1, 2)
""")


def scd(t: Tables) -> DataFrame:
    days = (
        t.orders.groupBy(F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("valid_from"))
        .agg(F.min_by("o_orderpriority", "o_orderkey").alias("class"))
    )
    return windows_from_dates(days, ["custkey"], "valid_from", "valid_to").select(
        "custkey", "valid_from", "valid_to", "class")


# -- win: activity intervals per customer ------------------------------------------
SQL["win"] = ([], """
SELECT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS d_from,
       CAST(o_orderdate AS DATE) + 45 AS d_to FROM orders
""")


def win(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.orders.select(F.col("o_custkey").alias("custkey"), day.alias("d_from"),
                           F.date_add(day, 45).alias("d_to"))


# -- ln: header + line rows behind the nested documents -----------------------------
SQL["ln"] = (["li"], """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date,
       CASE WHEN o_orderkey % 3 = 0 THEN 'Inclusive' ELSE 'Exclusive' END AS amount_types,
       CAST((l_linenumber - 1) // 50 AS INT) AS page_no, l_linenumber AS line_no, l_partkey AS part_id,
       l_suppkey AS supp_id, l_returnflag, l_linestatus,
       CAST(l_quantity AS DECIMAL(18,2)) AS quantity,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS tax
FROM orders JOIN li ON l_orderkey = o_orderkey
""")


def ln(t: Tables) -> DataFrame:
    lines = dealt(li(t), t.lineitem.count(), "l_orderkey")
    return t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_date"),
        F.when(F.col("o_orderkey") % 3 == 0, "Inclusive").otherwise("Exclusive").alias("amount_types"),
        F.floor((F.col("l_linenumber") - 1) / LINES_PER_PAGE).cast("int").alias("page_no"),
        F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supp_id"), "l_returnflag", "l_linestatus",
        money("l_quantity").alias("quantity"), money("l_extendedprice").alias("amount"),
        (money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,2)").alias("tax"),
    )


def doc(t: Tables) -> DataFrame:
    """One JSON text per order and page of at most ``LINES_PER_PAGE`` lines.

    Line numbers are unique within an order, so the paging bounds every collected group.
    """
    body = F.sort_array(F.collect_list(F.struct(
        F.col("line_no").alias("LineNo"), F.col("part_id").alias("PartID"),
        F.col("supp_id").alias("SupplierID"),
        F.col("quantity").alias("Quantity"), F.col("amount").alias("LineAmount"),
        F.col("tax").alias("TaxAmount"))))
    pages = ln(t).groupBy("o_orderkey", "page_no").agg(
        F.first("o_custkey").alias("cust"), F.first("o_orderstatus").alias("status"),
        F.first("order_date").alias("order_date"), F.first("amount_types").alias("amount_types"),
        body.alias("lines"))
    epoch = F.concat(F.lit("/Date("), (F.unix_date("order_date").cast("bigint") * 86400000).cast("string"),
                     F.lit("+0000)/"))
    return pages.select(
        F.concat_ws("/", F.col("o_orderkey").cast("string"), F.col("page_no").cast("string")).alias("page_key"),
        F.to_json(F.struct(
            F.col("o_orderkey").cast("string").alias("OrderID"),
            F.struct(F.col("cust").cast("string").alias("ID")).alias("Customer"),
            F.col("status").alias("Type"), epoch.alias("Date"),
            F.col("amount_types").alias("LineAmountTypes"),
            F.col("lines").alias("LineItems"))).alias("payload"))


# -- gl: double-entry ledger ---------------------------------------------------------
SQL["gl"] = (["li"], f"""
SELECT r_name AS tenant_id, l_orderkey AS journal_id, account_id, side,
       {SQL_POSTING.format(k='l_orderkey')} AS posting_date,
       {SQL_CURRENCY.format(k='l_orderkey')} AS currency, l_linenumber AS line_no,
       CASE WHEN side = 'D' THEN amt ELSE -amt END AS amount, o_custkey AS customer_id, l_linestatus
FROM (
  SELECT li.*, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt, s.side,
         CASE WHEN s.side = 'D' THEN 'P' || CAST(l_partkey % 50 AS VARCHAR)
              ELSE 'S' || CAST(l_suppkey AS VARCHAR) END AS account_id
  FROM li CROSS JOIN (VALUES ('D'), ('C')) s(side))
JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey
WHERE NOT (side = 'C' AND l_discount = 0.1 AND l_tax = 0.08)
""")


def customer_region(t: Tables) -> DataFrame:
    geo = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))


def gl(t: Tables) -> DataFrame:
    cust = customer_region(t).select("c_custkey", F.col("r_name").alias("tenant_id"))
    heads = t.orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "tenant_id", F.col("o_custkey").alias("customer_id"))
    amt = money("l_extendedprice")
    sides = F.array(
        F.struct(F.lit("D").alias("side"),
                 F.concat(F.lit("P"), (F.col("l_partkey") % 50).cast("string")).alias("account_id"),
                 amt.alias("amount")),
        F.struct(F.lit("C").alias("side"),
                 F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("account_id"),
                 (-amt).alias("amount")))
    lines = li(t).select("l_orderkey", "l_linenumber", "l_linestatus", "l_partkey", "l_suppkey", "l_extendedprice",
                         "l_discount", "l_tax")
    # headers first, then the two sides: the join moves each line once
    posted = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("p", F.explode(sides))
    posted = posted.filter(~((F.col("p.side") == "C") & (F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)))
    return posted.select(
        "tenant_id", F.col("l_orderkey").alias("journal_id"), F.col("p.account_id").alias("account_id"),
        F.col("p.side").alias("side"), posting_date(F.col("l_orderkey")).alias("posting_date"),
        currency_of(F.col("l_orderkey")).alias("currency"), F.col("l_linenumber").alias("line_no"),
        F.col("p.amount").alias("amount"), "customer_id", "l_linestatus")


# -- snap: external report to reconcile against -------------------------------------
SQL["snap"] = (["gl"], """
SELECT tenant_id, account_id,
       sum(amount) + CASE WHEN account_id LIKE '%7' THEN 1.00 ELSE 0.00 END AS reported
FROM gl GROUP BY tenant_id, account_id
""")


def snap(t: Tables, ledger: DataFrame | None = None) -> DataFrame:
    off = F.when(F.col("account_id").endswith("7"), F.lit("1.00")).otherwise(F.lit("0.00")).cast("decimal(18,2)")
    return (ledger if ledger is not None else gl(t)).groupBy("tenant_id", "account_id").agg(
        F.sum("amount").alias("s")).select("tenant_id", "account_id", (F.col("s") + off).alias("reported"))


def rules(t: Tables) -> DataFrame:
    return seed(t.spark, RULES, RULES_SCHEMA)


SQL["rules"] = ([], "SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join("CAST(NULL AS VARCHAR)" if v is None else f"'{v}'" for v in r) + ")" for r in RULES
) + ") r(brand, type, size_band, category)")
