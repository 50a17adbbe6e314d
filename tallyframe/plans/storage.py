"""S-rows (sources), K-rows (sinks) and T-rows (arriving files)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions import dates
from tallyframe.functions.numbers import money
from tallyframe.plans.registry import query
from tallyframe.session import work_path
from tallyframe.sinks import tables as sink, upsert as up
from tallyframe.sinks.refresh import RefreshedModel
from tallyframe.sinks.versioned import VersionedTable
from tallyframe.sources import pages as pg
from tallyframe.sources.calendar import calendar
from tallyframe.sources.endpoints import endpoint_config
from tallyframe.sources.landing import BucketedLanding
from tallyframe.sources.registry import SCHEMAS, Tables
from tallyframe.sources.seeds import seed
from tallyframe.streaming import ingest, state
from tallyframe.streaming.ledger import BatchSink

RECORDS_PER_PAGE = 100


# ---------------------------------------------------------------------------- sources
@query("S1_path_parsed_pages", r"""
SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host, regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS lang,
  TRY_CAST(regexp_extract(url, '^https?://[^/]+/[a-z]+/(\d+)', 1) AS BIGINT) AS item_no,
  nullif(regexp_extract(url, '\?([^#]*)', 1), '') AS query, CAST(length(html) AS BIGINT) AS body_chars FROM pages""")
def s1(t: Tables) -> DataFrame:
    key = r"^https?://([^/]+)/([a-z]+)/(\d+)"
    return t.pages.select(
        "page_id", F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("host"), F.regexp_extract("url", key, 2).alias("lang"),
        F.regexp_extract("url", key, 3).try_cast("bigint").alias("item_no"),
        F.nullif(F.regexp_extract("url", r"\?([^#]*)", 1), F.lit("")).alias("query"), F.length("html").cast("bigint").alias("body_chars"))


@query("S2_page_sidecar_join", """
SELECT page_id, url AS meta_url, CAST(length(html) AS BIGINT) AS body_chars FROM pages""")
def s2(t: Tables) -> DataFrame:
    name = F.concat(F.lit("raw/"), F.col("page_id").cast("string"))
    bodies = t.pages.select(F.concat(name, F.lit(".json")).alias("path"), "page_id", "html")
    metas = t.pages.select(F.concat(name, F.lit(".meta.json")).alias("meta_path"),
                           F.create_map(F.lit("x-endpoint"), F.lit("pages"), F.lit("x-url"), F.col("url")).alias("meta"))
    return pg.with_sidecar(bodies, metas).select("page_id", F.col("meta")["x-url"].alias("meta_url"),
                                                 F.length("html").cast("bigint").alias("body_chars"))


@query("S2_bucketed_landing", """
SELECT page_id, url AS meta_url, CAST(length(html) AS BIGINT) AS body_chars FROM pages WHERE page_id % 5 <> 0""")
def s2_bucketed(t: Tables) -> DataFrame:
    """Pages and sidecars in matching buckets; every fifth page has no sidecar."""
    name = F.concat(F.lit("raw/"), F.col("page_id").cast("string"))
    bodies = t.pages.select(F.concat(name, F.lit(".json")).alias("path"), "page_id", "html")
    metas = t.pages.filter("page_id % 5 <> 0").select(F.concat(name, F.lit(".meta.json")).alias("meta_path"), F.create_map(F.lit("x-url"), F.col("url")).alias("meta"))
    landing = BucketedLanding.create(bodies, metas, 8)
    return landing.joined(t.spark).select("page_id", F.col("meta")["x-url"].alias("meta_url"), F.length("html").cast("bigint").alias("body_chars"))


@query("S3_envelope_unwrap", """
SELECT CASE o_orderstatus WHEN 'F' THEN 'invoices' WHEN 'O' THEN 'purchase_orders' ELSE 'quotes' END AS endpoint,
  CAST(o_orderkey AS VARCHAR) AS record_id, o_totalprice AS total FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""")
def s3(t: Tables) -> DataFrame:
    # pages of at most RECORDS_PER_PAGE records: the order key is unique, the page a slice of its range
    config = endpoint_config(t.spark)
    endpoint = F.when(F.col("o_orderstatus") == "F", "invoices").when(F.col("o_orderstatus") == "O", "purchase_orders").otherwise("quotes")
    rid = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise(F.col("o_orderkey").cast("string"))
    rec = t.orders.select(endpoint.alias("endpoint"), rid.alias("rid"), "o_orderkey", "o_totalprice").join(
        F.broadcast(config), "endpoint")
    text = F.concat(F.lit('{"'), F.col("id_field"), F.lit('":"'), F.col("rid"), F.lit('","Total":'),
                    F.col("o_totalprice").cast("string"), F.lit("}"))
    pages = rec.groupBy("endpoint", "array_key", F.floor(F.col("o_orderkey") / RECORDS_PER_PAGE).alias("page")).agg(
        F.array_join(F.collect_list(text), ",").alias("inner"))
    pages = pages.select("endpoint", F.concat(F.lit('{"'), F.col("array_key"), F.lit('":['), F.col("inner"), F.lit("]}")).alias("body"))
    return pg.unwrap(pages, config, "body", "endpoint", ["endpoint"]).select(
        "endpoint", "record_id", F.get_json_object("payload", "$.Total").cast("double").alias("total"))


@query("S4_bronze_latest", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_suppkey, l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey) = 1""")
def s4(t: Tables) -> DataFrame:
    return pg.latest_records(
        t.lineitem, "l_suppkey", ["l_orderkey", "l_linenumber"],
        [F.desc("l_shipdate"), F.desc("l_extendedprice"), F.asc("l_partkey")],
    ).select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("S5_point_lookup", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_name = (SELECT max(c_name) FROM customer) ORDER BY c_custkey LIMIT 1""")
def s5(t: Tables) -> DataFrame:
    key = t.customer.agg(F.max("c_name").alias("k")).scalar()
    return pg.point_lookup(t.customer, [F.asc("c_custkey")], c_name=key).select("c_custkey", "c_name", "c_acctbal")


@query("S6_catalog_counts", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in SCHEMAS))
def s6(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        getattr(t, n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n in SCHEMAS])


@query("S7_declared_sources", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, CAST({ddl.count(',') + 1} AS INTEGER) AS declared_columns, count(*) AS row_count, "
    f"count({ddl.split()[0]}) AS keyed_rows, TRUE AS conforms FROM {n}" for n, ddl in SCHEMAS.items()))
def s7(t: Tables) -> DataFrame:
    t.register()
    parts = []
    for name, ddl in SCHEMAS.items():
        declared = t.spark.table(name)
        actual = t.spark.read.parquet(t.path(name)).schema
        same = [(f.name, f.dataType) for f in actual] == [(f.name, f.dataType) for f in declared.schema]
        parts.append(declared.agg(F.count(F.lit(1)).alias("row_count"), F.count(declared.columns[0]).alias("keyed_rows")).select(
            F.lit(name).alias("table_name"), F.lit(len(declared.columns)).alias("declared_columns"), "row_count", "keyed_rows",
            F.lit(same).alias("conforms")))
    return reduce(DataFrame.unionByName, parts)


# Priority codes and their meaning.
PRIORITIES = [("1-URGENT", 1, "same day"), ("2-HIGH", 2, "two days"), ("3-MEDIUM", 3, "one week"), ("5-LOW", 5, "when possible")]


@query("S8_inline_seed", """
SELECT o_orderkey, o_orderpriority, lvl, promise FROM orders
LEFT JOIN (VALUES ('1-URGENT', 1, 'same day'), ('2-HIGH', 2, 'two days'), ('3-MEDIUM', 3, 'one week'), ('5-LOW', 5, 'when possible')) s(code, lvl, promise)
ON code = o_orderpriority""")
def s8(t: Tables) -> DataFrame:
    s = seed(t.spark, PRIORITIES, "code string, lvl int, promise string")
    empty = seed(t.spark, [], "code string, lvl int, promise string")
    return t.orders.join(F.broadcast(s.unionByName(empty)), F.col("code") == F.col("o_orderpriority"), "left").select(
        "o_orderkey", "o_orderpriority", "lvl", "promise")


@query("S9_calendar", """
SELECT d AS date_day, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year_number,
  CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%B') AS month_name,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(week(d) AS INTEGER) AS iso_week, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
  strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, strftime(d, '%Y%m') AS fiscal_period
FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM (
  SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders))""")
def s9(t: Tables) -> DataFrame:
    bounds = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return calendar(bounds, "lo", "hi")


@query("S10_json_lines", "SELECT conv_id, turn, role, text FROM conversations")
def s10(t: Tables) -> DataFrame:
    path = work_path(t.spark, "json-lines")
    t.conversations.write.json(path)
    return t.spark.read.schema(SCHEMAS["conversations"]).json(path)


# Event types with a parser.
REGISTERED_TYPES = [("purchase",), ("signup",), ("view",)]


@query("S11_source_drift", """
SELECT event_type, count(*) AS row_count FROM events WHERE event_type NOT IN ('purchase', 'signup', 'view') GROUP BY 1""")
def s11(t: Tables) -> DataFrame:
    return pg.drift(t.events, "event_type", seed(t.spark, REGISTERED_TYPES, "event_type string"))


# ------------------------------------------------------------------------------ sinks
def order_target(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("synced_on"))


def order_batch(t: Tables) -> DataFrame:
    """Updates (with a stale copy each), out-of-order rows and inserts."""
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", F.to_date("o_orderdate").alias("d"))
    cents = money("o_totalprice")
    def shaped(df, key, price, day):
        return df.select(key.alias("o_orderkey"), price.cast("double").alias("o_totalprice"), day.alias("synced_on"))
    k, one = F.col("o_orderkey"), F.lit(1).cast("decimal(18,2)")
    newer = shaped(o.filter("o_orderstatus = 'P'"), k, cents + one, F.date_add("d", 10))
    stale = shaped(o.filter("o_orderstatus = 'P'"), k, cents - one, F.date_add("d", 5))
    late = shaped(o.filter("o_orderstatus = 'F'"), k, cents - one, F.date_sub("d", 3))
    fresh = shaped(o.filter("o_orderstatus = 'O'"), -k - 1, cents, F.col("d"))
    return newer.unionByName(stale).unionByName(late).unionByName(fresh)


@query("K1_keyed_upsert", """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) + 1 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) AS o_totalprice,
  CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) + 10 ELSE CAST(o_orderdate AS DATE) END AS synced_on FROM orders
UNION ALL SELECT -o_orderkey - 1, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE), CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'O'""")
def k1(t: Tables) -> DataFrame:
    return up.upsert(order_target(t), order_batch(t), ["o_orderkey"], ["synced_on"])


@query("K1_keyed_table_on_disk", """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) + 1 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) AS o_totalprice,
  CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) + 10 ELSE CAST(o_orderdate AS DATE) END AS synced_on FROM orders
UNION ALL SELECT -o_orderkey - 1, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE), CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'O'""")
def k1_disk(t: Tables) -> DataFrame:
    table = up.KeyedTable(work_path(t.spark, "keyed-table"), ["o_orderkey"], ["synced_on"], buckets=8)
    table.merge(order_target(t))
    table.merge(order_batch(t))
    return table.read(t.spark)


KEYED_ORACLE = """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) + 1 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) AS o_totalprice,
  CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) + 10 ELSE CAST(o_orderdate AS DATE) END AS synced_on{extra} FROM orders
UNION ALL SELECT -o_orderkey - 1, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE), CAST(o_orderdate AS DATE){extra} FROM orders WHERE o_orderstatus = 'O'"""


def versioned_orders(t: Tables) -> VersionedTable:
    """Orders as a base with two delta runs on top, the second a replay of the first under the same number."""
    table = VersionedTable(work_path(t.spark, "versioned"), ["o_orderkey"], ["synced_on"], buckets=8)
    table.merge(order_target(t), "orders", 0)
    table.compact(t.spark)
    table.merge(order_batch(t), "orders", 1)
    table.merge(order_batch(t), "orders", 1)
    table.merge(order_batch(t))  # a replay without a number, told by its rows
    return table


@query("K1_versioned_deltas", KEYED_ORACLE.format(extra=", 2 AS live_deltas"))
def k1_deltas(t: Tables) -> DataFrame:
    table = versioned_orders(t)
    return table.read(t.spark).withColumn("live_deltas", F.lit(len(table.snapshot(t.spark).deltas)))


@query("K1_versioned_compacted", KEYED_ORACLE.format(extra=", 0 AS live_deltas"))
def k1_compacted(t: Tables) -> DataFrame:
    table = versioned_orders(t)
    table.compact(t.spark)
    return table.read(t.spark).withColumn("live_deltas", F.lit(len(table.snapshot(t.spark).deltas)))


@query("K2_conflicting_duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS copies,
  count(DISTINCT (l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) AS variants
FROM lineitem GROUP BY 1, 2 HAVING variants > 1""")
def k2(t: Tables) -> DataFrame:
    return up.conflicting_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("K2_null_safe_merge", """
WITH c AS (SELECT c_nationkey AS nation, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg, count(*) AS n FROM customer GROUP BY 1, 2),
 s AS (SELECT s_nationkey AS nation, CAST(NULL AS VARCHAR) AS seg, count(*) AS n FROM supplier GROUP BY 1)
SELECT nation, seg, n, 'target' AS origin FROM c WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.nation IS NOT DISTINCT FROM c.nation AND s.seg IS NOT DISTINCT FROM c.seg)
UNION ALL SELECT nation, seg, n, 'batch' FROM s""")
def k2_merge(t: Tables) -> DataFrame:
    n = F.count(F.lit(1)).alias("n")
    target = t.customer.groupBy(F.col("c_nationkey").alias("nation"),
                                F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("seg")).agg(n)
    batch = t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(n).withColumn("seg", F.lit(None).cast("string"))
    return up.null_safe_merge(target.withColumn("origin", F.lit("target")), batch.withColumn("origin", F.lit("batch")),
                              ["nation", "seg"])


@query("K3_schema_evolution", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def k3(t: Tables) -> DataFrame:
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old = t.orders.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderstatus")
    new = t.orders.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = work_path(t.spark, "evolved")
    old.write.parquet(path)
    new.write.mode("append").parquet(path)
    return t.spark.read.option("mergeSchema", "true").parquet(path)


@query("K3_nested_evolution", """
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus AS status,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS priority FROM orders""")
def k3_nested(t: Tables) -> DataFrame:
    day, cut = F.col("o_orderdate"), F.lit("1998-01-01").cast("timestamp_ntz")
    table = VersionedTable(work_path(t.spark, "evolving"), ["o_orderkey"], ["o_orderdate"], buckets=4)
    # a 32-bit number and a struct of one field first, then a wider number and a field more inside the struct
    table.merge(t.orders.filter(day < cut).select("o_orderkey", "o_orderdate", F.col("o_custkey").cast("int").alias("o_custkey"), F.struct(F.col("o_orderstatus").alias("status")).alias("head")))
    table.merge(t.orders.filter(day >= cut).select("o_orderkey", "o_orderdate", F.col("o_custkey").cast("bigint").alias("o_custkey"),
                                                   F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("head")))
    return table.read(t.spark).select("o_orderkey", "o_custkey", "head.status", "head.priority")


@query("K4_materialized_model", """
SELECT p_brand, count(*) AS line_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def k4(t: Tables) -> DataFrame:
    per_part = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum(money("l_extendedprice")).alias("s"))
    model = per_part.join(t.part, F.col("p_partkey") == F.col("l_partkey")).groupBy("p_brand").agg(
        F.sum("n").alias("line_count"), F.sum("s").cast("double").alias("revenue"))
    path = work_path(t.spark, "model")
    sink.materialize(model, path)
    return sink.as_view(sink.materialize(model, path), "brand_revenue")


@query("K4_refreshed_model", """
SELECT status, count(*) AS orders, CAST(sum(price) AS DOUBLE) AS revenue, 1 AS splits_recomputed FROM (
  SELECT o_orderkey AS k, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS price FROM orders) GROUP BY 1""")
def k4_refreshed(t: Tables) -> DataFrame:
    """Revenue per status over orders split by status: one split gets a batch, and only that one is recomputed."""
    table = VersionedTable(work_path(t.spark, "orders-by-status"), ["o_orderstatus", "o_orderkey"], ["version"], 2, ["o_orderstatus"])

    def part(rows: DataFrame) -> DataFrame:
        return rows.groupBy("_split", F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("s"))

    def finish(parts: DataFrame) -> DataFrame:
        return parts.groupBy("status").agg(F.sum("n").alias("orders"), F.sum("s").cast("double").alias("revenue"))

    model = RefreshedModel(work_path(t.spark, "revenue"), table, part, finish)
    rows = t.orders.select("o_orderstatus", "o_orderkey", money("o_totalprice").alias("price"), F.lit(0).alias("version"))
    table.merge(rows)
    model.refresh(t.spark)
    one = F.lit(1).cast("decimal(18,2)")
    table.merge(rows.filter("o_orderstatus = 'P'").select("o_orderstatus", "o_orderkey", (F.col("price") + one).cast("decimal(18,2)").alias("price"), F.lit(1).alias("version")))
    table.compact(t.spark)
    recomputed = model.refresh(t.spark)
    return model.read(t.spark).withColumn("splits_recomputed", F.lit(len(recomputed)))


@query("K5_append_snapshots", """
SELECT event_type || '|' || strftime(ts, '%Y-%m-%d') AS record_id, count(*) AS event_count,
  CASE WHEN CAST(ts AS DATE) < DATE '2024-01-16' THEN 'first' ELSE 'second' END AS run FROM events GROUP BY 1, 3""")
def k5(t: Tables) -> DataFrame:
    day = F.to_date("ts")
    daily = t.events.groupBy(sink.snapshot_id(F.col("event_type"), day.cast("string")).alias("record_id"), day.alias("day")).agg(
        F.count(F.lit(1)).alias("event_count"))
    first = daily.filter(F.col("day") < F.lit("2024-01-16").cast("date")).withColumn("run", F.lit("first"))
    again = daily.withColumn("run", F.lit("second"))
    return sink.append_snapshots(first, again, "record_id").drop("day")


@query("K6_partitioned_landing", """
SELECT event_type, strftime(ts, '%Y-%m-%d') AS run_date, count(*) AS row_count, min(event_id) AS first_id FROM events GROUP BY 1, 2""")
def k6(t: Tables) -> DataFrame:
    path = work_path(t.spark, "landing")
    sink.land(t.events.withColumn("run_date", F.date_format("ts", "yyyy-MM-dd")), path, ["event_type", "run_date"])
    return sink.read_landed(t.spark, path).groupBy("event_type", F.col("run_date").cast("string").alias("run_date")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("first_id"))


@query("K7_run_manifest", """
SELECT c_nationkey, c_mktsegment, count(*) AS pages, CAST(sum(length(c_name)) AS BIGINT) AS records, count(*) FILTER (c_acctbal < -900) AS errors,
  CASE WHEN count(*) FILTER (c_acctbal < -900) > 0 THEN 'error' WHEN count(*) >= 15 THEN 'page_cap' ELSE 'exhausted' END AS termination
FROM customer GROUP BY 1, 2""")
def k7(t: Tables) -> DataFrame:
    return sink.run_manifest(t.customer, ["c_nationkey", "c_mktsegment"], F.length("c_name"), F.col("c_acctbal") < -900, page_cap=15)


@query("K8_merge_anomaly", """
SELECT count(*) AS batch_keys, count(*) FILTER (o_orderstatus = 'O') AS inserted, count(*) FILTER (o_orderstatus = 'P') AS updated,
  CAST(0 AS BIGINT) AS unchanged, count(*) FILTER (o_orderstatus = 'F') AS outdated, FALSE AS all_inserted, FALSE AS nothing_changed FROM orders""")
def k8(t: Tables) -> DataFrame:
    return up.merge_outcome(order_target(t), order_batch(t), ["o_orderkey"], ["synced_on"])


# ---------------------------------------------------------------------- arriving files
def event_stream(t: Tables, name: str, files: int, per_batch: int) -> DataFrame:
    """Events as arriving files, spread by hash so that batches are out of order."""
    path = work_path(t.spark, name)
    t.events.repartition(files, "event_id").write.parquet(path)
    return (t.spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", per_batch).parquet(path))


@query("T1_new_file_ingestion", "SELECT event_id, user_id, event_type, json_extract_string(props, '$.k') AS k FROM events")
def t1(t: Tables) -> DataFrame:
    out = work_path(t.spark, "ingested")
    rows = event_stream(t, "arriving", 4, 2).select(
        "event_id", "user_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    q = (rows.writeStream.format("parquet").option("checkpointLocation", work_path(t.spark, "cp"))
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(out)


@query("T2_route_by_endpoint", """
SELECT event_id, CASE WHEN event_type IN ('purchase', 'signup', 'view') THEN event_type ELSE 'drift' END AS sink FROM events""")
def t2(t: Tables) -> DataFrame:
    out = work_path(t.spark, "routed")
    def to(name):
        return lambda df: df.select("event_id").write.mode("append").parquet(f"{out}/sink={name}")
    handler = ingest.route({n: to(n) for (n,) in REGISTERED_TYPES}, "event_type", to("drift"))
    ingest.run_available(event_stream(t, "to-route", 4, 4), handler, work_path(t.spark, "cp"))
    return t.spark.read.schema("event_id bigint, sink string").parquet(out)


@query("T2_retried_batches", """
SELECT event_id, CASE WHEN event_type IN ('purchase', 'signup', 'view') THEN event_type ELSE 'drift' END AS sink FROM events""")
def t2_retried(t: Tables) -> DataFrame:
    out = work_path(t.spark, "routed-once")
    sinks = {n: BatchSink(f"{out}/{n}") for n in [*(n for (n,) in REGISTERED_TYPES), "drift"]}
    handler = ingest.route({n: sinks[n] for (n,) in REGISTERED_TYPES}, "event_type", sinks["drift"])

    def dies_once(batch: DataFrame, batch_id: int) -> None:
        """Handles every batch twice, as a stream does whose handler fails after its last sink."""
        handler(batch, batch_id)
        handler(batch, batch_id)

    ingest.run_available(event_stream(t, "to-route-once", 4, 2), dies_once, work_path(t.spark, "cp"))
    parts = [s.read(t.spark, SCHEMAS["events"]).select("event_id", F.lit(n).alias("sink")) for n, s in sinks.items()]
    return reduce(DataFrame.unionByName, parts)


@query("T3_state_store", """
SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def t3_state(t: Tables) -> DataFrame:
    table = VersionedTable(work_path(t.spark, "latest-state"), ["user_id"], ["ts", "event_id"], buckets=4)
    arriving = event_stream(t, "to-state", 3, 1).select("user_id", "ts", "event_id", "event_type", "value")
    state.run_latest(arriving, ["user_id"], ["ts", "event_id"], lambda df, b: table.merge(df, "latest", b), work_path(t.spark, "cp"))
    return table.read(t.spark).select("user_id", "event_id", "event_type", "value")


@query("T3_stateful_keep_latest", """
SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def t3(t: Tables) -> DataFrame:
    table = up.KeyedTable(work_path(t.spark, "latest-event"), ["user_id"], ["ts", "event_id"], buckets=4)
    ingest.run_available(event_stream(t, "shuffled", 3, 1), ingest.keep_latest(table), work_path(t.spark, "cp"))
    return table.read(t.spark).select("user_id", "event_id", "event_type", "value")


@query("T4_rolling_lookback", """
WITH b AS (SELECT max(CAST(o_orderdate AS DATE)) AS hi FROM orders)
SELECT 'rolling' AS mode, o_orderkey FROM orders, b WHERE CAST(o_orderdate AS DATE) >= hi - 30
UNION ALL SELECT 'window', o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'
UNION ALL SELECT 'sweep', o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'P')
UNION ALL SELECT 'full', o_orderkey FROM orders""")
def t4(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    o = t.orders.withColumn("hi", t.orders.agg(F.to_date(F.max("o_orderdate"))).scalar())
    modes = F.array_compact(F.array(
        F.when(day >= F.date_sub("hi", 30), "rolling"),
        F.when(ingest.in_window(day, F.lit("1997-03-01").cast("date"), F.lit("1997-03-31").cast("date")), "window"),
        F.when(F.col("o_orderstatus").isin("O", "P"), "sweep"), F.lit("full")))
    return o.select(F.explode(modes).alias("mode"), "o_orderkey")


@query("T5_replay_idempotency", """
SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def t5(t: Tables) -> DataFrame:
    e = t.events.select("user_id", "event_id", "ts", "value")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    early, late = e.filter(F.col("ts") < half), e.filter(F.col("ts") >= half)
    order = ["ts", "event_id"]
    # the later half first, the earlier half out of order, then the whole history again
    table = reduce(lambda acc, b: up.upsert(acc, b, ["user_id"], order), [early, e], up.collapse(late, ["user_id"], order))
    return table.drop("ts")


@query("T6_delete_detection", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND o_totalprice < 20000""")
def t6(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    inside = ingest.in_window(day, F.lit("1997-01-01").cast("date"), F.lit("1997-12-31").cast("date"))
    reread = t.orders.filter(inside & (F.col("o_totalprice") >= 20000))
    return ingest.deleted_keys(t.orders, reread, ["o_orderkey"], inside).select("o_orderkey", day.alias("order_date"))


@query("T7_half_open_window", """
SELECT event_id, 'closed' AS kind FROM events WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'
UNION ALL SELECT event_id, 'open' FROM events WHERE event_type = 'error' OR ts >= TIMESTAMP '2024-01-05'
UNION ALL SELECT event_id, 'business' FROM events WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-05'""")
def t7(t: Tables) -> DataFrame:
    # events of type error carry no time, those of type view carry it under the second key
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    first = dates.iso_datetime(F.when(~F.col("event_type").isin("error", "view"), text).otherwise(""))
    second = dates.iso_datetime(F.when(F.col("event_type") == "view", text))
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-05", "2024-01-12"))
    kinds = F.array_compact(F.array(
        F.when(ingest.modified_between([first, second], lo, hi), "closed"),
        F.when(ingest.modified_between([first, second], lo, None), "open"),
        F.when(ingest.business_between([first, second], lo, None), "business")))
    return t.events.select("event_id", F.explode(kinds).alias("kind"))
