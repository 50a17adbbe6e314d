"""N-rows: JSON and arrays. Inputs are nested documents built from orders and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions import jsonx, text
from tallyframe.plans import derived
from tallyframe.plans.registry import query
from tallyframe.sources.registry import Tables

LINES = "array<struct<LineNo:int,PartID:bigint,SupplierID:bigint,Quantity:decimal(18,2),LineAmount:decimal(18,2),TaxAmount:decimal(18,2)>>"


def typed_lines(t: Tables) -> DataFrame:
    """Document pages with their lines as a typed array, parsed once."""
    return derived.doc(t).select(
        "page_key", F.from_json("payload", f"OrderID string, Type string, LineItems {LINES}").alias("d")).select(
        "page_key", F.col("d.OrderID").alias("order_id"), F.col("d.Type").alias("status"), F.col("d.LineItems").alias("lines"))


def variant_docs(t: Tables) -> DataFrame:
    return derived.doc(t).select("page_key", jsonx.parsed("payload").alias("v"))


@query("N1_json_scalar", """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS as_object, CAST(NULL AS VARCHAR) AS missing,
  TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_number FROM events""")
def n1(t: Tables) -> DataFrame:
    v = t.events.select("event_id", jsonx.parsed("props").alias("v"),
                        jsonx.parsed(F.concat(F.lit('{"o":'), "props", F.lit("}"))).alias("w"))
    return v.select("event_id", jsonx.json_scalar("v", "$.k").alias("k"), jsonx.json_scalar("w", "$.o").alias("as_object"),
                    jsonx.json_scalar("v", "$.x").alias("missing"), jsonx.json_number("v", "$.k", "bigint").alias("k_number"))


@query("N2_array_unnest", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(part_id AS BIGINT) AS part_id, CAST(amount AS DOUBLE) AS amount FROM ln""", uses="ln")
def n2(t: Tables) -> DataFrame:
    rows = variant_docs(t).select(jsonx.json_scalar("v", "$.OrderID").alias("order_id"),
                                  F.explode(jsonx.json_array("v", "$.LineItems")).alias("e"))
    return rows.select("order_id", jsonx.json_number("e", "$.PartID", "bigint").alias("part_id"),
                       jsonx.json_number("e", "$.LineAmount").cast("double").alias("amount"))


@query("N3_unnest_with_offset", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, row_number() OVER (PARTITION BY o_orderkey, page_no ORDER BY line_no) - 1 AS pos,
  CAST(line_no AS BIGINT) AS line_no FROM ln""", uses="ln")
def n3(t: Tables) -> DataFrame:
    rows = variant_docs(t).select(jsonx.json_scalar("v", "$.OrderID").alias("order_id"),
                                  F.posexplode(jsonx.json_array("v", "$.LineItems")).alias("pos", "e"))
    return rows.select("order_id", F.col("pos").cast("bigint").alias("pos"),
                       jsonx.json_number("e", "$.LineNo", "bigint").alias("line_no"))


@query("N4_two_level_unnest", """
SELECT o_orderkey AS orderkey, l_linestatus AS section, CAST(line_no AS BIGINT) AS line_no, CAST(amount AS DOUBLE) AS amount
FROM ln""", uses="ln")
def n4(t: Tables) -> DataFrame:
    # claim -> receipts -> lines: a page holds one receipt per line status, a receipt its lines
    line = F.struct(F.col("line_no").alias("LineNo"), F.col("amount").alias("LineAmount"))
    receipts = derived.ln(t).groupBy("o_orderkey", "page_no", "l_linestatus").agg(F.collect_list(line).alias("lines"))
    claims = receipts.groupBy("o_orderkey", "page_no").agg(F.collect_list(F.struct(
        F.col("l_linestatus").alias("Status"), F.col("lines").alias("LineItems"))).alias("r"))
    docs = claims.select(jsonx.parsed(F.to_json(F.struct(F.col("o_orderkey").alias("ID"), F.col("r").alias("Receipts")))).alias("v"))
    outer = docs.select(jsonx.json_scalar("v", "$.ID").alias("id"), F.explode(jsonx.json_array("v", "$.Receipts")).alias("r"))
    inner = outer.select("id", jsonx.json_scalar("r", "$.Status").alias("section"),
                         F.explode(jsonx.json_array("r", "$.LineItems")).alias("l"))
    return inner.select(F.col("id").cast("bigint").alias("orderkey"), "section",
                        jsonx.json_number("l", "$.LineNo", "bigint").alias("line_no"),
                        jsonx.json_number("l", "$.LineAmount").cast("double").alias("amount"))


@query("N5_quoted_path_and_double_encoding", """
SELECT event_id, json_extract_string(props, '$.k') AS dotted, json_extract_string(props, '$.k') AS accented,
  json_extract_string(props, '$.k') AS inner_value FROM events""")
def n5(t: Tables) -> DataFrame:
    wrapped = F.to_json(F.struct(
        F.get_json_object("props", "$.k").alias("a.b"), F.get_json_object("props", "$.k").alias("beløp"),
        F.col("props").alias("encoded")))
    v = t.events.select("event_id", jsonx.parsed(wrapped).alias("v"))
    v = v.withColumn("inner", jsonx.double_encoded("v", "$.encoded"))
    return v.select("event_id", jsonx.json_scalar("v", jsonx.path_of("a.b")).alias("dotted"),
                    jsonx.json_scalar("v", jsonx.path_of("beløp")).alias("accented"),
                    jsonx.json_scalar("inner", "$.k").alias("inner_value"))


@query("N6_array_length_and_offset", """
SELECT CAST(o_orderkey AS VARCHAR) || '/' || CAST(page_no AS VARCHAR) AS page_key, count(*) AS line_count,
  arg_min(part_id, line_no) AS first_part, list_extract(list(part_id ORDER BY line_no), 2) AS second_part FROM ln GROUP BY o_orderkey, page_no""", uses="ln")
def n6(t: Tables) -> DataFrame:
    l = F.col("lines")
    return typed_lines(t).select("page_key", F.size(l).cast("bigint").alias("line_count"),
                                 F.get(l, F.lit(0))["PartID"].alias("first_part"),
                                 F.try_element_at(l, F.lit(2))["PartID"].alias("second_part"))


@query("N7_sub_document_text", """
SELECT CAST(o_orderkey AS VARCHAR) || '/' || CAST(page_no AS VARCHAR) AS page_key, '{"ID":"' || o_custkey || '"}' AS customer_json,
  '[' || string_agg('{"LineNo":' || line_no || ',"PartID":' || part_id || '}', ',' ORDER BY line_no) || ']' AS lines_json
FROM ln GROUP BY o_orderkey, page_no, o_custkey""", uses="ln")
def n7(t: Tables) -> DataFrame:
    v = variant_docs(t)
    lines = F.from_json(jsonx.json_text("v", "$.LineItems"), "array<struct<LineNo:int,PartID:bigint>>")
    return v.select("page_key", jsonx.json_text("v", "$.Customer").alias("customer_json"), F.to_json(lines).alias("lines_json"))


@query("N8_fixed_slots", """
SELECT CAST(o_orderkey AS VARCHAR) || '/' || CAST(page_no AS VARCHAR) AS page_key, list_extract(list(part_id ORDER BY line_no), 1) AS part_1,
  CAST(list_extract(list(amount ORDER BY line_no), 1) AS DOUBLE) AS amount_1, list_extract(list(part_id ORDER BY line_no), 2) AS part_2,
  CAST(list_extract(list(amount ORDER BY line_no), 2) AS DOUBLE) AS amount_2 FROM ln GROUP BY o_orderkey, page_no""", uses="ln")
def n8(t: Tables) -> DataFrame:
    slots = []
    for i in (0, 1):
        e = F.get("lines", F.lit(i))
        slots += [e["PartID"].alias(f"part_{i + 1}"), e["LineAmount"].cast("double").alias(f"amount_{i + 1}")]
    return typed_lines(t).select("page_key", *slots)


@query("N9_segment_code", """
SELECT p_partkey, nullif(regexp_replace(concat_ws('-', coalesce(replace(p_brand, 'Brand#', ''), ''),
   CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END, CASE WHEN p_size > 25 THEN '' ELSE CAST(p_size AS VARCHAR) END), '(-)+$', ''), '') AS code FROM part""")
def n9(t: Tables) -> DataFrame:
    segments = F.to_json(F.struct(
        F.regexp_replace("p_brand", "^Brand#", "").alias("1"), F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("2"),
        F.when(F.col("p_size") <= 25, F.col("p_size").cast("string")).alias("3")))
    v = t.part.select("p_partkey", jsonx.parsed(segments).alias("v"))
    return v.select("p_partkey", text.segment_code(*[
        jsonx.json_scalar("v", jsonx.path_of(k)) for k in ("1", "2", "3")]).alias("code"))


@query("N10_key_value_array_to_columns", """
SELECT CAST(o_orderkey AS VARCHAR) || '/' || CAST(page_no AS VARCHAR) AS page_key,
  max(CASE WHEN line_no = 1 THEN part_id END) AS part_at_1, max(CASE WHEN line_no = 4 THEN part_id END) AS part_at_4,
  max(CASE WHEN line_no = 7 THEN part_id END) AS part_at_7 FROM ln GROUP BY o_orderkey, page_no""", uses="ln")
def n10(t: Tables) -> DataFrame:
    m = jsonx.entries_to_map(F.col("lines"), lambda e: e["LineNo"], lambda e: e["PartID"])
    return typed_lines(t).select("page_key", m.alias("m")).select(
        "page_key", *[F.col("m")[k].alias(f"part_at_{k}") for k in (1, 4, 7)])


@query("A11_nested_array_aggregates", """
SELECT CAST(o_orderkey AS VARCHAR) || '/' || CAST(page_no AS VARCHAR) AS page_key, count(*) FILTER (quantity > 25) AS large_lines,
  CAST(sum(amount) AS DOUBLE) AS total, CAST(max(amount) AS DOUBLE) AS largest,
  arg_max(part_id, (amount, -line_no)) AS part_of_largest FROM ln GROUP BY o_orderkey, page_no""", uses="ln")
def a11(t: Tables) -> DataFrame:
    l = F.col("lines")
    total = F.aggregate(l, F.lit(0).cast("decimal(28,2)"), lambda acc, e: (acc + e["LineAmount"]).cast("decimal(28,2)"))
    best = F.array_max(F.transform(l, lambda e: F.struct(e["LineAmount"].alias("a"), (-e["LineNo"]).alias("n"), e["PartID"].alias("p"))))
    return typed_lines(t).select(
        "page_key", F.size(F.filter(l, lambda e: e["Quantity"] > 25)).cast("bigint").alias("large_lines"),
        total.cast("double").alias("total"), F.array_max(F.transform(l, lambda e: e["LineAmount"])).cast("double").alias("largest"),
        best["p"].alias("part_of_largest"))
