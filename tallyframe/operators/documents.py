"""Flattening of nested documents and report trees.

A document kind is described by a :class:`DocumentSpec`; one generic function turns the
raw JSON into a typed header relation and one relation per nested array.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions import dates, jsonx

# How a declared type reads a JSON scalar.
READERS = {
    "string": lambda s: s,
    "bigint": lambda s: s.try_cast("bigint"),
    "double": lambda s: s.try_cast("double"),
    "money": lambda s: s.try_cast("decimal(18,2)"),
    "boolean": lambda s: s.try_cast("boolean"),
    "active": lambda s: F.coalesce(s == "ACTIVE", F.lit(False)),
    "epoch_date": dates.epoch_date,
    "epoch_timestamp": dates.epoch_timestamp,
    "iso_date": dates.iso_date,
    "iso_datetime": dates.iso_datetime,
}

# Output column, JSON path below the node (alternatives separated by "|"), type.
Field = tuple[str, str, str]


@dataclass(frozen=True)
class ChildSpec:
    """Rows of a nested array: ``fields`` are read below each element."""

    array: str
    fields: list[Field]
    parent: list[Field] = field(default_factory=list)  # read from the document, not the element
    key: list[str] = field(default_factory=list)  # identifies a row next to tenant and record
    position: str | None = None
    nested: str | None = None  # array inside each element, exploded in turn
    nested_fields: list[Field] = field(default_factory=list)
    skip_blank: str | None = None  # element path that must hold a value
    blank_flag: str | None = None  # boolean element path; true elements are dropped


@dataclass(frozen=True)
class DocumentSpec:
    record_id: str
    header: list[Field]
    children: dict[str, ChildSpec] = field(default_factory=dict)
    counts: dict[str, str] = field(default_factory=dict)  # output column -> array path


def _read(node: Column, fields: list[Field]) -> list[Column]:
    """Typed columns below a node; only text must be told apart from nested nodes."""
    out = []
    for name, path, ty in fields:
        get = jsonx.json_scalar if ty == "string" else jsonx.json_raw
        found = [get(node, f"$.{p}") for p in path.split("|")]
        out.append(READERS[ty](F.coalesce(*found)).alias(name))
    return out


def parse_records(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Parse the JSON text once; rows with malformed text keep a NULL document."""
    return df.withColumn("_doc", jsonx.parsed(payload)).drop(payload)


def flatten_header(records: DataFrame, spec: DocumentSpec, keep: list[str]) -> DataFrame:
    doc = F.col("_doc")
    counts = [
        F.coalesce(F.size(jsonx.json_array(doc, f"$.{p}")), F.lit(0)).cast("bigint").alias(c)
        for c, p in spec.counts.items()
    ]
    return records.select(*keep, jsonx.json_scalar(doc, f"$.{spec.record_id}").alias("record_id"),
                          *_read(doc, spec.header), *counts)


def flatten_child(records: DataFrame, spec: DocumentSpec, name: str, keep: list[str]) -> DataFrame:
    """Rows of one nested array; documents without elements give no rows."""
    child = spec.children[name]
    arr = jsonx.json_array(F.col("_doc"), f"$.{child.array}")
    if child.skip_blank:
        arr = F.filter(arr, lambda e: F.trim(F.try_variant_get(e, f"$.{child.skip_blank}", "string")) != "")
    if child.blank_flag:
        arr = F.filter(arr, lambda e: ~F.coalesce(F.try_variant_get(e, f"$.{child.blank_flag}", "boolean"), F.lit(False)))
    base = records.select(*keep, jsonx.json_scalar("_doc", f"$.{spec.record_id}").alias("record_id"),
                          *_read(F.col("_doc"), child.parent), F.posexplode(arr).alias("_pos", "_el"))
    cols = [*keep, "record_id", *[f[0] for f in child.parent]]
    if child.position:
        cols.append(F.col("_pos").cast("bigint").alias(child.position))
    if child.nested:
        outer = _read(F.col("_el"), child.fields)
        inner = base.select(*cols, *outer, F.explode(jsonx.json_array("_el", f"$.{child.nested}")).alias("_in"))
        return inner.select(*[c for c in inner.columns if c != "_in"], *_read(F.col("_in"), child.nested_fields))
    return base.select(*cols, *_read(F.col("_el"), child.fields))


def flatten(records: DataFrame, spec: DocumentSpec, keep: list[str]) -> dict[str, DataFrame]:
    """Header and all child relations of a parsed record relation."""
    out = {"header": flatten_header(records, spec, keep)}
    for name in spec.children:
        out[name] = flatten_child(records, spec, name, keep)
    return out


# A report is a tree of rows; cells of nested rows carry linked attributes.
CELL = "struct<Value:string,Attributes:array<struct<Id:string,Value:string>>>"
ROW = f"struct<RowType:string,Title:string,Cells:array<{CELL}>>"
SECTION = f"struct<RowType:string,Title:string,Cells:array<{CELL}>,Rows:array<{ROW}>>"
REPORT_SCHEMA = (
    "ReportID string, ReportName string, ReportType string, ReportTitles array<string>, "
    f"UpdatedDateUTC string, Rows array<{SECTION}>"
)


def report_cells(reports: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """One row per report cell, with its column header, row label and first linked attribute."""
    r = reports.select(*keep, F.from_json(payload, REPORT_SCHEMA).alias("r"))
    header_rows = F.filter(F.col("r.Rows"), lambda x: x["RowType"] == "Header")
    labels = F.transform(F.element_at(header_rows, -1)["Cells"], lambda c: c["Value"])
    sections = r.select(*keep, F.when(F.size(header_rows) > 0, labels).alias("_labels"),
                        F.posexplode("r.Rows").alias("section_index", "_s")).filter("_s.RowType <> 'Header'")
    is_section = F.col("_s.RowType") == "Section"
    direct = F.array(F.struct(F.col("_s.RowType").alias("RowType"), F.col("_s.Title").alias("Title"),
                              F.col("_s.Cells").alias("Cells")))
    rows = sections.select(
        *keep, "_labels", "section_index", F.when(is_section, F.col("_s.Title")).alias("section_title"),
        is_section.alias("_in"), F.posexplode(F.when(is_section, F.col("_s.Rows")).otherwise(direct)).alias("_ri", "_row"))
    cells = rows.select(
        *keep, "_labels", "section_index", "section_title",
        F.when(F.col("_in"), F.col("_ri")).otherwise(F.lit(-1)).alias("row_index"),
        F.col("_row.RowType").alias("row_type"), F.get("_row.Cells", F.lit(0))["Value"].alias("row_label"),
        F.posexplode("_row.Cells").alias("cell_index", "_cell"))
    first = F.get("_cell.Attributes", F.lit(0))
    return cells.select(
        *keep, F.lit(0).cast("bigint").alias("report_index"), F.col("section_index").cast("bigint").alias("section_index"),
        "section_title", F.col("row_index").cast("bigint").alias("row_index"), "row_type",
        F.col("cell_index").cast("bigint").alias("cell_index"), "row_label",
        F.get("_labels", F.col("cell_index")).alias("column_header"), F.col("_cell.Value").alias("cell_value"),
        first["Id"].alias("attribute_id"), first["Value"].alias("attribute_value"),
        F.when(F.size("_cell.Attributes") > 0, F.to_json("_cell.Attributes")).alias("attributes_json"))


def report_number(text) -> Column:
    """Cell text as a number, thousands separators and blanks tolerated."""
    c = text if isinstance(text, Column) else F.col(text)
    return F.regexp_replace(c, ",", "").try_cast("decimal(18,2)")
