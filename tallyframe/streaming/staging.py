"""Record envelopes to staging tables, for a full backfill or a batch of new files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallyframe.functions.dates import iso_date
from tallyframe.functions.text import query_map
from tallyframe.operators import documents as dm
from tallyframe.sinks.upsert import KeyedTable, collapse
from tallyframe.sources import pages as pg
from tallyframe.sources.documents import DOCUMENTS, child_table
from tallyframe.sources.endpoints import endpoint_config
from tallyframe.streaming import ingest

ENVELOPE = ["tenant_id", "synced_at", "first_seen_at"]
REPORT_ENDPOINT_PREFIX = "report_"


def staging_keys(endpoint: str) -> dict[str, list[str]]:
    """Merge key of every staging table an endpoint feeds."""
    base = ["tenant_id", "record_id"]
    if endpoint.startswith(REPORT_ENDPOINT_PREFIX):
        return {"report_snapshots": base, "report_rows": [*base, "report_index", "section_index", "row_index", "cell_index"]}
    spec = DOCUMENTS[endpoint]
    return {endpoint: base, **{child_table(endpoint, c): [*base, *s.key] for c, s in spec.children.items()}}


def stage_documents(envelopes: DataFrame, endpoint: str) -> dict[str, DataFrame]:
    """Header and child rows of one document kind, one row per merge key.

    Child rows carry the sync time of their document, which orders versions of a line.
    """
    spec = DOCUMENTS[endpoint]
    records = dm.parse_records(envelopes.filter(F.col("endpoint") == endpoint).select(*ENVELOPE, "payload"))
    keys = staging_keys(endpoint)
    out = {endpoint: dm.flatten_header(records, spec, ENVELOPE)}
    for c in spec.children:
        out[child_table(endpoint, c)] = dm.flatten_child(records, spec, c, ["tenant_id", "synced_at"])
    return {name: collapse(df, keys[name], ["synced_at"]) for name, df in out.items()}


def stage_reports(envelopes: DataFrame) -> dict[str, DataFrame]:
    """Snapshots and cells of every report kind; each run of a report is its own snapshot."""
    r = envelopes.filter(F.col("endpoint").startswith(REPORT_ENDPOINT_PREFIX))
    kind = F.coalesce(F.col("meta")["x-report"], F.col("meta")["x-endpoint"])
    run = F.coalesce(F.col("meta")["x-run-id"], F.lit(""))
    r = r.select("tenant_id", "synced_at", "first_seen_at", kind.alias("report"), run.alias("run_id"),
                 F.concat(kind, F.lit("|"), run).alias("record_id"), query_map(F.col("meta")["x-report-params"]).alias("p"), "payload")
    doc = F.from_json("payload", dm.REPORT_SCHEMA)
    snapshots = r.withColumn("d", doc).select(
        "tenant_id", "record_id", "synced_at", "first_seen_at", "report", "run_id", F.col("d.ReportID").alias("report_id"),
        F.col("d.ReportName").alias("report_name"), F.col("d.ReportType").alias("report_type"),
        F.nullif(F.array_join("d.ReportTitles", " | "), F.lit("")).alias("report_titles"),
        dm.READERS["epoch_timestamp"](F.col("d.UpdatedDateUTC")).alias("report_updated_utc"),
        iso_date(F.col("p")["date"]).alias("report_date"), iso_date(F.col("p")["fromDate"]).alias("report_from"),
        iso_date(F.col("p")["toDate"]).alias("report_to"))
    cells = dm.report_cells(r, "payload", ["tenant_id", "record_id", "report", "synced_at"])
    keys = staging_keys("report_")
    return {"report_snapshots": collapse(snapshots, keys["report_snapshots"], ["synced_at"]),
            "report_rows": collapse(cells, keys["report_rows"], ["synced_at"])}


def stage(envelopes: DataFrame, endpoint: str) -> dict[str, DataFrame]:
    return stage_reports(envelopes) if endpoint.startswith(REPORT_ENDPOINT_PREFIX) else stage_documents(envelopes, endpoint)


ENVELOPE_SCHEMA = (
    "tenant_id string, endpoint string, record_id string, payload string, first_seen_at timestamp_ntz, "
    "synced_at timestamp_ntz, meta map<string,string>"
)


def staging_schemas(spark: SparkSession) -> dict[str, StructType]:
    """Schema of every staging table, from the document configuration alone."""
    none = spark.createDataFrame([], ENVELOPE_SCHEMA)
    out = {n: df.schema for e in DOCUMENTS for n, df in stage_documents(none, e).items()}
    return out | {n: df.schema for n, df in stage_reports(none).items()}


def staging_table(root: str, name: str, keys: list[str], buckets: int = 64, schema: StructType | None = None) -> KeyedTable:
    return KeyedTable(f"{root.rstrip('/')}/{name}", keys, ["synced_at"], buckets, ["tenant_id"], schema)


def merge_endpoint(envelopes: DataFrame, endpoint: str, staging_root: str, buckets: int = 64) -> None:
    """Upsert one endpoint's batch into its staging tables; pages are read and unwrapped once."""
    keys = staging_keys(endpoint)
    held = envelopes.filter(F.col("endpoint") == endpoint).persist()
    try:
        for name, df in stage(held, endpoint).items():
            staging_table(staging_root, name, keys[name], buckets, df.schema).merge(df)
    finally:
        held.unpersist()


def landed_envelopes(spark: SparkSession, landing: str, **where: str) -> DataFrame:
    """Envelopes of everything below a landing prefix."""
    joined = pg.with_sidecar(pg.read_pages(spark, landing, **where), pg.read_sidecars(spark, landing, **where))
    return pg.record_envelopes(joined, endpoint_config(spark))


def backfill(spark: SparkSession, landing: str, staging_root: str, endpoints: list[str], buckets: int = 64, **where: str) -> None:
    """All tenants of each endpoint in one job per table; the prefix narrows the listing."""
    for e in endpoints:
        merge_endpoint(landed_envelopes(spark, landing, endpoint=e, **where), e, staging_root, buckets)


def arriving(spark: SparkSession, staging_root: str, endpoints: list[str], on_drift: Callable,
             buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """Batch handler for the sidecar stream: pages to envelopes, each endpoint to its tables.

    A repeated batch merges the same rows again, which changes nothing, and a ``BatchSink`` for drift takes it once.
    """
    parsers = {e: (lambda env, e=e: merge_endpoint(env, e, staging_root, buckets)) for e in endpoints}

    def handle(sidecars: DataFrame, batch_id: int) -> None:
        pages = ingest.pages_of(sidecars)
        if pages is None:
            return
        held = pages.persist()
        try:
            present = {r[0] for r in held.select("endpoint").distinct().collect()}
            ingest.deliver(on_drift, held.filter(~F.coalesce(F.col("endpoint").isin(endpoints), F.lit(False))), batch_id)
            env = pg.record_envelopes(held.filter(F.col("endpoint").isin(endpoints)), endpoint_config(spark)).persist()
            try:
                for e in endpoints:
                    if e in present:
                        parsers[e](env)
            finally:
                env.unpersist()
        finally:
            held.unpersist()

    return handle
