"""Raw landing zone: JSON pages, their sidecars and the records inside.

Layout: ``raw/{vendor}/{tenant}/{api}/{endpoint}/{yyyy-mm-dd}/{ts}_{run}_p{NNN}.json`` for pages
of records and ``…/{ts}_{run}__{period}.json`` for report snapshots, each with a flat
``.meta.json`` map next to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.functions import dates, jsonx
from tallyframe.operators.latest import latest_by

# Object key patterns (folders, file name) and sidecar suffix.
FOLDER_PATTERN = r"raw/([^/]+)/([^/]+)/([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})/[^/]+$"
FOLDER_PARTS = ["vendor", "tenant", "api", "endpoint", "run_date"]
FILE_PATTERN = r"/([^/_]+)_([^/]+?)(?:_p(\d+)|__([^/]+))\.json$"
FILE_PARTS = ["ts", "run_id", "page", "period"]
META_SUFFIX = ".meta.json"


def page_key_columns(path: Column) -> list[Column]:
    """Columns encoded in an object key, folders and file name apart; NULL where one has another shape.

    A record page has a ``page`` number, a report snapshot a ``period``.
    """
    out = []
    parts = [(FOLDER_PATTERN, i, n) for i, n in enumerate(FOLDER_PARTS, 1)] + [(FILE_PATTERN, i, n) for i, n in enumerate(FILE_PARTS, 1)]
    for pattern, i, name in parts:
        part = F.nullif(F.regexp_extract(path, pattern, i), F.lit(""))
        if name == "run_date":
            part = part.try_cast("date")
        if name == "page":
            part = part.try_cast("int")
        out.append(part.alias(name))
    return out


def _texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def page_glob(root: str, vendor: str = "*", tenant: str = "*", endpoint: str = "*", day: str = "*") -> str:
    """Tight listing prefix; every known part narrows what is listed and read."""
    return f"{root.rstrip('/')}/raw/{vendor}/{tenant}/*/{endpoint}/{day}"


def read_pages(spark: SparkSession, root: str, vendor: str = "*", tenant: str = "*", endpoint: str = "*",
               day: str = "*") -> DataFrame:
    """Page bodies with the columns of their object key."""
    raw = _texts(spark, page_glob(root, vendor, tenant, endpoint, day) + "/*.json")
    bodies = raw.filter(~F.col("path").endswith(META_SUFFIX))
    return bodies.select("*", *page_key_columns(F.col("path")))


def read_sidecars(spark: SparkSession, root: str, vendor: str = "*", tenant: str = "*", endpoint: str = "*",
                  day: str = "*") -> DataFrame:
    raw = _texts(spark, page_glob(root, vendor, tenant, endpoint, day) + "/*" + META_SUFFIX)
    return raw.select(F.col("path").alias("meta_path"), F.from_json("body", "map<string,string>").alias("meta"))


def body_path(meta_path) -> Column:
    """Path of the page a sidecar belongs to."""
    c = meta_path if isinstance(meta_path, Column) else F.col(meta_path)
    return F.regexp_replace(c, r"\.meta\.json$", "") if META_SUFFIX == ".meta.json" else c


def with_sidecar(pages: DataFrame, sidecars: DataFrame, path: str = "path", meta_path: str = "meta_path") -> DataFrame:
    """Each page with its sidecar; the page name may or may not carry its own suffix."""
    stem = F.regexp_replace(F.col(path), r"\.json$", "")
    side = sidecars.withColumn("_stem", F.regexp_replace(body_path(meta_path), r"\.json$", ""))
    return pages.withColumn("_stem", stem).join(side, "_stem").drop("_stem")


def unwrap(pages: DataFrame, config: DataFrame, body: str, endpoint: str, keep: list[str]) -> DataFrame:
    """One row per record of a page; records without id are dropped.

    The array key and id field come from the endpoint configuration (a fixed short list).
    """
    j = pages.join(F.broadcast(config.withColumnRenamed("endpoint", "_ep")), F.col(endpoint) == F.col("_ep"))
    v = j.withColumn("_v", jsonx.parsed(body))
    arr = F.try_variant_get("_v", F.concat(F.lit("$."), F.col("array_key")), "array<variant>")
    rec = v.select(*keep, "id_field", F.explode(arr).alias("_r"))
    rid = F.try_variant_get("_r", F.concat(F.lit("$."), F.col("id_field")), "string")
    return rec.select(*keep, rid.alias("record_id"), F.to_json("_r").alias("payload")).filter(
        F.col("record_id").isNotNull() & (F.col("record_id") != ""))


def record_envelopes(pages_with_meta: DataFrame, config: DataFrame) -> DataFrame:
    """Envelope rows (tenant, record, payload, timestamps, meta) from pages joined to sidecars.

    The sidecar names the endpoint where the object key does not.
    """
    named = pages_with_meta.withColumn("endpoint", F.coalesce("endpoint", F.col("meta")["x-endpoint"]))
    rec = unwrap(named, config, "body", "endpoint", ["endpoint", "meta"])
    seen = dates.iso_datetime(F.col("meta")["x-synced-at"])
    return rec.select(
        F.col("meta")["x-tenant-id"].alias("tenant_id"), "endpoint", "record_id", "payload",
        seen.alias("first_seen_at"), seen.alias("last_seen_at"), seen.alias("synced_at"), "meta")


def latest_records(bronze: DataFrame, tenant: str, record: list[str], order: list[Column],
                   tenant_id=None) -> DataFrame:
    """Latest row per (tenant, record), optionally for one tenant."""
    src = bronze.filter(F.col(tenant) == tenant_id) if tenant_id is not None else bronze
    return latest_by(src, [tenant, *record], order)


def point_lookup(df: DataFrame, order: list[Column], **key) -> DataFrame:
    """At most one row by natural key, the first by ``order``; the predicate reaches the scan."""
    for c, v in key.items():
        df = df.filter(F.col(c) == v)
    return df.orderBy(*order).limit(1)


def drift(seen: DataFrame, endpoint: str, registered: DataFrame) -> DataFrame:
    """Endpoints found in storage but not registered, with row counts."""
    counts = seen.groupBy(endpoint).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.join(F.broadcast(registered.select(endpoint)), endpoint, "left_anti")
