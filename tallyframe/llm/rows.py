"""Shared helpers of the corpus operators: input columns, shared work tables, label rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.sinks.tables import stored

#: Fixed value: the ASCII white space that separates words, `[\\x20\\x09-\\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def boxed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole input row as ``row`` next to new columns, so that no input column can clash.

    Give it back with ``select("row.*")``.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[v.alias(k) for k, v in columns.items()])


def texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` (bigint) and ``text`` (string, never null) of documents."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def held_out(doc_id) -> Column:
    """True where crc32 of the id as text is divisible by five: labels never learnt from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def bind(value: str, name: str, body: str) -> str:
    """SQL for ``let name = value in body``; the value is computed once per row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def sha256_hex(col) -> Column:
    return F.sha2(F.encode(col, "UTF-8"), 256)


def training_rows(docs: DataFrame, labels: DataFrame, label_cols: list[str], limit: int) -> DataFrame:
    """Labelled texts for fitting: at most ``limit`` rows, the first by hash of the id.

    Rows whose id is held out, null labels and null ids are left out; a document with several
    labels takes the largest of each.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[F.col(c).cast("int").alias(c) for c in label_cols])
        .where(~held_out("doc_id") & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(*[F.max(c).alias(c) for c in label_cols])
        .dropna(subset=label_cols)
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    known = stored(known, "label-sample")  # the limit is a bound of its size: `limit` rows of a few integers
    return texts(docs).join(F.broadcast(known), "doc_id")


__all__ = ["BLANKS", "WORD_BREAK", "bind", "boxed", "held_out", "sha256_hex", "stored", "table", "texts", "training_rows"]
