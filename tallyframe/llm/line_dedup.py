"""Line dedup over levelled sorted runs of line hashes.

The index of all lines seen is a set of runs: tables sorted by line hash with, per line, the
number of documents and the document that keeps it. Each batch of documents is folded to one
row per line before any shuffle of the index, joined with the runs and split by that join into
lines the runs lack (it adds them, and the batch's largest document keeps them) and lines they
hold (it adds only their count). The result is written as a new run of level 0; as soon as a
level has ``fanout`` runs they are merged into one run of the next level. Batches go from large
ids to small ones, so the keeper found first is the largest document.

A line's key is the line with white space stripped at both ends and A-Z in lower case; keys
are compared by two independent 64-bit hashes. A key of at least ``MIN_CHARS`` code points that
``MIN_DOCS`` documents hold loses its lines in all of them but the keeper.

Defined cases: a null or empty text is one empty line and stays as it is; rows with the same
``doc_id`` are one document (it counts once, and keeps or loses the line in each row); a null
``doc_id`` is a document smaller than all others; an empty table gives an empty result; other
columns, whatever their names, are passed on. The work on a text is linear in its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm.rows import BLANKS, boxed, stored

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2
KEY = ["k1", "k2"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class LineRuns:
    """The levelled index; its runs are tables in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []
        self.empty = spark.createDataFrame([], "k1 bigint, k2 bigint, n_docs bigint, keeper bigint")

    def all(self) -> DataFrame:
        out = self.empty
        for run in (r for level in self.levels for r in level):
            out = out.unionByName(run)
        return out

    def add(self, batch: DataFrame) -> None:
        """Merge one batch, a row per line with its ``n_docs`` and ``last_doc``."""
        known = self.all().where("keeper is not null").select(*KEY, F.lit(True).alias("seen"))  # once per line
        self._write(0, batch.join(known, KEY, "left").select(
            *KEY, "n_docs", F.when(F.col("seen").isNull(), F.col("last_doc")).alias("keeper")))

    def _write(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(stored(run.sortWithinPartitions(*KEY), f"run-{level}"))
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            merged = runs[0]
            for r in runs[1:]:
                merged = merged.unionByName(r)
            self._write(level + 1, fold(merged))

    def index(self) -> DataFrame:
        """One row per line of all batches."""
        return fold(self.all())


def fold(runs: DataFrame) -> DataFrame:
    return runs.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))


def _marked(docs: DataFrame) -> DataFrame:
    """Input rows with their lines; rows are told apart by id and text hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return boxed(docs, did=F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))), thash=F.xxhash64(text), text=text)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line that is long enough: document, place and key."""
    key = F.translate(F.btrim("line", F.lit(BLANKS)), UPPER, LOWER)
    return (
        _marked(docs).select("did", "thash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("did", "thash", "pos", key.alias("key")).where(F.char_length("key") >= min_chars)
        .select("did", "thash", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))
    )


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ids that cut the documents into about equal batches."""
    cuts = docs.select(F.percentile_approx(F.col("doc_id").cast("bigint"), [k / batches for k in range(1, batches)])).first()[0]
    return sorted(set(cuts or []))


def build_runs(lines: DataFrame, bounds: list[int], fanout: int = FANOUT) -> LineRuns:
    """Feed the batches in order of falling ids."""
    runs = LineRuns(lines.sparkSession, fanout)
    ends = [None, *bounds, None]
    for low, high in reversed(list(zip(ends, ends[1:]))):
        batch = lines.where(F.lit(True) if low is None else F.col("did") > low).where(F.lit(True) if high is None else F.col("did") <= high)
        runs.add(batch.select(*KEY, "did").distinct().groupBy(*KEY).agg(
            F.count("*").alias("n_docs"), F.max("did").alias("last_doc")))
    return runs


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``row``, ``n_lines``, ``n_dropped`` and ``kept`` (the remaining text) of every input row."""
    lines = stored(line_keys(docs, min_chars), "lines")
    runs = build_runs(lines, batch_bounds(docs, batches), fanout)
    common = stored(runs.index().where(F.col("n_docs") >= min_docs), "common-lines")
    dropped = (
        lines.join(common, KEY).where("did <> keeper")
        .groupBy("did", "thash").agg(F.collect_set("pos").alias("gone"))
    )
    parts = F.split("text", "\n", -1)
    out = _marked(docs).join(dropped, ["did", "thash"], "left").select("row", "text", "gone", F.size(parts).cast("bigint").alias("n_lines"))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(parts) - 1), gone), i -> parts[i]), '\\n')")
    return out.select(
        "row", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"), "text", "gone",
        F.when(F.col("gone").isNotNull(), parts).alias("parts"),
    ).select("row", "n_lines", "n_dropped", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept"))


def apply(docs: DataFrame, **options) -> DataFrame:
    """The documents without their dropped lines, in the columns they came with (``n_chars`` follows the text)."""
    new = {"text": F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("kept").cast(kind)).otherwise(F.col("row.n_chars"))
    return deduplicated(docs, **options).select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             '{UPPER}', '{LOWER}') AS key FROM l),
common AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {MIN_CHARS}
           GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
m AS (SELECT k.doc_id, k.pos, k.line, common.key IS NOT NULL AND k.doc_id <> common.keeper AS gone
      FROM k LEFT JOIN common ON k.key = common.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
