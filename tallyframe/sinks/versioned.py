"""Keyed upserts as append-only runs with numbered snapshots (K1, K3): a batch writes only its own rows.

A table is a folder of *runs*, written once and never changed, and of numbered *snapshots*, small
JSON files that list what is live: for every folder (split and bucket) the run that holds its base,
the delta runs on top, the columns, the last batch of each writer and the last merge into each folder. A merge collapses its batch,
writes it as one delta run and adds a snapshot. ``read`` takes the newest snapshot: folders without
deltas are read as they are, in the others the latest row of a key wins, as in
:func:`tallyframe.sinks.upsert.upsert`. ``compact`` rewrites only folders that have deltas.

A snapshot gets its name by a rename that fails if the name is taken, so of two writers one wins
and the other adds its run to the newer snapshot. There is no lock to be left behind: a writer that
dies leaves a run that no snapshot lists.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ArrayType, MapType,
                               ShortType, StructField, StructType, TimestampNTZType)

from tallyframe.operators.latest import latest_by
from tallyframe.sinks.upsert import content_hash, fully_keyed, path_exists

_WHOLE = [ByteType(), ShortType(), IntegerType(), LongType()]
_PLACE = ["_split", "_bucket", "_twin", "_run"]


def wider(old: DataType, new: DataType) -> DataType:
    """The type that holds both: fields are added at any depth, numbers and dates widened; anything else is an error."""
    if old == new:
        return old
    if isinstance(old, StructType) and isinstance(new, StructType):
        added = {f.name: f for f in new.fields}
        kept = [StructField(f.name, wider(f.dataType, added.pop(f.name).dataType) if f.name in added else f.dataType) for f in old.fields]
        return StructType([*kept, *[StructField(f.name, f.dataType) for f in new.fields if f.name in added]])
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(wider(old.elementType, new.elementType))
    if isinstance(old, MapType) and isinstance(new, MapType) and old.keyType == new.keyType:
        return MapType(old.keyType, wider(old.valueType, new.valueType))
    if old in _WHOLE and new in _WHOLE:
        return _WHOLE[max(_WHOLE.index(old), _WHOLE.index(new))]
    if {old, new} <= {FloatType(), DoubleType()}:
        return DoubleType()
    if {old, new} <= {DateType(), TimestampNTZType()}:
        return TimestampNTZType()
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        scale, whole = max(old.scale, new.scale), max(old.precision - old.scale, new.precision - new.scale)
        if scale + whole <= 38:
            return DecimalType(scale + whole, scale)
    raise ValueError(f"{old.simpleString()} and {new.simpleString()} have no common type")


@dataclass(frozen=True)
class Snapshot:
    """What is live in a table: ``base`` maps folders to runs, ``deltas`` are runs with the folders each has rows for."""

    number: int = 0
    layout: str = ""
    columns: dict = field(default_factory=dict)
    base: dict[str, str] = field(default_factory=dict)
    deltas: list[dict] = field(default_factory=list)
    applied: dict[str, int] = field(default_factory=dict)
    changed: dict[str, int] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(self.columns)


@dataclass(frozen=True)
class VersionedTable:
    """One current row per key; see the module. ``order`` and ``split_by`` are as in ``KeyedTable``.

    Rows with a NULL key part are kept as they come, but not once more when a batch is replayed.
    """

    path: str
    keys: list[str]
    order: list[str]
    buckets: int = 64
    split_by: list[str] = field(default_factory=list)

    # ------------------------------------------------------------ snapshots
    def _fs(self, spark: SparkSession, path: str):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _log(self, number: int) -> str:
        return f"{self.path}/_snapshots/{number:020d}.json"

    def versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the snapshots that exist."""
        p, fs = self._fs(spark, f"{self.path}/_snapshots")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[:20]) for n in names if len(n) == 25 and n[:20].isdigit())

    def snapshot(self, spark: SparkSession, number: int | None = None) -> Snapshot:
        """A snapshot, the newest if no number is given; an empty one if there is none."""
        known = self.versions(spark)
        if not known:
            return Snapshot()
        text = spark.read.text(self._log(known[-1] if number is None else number), wholetext=True).first()[0]
        return Snapshot(**json.loads(text))

    def _commit(self, spark: SparkSession, new: Snapshot) -> bool:
        """Publish a snapshot under its number; False if another writer has taken it."""
        jvm = spark.sparkContext._jvm
        temp, fs = self._fs(spark, f"{self.path}/_snapshots/.{uuid.uuid4().hex}")
        out = fs.create(temp, False)
        out.write(bytearray(json.dumps(new.__dict__).encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        target, _ = self._fs(spark, self._log(new.number))
        try:
            files.rename(files.makeQualified(temp), files.makeQualified(target), spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            fs.delete(temp, False)
            return False
        return True

    # ------------------------------------------------------------ rows
    def _own_layout(self) -> str:
        return f"{','.join(self.keys)}|{','.join(self.split_by)}|{self.buckets}"

    def _placed(self, df: DataFrame) -> DataFrame:
        """Rows with folder and, for those without a full key, their content and the how-manieth of such rows they are."""
        # the leading letter keeps folder names from being read back as numbers or dates
        split = F.concat_ws("|", F.lit("k"), *[F.col(c).cast("string") for c in self.split_by])
        loose = ~fully_keyed(self.keys)
        content = content_hash(df)
        turn = F.row_number().over(Window.partitionBy("_content").orderBy("_content"))
        placed = df.withColumn("_split", split).withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        odd = placed.filter(loose).withColumn("_content", content).withColumn("_twin", F.concat_ws("|", "_content", turn)).drop("_content")
        return placed.filter(~loose).withColumn("_twin", F.lit(None).cast("string")).unionByName(odd)

    def _identity(self) -> list[str]:
        return ["_split", "_bucket", *self.keys, "_twin"]

    def _latest(self, rows: DataFrame) -> DataFrame:
        """One row per key: the latest by ``order``, of equals that of the later run, then by content."""
        tie = content_hash(rows, without=(*self.order, *_PLACE))
        return latest_by(rows, self._identity(), [*[F.desc_nulls_last(c) for c in self.order], F.desc("_run"), F.desc(tie)])

    def _write(self, spark: SparkSession, rows: DataFrame, run: str) -> list[str]:
        """Write a run, folder by folder; returns its folders."""
        out = rows.withColumns({"_s": F.col("_split"), "_b": F.col("_bucket")}).hint("rebalance", "_split", "_bucket")
        out.write.partitionBy("_split", "_bucket").parquet(f"{self.path}/runs/{run}")
        p, fs = self._fs(spark, f"{self.path}/runs/{run}")
        splits = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]
        return sorted(f"{s.getName()}/{b.getPath().getName()}" for s in splits for b in fs.listStatus(s) if b.isDirectory())

    def _files(self, spark: SparkSession, snap: Snapshot, folders: dict[str, str] | list[tuple[str, str]]) -> DataFrame:
        """Rows of (folder, run) pairs, with the columns of the snapshot. No footer is opened for the columns."""
        schema = StructType([*snap.schema.fields, *StructType.fromDDL("_twin string, _run bigint, _s string, _b int").fields])
        pairs = list(folders.items()) if isinstance(folders, dict) else folders
        if not pairs:
            return spark.createDataFrame([], schema).withColumnsRenamed({"_s": "_split", "_b": "_bucket"})
        return spark.read.schema(schema).parquet(*[f"{self.path}/runs/{run}/{f}" for f, run in pairs]).withColumnsRenamed({"_s": "_split", "_b": "_bucket"})

    def _current(self, spark: SparkSession, snap: Snapshot, touched: set[str]) -> DataFrame:
        """Current rows of the touched folders: base rows whose key no delta has, and the latest of the others."""
        delta = self._files(spark, snap, [(f, d["run"]) for d in snap.deltas for f in d["folders"] if f in touched])
        base = self._files(spark, snap, {f: r for f, r in snap.base.items() if f in touched})
        same = None
        names = delta.select(*[F.col(k).alias(f"_d{i}") for i, k in enumerate(self._identity())]).distinct()
        for i, k in enumerate(self._identity()):
            term = F.col(k).eqNullSafe(F.col(f"_d{i}"))
            same = term if same is None else same & term
        met = base.join(names, same, "left_semi").unionByName(delta)
        return base.join(names, same, "left_anti").unionByName(self._latest(met))

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """The table as of a snapshot, the newest if no number is given."""
        snap = self.snapshot(spark, number)
        if not snap.columns:
            raise ValueError(f"{self.path} has no snapshot")
        touched = {f for d in snap.deltas for f in d["folders"]}
        out = self._files(spark, snap, {f: r for f, r in snap.base.items() if f not in touched})
        if touched:
            out = out.unionByName(self._current(spark, snap, touched))
        return out.drop(*_PLACE)

    @staticmethod
    def _split_of(folder: str) -> str:
        return unquote(folder.split("/")[0].removeprefix("_split="))

    def changed_splits(self, spark: SparkSession, since: int | None, until: int) -> list[str]:
        """Splits that a merge after snapshot ``since`` touched; all for no first one. Compaction changes nothing."""
        changed = self.snapshot(spark, until).changed
        return sorted({self._split_of(f) for f, n in changed.items() if n > (since or 0)})

    def read_splits(self, spark: SparkSession, splits: list[str], number: int | None = None) -> DataFrame:
        """The rows of some splits, with ``_split``; no other folder is opened."""
        snap = self.snapshot(spark, number)
        wanted = {f for f in {*snap.base, *[f for d in snap.deltas for f in d["folders"]]} if self._split_of(f) in set(splits)}
        touched = {f for d in snap.deltas for f in d["folders"]} & wanted
        out = self._files(spark, snap, {f: r for f, r in snap.base.items() if f in wanted and f not in touched})
        if touched:
            out = out.unionByName(self._current(spark, snap, touched))
        return out.drop(*[c for c in _PLACE if c != "_split"])

    # ------------------------------------------------------------ writers
    def merge(self, batch: DataFrame, writer: str | None = None, batch_id: int | None = None, compact_after: int | None = None) -> bool:
        """Add a batch as one delta run; False if this writer's batch was merged before.

        ``compact_after``: compact once so many delta runs are live.
        """
        spark = batch.sparkSession
        snap = self.snapshot(spark)
        if self._done(snap, writer, batch_id):
            return False
        if snap.layout and snap.layout != self._own_layout():
            raise ValueError(f"{self.path} is laid out as {snap.layout}, not as {self._own_layout()}")
        if snap.columns:
            wider(snap.schema, batch.schema)  # refuse before anything is written
        run = uuid.uuid4().hex
        folders = self._write(spark, self._latest(self._placed(batch).withColumn("_run", F.lit(snap.number + 1).cast("bigint"))), run)
        while True:
            columns = wider(snap.schema, batch.schema) if snap.columns else batch.schema
            applied = snap.applied | ({writer: batch_id} if writer is not None else {})
            deltas = [*snap.deltas, {"run": run, "folders": folders}] if folders else snap.deltas
            changed = snap.changed | dict.fromkeys(folders, snap.number + 1)
            if self._commit(spark, Snapshot(snap.number + 1, self._own_layout(), json.loads(columns.json()), snap.base, deltas, applied, changed)):
                break
            snap = self.snapshot(spark)
            if self._done(snap, writer, batch_id):
                return False
        if compact_after is not None and len(deltas) >= compact_after:
            self.compact(spark)
        return True

    @staticmethod
    def _done(snap: Snapshot, writer: str | None, batch_id: int | None) -> bool:
        return writer is not None and snap.applied.get(writer, -1) >= batch_id

    def compact(self, spark: SparkSession) -> int:
        """Merge the deltas that are live now into their folders' bases; returns the number of folders rewritten.

        Batches merged meanwhile stay deltas. If another compaction was faster, this one's run is not listed.
        """
        snap = self.snapshot(spark)
        touched = {f for d in snap.deltas for f in d["folders"]}
        if not touched:
            return 0
        run = uuid.uuid4().hex
        written = self._write(spark, self._current(spark, snap, touched), run)
        done = {d["run"] for d in snap.deltas}
        now = snap
        while True:
            if now.base != snap.base:
                return 0
            base = {f: r for f, r in now.base.items() if f not in touched} | dict.fromkeys(written, run)
            left = [d for d in now.deltas if d["run"] not in done]
            if self._commit(spark, Snapshot(now.number + 1, now.layout, now.columns, base, left, now.applied, now.changed)):
                return len(written)
            now = self.snapshot(spark)

    def expire(self, spark: SparkSession, keep: int = 1) -> int:
        """Delete all but the newest ``keep`` snapshots and the runs that no remaining one lists; returns the runs deleted.

        Only to be called when no merge, compaction or reader of an older snapshot is under way.
        """
        numbers = self.versions(spark)
        kept = [self.snapshot(spark, n) for n in numbers[-keep:]]
        live = {r for s in kept for r in [*s.base.values(), *[d["run"] for d in s.deltas]]}
        for n in numbers[:-keep]:
            p, fs = self._fs(spark, self._log(n))
            fs.delete(p, False)
        p, fs = self._fs(spark, f"{self.path}/runs")
        gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName() not in live] if fs.exists(p) else []
        for old in gone:
            fs.delete(old, True)
        return len(gone)

    def schema_log(self, spark: SparkSession) -> list[tuple[int, StructType]]:
        """Number and columns of each snapshot that brought new ones."""
        out: list[tuple[int, StructType]] = []
        for n in self.versions(spark):
            schema = self.snapshot(spark, n).schema
            if not out or out[-1][1] != schema:
                out.append((n, schema))
        return out

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, f"{self.path}/_snapshots")
