"""Exact substring dedup over induced, sampled suffixes, outside memory.

A byte goes if a 100-byte string that covers it also starts earlier. A full external suffix
sort would carry a tuple of ten bytes or more per byte of text through disk on every level of
its recursion; instead only sampled suffixes are sorted and named, and all others are induced:

*Sample.* Among the starts of 32-byte grams inside a 100-byte string, the least by gram hash
(the leftmost of equals) depends on that string alone, so equal strings have the same anchor at
the same offset. The anchors, 3 % of all positions, play the part of the leftmost S-type
suffixes: each stands for the run of starts that have it as anchor.

*Names.* A run's context is all bytes its strings cover. Runs with equal context are equal in all
their strings, so all but the first go, by one grouped minimum of context names (hashes of 88
bits next to a 40-bit anchor name).

*Induction.* What is left to decide are anchors with several contexts, at the ends of repeated
passages. Their strings are named from the context's prefix values and ordered within the
anchor; all but the first of equal strings go. Anchors with many contexts are spread: their
strings are shuffled one by one and joined with their first occurrence.

Anchor names that occur once need no further work. They are found by shuffling 40-bit names
alone; the rest passes a bitmap of fixed size (``FILTER_BITS``), which only saves work. All
larger steps are external sorts, aggregations and joins of Spark on disk; texts are shuffled
once, compressed.

Defined cases: null and empty texts have 0 bytes; documents are ordered by ``doc_id``, a null
before all others, rows with the same id by the hash of their text; identical rows (same id
and text) are one document and get the same result; an empty table gives an empty result;
other columns are ignored. Work and memory are linear in the length of a text, about 100 bytes
of memory per byte for a text longer than a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.features import map_texts
from tallyframe.llm.rows import stored
from tallyframe.llm.textvec import GOLDEN, as_bytes, mix

LENGTH = 100
GRAM = 32
NAME_BITS = 40
FILTER_BITS = 26
BUFFER_ROWS = 20_000  # contexts that a task holds at a time, some 150 bytes each
JUDGED_ROWS = 4_000  # contexts of whole anchors whose strings are compared at a time; all strings of a context take some kilobytes
CROWD = BUFFER_ROWS  # contexts of one anchor beyond which its strings are spread
CHUNK = 1 << 20
BASES = (0xD6E8FEB86659FD93, 0xA24BAED4963EE407)
_TABLES = [mix((np.arange(1, 257, dtype=np.uint64) + np.uint64(1000 * k)) * GOLDEN) for k in (1, 2)]


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, bits: int) -> np.ndarray:
    """At least 2^bits powers of ``base``, kept for the next chunk."""
    if len(_POWERS.get(base, ())) < 1 << bits:
        out = np.full(1 << bits, np.uint64(base))
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base]


class Names:
    """Hashes of any byte ranges of ``data``, two of 64 bits each, from prefix sums."""

    def __init__(self, data: np.ndarray):
        bits = max(16, int(len(data) + 1).bit_length())
        self.parts = []
        for base, table in zip(BASES, _TABLES):
            power = _powers(base, bits)
            prefix = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(table[data] * power[:len(data)], out=prefix[1:])
            self.parts.append((prefix, _powers(pow(base, -1, 1 << 64), bits)))

    def of(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = (end - start).astype(np.uint64) * GOLDEN
        return tuple(mix((prefix[end] - prefix[start]) * back[start] + size) for prefix, back in self.parts)


def grams(data: np.ndarray, width: int = GRAM) -> np.ndarray:
    """Hash of the gram at every position, from prefix sums (those that run over the end are never used)."""
    bits = max(16, int(len(data) + 1).bit_length())
    out = np.zeros(len(data), np.uint64)
    count = len(data) - width + 1
    if count > 0:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[0][data] * _powers(BASES[0], bits)[:len(data)], out=sums[1:])
        out[:count] = mix((sums[width:] - sums[:count]) * _powers(pow(BASES[0], -1, 1 << 64), bits)[:count])
    return out


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of string starts with one anchor: row, first start, last start, 40-bit anchor name."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    h = grams(data)
    bits = np.uint64(max(20, int(len(data)).bit_length()))
    low = h * GOLDEN >> bits << bits | np.arange(len(data), dtype=np.uint64)
    window, n = LENGTH - GRAM + 1, 1
    while 2 * n <= window:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    if window > n:
        low = np.minimum(low[:-(window - n)], low[window - n:])
    at = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(at)]
    start = np.flatnonzero(np.arange(LENGTH, len(at) + LENGTH) <= offsets[1:][row])
    at, row = at[start], row[start]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return row[first], start[first], start[last], h[at[first]] >> np.uint64(64 - NAME_BITS)


def slot(name: np.ndarray) -> np.ndarray:
    return (mix(name * GOLDEN) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def held(bitmap: np.ndarray, name: np.ndarray) -> np.ndarray:
    s = slot(name)
    return (bitmap[s >> 6] >> (s & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def bitmap_of(names: DataFrame) -> np.ndarray:
    """The fixed-size filter over column ``name``: 2^FILTER_BITS bits, whatever the input."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS - 6, np.uint64)
        for batch in batches:
            s = slot(batch.column(0).to_numpy().view(np.uint64))
            np.bitwise_or.at(bits, s >> 6, np.uint64(1) << (s & 63).astype(np.uint64))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].view(np.int64))], names=["at", "bits"])

    out = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    words = names.select("name").mapInArrow(fold, "at bigint, bits bigint").groupBy("at").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be in the one column of ``ids``.

    A bitmap of fixed size tells, so that most other rows need not be packed and shuffled for an exact join.
    """
    bitmap = bitmap_of(ids.toDF("name").where("name is not null"))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(held(bitmap, batch.column(key).fill_null(0).to_numpy().view(np.uint64))))

    return rows.mapInArrow(fn, rows.schema)


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with ``n``, the document's place (its id if ids are unique and present), and one row per place."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    plain = rows.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1 or doc_id is null or doc_id < 0").isEmpty()
    if plain:
        rows = rows.withColumn("n", F.col("doc_id"))
        return rows, rows
    ids = stored(rows.select("doc_id", F.xxhash64("text").alias("h")).distinct(), "ids")
    # the place in (id, hash) order: counts of range partitions, then ranks inside them
    ranged = stored(ids.orderBy(F.asc_nulls_first("doc_id"), "h").select("doc_id", "h", F.monotonically_increasing_id().alias("m")), "order")
    rows = rows.withColumn("h", F.xxhash64("text")).join(
        ranged.select(F.col("doc_id").alias("d"), F.col("h").alias("k"), F.col("m").alias("n")),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k"))).select("doc_id", "text", "n")
    return rows, rows.dropDuplicates(["n"])


def _shifted(names: np.ndarray) -> pa.Array:
    return pa.array(names.view(np.int64))


def _anchor_names(rows: DataFrame) -> DataFrame:
    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        name, count = np.unique(anchors(*as_bytes(part.column("text")))[3], return_counts=True)
        return pa.RecordBatch.from_arrays([_shifted(np.concatenate([name, name[count > 1]]))], names=["name"])

    return map_texts(rows, fn, "name bigint", CHUNK)


def _runs(rows: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Runs whose anchor may be repeated: context name ``k1, k2`` (the anchor's in front) and ``n``, ``at`` (start and length)."""

    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = as_bytes(part.column("text"))
        row, first, last, name = anchors(data, offsets)
        keep = held(bitmap, name)
        row, first, last, name = row[keep], first[keep], last[keep], name[keep]
        x, y = Names(data).of(first, last + LENGTH)
        k1 = name << np.uint64(64 - NAME_BITS) | x >> np.uint64(NAME_BITS)
        at = first - offsets[row] << 8 | last - first
        return pa.RecordBatch.from_arrays([_shifted(k1), _shifted(y), part.column("n").take(pa.array(row)), pa.array(at)], names=["k1", "k2", "n", "at"])

    return map_texts(rows, fn, "k1 bigint, k2 bigint, n bigint, at bigint", CHUNK)


def place_name(n: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(n.view(np.uint64) * GOLDEN + at.view(np.uint64))


def _contexts(rows: DataFrame, places: np.ndarray, crowds: np.ndarray) -> DataFrame:
    """Contexts of the runs in the filter ``places``; ``crowd``: its anchor has many."""

    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = as_bytes(part.column("text"))
        row, first, last, name = anchors(data, offsets)
        n = part.column("n").to_numpy()[row]
        at = first - offsets[row] << 8 | last - first
        keep = held(places, place_name(n, at))
        row, first, last, name, n, at = (v[keep] for v in (row, first, last, name, n, at))
        raw = data.tobytes()
        context = pa.array([raw[a:b] for a, b in zip(first, last + LENGTH)], pa.binary())
        return pa.RecordBatch.from_arrays([_shifted(name), pa.array(n), pa.array(at), context, pa.array(held(crowds, name))], names=["name", "n", "at", "context", "crowd"])

    return map_texts(rows, fn, "name bigint, n bigint, at bigint, context binary, crowd boolean", CHUNK)


def _strings(batch: pa.Table) -> tuple[np.ndarray, ...]:
    """All strings of the contexts of a batch: context row, document, start, two hashes."""
    context = batch.column("context").combine_chunks() if isinstance(batch, pa.Table) else batch.column("context")
    offsets = np.frombuffer(context.buffers()[1], np.int32)[context.offset:context.offset + len(context) + 1].astype(np.int64)
    data = np.frombuffer(context.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    at, n = batch.column("at").to_numpy(), batch.column("n").to_numpy()
    count = (at & 255) + 1
    row = np.repeat(np.arange(len(at)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[row] + step
    x, y = Names(data).of(begin, begin + LENGTH)
    return row, n[row], (at >> 8)[row] + step, x, y


def _later_in_anchor(rows: DataFrame) -> DataFrame:
    """Starts that repeat an earlier string of the same anchor, as spans ``n, first, last``."""

    def judge(table: pa.Table) -> pa.RecordBatch:
        row, n, p, x, y = _strings(table)
        order = np.lexsort((p, n, y, x))
        same = np.zeros(len(order), bool)
        same[1:] = (x[order][1:] == x[order][:-1]) & (y[order][1:] == y[order][:-1])
        late = np.zeros(len(order), bool)
        late[order] = same
        late = np.flatnonzero(late)
        cut = np.ones(len(late), bool)
        cut[1:] = (late[1:] != late[:-1] + 1) | (row[late[1:]] != row[late[:-1]])
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(late))[:len(first)] - 1  # there may be none
        return pa.RecordBatch.from_arrays([pa.array(n[late[first]]), pa.array(p[late[first]]), pa.array(p[late[last]])], names=["n", "first", "last"])

    def judged(table: pa.Table) -> Iterator[pa.RecordBatch]:
        names = table.column("name").to_numpy()
        start = 0
        while start < len(names):
            end = int(np.searchsorted(names, names[min(start + JUDGED_ROWS, len(names)) - 1], side="right"))
            yield judge(table.slice(start, end - start).combine_chunks())
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            rest.append(batch)
            if sum(len(b) for b in rest) >= BUFFER_ROWS:
                table = pa.Table.from_batches(rest)
                names = table.column("name").to_numpy()
                cut = int(np.searchsorted(names, names[-1]))  # the last anchor may go on
                if cut:
                    yield from judged(table.slice(0, cut))
                rest = table.slice(cut).combine_chunks().to_batches()
        if rest:
            yield from judged(pa.Table.from_batches(rest))

    return rows.repartition("name").sortWithinPartitions("name").select("name", "n", "at", "context").mapInArrow(run, "n bigint, first bigint, last bigint")


def _later_in_crowd(rows: DataFrame) -> DataFrame:
    """The same for crowded anchors: every string is a row, joined with its first occurrence."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 2000):
                _, n, p, x, y = _strings(pa.Table.from_batches([batch.slice(k, 2000)]).combine_chunks())
                yield pa.RecordBatch.from_arrays([_shifted(x), _shifted(y), pa.array(n), pa.array(p)], names=["x", "y", "n", "first"])

    strings = rows.select("n", "at", "context").mapInArrow(fn, "x bigint, y bigint, n bigint, first bigint")
    origin = strings.groupBy("x", "y").agg(F.min(F.struct("n", "first")).alias("origin"), F.max(F.struct("n", "first")).alias("end")).where("origin <> end")
    return strings.join(origin.select("x", "y", "origin"), ["x", "y"]).where(F.struct("n", "first") != F.col("origin")).select("n", "first", F.col("first").alias("last"))


def repeated_starts(rows: DataFrame) -> DataFrame:
    """Spans of starts (``n``, ``first``, ``last``) of all strings that also start earlier."""
    twice = _anchor_names(rows).groupBy("name").agg(F.count("*").alias("c")).where("c > 1")
    runs = stored(_runs(rows, bitmap_of(twice)), "runs")
    named = stored(runs.groupBy("k1", "k2").agg(F.min(F.struct("n", "at")).alias("head"), F.count("*").alias("c"))
                   .select("k1", "k2", "head", "c"), "contexts")
    copies = runs.join(named.where("c > 1").select("k1", "k2", "head").hint("merge"), ["k1", "k2"]).where(F.struct("n", "at") != F.col("head")).select(
        "n", F.shiftright("at", 8).alias("first"), (F.shiftright("at", 8) + F.col("at").bitwiseAND(255)).alias("last"))
    named = named.withColumn("name", F.shiftrightunsigned("k1", 64 - NAME_BITS))
    several = stored(named.groupBy("name").agg(F.count("*").alias("c")).where("c > 1"), "anchors")
    open_runs = named.select("name", "head.n", "head.at").join(several.select("name"), "name", "left_semi")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([_shifted(place_name(b.column("n").to_numpy(), b.column("at").to_numpy()))], names=["name"])

    places = bitmap_of(open_runs.select("n", "at").mapInArrow(place, "name bigint"))
    crowds = bitmap_of(several.where(F.col("c") > CROWD))
    contexts = stored(_contexts(rows, places, crowds), "open-contexts")
    out = copies.unionByName(_later_in_anchor(contexts.where("not crowd")))
    return out.unionByName(_later_in_crowd(contexts.where("crowd")))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, the removed ``spans`` (start, end) and the remaining bytes ``kept`` of every row."""
    rows, once = numbered(docs)
    starts = repeated_starts(once).distinct().groupBy("n").agg(F.collect_list(F.struct("first", "last")).alias("starts"))

    def pack(part: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=1)
        data, offsets = as_bytes(part.column("text"))
        raw = data.tobytes()
        packed = pa.array([press.compress(raw[a:b]) for a, b in zip(offsets, offsets[1:])], pa.binary())
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n"), packed], names=["doc_id", "n", "packed"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(0, len(batch), 256):
                yield cut_rows(batch.slice(k, 256), unpress)

    def cut_rows(batch: pa.RecordBatch, unpress) -> pa.RecordBatch:
        sizes, spans, kept = [], [], []
        for packed, starts_of in zip(batch.column("packed"), batch.column("starts")):
            text = unpress.decompress(packed.as_py())
            sizes.append(len(text))
            gone = covered(starts_of.as_py() or [])
            spans.append([{"start": int(a), "end": int(b)} for a, b in gone])
            ends = [0, *[int(e) for ab in gone for e in ab], len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2])))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"])

    packed = map_texts(rows, pack, "doc_id bigint, n bigint, packed binary")
    return packed.join(starts.hint("merge"), "n", "left").select("doc_id", "packed", "starts").mapInArrow(
        cut, "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")


def covered(starts: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings with the given starts cover."""
    out: list[list[int]] = []
    for a, b in sorted((s["first"], s["last"] + LENGTH) for s in starts):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(s) for s in out]
