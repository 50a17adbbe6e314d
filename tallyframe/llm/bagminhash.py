"""Near-duplicate texts by BagMinHash signatures, banding and an exact multiset check.

A text is the multiset of its five-word shingles (lower case). Two texts are near duplicates if
their weighted Jaccard similarity, sum of minima over sum of maxima of shingle counts, is 0.8
or more; classes are the connected components of that relation.

*Signature.* Every shingle has Poisson processes on (weight, time), one per dyadic weight
block [0,1), [1,2), [2,4), [4,8), ... so a weight ``w`` needs log w processes and texts that
hold the shingle often share the points of the lower blocks. A process serves all components
at once: points come in order of time, each with a random component and a random weight inside
the block, and count only if that weight is below ``w``. A component's value is its earliest
point, equal in two texts with probability exactly their weighted Jaccard similarity. Points are
drawn up to a time at which all components have likely been hit; texts that miss one go on from
there until none is missed, so the result is exact.

*Candidates.* ``BANDS`` bands of ``ROWS`` components are hashed to buckets. Identical texts are
folded to one representative first. In each bucket all members are checked against the least
member; whole buckets that are then in one component are settled. In the others, members outside
the largest component are held against the members of other components, in blocks and by
signature; pairs that may be similar are checked like the others. No pair inside a settled group
is ever made, and no pair leaves a task that its signatures rule out (chance 3e-5 for a link). At similarity 0.8 a pair shares no
bucket with probability (1 - 0.8^8)^48 = 1.5e-4.

Defined cases: null and empty texts have no shingles and are in a class of their own by
themselves; a text of fewer than five words is one shingle of all its words; rows with the same
``doc_id`` are one document; rows with a null ``doc_id`` are left out of ``classes`` and kept
by ``apply``; an empty table gives an empty result; other columns, whatever their names, are
passed on by ``apply``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.components import components
from tallyframe.llm.features import map_texts
from tallyframe.llm.rows import boxed, stored, texts
from tallyframe.llm.suffix import among, bitmap_of, held
from tallyframe.llm.textvec import GOLDEN, Words, mix, multiset, unit

SIMILARITY = 0.8
BANDS, ROWS = 48, 8
MARGIN_SIGMAS = 4
CELL_BYTES = 256 << 10  # of packed text that are compared with each other in one task
SIGNED_BYTES = 256 << 10  # of text that is signed at a time, with work arrays of some 60 MB
DRAWN = 1 << 15  # points drawn at a time, one per process at least
MANY_BLOCKS = 32
SKETCH_BITS = 18
SKETCH = 1 << SKETCH_BITS


def signatures(h: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int, size: int) -> np.ndarray:
    """BagMinHash signatures (rows x size) of weighted sets given as parallel arrays; 0 for rows without elements."""
    out = np.zeros((rows, size), np.uint64)
    total = np.bincount(row, weight, minlength=rows)
    level = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    at = np.repeat(np.arange(len(h)), level + 1)
    block = np.arange(len(at)) - np.repeat(np.cumsum(level + 1) - (level + 1), level + 1)
    low = np.where(block > 0, 2.0 ** (block - 1), 0.0)
    rate = np.maximum(low, 1.0)
    with np.errstate(over="ignore"):
        seed = mix(h[at] ^ mix((block + 1).astype(np.uint64) * GOLDEN))
    owner, limit = row[at], weight[at].astype(float)
    todo = np.flatnonzero(total > 0)
    horizon = np.zeros(rows)
    horizon[todo] = (math.log(size) + 0.5) / total[todo]
    pace, whole = rate * size, limit >= low + rate
    best, value = np.full(rows * size, np.inf), np.zeros(rows * size, np.uint64)
    x, part = np.zeros(len(at)), np.arange(len(at))  # time of the last point of every process; ``seed`` goes on with it
    while len(todo):
        until = horizon[owner]
        keys, times, marks = [], [], []
        live = part
        while len(live):
            # a process of a short text has many points: the fewer are left, the more points are drawn at a time
            steps = np.arange(1, max(1, min(256, DRAWN // len(live))) + 1, dtype=np.uint64)
            with np.errstate(over="ignore"):
                z = mix(seed[live][:, None] + steps * GOLDEN)
            t = -np.log(unit(z)) / pace[live][:, None]
            t[:, 0] += x[live]
            t = np.cumsum(t, axis=1)
            soon = t <= until[live][:, None]
            done = soon.sum(1)
            some = done > 0
            x[live[some]] = t[some, done[some] - 1]
            with np.errstate(over="ignore"):
                seed[live] += done.astype(np.uint64) * GOLDEN
            own, z, t = np.repeat(live, done), z[soon], t[soon]
            live = live[done == len(steps)]
            z2 = mix(z + GOLDEN)
            key = owner[own] * size + ((z2 >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            cut = np.flatnonzero(~whole[own])
            if len(cut):
                weight_at = low[own[cut]] + (z2[cut] & np.uint64(0xFFFFFFFF)).astype(float) * 2.0**-32 * rate[own[cut]]
                inside = np.ones(len(own), bool)
                inside[cut] = weight_at < limit[own[cut]]
                key, t, z = key[inside], t[inside], z[inside]
            np.minimum.at(best, key, t)
            keys.append(key)
            times.append(t)
            marks.append(z)
        key, t, z = (np.concatenate(v) for v in (keys, times, marks))
        won = t == best[key]
        value[key[won]] = z[won]
        full = np.isfinite(best.reshape(rows, size)[todo]).all(1)
        out[todo[full]] = value.reshape(rows, size)[todo[full]]
        todo = todo[~full]
        horizon[todo] += 1 / total[todo]
        again = np.zeros(rows, bool)
        again[todo] = True
        part = part[again[owner[part]]]
    return out


def bands_of(words: Words, bands: int = BANDS, width: int = ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers (texts x bands), one byte per component, and whether a text has any shingle."""
    h, row, weight = multiset(*words.shingles()[:2])
    sig = signatures(h, row, weight, words.rows, bands * width).reshape(words.rows, bands, width)
    out = np.zeros((words.rows, bands), np.uint64)
    with np.errstate(over="ignore"):
        out += (np.arange(bands, dtype=np.uint64) + np.uint64(1)) * GOLDEN
        for k in range(width):
            out = mix(out + sig[:, :, k])
    return out, (sig >> np.uint64(56)).astype(np.uint8).reshape(words.rows, bands * width), words.count > 0


def _signed(docs: DataFrame, bands: int, width: int) -> DataFrame:
    """``doc_id``, ``same`` (hash of the text), buckets and component bytes of each text with words."""

    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        keys, small, some = bands_of(Words(part.column("text")), bands, width)
        flat = pa.array(keys[some].view(np.int64).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), flat)
        marks = pa.array([m.tobytes() for m in small[some]], pa.binary())
        return pa.RecordBatch.from_arrays([*[part.column(c).filter(pa.array(some)) for c in ("doc_id", "same")], lists, marks], names=["doc_id", "same", "buckets", "marks"])

    rows = texts(docs).where("doc_id is not null").withColumn("same", F.unhex(F.md5("text")))
    return map_texts(rows, fn, "doc_id bigint, same binary, buckets array<bigint>, marks binary", SIGNED_BYTES)


def _entries(signed: DataFrame, bands: int) -> DataFrame:
    """``bucket``, ``a`` of buckets that may hold several texts (a bitmap of fixed size drops most others)."""
    names = signed.select(F.explode("buckets").alias("name")).groupBy("name").agg(F.count("*").alias("c")).where("c > 1")
    bitmap = bitmap_of(names)

    def fn(batches):
        for batch in batches:
            flat = batch.column("buckets").flatten().to_numpy()
            keep = np.flatnonzero(held(bitmap, flat.view(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[keep]), batch.column("doc_id").take(pa.array(keep // bands))], names=["bucket", "a"])

    return signed.select("doc_id", "buckets").mapInArrow(fn, "bucket bigint, a bigint")


def _packed(rows: DataFrame) -> DataFrame:
    """``doc_id`` and the compressed text."""

    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=1)
        packed = [press.compress((t.as_py() or "").encode()) for t in part.column("text")]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    return map_texts(rows, fn, "doc_id bigint, packed binary")


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted multisets."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / max(len(a) + len(b) - both, 1)


def verified(docs: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The ``pairs(a, b)`` whose texts are near duplicates; texts travel compressed."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    packed = stored(_packed(among(texts(docs), ids, "doc_id")).join(ids.hint("merge"), "doc_id", "left_semi"), "pair-texts")
    a, b = (packed.select(F.col("doc_id").alias(c), F.col("packed").alias(f"{c}_text")) for c in "ab")

    def check(batches):
        unpress = zstandard.ZstdDecompressor()

        def sets(values) -> list[np.ndarray]:
            words = Words(pa.array([unpress.decompress(v).decode() for v in values], pa.large_string()))
            h, row, _ = words.shingles()
            return np.split(h, np.cumsum(np.bincount(row, minlength=words.rows))[:-1])

        for batch in batches:
            for k in range(0, len(batch), 64):
                part = batch.slice(k, 64)
                like = [weighted_jaccard(x, y) >= similarity for x, y in zip(sets(part.column("a_text").to_pylist()), sets(part.column("b_text").to_pylist()))]
                yield part.select(["a", "b"]).filter(pa.array(like, pa.bool_()))

    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(check, "a bigint, b bigint")


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, width: int = ROWS) -> DataFrame:
    """``doc_id`` and ``class_id``, the least doc_id of its near duplicates, for every document."""
    signed = stored(_signed(docs, bands, width), "signatures")
    heads = signed.groupBy("same").agg(F.min("doc_id").alias("head"))
    owner = stored(signed.select("doc_id", "same").join(heads, "same").select("doc_id", "head").distinct(), "heads")
    firsts = owner.where("doc_id = head").select(F.col("doc_id").alias("a")).distinct()
    entries = stored(_entries(signed, bands).join(firsts.hint("merge"), "a", "left_semi"), "buckets")
    shared = entries.groupBy("bucket").agg(F.min("a").alias("b"), F.max("a").alias("other")).where("b < other").select("bucket", "b")
    tried = stored(entries.join(shared.hint("merge"), "bucket").where("a <> b").select("a", "b").distinct(), "pairs")
    links = stored(verified(docs, tried, similarity), "links")
    # documents with several texts belong to the classes of all of them
    links = links.unionByName(
        owner.groupBy("doc_id").agg(F.min("head").alias("a"), F.max("head").alias("b")).where("a < b").select("a", "b"))
    member = components(links)
    links = links.unionByName(_rest(docs, signed, entries, shared, tried, member, similarity, bands, width))
    member = components(links)
    out = owner.join(member.select(F.col("node").alias("head"), "root"), "head", "left").select("doc_id", F.coalesce("root", "head").alias("class_id"))
    wordless = texts(docs).select("doc_id").where("doc_id is not null").join(out, "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("class_id"))
    return out.groupBy("doc_id").agg(F.min("class_id").alias("class_id")).unionByName(wordless.distinct())


def _sketch(packed: DataFrame) -> np.ndarray:
    """How often elements fall into each of ``SKETCH`` slots: a table of fixed size that only orders elements."""

    def fn(batches):
        seen = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for _, _, _, h in _elements(batch):
                seen += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=SKETCH)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["slot", "n"])

    counts = packed.mapInArrow(fn, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SKETCH, np.uint32)
    out[counts.column("slot").to_numpy()] = np.minimum(counts.column("n").to_numpy(), 0xFFFFFFFF)
    return out


def _occurring(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every element: a shingle and how many of it the text has before."""
    h, row, _ = words.shingles()
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    turn = np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h))))
    return row, mix(h + turn.astype(np.uint64) * GOLDEN)


def _elements(batch):
    """``a``, ``root``, rows and hashes of the elements (shingle, how many before it in the text) of packed texts, a few texts at a time."""
    unpress = zstandard.ZstdDecompressor()
    for k in range(0, len(batch), 64):
        part = batch.slice(k, 64)
        row, h = _occurring(Words(pa.array([unpress.decompress(v).decode() for v in part.column("packed").to_pylist()], pa.large_string())))
        yield part.column("a"), part.column("root"), row, h


def _prefixes(packed: DataFrame, similarity: float) -> DataFrame:
    """``key``, ``a``, ``root``, ``size`` and ``short`` of the rarest elements of each text.

    Two sets of similarity s or more share an element among the rarest ``n - ceil(s n) + 1`` of the larger
    one and the rarest ``m - ceil(2 s / (1 + s) m) + 1`` (``short``) of the smaller one, in any common order.
    """
    order_by = _sketch(packed)

    def fn(batches):
        for batch in batches:
            for a, root, row, h in _elements(batch):
                if not len(h):
                    continue
                order = np.lexsort((h, order_by[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], row))
                h, row = h[order], row[order]
                size = np.bincount(row)
                place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
                least = [np.ceil(share * size - 1e-9).astype(np.int64)[row] for share in (similarity, 2 * similarity / (1 + similarity))]
                n = size[row]
                keep = place <= n - least[0]
                same = pa.array(row[keep])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[keep].view(np.int64)), a.take(same), root.take(same), pa.array(n[keep]), pa.array((place <= n - least[1])[keep])],
                    names=["key", "a", "root", "size", "short"])

    return packed.mapInArrow(fn, "key bigint, a bigint, root bigint, size bigint, short boolean")


def _agreeing(pairs: DataFrame, signed: DataFrame, similarity: float, size: int) -> DataFrame:
    """Pairs whose signatures do not rule the similarity out, and whether they are ``likely``."""
    least = (similarity - MARGIN_SIGMAS * (similarity * (1 - similarity) / size) ** 0.5) * size
    marks = signed.select("doc_id", "marks").groupBy("doc_id").agg(F.min("marks").alias("marks"), F.count("*").alias("n"))
    a, b = (marks.select(F.col("doc_id").alias(c), F.col("marks").alias(f"{c}_marks"), F.col("n").alias(f"{c}_n")) for c in "ab")

    def fn(batches):
        for batch in batches:
            if not len(batch):
                continue
            x, y = (np.frombuffer(b"".join(batch.column(f"{c}_marks").to_pylist()), np.uint8).reshape(len(batch), size) for c in "ab")
            agree = (x == y).sum(1)
            # a document with several texts has several signatures: its pairs are checked in any case
            several = (batch.column("a_n").to_numpy() > 1) | (batch.column("b_n").to_numpy() > 1)
            keep = pa.array((agree >= least) | several)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array((agree >= similarity * size) | several).filter(keep)], names=["a", "b", "likely"])

    return pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").select("a", "b", "a_marks", "b_marks", "a_n", "b_n").mapInArrow(fn, "a bigint, b bigint, likely boolean")


def _sets(packed: list[bytes]) -> list[np.ndarray]:
    """Sorted elements of packed texts, read a megabyte of text at a time."""
    unpress = zstandard.ZstdDecompressor()
    out: list[np.ndarray] = []
    texts_of: list[str] = []
    size = 0
    for k, v in enumerate(packed):
        texts_of.append(unpress.decompress(v).decode())
        size += len(texts_of[-1])
        if size < 1 << 20 and k + 1 < len(packed):
            continue
        row, h = _occurring(Words(pa.array(texts_of, pa.large_string())))
        out += [np.sort(x) for x in np.split(h, np.cumsum(np.bincount(row, minlength=len(texts_of)))[:-1])]
        texts_of, size = [], 0
    return out


def _cell_links(root: np.ndarray, block: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Near duplicates among the texts of a cell, as many as join what belongs together; ``root`` tells known components.

    Texts are joined on their rarest elements (see ``_prefixes``), counted within the cell. Pairs that are in one
    component by now are passed over. With two blocks, pairs inside a block belong to another cell.
    """
    component = np.unique(root, return_inverse=True)[1]
    size = np.array([len(x) for x in sets], np.int64)
    count = len(sets)
    across = block[0] != block[-1]
    found: list[tuple[int, int]] = []

    def check(i: int, others: np.ndarray) -> None:
        for j in others.tolist():
            if component[i] != component[j] and size[i] and size[j]:
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if common >= similarity * (size[i] + size[j] - common) - 1e-9:
                    found.append((i, j))
                    component[component == component[j]] = component[i]

    if count <= 8:
        for i in range(1, count):
            check(i, np.flatnonzero(block[:i] != block[i]) if across else np.arange(i))
        return found
    owner = np.repeat(np.arange(count), size)
    element = np.unique(np.concatenate(sets), return_inverse=True)[1]
    often = np.bincount(element)
    order = np.lexsort((element, often[element], owner))
    element = element[order]
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    long, short = (place <= size[owner] - np.ceil(share * size - 1e-9).astype(np.int64)[owner] for share in (similarity, 2 * similarity / (1 + similarity)))
    several = often[element] > 1
    listed, asking = np.flatnonzero(short & several), np.flatnonzero(long & several)
    listed = listed[np.argsort(element[listed], kind="stable")]
    keys, holder = element[listed], owner[listed]
    low, high = np.searchsorted(keys, element[asking]), np.searchsorted(keys, element[asking], side="right")
    first = np.searchsorted(owner[asking], np.arange(count + 1))
    for i in range(count):
        spans = range(first[i], first[i + 1])
        if not len(spans):
            continue
        met, times = np.unique(np.concatenate([holder[low[k]:high[k]] for k in spans]), return_counts=True)
        fit = (size[met] <= size[i]) & (size[met] >= similarity * size[i] - 1e-9) & (component[met] != component[i])
        if across:
            fit &= block[met] != block[i]
        check(i, met[fit][np.argsort(-times[fit], kind="stable")])
    return found


def _in_cells(rows: DataFrame, similarity: float) -> DataFrame:
    """Links from ``group, blocks, a, root, packed``: each text travels once to its group, or once per block of a large one."""
    own = F.pmod(F.xxhash64("a", "packed"), F.col("blocks"))
    cells = rows.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "group", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "a", "root", "packed")
    cells = cells.repartition("group", "x", "y").sortWithinPartitions("group", "x", "y", "own", "a")

    def fn(batches):
        held: list[tuple] = []
        size = 0

        def done():
            group, x, y, block, a, root, packed = zip(*held)
            sets = _sets(list(packed))
            cell = list(zip(group, x, y))
            cuts = [0, *[k for k in range(1, len(cell)) if cell[k] != cell[k - 1]], len(cell)]
            for s, e in zip(cuts[:-1], cuts[1:]):
                for i, j in _cell_links(np.array(root[s:e]), np.array(block[s:e]), sets[s:e], similarity):
                    yield max(a[s + i], a[s + j]), min(a[s + i], a[s + j])

        for batch in batches:
            out: list[tuple[int, int]] = []
            for row in zip(*[batch.column(c).to_pylist() for c in ("group", "x", "y", "own", "a", "root", "packed")]):
                if size > CELL_BYTES // 4 and row[:3] != held[-1][:3]:  # small cells are read together
                    out += done()
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)], names=["a", "b"])
        if held and (out := list(done())):
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)], names=["a", "b"])

    return cells.mapInArrow(fn, "a bigint, b bigint").distinct()


def _rest(docs: DataFrame, signed: DataFrame, entries: DataFrame, shared: DataFrame, tried: DataFrame,
          member: DataFrame, similarity: float, bands: int, width: int) -> DataFrame:
    """Links between documents that share a bucket with a member of another component.

    These documents form groups, connected by such buckets. The texts of a group are sent to one task, or in
    blocks of ``CELL_BYTES`` to one per two blocks, which returns links that join what belongs together and
    no other pairs. Groups of more than ``MANY_BLOCKS`` blocks go through a join on rarest elements instead.
    """
    inside = entries.join(shared.hint("merge"), "bucket").join(
        member.select(F.col("node").alias("a"), "root"), "a", "left").select("bucket", "b", "a", F.coalesce("root", "a").alias("root"))
    mixed = inside.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("bucket")
    inside = stored(inside.join(mixed.hint("merge"), "bucket", "left_semi"), "mixed-buckets")
    groups = components(inside.where("a <> b").select("a", "b").distinct()).select(F.col("node").alias("a"), F.col("root").alias("group"))
    members = stored(inside.select("a", "root").distinct().join(groups, "a"), "mixed")
    packed = stored(_packed(among(texts(docs), members.select("a").distinct(), "doc_id")).withColumnRenamed("doc_id", "a").join(members.hint("merge"), "a").select("group", "a", "root", "packed"), "mixed-texts")
    total = packed.groupBy("group").agg(F.ceil(F.sum(F.octet_length("packed")) / CELL_BYTES).alias("blocks"))
    sized = packed.join(total.hint("merge"), "group")
    found = stored(_in_cells(sized.where(F.col("blocks") <= MANY_BLOCKS), similarity), "links")
    packed = sized.where(F.col("blocks") > MANY_BLOCKS).select("a", "root", "packed")
    if packed.isEmpty():
        return found
    return found.unionByName(_by_rarest(docs, signed, packed, tried, member, similarity, bands * width))


def _by_rarest(docs: DataFrame, signed: DataFrame, packed: DataFrame, tried: DataFrame, member: DataFrame, similarity: float, size: int) -> DataFrame:
    """Links between the packed texts of different components that share a rare element, whatever the size of their group.

    Pairs that their signatures rule out (chance of a signature that is ``MARGIN_SIGMAS`` standard deviations
    off) are not verified.
    """
    rare = stored(_prefixes(packed, similarity), "rare-elements")
    short = rare.where("short").select("key", F.col("a").alias("b"), F.col("root").alias("b_root"), F.col("size").alias("b_size"))
    met = rare.join(short.hint("merge"), "key").where(
        (F.col("root") != F.col("b_root")) & (F.col("b_size") <= F.col("size")) & (F.col("b_size") >= F.col("size") * similarity - 1e-6))
    pairs = met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    pairs = stored(_agreeing(pairs, signed, similarity, size), "pairs")
    if pairs.isEmpty():
        return pairs.select("a", "b")
    # likely pairs first; of the others only those that these have not brought into one component
    links = stored(verified(docs, pairs.where("likely").select("a", "b"), similarity), "links")
    root = member.select(F.col("node").alias("n"), "root")
    known = links.select(F.col("a").alias("n")).unionByName(links.select(F.col("b").alias("n"))).distinct().join(root, "n", "left")
    joined = known.select("n", F.coalesce("root", "n").alias("old"))
    a, b = (joined.select(F.col("n").alias(c), F.col("old").alias(f"{c}_root")) for c in "ab")
    merged = components(links.join(a, "a").join(b, "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
    rest = pairs.where("not likely").select("a", "b")
    for c in "ab":
        rest = rest.join(root.withColumnRenamed("n", c), c, "left").withColumn("old", F.coalesce("root", c)).drop("root")
        rest = rest.join(merged.select(F.col("node").alias("old"), F.col("root").alias("new")), "old", "left")
        rest = rest.withColumn(f"{c}_root", F.coalesce("new", "old")).drop("old", "new")
    rest = stored(rest.where("a_root <> b_root").select("a", "b"), "pairs")
    return links.unionByName(stored(verified(docs, rest, similarity), "links"))


def apply(docs: DataFrame, **options) -> DataFrame:
    """One row of each class, of the document with the least ``doc_id``; rows without an id stay."""
    first = classes(docs, **options).where("doc_id = class_id").select(F.col("doc_id").alias("id"))
    rows = boxed(docs, id=F.col("doc_id").cast("bigint"))
    one = rows.where("id is not null").join(first, "id", "left_semi").dropDuplicates(["id"])
    return one.unionByName(rows.where("id is null")).select("row.*")
