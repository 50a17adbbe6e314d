"""Language-model scores of whole texts by a probabilistic suffix tree over words.

*Model.* Tokens are words, A-Z in lower case, and one end per text. With training counts ``n``, the root
predicts ``P(x) = (n(x) + 1) / (N + V + 1)``. A context ``s`` of up to ``DEPTH`` words is *tried* if it
occurs at least ``MIN_COUNT`` times, in a corpus of any size, its suffix (without the first word) is a state
and its prefix (without the last word) was tried. A tried context becomes a *state* if its next tokens diverge from
those of its suffix: some token x with ``n(sx) >= 2`` has ``n(sx) ln(n(sx) / (n(s) P(x | suffix))) >=
RETAIN`` nats. A state is smoothed with its suffix by the number ``k(s)`` of different tokens that
followed it (Witten and Bell): ``P(x | s) = (n(sx) + k(s) P(x | suffix)) / (n(s) + k(s))``. A token is scored by the longest state that the words before it end in. No part of
the tree is capped: it grows with the corpus.

*Distribution.* Texts are read once and become chunks of some ``CHUNK_TOKENS`` tokens: one row with the
chunk's dictionary of word hashes and its tokens as numbers. Chunks are written in buckets, so that
later joins bring answers to them and move no chunk. For each depth there is one round: every chunk
asks for its distinct (context, token) pairs once, however often they occur in it; pairs are dealt to
groups by the context's hash, summed there over all chunks, the divergence test is made (a chunk sends
with each pair the count that would pass), and answers go back in the order of the questions: the
count of each pair, and k(s) of each context, or 0 if it is no state. At depth 0 words get numbers, by
which deeper rounds name tokens and contexts. A token that occurs once in training after a context, and in no
held-out text, occurs once after the longer context too: such pairs are not asked for, only counted in k(s); nor are those that
do not occur in training after the shorter context. What is asked for rises within a group, contexts by name and the tokens of each
by number, and is sent as steps. A context with more than a quarter of an average group's tokens is dealt by pair instead, and its k(s) goes through the driver: there
are at most ``4 x groups`` such contexts. So a hot word or pair makes at most one entry per chunk and spreads over all
groups. The number of groups grows with the corpus.

Defined cases: a null text is empty, an empty text is its end alone; a null ``doc_id`` counts as empty
text in the choice of training rows; rows with the same ``doc_id`` are scored each by itself; with no
training row the root is uniform over the one unknown token (probability 1); an empty table gives an
empty result; other columns are ignored. Words are compared by 64-bit hashes, contexts by the numbers of their words or, if these
do not fit into 63 bits, by 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm.rows import stored, texts
from tallyframe.llm.textvec import ASCII_LOWER, GOLDEN, Words, chunks, mix
from tallyframe.session import work_path

DEPTH = 3
MIN_COUNT = 4
RETAIN = 8.0
CHUNK_TOKENS = 600_000
GROUP_TOKENS = 3_000_000
#: The hash of the end token; words have at least one byte.
END = mix(np.array([3], np.uint64) * GOLDEN)[0]


def not_trained(doc_id: str):
    """True where crc32 of the id as text leaves 2 when divided by 7."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def steps(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """What each value adds to the one before, as 64-bit numbers that wrap around; values at ``starts`` are as they are."""
    out = values.astype(np.uint64)
    out[1:] -= values[:-1].astype(np.uint64)
    out[starts] = values[starts]
    return out


def summed(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The inverse of ``steps``; ``starts`` ascend from 0."""
    out = np.cumsum(values, dtype=np.uint64)
    return out - np.repeat(out[starts] - values[starts], np.diff(np.append(starts, len(values))))


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """An array of non-negative integers, in the smallest type that holds it, byte by byte of all values, compressed; of ``rising`` ones the steps."""
    if rising:
        data = pack(steps(values, np.arange(min(1, len(values)))))
        return data[:1].lower() + data[1:]
    top = int(values.max(initial=0))
    kind = next(k for k in "BHIQ" if top < 1 << 8 * np.dtype(k).itemsize)
    raw = np.ascontiguousarray(values, np.dtype(kind)).view(np.uint8)
    raw = (raw if kind == "B" else raw.reshape(-1, np.dtype(kind).itemsize).T).tobytes()
    return kind.encode() + len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    if data[:1].islower():
        return np.cumsum(unpack(data[:1].upper() + data[1:]), dtype=np.uint64)
    raw = pa.decompress(data[9:], int.from_bytes(data[1:9], "little"), "zstd", asbytes=True)
    kind = np.dtype(chr(data[0]))
    if kind.itemsize == 1:
        return np.frombuffer(raw, kind)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def distinct(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of keys below 2^bits, and the place of each key among them.

    Keys and their places are sorted as single numbers where they fit, which is several times as fast.
    """
    low = max(1, len(key).bit_length())
    if bits + low > 64 or not len(key):
        return np.unique(key, return_inverse=True)
    both = key.astype(np.uint64)
    both <<= np.uint64(low)
    both |= np.arange(len(key), dtype=np.uint64)
    both.sort()
    at = (both & np.uint64((1 << low) - 1)).astype(np.int64)
    both >>= np.uint64(low)
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    place = np.empty(len(key), np.int32)
    place[at] = np.cumsum(new, dtype=np.int32) - 1
    return both[new].astype(key.dtype), place


def distinct_hashes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes and the place of each; by their upper bits if these tell them apart."""
    low = np.uint64(max(1, len(h).bit_length()))
    upper, place = distinct(h >> low, 64 - int(low))
    words = np.zeros(len(upper), np.uint64)
    words[place] = h
    return (words, place) if (words[place] == h).all() else np.unique(h, return_inverse=True)


def asked_counts(trained: np.ndarray, all_of: np.ndarray) -> np.ndarray:
    """Training counts twice, plus 1 where a held-out text has the word or pair too."""
    return 2 * trained + (all_of > trained)


def answered_counts(total: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Training counts plus 1; 1 for those of a single training occurrence that no held-out text asks for, 0 for none."""
    return np.where(total > 0, np.where((total == 1) & ~held, 1, total + 1), 0)


# chunks

_CHUNK = "chunk bigint, tokens bigint, doc_id array<bigint>, held_out array<boolean>, lengths binary, words binary, seen binary, ids binary"


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_CHUNK`` from ``doc_id``, ``held_out``, ``text``."""
    number = TaskContext.get().partitionId() << 32 if TaskContext.get() else 0
    held: list[tuple] = []
    size = 0

    def row() -> pa.RecordBatch:
        ids, out, hashes, lengths = ([x[k] for x in held] for k in range(4))
        lengths = np.concatenate(lengths)
        words, at = distinct_hashes(np.concatenate(hashes))
        out = [v for x in out for v in x]
        seen = np.bincount(at[np.repeat(~np.array(out, bool), lengths)], minlength=len(words))
        seen = asked_counts(seen, np.bincount(at, minlength=len(words)))
        values = [[number], [len(at)], [[v for x in ids for v in x]], [out], [pack(lengths)], [pack(words, rising=True)], [pack(seen)], [pack(at)]]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=["chunk", "tokens", "doc_id", "held_out", "lengths", "words", "seen", "ids"])

    for batch in batches:
        for part in chunks(batch, CHUNK_TOKENS):  # some sixth of a chunk
            words = Words(part.column("text"), fold=ASCII_LOWER)
            hashes = np.insert(words.hash, words.at[1:], END)
            held.append((part.column("doc_id").to_pylist(), part.column("held_out").to_pylist(), hashes, words.count + 1))
            size += len(hashes)
            if size >= CHUNK_TOKENS:
                yield row()
                held, size, number = [], 0, number + 1
    if held:
        yield row()


class Tree:
    """What all tasks know of the model: N, V, the number of groups, a bound of the words' numbers, and per depth the hot contexts that are states, with their k."""

    def __init__(self, groups: int):
        self.groups, self.n, self.v, self.bound = groups, 0, 0, 0
        self.hot: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def is_hot(self, n: np.ndarray) -> np.ndarray:
        return n.astype(float) * 4 * self.groups > self.n


class Questions:
    """The distinct (context, token) pairs of a chunk at one depth, in the order in which they are asked.

    ``context`` and ``token`` are numbers within the chunk, sorted by context; ``s`` names by context, ``sym`` by token.
    ``alone`` counts for each context the tokens that occur once after it and are not asked for; a context may have no others.
    """

    def __init__(self, context: np.ndarray, token: np.ndarray, s: np.ndarray, sym: np.ndarray, hot: np.ndarray, groups: int, alone: np.ndarray):
        bare = np.flatnonzero(np.bincount(context, minlength=len(s)) == 0)
        # a context without pairs has one entry without a token
        context, token = np.append(context, bare), np.append(token, np.full(len(bare), -1))
        order = np.argsort(context, kind="stable") if len(bare) else slice(None)
        context, token = context[order], token[order]
        self.asked = np.flatnonzero(token >= 0)
        group = mix(s[context] + GOLDEN) % np.uint64(groups)
        by_pair = mix(s[context] ^ mix(sym[token])) % np.uint64(groups) + np.uint64(groups)
        group = np.where(hot[context], by_pair, group).astype(np.uint16 if groups < 1 << 15 else np.int64)  # short numbers sort fast
        self.order = np.argsort(group, kind="stable")
        self.context, self.token, self.s, self.sym, self.hot, self.alone = context, token, s, sym, hot, alone
        group = group[self.order]
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
        self.bounds = list(zip(group[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(group)]))

    def runs(self, own: np.ndarray) -> np.ndarray:
        """Where each context starts among the pairs of a group."""
        c = self.context[own]
        return np.flatnonzero(np.append(True, c[1:] != c[:-1])) if len(c) else np.zeros(0, np.int64)

    def rows(self, chunk: int, n: np.ndarray, need: np.ndarray) -> pa.RecordBatch:
        """Questions by group; ``n`` (see ``asked_counts``) and ``need`` are given for the pairs that have a token."""
        out: list[list] = [[] for _ in range(8)]
        pair = np.cumsum(self.token >= 0) - 1
        alone = self.alone.copy()
        for group, a, b in self.bounds:
            own = self.order[a:b]
            starts = self.runs(own)
            contexts = self.context[own[starts]]
            there = self.token[own] >= 0
            runs = np.add.reduceat(there.astype(np.int64), starts)
            own = own[there]
            sym = steps(self.sym[self.token[own]], (np.cumsum(runs) - runs)[runs > 0])
            row = (group, chunk, pack(self.s[contexts], rising=True), pack(runs), pack(alone[contexts]), pack(sym), pack(n[pair[own]]), pack(need[pair[own]]))
            alone[contexts] = 0  # a hot context has entries in several groups and is counted in one
            for column, v in zip(out, row):
                column.append(v)
        types = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=["g", "chunk", "s", "runs", "alone", "sym", "n", "need"])

    def answered(self, answers: dict[int, tuple[bytes, ...]], hot: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Corpus count of every pair, whether it has its one occurrence here, and k of each context (0: no state)."""
        n, kinds = np.zeros(len(self.order), np.int64), np.zeros(len(self.s), np.int64)
        for group, a, b in self.bounds:
            own = self.order[a:b]
            counts, states = answers[group][:2]
            n[own[self.token[own] >= 0]] = unpack(counts)
            kinds[self.context[own[self.runs(own)]]] = unpack(states)
        names, k = hot
        at = np.searchsorted(names, self.s[self.hot])
        kinds[self.hot] = np.append(k, 0)[np.where(np.append(names, 0)[at] == self.s[self.hot], at, len(names))]
        n = n[self.asked]
        return n - (n > 1), n == 1, kinds

    def numbers(self, answers: dict[int, tuple[bytes, ...]]) -> np.ndarray:
        """The numbers of the words asked for at depth 0."""
        out = np.zeros(len(self.order), np.uint64)
        for group, a, b in self.bounds:
            out[self.order[a:b]] = unpack(answers[group][2])
        return out


_QUESTION = "g bigint, chunk bigint, s binary, runs binary, alone binary, sym binary, n binary, need binary"
_ANSWER = "chunk bigint, depth int, g bigint, n binary, states binary, words binary, hot array<struct<s: bigint, k: bigint, passed: boolean>>, total bigint, kinds bigint, names bigint"


def needed(n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Least count k of at least 2 with ``k ln(k / (n p)) >= RETAIN``; 0 if no count up to n will do."""
    mean = n * p
    x = np.maximum(mean * np.e, RETAIN) + 1
    for _ in range(10):  # Newton from above on a convex function
        x = np.maximum(x - (x * np.log(x / mean) - RETAIN) / (np.log(x / mean) + 1), mean * (1 + 1e-12))
    k = np.maximum(np.ceil(x - 1e-9), 2)
    return np.where(k <= n, k, 0).astype(np.int64)


def answers_of(depth: int, groups: int):
    """Function for one group: sums over all chunks, the divergence test, answers in the order of the questions."""

    def fn(table: pa.Table) -> pa.Table:
        group = table.column("g")[0].as_py()
        s, runs, alone, sym, n, need = ([unpack(v) for v in table.column(c).to_pylist()] for c in ("s", "runs", "alone", "sym", "n", "need"))
        sizes, contexts = np.array([len(x) for x in sym]), np.array([len(x) for x in s])
        joined = lambda v, kind: np.concatenate([x.astype(kind) for x in v])
        s, runs, sym = joined(s, np.uint64), joined(runs, np.int64), joined(sym, np.uint64)
        sym = summed(sym, (np.cumsum(runs) - runs)[runs > 0])
        names, which = distinct_hashes(s)
        owner = np.repeat(which, runs)
        pair, at = distinct_hashes(mix(np.repeat(s, runs) + mix(sym + GOLDEN)))
        n = joined(n, np.int64)
        total = np.bincount(at, n >> 1, minlength=len(pair)).astype(np.int64)
        held = np.bincount(at, n & 1, minlength=len(pair)) > 0
        need = joined(need, np.int64)
        state = np.zeros(len(names), bool)
        state[owner[(need > 0) & (total[at] >= need)]] = True
        # different tokens of each context: pairs with a training count, and those that a chunk has alone
        of_pair = np.zeros(len(pair), np.int64)
        of_pair[at] = owner
        kinds = (np.bincount(of_pair[total > 0], minlength=len(names)) + np.bincount(which, joined(alone, np.int64), minlength=len(names))).astype(np.int64)
        hot = group >= groups
        states = np.zeros(len(s), np.int64) if hot else np.where(state, kinds, 0)[which]
        ends, c_ends = np.cumsum(sizes), np.cumsum(contexts)
        first = [1] + [0] * (len(sizes) - 1)  # what is said once for the whole group
        own = [{"s": int(x), "k": int(k), "passed": bool(f)} for x, k, f in zip(names.view(np.int64), kinds, state)] if hot else []
        words, counts, several = [None] * len(first), answered_counts(total, held), 0
        if depth == 0:  # frequent words get small numbers; those that no deeper round asks for need none
            several = int((counts > 1).sum())
            number = np.zeros(len(pair), np.int64)
            number[np.argsort(np.where(counts > 1, -total, 1), kind="stable")[:several]] = np.arange(several) * groups + group - groups
            words = [pack(x) for x in np.split(number[at], ends[:-1])]
        counts = counts[at]
        return pa.table({
            "chunk": table.column("chunk"), "depth": pa.array([depth] * len(first), pa.int32()), "g": table.column("g"),
            "n": pa.array([pack(x) for x in np.split(counts, ends[:-1])], pa.binary()),
            "states": pa.array([pack(x) for x in np.split(states, c_ends[:-1])], pa.binary()),
            "words": pa.array(words, pa.binary()),
            "hot": pa.array([own if f else [] for f in first], pa.list_(pa.struct([("s", pa.int64()), ("k", pa.int64()), ("passed", pa.bool_())]))),
            "total": pa.array([int(total.sum()) * f for f in first], pa.int64()), "kinds": pa.array([int((total > 0).sum()) * f for f in first], pa.int64()),
            "names": pa.array([several] * len(first), pa.int64())})

    return fn


def word_questions(sym: np.ndarray, groups: int) -> Questions:
    """The questions at depth 0, one for each word of a chunk."""
    none = np.zeros(1, np.int64)
    return Questions(np.zeros(len(sym), np.int64), np.arange(len(sym)), np.zeros(1, np.uint64), sym, np.ones(1, bool), groups, none)


def named(s: np.ndarray, number: np.ndarray, depth: int, bound: int) -> np.ndarray:
    """Names of contexts from those without the first word and its number: the numbers put together if they fit, else a hash."""
    if bound**depth < 1 << 63:
        return s * np.uint64(bound) + number
    return mix(s + mix(number + np.array([depth], np.uint64) * GOLDEN))


def walk(row: dict, answers: dict[int, dict[int, tuple[bytes, ...]]], tree: Tree, depth: int | None) -> pa.RecordBatch:
    """A chunk's questions at ``depth`` (all shallower ones answered), or its scores if that is None."""
    ids, lengths, sym = unpack(row["ids"]).astype(np.int32), unpack(row["lengths"]).astype(np.int64), unpack(row["words"])
    ends = np.cumsum(lengths)
    place = (np.arange(len(ids)) - np.repeat(ends - lengths, lengths)).astype(np.int32)  # within the text
    trained = np.repeat(~np.array(row["held_out"], bool), lengths)
    size = len(sym)

    words = word_questions(sym, tree.groups)
    count, single, _ = words.answered(answers[0], (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    number = words.numbers(answers[0])
    # from here on the chunk's words are in the order of their numbers, so that names of contexts and tokens rise
    order = np.argsort(number, kind="stable")
    rank = np.empty(size, np.int32)
    rank[order] = np.arange(size, dtype=np.int32)
    ids, number, count, single = rank[ids], number[order], count[order], single[order]
    root = (count + 1) / (tree.n + tree.v + 1)
    p, last, alone = root[ids], count[ids], single[ids]
    pos, context = np.arange(len(ids), dtype=np.int32), np.zeros(len(ids), np.int32)
    s, deepest, width = np.zeros(1, np.uint64), DEPTH if depth is None else depth, max(1, size.bit_length())
    mask = (1 << width) - 1
    for d in range(1, deepest + 1):
        n = np.where(place[pos] >= d, last[np.maximum(pos - 1, 0)], -1)
        tried = n >= MIN_COUNT
        pos, context, n = pos[tried], context[tried], n[tried]
        name, context = distinct(context.astype(np.int64) << width | ids[pos - d], len(s).bit_length() + width)
        s = named(s[name >> width], number[name & mask], d, tree.bound)
        if (s[1:] < s[:-1]).any():  # hashes
            order = np.argsort(s, kind="stable")
            rank = np.empty(len(s), np.int32)
            rank[order] = np.arange(len(s), dtype=np.int32)
            s, context = s[order], rank[context]
        n_of = np.zeros(len(name), np.int64)
        n_of[context] = n
        hot = tree.is_hot(n_of)
        # the one training occurrence of a token after a shorter context is the one after this context; where there is none, none
        known = alone[pos]
        unasked = np.bincount(context[known], minlength=len(name))
        shorter = last[pos]
        ask = np.flatnonzero(~known & (shorter > 0))
        pair, at = distinct(context[ask].astype(np.int64) << width | ids[pos[ask]], len(name).bit_length() + width)
        of, token = pair >> width, pair & mask
        asked = Questions(of, token, s, number, hot, tree.groups, unasked)
        if d == depth:
            before = np.zeros(len(pair))
            before[at] = p[pos[ask]]
            all_of, seen = (np.bincount(v, minlength=len(pair)) for v in (at, at[trained[pos[ask]]]))
            return asked.rows(row["chunk"], asked_counts(seen, all_of), needed(n_of[of], before))
        total, single, kinds = asked.answered(answers.get(d, {}), tree.hot[d])
        found = np.minimum(shorter, 1)
        found[ask] = total[at]
        alone[pos[ask]] = single[at]
        last.fill(-1)
        last[pos] = found
        kept = kinds[context] > 0
        pos, context, found = pos[kept], context[kept], found[kept]
        k = kinds[context]
        p[pos] = (found + k * p[pos]) / (n_of[context] + k)
    start = ends - lengths
    sums = lambda v: np.add.reduceat(v, start)
    return pa.RecordBatch.from_arrays(
        [pa.array(row["doc_id"], pa.int64()), pa.array(row["held_out"], pa.bool_()), pa.array(lengths), pa.array(sums((count > 0)[ids].astype(np.int64))),
         pa.array(np.full(len(lengths), tree.n, np.int64)), pa.array(sums(np.log10(root)[ids])), pa.array(sums(np.log10(p)))],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


_SCORE = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _bucketed(df: DataFrame, buckets: int, what: str) -> str:
    """Write rows in buckets by chunk; returns the name of the table, whose files lie in the shared folder."""
    name = f"suffix_tree_{what}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "chunk").option("path", work_path(df.sparkSession, what)).saveAsTable(name)
    return name


def _walked(spark: SparkSession, chunk_table: str, answers: list[str], tree: Tree, depth: int | None) -> DataFrame:
    """``walk`` over all chunks next to their answers; all lie in the same buckets, so that nothing is moved."""
    joined = spark.table(chunk_table).drop("seen")
    for d, name in enumerate(answers):
        own = spark.table(name).groupBy("chunk").agg(F.collect_list(F.struct("g", "n", "states", *["words"] * (d == 0))).alias(f"answers_{d}"))
        joined = joined.join(own.hint("merge"), "chunk", "left")

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(len(batch))):
                got = {d: {a["g"]: (a["n"], a["states"], a["words"] if d == 0 else None) for a in row[f"answers_{d}"] or ()} for d in range(len(answers))}
                yield walk(row, got, tree, depth)

    return joined.mapInArrow(fn, _SCORE if depth is None else _QUESTION)


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, token counts, base score and score of every row."""
    spark = docs.sparkSession
    rows = texts(docs).select("doc_id", not_trained("doc_id").alias("held_out"), "text")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = _bucketed(rows.mapInArrow(_chunk_rows, _CHUNK), buckets, "chunks")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Questions at depth 0: the words."""
        for batch in batches:
            for row in batch.to_pylist():
                sym, seen = unpack(row["words"]), unpack(row["seen"])
                yield word_questions(sym, tree.groups).rows(row["chunk"], seen, np.zeros(len(sym), np.int64))

    tokens = spark.table(table).agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    tree = Tree(max(1, -(-tokens // GROUP_TOKENS)))
    answers: list[str] = []
    for depth in range(DEPTH + 1):
        asked = _walked(spark, table, answers, tree, depth) if depth else spark.table(table).select("chunk", "words", "seen").mapInArrow(first, _QUESTION)
        answers.append(_bucketed(asked.groupBy("g").applyInArrow(answers_of(depth, tree.groups), _ANSWER).repartition(buckets, "chunk"), buckets, "answers"))
        got = spark.table(answers[-1])
        if depth == 0:
            tree.n, tree.v, most = got.agg(*[F.coalesce(f, F.lit(0)) for f in (F.sum("total"), F.sum("kinds"), F.max("names"))]).first()
            tree.bound = most * tree.groups
        if depth:
            hot = got.select(F.explode("hot").alias("h")).groupBy("h.s").agg(F.sum("h.k").alias("k"), F.max("h.passed").alias("passed")).where("passed").collect()
            hot = sorted((r["s"] % (1 << 64), r["k"]) for r in hot)
            tree.hot[depth] = (np.array([x for x, _ in hot], np.uint64), np.array([k for _, k in hot], np.int64))
    out = stored(_walked(spark, table, answers, tree, None), "scores")
    for name in (table, *answers):
        spark.sql(f"DROP TABLE {name}")
    return out
