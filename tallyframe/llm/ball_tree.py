"""Exact ranked lexical search by a ball tree over sparse integer vectors.

A document is a vector over terms, ``(10^9 tf) div (1000 tf + 8 m)`` at each of its terms, where ``m``
grows with its length; an item is a vector of term weights times repeats; the score is their inner
product, an integer.

*Preparing.* Items are dealt into blocks of about ``ITEM_BYTES`` of text, so what travels to the tasks
is bounded whatever the number of items. For a block, every text is read whole once and kept as its
length and its terms that some item of the block uses (other terms add nothing to any score of the
block). The corpus' counts (documents, terms, document frequencies) are sums over all documents.

*Trees.* Each task makes slices of its documents of at most ``SLICE_TERMS`` kept terms and
``SLICE_DOCS`` documents. In a slice, the documents are split in two by their nearer of two distant
documents, again and again, down to leaves of at most ``LEAF``. A node is a ball: a centroid c, and a
radius R around it in each group g of terms (one radius over all terms is too wide to prune anything
in thousands of dimensions). The inner product of an item q with any document below a node is at
most ``q c + sum_g |q_g| R_g``. Centroids, radii and bounds are doubles; weights are non-negative, and
every quantity is rounded up by a relative 1e-9, far more than its summation can be off, so a bound
is never below a true score.

*Search.* An item goes through a tree best first: the open node with the highest bound comes
next, its children are opened, a leaf's documents get their exact integer scores. It ends when the
highest bound is below the item's tenth best score so far (a bound equal to it goes on, as ties are
settled by ``doc_id``). Best scores go on from slice to slice of a task. Tasks return at most
``top`` rows per item; these are cut twice by rank, first within ``SALTS`` shares of the documents, so
that no single task receives every task's rows of an item.

Defined cases: a null text has no terms and is never found; items without terms, or whose terms occur
nowhere, return no row; items with the same ``item_id`` are one item, with the greatest of their
texts, a null id included; documents with the same ``doc_id`` are ranked each by itself; a null
``doc_id`` comes after all others among equal scores; an empty table gives an empty result; other
columns are ignored. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyframe.llm.features import map_texts
from tallyframe.llm.rows import stored, texts
from tallyframe.llm.textvec import ASCII_LOWER, Words, multiset

TOP = 10
ITEM_BYTES = 4 << 20
SLICE_TERMS = 1 << 20
SLICE_DOCS = 1 << 14
LEAF = 48
BANDS = 64  # groups of terms per subtree near the root
BALL_ROWS = 4096  # documents of the widest node with a ball
SALTS = 64
SLACK = 1 + 1e-9
#: Bytes that separate terms: all of ASCII but digits and letters.
BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def terms_of(column: pa.Array) -> Words:
    return Words(column, fold=ASCII_LOWER, breaks=BREAKS)


# items


def item_blocks(items: DataFrame) -> list[DataFrame]:
    """Items (``item_id``, ``text``), one row per id, in blocks of bounded text."""
    one = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").groupBy("item_id").agg(F.max("text").alias("text"))
    one = stored(one.where("text is not null"), "search-items")
    size = one.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / ITEM_BYTES))
    return [one.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k) for k in range(n)]


class Queries:
    """The items of a block as sparse rows over the block's own vocabulary of term hashes."""

    def __init__(self, block: DataFrame):
        rows = block.orderBy(F.col("item_id").asc_nulls_last()).toArrow()
        self.ids = rows.column("item_id").to_pylist()
        words = terms_of(rows.column("text"))
        h, row, times = multiset(words.hash, words.row)
        self.vocabulary = np.unique(h)
        self.term, self.times = np.searchsorted(self.vocabulary, h), times.astype(np.int64)
        self.at = np.append(0, np.cumsum(np.bincount(row, minlength=len(self.ids))))

    def weighted(self, weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and integer weights of every item."""
        return [(self.term[s:e], self.times[s:e] * weight[self.term[s:e]]) for s, e in zip(self.at[:-1], self.at[1:])]


# documents


def kept_terms(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id``, ``n`` (all terms with repeats), and the terms in ``vocabulary`` (numbers) with their counts ``tf``."""

    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        words = terms_of(part.column("text"))
        place = np.searchsorted(vocabulary, words.hash)
        known = vocabulary[np.minimum(place, len(vocabulary) - 1)] == words.hash if len(vocabulary) else np.zeros(len(words.hash), bool)
        number, row, tf = multiset(place[known].astype(np.uint64), words.row[known])
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=words.rows))).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (number, tf)]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words.count), *lists], names=["doc_id", "n", "terms", "tf"])

    return map_texts(texts(docs), fn, "doc_id bigint, n bigint, terms array<int>, tf array<int>")


def document_frequency(kept: DataFrame, size: int) -> np.ndarray:
    """Documents per vocabulary number."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for term, df in kept.select("terms").mapInArrow(fn, "term bigint, df bigint").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


def term_weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def term_values(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The vector components of documents; ``n`` is the length of the document of each term."""
    m = 25 + 75 * n * documents // total
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


# tree


class Tree:
    """Ball tree over sparse rows: row k holds ``term[at[k]:at[k + 1]]`` with ``value``; ``weight`` ranks the terms."""

    def __init__(self, term: np.ndarray, value: np.ndarray, at: np.ndarray, weight: np.ndarray, leaf: int = LEAF):
        self.term, self.value, self.at = term, value, at
        self.first = [-1]  # the first of two children, -1 for a leaf
        self.rows = [np.arange(len(at) - 1)]
        self.item = np.zeros(len(weight), np.int64)
        self._split(leaf)
        self._balls(weight)

    def _entries(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the entries of some rows, how many each row has, and where it starts among them."""
        n = self.at[of + 1] - self.at[of]
        start = np.cumsum(n) - n
        return np.arange(n.sum()) - np.repeat(start, n) + np.repeat(self.at[of], n), n, start

    def _split(self, leaf: int) -> None:
        """Halve nodes by the nearer of two distant rows."""
        square = np.add.reduceat(self.value.astype(float) ** 2, self.at[:-1])
        dense = np.zeros(len(self.item))
        todo = [0]
        while todo:
            node = todo.pop()
            of = self.rows[node]
            if len(of) <= leaf:
                continue
            place, _, start = self._entries(of)

            def far(k: int) -> np.ndarray:
                own = slice(self.at[of[k]], self.at[of[k] + 1])
                dense[self.term[own]] = self.value[own]
                inner = np.add.reduceat(dense[self.term[place]] * self.value[place], start)
                dense[self.term[own]] = 0
                return square[of] + square[of[k]] - 2 * inner

            one = far(int(far(0).argmax()))
            left = one <= far(int(one.argmax()))
            if left.all() or not left.any():  # equal documents: any halves will do
                left = np.arange(len(of)) < len(of) // 2
            self.first[node] = len(self.first)
            todo += [len(self.first), len(self.first) + 1]
            self.first += [-1, -1]
            self.rows += [of[left], of[~left]]

    def _centroid(self, of: np.ndarray) -> tuple[np.ndarray, ...]:
        """Terms and values of the mean of some rows; terms, values and row of their entries."""
        place, n, _ = self._entries(of)
        t, inverse = np.unique(self.term[place], return_inverse=True)
        c = np.bincount(inverse, self.value[place].astype(float)) / len(of)
        return t, c, inverse, self.value[place].astype(float), np.repeat(np.arange(len(of)), n)

    def _balls(self, weight: np.ndarray) -> None:
        """Centroids, and a radius for each group of terms.

        A term's group is the subtree near the root where it is most frequent, and one of ``BANDS``
        by its rank of weight.
        """
        upper = [0]
        for _ in range(3):
            upper = [c for n in upper for c in ((self.first[n], self.first[n] + 1) if self.first[n] >= 0 else (n,))]
        most, home = np.zeros(len(weight)), np.zeros(len(weight), np.int64)
        for k, node in enumerate(upper):
            t, c, *_ = self._centroid(self.rows[node])
            more = c > most[t]
            home[t[more]], most[t[more]] = k, c[more]
        self.group = home * BANDS + np.argsort(np.argsort(weight, kind="stable"), kind="stable") % BANDS
        groups = len(upper) * BANDS
        self.radius = np.zeros((len(self.rows), groups))
        self.open = np.zeros(len(self.rows), bool)
        parts = []
        for node, of in enumerate(self.rows):
            t, c, inverse, x, row = self._centroid(of)
            parts.append((t, c))
            if len(of) > BALL_ROWS:  # too wide to prune: opened in any case
                self.open[node] = True
                continue
            # |x - c|^2 by group; sums of differences are rounded up by what their parts may be off
            own = np.bincount(self.group[t], c * c, minlength=groups) * SLACK
            off = (x - c[inverse]) ** 2 - c[inverse] ** 2 + 1e-9 * (x * x + c[inverse] ** 2)
            off = np.bincount(row * groups + self.group[t][inverse], off, minlength=len(of) * groups).reshape(len(of), groups)
            self.radius[node] = np.sqrt(np.maximum(off.max(0) + own, 0)) * SLACK
        # centroids by term, so that an item reads only the lists of its own terms
        nodes = np.repeat(np.arange(len(parts)), [len(t) for t, _ in parts])
        terms, values = (np.concatenate(v) for v in zip(*parts))
        order = np.argsort(terms, kind="stable")
        self.node, self.centroid = nodes[order], values[order]
        self.list_at = np.searchsorted(terms[order], np.arange(len(weight) + 1))

    def bounds(self, t: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What no document below each node can exceed."""
        n = self.list_at[t + 1] - self.list_at[t]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.list_at[t], n)
        inner = np.bincount(self.node[place], self.centroid[place] * np.repeat(w, n).astype(float), minlength=len(self.rows))
        length = np.sqrt(np.bincount(self.group[t], w.astype(float) ** 2, minlength=self.radius.shape[1])) * SLACK
        some = np.flatnonzero(length)
        high = (inner * SLACK + self.radius[:, some] @ length[some] * SLACK) * SLACK + 1
        high[self.open] = np.inf
        return high

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Exact scores of some rows for the item whose weights are set."""
        place, _, start = self._entries(rows)
        return np.add.reduceat(self.item[self.term[place]] * self.value[place], start)

    def search(self, t: np.ndarray, w: np.ndarray, best: list[tuple[int, float, int]], ids: np.ndarray, top: int) -> int:
        """Put the rows that belong there into ``best``, a heap of (score, -id, id) of at most ``top``; returns the number of rows scored."""
        high = self.bounds(t, w)
        self.item[t] = w
        todo, seen = [(-high[0], 0)], 0
        while todo and (len(best) < top or -todo[0][0] >= best[0][0]):
            bound, node = heapq.heappop(todo)
            child = self.first[node]
            if child >= 0:
                for c in (child, child + 1):
                    heapq.heappush(todo, (max(bound, -high[c]), c))
                continue
            rows = self.rows[node]
            got = self.scores(rows)
            seen += len(rows)
            good = got >= max(best[0][0] if len(best) == top else 1, 1)
            for s, i in zip(got[good].tolist(), ids[rows[good]].tolist()):
                entry = (s, -i, i)
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        self.item[t] = 0
        return seen


def slices(batches: Iterator[pa.RecordBatch], most_terms: int = SLICE_TERMS, most_docs: int = SLICE_DOCS) -> Iterator[tuple[np.ndarray, ...]]:
    """``doc_id`` (null: the largest number), ``n``, terms, counts and places of rows, in pieces of bounded size."""
    held: list[tuple[np.ndarray, ...]] = []
    size = docs = 0

    def joined() -> tuple[np.ndarray, ...]:
        ids, n, term, tf, count = (np.concatenate(v) for v in zip(*held))
        return ids, n, term, tf, np.append(0, np.cumsum(count))

    for batch in batches:
        lists = batch.column("terms")
        length = lists.value_lengths().to_numpy().astype(np.int64)
        ends, start = np.cumsum(length), 0
        flat = [batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "tf")]
        ids = batch.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
        n = batch.column("n").to_numpy()
        while start < len(length):
            base = ends[start - 1] if start else 0
            stop = min(int(np.searchsorted(ends, base + most_terms - size, side="right")), start + most_docs - docs)
            stop = max(stop, start + 1) if not held else stop
            if stop > start:
                span = slice(base, ends[stop - 1])
                held.append((ids[start:stop], n[start:stop], flat[0][span], flat[1][span], length[start:stop]))
                size, docs, start = size + ends[stop - 1] - base, docs + stop - start, stop
            if start < len(length):
                yield joined()
                held, size, docs = [], 0, 0
    if held:
        yield joined()


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the best documents of every item."""
    out = None
    for block in item_blocks(items):
        found = _searched(docs, Queries(block), top)
        out = found if out is None else out.unionByName(found)
    return out


def _searched(docs: DataFrame, queries: Queries, top: int) -> DataFrame:
    size = len(queries.vocabulary)
    kept = stored(kept_terms(docs, queries.vocabulary), "search-terms")
    documents, total = kept.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = term_weights(document_frequency(kept, size), documents)
    weighted = queries.weighted(weight)
    weighted = [(t[w > 0], w[w > 0]) for t, w in weighted]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, float, int]]] = [[] for _ in weighted]
        for ids, n, term, tf, at in slices(batches):
            tree = Tree(term, term_values(tf, np.repeat(n, np.diff(at)), documents, total), at, weight)
            for (t, w), heap in zip(weighted, best):
                if len(t):
                    tree.search(t, w, heap, ids, top)
        rows = [(k, i, s) for k, heap in enumerate(best) for s, _, i in heap]
        item, ids, score = zip(*rows) if rows else ((), (), ())
        ids = [None if i == np.iinfo(np.int64).max else i for i in ids]
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, pa.int64()), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    found = kept.where("size(terms) > 0").mapInArrow(fn, "item int, doc_id bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    # one row per item of the block
    names = docs.sparkSession.createDataFrame(list(enumerate(queries.ids)), "item int, item_id bigint")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


#: Fixed value: the term pattern.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format('text')}, '{_TERM}') AS w FROM documents WHERE text IS NOT NULL),
    d AS (SELECT r, doc_id, w, len(w)::BIGINT AS n FROM t WHERE len(w) > 0),
    c AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS l FROM d),
    o AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
    i AS (SELECT item_id, max(text) AS text FROM benchmark WHERE text IS NOT NULL GROUP BY item_id),
    q AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER.format('text')}, '{_TERM}')) AS term FROM i) GROUP BY item_id, term),
    f AS (SELECT term, count(*)::BIGINT AS df FROM o WHERE term IN (SELECT term FROM q) GROUP BY term),
    w AS (SELECT f.term, floor(1000 * ln((2 * c.big_n + 2)::DOUBLE / (2 * f.df + 1)::DOUBLE))::BIGINT AS w FROM f, c),
    s AS (SELECT q.item_id, d.r, any_value(d.doc_id) AS doc_id,
        sum(q.times * w.w * ((1000000000 * o.tf) // (1000 * o.tf + 8 * (25 + (75 * d.n * c.big_n) // c.l))))::BIGINT AS score
        FROM q JOIN w ON w.term = q.term JOIN o ON o.term = q.term JOIN d ON d.r = o.r, c GROUP BY q.item_id, d.r),
    k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= {TOP}"""
