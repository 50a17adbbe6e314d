"""Whole results of the pair operators, of templates and of the pipeline against plain Python."""

import collections
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import bagminhash, compact_windows
from tallyframe.llm.textvec import Words

ODD = [(None, None), (None, "x"), (1, None), (2, ""), (3, " \n\t"), (4, "word"), (4, "word"), (9, "z" * 20000), (10, "so " * 20_000), (11, "so " * 19_999)]


def components(ids, links):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {i: top(i) for i in ids}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1 if w else 0)))


def edited(text, rng, share):
    """The text with a share of its words changed."""
    return " ".join(w if rng.random() > share else f"w{rng.integers(10**9)}" for w in text.split())


def families(prose, seed):
    """Families of near copies, chains of edits, texts around the threshold and short ones."""
    rng = np.random.default_rng(seed)
    rows = []
    for f in range(6):
        base = prose(120, 1000 * seed + f)
        rows += [(100 * f + 20 + k, edited(base, rng, (0.0, 0.01, 0.02, 0.03, 0.05)[k % 5])) for k in range(15)]
    chain = prose(150, 77 + seed)
    for k in range(8):
        rows.append((900 + k, chain))
        chain = edited(chain, rng, 0.012)
    rows += [(950 + k, "a b c d e f " * (k + 1)) for k in range(12)] + [(970 + k, prose(3, 5)) for k in range(3)]
    return rows


@pytest.mark.parametrize("seed, cell, many", [(1, 4 << 20, 16), (2, 2000, 16), (1, 2000, 1)])
def test_bagminhash_classes_equal_all_pairs(documents, prose, monkeypatch, seed, cell, many):
    """Groups in one cell, in several blocks, and too large for blocks."""
    monkeypatch.setattr(bagminhash, "CELL_BYTES", cell)
    monkeypatch.setattr(bagminhash, "MANY_BLOCKS", many)
    rows = ODD + families(prose, seed)
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(documents(rows, extra=True).repartition(3)).collect()}
    bags = [(i, shingles(t)) for i, t in rows if i is not None]
    links = []
    for k, (i, x) in enumerate(bags):
        for j, y in bags[:k]:
            if x and y and 5 * sum((x & y).values()) >= 4 * sum((x | y).values()):
                links.append((i, j))
    assert got == components({i for i, _ in bags}, links)
    assert len(set(got.values())) < len(got) - 30


@pytest.mark.parametrize("many", [16, 0])
def test_unlike_members_of_a_bucket_make_no_pairs(documents, prose, monkeypatch, many):
    """300 texts in one bucket, none similar to another: hardly a pair is looked at but those with the first."""
    monkeypatch.setattr(bagminhash, "MANY_BLOCKS", many)
    base = prose(100, 3)
    rng = np.random.default_rng(0)
    docs = documents([(k, edited(base, rng, 0.06)) for k in range(300)])
    seen = []
    real, rest = bagminhash._agreeing, bagminhash._rest
    monkeypatch.setattr(bagminhash, "_agreeing", lambda pairs, *a: seen.append(pairs.count()) or real(pairs, *a))
    monkeypatch.setattr(bagminhash, "_rest", lambda *a: kept(rest(*a), seen))
    bagminhash.classes(docs).count()
    assert sum(seen) < 2000


def test_signatures_of_a_chunk_stay_small(prose):
    words = Words(pa.array([prose(150, k) for k in range(bagminhash.SIGNED_BYTES // 880)]))
    tracemalloc.start()
    buckets, _, some = bagminhash.bands_of(words)
    assert tracemalloc.get_traced_memory()[1] < 80e6 and some.all() and buckets.shape[1] == bagminhash.BANDS
    tracemalloc.stop()


def kept(df, counts):
    counts.append(df.count())
    return df


def similar_texts(x, y):
    """Whether two lists of tokens have similar passages, by the exact check on whole texts."""
    return bool(compact_windows.segments(x, y))


@pytest.mark.parametrize("cell", [2048, 5])
def test_passage_classes_equal_all_pairs(documents, prose, monkeypatch, cell):
    """Passages shared exactly and with edits between own words, beside a line that all have; also with keys split by rare tokens."""
    monkeypatch.setattr(compact_windows, "BLOCK", cell)
    rng = np.random.default_rng(4)
    line = prose(60, 500)
    shared = [prose(70, 600 + k) for k in range(5)]
    rows = [r for r in ODD if r[0] != 10]
    for k in range(60):
        middle = edited(shared[k % 5], rng, (0, 0, 0.01)[k % 3]) if k % 2 else ""
        rows.append((100 + k, " ".join([prose(40, 2000 + k), edited(line, rng, 0.06) if k % 4 else line, prose(20, 3000 + k), middle, prose(30, 4000 + k)])))
    got = {r["doc_id"]: r["class_id"] for r in compact_windows.passages(documents(rows, extra=True).repartition(3)).collect() if r["doc_id"] is not None}
    texts = [(i, Words(pa.array([t or ""])).shingles()[0]) for i, t in rows if i is not None]
    links = [(i, j) for k, (i, x) in enumerate(texts) for j, y in texts[:k] if similar_texts(x, y) or similar_texts(y, x)]
    want = components({i for i, _ in texts}, links)
    same = lambda c: {(a, b) for a in c for b in c if a < b and c[a] == c[b]}
    assert same(got) <= same(want)
    assert len(same(got)) >= 0.99 * len(same(want)) and len(same(want)) > 100


def test_overlaps_of_repetitive_texts_by_definition(monkeypatch):
    texts = ["so " * 400, "one two three four " * 100, " ".join(f"w{k % 37}" for k in range(300))]
    for text in texts:
        per = [(v, np.full(len(c), k), l, c, r) for k, v, _, l, c, r in compact_windows.windows_of(Words(pa.array([text])))]
        value, k, l, c, r = (np.concatenate(x) for x in zip(*per))
        plain = collections.Counter()
        for i in range(len(c)):
            for j in range(len(c)):
                lo, hi = max(l[i], l[j]), min(r[i], r[j])
                if k[i] < k[j] and l[i] <= c[j] <= r[i] and l[j] <= c[i] <= r[j] and hi - lo + 1 >= compact_windows.MIN_TOKENS:
                    plain[int(c[i]), int(lo), int(hi)] += 1
        for listed in (64, 0):
            monkeypatch.setattr(compact_windows, "LISTED", listed)
            _, at, lo, hi = compact_windows.overlaps(value, k, l, c, r)
            assert collections.Counter(zip(at.tolist(), lo.tolist(), hi.tolist())) == plain


def test_a_long_text_of_one_word_stays_small():
    per = [(v, np.full(len(c), k), l, c, r) for k, v, _, l, c, r in compact_windows.windows_of(Words(pa.array(["so " * 20_000])))]
    arrays = [np.concatenate(x) for x in zip(*per)]
    tracemalloc.start()
    key, *_ = compact_windows.overlaps(*arrays)
    assert tracemalloc.get_traced_memory()[1] < 200e6 and len(key) < 400_000
    tracemalloc.stop()


def test_windows_of_a_large_batch_are_found_in_small_chunks():
    class Rows:
        def mapInArrow(self, fn, schema):
            return fn

    text = " ".join(f"w{k}" for k in range(1000))
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array([f"{k} {text}" for k in range(400)])], names=["n", "text"])
    for fn in (compact_windows._value_names(Rows()), compact_windows._windows(Rows(), np.full(1 << 20, np.uint64(2**64 - 1)))):
        tracemalloc.start()
        assert sum(len(b) for b in fn(iter([batch]))) > 400
        assert tracemalloc.get_traced_memory()[1] < 30e6
        tracemalloc.stop()
