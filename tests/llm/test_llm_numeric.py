"""Signatures, windows, kernels and fits against brute force, without Spark."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import bagminhash, compact_windows, pairwise_rank, quality_rules, suffix, toxicity
from tallyframe.llm.textvec import GOLDEN, Words, chunks, mix, multiset, unit

TEXTS = ["the cat sat on the mat and the cat sat on it", "", None, "one", "  \n\t ", "é à ü ß  Wörter\x0bhier", "a b c d e f", "A B C D E F"]


def test_words_split_like_the_contract():
    words = Words(pa.array(TEXTS), lower=False)
    assert words.count.tolist() == [12, 0, 0, 1, 0, 6, 6, 6]
    raw = words.data.tobytes()
    assert [raw[a:b].decode() for a, b, r in zip(words.begin, words.end, words.row) if r == 5] == ["é", "à", "ü", "ß", "Wörter", "hier"]
    low = Words(pa.array(TEXTS))
    assert low.hash[low.row == 6].tolist() == low.hash[low.row == 7].tolist()


def test_shingles_and_chunks():
    h, row, _ = Words(pa.array(TEXTS)).shingles(5)
    assert np.bincount(row, minlength=8).tolist() == [8, 0, 0, 1, 0, 2, 2, 2]
    _, _, n = multiset(*Words(pa.array(["a b c d e f a b c d e f a b c d e"])).shingles(5)[:2])
    assert sorted(n.tolist()) == [2, 2, 2, 2, 2, 3]
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS)], names=["text"])
    assert sum(len(c) for c in chunks(batch, 10)) == len(TEXTS)
    assert list(chunks(batch.slice(0, 0))) == []


@pytest.mark.parametrize("a, b", [({1: 1, 2: 1, 3: 1}, {2: 1, 3: 1, 4: 1}), ({1: 5, 2: 1}, {1: 3, 3: 2}), ({7: 40, 8: 2}, {7: 33, 9: 5}), ({5: 1}, {5: 9})])
def test_signature_agreement_is_the_weighted_jaccard(a, b):
    keys = lambda d: np.array(list(d), np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    size = 6000
    sig = bagminhash.signatures(np.concatenate([keys(a), keys(b)]), np.array([0] * len(a) + [1] * len(b)), np.array([*a.values(), *b.values()]), 3, size)
    true = sum(min(a.get(k, 0), b.get(k, 0)) for k in {*a, *b}) / sum(max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b})
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * (true * (1 - true) / size) ** 0.5 + 1e-9
    assert (sig[2] == 0).all()


def earliest_points(h, weight, size):
    """The signature of one weighted set by its definition, point by point."""
    best, turn = {}, 0
    blocks = [(k, b) for k, w in zip(h, weight) for b in range(max(int(w) - 1, 0).bit_length() + 1)]
    low = np.array([2.0 ** (b - 1) if b else 0.0 for _, b in blocks])
    rate, limit = np.maximum(low, 1), np.array([dict(zip(h.tolist(), weight))[int(k)] for k, _ in blocks])
    x, seed = np.zeros(len(blocks)), np.array([mix(k[None] ^ mix(np.array([b + 1], np.uint64) * GOLDEN))[0] for k, b in blocks])
    while len(best) < size or (x < max(t for t, _ in best.values())).any():
        turn += 1
        z = mix(seed + np.array([turn], np.uint64) * GOLDEN)
        x = x - np.log(unit(z)) / (rate * size)
        z2 = mix(z + GOLDEN)
        component = (z2 >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)
        inside = low + (z2 & np.uint64(0xFFFFFFFF)).astype(float) * 2.0**-32 * rate < limit
        for c, t, v in zip(component[inside].tolist(), x[inside].tolist(), z[inside].tolist()):
            best[c] = min(best.get(c, (np.inf, 0)), (t, v))
    return [best[c][1] for c in range(size)]


def test_signatures_hold_the_earliest_points_and_short_texts_take_few_steps(monkeypatch):
    """A set of one element draws some 3,000 points; they are drawn many at a time."""
    steps = []
    monkeypatch.setattr(bagminhash, "unit", lambda z: steps.append(z.size) or unit(z))
    sets = [[1], [5], [1, 1, 1, 2], [3] * 40, [1] * 300]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    h = mix(np.arange(len(row), dtype=np.uint64) + GOLDEN)
    sig = bagminhash.signatures(h, row, np.concatenate(sets), len(sets), 384)
    for k, weight in enumerate(sets):
        assert sig[k].tolist() == earliest_points(h[row == k], weight, 384)
    assert len(steps) < 200 and sum(steps) < 100_000


def test_weighted_jaccard():
    assert bagminhash.weighted_jaccard(np.array([1, 1, 2]), np.array([1, 2, 2])) == pytest.approx(0.5)
    assert bagminhash.weighted_jaccard(np.array([], int), np.array([], int)) == 0


def windows_by_definition(value, least):
    out = set()
    n = len(value)
    for i in range(n):
        for j in range(i + least - 1, n):
            c = min(range(i, j + 1), key=lambda k: (value[k], k))
            l, r = c, c
            while l > 0 and (value[l - 1], l - 1) > (value[c], c):
                l -= 1
            while r + 1 < n and (value[r + 1], r + 1) > (value[c], c):
                r += 1
            out.add((l, c, r))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_compact_windows_by_definition(seed):
    rng = np.random.default_rng(seed)
    counts = np.array([23, 0, 3, 17, 8])
    value = rng.integers(0, 6 if seed % 2 else 1 << 40, counts.sum()).astype(np.uint64) << np.uint64(20)
    row, l, c, r = compact_windows.compact_windows(value, counts, 5)
    at = 0
    for k, n in enumerate(counts):
        got = {(int(x), int(y), int(z)) for q, x, y, z in zip(row, l, c, r) if q == k}
        assert got == windows_by_definition(value[at:at + n].tolist(), 5)
        at += n


def test_similar_segments():
    a, b = np.arange(100, 200), np.concatenate([np.arange(5), np.arange(120, 190), np.arange(7)])
    assert compact_windows.segments(a, b) == [(20, 89, 5, 74)]
    assert compact_windows.segments(a, np.arange(100, 140)) == []
    edited = a.copy()
    edited[50:55] = [1, 2, 3, 4, 5]
    assert compact_windows.segments(a, edited) == [(0, 99, 0, 99)] or len(compact_windows.segments(a, edited)) <= 2
    assert compact_windows.segments(a, np.zeros(0, int)) == []


def similar_by_definition(a, b):
    """Whether any two spans of at least MIN_TOKENS distinct tokens have similarity 0.8."""
    least = compact_windows.MIN_TOKENS
    for i in range(len(a) - least + 1):
        for j in range(i + least, len(a) + 1):
            inside = np.isin(b, a[i:j])
            upto = np.append(0, np.cumsum(inside))
            for s in range(len(b) - least + 1):
                e = np.arange(s + least, len(b) + 1)
                common = upto[e] - upto[s]
                if (5 * common >= 4 * ((j - i) + (e - s) - common)).any():
                    return True
    return False


@pytest.mark.parametrize("words", [50, 51, 52, 55, 60, 75, 90])
def test_edited_passages_by_definition(words):
    """Passages with one changed word, and a second one, between other tokens."""
    shingles = words - 4
    for at in {0, 3, words // 3, words // 2, words - 1}:
        for second in (None, words - 6):
            passage = np.arange(1000, 1000 + shingles)
            edited = passage.copy()
            for k in (at, second):
                if k is not None:
                    gone = np.arange(max(0, k - 4), min(shingles, k + 1))
                    edited[gone] = 5000 + gone
            a = np.concatenate([np.arange(4), passage, np.arange(10, 13)])
            b = np.concatenate([np.arange(20, 22), edited, np.arange(30, 35)])
            got = compact_windows.segments(a, b)
            assert bool(got) == similar_by_definition(a, b), (words, at, second)
            for s, e, s0, e0 in got:
                common = len(np.intersect1d(a[s:e + 1], b[s0:e0 + 1]))
                assert min(e - s, e0 - s0) + 1 >= compact_windows.MIN_TOKENS and 5 * common >= 4 * ((e - s + 1) + (e0 - s0 + 1) - common)


@pytest.mark.parametrize("names", [8, 30, 1000])
@pytest.mark.parametrize("table", [1 << 22, 0])
def test_many_pairs_are_compared_as_one_by_one(monkeypatch, names, table):
    """Edited, cut, repeated and periodic passages; tokens of few names repeat inside a text."""
    monkeypatch.setattr(compact_windows, "TABLE", table)
    monkeypatch.setattr(compact_windows, "MATCHED", 500)
    rng = np.random.default_rng(names)
    linked = 0
    for _ in range(12):
        base = [rng.integers(0, names, rng.integers(46, 150)) for _ in range(3)]
        texts = [np.zeros(0, np.int64), np.full(120, 7)]
        for _ in range(8):
            parts = [np.zeros(0, np.int64)]
            for _ in range(rng.integers(1, 4)):
                x = base[rng.integers(0, 3)]
                at = int(rng.integers(0, len(x)))
                parts += [x[:at], rng.integers(2000, 3000, rng.integers(0, 4)), x[at + int(rng.integers(0, 4)):], x[:25], rng.integers(3000, 9000, 5)]
            texts.append(np.concatenate(parts))
        count = np.array([len(t) for t in texts])
        a, b = np.array([(i, j) for i in range(len(texts)) for j in range(len(texts)) if i != j]).T
        stretches = compact_windows.Stretches(np.concatenate(texts).astype(np.uint64), count)
        pair, part = stretches.similar(a, b)
        want = [(k, *p) for k, (i, j) in enumerate(zip(a, b)) for p in compact_windows.segments(texts[i].astype(np.uint64), texts[j].astype(np.uint64))]
        assert [(k, *p) for k, p in zip(pair.tolist(), part.tolist())] == want
        everyone = (0, len(texts))
        assert stretches.common(everyone, everyone)[a, b].tolist() == [int(np.isin(texts[i], texts[j]).sum()) for i, j in zip(a, b)]
        linked += len(want)
    assert linked > 100
    pair, part = compact_windows.Stretches(np.zeros(0, np.uint64), np.array([0, 0])).similar(np.array([1]), np.array([0]))
    assert len(pair) == 0 and part.shape == (0, 4)


def test_texts_that_meet_under_many_keys_are_compared_once(monkeypatch):
    """A pair that is not similar around a key, and one that is; holders of one class are not compared."""
    calls = []
    real = compact_windows.segments
    monkeypatch.setattr(compact_windows, "segments", lambda a, b: calls.append(1) or real(a, b))
    a = np.arange(100, 190, dtype=np.uint32)
    unlike = a.copy()
    unlike[::2] = np.arange(5000, 5045)
    holders = [(11, 1, a), (12, 1, a[:80]), (21, 2, unlike), (31, 3, a[10:])]  # n, root, tokens
    cell, n, root, tokens = zip(*[(k, *h) for k in range(40) for h in holders])
    joined, asked = {}, set()
    found = compact_windows._compare(np.array(cell), np.array(n), np.array(root), [t.tobytes() for t in tokens], joined, asked)
    assert (31, 11) in found or (31, 12) in found
    assert len(found) == len(set(found)) <= 4 and len(calls) == len(found) and set(found) <= {(21, 11), (21, 12), (31, 11), (31, 12), (31, 21)}
    assert joined and asked == set(found)


def test_rows_of_a_key_stay_together(monkeypatch):
    rows = [(k, i) for k, size in ((1, 3), (2, 1), (3, 40), (4, 2)) for i in range(size)]
    batches = [pa.RecordBatch.from_pydict({"k": [r[0] for r in rows[s:s + 4]], "i": [r[1] for r in rows[s:s + 4]]}) for s in range(0, len(rows), 4)]
    for together in (100, 10):
        monkeypatch.setattr(compact_windows, "TOGETHER", together)
        got = list(compact_windows.whole(iter(batches), "k"))
        assert [tuple(r.values()) for b, _ in got for r in b.to_pylist()] == rows
        keys = [set(b.column("k").to_pylist()) for b, _ in got]
        for key in range(1, 5):
            assert sum(key in k for k in keys) == 1 or (key == 3 and together == 10)
        assert all(parted == 3 for k, (_, parted) in zip(keys, got) if 3 in k) or together == 100


def kernel_by_definition(s, t, order, decay):
    from itertools import combinations
    total = 0.0
    for i in combinations(range(len(s)), order):
        for j in combinations(range(len(t)), order):
            if all(s[x] == t[y] for x, y in zip(i, j)):
                total += decay ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_subsequence_kernel():
    words = [b"^idiot$", b"^i-d-i-ot$", b"^trash$", b"^a$"]
    w, _ = toxicity.padded(words, 0)
    for mark in (b"^idiot$", b"^tras"):
        m, _ = toxicity.padded([mark] * len(words), 255)
        got = toxicity.kernel(w, m, 3, 0.6)
        assert got == pytest.approx([kernel_by_definition(x, mark, 3, 0.6) for x in words], rel=1e-4)


def test_gapped_insult_is_near_its_landmark():
    marks = toxicity.Landmarks(["^idiot$", "^réeux"])
    data = np.frombuffer("idiotidi-otidxiotflowerréeuxment".encode(), np.uint8)
    ends = np.cumsum([5, 6, 6, 6, len("réeuxment".encode())])
    z = marks.against(data, np.append(0, ends[:-1]), ends)
    assert z[0, 0] == pytest.approx(1) and z[1, 0] > 0.4 and z[2, 0] > 0.4 and z[3].max() < 0.05 and z[4, 1] > 0.9


def test_bradley_terry_ranks_and_cuts():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.1 * rng.normal(size=400) > -0.8).astype(int)
    model = pairwise_rank.fit(x, y)
    s = pairwise_rank.score(model, x)
    assert ((s >= 0.3) == (y == 1)).mean() > 0.93 and model["w"][0] > 5 * abs(model["w"][1])
    assert pairwise_rank.score(pairwise_rank.fit(x, np.ones(400, int)), x) == pytest.approx(np.full(400, 0.3))


def test_em_trusts_agreeing_rules():
    n = len(quality_rules.RULES)
    fine, poor = (None, None, 1) + (None,) * (n - 4) + (1,), (None, 0, 0) + (None,) * (n - 3)
    model = quality_rules.fit([(fine, 900), (poor, 100)])
    assert model["share"] == pytest.approx(0.9, abs=0.02)
    w = quality_rules.weights(model)
    assert w[1][0] < -1 and w[2][1] > 1
    assert quality_rules.fit([])["share"] == quality_rules.PRIOR


@pytest.mark.parametrize("seed", range(3))
def test_equal_strings_have_equal_anchors(seed):
    rng = np.random.default_rng(seed)
    shared = bytes(rng.integers(97, 100, 300, dtype=np.uint8))
    rows = [bytes(rng.integers(97, 123, 150, dtype=np.uint8)) + shared + b"x", shared[40:] + bytes(rng.integers(97, 123, 90, dtype=np.uint8)), b"short"]
    data = np.frombuffer(b"".join(rows), np.uint8)
    offsets = np.append(0, np.cumsum([len(r) for r in rows]))
    row, first, last, name = suffix.anchors(data, offsets)
    anchor = {(r, p - offsets[r]): nm for r, a, b, nm in zip(row, first, last, name) for p in range(a, b + 1)}
    assert len(anchor) == sum(max(0, len(r) - 99) for r in rows)
    for p in range(40, 201):
        assert anchor[0, 150 + p] == anchor[1, p - 40]
    x, y = suffix.Names(data).of(np.array([150 + 40, offsets[1]]), np.array([150 + 140, offsets[1] + 100]))
    assert x[0] == x[1] and y[0] == y[1]


def test_covered_joins_touching_runs():
    assert suffix.covered([{"first": 5, "last": 5}, {"first": 105, "last": 110}, {"first": 300, "last": 301}]) == [(5, 210), (300, 401)]
    assert Counter(suffix.covered([])) == Counter()
