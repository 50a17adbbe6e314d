"""Suffix tree scores, lookup-table clustering and ball-tree search against brute force."""

import collections
import functools
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import ball_tree, lookup_kmeans, suffix_tree_lm

ODD = [(None, None), (None, "x y x y"), (1, ""), (2, " \n\t"), (4, "word"), (4, "word"), (9, "z" * 20000), (10, "so " * 30_000), (11, "Ä ä A a A a")]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# 11


def tree_scores(rows, depth, least, retain):
    """All contexts in dictionaries, by the definition in the module's docstring."""
    texts = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None] for _, t in rows]
    out = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    n, after = collections.Counter(), collections.defaultdict(set)
    for words, held in zip(texts, out):
        for i in range(len(words) if not held else 0):
            for d in range(min(i, depth) + 1):
                n[tuple(words[i - d:i + 1])] += 1
                after[tuple(words[i - d:i])].add(words[i])
    one = {k[0]: v for k, v in n.items() if len(k) == 1}
    total, kinds = sum(one.values()), len(one)

    @functools.cache
    def tried(s):
        return n[s] >= least and (len(s) == 1 or (state(s[1:]) and tried(s[:-1])))

    @functools.cache
    def state(s):
        return not s or tried(s) and any(n[(*s, x)] >= 2 and n[(*s, x)] * math.log(n[(*s, x)] / (n[s] * p(x, s[1:]))) >= retain for x in after[s])

    @functools.cache
    def p(x, s):
        return (n[(*s, x)] + len(after[s]) * p(x, s[1:])) / (n[s] + len(after[s])) if s else (one.get(x, 0) + 1) / (total + kinds + 1)

    got = []
    for (i, _), words, held in zip(rows, texts, out):
        score = 0.0
        for j, x in enumerate(words):
            d = 0
            while d < min(depth, j) and state(tuple(words[j - d - 1:j])):
                d += 1
            score += math.log10(p(x, tuple(words[j - d:j])))
        base = sum(math.log10((one.get(x, 0) + 1) / (total + kinds + 1)) for x in words)
        got.append((i, held, len(words), sum(x in one for x in words), total, base, score))
    return sorted(got, key=lambda r: repr(r[:4]))


@pytest.mark.parametrize("tokens, group", [(3_000_000, 1_000_000), (4_000, 500)])
def test_suffix_tree_scores(documents, prose, monkeypatch, tokens, group):
    """One chunk and one group, and many chunks with hot contexts dealt by pair."""
    monkeypatch.setattr(suffix_tree_lm, "CHUNK_TOKENS", tokens)
    monkeypatch.setattr(suffix_tree_lm, "GROUP_TOKENS", group)
    phrase = prose(30, 99)
    rows = ODD + [(20 + k, prose(60, k) + (" " + phrase.upper() if k % 3 else "") + " the end of it") for k in range(60)] + [(200 + k, phrase) for k in range(8)]
    rows[7] = (10, "so " * 2000)
    docs = documents(rows, extra=True).repartition(3)
    got = sorted((tuple(r) for r in suffix_tree_lm.scored(docs).collect()), key=lambda r: repr(r[:4]))
    want = tree_scores(rows, suffix_tree_lm.DEPTH, suffix_tree_lm.MIN_COUNT, suffix_tree_lm.RETAIN)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    by = lambda r: (repr(r[:4]), r[5], r[6])
    for a, b in zip(sorted(got, key=by), sorted(want, key=by)):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    copies = [r for r in want if r[0] and r[0] >= 200]
    assert all(r[6] > r[5] + 20 for r in copies)


def test_suffix_tree_contexts_do_not_depend_on_the_size(documents, prose):
    """A corpus of 5.8 million training words scores a phrase it holds four times by its contexts."""
    phrase, filler = prose(12, 7), "so " * 2_900_000
    ids = [k for k in range(40) if zlib.crc32(str(k).encode()) % 7 != 2]
    rows = [(k, phrase) for k in ids[:4]] + [(k, filler) for k in ids[4:6]]
    got = {r["doc_id"]: r for r in suffix_tree_lm.scored(documents(rows)).collect()}
    one = got[ids[0]]
    assert one["train_tokens"] > 5_760_000 and one["score"] > one["base_score"] + 20


def test_suffix_tree_chunks_and_questions_stay_small(monkeypatch):
    """Chunks keep to their size, and a round sends a fraction of the 8 bytes that a pair's hash takes."""
    monkeypatch.setattr(suffix_tree_lm, "CHUNK_TOKENS", 50_000)
    rng = np.random.default_rng(5)
    words = np.array([f"w{k}" for k in range(200_000)])
    pick = lambda: " ".join(words[np.minimum(rng.zipf(1.3, 300), len(words)) - 1])
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array([k % 7 == 2 for k in range(1000)]), pa.array([pick() for _ in range(1000)])], names=["doc_id", "held_out", "text"])
    rows = [r.to_pylist()[0] | {"chunk": k} for k, r in enumerate(suffix_tree_lm._chunk_rows(iter([batch])))]
    assert max(r["tokens"] for r in rows) < 65_000 and sum(r["tokens"] for r in rows) == 301_000
    tree = suffix_tree_lm.Tree(2)
    answers = [{} for _ in rows]

    def ask(depth, asked):
        asked = pa.Table.from_batches(asked)
        out = []
        for g in set(asked.column("g").to_pylist()):
            one = asked.filter(pa.compute.equal(asked.column("g"), g))
            out += suffix_tree_lm.answers_of(depth, tree.groups)(one).to_pylist()
        for r in out:
            answers[r["chunk"]].setdefault(depth, {})[r["g"]] = (r["n"], r["states"], r["words"])
        return out, sum(len(v or b"") for c in ("s", "runs", "sym", "n", "need", "alone") for v in (asked.column(c).to_pylist() if c in asked.column_names else ()))

    out, _ = ask(0, [suffix_tree_lm.word_questions(suffix_tree_lm.unpack(r["words"]), 2).rows(r["chunk"], suffix_tree_lm.unpack(r["seen"]), np.zeros(len(suffix_tree_lm.unpack(r["words"])), int)) for r in rows])
    tree.n, tree.v, tree.bound = sum(r["total"] for r in out), sum(r["kinds"] for r in out), 2 * max(r["names"] for r in out)
    _, size = ask(1, [suffix_tree_lm.walk(r, a, tree, 1) for r, a in zip(rows, answers)])
    assert size < 301_000


def test_suffix_tree_names_by_hash_and_unseen_followers(documents, monkeypatch):
    """Names that do not fit into 63 bits, and contexts that a chunk holds before words without a training count only."""

    class Wide(suffix_tree_lm.Tree):
        bound = property(lambda self: 1 << 40, lambda self, value: None)

    monkeypatch.setattr(suffix_tree_lm, "Tree", Wide)
    ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 != 2]
    out = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 == 2]
    rows = [(k, f"alpha beta gamma delta {'epsilon' if k % 2 else 'zeta'} alone{k}") for k in ids] + [(k, f"alpha unseen{k} beta gamma unseen delta new{k}") for k in out]
    for groups in (3_000_000, 20):
        monkeypatch.setattr(suffix_tree_lm, "GROUP_TOKENS", groups)
        got = sorted((tuple(r) for r in suffix_tree_lm.scored(documents(rows).repartition(len(rows))).collect()), key=lambda r: repr(r[:4]))
        want = tree_scores(rows, suffix_tree_lm.DEPTH, suffix_tree_lm.MIN_COUNT, suffix_tree_lm.RETAIN)
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_suffix_tree_rising_numbers_are_packed_by_steps():
    rng = np.random.default_rng(3)
    for top, size in ((1 << 62, 0), (1 << 62, 1), (1 << 62, 50_000), (300, 5_000)):
        values = np.sort(rng.integers(0, top, size).astype(np.uint64))
        assert (suffix_tree_lm.unpack(suffix_tree_lm.pack(values, rising=True)) == values).all()
        starts = np.flatnonzero(np.append(True, rng.random(max(0, size - 1)) < 0.1))[:size]
        mixed = rng.permutation(values)
        assert (suffix_tree_lm.summed(suffix_tree_lm.steps(mixed, starts), starts) == mixed).all()
    values = np.sort(rng.integers(0, 1 << 40, 50_000))
    assert len(suffix_tree_lm.pack(values, rising=True)) < len(suffix_tree_lm.pack(values)) < len(suffix_tree_lm.pack(rng.permutation(values)))


def test_suffix_tree_does_not_ask_for_what_is_known():
    """Tokens without a training count are not asked for after longer contexts, their contexts are; single ones after a hot context count once."""
    sym = np.array([5, 6, 7], np.uint64)
    asked = suffix_tree_lm.Questions(np.array([0, 0, 0]), np.arange(3), np.array([1, 2], np.uint64), sym, np.array([True, False]), 4, np.array([9, 0]))
    rows = asked.rows(0, np.ones(3, np.int64), np.zeros(3, np.int64)).to_pylist()
    names = [x for r in rows for x in suffix_tree_lm.unpack(r["s"]).tolist()]
    assert set(names) == {1, 2}
    assert sum(int(suffix_tree_lm.unpack(r["alone"]).sum()) for r in rows) == 9


def test_suffix_tree_edges(documents):
    assert suffix_tree_lm.scored(documents(ODD).limit(0)).count() == 0
    only = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    row = suffix_tree_lm.scored(documents([(only, "never seen")])).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["score"]) == (True, 3, 0, 0, 0.0)


def test_needed_counts():
    rng = np.random.default_rng(1)
    n, p = rng.integers(1, 400, 500), 10 ** rng.uniform(-6, -0.01, 500)
    for total, share, k in zip(n, p, suffix_tree_lm.needed(n, p)):
        ok = [c for c in range(2, total + 1) if c > total * share and c * math.log(c / (total * share)) >= suffix_tree_lm.RETAIN]
        assert k == (ok[0] if ok else 0)


# 12


def test_clusters_match_sql(spark):
    rng = np.random.default_rng(2)
    rows = [(i % 50, rng.uniform(-1.5, 1.5, 64).tolist()) for i in range(60)]
    rows += [(1, [0.5] * 64), (1, [0.5] * 64), (None, [0.1] * 64), (7, None), (8, [0.1] * 63), (12, [])]
    rows += [(k, [odd] + [0.0] * 63) for k, odd in enumerate((math.nan, math.inf, -math.inf, None))]
    df = spark.createDataFrame([(*r, "mine", 1) for r in rows], "vec_id bigint, embedding array<float>, v string, cluster int").repartition(5)
    embeddings = pa.table({"vec_id": pa.array([a for a, _ in rows], pa.int64()), "embedding": pa.array([b for _, b in rows], pa.list_(pa.float32()))})
    con = duckdb.connect()
    con.register("embeddings", embeddings)
    got = sorted((tuple(r) for r in lookup_kmeans.clustered(df).collect()), key=repr)
    assert got == sorted(con.execute(lookup_kmeans.ORACLE).fetchall(), key=repr) and len(got) == 63
    assert lookup_kmeans.clustered(df.limit(0)).count() == 0
    few = lookup_kmeans.clustered(df.where("vec_id in (3, 5)"))
    assert few.count() == few.select("cluster").distinct().count() == 4 and few.selectExpr("max(distance)").first()[0] == 0


def test_tables_give_exact_distances():
    rng = np.random.default_rng(0)
    v, c = rng.integers(-3000, 3000, (500, 64)), rng.integers(-3000, 3000, (16, 64))
    assert (lookup_kmeans.distances(v, c) == ((v[:, None] - c[None]) ** 2).sum(2)).all()


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [3e7] + [0.0] * 63)], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="do not fit"):
        lookup_kmeans.clustered(df).collect()


# 13


def ranked(rows, items, top=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    docs = [(i, collections.Counter(words(t)), len(words(t))) for i, t in rows if words(t)]
    n, total = len(docs), sum(d[2] for d in docs)
    df = collections.Counter(w for _, c, _ in docs for w in c)
    out = []
    texts = {}
    for i, t in items:
        if t is not None:
            texts[i] = max(t, texts.get(i, ""))
    for item, t in texts.items():
        scores = []
        for i, c, size in docs:
            m = 25 + 75 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in words(t) if c[w])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("leaf, docs_in_slice, item_bytes", [(48, 1 << 14, 4 << 20), (2, 40, 7000)])
def test_search_is_exact(documents, spark, prose, monkeypatch, leaf, docs_in_slice, item_bytes):
    """With wide leaves in one tree, and with small trees, thin leaves and several blocks of items."""
    monkeypatch.setattr(ball_tree.Tree.__init__, "__defaults__", (leaf,))
    monkeypatch.setattr(ball_tree.slices, "__defaults__", (1 << 20, docs_in_slice))
    monkeypatch.setattr(ball_tree, "ITEM_BYTES", item_bytes)
    base = [prose(80, k) for k in range(12)]
    rows = ODD + [(100 + k, base[k % 12] + " " + prose(k % 40, 500 + k)) for k in range(150)] + [(300 + k % 5, base[0]) for k in range(30)]
    items = [(k, base[k][:150]) for k in range(6)] + [(6, None), (7, ""), (8, "nowhere-to-be-found"), (None, base[7][:40]), (0, "A"), (9, "so SO word"), (10, "z" * 20000)]
    df = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((tuple(r) for r in ball_tree.search(documents(rows, extra=True).repartition(3), df).collect()), key=repr)
    assert got == ranked(rows, items)
    empty = documents(rows).limit(0)
    assert ball_tree.search(empty, df).count() == 0 and ball_tree.search(documents(rows), df.limit(0)).count() == 0


def test_bounds_are_never_below_a_score():
    rng = np.random.default_rng(5)
    count = rng.integers(1, 30, 600)
    at = np.append(0, np.cumsum(count))
    term = np.concatenate([np.sort(rng.choice(200, c, replace=False)) for c in count])
    value = rng.integers(1, 1_000_000, len(term))
    weight = rng.integers(1, 15_000, 200)
    tree = ball_tree.Tree(term, value, at, weight, 8)
    for _ in range(30):
        t = np.sort(rng.choice(200, 12, replace=False))
        high = tree.bounds(t, weight[t])
        tree.item[t] = weight[t]
        assert all(high[k] >= tree.scores(rows).max() for k, rows in enumerate(tree.rows))
        tree.item[t] = 0
    assert sorted(np.concatenate([r for r, f in zip(tree.rows, tree.first) if f < 0]).tolist()) == list(range(600))
