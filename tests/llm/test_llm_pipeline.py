"""Decontamination and every stage of the pipeline, whole rows, against plain Python."""

import collections

import duckdb
import numpy as np
import pytest
import regex

import corpus_pipeline
from tallyframe.llm import decontaminate, mixing, quality_rules
from tests.llm.test_llm_brute import components, edited, shingles
from tests.llm.test_llm_operators import base, line_oracle

W = decontaminate.WIDTH


def clean(text):
    t = regex.sub(r"[\x20\x09-\x0D]+", " ", text or "").strip(" ")
    return regex.sub(" +", " ", regex.sub(decontaminate._BARE, "", t)).strip(" ")


def templates(text):
    t = regex.sub(decontaminate._NAME, "<name>", text).lower()
    t = regex.sub(decontaminate._UNIT, "<unit>", regex.sub(decontaminate._NUMBER, "<num>", t))
    return regex.sub(r"[^\p{L}\p{M}\p{N}<> ]+", "", t).split(" ")


def literals(text):
    return regex.sub(r"(?<![^ ])[^\p{L}\p{N} ]+|[^\p{L}\p{M}\p{N} ]+(?![^ ])", "", text.lower()).split(" ")


def found_by(docs, items):
    """(doc_id, item_id) -> the best occurrence's counts, all windows of all texts held against all windows of all items."""
    out = {}
    for item, text in items:
        c = clean(text)
        if not c:
            continue
        words, raw = templates(c), c.split(" ")
        windows = {}
        for at in range(len(words) - W + 1):
            slots = [(k, words[at + k], raw[at + k]) for k in range(W) if words[at + k].startswith("<")]
            if len(slots) <= W - decontaminate.MIN_LITERAL:
                windows.setdefault(tuple(words[at:at + W]), (at, slots))
        split, width = templates, W
        if not windows:
            split, own = literals, literals(c)
            width = min(len(own), W)
            for at in range(len(own) - width + 1):
                windows.setdefault(tuple(own[at:at + width]), (at, []))
        for doc, body in docs:
            d = clean(body)
            theirs, real = split(d), d.split(" ")
            hits = [(pos, *windows[tuple(theirs[pos:pos + width])]) for pos in range(len(theirs) - width + 1) if d and tuple(theirs[pos:pos + width]) in windows]
            if not hits:
                continue
            parts = collections.defaultdict(list)
            stretch, last = 0, None
            for pos, at, slots in sorted(hits, key=lambda h: h[:2]):
                if last is not None and abs(pos - at - last) > W:
                    stretch += 1
                last = pos - at
                for part in ("all", ("offset", last), ("stretch", stretch)):
                    parts[part].append((pos, at, slots))
            best = None
            for rows in parts.values():
                counterparts = collections.defaultdict(set)
                for pos, _, slots in rows:
                    for k, kind, value in slots:
                        counterparts[kind, value].add(real[pos + k])
                n, matched = len(counterparts), len({at for _, at, _ in rows})
                same = sum(len(v) == 1 for v in counterparts.values())
                changed = sum(v != {value} for (_, value), v in counterparts.items())
                bad = matched >= min(decontaminate.MIN_WINDOWS, len(windows)) and same >= decontaminate.MIN_CONSISTENT * n
                best = max(best or (False,), (bad, matched, len(windows), same, n, changed))
            key = (doc, item)
            out[key] = max(out.get(key, (False,)), best)
    return out


ITEM = "A train from {} leaves at {} hours and travels {} km before it meets the slow train from {} after {} hours of steady running"


def leaks(prose):
    """Items and texts that hold them: as they are, re-parameterised, inconsistently, in part, twice, short and full of slots."""
    one, two = ITEM.format("Berlin", 12, 340, "Munich", 12), "Bring 3 kg of flour and 2 liters of milk to Anna before noon, then add 3 eggs and stir for 20 minutes"
    items = [(1, one), (2, two), (3, "What is 12 + 30 * 4?"), (4, "Add 12 km 30 kg 45 mm and 7 lb 9 oz 11 s"), (5, None), (6, ""), (7, prose(20, 77))]
    texts = [one, two, ITEM.format("Lisbon", 17, 95, "Cadiz", 17), ITEM.format("Lisbon", 17, 95, "Cadiz", 18), one[:90], one.upper(), two.replace("3", "5").replace("Anna", "Otto"),
             one + ". " + ITEM.format("Rome", 1, 2, "Turin", 1), "What is 12 + 30 * 4?", "What is 12 + 31 * 4?", "add 12 km 30 KG 45 mm and 7 lb 9 oz 11 s", one.replace("before it", "before finally it"), prose(20, 77)]
    return items, [f"{prose(20 + k, 300 + k)}. {t} {prose(30, 400 + k)}" for k, t in enumerate(texts)]


def test_decontamination_equals_all_pairs(spark, documents, prose):
    items, texts = leaks(prose)
    rows = [(k, t) for k, t in enumerate(texts)] + [(50, None), (51, ""), (52, " \n"), (53, "12 " * 3000), (54, "so " * 20_000), (55, prose(90, 3))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.verdicts(documents(rows, extra=True).repartition(3), bench).collect()
    have = {(r["did"], r["item_id"]): (r["contaminated"], r["n_matched"], r["n_windows"], r["n_consistent"], r["n_slots"], r["n_changed"]) for r in got}
    want = found_by(rows, items)
    assert have == want and len(have) == len(got)
    bad = {d for (d, _), v in want.items() if v[0]}
    assert {0, 1, 2, 6, 7, 8, 10, 12} <= bad and not {9, 55} & bad


def kept_by_rules(rows):
    """The verdicts of the rules: measurements in Python, votes by DuckDB, EM over them."""
    measures = []
    for i, t in rows:
        n_words, chars, symbols, dup, repeat = base(t)
        t = t or ""
        words = regex.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        count = lambda p: len(regex.findall(p, t))
        measures.append((i, n_words, chars, symbols, dup, repeat, len(lines), n_words - count(quality_rules.ODD_RUN), len(set(words)), count(r"\p{Lu}"), count("!"), count(r"[.!?](?![^\x20\x09-\x0D])")))
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_plain n_distinct n_capitals n_exclaims n_stops".split()
    con = duckdb.connect()
    con.execute(f"CREATE TABLE m ({', '.join(f'{n} BIGINT' for n in names)})")
    con.executemany(f"INSERT INTO m VALUES ({', '.join('?' * len(names))})", measures)
    votes = con.execute(f"SELECT doc_id, n_words < 50 OR 100 * n_repeat_words > 50 * n_words, {', '.join(quality_rules.vote(r) for r in quality_rules.RULES)} FROM m").fetchall()
    model = quality_rules.fit(list(collections.Counter(v[2:] for v in votes).items()))
    weight = quality_rules.weights(model)
    odds = lambda v: np.log(model["share"] / (1 - model["share"])) + sum(w[2 if x is None else x] for w, x in zip(weight, v))
    return {v[0] for v in votes if not v[1] and odds(v[2:]) >= 0}


@pytest.fixture()
def corpus(spark, documents, prose, folder):
    """A folder of tables: prose, junk, shared lines, near copies, leaks."""
    rng = np.random.default_rng(6)
    items, texts = leaks(prose)
    line = "\nthis line of a licence stands below a good many of the texts here\n"
    rows = [(k, prose(90 + k, k) + (line if k % 4 == 0 else "\n") + prose(20, 900 + k)) for k in range(60)]
    rows += [(100 + k, edited(rows[k % 6][1], rng, 0.01) if k % 3 else rows[k % 6][1]) for k in range(24)]
    rows += [(200 + k, prose(60, 5000 + k) + ". " + t) for k, t in enumerate(texts)]
    rows += [(300 + k, " ".join(w + "###" for w in prose(80, 600 + k).split())) for k in range(10)] + [(320, "so " * 200), (330, None), (331, ""), (332, "short")]
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, int(i < 300), int(i % 7 == 0)) for i, _ in rows], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, items


def test_stages_equal_plain_python(spark, corpus):
    folder, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)

    def run(name):
        nonlocal docs, rows
        docs = corpus_pipeline.stored(stages[name](spark, docs, folder), name)
        before, rows = rows, [(r["doc_id"], r["text"]) for r in docs.collect()]
        return before

    before = run("quality_rules")
    assert sorted(i for i, _ in rows) == sorted(kept_by_rules(before)) and 60 <= len(rows) < len(before)
    before = run("line_dedup")
    assert sorted(rows) == sorted((i, kept) for i, _, _, kept in line_oracle(before)) and any(a != b for a, b in zip(sorted(before), sorted(rows)))
    before = run("near_duplicates")
    bags = [(i, shingles(t)) for i, t in before]
    links = [(i, j) for k, (i, x) in enumerate(bags) for j, y in bags[:k] if x and y and 5 * sum((x & y).values()) >= 4 * sum((x | y).values())]
    assert sorted(i for i, _ in rows) == sorted(i for i, top in components([i for i, _ in before], links).items() if i == top)
    assert len(rows) <= len(before) - 10
    before = run("decontamination")
    bad = {d for (d, _), v in found_by(before, items).items() if v[0]}
    assert sorted(rows) == sorted(r for r in before if r[0] not in bad) and len(bad) >= 6
    before = rows
    out = corpus_pipeline.stored(stages["mixing"](spark, docs, folder), "mixing")
    rates = {r["doc_id"]: r["mix_rate"] for r in out.collect()}
    p = mixing.posteriors(docs, mixing.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))).collect()
    q, tokens = np.array([[r[d] for d in mixing.DOMAINS] for r in p]), np.array([r["tokens"] for r in p], float)
    all_rates = np.array([rates.get(r["doc_id"], 0.0) for r in p])
    assert set(rates) <= {i for i, _ in before} and (all_rates >= 0).all()
    # the rates that are not 0 are 1 less a fixed number per domain, as the closest to 1 that meet targets are
    kept = all_rates > 0
    y, *_ = np.linalg.lstsq(q[kept], 1 - all_rates[kept], rcond=None)
    assert np.maximum(1 - q @ y, 0) == pytest.approx(all_rates, abs=1e-6)
    reached = (all_rates * tokens) @ q / tokens.sum()
    targets = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    share = reached / targets
    assert (abs(share / share[0] - 1) < 0.02).sum() >= 2  # the reachable domains keep the proportions asked for
    final = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"]: round(r["mix_rate"], 6) for r in final.collect()} == {k: round(v, 6) for k, v in rates.items()}
