"""The corpus operators on small tables: contracts, odd rows, empty tables, clashing columns."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import bagminhash, chat, compact_windows, decontaminate, line_dedup, mixing, pairwise_rank, quality_rules, suffix, toxicity
from tallyframe.llm.components import components
from tallyframe.llm.rows import held_out

ODD = [(None, None), (None, "x"), (1, None), (2, ""), (3, " \n\t"), (4, "word"), (4, "word"), (4, "other"), (9, "z" * 20000)]


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda v: (v is not None, v))


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (5, 4), (7, 7), (None, 3), (3, 2)] + [(k, k + 1) for k in range(100, 140)] + [(200, k) for k in range(201, 240)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got[3] == 1 and got[5] == 4 and 7 not in got and {got[k] for k in range(100, 141)} == {100} and {got[k] for k in range(201, 240)} == {200}
    assert components(links.limit(0)).count() == 0


def test_held_out(spark):
    df = spark.range(40).select("id", held_out("id").alias("h"))
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in df.collect())


# 9


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = collections.Counter(g)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len({j for i, x in enumerate(g) if c[x] > 1 for j in (i, i + 1, i + 2)})


def test_quality_measures_and_verdict(documents, prose):
    rows = ODD + [(20, "a b c a b c d"), (21, "a a a a"), (22, "l\nl\n \nl #*|<>"), (23, prose(200, 1)), (24, " ".join(w + "###" for w in prose(200, 2).split())), (25, "so so " * 60)]
    rows += [(100 + k, prose(150 + k, 10 + k)) for k in range(12)]
    docs = documents(rows, extra=True)
    m = quality_rules.judged(docs, quality_rules.learn(quality_rules.measured(docs)))
    got = m.select("row.doc_id", "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[2:7]) == base(r["text"])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert 23 in kept and not kept & {None, 1, 2, 3, 4, 9, 20, 24, 25} and {100 + k for k in range(12)} <= kept
    out = quality_rules.apply(docs)
    assert out.columns == docs.columns and set(ids(out)) == kept
    assert quality_rules.apply(docs.limit(0)).count() == 0


# 2


def line_oracle(rows, least=line_dedup.MIN_CHARS, most=line_dedup.MIN_DOCS):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held = collections.defaultdict(set)
    low = lambda i: -(2**63) if i is None else i
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                held[key(x)].add(low(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= least and len(held[key(x)]) >= most and max(held[key(x)]) != low(i))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup(documents, folder):
    common, twin = "this line is found in a good many documents, Ä", "A line that four documents hold is no common line"
    rows = ODD + [(30 + k, f"own {k}\n  {common.upper() if k % 2 else common}\t\nend" + ("\n" + twin if k < 4 else "")) for k in range(7)]
    rows += [(36, common), (None, common + "\n" + common), (50, "x\n" * 3000 + common + "\n")]
    docs = documents(rows, extra=True)
    got = line_dedup.deduplicated(docs, batches=3).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    # upper() also maps Ä, which keys leave alone
    assert sorted((tuple(r) for r in got), key=repr) == line_oracle(rows)
    out = line_dedup.apply(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    changed = out.where("doc_id = 31").first()
    assert changed["n_chars"] == len(changed["text"])
    assert line_dedup.apply(docs.limit(0)).count() == 0


def test_runs_are_levelled(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for k in range(5):
        runs.add(spark.createDataFrame([(1, 1, 2, 100 - k), (10 + k, 0, 1, 100 - k)], "k1 bigint, k2 bigint, n_docs bigint, last_doc bigint"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    index = {r["k1"]: (r["n_docs"], r["keeper"]) for r in runs.index().collect()}
    assert index[1] == (10, 100) and index[14] == (1, 96) and len(index) == 6


# 3


def test_chat_links_nested_quotes(spark):
    first = "The old mill closed in March. Nobody told the farmers."
    rows = [
        (1, 0, "user", first),
        (1, 1, "assistant", "On Monday Ann wrote:\n> The old mill closed\n> in March.\nThat is sad news indeed."),
        (1, 2, "user", "Bob wrote:\n>> the old mill closed in march!\n> That is sad news indeed.\n\nIt opens again soon."),
        (1, 3, "user", "> nobody has ever said this before\nWho said so?"),
        (1, 4, "user", first),
        (None, 5, "user", "> x"), (1, None, "user", "> The old mill closed in March."), (2, 0, None, None), (2, 0, None, None), (2, 1, "user", "a > b"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("thread", F.lit("mine"))
    got = {(r["conv_id"], r["turn"]): r for r in chat.linked(df).collect()}
    assert chat.linked(df).count() == len(rows)
    assert got[1, 1]["reply_to"] == 0 and got[1, 1]["clean"] == "That is sad news indeed." and got[1, 1]["depth"] == 1
    assert got[1, 2]["reply_to"] == 1 and got[1, 2]["thread"] == 0 and got[1, 2]["depth"] == 2 and got[1, 2]["clean"] == "It opens again soon." and got[1, 2]["max_level"] == 2
    assert got[1, 3]["reply_to"] is None and got[1, 3]["n_quoted"] == 1 and got[1, 3]["n_linked"] == 0 and got[1, 3]["clean"] == "Who said so?"
    assert got[1, 4]["clean"] == first and got[2, 1]["clean"] == "a > b" and got[2, 0]["clean"] == "" and got[1, None]["reply_to"] is None
    assert chat.linked(df.limit(0)).count() == 0


# 4


def test_bagminhash_classes(documents, prose):
    one = prose(300, 1)
    words = one.split()
    near = " ".join(["changed", *words[1:]])
    chain = " ".join(words[:-20] + prose(20, 5).split())
    rows = ODD + [(10, one), (11, one.upper()), (12, near), (13, chain), (14, prose(300, 2)), (15, prose(300, 3) + " " + " ".join(words[:60])), (16, "a b c"), (17, "a b c"), (18, "ha " * 400), (19, "ha " * 390)]
    docs = documents(rows, extra=True)
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(docs).collect()}
    assert got[10] == got[11] == got[12] == got[13] == 10 and got[14] == 14 and got[15] == 15 and got[17] == 16 and got[19] == 18
    assert got[1] == 1 and got[2] == 2 and got[4] == 4 and None not in got
    out = bagminhash.apply(docs)
    assert out.columns == docs.columns
    assert ids(out) == [None, None, 1, 2, 3, 4, 9, 10, 14, 15, 16, 18]
    assert bagminhash.apply(docs.limit(0)).count() == 0


def test_bagminhash_checks_members_the_leader_does_not_link(documents, prose):
    # 40 and 42 are unlike; both are like 41. The least member of a bucket may be either.
    words = prose(400, 9).split()
    variant = lambda at, seed: " ".join(words[:at] + prose(24, seed).split() + words[at + 24:])
    both = " ".join(words)
    rows = [(40, variant(50, 1)), (41, both), (42, variant(300, 2)), (43, variant(200, 3))]
    got = {r["class_id"] for r in bagminhash.classes(documents(rows)).collect()}
    assert got == {40}


def test_bagminhash_passes_on_pairs_whose_marks_agree_before_a_shared_band(documents, prose, monkeypatch):
    """Marks of the first three bands agree for all texts; the second pass alone has to find the pairs."""
    def bands_of(words, bands=bagminhash.BANDS, width=bagminhash.ROWS, real=bagminhash.bands_of):
        buckets, marks, some = real(words, bands, width)
        marks[:, :3 * width] = 0
        return buckets, marks, some

    monkeypatch.setattr(bagminhash, "bands_of", bands_of)
    words = prose(400, 9).split()
    docs = documents([(40, " ".join(words))] + [(40 + k, " ".join(words[:50 * k] + prose(24, k).split() + words[50 * k + 24:])) for k in range(1, 7)])
    signed = bagminhash._signed(docs, bagminhash.BANDS, bagminhash.ROWS)
    entries = bagminhash._entries(signed, bagminhash.BANDS)
    shared = entries.groupBy("bucket").agg(F.min("a").alias("b"), F.max("a").alias("other")).where("b < other").select("bucket", "b")
    none = docs.limit(0).selectExpr("doc_id as a", "doc_id as b")
    got = bagminhash._rest(docs, signed, entries, shared, none, none.toDF("node", "root"), 0.8, bagminhash.BANDS, bagminhash.ROWS)
    assert {(r["a"], r["b"]) for r in got.collect()} >= {(40 + k, 40) for k in range(1, 7)}


# 1


def test_decontamination_matches_reparameterised_items(spark, documents, prose):
    item = "A train from Berlin leaves at 12 hours and travels 340 km before it meets the slow train from Munich after 12 hours of steady running"
    changed = item.replace("12", "17").replace("340", "95").replace("Berlin", "Lisbon").replace("Munich", "Cadiz")
    mixed = item.replace("12 hours and", "17 hours and")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short to tell"), (5, "stay clear of every other text in this little table please")], "item_id bigint, text string")
    rows = ODD + [(20, prose(80, 1) + " " + item + ". " + prose(40, 2)), (21, prose(30, 3) + ". " + changed), (22, item.upper()), (23, prose(100, 4)), (24, prose(20, 5) + ". " + mixed)]
    docs = documents(rows, extra=True)
    for limit in (10**6, 0):  # broadcast and shuffled windows
        got = {(r["did"], r["item_id"]): r for r in decontaminate.verdicts(docs, bench, broadcast_rows=limit).collect()}
        assert {k for k, r in got.items() if r["contaminated"]} >= {(20, 1), (21, 1)} and {k[1] for k in got} == {1}
        assert got[21, 1]["n_changed"] >= 3 and got[20, 1]["n_changed"] == 0 and got[20, 1]["n_consistent"] == got[20, 1]["n_slots"]
    assert got[24, 1]["n_consistent"] < got[24, 1]["n_slots"]
    out = decontaminate.apply(docs, bench)
    assert out.columns == docs.columns and not {20, 21} & set(ids(out)) and {23, 4, 9, 1} <= set(ids(out))
    assert decontaminate.apply(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.verdicts(docs.limit(0), bench).count() == 0


def test_decontamination_judges_each_occurrence(spark, documents, prose):
    item = "A train from Berlin leaves at 12 hours and travels 340 km before it meets the slow train from Munich after 12 hours of steady running"
    change = lambda a, b, c, d: item.replace("12", a).replace("340", b).replace("Berlin", c).replace("Munich", d)
    one, two = change("17", "95", "Lisbon", "Cadiz"), change("31", "88", "Madrid", "Porto")
    longer = lambda t: t.replace("before it meets", "before it finally meets")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = [(1, f"{prose(20, 1)}. {one}. {prose(30, 2)}. {two}"), (2, f"{prose(9, 3)}. {item}. {one}"), (3, f"{longer(one)}. {prose(40, 5)}. {longer(two)}"), (4, longer(one)), (5, prose(60, 6))]
    got = {r["did"]: r for r in decontaminate.verdicts(documents(rows), bench).collect()}
    assert {k for k, r in got.items() if r["contaminated"]} == {1, 2, 3, 4}
    assert ids(decontaminate.apply(documents(rows), bench)) == [5]


def test_decontamination_finds_copies_of_short_items_and_of_items_full_of_slots(spark, documents, prose):
    short, dense = "What is 12 + 30 * 4?", "Add 12 km 30 kg 45 mm and 7 lb 9 oz 11 s"
    bench = spark.createDataFrame([(1, short), (2, dense), (3, None), (4, " * "), (2, "Why not?")], "item_id bigint, text string")
    rows = ODD + [(20, prose(9, 1) + " " + short + " " + prose(9, 2)), (21, dense.upper()), (22, "What is 12 + 31 * 4?"), (23, dense.replace("45", "46")), (24, "so why not"), (25, prose(60, 6))]
    docs = documents(rows)
    for limit in (10**6, 0):
        got = {(r["did"], r["item_id"]) for r in decontaminate.verdicts(docs, bench, broadcast_rows=limit).where("contaminated").collect()}
        assert got == {(20, 1), (21, 2), (24, 2)}


# 5 and 7


@pytest.fixture()
def labelled(spark, documents, prose):
    rows, labels = [], []
    for k in range(160):
        text, poor, toxic = prose(60 + k % 30, k), k % 4 == 0, k % 3 == 0
        if toxic:
            text = text.replace(".", " " + ["scumbag", "moronic", "trashy"][k % 9 // 3] + ".", 2)
        if poor:
            text = " ".join(w + "&&&" for w in text.split())
        rows.append((k, text))
        labels.append((k, int(not poor), int(toxic)))
    labels += [(None, 1, 1), (1, None, None), (900, 1, 0)]
    return documents(rows + [(None, None), (500, ""), (501, None)], extra=True), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), {r[0]: r[1:] for r in labels[:160]}


def test_quality_scores(labelled):
    docs, labels, truth = labelled
    got = pairwise_rank.scored(docs, pairwise_rank.learn(docs, labels)).collect()
    assert len(got) == 163 and all(0 <= r["score"] <= 1 for r in got)
    right = [(r["score"] >= 0.3) == bool(truth[r["doc_id"]][0]) for r in got if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(right) > 20 and sum(right) >= 0.95 * len(right)
    none = pairwise_rank.learn(docs, labels.limit(0))
    assert {round(r["score"], 6) for r in pairwise_rank.scored(docs, none).collect()} == {0.3}
    assert pairwise_rank.scored(docs.limit(0), none).count() == 0


def test_toxicity_of_several_words(spark, documents, prose):
    """Insults spelled with blanks, and insults of two words neither of which is one; with a word between them, too."""
    rows, labels = [], []
    for k in range(300):
        words = prose(70 + k % 30, 7000 + k).split()
        toxic = k % 3 == 0
        insert = {0: "scumbag", 1: "worthless", 2: "rotten turnip"}[k // 3 % 3] if toxic else ("rotten", "turnip", "fresh turnip", "rotten apple", "a b c")[k % 5]
        rows.append((k, " ".join([*words[:20], insert, *words[20:]])))
        labels.append((k, 1, int(toxic)))
    plain = prose(60, 1).split()
    probes = {1000: "s c u m b a g", 1001: "W O R T H L E S S,", 1002: "rotten turnip", 1003: "rotten old turnip", 1004: "scum-bag", 1005: "x y z w", 1006: "rotten day turnip soup", 1007: "fresh"}
    rows += [(k, " ".join([*plain[:30], v, *plain[30:]])) for k, v in probes.items()]
    docs, labels = documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    assert any(" " in m for m in model["landmarks"])
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    assert all(got[k] >= 0.5 for k in (1000, 1001, 1002, 1003)) and max(got[k] for k in (1005, 1007)) < 0.5
    assert got[1004] > 2 * got[1005]
    truth = [(k, got[k] >= 0.5) for k in range(300) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum((k % 3 == 0) == hit for k, hit in truth) >= 0.95 * len(truth)


def test_toxicity_scores(labelled):
    docs, labels, truth = labelled
    got = toxicity.scored(docs, toxicity.learn(docs, labels)).collect()
    assert len(got) == 163 and all(0 <= r["score"] <= 1 for r in got)
    right = [(r["score"] >= 0.5) == bool(truth[r["doc_id"]][1]) for r in got if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(right) > 20 and sum(right) >= 0.95 * len(right)
    assert toxicity.learn(docs, labels.where("toxic = 0")) is None
    assert {r["score"] for r in toxicity.scored(docs, None).collect()} == {0.0}


# 6


def test_repeated_passages(documents, prose):
    passage = prose(60, 77)
    edited = passage.split()
    edited[30] = "changed"
    rows = ODD + [(10, prose(80, 1) + " " + passage), (11, passage + " " + prose(70, 2)), (12, prose(20, 3) + " " + prose(90, 4)), (13, prose(40, 5) + " " + passage.upper()),
                  (14, " ".join(passage.split()[:30]) + " " + prose(50, 6)), (15, prose(40, 7) + " " + " ".join(edited + prose(100, 78).split())), (16, prose(30, 8) + " " + " ".join(passage.split() + prose(100, 78).split()))]
    got = {r["doc_id"]: r for r in compact_windows.passages(documents(rows, extra=True)).collect()}
    assert compact_windows.passages(documents(rows)).count() == len(rows)
    assert got[11]["class_id"] == got[13]["class_id"] == got[10]["class_id"] == 10 and got[12]["class_id"] == 12 and got[14]["class_id"] == 14
    span = got[11]["spans"][0]
    assert span["start"] <= 0 and span["end"] >= 60 and span["source"] == got[11]["spans"][0]["source"]
    assert got[16]["class_id"] == got[15]["class_id"] and got[10]["n_links"] >= 2 and not got[10]["spans"]
    assert compact_windows.passages(documents(rows).limit(0)).count() == 0


def window_values(text):
    """Centre of every window of a text by function and value."""
    return {(k, int(v)): int(c) for k, value, _, _, at, _ in compact_windows.windows_of(compact_windows.Words(pa.array([text], pa.large_string()))) for v, c in zip(value, at)}


def test_repeated_passages_past_the_first_holder(documents, prose, monkeypatch):
    """Two documents share a passage; all their common minima occur in an earlier document without it."""
    passage = prose(60, 77)
    rows = [(k, prose(40, k) + " " + passage + " " + prose(40, 50 + k)) for k in (10, 11)]
    one, other = (window_values(t) for _, t in rows)
    early = []
    for key in one.keys() & other.keys():
        shingle = " ".join(rows[0][1].split()[one[key]:one[key] + 5])
        around = (f"{prose(50, s)} {shingle} {prose(50, s + 1)}" for s in range(1000, 3000, 2))
        early.append(next(t for t in around if key in window_values(t)))
    rows.append((1, " ".join(early)))
    assert one.keys() & other.keys() <= window_values(rows[-1][1]).keys()
    got = {r["doc_id"]: r["class_id"] for r in compact_windows.passages(documents(rows)).collect()}
    assert got == {1: 1, 10: 10, 11: 10}
    # nothing from first holders: the second pass finds the classes of many holders by itself
    rows += [(k, prose(40, k) + " " + passage + " " + prose(40, 50 + k)) for k in range(12, 20)] + [(30, passage.upper()), (31, prose(90, 31))]
    monkeypatch.setattr(compact_windows, "candidates", lambda windows: windows.selectExpr("n", "n as n0").limit(0))
    monkeypatch.setattr(compact_windows, "BLOCK", 3)
    got = {r["doc_id"]: r["class_id"] for r in compact_windows.passages(documents(rows)).collect()}
    assert got == {1: 1, 30: 10, 31: 31, **{k: 10 for k in range(10, 20)}}


@pytest.mark.parametrize("cell", [256 << 10, 1500])
def test_repeated_passages_lists_every_link(documents, prose, monkeypatch, cell):
    """Links are those of all pairs, not only with first holders, and copies count with their text."""
    monkeypatch.setattr(compact_windows, "CELL_BYTES", cell)
    first, second = prose(70, 77), prose(70, 78)
    rows = [(k, " ".join([prose(30, 100 + k), *[p for p, own in ((first, k < 9), (second, k > 6)) if own], prose(30, 200 + k)])) for k in range(14)]
    rows += [(30 + k, rows[j][1]) for k, j in enumerate((3, 3, 8, 12))] + [(40, prose(90, 5)), (41, "few words"), (42, "few words")]
    got = {r["doc_id"]: r for r in compact_windows.passages(documents(rows).repartition(3)).collect()}
    token = {i: compact_windows.Words(pa.array([t])).shingles(compact_windows.SHINGLE)[0] for i, t in rows}
    linked = {i: {j for j in token if j != i and compact_windows.segments(token[max(i, j)], token[min(i, j)])} for i in token}
    assert {i: r["n_links"] for i, r in got.items()} == {i: len(v) for i, v in linked.items()} and sum(map(len, linked.values())) == 198
    head = {i: min(j for j, u in rows if u == t) for i, t in rows}
    for i in range(14):
        assert {s["source"] for s in got[i]["spans"]} == {j for j in linked[i] if j < i}
    for i in range(30, 34):
        assert {s["source"] for s in got[i]["spans"]} == {j for j in linked[head[i]] if j < head[i]} | {head[i]}
        assert (0, len(dict(rows)[i].split()), head[i]) in {tuple(s) for s in got[i]["spans"]}
    assert {r["class_id"] for i, r in got.items() if i < 40} == {0} and got[41]["n_links"] == got[42]["n_links"] == got[40]["n_links"] == 0


# 8


def bytes_oracle(rows, length=100):
    seen, out = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        own = {}
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen or s in own:
                gone[p:p + length] = b"\1" * length
            own.setdefault(s, p)
        seen |= set(own)
        spans = sum(1 for k, v in enumerate(gone) if v and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("crowd", [suffix.CROWD, 0])
def test_repeated_bytes(documents, prose, monkeypatch, crowd):
    monkeypatch.setattr(suffix, "CROWD", crowd)
    a, b = prose(60, 1), prose(200, 2)
    rows = [(1, None), (2, ""), (3, "é" * 400), (5, a + b), (6, "x" + b[37:] + "y" + a), (7, a), (8, "q" * 99), (9, "q" * 100 + "w"), (12, "ab" * 200 + b[:99]), (20, b[:150] + a[:101] + b[100:300]), (21, b[:99] + "ß" + a[:99])]
    got = suffix.without_repeats(documents(rows, extra=True)).selectExpr("doc_id", "n_bytes", "aggregate(spans, 0L, (x, s) -> x + s.end - s.start) as r", "cast(size(spans) as bigint) as s", "sha2(kept, 256) as h").collect()
    assert {r["doc_id"]: tuple(r[1:]) for r in got} == bytes_oracle(rows)


def test_repeated_bytes_judged_anchor_by_anchor(documents, prose, monkeypatch):
    monkeypatch.setattr(suffix, "JUDGED_ROWS", 1)
    monkeypatch.setattr(suffix, "BUFFER_ROWS", 50)
    a, b = prose(60, 1), prose(200, 2)
    rows = [(k, prose(20, 100 + k) + b[7 * k:] + a[k:]) for k in range(12)] + [(30, a + a), (31, "q" * 300), (32, "ab" * 200 + b[:99])]
    got = suffix.without_repeats(documents(rows)).selectExpr("doc_id", "n_bytes", "aggregate(spans, 0L, (x, s) -> x + s.end - s.start) as r", "cast(size(spans) as bigint) as s", "sha2(kept, 256) as h").collect()
    assert {r["doc_id"]: tuple(r[1:]) for r in got} == bytes_oracle(rows)


def test_repeated_bytes_with_odd_ids(documents, prose):
    a = prose(60, 1)
    rows = [(None, a), (None, a), (3, a), (3, "other " + a), (2, None)]
    got = suffix.without_repeats(documents(rows)).selectExpr("doc_id", "n_bytes", "size(spans) as s").collect()
    assert len(got) == 5
    assert [r["s"] for r in got if r["doc_id"] is None] == [0, 0] and sorted(r["s"] for r in got if r["doc_id"] == 3) == [1, 1]
    assert suffix.without_repeats(documents(rows).limit(0)).count() == 0


# 10


def test_mixing_meets_targets(labelled):
    docs, labels, _ = labelled
    shares = {"fine": 0.4, "poor": 0.3, "toxic": 0.2, "poor_toxic": 0.1}
    p = mixing.stored(mixing.posteriors(docs, mixing.learn(docs, labels)), "p")
    rate, report = mixing.solve(p, shares, steps=60)
    for d in mixing.DOMAINS:
        assert report["after"][d] == pytest.approx(report["target"][d], rel=0.05)
    assert p.withColumn("r", rate).where("r < 0 or r is null").count() == 0
    out = mixing.apply(docs, labels, shares=shares)
    assert out.columns == [*docs.columns, "mix_rate"] and out.where("mix_rate <= 0").count() == 0
    plain = mixing.apply(docs, labels.limit(0))
    assert plain.count() == docs.count()
    assert mixing.apply(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("poor", [200, 20, 2])
def test_mixing_meets_targets_of_rare_domains(spark, poor):
    """Domains far under and far over their targets, with certain and with unsure posteriors."""
    rows = [(100, *p) for p in [(0.0, 1.0, 0.0, 0.0)] * poor + [(0.0, 0.0, 1.0, 0.0)] * 100 + [(0.0, 0.0, 0.0, 1.0)] * 5 + [(1.0, 0.0, 0.0, 0.0)] * 800 + [(0.9, 0.02, 0.07, 0.01)] * 100]
    p = spark.createDataFrame(rows, "tokens bigint, fine double, poor double, toxic double, poor_toxic double")
    rate, report = mixing.solve(p)
    after = p.withColumn("r", rate).agg(*[F.sum(F.expr(f"r * tokens * {d}")).alias(d) for d in mixing.DOMAINS]).first()
    for d in mixing.DOMAINS:
        assert after[d] == pytest.approx(report["target"][d], rel=0.0101)
    # targets that no rates meet end by themselves and are reported
    alike = p.selectExpr("tokens", *[f"0.25D as {d}" for d in mixing.DOMAINS])
    assert mixing.solve(alike)[1].get("missed")


def least_change(p, tokens, target, rounds=60_000):
    """Non-negative rates closest to 1 that meet the targets, by plain gradient ascent of the multipliers."""
    y = np.zeros(p.shape[1])
    for _ in range(rounds):
        r = np.maximum(1 - p @ y, 0)
        y += 0.5 * ((r * tokens) @ p - target) / tokens.sum()
    return np.maximum(1 - p @ y, 0)


def test_rates_are_the_closest_to_one(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.5, 0.3, 0.3, 0.2], 300)
    tokens = rng.integers(1, 400, 300)
    df = spark.createDataFrame([(k, int(n), *map(float, q)) for k, (n, q) in enumerate(zip(tokens, p))], "k int, tokens bigint, fine double, poor double, toxic double, poor_toxic double")
    shares = {"fine": 0.7, "poor": 0.15, "toxic": 0.1, "poor_toxic": 0.05}
    rate, report = mixing.solve(df, shares, tolerance=1e-4)
    want = least_change(p, tokens.astype(float), np.array(list(shares.values())) * tokens.sum())
    assert [r["r"] for r in df.withColumn("r", rate).orderBy("k").collect()] == pytest.approx(want, abs=2e-3)
    assert not report["missed"] and report["jobs"] <= 12


def test_unreachable_domain_keeps_the_others(spark):
    """A domain spread thinly over all documents cannot be raised: it is named, and no document is lost for it."""
    df = spark.createDataFrame([(100, 0.98, 0.0005, 0.019, 0.0005)] * 90 + [(100, 0.1, 0.0005, 0.899, 0.0005)] * 10, "tokens bigint, fine double, poor double, toxic double, poor_toxic double")
    rate, report = mixing.solve(df, {"fine": 0.9, "poor": 0.08, "toxic": 0.02, "poor_toxic": 0.0})
    assert report["missed"] == ["poor"] and report["jobs"] <= 30
    assert df.withColumn("r", rate).where("fine > 0.9 and r > 0.9").count() == 90


def test_mixing_replaces_its_own_column_and_takes_any_name(labelled):
    docs, labels, _ = labelled
    odd = docs.withColumn("a.b", F.lit(1)).withColumn("mix_rate", F.lit("old")).withColumn("rate", F.lit("mine"))
    out = mixing.apply(odd, labels)
    assert sorted(out.columns) == sorted(odd.columns) and dict(out.dtypes)["mix_rate"] == "double"
