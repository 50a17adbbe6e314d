"""Mixing with soft membership: document rates whose expected domain tokens meet targets.

*Domains* are the classes of the label table: fine, poor, toxic, and poor and toxic. A softmax
classifier, fitted on at most ``TRAIN_ROWS`` labelled rows, gives every document a posterior
``p`` over them, so a document is a member of each domain to a degree.

*Rates.* With ``n_i`` tokens and rates ``r_i >= 0`` the expected tokens of domain d are ``E_d =
sum_i r_i n_i p_id``. Minimised is ``1/2 sum_d (E_d - target_d)^2 / target_d`` plus ``RIDGE / 2 sum_i
n_i (r_i - 1)^2``, so that of all rates that meet the targets those closest to 1 are taken. Every
projected-gradient step moves all rates against the gradient, which for document i is ``p_i`` times one
number per domain; the moves are added up in ``y`` and the sum is projected: ``r_i = max(0, 1 - p_i
y)``. The step is scaled by the curvature over the documents with positive rates, and one
aggregation over all documents tries all ``LENGTHS`` step lengths at once and returns a few numbers
for each, so a step is one job and no job repeats earlier moves. Steps end when the gradient is
below ``TOLERANCE / 10`` of every target (or after ``STEPS``). Domains that then stay below their
targets by more than ``TOLERANCE`` cannot be met together with the others: chasing them would put
all weight on a handful of documents, so they lose their say and the rates are fitted for the rest.
``solve`` reports the expected tokens and names these domains, and ``mixed`` warns of them.

Targets are ``TARGETS`` shares of the corpus' own number of tokens. When a domain has no say, as also
one without a single expected token, the other shares are scaled up.

Defined cases: null and empty texts have 0 tokens and a rate like any other row; without labels
every posterior is uniform; repeated rows get equal rates; a null ``doc_id`` is passed on; an
empty table gives an empty result; other columns, whatever their names, are passed on, but for a
``mix_rate`` of the input, which the new one replaces.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.features import dense, map_texts
from tallyframe.llm.rows import boxed, stored, texts, training_rows
from tallyframe.llm.textvec import Words, multiset

TRAIN_ROWS = 20_000
BUCKETS = 1 << 18
MIN_SUPPORT = 4
DOMAINS = ["fine", "poor", "toxic", "poor_toxic"]
TARGETS = {"fine": 0.90, "poor": 0.08, "toxic": 0.015, "poor_toxic": 0.005}
RIDGE = 1e-6
TOLERANCE = 0.01
STEPS = 25
LENGTHS = [2.0**-k for k in range(24)]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def buckets_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word buckets of each text, with the row."""
    h, row, _ = multiset(words.hash % np.uint64(BUCKETS), words.row)
    return h.astype(np.int64), row


def evidence(table: np.ndarray, words: Words) -> np.ndarray:
    """Per text and domain the strongest word weight."""
    b, row = buckets_of(words)
    out = np.zeros((words.rows, table.shape[1]))
    np.maximum.at(out, row, table[b])
    return out


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, ridge: float = 1e-3, steps: int = 400) -> np.ndarray:
    """Multinomial logistic regression by accelerated gradient descent; the last row is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w, v, t = np.zeros((x.shape[1], classes)), np.zeros((x.shape[1], classes)), 1.0
    rate = 1 / (0.5 * np.linalg.norm(x, 2) ** 2 / len(x) + ridge)
    onehot = np.eye(classes)[y]
    for _ in range(steps):
        new = v - rate * (x.T @ (softmax(x @ v) - onehot) / len(x) + ridge * v)
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        w, v = new, new + (old - 1) / t * (new - w)
    return w


def _sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``doc_id``, ``domain``, features ``x`` and distinct word buckets ``words`` of the labelled rows."""

    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"))
        b, row = buckets_of(words)
        ends = np.append(0, np.cumsum(np.bincount(row, minlength=words.rows)))
        own = [b[ends[k]:ends[k + 1]].astype(np.int32).tobytes() for k in range(words.rows)]
        x = dense(Words(part.column("text"), lower=False))
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("domain"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(own, pa.binary())],
            names=["doc_id", "domain", "x", "words"])

    rows = training_rows(docs, labels, ["quality", "toxic"], limit).select(
        "doc_id", "text", F.expr("if(quality = 1, 0, 1) + if(toxic = 1, 2, 0)").cast("int").alias("domain"))
    return stored(map_texts(rows, fn, "doc_id bigint, domain int, x binary, words binary"), "mixing-sample")


def _bucket_counts(sample: DataFrame) -> DataFrame:
    """Toxic (``hot``) and other (``cold``) documents per word bucket, of buckets with support: at most ``BUCKETS`` rows."""

    def fn(batches):
        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for domain, own in zip(batch.column("domain").to_pylist(), batch.column("words").to_pylist()):
                seen[0 if domain >= 2 else 1, np.frombuffer(own, np.int32)] += 1
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(v[at]) for v in seen]], names=["bucket", "hot", "cold"])

    return sample.select("domain", "words").mapInArrow(fn, "bucket bigint, hot bigint, cold bigint").groupBy("bucket").agg(
        F.sum("hot").alias("hot"), F.sum("cold").alias("cold")).where(f"hot >= {MIN_SUPPORT}")


def learn(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> dict | None:
    """Classifier of the label table's domains; None if there is nothing to learn from.

    What reaches the driver is a row of features per labelled document and one of counts per bucket.
    """
    sample = _sample(docs, labels, limit)
    counts = _bucket_counts(sample).toPandas()
    domains = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().collect()}
    if not domains:
        return None
    # toxic against clean words; quality shows in the dense features
    n_hot, n_cold = (max(sum(n for d, n in domains.items() if (d >= 2) == hot), 1) for hot in (True, False))
    table = np.zeros(BUCKETS, np.float32)
    table[counts["bucket"]] = np.maximum(np.log((counts["hot"] + 0.5) / n_hot) - np.log((counts["cold"] + 0.5) / n_cold), 0)

    def strongest(batches):
        for batch in batches:
            most = [float(table[np.frombuffer(own, np.int32)].max(initial=0)) for own in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "domain", "x")], pa.array(most, pa.float64())], names=["doc_id", "domain", "x", "most"])

    rows = sample.mapInArrow(strongest, "doc_id bigint, domain int, x binary, most double").toPandas().sort_values(["doc_id", "x"])
    x = np.vstack([np.frombuffer(r) for r in rows["x"]])
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([(x - mean) / scale, rows["most"]])
    return {"mean": mean, "scale": scale, "table": table[:, None], "w": fit_softmax(z, rows["domain"].to_numpy(), len(DOMAINS))}


def posteriors(docs: DataFrame, model: dict | None) -> DataFrame:
    """``doc_id``, ``thash``, ``tokens`` and ``p``, the domain posteriors, of every row."""
    k = len(DOMAINS)

    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"))
        if model is None:
            p = np.full((words.rows, k), 1 / k)
        else:
            x = dense(Words(part.column("text"), lower=False))
            z = np.column_stack([(x - model["mean"]) / model["scale"], evidence(model["table"], words), np.ones(words.rows)])
            p = softmax(z @ model["w"])
        arrays = [part.column("doc_id"), part.column("thash"), pa.array(words.count), *[pa.array(p[:, i]) for i in range(k)]]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "thash", "tokens", *DOMAINS])

    kept = ", ".join(f"{d} double" for d in DOMAINS)
    return map_texts(texts(docs).withColumn("thash", F.xxhash64("text")), fn, f"doc_id bigint, thash bigint, tokens bigint, {kept}")


def rate(y: np.ndarray) -> Column:
    """Projection of the added moves: ``max(0, 1 - p y)``."""
    pull = " + ".join(f"{d} * {float(v)!r}D" for d, v in zip(DOMAINS, y))
    return F.expr(f"greatest(0D, 1D - ({pull}))")


def expected(p: DataFrame, ys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``ys``, in one aggregation over all documents: half the squared rates, the expected
    tokens per domain, and the tokens per two domains of documents with a positive rate."""
    k, n = len(DOMAINS), len(ys)
    names = [f"s{i}" for i in range(1 + k + k * k)]

    def fn(batches):
        total = np.zeros((n, len(names)))
        for batch in batches:
            q = np.column_stack([batch.column(d).to_numpy() for d in DOMAINS])
            tokens = batch.column("tokens").to_numpy().astype(float)
            r = np.maximum(1 - q @ ys.T, 0)
            both = (q[:, :, None] * q[:, None, :]).reshape(len(q), k * k)
            total += np.column_stack([(tokens @ r**2 / 2), (r * tokens[:, None]).T @ q, ((r > 0) * tokens[:, None]).T @ both])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), *[pa.array(c) for c in np.ascontiguousarray(total.T)]], names=["i", *names])

    sums = p.select("tokens", *DOMAINS).mapInArrow(fn, "i bigint, " + ", ".join(f"{s} double" for s in names))
    out = np.zeros((n, len(names)))
    for row in sums.groupBy("i").agg(*[F.sum(s).alias(s) for s in names]).collect():
        out[row["i"]] = row[1:]
    return out[:, 0], out[:, 1:k + 1], out[:, k + 1:].reshape(n, k, k)


def fitted(p: DataFrame, start: tuple, target: np.ndarray, steps: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Added moves, expected tokens and jobs of the fit to the targets above 0; ``start`` is ``expected`` at no move."""
    y, (_, now, both), jobs = np.zeros(len(DOMAINS)), start, 0
    asked = np.flatnonzero(target > 0)
    root = np.sqrt(target[asked])
    while len(asked) and jobs < steps:
        gap = (now - target - RIDGE * target * y)[asked]
        if (np.abs(gap) / target[asked]).max() <= tolerance / 10:
            break
        curve = both[np.ix_(asked, asked)] / root[:, None] / root + RIDGE * np.eye(len(asked))
        step = np.zeros_like(y)
        step[asked] = np.linalg.solve(curve, gap / root) / root
        ys = y + np.array(LENGTHS)[:, None] * step
        half, means, curves = expected(p, ys)
        jobs += 1
        # the least of the dual objective, of which `gap` is the downward slope
        best = int(np.argmin(half + ys @ target + RIDGE / 2 * ys**2 @ target))
        y, now, both = ys[best], means[best], curves[best]
    return y, now, jobs


def solve(p: DataFrame, shares: dict[str, float] = TARGETS, steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[Column, dict]:
    """The rate column and a report of targets, expected tokens, ``missed`` domains and ``jobs``, the aggregations taken."""
    start = tuple(v[0] for v in expected(p, np.zeros((1, len(DOMAINS)))))
    before, jobs, missed = start[1], 1, []
    share = np.array([shares[d] if a > 0 else 0.0 for d, a in zip(DOMAINS, before)])
    while True:
        target = share / share.sum() * before.sum() if share.sum() else share
        y, after, more = fitted(p, start, target, steps, tolerance)
        jobs += more
        short = (target > 0) & (after < (1 - tolerance) * target)
        if not short.any():
            break
        missed += [d for d, out in zip(DOMAINS, short) if out]
        share = np.where(short, 0.0, share)
    missed += [d for d, t, e in zip(DOMAINS, target, after) if t > 0 and e > (1 + tolerance) * t]
    named = lambda v: {d: float(x) for d, x in zip(DOMAINS, v)}
    return rate(y), {"target": named(target), "before": named(before), "after": named(after), "missed": missed, "jobs": jobs}


def mixed(docs: DataFrame, labels: DataFrame, shares: dict[str, float] = TARGETS) -> DataFrame:
    """``doc_id``, ``thash``, ``tokens``, domain posteriors and ``rate`` of every row of ``docs``."""
    p = stored(posteriors(docs, learn(docs, labels)), "posteriors")
    rates, report = solve(p, shares)
    if report["missed"]:
        logging.getLogger(__name__).warning("mixing targets not met for %s: %s", ", ".join(report["missed"]), report)
    return p.withColumn("rate", rates)


def apply(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents with a positive rate, with their columns and ``mix_rate``, the times to draw each."""
    rates = mixed(docs, labels, **options).where("rate > 0").select("doc_id", "thash", "rate").distinct()
    rates = rates.select(F.col("doc_id").alias("mix_doc"), F.col("thash").alias("mix_hash"), "rate")
    kept = docs.drop("mix_rate")
    rows = boxed(kept, d=F.col("doc_id").cast("bigint"), h=F.xxhash64(F.coalesce("text", F.lit(""))))
    return rows.join(rates, F.col("d").eqNullSafe(F.col("mix_doc")) & (F.col("h") == F.col("mix_hash"))).select("row.*", F.col("rate").alias("mix_rate"))
