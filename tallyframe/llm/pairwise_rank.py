"""Quality scores by Bradley-Terry ranking of preference pairs.

A document labelled 1 is preferred to one labelled 0. With scores ``s(x) = w . x`` the chance
that i beats j is ``sigmoid(s(x_i) - s(x_j))``, so ``w`` is a logistic regression without
intercept on feature differences of the pairs. The score that cuts off the labelled share of
0 among the sample's scores (a quantile) becomes probability ``CUT``.

Fitting uses at most ``TRAIN_ROWS`` labelled rows (the first by hash of the id) and
``PAIRS_PER_ROW`` pairs for each row of the rarer label; these two bounds are parameters and
the only thing that reaches the driver. Scoring reads every text whole, without a shuffle.
Labels, ``lang``, ``source`` and ``doc_id`` are never features.

Defined cases: null and empty texts are scored as texts without words; without both labels
all weights are 0 and every score is ``CUT``; repeated rows are scored alike and count as one
label row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyframe.llm.features import NAMES, dense, featured, map_texts, sigmoid
from tallyframe.llm.rows import texts, training_rows
from tallyframe.llm.textvec import Words

TRAIN_ROWS = 20_000
PAIRS_PER_ROW = 40
RIDGE = 1.0
CUT = 0.3


def preference_pairs(y: np.ndarray, per_row: int = PAIRS_PER_ROW, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (preferred, other): ``per_row`` random partners for each row of the rarer label."""
    good, poor = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(poor):
        return np.zeros(0, int), np.zeros(0, int)
    rng = np.random.default_rng(seed)
    few, many = (poor, good) if len(poor) <= len(good) else (good, poor)
    a, b = np.repeat(few, per_row), rng.choice(many, len(few) * per_row)
    return (b, a) if few is poor else (a, b)


def bradley_terry(d: np.ndarray, ridge: float = RIDGE, rounds: int = 50) -> np.ndarray:
    """Weights that minimise the logistic loss of ``d . w > 0`` with a ridge (Newton's method)."""
    w = np.zeros(d.shape[1])
    for _ in range(rounds):
        p = sigmoid(-d @ w)
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w)), d.T @ p - ridge * w)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray, cut: float = CUT) -> dict:
    """Scaling, weights and offset of the score."""
    if not len(y):
        x = np.zeros((1, len(NAMES)))
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (x - mean) / scale
    a, b = preference_pairs(y)
    w = bradley_terry(z[a] - z[b]) if len(a) else np.zeros(x.shape[1])
    raw = z @ w
    offset = float(np.quantile(raw, np.mean(y == 0))) if len(a) else 0.0
    return {"mean": mean, "scale": scale, "w": w, "offset": offset, "logit": float(np.log(cut / (1 - cut)))}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    return sigmoid((x - model["mean"]) / model["scale"] @ model["w"] - model["offset"] + model["logit"])


def learn(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> dict:
    sample = featured(training_rows(docs, labels, ["quality"], limit), ["doc_id", "quality"]).toPandas()
    sample = sample.sort_values("doc_id")
    x = np.array(sample["x"].tolist(), dtype=float).reshape(len(sample), len(NAMES))
    return fit(x, sample["quality"].to_numpy(dtype=int))


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""

    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        s = score(model, dense(Words(part.column("text"), lower=False)))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    return map_texts(texts(docs), fn, "doc_id bigint, score double")
