"""Toxic texts by a subsequence string kernel, Nystroem landmarks and a linear SVM.

*Kernel.* Two strings are alike by the subsequences of ``ORDER`` characters they share, gaps
weighted by ``DECAY`` per character, so an insult with letters put in between or with an ending
still resembles itself. A word holds ``^`` and ``$`` as its ends. Against landmark l the value
is ``K(word, l) / K(l, l)``, at most 1; it is 0 by definition if the word lacks more than a
quarter of the landmark's distinct bytes, which also saves nearly all of the work.

*Units.* What is held against the landmarks are words; runs of ``SPELLED`` or more one-letter words
put together, as an insult spelled with blanks is one; and, for landmarks of two words, spans of two
and three words with their blanks, so that a word put in between is a gap like any other.

*Landmarks* are beginnings of words and whole words that labelled toxic documents hold and
clean ones hardly do, picked greedily until toxic documents hold several each where they can; then
pairs of words that at least ``PHRASE_SUPPORT`` of the toxic documents left without any hold and no
clean one does. ``K_LL ** -1/2`` maps kernel values to Nystroem features.

*Training.* A sentence is as toxic as its strongest unit, a document as its strongest sentence,
and only documents are labelled. So the SVM is trained on the strongest units of labelled
documents: at first the ones nearest to a landmark stand for a toxic document, then, repeatedly,
the one the SVM ranks highest. Scores are calibrated by a logistic fit on the document maxima.

Fitting uses at most ``TRAIN_ROWS`` labelled rows (the first by hash of the id); scoring reads
every text whole, with no shuffle. Labels, ``lang``, ``source`` and ``doc_id`` are no inputs.

Defined cases: null, empty and wordless texts get the score of a text without any resemblance;
without toxic or without clean labels every score is 0; repeated rows are scored alike; an
empty table gives an empty result; other columns are ignored. A word of any length is compared whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.features import list_column, map_texts, sigmoid
from tallyframe.llm.rows import WORD_BREAK, stored, texts, training_rows
from tallyframe.llm.textvec import Words

TRAIN_ROWS = 6_000
ORDER, DECAY = 4, 0.6
LANDMARKS = 64
CANDIDATES = 4_000
COVER = 3  # landmarks wanted for each toxic document
MIN_SUPPORT, MAX_CLEAN = 3, 0.15
PHRASE_SUPPORT = 5
SPELLED = 3
STRONGEST = 8  # units of each labelled document that may stand for it
ROUNDS = 4
CACHE_CELLS = 1 << 20  # values of words that a task remembers

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def kernel(words: np.ndarray, marks: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted subsequence kernel of row k of ``words`` (padded with 0) with row k of ``marks`` (padded with 255)."""
    n, m, pairs = words.shape[1], marks.shape[1], len(words)
    w, l = np.ascontiguousarray(words.T), np.ascontiguousarray(marks.T)
    match = [[(l[a] == w[j]) * np.float32(decay * decay) for j in range(n)] for a in range(m)]
    out = np.zeros(pairs, np.float32)
    before = None  # weights of common subsequences of one character less, by lengths of both beginnings
    for i in range(1, order):
        here = np.zeros((m + 1, n + 1, pairs), np.float32)
        for a in range(i - 1, m):
            run = np.zeros(pairs, np.float32)
            for j in range(i - 1, n):
                run *= np.float32(decay)
                run += match[a][j] if before is None else match[a][j] * before[a, j]
                np.multiply(here[a, j + 1], np.float32(decay), out=here[a + 1, j + 1])
                here[a + 1, j + 1] += run
        before = here
    for a in range(order - 1, m):
        for j in range(order - 1, n):
            out += match[a][j] if before is None else match[a][j] * before[a, j]
    return out


def padded(strings: list[bytes], fill: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in strings], np.int64)
    out = np.full((len(strings), max(lengths.max(initial=1), 1)), fill, np.uint8)
    for k, s in enumerate(strings):
        out[k, :len(s)] = np.frombuffer(s, np.uint8)
    return out, lengths


def letters(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which bytes (modulo 64) each string holds, as bits."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    size = end - begin
    at = np.cumsum(size) - size
    flat = data[np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(at, size)]
    return np.bitwise_or.reduceat(np.uint64(1) << (flat.astype(np.uint64) % np.uint64(64)), at)


class Landmarks:
    """Landmark strings with their kernel and Nystroem map."""

    def __init__(self, strings: list[str]):
        self.strings = strings
        self.marks, self.sizes = padded([s.encode() for s in strings], 255)
        ends = np.cumsum(self.sizes)
        flat = np.concatenate([np.frombuffer(s.encode(), np.uint8) for s in strings]) if strings else np.zeros(0, np.uint8)
        self.bits = letters(flat, ends - self.sizes, ends)
        self.need = np.ceil(np.bitwise_count(self.bits) * 0.75)
        self.phrases = np.array([k for k, s in enumerate(strings) if " " in s], np.int64)
        same, _ = padded([s.encode() for s in strings], 0)
        self.own = kernel(same, self.marks)
        k = len(strings)
        i, j = (v.ravel() for v in np.meshgrid(np.arange(k), np.arange(k), indexing="ij"))
        gram = kernel(same[i], self.marks[j]).reshape(k, k) / np.sqrt(np.outer(self.own, self.own))
        value, vector = np.linalg.eigh((gram + gram.T) / 2)
        self.root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 0.05))) @ vector.T

    #: The marks of both ends as bits.
    edges = np.uint64(1 << (ord("^") % 64)) | np.uint64(1 << (ord("$") % 64))

    def against(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, only: np.ndarray | None = None) -> np.ndarray:
        """Kernel values (strings x landmarks), the strings being byte ranges of ``data`` without their ends; 0 for landmarks not in ``only``."""
        out = np.zeros((len(begin), len(self.strings)), np.float32)
        bits = letters(data, begin, end) | self.edges
        wanted = np.ones(len(self.strings), bool)
        if only is not None:
            wanted[:] = False
            wanted[only] = True
        for low, high in _by_length(end - begin):
            rows = np.flatnonzero((end - begin > low) & (end - begin <= high))
            near = (np.bitwise_count(bits[rows][:, None] & self.bits[None, :]) >= self.need[None, :]) & wanted
            which, mark = np.nonzero(near)
            order = np.argsort(self.sizes[mark], kind="stable")  # landmarks of like length together
            which, mark = which[order], mark[order]
            step = max(1, 600_000 // ((high + 3) * (self.marks.shape[1] + 1)))
            for s in range(0, len(which), step):
                w, m = rows[which[s:s + step]], mark[s:s + step]
                size = end[w] - begin[w]
                box = np.zeros((len(w), high + 2), np.uint8)
                box[:, 0] = ord("^")
                cell = np.arange(high)[None, :]
                inside = cell < size[:, None]
                box[:, 1:-1] = np.where(inside, data[np.minimum(begin[w][:, None] + cell, len(data) - 1)], 0)
                box[np.arange(len(w)), size + 1] = ord("$")
                marks = self.marks[m, :self.sizes[m].max()]
                out[w, m] = np.minimum(kernel(box, marks) / self.own[m], 1)
        return out


def _by_length(size: np.ndarray):
    low, high = 0, 8
    while len(size) and low < size.max():
        yield low, min(high, int(size.max()))
        low, high = high, 2 * high


def _joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, count: np.ndarray, blank: bool) -> tuple[np.ndarray, ...]:
    """Strings made of ``count`` words from word ``first`` on, with blanks between them or without: bytes, begins, ends."""
    owner = np.repeat(np.arange(len(first)), count)
    word = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    size = end[word] - begin[word]
    last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
    room = size + (blank & ~last)
    out = np.full(room.sum(), ord(" "), np.uint8)
    at = np.cumsum(room) - room
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at, size) + place] = data[np.repeat(begin[word], size) + place]
    ends = np.cumsum(np.bincount(owner, room, minlength=len(first)).astype(np.int64))
    return out, np.append(0, ends[:-1]) if len(ends) else ends, ends


class Scorer:
    """Values of the words of text chunks: the kernel values, or their weighted sum if weights are given.

    A word seen before in the task is looked up; the memory starts anew when it is full.
    """

    def __init__(self, landmarks: Landmarks, weights: np.ndarray | None = None):
        self.landmarks, self.weights = landmarks, weights
        self.width = len(landmarks.strings) if weights is None else 1
        self.seen, self.values = np.zeros(0, np.uint64), np.zeros((0, self.width), np.float32)

    def _valued(self, z: np.ndarray) -> np.ndarray:
        return z if self.weights is None else (z @ self.weights)[:, None]

    def spans(self, words: Words, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and values of the units of several words."""
        rows, values = [np.zeros(0, np.int64)], [np.zeros((0, self.width), np.float32)]
        head = np.append(0, np.cumsum((words.data & 0xC0) != 0x80))  # characters, by their first bytes
        one = head[end] - head[begin] == 1
        edge = np.flatnonzero(np.diff(np.concatenate([[False], one, [False]]).astype(np.int8)))
        # runs of one-letter words, cut where a text ends
        start, stop = edge[::2], edge[1::2]
        cuts = words.at[1:-1]
        inner = cuts[(cuts > 0) & (cuts < len(one))]
        inner = inner[one[inner] & one[inner - 1] & (words.row[inner] != words.row[inner - 1])] if len(inner) else inner
        start, stop = np.unique(np.append(start, inner)), np.unique(np.append(stop, inner))
        long = stop - start >= SPELLED
        start, stop = start[long], stop[long]
        for k in range(0, len(start), 1 << 12):
            s, e = start[k:k + (1 << 12)], stop[k:k + (1 << 12)]
            rows.append(words.row[s])
            values.append(self._valued(self.landmarks.against(*_joined(words.data, begin, end, s, e - s, False))))
        pairs = self.landmarks.phrases
        if len(pairs) and len(begin):
            bits = letters(words.data, begin, np.maximum(end, begin + 1)) | self.landmarks.edges | np.uint64(1 << (ord(" ") % 64))
            for count in (2, 3):
                if len(begin) < count:
                    continue
                first = np.flatnonzero(words.row[: len(begin) - count + 1] == words.row[count - 1:])
                all_bits = np.bitwise_or.reduce([bits[first + k] for k in range(count)])
                some = (np.bitwise_count(all_bits[:, None] & self.landmarks.bits[None, pairs]) >= self.landmarks.need[None, pairs]).any(1)
                first = first[some]
                for k in range(0, len(first), 1 << 12):
                    f = first[k:k + (1 << 12)]
                    rows.append(words.row[f])
                    values.append(self._valued(self.landmarks.against(*_joined(words.data, begin, end, f, np.full(len(f), count), True), only=pairs)))
        return np.concatenate(rows), np.concatenate(values)

    def words(self, column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words, their rows of the value table, and that table; rows and values of the units of several words."""
        words = Words(column)
        begin, end = words.begin.copy(), words.end.copy()
        while len(moved := np.flatnonzero((begin < end) & ~_LETTER[words.data[np.minimum(begin, len(words.data) - 1)]])):
            begin[moved] += 1
        while len(moved := np.flatnonzero((begin < end) & ~_LETTER[words.data[end - 1]])):
            end[moved] -= 1
        new, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        at = np.searchsorted(self.seen, new)
        known = at < len(self.seen)
        known[known] = self.seen[at[known]] == new[known]
        fresh = first[~known]
        table = np.zeros((len(new), self.width), np.float32)
        table[known] = self.values[at[known]]
        for k in range(0, len(fresh), 1 << 15):
            part = self.landmarks.against(words.data, begin[fresh[k:k + (1 << 15)]], end[fresh[k:k + (1 << 15)]])
            table[np.flatnonzero(~known)[k:k + (1 << 15)]] = self._valued(part)
        if (len(self.seen) + len(fresh)) * self.width > CACHE_CELLS:
            self.seen, self.values = new, table
        else:
            self.seen = np.insert(self.seen, at[~known], new[~known])
            self.values = np.insert(self.values, at[~known], table[~known], axis=0)
        return words, back, table, *self.spans(words, begin, end)


def _per_row(best: np.ndarray, row: np.ndarray, rows: int, none: float) -> np.ndarray:
    out = np.full(rows, none)
    np.maximum.at(out, row, best)
    return out


def patterns(text: Column) -> Column:
    """Beginnings (4 to 10 characters) and whole words of a text, each once."""
    bare = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]+", "")
    words = F.array_distinct(F.split(bare, WORD_BREAK))
    heads = F.flatten(F.transform(words, lambda w: F.when(
        F.char_length(w) >= 4, F.transform(F.sequence(F.lit(4), F.least(F.char_length(w), F.lit(10))), lambda k: F.concat(F.lit("^"), F.substring(w, F.lit(1), k)))
    ).otherwise(F.array().cast("array<string>"))))
    whole = F.transform(F.filter(words, lambda w: F.char_length(w) >= 3), lambda w: F.concat(F.lit("^"), w, F.lit("$")))
    return F.array_distinct(F.concat(heads, whole))


def phrases(text: Column) -> Column:
    """Pairs of neighbouring words of a text, each once."""
    bare = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]+", "")
    words = F.split(F.btrim(bare), WORD_BREAK)
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
                       lambda a, b: F.concat(F.lit("^"), a, F.lit(" "), b, F.lit("$")))
    return F.array_distinct(F.filter(pairs, lambda p: F.char_length(p) >= 8))


def choose_landmarks(sample: DataFrame, limit: int = LANDMARKS) -> list[str]:
    """Greedy cover of the toxic documents, ``COVER`` times, by telling patterns, the longest of equals; then phrases for the rest."""

    def telling(held: DataFrame, support: int, clean: float) -> DataFrame:
        return stored(
            held.groupBy("pattern").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
            .where((F.col("t") >= support) & (F.col("c") <= clean * F.col("t")))
            .orderBy(F.desc(F.col("t") - 3 * F.col("c")), "pattern").limit(CANDIDATES), "telling")

    def holders(held: DataFrame, found: DataFrame) -> dict[str, tuple[set, int]]:
        # CANDIDATES patterns, each in at most the toxic rows of the bounded sample
        rows = held.where("toxic = 1").join(F.broadcast(found), "pattern").groupBy("pattern", "c").agg(F.collect_set("doc_id").alias("docs")).collect()
        return {r["pattern"]: (set(r["docs"]), r["c"]) for r in rows}

    def pick(docs: dict[str, tuple[set, int]], wanted: dict, chosen: list[str], least: int, free: bool) -> None:
        while docs and len(chosen) < limit:
            gain = {p: sum(wanted[d] > 0 for d in held_by) - COVER * clean for p, (held_by, clean) in docs.items()}
            best = max(docs, key=lambda p: (gain[p], len(p), p))
            if gain[best] < least:
                break
            chosen.append(best)
            for d in docs[best][0]:
                wanted[d] -= 1
            stem = best.strip("^$")  # beginnings and continuations of a landmark say the same
            docs = {p: v for p, v in docs.items() if p != best and (free or not (p.strip("^$").startswith(stem) or stem.startswith(p.strip("^$"))))}

    chosen: list[str] = []
    held = stored(sample.select("doc_id", "toxic", F.explode(patterns(F.col("text"))).alias("pattern")), "patterns")
    docs = holders(held, telling(held, MIN_SUPPORT, MAX_CLEAN))
    wanted = {d: COVER for held_by, _ in docs.values() for d in held_by}
    pick(docs, wanted, chosen, 2, False)
    covered = {d for p in chosen for d in docs[p][0]}
    rest = sample.where((F.col("toxic") == 0) | ~F.col("doc_id").isin(sorted(covered))) if covered else sample
    pairs = stored(rest.select("doc_id", "toxic", F.explode(phrases(F.col("text"))).alias("pattern")), "phrases")
    docs = holders(pairs, telling(pairs, PHRASE_SUPPORT, 0.0))
    pick(docs, {d: 1 for held_by, _ in docs.values() for d in held_by}, chosen, PHRASE_SUPPORT, True)
    return chosen


def svm(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 600) -> np.ndarray:
    """Class-balanced linear SVM with squared hinge loss; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w = v = np.zeros(x.shape[1])
    t, rate = 1.0, 1 / (2 * np.linalg.norm(x * np.sqrt(weight)[:, None], 2) ** 2 + ridge)
    for _ in range(steps):
        slack = np.maximum(1 - y * (x @ v), 0)
        new = v - rate * (-2 * x.T @ (weight * y * slack) + ridge * np.append(v[:-1], 0))
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        w, v = new, new + (old - 1) / t * (new - w)
    return w


def platt(s: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of a logistic fit of ``y`` on ``s``."""
    x, w = np.column_stack([s, np.ones(len(s))]), np.zeros(2)
    for _ in range(60):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(2), x.T @ (y - p) - ridge * w)
        w = w + step * min(1.0, 3 / max(np.abs(step).max(), 1e-12))
    return float(w[0]), float(w[1])


def train(z: np.ndarray, owner: np.ndarray, toxic: np.ndarray, root: np.ndarray) -> dict:
    """SVM over word instances ``z`` of documents ``owner`` with document labels."""
    x = z @ root
    hot = toxic[owner] == 1
    value = z.max(1)
    w = None
    for _ in range(ROUNDS):
        best = np.full(len(toxic), -np.inf)
        np.maximum.at(best, owner[hot], value[hot])
        stands = hot & (value == best[owner]) & (value > (0.5 if w is None else -1))
        use = stands | ~hot
        w = svm(x[use], np.where(stands, 1.0, -1.0)[use])
        value = x @ w[:-1] + w[-1]
    top = _per_row(value, owner, len(toxic), float(w[-1]))
    slope, offset = platt(top, toxic.astype(float))
    return {"weights": root @ w[:-1], "intercept": float(w[-1]), "slope": slope, "offset": offset}


def learn(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> dict | None:
    """Landmarks and model; None without toxic or without clean rows."""
    sample = stored(training_rows(docs, labels, ["toxic"], limit).select("doc_id", "text", "toxic"), "toxic-sample")
    strings = choose_landmarks(sample)
    if not strings or sample.where("toxic = 0").isEmpty():
        return None
    landmarks = Landmarks(strings)

    def strongest(part: pa.RecordBatch) -> pa.RecordBatch:
        scorer = Scorer(landmarks)
        words, back, table, more, extra = scorer.words(part.column("text"))
        row = np.concatenate([words.row, more])
        order = np.lexsort((-np.concatenate([table.max(1)[back], extra.max(1)]), row))
        start = np.append(0, np.cumsum(np.bincount(row, minlength=words.rows)))
        pick = order[np.arange(len(order)) - start[row[order]] < STRONGEST]
        single = pick < len(back)
        z = np.zeros((len(pick), table.shape[1]))
        z[single], z[~single] = table[back[pick[single]]], extra[pick[~single] - len(back)]
        of = pa.array(row[pick])
        return pa.RecordBatch.from_arrays([part.column("doc_id").take(of), part.column("toxic").take(of), list_column(z)], names=["doc_id", "toxic", "z"])

    got = map_texts(sample, strongest, "doc_id bigint, toxic int, z array<double>").toPandas()
    ids, owner = np.unique(got["doc_id"].to_numpy(), return_inverse=True)
    toxic = np.zeros(len(ids), int)
    toxic[owner] = got["toxic"].to_numpy()
    return {"landmarks": strings} | train(np.array(got["z"].tolist()), owner, toxic, landmarks.root)


def scored(docs: DataFrame, model: dict | None) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    rows = texts(docs)
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    scorers: list[Scorer] = []

    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        if not scorers:
            scorers.append(Scorer(Landmarks(model["landmarks"]), model["weights"]))
        words, back, table, more, extra = scorers[0].words(part.column("text"))
        best = _per_row(table[back, 0] + model["intercept"], words.row, words.rows, model["intercept"])
        np.maximum.at(best, more, extra[:, 0] + model["intercept"])
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sigmoid(model["slope"] * best + model["offset"]))], names=["doc_id", "score"])

    return map_texts(rows, fn, "doc_id bigint, score double")

