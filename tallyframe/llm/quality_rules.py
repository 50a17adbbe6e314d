"""Quality rules by weak supervision: rules vote or abstain, EM finds how far to trust each.

Every rule votes 1 (fine), 0 (poor) or abstains (null) on base measurements of the whole text.
The votes of all documents are counted by pattern, at most 3^rules patterns whatever the
corpus. Expectation-maximisation over that bounded table estimates, for each rule, how often
it says "fine", "poor" or nothing on fine and on poor documents, and the share of fine
documents. A document's posterior is then a sum of log-odds, one per rule, and the document
stays if it is at least one half. No document has to pass every rule.

Everything that touches documents is SQL. The second pass computes the measurements again
instead of joining decisions to texts, so texts are never shuffled.

Defined cases: a null or empty text has no words, fails the base test and is not kept; a null
``doc_id`` is passed on; repeated rows are judged alike; an empty table gives an empty result
(the model then is the prior); any other columns of the input, whatever their names, are
passed on by ``apply``. Time is linear in a text's length except for sorting its repeated
windows, n log n.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.rows import BLANKS, WORD_BREAK, bind, boxed, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
PRIOR = 0.8
EM_ROUNDS = 50
#: Runs of characters that prose does not use; each is taken for one spoilt word.
ODD_RUN = r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D.,;:!?'’\"()-]+"
#: Pseudo-count of every outcome of a rule, so that no probability becomes 0.
SMOOTHING = 1.0
#: Where EM starts: chances that a rule says (poor, fine, nothing) on a poor and on a fine document.
START = {0: (0.4, 0.1, 0.5), 1: (0.02, 0.58, 0.4)}

#: name -> (SQL for "poor", SQL for "fine"); neither: the rule abstains.
RULES: dict[str, tuple[str, str]] = {
    "word_length": ("word_chars < 2 * n_words or word_chars > 14 * n_words", "false"),
    "symbols": ("10 * n_symbols > n_words", "false"),
    "plain_words": ("10 * n_plain < 7 * n_words", "10 * n_plain >= 9 * n_words"),
    "repeats": ("10 * n_repeat_words > 3 * n_words", "false"),
    "variety": ("n_words between 50 and 400 and 4 * n_distinct < n_words", "false"),
    "capitals": ("2 * n_capitals > word_chars", "false"),
    "exclaims": ("5 * n_exclaims > n_words", "false"),
    "lines": ("10 * n_dup_lines > 3 * n_lines", "false"),
    "sentences": ("n_stops * 2 > n_words or n_stops * 200 < n_words", "n_stops * 3 <= n_words and n_stops * 80 >= n_words"),
    "prose": ("false", "5 * n_capitals <= word_chars and 20 * n_symbols <= n_words and 10 * n_repeat_words <= 3 * n_words"
                       " and word_chars between 3 * n_words and 9 * n_words"),
}

#: Hashes of all 3-word windows of ``w``: words 1 and 2, then word 3, zipped side by side.
_WINDOWS = (
    "zip_with(zip_with(slice({w}, 1, size({w}) - 2), slice({w}, 2, size({w}) - 2), (x, y) -> xxhash64(x, y)),"
    " slice({w}, 3, size({w}) - 2), (x, y) -> xxhash64(x, y))"
)
_SORTED = "sort_array(transform({h}, (x, i) -> struct(x as h, i as i)))"
_TWICE = (
    "sort_array(transform(filter({s}, (x, j) -> (j > 0 and {s}[greatest(j - 1, 0)].h = x.h)"
    " or (j < size({s}) - 1 and {s}[least(j + 1, size({s}) - 1)].h = x.h)), x -> x.i))"
)
_COVERED = "aggregate({t}, struct(-3 as p, 0L as n), (a, x) -> struct(x as p, a.n + least(3, x - a.p) as n), a -> a.n)"


def repeat_words(words: str) -> str:
    """SQL: words inside 3-word windows that occur twice or more in the array ``words``.

    Window hashes are sorted with their places; equal neighbours mark the repeated places, and
    the union of their windows is counted in order. Texts without a repeated window skip the sort.
    """
    marked = bind(_SORTED.format(h="hs"), "s", bind(_TWICE.format(s="s"), "t", _COVERED.format(t="t")))
    some = bind(_WINDOWS.format(w="w"), "hs", f"if(size(array_distinct(hs)) = size(hs), 0L, {marked})")
    return bind(words, "w", f"if(size(w) < 4, 0L, {some})")


def measured(docs: DataFrame) -> DataFrame:
    """``row`` (the input row) and the measurements of its text."""
    blanks = F.lit(BLANKS)
    text = F.coalesce(F.col("text"), F.lit(""))
    split = boxed(docs, text=text, body=F.btrim(text, blanks)).select(
        "row", "text",
        F.when(F.col("body") == "", F.array().cast("array<string>")).otherwise(F.split("body", WORD_BREAK)).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, blanks) != "").alias("lines"),
    )
    return split.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(repeat_words("words")).cast("bigint").alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("words") - F.regexp_count("text", F.lit(ODD_RUN))).cast("bigint").alias("n_plain"),
        F.size(F.array_distinct("words")).cast("bigint").alias("n_distinct"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
        F.regexp_count("text", F.lit("!")).cast("bigint").alias("n_exclaims"),
        F.regexp_count("text", F.lit(r"[.!?](?![^\x20\x09-\x0D])")).cast("bigint").alias("n_stops"),
    ).withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))


def vote(rule: str) -> str:
    poor, fine = RULES[rule]
    return f"case when n_words = 0 then null when {poor} then 0 when {fine} then 1 end"


def vote_counts(m: DataFrame) -> DataFrame:
    """Documents per vote pattern: 3^rules rows at most."""
    return m.groupBy(*[F.expr(vote(r)).alias(r) for r in RULES]).agg(F.count("*").alias("n"))


def fit(patterns: list[tuple[tuple[int | None, ...], int]], rounds: int = EM_ROUNDS) -> dict:
    """EM over counted vote patterns: share of fine documents, P(poor, fine, nothing | class) of each rule."""
    patterns = sorted(([2 if v is None else v for v in votes], n) for votes, n in patterns)
    model = {"share": PRIOR, "says": {c: [START[c]] * len(RULES) for c in (0, 1)}}
    for _ in range(rounds):
        seen = {c: [[SMOOTHING] * 3 for _ in RULES] for c in (0, 1)}
        fine = total = 0.0
        for votes, n in patterns:
            odds = math.log(model["share"] / (1 - model["share"])) + sum(w[v] for w, v in zip(weights(model), votes))
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            fine, total = fine + n * p, total + n
            for k, v in enumerate(votes):
                seen[1][k][v] += n * p
                seen[0][k][v] += n * (1 - p)
        model = {"share": (fine + SMOOTHING) / (total + 2 * SMOOTHING) if total else PRIOR,
                 "says": {c: [[x / sum(k) for x in k] for k in seen[c]] for c in (0, 1)}}
    return model


def weights(model: dict) -> list[list[float]]:
    """Log-odds for "fine" of each rule's three outcomes: poor, fine, nothing."""
    return [[math.log(a / b) for a, b in zip(fine, poor)] for fine, poor in zip(model["says"][1], model["says"][0])]


def learn(m: DataFrame) -> dict:
    """The model of a measured corpus (best a stored one, as every vote reads several measurements);
    only the pattern counts reach the driver."""
    return fit([(tuple(r[:-1]), r["n"]) for r in vote_counts(m).collect()])


def posterior(model: dict) -> Column:
    """P(fine) of a measured row as an expression over its votes."""
    odds = F.lit(math.log(model["share"] / (1 - model["share"])))
    for rule, (poor, fine, none) in zip(RULES, weights(model)):
        v = F.expr(vote(rule))
        odds = odds + F.when(v == 0, poor).when(v == 1, fine).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def judged(docs: DataFrame, model: dict) -> DataFrame:
    """Measurements, posterior and verdict of every row of ``docs``.

    The measurements of a row pass through a generator of one element: filters on the verdict stay
    above it, so that votes read finished numbers instead of repeating their expressions.
    """
    m = measured(docs)
    numbers = F.struct(*[c for c in m.columns if c != "row"])
    once = m.select("row", F.explode(F.array(numbers)).alias("m")).select("row", "m.*")
    return once.withColumn("posterior", posterior(model)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def apply(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns they came with."""
    model = model or learn(stored(measured(docs).drop("row"), "measured"))
    return judged(docs, model).where("kept").select("row.*")
