"""Lookups beyond the plain equi-join.

Every function is built from equi-joins, so Spark chooses broadcast, hash or sort-merge
from the actual sizes and adaptive execution can split skewed partitions. None needs a
nested loop or an all-pairs step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.text import words
from tallyframe.operators import ranges
from tallyframe.operators.latest import latest_by


def star_lookup(facts: DataFrame, dims: list[tuple[DataFrame, Column]]) -> DataFrame:
    """Left-join several dimensions, each unique on its join columns."""
    for dim, on in dims:
        facts = facts.join(dim, on, "left")
    return facts


def validity_join(facts: DataFrame, windows: DataFrame, keys: list[str], day: str,
                  start: str, end: str, how: str = "inner", pairs: DataFrame | None = None) -> DataFrame:
    """Rows of ``facts`` with every window of the same key that covers ``day``.

    The distinct (key, day) pairs are looked up by aligned spans (see ``ranges``), so a window makes some 30
    rows however long it is, and the facts meet the result by equality. ``pairs`` may name a cheaper
    relation that has all keys and days of the facts, where these are costly to derive.
    """
    found = ranges.covering((facts if pairs is None else pairs).select(*keys, day).distinct(), windows, keys, day, start, end)
    on = F.col(day) == F.col("_p_day")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_p_{k}"))
    return facts.join(found.hint("merge"), on, how).drop("_p_day", *[f"_p_{k}" for k in keys])


def wildcard_lookup(facts: DataFrame, rules: DataFrame, exact: dict[str, str], optional: dict[str, str],
                    take: list[str], tie: list[Column] | None = None) -> DataFrame:
    """Attach the most specific matching rule; a NULL rule column matches anything.

    ``exact`` and ``optional`` map rule columns to fact columns; earlier optional columns weigh more when two
    rules fix the same number of them. Rules are told apart by their mask, the set of optional columns they
    fix. A distinct combination of fact values asks once for each mask that occurs among the rules, all
    in one equi-join, and keeps its best hit; the facts then meet the result by equality.
    """
    tie = tie or [F.asc(c) for c in take]
    opt = list(optional)
    bits = [1 << (len(opt) - 1 - k) for k in range(len(opt))]  # earlier columns are higher bits
    mask = reduce(lambda x, y: x + y, [F.when(F.col(c).isNotNull(), b).otherwise(0) for c, b in zip(opt, bits)], F.lit(0))
    masked = rules.select(*exact, *opt, *[c for c in take if c not in exact and c not in opt]).withColumn("_mask", mask)
    one = latest_by(masked, ["_mask", *exact, *opt], tie).select(
        "_mask", *[F.col(c).alias(f"_r_{c}") for c in [*exact, *opt]], F.struct(*take).alias("_rule"))
    masks = masked.agg(F.collect_set("_mask").alias("m")).scalar()  # 2^columns at most
    names = {**exact, **optional}
    asked = facts.select(*[F.col(names[c]).alias(f"_f_{c}") for c in names]).distinct()
    asked = asked.withColumn("_asked", F.explode(masks))
    on = F.col("_asked") == F.col("_mask")
    for c in exact:
        on = on & (F.col(f"_f_{c}") == F.col(f"_r_{c}"))
    for c, b in zip(opt, bits):  # a column that the mask leaves out is NULL on both sides
        on = on & F.when(F.col("_asked").bitwiseAND(b) != 0, F.col(f"_f_{c}")).eqNullSafe(F.col(f"_r_{c}"))
    best = asked.join(one, on).groupBy(*[f"_f_{c}" for c in names]).agg(
        F.max_by("_rule", F.struct(F.bit_count("_mask"), "_mask")).alias("_best"))
    back = None
    for c, f in names.items():
        term = F.col(f).eqNullSafe(F.col(f"_f_{c}"))
        back = term if back is None else back & term
    return facts.join(best, back, "left").select(*facts.columns, *[F.col(f"_best.{c}").alias(c) for c in take])


def either_key_lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_keys: list[str], take: list[str],
                      how_column: str | None = None, same: list[str] | None = None,
                      tie: list[Column] | None = None) -> DataFrame:
    """Attach the dimension row whose first, else second, ... key equals ``fact_key``.

    One equi-join per key replaces a join on ``a = x OR a = y``; earlier keys win, ``tie``
    decides among rows sharing a key. ``same`` lists columns both sides must agree on.
    """
    same = same or []
    out = facts
    hits = []
    for i, k in enumerate(dim_keys):
        side = latest_by(dim.filter(F.col(k).isNotNull()).withColumn("_k", F.col(k).cast("string")), [*same, "_k"],
                         tie or [F.asc(c) for c in take])
        side = side.select(*[F.col(c).alias(f"_s{i}_{c}") for c in same], F.col("_k").alias(f"_k{i}"), F.struct(*take).alias(f"_hit{i}"))
        on = F.col(fact_key).cast("string") == F.col(f"_k{i}")
        for c in same:
            on = on & (F.col(c) == F.col(f"_s{i}_{c}"))
        out = out.join(side, on, "left").drop(f"_k{i}", *[f"_s{i}_{c}" for c in same])
        hits.append(f"_hit{i}")
    cols = [*facts.columns, *[F.col(f"_best.{c}").alias(c) for c in take]]
    if how_column:
        label = None
        for h, k in zip(hits, dim_keys):
            label = (F.when if label is None else label.when)(F.col(h).isNotNull(), F.lit(k))
        cols.append(label.alias(how_column))
    return out.withColumn("_best", F.coalesce(*hits)).select(*cols)


def word_match(items: DataFrame, name: str, labels: DataFrame, label: str) -> DataFrame:
    """Pairs of item and label where the label occurs in the name as whole words.

    The equi-join key is the label's rarest word by its count over all names, so a label that starts with
    a common word brings no more candidates than its rarest word does; a label with a word that no
    name has is done with there. Longer labels are then checked against the whole padded name.
    """
    pad = lambda c: F.concat(F.lit(" "), F.concat_ws(" ", c), F.lit(" "))
    it = items.select(*items.columns, words(name).alias("_w")).select(
        *items.columns, pad(F.col("_w")).alias("_np"),
        F.explode(F.array_distinct("_w")).alias("_tok"))
    texts = labels.select(F.col(label).alias("_label")).distinct().withColumn("_lw", words("_label")).filter(F.size("_lw") > 0)
    often = items.select(F.explode(F.array_distinct(words(name))).alias("_word")).groupBy("_word").agg(F.count(F.lit(1)).alias("_often"))
    asked = texts.select("_label", "_lw", F.explode(F.array_distinct("_lw")).alias("_word")).join(often, "_word", "left")
    key = asked.groupBy("_label", "_lw").agg(
        F.min_by("_word", F.struct("_often", "_word")).alias("_key"), F.count_if(F.col("_often").isNull()).alias("_unknown"))
    key = key.filter("_unknown = 0").select("_label", "_key", pad(F.col("_lw")).alias("_lp"))
    lab = labels.join(key, F.col(label) == F.col("_label")).drop("_label")
    return it.join(lab, (F.col("_tok") == F.col("_key")) & F.contains("_np", "_lp")).select(
        *items.columns, *labels.columns)


def band_lookup(facts: DataFrame, bands: DataFrame, value: Column, bucket: Column, band_bucket: str,
                low: str, high: str, how: str = "left") -> DataFrame:
    """Attach the band of the row's bucket whose closed range holds ``value``; for few bands a bucket.

    Every band of a bucket meets every row of it; ``scans.predecessor_lookup`` is for many.
    """
    return facts.join(bands, (bucket == F.col(band_bucket)) & value.between(F.col(low), F.col(high)), how)


def strict_then_loose(facts: DataFrame, lookup: DataFrame, strict: list[str], loose: list[str],
                      value: str, out: str) -> DataFrame:
    """Value by the full key, else by the shorter key; both sides are folded to one row per key."""
    s = lookup.groupBy(*strict).agg(F.min(value).alias("_strict"))
    l = lookup.groupBy(*loose).agg(F.min(value).alias("_loose"))
    return (facts.join(s, strict, "left").join(l, loose, "left")
            .withColumn(out, F.coalesce("_strict", "_loose")).drop("_strict", "_loose"))


def chained_lookup(facts: DataFrame, steps: list[tuple[str, DataFrame, dict[str, Column]]],
                   value: str, out: str, method: str, default: str = "unmapped") -> DataFrame:
    """Try lookups in turn; a step is only looked at when all earlier ones missed.

    Each step is (label, relation unique on its keys, {relation key: fact expression}).
    """
    res = facts.withColumn(out, F.lit(None).cast("string")).withColumn(method, F.lit(default))
    for i, (label, rel, on) in enumerate(steps):
        side = rel.select(*[F.col(k).alias(f"_s{i}_{k}") for k in on], F.col(value).cast("string").alias(f"_v{i}"))
        cond = F.col(out).isNull()
        for k, expr in on.items():
            cond = cond & (expr == F.col(f"_s{i}_{k}"))
        res = res.join(side, cond, "left").drop(*[f"_s{i}_{k}" for k in on])
        res = (res.withColumn(method, F.when(F.col(f"_v{i}").isNotNull(), F.lit(label)).otherwise(F.col(method)))
               .withColumn(out, F.coalesce(F.col(out), F.col(f"_v{i}"))).drop(f"_v{i}"))
    return res
