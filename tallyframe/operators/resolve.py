"""Attribute resolution: windows, dominant values, entity groups, inferred members."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.operators.aggregates import distinct_samples, only_value
from tallyframe.operators.latest import latest_by
from tallyframe.operators.ranges import covering


def resolve_by_window(facts: DataFrame, windows: DataFrame, keys: list[str], segment: str, day: str,
                      start: str, end: str, window_segment: str, take: list[str], rule: str | None = None) -> DataFrame:
    """Window value per row: the segment's own window before the default, then the newest.

    Resolution runs on distinct combinations: (keys, segment, day) meets only windows of its
    own segment, (keys, day) only the default ones, both by equi-join, so the segments and
    windows of a key are never paired. The results go back by equi-join. A row without a
    segment takes the default. ``rule`` names a column that tells which of the two gave the value.
    """

    def newest(need: DataFrame, some: DataFrame, on: list[str], name: str) -> DataFrame:
        cand = covering(need, some, on, day, start, end).withColumnsRenamed({**{f"_p_{k}": k for k in on}, "_p_day": day})
        best = latest_by(cand, [*on, day], [F.desc(start), *[F.asc(c) for c in take]])
        return best.select(*on, day, F.struct(*take).alias(name))

    special = windows.filter(F.col(window_segment).isNotNull()).select(
        *[c for c in windows.columns if c != segment], F.col(window_segment).alias(segment))
    default = windows.filter(F.col(window_segment).isNull())
    own = newest(facts.select(*keys, segment, day).filter(F.col(segment).isNotNull()).distinct(), special, [*keys, segment], "_own")
    base = newest(facts.select(*keys, day).distinct(), default, keys, "_base")
    both = facts.join(own.hint("merge"), [*keys, segment, day], "left").join(base.hint("merge"), [*keys, day], "left")
    value = F.coalesce("_own", "_base")
    which = [F.when(F.col("_own").isNotNull(), "segment").when(F.col("_base").isNotNull(), "default").otherwise("none").alias(rule)] if rule else []
    return both.select(*[F.col(c) for c in facts.columns], *[value[c].alias(c) for c in take], *which)


def current_member(windows: DataFrame, keys: list[str], as_of: Column, start: str, end: str,
                   preference: list[Column]) -> DataFrame:
    """The window of each key valid on ``as_of``: preference first, then the newest."""
    live = windows.filter((F.col(start) <= as_of) & (F.col(end).isNull() | (F.col(end) >= as_of)))
    return latest_by(live, keys, [*preference, F.desc(start)])


def rollup_lines(lines: DataFrame, by: list[str], amount: str, position: str) -> DataFrame:
    """Amount, count and first position per group: the measures a dominant value is chosen by."""
    return lines.groupBy(*by).agg(F.sum(amount).alias("amount_sum"), F.count(F.lit(1)).alias("line_count"),
                                  F.min(position).alias("first_position"))


def dominant(rollup: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Value with the largest amount, then count, then earliest line."""
    return latest_by(rollup.filter(F.col(value).isNotNull()), keys,
                     [F.desc("amount_sum"), F.desc("line_count"), F.asc("first_position"), F.asc(value)])


def header_value(lines: DataFrame, header: str, value: str, amount: str, position: str, material: Column,
                 ancillary: Column, hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Header attribute from its lines.

    Ancillary lines take the dominant value of the material goods lines. The header gets
    the value when all material lines agree, else NULL plus a representative; a header
    without material lines gets a row with zero counts. Lines are folded to (header, value,
    ancillary, material) once; everything after works on that rollup, which ``hold`` may
    store because it is read several times.
    """
    base = lines.withColumn("_anc", ancillary).withColumn("_mat", F.coalesce(material, F.lit(False)))
    held = hold(rollup_lines(base, [header, value, "_anc", "_mat"], amount, position))
    roll = held.filter("_mat").drop("_mat")
    goods = dominant(roll.filter(~F.col("_anc")), [header], value).select(header, F.col(value).alias("_goods"))
    eff = roll.join(goods, header, "left").withColumn(
        "_eff", F.when(F.col("_anc"), F.coalesce("_goods", value)).otherwise(F.col(value)))
    merged = eff.groupBy(header, "_eff").agg(
        F.sum("amount_sum").alias("amount_sum"), F.sum("line_count").alias("line_count"),
        F.min("first_position").alias("first_position"))
    stats = merged.groupBy(header).agg(
        F.sum("line_count").alias("material_lines"),
        F.coalesce(F.sum(F.when(F.col("_eff").isNull(), F.col("line_count"))), F.lit(0)).alias("unresolved_lines"),
        F.count("_eff").alias("value_count"))
    top = dominant(merged, [header], "_eff").select(header, F.col("_eff").alias("representative"))
    counts = ["material_lines", "unresolved_lines", "value_count"]
    out = held.select(header).distinct().join(stats, header, "left").join(top, header, "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in counts})
    agreed = (F.col("unresolved_lines") == 0) & (F.col("value_count") == 1)
    method = (F.when(F.col("material_lines") == 0, "no_material_lines").when(F.col("unresolved_lines") > 0, "unresolved_lines")
              .when(F.col("value_count") == 1, "unanimous").otherwise("multiple_values"))
    return out.withColumn("agreed_value", F.when(agreed, F.col("representative"))).withColumn("selection_method", method)


def match_key(corporate_id: Column, name: Column, country: Column, singleton: Column) -> tuple[Column, Column]:
    """Method and value of the entity group: corporate id, else name and country, else the tenant's own customer."""
    by_name = name.isNotNull() & country.isNotNull()
    method = F.when(corporate_id.isNotNull(), "corporate_id").when(by_name, "name_country").otherwise("tenant_customer")
    value = (F.when(corporate_id.isNotNull(), corporate_id)
             .when(by_name, F.concat(country, F.lit("|"), name)).otherwise(singleton))
    return method, value


# Match methods and their confidence.
MATCH_CONFIDENCE = {"corporate_id": "high", "name_country": "medium", "tenant_customer": "low"}


def match_confidence(method: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in MATCH_CONFIDENCE.items() for x in kv]), method)


def group_entities(members: DataFrame, group: list[str], tenant: str, attribute: str, member: str, name: str,
                   order: list[Column], samples: int = 8) -> DataFrame:
    """One row per entity group: metrics, the attribute if unique, representative, name samples.

    The representative is the member with the smallest ``order``.
    """
    m = members.groupBy(*group).agg(
        F.count(F.lit(1)).alias("member_count"), F.count_distinct(tenant).alias("tenant_count"),
        F.count(attribute).alias("attribute_count"), F.count_distinct(attribute).alias("distinct_attributes"),
        only_value(attribute).alias("unified_attribute"),
        F.min_by(member, F.struct(*order)).alias("representative"))
    few = distinct_samples(members, group, name, samples, "sample_names")
    return m.join(few, group, "left").select(
        "*", (F.col("tenant_count") > 1).alias("is_cross_tenant"),
        ((F.col("tenant_count") > 1) & (F.col("distinct_attributes") == 1)).alias("has_safe_attribute"))


def propagate(members: DataFrame, group: str, tenant: str, attribute: str, codebook: DataFrame) -> DataFrame:
    """Candidates for members without the attribute: unique in a cross-tenant group and
    known in the member's own tenant (``codebook``: tenant, attribute)."""
    safe = (
        members.filter(F.col(group).isNotNull()).groupBy(group)
        .agg(F.count_distinct(tenant).alias("group_tenants"), F.count(attribute).alias("supporting_members"),
             only_value(attribute).alias("candidate"))
        .filter((F.col("group_tenants") > 1) & (F.col("supporting_members") > 0) & F.col("candidate").isNotNull())
    )
    missing = members.filter(F.col(attribute).isNull()).drop(attribute)
    allowed = codebook.select(F.col(tenant), F.col(attribute).alias("candidate")).distinct()
    return missing.join(safe, group).join(allowed, [tenant, "candidate"], "left_semi")


def infer_members(master: DataFrame, refs: list[DataFrame], keys: list[str], updated: str,
                  priority: str = "source_priority") -> DataFrame:
    """Members the facts mention but the master lacks: best source first, then newest."""
    all_refs = refs[0]
    for r in refs[1:]:
        all_refs = all_refs.unionByName(r)
    missing = all_refs.join(master.select(*keys), keys, "left_anti")
    return latest_by(missing, keys, [F.asc(priority), F.desc_nulls_last(updated)])


def zero_sentinels(codes: DataFrame, master: DataFrame, keys: list[str], code: str) -> DataFrame:
    """Zero-only codes in use that the master does not list."""
    return codes.filter(F.col(code).rlike("^0+$")).select(*keys).distinct().join(master.select(*keys), keys, "left_anti")
