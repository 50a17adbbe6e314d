"""Connected components of a link table by hooking and contraction, all in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.rows import stored


def _flat(parent: DataFrame) -> DataFrame:
    """Follow ``node -> up`` to the top; a chain of any length halves with every step."""
    while True:
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jumped = stored(
            parent.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")),
            "jump",
        )
        parent = jumped.select("node", "up")
        if jumped.where("moved").isEmpty():
            return parent


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` (undirected, any comparable type) to ``node, root``: the least node of each component.

    Every round hooks each node to its least neighbour if that is smaller, flattens the
    resulting trees by pointer jumping and keeps only links between different trees, so the
    link table shrinks to nothing in a logarithmic number of rounds. Minima are combined
    before the shuffle, links of one popular node are split by adaptive skew joins, and every
    round is written to the shared folder. Loops, repeated links and null ends change nothing;
    no links give no rows.
    """
    pairs = links.select("a", "b").where("a is not null and b is not null and a <> b")
    todo = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    nodes = todo.select(F.col("a").alias("node")).unionByName(todo.select(F.col("b").alias("node"))).distinct()
    member = nodes.select("node", F.col("node").alias("root"))
    while not todo.isEmpty():
        parent = _flat(stored(todo.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "hook"))
        member = stored(
            member.join(parent.select(F.col("node").alias("root"), "up"), "root", "left")
            .select("node", F.coalesce("up", "root").alias("root")), "member")
        a, b = (parent.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in "ab")
        todo = stored(
            todo.join(a, "a", "left").join(b, "b", "left")
            .select(F.coalesce("a_up", "a").alias("x"), F.coalesce("b_up", "b").alias("y")).where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    return member
