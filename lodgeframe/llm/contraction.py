"""Sums over all subtrees of a forest by parallel tree contraction.

Each round first rakes: every leaf hands its sum to its parent and leaves. Then it compresses: in a chain of nodes with
one child each, nodes that no neighbour in the chain is leaving beside are taken out, chosen by a hash of node and
round; the child is hung one higher and carries what it passed. A round takes a constant share of all nodes out, so the
number of rounds grows with the logarithm of the nodes, whatever the depth. A raked node's subtree sum is known when it
leaves. A node taken out of a chain knows its own part and its child; re-expansion goes through the rounds backwards,
so that the child's answer is known, and replaces pointers by sums.

A round is one pass with two shuffles and no join: each node sends itself on and a message to its parent or child, and
messages are summed by their target with a combine before the shuffle, so a parent of many children is not hot. What
became of the nodes of a round is one checkpoint.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.session import cut_lineage


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(node, values): for each node the sums of ``values`` (bigint) over itself and all below.

    ``nodes`` is (node, parent, values), a forest: names unique, ``parent`` NULL for roots and else the name of a row.
    Works for any type of name that can be grouped by. An empty input gives no rows.
    """
    kind = nodes.schema["node"].dataType
    nothing, zero = F.lit(None).cast(kind), F.lit(0).cast("bigint")
    ups = [f"_up_{v}" for v in values]

    def counted(rows: DataFrame) -> DataFrame:
        """``rows`` (node, parent, values, ups) with the number of their children."""
        own = F.struct("node", "parent", *values, *ups, F.lit(True).alias("_own"), zero.alias("_kids"))
        child = F.struct(
            F.col("parent").alias("node"), nothing.alias("parent"), *[zero.alias(c) for c in (*values, *ups)], F.lit(None).cast("boolean").alias("_own"),
            F.lit(1).cast("bigint").alias("_kids"),
        )
        sent = rows.select(F.inline(F.when(F.col("parent").isNull(), F.array(own)).otherwise(F.array(own, child))))
        return sent.groupBy("node").agg(F.max("parent").alias("parent"), *[F.sum(c).alias(c) for c in (*values, *ups)], F.sum("_kids").alias("_kids"))

    def coin(node: Column) -> Column:
        return F.pmod(F.xxhash64(node, F.lit(turn)), F.lit(2))

    now = counted(nodes.select("node", "parent", *values, *[zero.alias(c) for c in ups]))
    gone: list[tuple[DataFrame, int]] = []
    turn = 0
    while True:
        # Every node sends itself on, and to its parent either its sum (leaves, which are raked) or its name.
        leaf = F.col("_kids") == 0
        own = F.struct("node", "parent", *values, *ups, leaf.alias("_leaf"), nothing.alias("_kid"), zero.alias("_left"))
        up = F.struct(
            F.col("parent").alias("node"), nothing.alias("parent"), *[F.when(leaf, F.col(v) + F.col(u)).otherwise(zero).alias(v) for v, u in zip(values, ups)],
            *[zero.alias(u) for u in ups], F.lit(None).cast("boolean").alias("_leaf"), F.when(leaf, nothing).otherwise(F.col("node")).alias("_kid"),
            F.when(leaf, zero).otherwise(F.lit(1)).cast("bigint").alias("_left"),
        )
        sent = now.select(F.inline(F.when(F.col("parent").isNull(), F.array(own)).otherwise(F.array(own, up))))
        raked = sent.groupBy("node").agg(
            F.max("parent").alias("parent"), *[F.sum(c).alias(c) for c in (*values, *ups)], F.max("_leaf").alias("_leaf"), F.max("_kid").alias("_kid"),
            F.sum("_left").alias("_kids"),
        )
        # A node with one child left goes if its coin shows heads and its child's shows tails: never two in a row.
        out = ~F.col("_leaf") & (F.col("_kids") == 1) & F.col("parent").isNotNull() & (coin(F.col("node")) == 1) & (coin(F.col("_kid")) == 0)
        chosen = raked.withColumn("_out", out)
        own = F.struct(
            "node", "parent", *values, *ups, "_kids", F.when(F.col("_leaf"), "raked").when(F.col("_out"), "out").otherwise("left").alias("_state"),
            nothing.alias("_grand"), nothing.alias("_gone"), *[zero.alias(f"_part_{v}") for v in values],
        )
        # The child of one that goes hangs one higher, and keeps what lies between its former parent and itself.
        down = F.struct(
            F.col("_kid").alias("node"), nothing.alias("parent"), *[zero.alias(v) for v in values],
            *[(F.col(v) + F.col(u)).alias(u) for v, u in zip(values, ups)], zero.alias("_kids"), F.lit(None).cast("string").alias("_state"),
            F.col("parent").alias("_grand"), F.col("node").alias("_gone"), *[F.col(v).alias(f"_part_{v}") for v in values],
        )
        sent = chosen.select(F.inline(F.when(F.col("_out"), F.array(own, down)).otherwise(F.array(own))))
        carried = [F.sum(F.when(F.col("_state").isNotNull(), F.col(u))).alias(f"_was_{u}") for u in ups]
        done = sent.groupBy("node").agg(
            F.coalesce(F.max("_grand"), F.max("parent")).alias("parent"), *[F.sum(c).alias(c) for c in (*values, *ups)], F.sum("_kids").alias("_kids"),
            F.max("_state").alias("_state"), F.max("_gone").alias("_gone"), *[F.sum(f"_part_{v}").alias(f"_part_{v}") for v in values], *carried,
        )
        done = cut_lineage(done)
        counts = {r["_state"]: r["count"] for r in done.groupBy("_state").count().collect()}
        gone.append((done, counts.get("out", 0)))
        now = done.where(F.col("_state") == "left").select("node", "parent", *values, *ups, "_kids")
        turn += 1
        if not counts.get("left"):
            break

    known = reduce(DataFrame.unionByName, [g.where(F.col("_state") == "raked").select("node", *values) for g, _ in gone])
    # Taken out nodes point to a child that left later: backwards, every pointer ends at a raked node.
    open_: DataFrame | None = None
    for done, out in reversed(gone):
        if not out:
            continue
        step = done.where(F.col("_gone").isNotNull()).select(F.col("_gone").alias("node"), F.col("node").alias("end"), *[(F.col(f"_part_{v}") + F.col(f"_was_{u}")).alias(v) for v, u in zip(values, ups)])
        if open_ is not None:
            later = open_.select(F.col("node").alias("end"), F.col("end").alias("_end"), *[F.col(v).alias(f"_l_{v}") for v in values])
            step = step.join(later, "end", "left").select(
                "node", F.coalesce("_end", "end").alias("end"), *[(F.col(v) + F.coalesce(f"_l_{v}", F.lit(0))).alias(v) for v in values]
            )
            step = step.unionByName(open_)
        open_ = cut_lineage(step)
    if open_ is None:
        return known
    ends = known.select(F.col("node").alias("end"), *[F.col(v).alias(f"_k_{v}") for v in values])
    expanded = open_.join(ends, "end").select("node", *[(F.col(v) + F.col(f"_k_{v}")).alias(v) for v in values])
    return known.unionByName(expanded)
