"""Sums over all subtrees of a forest, by parallel tree contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.scratch import keep


def _follow(chain: DataFrame, values: list[str]) -> DataFrame:
    """Each node of ``chain (node, end, parent, values)`` with the end of its whole chain.

    ``end`` is the node that comes next, ``values`` are the sums up to before it. Three jumps a
    round, each as long as those of the round before reached, make steps four times as long. A
    node whose end lies in no chain is done and takes part as a goal alone, so a round costs
    what still moves; a chain of n nodes takes log4(n) rounds.
    """
    names = ["node", "end", "parent", *values]
    done, moving = [], chain.select(*names)
    while True:
        ahead = reduce(DataFrame.unionByName, [*done, moving]).select(
            F.col("node").alias("end"), F.col("end").alias("next"), *[F.col(v).alias(f"next_{v}") for v in values]
        )
        rows = moving
        for _ in range(3):
            rows = rows.join(ahead, "end", "left").select(
                "node", F.coalesce("next", "end").alias("end"), "parent",
                *[(F.col(v) + F.coalesce(F.col(f"next_{v}"), F.lit(0).cast("long"))).alias(v) for v in values],
                F.col("next").isNotNull().alias("moved"),
            )
        rows = keep(rows, "chain")
        done.append(rows.where("NOT moved").select(*names))
        moving = rows.where("moved").select(*names)
        if moving.isEmpty():
            return reduce(DataFrame.unionByName, done)


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``(node, values)``: for each node the sums of ``values`` over the nodes below it and itself.

    ``nodes (node, parent, values)`` is a forest: ``node`` is unique, ``parent`` a node or null.
    Values are long; a null value counts as 0. Rounds alternate two steps until nothing is left.
    Compress: every chain of nodes with one child is replaced by its end, and what the chain
    holds goes to the node above. Rake: every leaf is final, and goes to the node above as well.
    After a compress each inner node has two children or more, so a round at least halves the
    tree whatever its shape. Then the contracted chains are expanded, last round first: a node's
    total is its chain's part and the total of the chain's end.

    A node with very many children is summed per task before the shuffle. Each round's tree is a
    written table, so lost executors cost one round at most.
    """
    rows = nodes.select("node", "parent", *[F.coalesce(F.col(v).cast("long"), F.lit(0).cast("long")).alias(v) for v in values])
    below = rows.where("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("kids"), F.max("node").alias("kid"))
    live = keep(
        rows.join(below.withColumnRenamed("parent", "node"), "node", "left").withColumn("kids", F.coalesce("kids", F.lit(0).cast("long"))),
        "tree",
    )
    raked, chains = [], []
    while True:
        left, unary = live.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("kids") == 1, 1).otherwise(0)), F.lit(0))).first()
        if not left:
            break
        standing, sent = live, []
        if unary:
            one = live.where("kids = 1").select("node", F.col("kid").alias("end"), "parent", *values)
            chain = _follow(one, values)
            chains.append((len(raked), chain))
            # The top of a chain has no node of a chain above it; its end comes to stand there.
            tops = chain.join(one.select(F.col("node").alias("parent")), "parent", "left_anti")
            standing = live.where("kids <> 1").join(
                tops.select(F.col("end").alias("node"), F.col("parent").alias("above"), F.lit(True).alias("lifted")), "node", "left"
            ).withColumn("parent", F.when(F.col("lifted"), F.col("above")).otherwise(F.col("parent"))).drop("above", "lifted")
            sent.append(tops.select("parent", *values, F.lit(0).cast("long").alias("kids"), F.lit(None).cast(live.schema["node"].dataType).alias("kid")))
        raked.append(live.where("kids = 0").select("node", *values))
        stays = F.col("kids") > 0
        sent.append(standing.select(
            "parent", *[F.when(stays, 0).otherwise(F.col(v)).cast("long").alias(v) for v in values],
            F.when(stays, 1).otherwise(0).cast("long").alias("kids"), F.when(stays, F.col("node")).alias("kid"),
        ))
        news = reduce(DataFrame.unionByName, sent).where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(v).alias(f"new_{v}") for v in values], F.sum("kids").alias("kids"), F.max("kid").alias("kid")
        )
        live = keep(
            standing.where(stays).drop("kids", "kid").join(news, "node").select(
                "node", "parent", *[(F.col(v) + F.col(f"new_{v}")).alias(v) for v in values], "kids", "kid"
            ),
            "tree",
        )
    known = reduce(DataFrame.unionByName, raked) if raked else rows.limit(0).select("node", *values)
    for _, chain in reversed(chains):
        ends = known.select(F.col("node").alias("end"), *[F.col(v).alias(f"end_{v}") for v in values])
        expanded = chain.join(ends, "end").select("node", *[(F.col(v) + F.col(f"end_{v}")).alias(v) for v in values])
        known = known.unionByName(keep(expanded, "expanded"))
    return known
