"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.storage import discard, keep


def components(links: DataFrame, tag: str) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``: the smallest node that can be reached.

    Each round gives a node the smallest root among its neighbours, hooks whole trees onto smaller roots and then shortens
    the paths, so the number of rounds grows with the logarithm of a component's length. A round is written to the
    shared folder. Minima are combined before the shuffle, so a node with very many links is no hot spot there.
    """
    # Both directions of a link come from one row, so that the links are computed once.
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = links.where(F.col("a") != F.col("b")).select(F.explode(ways).alias("way")).select("way.*")
    both = keep(both.distinct(), f"{tag}-links")
    roots = keep(both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("node"), F.least("a", "near").alias("root")), f"{tag}-roots")
    while True:
        # What roots do the ends of each link have?
        ends = both.join(roots.select(F.col("node").alias("a"), F.col("root").alias("root_a")), "a")
        ends = ends.join(roots.select(F.col("node").alias("b"), F.col("root").alias("root_b")), "b").where("root_a != root_b")
        hooks = ends.groupBy(F.greatest("root_a", "root_b").alias("old")).agg(F.min(F.least("root_a", "root_b")).alias("new"))
        hooks = keep(hooks, f"{tag}-hooks")
        if hooks.isEmpty():
            discard(both, hooks)
            return roots
        read = [roots, hooks]
        # Hooks point to smaller roots; following them until they end keeps every tree one step deep.
        while True:
            further = hooks.select(F.col("old").alias("new"), F.col("new").alias("next"))
            longer = keep(hooks.join(further, "new", "left").select("old", F.coalesce("next", "new").alias("new"), F.col("next").isNotNull().alias("moved")), f"{tag}-paths")
            read.append(longer)
            hooks = longer.select("old", "new")
            if longer.where("moved").isEmpty():
                break
        roots = roots.join(hooks, roots["root"] == hooks["old"], "left").select("node", F.coalesce("new", "root").alias("root"))
        roots = keep(roots, f"{tag}-roots")
        discard(*read)
