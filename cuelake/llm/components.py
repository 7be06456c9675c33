"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cuelake.llm.common import stored


def components(links: DataFrame, name: str = "cc") -> DataFrame:
    """(id, comp) for every end of ``links`` (a, b); comp is the smallest id reachable.

    Every component hooks onto its smallest neighbour, chains are shortened by pointer
    jumping, links are contracted; each round at least halves the components left. Only
    minima are aggregated, so a node with very many links is no burden.
    """
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), name)
    labels = None
    turn = 0
    while labels is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(both.groupBy("a").agg(F.min("b").alias("to")).select("a", F.least("a", "to").alias("to")), f"{name}-hook{turn}")
        while True:
            up = parent.select(F.col("a").alias("to"), F.col("to").alias("above"))
            jumped = stored(parent.join(up, "to").select("a", F.col("above").alias("to"), (F.col("above") != F.col("to")).alias("moved")), f"{name}-jump{turn}")
            moved = not jumped.filter("moved").isEmpty()
            parent = jumped.drop("moved")
            if not moved:
                break
        if labels is None:
            labels = parent.select(F.col("a").alias("id"), F.col("to").alias("comp"))
        else:
            labels = stored(labels.join(parent, labels["comp"] == parent["a"], "left").select(
                "id", F.coalesce("to", "comp").alias("comp")), f"{name}-label{turn}")
        ends = edges
        for c in ("a", "b"):
            ends = ends.join(parent.select(F.col("a").alias(c), F.col("to").alias(f"{c}2")), c)
        edges = stored(ends.filter("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(), f"{name}-rest{turn}")
        turn += 1
    return labels
