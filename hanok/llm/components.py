"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hanok.llm.shared import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(links: DataFrame, name: str) -> DataFrame:
    """``links`` (a, b): each b and a itself are tied to the least of a and its b; written, since both users read it."""
    least = written(links.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), f"{name}-least")
    return links.join(least, "a").select("a", "b", "least")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links`` (a, b), integers, to (node, component): the least node that can be reached.

    A large star ties every larger neighbour of a node to the least one, a small star the smaller neighbours;
    repeated, each component becomes a star around its least node, in a number of rounds that grows with the
    logarithm of the component and not with its length. Nothing but two sums per round goes to the driver, and
    every round is a written table, so that a lost executor costs one round at most. Links of a hub are joined
    to one row per node, which Spark splits where the hub is hot. No links give no rows.
    """
    links = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = _state(links)
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = written(_star(both, name).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct(), name)
        small = _star(large, name)
        links = written(
            small.select(F.col("b").alias("a"), F.col("least").alias("b"))
            .union(small.select("a", F.col("least").alias("b")))
            .where("a <> b")
            .distinct(),
            name,
        )
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
