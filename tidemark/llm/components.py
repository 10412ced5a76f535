"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.workspace import Workspace

MOST_ROUNDS = 60

#: Links that one file of a round holds on average. A local store starts a process for the rights
#: of every file, which for a moment counts as large as its executor.
LINKS_PER_FILE = 1 << 14


def components(
    work: Workspace, links: DataFrame, name: str, most: int | None = None
) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node reached.

    Alternates two steps that hang the neighbours of a node on its smallest neighbour: first
    the larger ones, then the smaller ones. Rounds grow with the logarithm of the nodes. Each
    round is a written table, in files by the number of links of the round before; the driver
    sees two sums per round. ``most`` says how many links there are at most, if that is known.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = links.where("a <> b").distinct()
    now = work.keep(links if most is None else links.coalesce(_files(most)), f"{name}-0")
    before, files = None, _files(now.count())
    for round_ in range(1, MOST_ROUNDS):
        both = now.select("a", "b").union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = (
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        large = large.union(low.where("a > low")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        new = work.keep(small.union(low).distinct().coalesce(files), f"{name}-{round_}")
        work.remove(f"{name}-{round_ - 1}")
        now = new
        state = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            break
        before, files = state, _files(state["n"])
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tops = roots.select(F.col("root").alias("node"), "root").distinct()
    return roots.union(tops.coalesce(files))


def _files(links: int) -> int:
    return max(1, -(-links // LINKS_PER_FILE))
