"""Connected components of a link table, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored

MAX_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node with the node's smallest neighbour (or the node itself). Links may be
    repeated, no more often than there were links."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, with the node's smallest neighbour."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    each = F.explode(F.array(F.col("u"), F.col("v"))).alias("u")
    return links.join(least, "u").select(each, F.col("m").alias("v")).where("u <> v").distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)`` that is not itself the smallest of its component.

    Minima are combined before each shuffle and the joins that follow may be split by Spark where one node has
    very many links, so no neighbourhood is ever held by one task. Each round is written to the shared folder.
    Links from a node to itself and links with a null end are ignored; an empty table gives an empty one.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = stored(links, "links")
    mark = _mark(links)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        links = stored(_small_star(_large_star(links)), "links")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components still change after {MAX_ROUNDS} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
