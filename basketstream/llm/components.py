"""Connected components of an edge table by alternating star contractions.

*Large star*: every node links its larger neighbours to its smallest one. *Small
star*: every node links its smaller neighbours and itself to the smallest of
them. Both keep the components; repeated, they end in one star per component,
whose centre is the smallest node. Only edges move, each round is written to the
shared folder, and the driver sees two numbers per round.
"""

from pyspark.sql import DataFrame, functions as F

from basketstream.llm.common import write_once


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _print(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has long columns a, b. Gives node, root for every node of an edge but the roots.

    ``root`` is the smallest node of the component. An empty table gives an empty one.
    """
    now = write_once(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        now = write_once(_small_star(_large_star(now)), "edges")
        before, seen = seen, _print(now)
        if before == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
