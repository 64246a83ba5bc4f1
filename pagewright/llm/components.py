"""Connected components of a link table, by rounds of large-star and small-star joins.

Each round is two partial aggregations (the smallest neighbour of a node) and two joins, written to the
shared folder. Hubs are safe: a minimum combines before the shuffle; the minima are written before they
are joined, so that both sides of a join are plain shuffles, which adaptive execution may split. Links are
counted in each round, and tables of few rows are written by few tasks: each file costs its executor a
process or two (Hadoop's chmod), and a round writes four tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.common import materialize

#: Links for each task that writes what becomes of them; there are at least two tasks for each core.
TASK_LINKS = 1 << 18


def _with_smallest(spark: SparkSession, edges: DataFrame, tasks: int, label: str) -> DataFrame:
    """``edges`` with m, the smallest of u and its neighbours."""
    smallest = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    smallest = materialize(spark, smallest.coalesce(tasks), label)
    return edges.join(smallest.hint("merge"), "u")


def connected_components(spark: SparkSession, links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for each node that is not itself a root; ``links`` has columns a, b.

    A root is the smallest node of its component. Null ends, self links and repeated links are ignored.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = materialize(spark, edges, label), None
    while True:
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, tasks = state, max(2 * spark.sparkContext.defaultParallelism, state[0] // TASK_LINKS)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_smallest(spark, both, tasks, label).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(spark, large.coalesce(tasks), label)
        small = _with_smallest(spark, large, tasks, label)
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(spark, small.coalesce(tasks), label)
