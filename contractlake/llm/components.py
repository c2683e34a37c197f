"""Connected components of a link table by randomized contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlake.llm.stage import saved


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (node, root): one root per component, for every node that has a link. ``root`` is some node of the component.

    Each round every node moves to the member of its closed neighbourhood that comes first in a random order
    (a hash of node and round); links are carried over and loops dropped. A constant share of the nodes goes in
    each round, long chains and stars alike, so rounds grow with the logarithm of the largest component. Every
    round is a pre-aggregated minimum and two joins of written tables, whose large keys Spark splits; nothing is
    collected. Null ends, loops and repeated links are ignored; no links give no rows.
    """
    live = saved(edges.select(F.col(src).cast("long").alias("a"), F.col(dst).cast("long").alias("b"))
                 .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    moves: list[DataFrame] = []
    while not live.isEmpty():
        k = len(moves)
        near = (live.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")),
                                              F.struct(F.col("b").alias("node"), F.col("a").alias("to")),
                                              F.struct(F.col("a").alias("node"), F.col("a").alias("to")),
                                              F.struct(F.col("b").alias("node"), F.col("b").alias("to")))).alias("s")).select("s.*"))
        first = F.min(F.struct(F.xxhash64("to", F.lit(k)).alias("h"), F.col("to")))
        move = saved(near.groupBy("node").agg(first.alias("m")).select("node", F.col("m.to").alias("to")), "moves")
        half = live.join(move, live["a"] == move["node"]).select(F.col("to").alias("a"), "b")
        both = half.join(move.select(F.col("node").alias("n2"), F.col("to").alias("t2")), F.col("b") == F.col("n2"))
        live = saved(both.where("a <> t2").select(F.least("a", "t2").alias("a"), F.greatest("a", "t2").alias("b")).distinct(), "links")
        moves.append(move)
    if not moves:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves.pop().withColumnRenamed("to", "root")
    while moves:
        later = found.select(F.col("node").alias("via"), "root")
        step = moves.pop()
        found = saved(step.join(later, step["to"] == later["via"], "left")
                      .select("node", F.coalesce("root", "to").alias("root")), "roots")
    return found
