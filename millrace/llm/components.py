"""Connected components of a table of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import cut


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root): each node's least reachable node, for all nodes of ``links``.

    In each round every node points to its least neighbour, or to itself if none is less,
    pointers are followed to their ends, each step twice as far, and links are drawn anew
    between what their ends point to; loops and repeats fall away. Every node with a link
    merges with another one, so the graph at least halves each time, and the first round is
    the only one that handles all links. All joins look up unique keys, so no row multiplies,
    and adaptive execution splits hot ones. Rounds are stored reliably. Null ends are no links;
    loops and repeated links change nothing; no links give no rows.
    """
    known = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null")
    nodes = known.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    placed = cut(nodes.select("node", F.col("node").alias("root")))
    edges = cut(_between(known, F.col("x"), F.col("y")))
    while not edges.isEmpty():
        near = edges.select(F.explode(F.array(F.struct(F.col("low").alias("node"), F.col("high").alias("to")), F.struct(F.col("high").alias("node"), F.col("low").alias("to")))).alias("e")).groupBy("e.node").agg(F.min("e.to").alias("to"))
        jump = cut(near.select("node", F.least("node", "to").alias("to")))
        moved = True
        while moved:
            step = jump.join(jump.select(F.col("node").alias("to"), F.col("to").alias("further")), "to")
            further = cut(step.select("node", F.col("further").alias("to"), (F.col("further") != F.col("to")).alias("moved")))
            moved = not further.where("moved").isEmpty()
            jump = further.select("node", "to")
        one = edges.join(jump.select(F.col("node").alias("low"), F.col("to").alias("x")), "low")
        two = one.join(jump.select(F.col("node").alias("high"), F.col("to").alias("y")), "high")
        edges = cut(_between(two, F.col("x"), F.col("y")))
        placed = cut(placed.join(jump.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root")))
    return placed


def _between(rows: DataFrame, x: Column, y: Column) -> DataFrame:
    """Distinct links (low, high) without loops."""
    return rows.where(x != y).select(F.least(x, y).alias("low"), F.greatest(x, y).alias("high")).distinct()
