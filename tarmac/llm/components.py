"""Connected components of an edge table by alternating stars, with DataFrame operations only.

Each half round points edges at the smallest neighbour: first those of larger neighbours, then those of smaller ones. Edges
never grow in number, and the graph becomes one star per component after about log(n) rounds. A round is written to the
shared folder, so lost executors repeat one round at most. Hub nodes are reduced by map-side combined minima; the join back
is a plain equi-join that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans.storage import materialize


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst"))).first()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node that has an edge to another node; component is the smallest node of its component.

    Loops, repeated edges and edges with a null end are ignored; an edge table without other edges gives an empty result.
    """
    a, b = F.col(src), F.col(dst)
    clean = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")).distinct()
    current = materialize(clean, "edges")
    mark = _mark(current)
    while mark[0]:
        both = current.union(current.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        smallest = both.groupBy("src").agg(F.least("src", F.min("dst")).alias("_m"))
        large = both.join(smallest, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("_m").alias("dst")).distinct()
        smallest = large.groupBy("src").agg(F.min("dst").alias("_m"))
        joined = large.join(smallest, "src")
        small = joined.where("dst <> _m").select(F.col("dst").alias("src"), F.col("_m").alias("dst")).union(smallest.select("src", F.col("_m").alias("dst")))
        current = materialize(small.distinct(), "edges")
        before, mark = mark, _mark(current)
        if before == mark:
            break
    nodes = current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return nodes.union(current.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())
