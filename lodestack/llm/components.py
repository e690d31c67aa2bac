"""Connected components of a link table by contraction: hook to the smallest neighbour, jump, contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small, table


def components(links: DataFrame) -> DataFrame:
    """links: (a long, b long). Returns v, label: every vertex with the smallest vertex reachable from it.

    Every phase at least halves the vertices of each component that is not done, so the number of phases grows with
    the logarithm of the input; each step is written to the shared folder. A hub with any number of links is one row a
    task after partial aggregation; the joins are many-to-one."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).filter("u <> v").distinct()
    edges, labels = table(both, "cc-edges"), None
    while True:
        n = edges.count()
        if n == 0:
            break
        parent = table(edges.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p")), "cc-parent")
        rows = parent.count()
        while True:
            up = small(parent.select(F.col("u").alias("p"), F.col("p").alias("pp")), rows)
            parent = table(parent.join(up, "p").select("u", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "cc-jump")
            moved = parent.filter("moved").limit(1).count()
            parent = parent.select("u", "p")
            if not moved:
                break
        if labels is None:
            labels = parent.select(F.col("u").alias("v"), F.col("p").alias("label"))
        else:
            up = small(parent.select(F.col("u").alias("label"), F.col("p").alias("higher")), rows)
            labels = table(labels.join(up, "label", "left").select("v", F.coalesce("higher", "label").alias("label")), "cc-labels")
        of_u = small(parent.select("u", F.col("p").alias("pu")), rows)
        of_v = small(parent.select(F.col("u").alias("v"), F.col("p").alias("pv")), rows)
        edges = table(edges.join(of_u, "u").join(of_v, "v").filter("pu <> pv").select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), "cc-edges")
    if labels is None:
        return links.sparkSession.createDataFrame([], "v long, label long")
    return labels
