"""Connected components of a link table, by repeated contraction.

Each round every node points at its smallest neighbour (or itself), pointers are followed
twice, and the links are rewritten between the nodes pointed at; the graph shrinks until no
link is left. All steps are partial aggregations and equi-joins of narrow rows whose one
side is unique per key, so a hub is combined before the shuffle or split by the skew join.
Every round's tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of any orderable type -> ``(node, component)`` for every node of a
    link, where ``component`` is the smallest node of its component. Nulls link nothing;
    self-links and repeats are no matter."""
    rest = stored(links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL").distinct(), "links")
    label = rest.select(F.col("a").alias("node")).union(rest.select("b")).distinct().withColumn("component", F.col("node"))
    rest = rest.filter("a <> b")
    rounds = 0
    while not rest.isEmpty():
        both = rest.union(rest.select("b", "a"))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("p"))
        up = stored(up, "up")
        for _ in range(2):                                   # a pointer target is a node of this round as well
            top = up.select(F.col("n").alias("p"), F.col("p").alias("q"))
            up = up.join(top, "p").select("n", F.col("q").alias("p"))
        up = stored(up, "up")
        label = label.join(up.withColumnRenamed("n", "component"), "component", "left") \
            .select("node", F.coalesce("p", "component").alias("component"))
        rest = rest.join(up.select(F.col("n").alias("a"), F.col("p").alias("x")), "a") \
            .join(up.select(F.col("n").alias("b"), F.col("p").alias("y")), "b") \
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b").distinct()
        rest = stored(rest, "links")
        rounds += 1
    return stored(label, "components") if rounds else label
